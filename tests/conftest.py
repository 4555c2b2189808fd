import json
import pathlib
import sys
import tempfile

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

FIXTURES = pathlib.Path(__file__).parent / "fixtures"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]")
        .appName("indtables-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="indtables-test-ckpt-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="indtables-test-")


def load_fixture(name: str) -> dict:
    return json.loads((FIXTURES / name).read_text())


def docs_frame(spark, docs: list[dict], feed: str):
    """Documents (Python dicts) as a DataFrame with the feed's schema, going
    through JSON text exactly as files would."""
    from indtables.schemas import FEED_A_SCHEMA, FEED_B_SCHEMA

    schema = FEED_A_SCHEMA if feed == "a" else FEED_B_SCHEMA
    texts = spark.createDataFrame([(json.dumps(d),) for d in docs], "json string")
    from pyspark.sql import functions as F

    return texts.select(F.from_json("json", schema).alias("d")).select("d.*")
