"""Bronze scans before, during and after packing."""

import os
import time

import pytest

from conftest import docs_frame
from indtables.plans.refresh import published, run
from indtables.schemas import FEED_A_SCHEMA
from indtables.sinks.writers import write_bronze
from indtables.sources import packing
from indtables.sources.bronze import read_bronze
from indtables.sources.packing import pack_bronze, packs


def land(spark, bronze, n, first=0, age=0):
    """``n`` objects of one pull each, as the extract lands them."""
    top = os.path.join(bronze, "banxico")
    had = set(os.listdir(top)) if os.path.isdir(top) else set()
    docs = [{"pulled_at": None if i % 2 else f"2024010{i % 9}T000000", "bmx": {"series": [{"idSerie": f"S{i % 3}", "datos": [
        {"fecha": f"{i % 27 + 1:02d}/01/2024", "dato": "x" if i == 4 else f'{i}.5'}]}]}} for i in range(first, first + n)]
    write_bronze(docs_frame(spark, docs, "a").repartition(n), bronze, "banxico")
    for f in set(os.listdir(top)) - had:
        path = os.path.join(top, f)
        os.utime(path, (time.time() - age,) * 2)


def scan(spark, bronze):
    return sorted(map(repr, read_bronze(spark, bronze, "banxico", FEED_A_SCHEMA).collect()))


def loose(bronze):
    """Objects with a document; Spark also leaves an empty file in a write."""
    top = os.path.join(bronze, "banxico")
    return sorted(f for f in os.listdir(top) if f.endswith(".json") and os.path.getsize(os.path.join(top, f)))


def test_a_scan_is_the_same_before_and_after(spark, scratch):
    bronze = os.path.join(scratch, "bronze")
    assert pack_bronze(spark, bronze, "banxico", 0) == 0  # nothing there yet
    land(spark, bronze, 20, age=100)
    land(spark, bronze, 3, 20)
    want = scan(spark, bronze)
    n = len(loose(bronze))
    packed = pack_bronze(spark, bronze, "banxico", 50)
    assert scan(spark, bronze) == want and 0 < packed < n and len(loose(bronze)) == n - packed  # the young stay
    assert pack_bronze(spark, bronze, "banxico", 50) == 0 and len(packs(spark, bronze, "banxico")) == 1
    land(spark, bronze, 5, 30)
    want, n = scan(spark, bronze), len(loose(bronze))
    assert pack_bronze(spark, bronze, "banxico", -60) == n
    assert scan(spark, bronze) == want and loose(bronze) == [] and len(packs(spark, bronze, "banxico")) == 2
    files = [f for p in packs(spark, bronze, "banxico") for f in os.listdir(p) if f.startswith("part-")]
    assert len(files) <= 4  # of some 28 objects


@pytest.mark.parametrize("where", ["before the pointer", "before the deletes", "between the deletes"])
def test_a_run_that_dies(spark, scratch, monkeypatch, where):
    bronze = os.path.join(scratch, "bronze")
    land(spark, bronze, 12)
    want = scan(spark, bronze)

    def dies(*args):
        if where == "between the deletes":
            os.remove(os.path.join(bronze, "banxico", loose(bronze)[0]))
        raise OSError("driver lost")

    name = "write_small" if where == "before the pointer" else "_delete_packed"
    real, calls = getattr(packing, name), []

    def later(*args):  # the first call finishes what an earlier run left
        calls.append(1)
        return real(*args) if name == "_delete_packed" and len(calls) == 1 else dies(*args)

    monkeypatch.setattr(packing, name, later)
    with pytest.raises(OSError):
        pack_bronze(spark, bronze, "banxico", -60)
    monkeypatch.setattr(packing, name, real)
    assert scan(spark, bronze) == want
    pack_bronze(spark, bronze, "banxico", -60)
    assert scan(spark, bronze) == want and loose(bronze) == []


def test_a_refresh_over_packs(spark, scratch):
    bronze, plain, after, inc = (os.path.join(scratch, x) for x in ("bronze", "plain", "after", "inc"))
    land(spark, bronze, 25)
    assert run(spark, bronze, plain)["silver"] == 24
    pack_bronze(spark, bronze, "banxico", -60)
    land(spark, bronze, 1, 3)
    run(spark, bronze, after)
    for t in ("silver", "long", "wide"):
        a, b = (sorted(map(repr, getattr(published(spark, r), t)().collect())) for r in (plain, after))
        assert a == b, t
    rejects = published(spark, after).rejects().collect()
    assert len(rejects) == 1 and rejects[0]["_pull_file"]
    with pytest.raises(ValueError, match="packed pulls"):
        run(spark, bronze, inc, incremental=True)
