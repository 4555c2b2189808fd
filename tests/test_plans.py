"""SQL surface, the whole refresh, the stream intake and the driver contract."""

import datetime as dt
import os

import duckdb
import pytest

from conftest import FIXTURES, docs_frame
from indtables.plans.query import GoldCatalog
from indtables.plans.refresh import Intake, published, run
from indtables.sinks.publish import POINTER, read_small, write_small
from indtables.sinks.writers import write_bronze, write_csv_file
from indtables.sources.gold import read_csv_typed
from indtables.schemas import FEED_A_SCHEMA, FEED_B_SCHEMA, LONG_SCHEMA
from indtables.streaming.bronze_stream import conform_new_pulls, landed_rejects, landed_rows, silver_from_landing


def tiny_gold(spark, scratch):
    """Three long rows of two series and two wide rows, written."""
    long_ = spark.createDataFrame(
        [("s1", "k1", "steel", dt.date(2021, 5, 30), 400.0, False, None, 400.0),
         ("s1", "k1", "steel", dt.date(2021, 6, 4), 300.0, False, -25.0, 350.0),
         ("s2", "k2", "copper", dt.date(2021, 6, 4), 9.5, True, None, 9.5)], LONG_SCHEMA)
    wide = spark.createDataFrame([(dt.date(2021, 5, 30), None, 400.0), (dt.date(2021, 6, 4), 9.5, 300.0)],
                                 "calendar_date date, copper double, steel double")
    paths = os.path.join(scratch, "long"), os.path.join(scratch, "wide")
    for df, path in zip((long_, wide), paths):
        df.coalesce(1).write.parquet(path)
    return GoldCatalog(spark, *paths)


def test_sql_tails_and_counts(spark, scratch):
    cat = tiny_gold(spark, scratch)
    assert cat.row_counts() == {"indicators_long": 3, "indicators_wide": 2}
    assert cat.query_wide("WHERE copper IS NULL").columns == ["calendar_date", "copper", "steel"]
    assert [r["change_pct"] for r in cat.query_long("WHERE value < 350 ORDER BY value DESC").collect()] == [-25.0, None]
    joined = cat.query_long("JOIN indicators_wide w ON w.calendar_date = obs_date AND w.steel = value")
    assert joined.count() == 2


def test_suffix_filter_reaches_the_scan(spark, scratch):
    cat = tiny_gold(spark, scratch)
    plan = cat.query_long("WHERE indicator_label = 'x'").select("value")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(indicator_label), EqualTo(indicator_label,x)]" in plan
    assert "ReadSchema: struct<indicator_label:string,value:double>" in plan


def test_missing_gold_raises_clear_error(spark, scratch):
    cat = GoldCatalog(spark, os.path.join(scratch, "none"), os.path.join(scratch, "none2"))
    with pytest.raises(FileNotFoundError, match="none"):
        cat.query_long()


def test_csv_export(spark, scratch):
    cat = tiny_gold(spark, scratch)
    long_csv, wide_csv = cat.export_csv(os.path.join(scratch, "csv"))
    assert cat.export_csv(os.path.join(scratch, "csv")) == [long_csv, wide_csv]  # rerun replaces
    assert spark.read.option("header", True).csv(long_csv).count() == 3


def test_exact_csv_files(spark, scratch):
    out = os.path.join(scratch, "csv1")
    for _ in range(2):  # a rerun replaces the files
        paths = tiny_gold(spark, os.path.join(scratch, str(_))).export_csv(out, single_file=True)
        assert paths == [os.path.join(out, "indicators_long.csv"), os.path.join(out, "indicators_wide.csv")]
        lines = open(paths[0]).read().splitlines()
        assert lines[0].startswith("source,indicator_id") and len(lines) == 4
        assert [ln.split(",")[3] for ln in lines[1:]] == ["2021-05-30", "2021-06-04", "2021-06-04"]  # ordered
        assert sorted(f for f in os.listdir(out) if not f.endswith(".crc")) == ["indicators_long.csv", "indicators_wide.csv"]
    assert read_csv_typed(spark, paths[0], LONG_SCHEMA).count() == 3
    empty = write_csv_file(spark.createDataFrame([], 'a int, "b,c" string'.replace('"', "`")), os.path.join(out, "none.csv"))
    assert open(empty).read().splitlines() == ['a,"b,c"']


def test_bound_values_and_two_catalogs(spark, scratch):
    one, two = (tiny_gold(spark, os.path.join(scratch, x)) for x in "ab")
    two = GoldCatalog(spark, two.long().filter("value < 100"), two.wide())
    views = {t.name for t in spark.catalog.listTables()}
    tail = "WHERE indicator_label = :label AND value >= :low ORDER BY obs_date"
    a = one.query_long(tail, {"label": "steel", "low": 350.0})
    b = two.query_long("WHERE indicator_label = ? AND value >= ?", ["steel", 0.0])
    assert [r["value"] for r in a.collect()] == [400.0] and b.count() == 0  # two's frames do not replace one's
    assert [r["value"] for r in one.query_long(tail, {"label": "x' OR '1' = '1", "low": 0.0}).collect()] == []
    assert one.query_long("WHERE indicator_label <> '{steel}'").count() == 3
    assert {t.name for t in spark.catalog.listTables()} == views  # nothing is left in the session


def land_fixtures(spark, bronze, times=1):
    a = spark.read.schema(FEED_A_SCHEMA).option("multiLine", True).json(str(FIXTURES / "feed_a_sample.json"))
    b = spark.read.schema(FEED_B_SCHEMA).option("multiLine", True).json(str(FIXTURES / "feed_b_sample.json"))
    for _ in range(times):
        write_bronze(a, bronze, "banxico")
        write_bronze(b, bronze, "inegi")


def test_refresh_end_to_end_and_idempotent(spark, scratch):
    bronze, out = os.path.join(scratch, "bronze"), os.path.join(scratch, "out")
    land_fixtures(spark, bronze, times=2)  # two identical pulls: dedupe keeps one of each
    counts = run(spark, bronze, out)
    assert counts["silver"] == 8 and counts["indicators_long"] == 8
    assert counts["indicators_wide"] == 401  # the last day and 400 before it
    assert run(spark, bronze, out) == counts
    from indtables.plans.query import query_long, query_wide, row_counts

    assert row_counts(spark, out) == {"indicators_long": 8, "indicators_wide": 401}
    assert query_long(spark, out, "WHERE source = 'inegi'").count() == 3
    assert query_wide(spark, out, "WHERE inpc_general = 60.5").count() == 31  # January
    now = published(spark, out)
    wide = now.wide()
    assert wide.columns == ["calendar_date", "SF46410", "inpc_general", "viviendas_censo"]
    rows = wide.orderBy("calendar_date").collect()
    assert tuple(rows[0]) == (dt.date(2023, 2, 2), None, None, 42.0)
    assert tuple(rows[-1]) == (dt.date(2024, 3, 8), 99.0, 61.25, 7.25)
    assert now.rejects().count() == 0
    assert now.conformed().count() == 2 * 8


def test_refresh_with_only_one_feed(spark, scratch):
    bronze, out = os.path.join(scratch, "bronze"), os.path.join(scratch, "out")
    a = spark.read.schema(FEED_A_SCHEMA).option("multiLine", True).json(str(FIXTURES / "feed_a_sample.json"))
    write_bronze(a, bronze, "banxico")
    assert run(spark, bronze, out)["silver"] == 5


def tables(spark, root):
    now = published(spark, root)
    return {t: sorted(map(repr, getattr(now, t)().collect())) for t in ("silver", "long", "wide")}


def test_refresh_with_absent_ids_and_clashing_labels(spark, scratch):
    bronze, out = os.path.join(scratch, "bronze"), os.path.join(scratch, "out")
    point = [{"fecha": "01/02/2024", "dato": "3"}]
    docs = [{"bmx": {"series": [{"datos": point}, {"idSerie": "FX", "datos": point}, {"idSerie": "fx", "datos": point},
                                {"idSerie": "Calendar_Date", "datos": point}]}}]
    write_bronze(docs_frame(spark, docs, "a"), bronze, "banxico")
    assert run(spark, bronze, out) == {"indicators_long": 4, "indicators_wide": 1, "silver": 4}
    wide = published(spark, out).wide()
    assert wide.columns == ["calendar_date", "unlabelled", "Calendar_Date_2", "FX", "fx_2"]


@pytest.mark.parametrize("incremental", [False, True])
def test_wrong_bronze_root_leaves_the_tables(spark, scratch, incremental):
    bronze, out = os.path.join(scratch, "bronze"), os.path.join(scratch, "out")
    land_fixtures(spark, bronze)
    run(spark, bronze, out, incremental=incremental)
    before = tables(spark, out)
    with pytest.raises(FileNotFoundError, match="no bronze folder"):
        run(spark, os.path.join(scratch, "nowhere"), out, incremental=incremental)
    assert tables(spark, out) == before


def test_empty_bronze_folder_replaces_all_tables(spark, scratch):
    bronze, out = os.path.join(scratch, "bronze"), os.path.join(scratch, "out")
    land_fixtures(spark, bronze)
    run(spark, bronze, out)
    empty = os.path.join(scratch, "empty")
    os.makedirs(os.path.join(empty, "banxico"))
    assert run(spark, empty, out) == {"silver": 0, "indicators_long": 0, "indicators_wide": 0}
    now = published(spark, out)
    assert now.conformed().count() == now.rejects().count() == 0


def test_incremental_takes_pulls_of_any_file_time(spark, scratch):
    bronze, inc, full = (os.path.join(scratch, x) for x in ("bronze", "inc", "full"))

    def pull(day, age_days):
        docs = [{"bmx": {"series": [{"idSerie": "Q", "datos": [{"fecha": day, "dato": "1"}]}]}}]
        had = set(os.listdir(os.path.join(bronze, "banxico"))) if os.path.isdir(os.path.join(bronze, "banxico")) else set()
        write_bronze(docs_frame(spark, docs, "a").coalesce(1), bronze, "banxico")
        for f in set(os.listdir(os.path.join(bronze, "banxico"))) - had:
            path = os.path.join(bronze, "banxico", f)
            os.utime(path, (os.path.getmtime(path) - age_days * 86400,) * 2)

    pull("01/01/2024", 0)
    assert run(spark, bronze, inc, incremental=True)["silver"] == 1
    pull("02/01/2024", 30)
    pull("03/01/2024", 0)
    assert run(spark, bronze, inc, incremental=True)["silver"] == 3
    run(spark, bronze, full)
    assert tables(spark, inc) == tables(spark, full)


def test_incremental_does_not_hang_on_the_session_checkpoint_folder(spark, scratch):
    """The intake's checkpoint belongs to the output, not to the session."""
    bronze, inc = os.path.join(scratch, "bronze"), os.path.join(scratch, "inc")
    land_fixtures(spark, bronze)
    run(spark, bronze, inc, incremental=True)
    assert os.path.isdir(Intake(inc).checkpoint)


def test_incremental_refuses_a_lost_half(spark, scratch):
    import shutil

    bronze = os.path.join(scratch, "bronze")
    land_fixtures(spark, bronze)
    for lost in ("checkpoint", "conformed"):
        root = os.path.join(scratch, lost)
        run(spark, bronze, root, incremental=True)
        before = tables(spark, root)
        shutil.move(getattr(Intake(root), lost), os.path.join(scratch, f"moved-{lost}"))
        with pytest.raises(RuntimeError, match="has lost its"):
            run(spark, bronze, root, incremental=True)
        assert tables(spark, root) == before


def test_one_mode_per_root(spark, scratch):
    bronze = os.path.join(scratch, "bronze")
    land_fixtures(spark, bronze)
    for first in (False, True):
        root = os.path.join(scratch, f"out-{first}")
        run(spark, bronze, root, incremental=first)
        before = tables(spark, root)
        with pytest.raises(ValueError, match="needs a root of its own"):
            run(spark, bronze, root, incremental=not first)
        assert tables(spark, root) == before


def test_rejects_name_their_pull(spark, scratch):
    bronze, out = os.path.join(scratch, "bronze"), os.path.join(scratch, "out")
    for stamp in ("20240101T000000", "20240102T000000"):
        docs = [{"pulled_at": stamp, "bmx": {"series": [{"idSerie": "Q", "datos": [{"fecha": "1/1/2024", "dato": "x"}]}]}}]
        write_bronze(docs_frame(spark, docs, "a"), bronze, "banxico")
    run(spark, bronze, out)
    rows = published(spark, out).rejects().collect()
    assert sorted((r["reason"], r["_pull_stamp"]) for r in rows) == [
        ("bad_value", "20240101T000000"), ("bad_value", "20240102T000000")]
    assert all(r["_pull_file"] for r in rows)


def test_stream_intake_only_new_pulls(spark, scratch):
    bronze, landing, ckpt = (os.path.join(scratch, x) for x in ("bronze", "landing", "ckpt"))
    land_fixtures(spark, bronze)
    conform_new_pulls(spark, bronze, landing, ckpt, feeds=["a"])
    assert landed_rows(spark, landing).count() == 5
    conform_new_pulls(spark, bronze, landing, ckpt, feeds=["a"])
    assert landed_rows(spark, landing).count() == 5  # nothing new landed
    land_fixtures(spark, bronze)
    conform_new_pulls(spark, bronze, landing, ckpt, feeds=["a"])
    assert landed_rows(spark, landing).count() == 10
    assert landed_rejects(spark, landing).count() == 0
    assert silver_from_landing(spark, landing).count() == 5


def test_stream_intake_bounded_batches(spark, scratch):
    bronze, landing, ckpt = (os.path.join(scratch, x) for x in ("bronze", "landing", "ckpt"))
    land_fixtures(spark, bronze, times=3)
    conform_new_pulls(spark, bronze, landing, ckpt, feeds=["b"], max_files_per_batch=1)
    assert landed_rows(spark, landing).count() == 9
    assert len([f for f in os.listdir(os.path.join(ckpt, "commits")) if f.isdigit()]) >= 3


def test_driver_contract(spark):
    import __spark_entry__ as E

    assert set(E.QUERY_NAMES) <= set(E.oracle_sql())  # every one of these has its SQL twin
    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    assert df.columns[-2:] == ["change_pct", "rolling_avg_30d"]
    assert df.count() > 0


@pytest.mark.parametrize("key", ["gold_long", "gold_wide", "parse_feed_b", "conform_rejects", "conform_rejects_a",
                                 "report_inpc_shipped", "kpi_latest", "fallback_by_source", "wide_dense_lineitem",
                                 "refresh_incremental_long", "refresh_incremental_wide", "refresh_rejects",
                                 "rolling_avg_plain", "label_join"])
def test_queries_match_oracle_small(spark, key):
    import math

    import __spark_entry__ as E

    root = "/root/testdata/sf0.001"
    if not os.path.isdir(root):
        pytest.skip("no driver tables")
    con = duckdb.connect()
    for t in ("orders", "lineitem", "customer"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    got = E.queries()[key](spark, root).toPandas()
    want = con.sql(E.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)

    def norm(df):
        out = []
        for r in df[cols].itertuples(index=False):
            row = []
            for v in r:
                if hasattr(v, "item"):
                    v = v.item()
                if v is None or (isinstance(v, float) and math.isnan(v)):
                    v = None
                elif hasattr(v, "date") and not isinstance(v, str):
                    v = v.date() if hasattr(v, "hour") else v
                row.append(repr(v))
            out.append(tuple(row))
        return sorted(out)

    assert norm(got) == norm(want)


def test_offline_chain_fallback_to_csv(spark, scratch):
    """No feed reachable: synthetic pulls -> refresh -> CSV, all flagged."""
    from indtables.plans.extract import land_fallback_pulls

    bronze, out = os.path.join(scratch, "bronze"), os.path.join(scratch, "out")
    land_fallback_pulls(spark, bronze, dt.date(2026, 8, 28))
    counts = run(spark, bronze, out)
    # feed A: 401 daily FX rows + 13 month starts; feed B: 4 indicators x 6 months
    assert counts["silver"] == 401 + 13 + 24
    assert counts["indicators_wide"] == 401
    now = published(spark, out)
    long_ = now.long()
    assert long_.filter("NOT is_fallback").count() == 0
    wide = now.wide().orderBy("calendar_date").collect()
    assert wide[-1]["fx_rate_usd_mxn"] == 17.5 and wide[-1]["igae_ivf"] == 100.0
    assert wide[-1]["inpc_general"] == 130.0
    # a later real pull of the same day wins over the synthetic one
    real = {"is_fallback": False, "bmx": {"series": [{"idSerie": "SF43718",
            "datos": [{"fecha": "28/08/2026", "dato": "18.25"}]}]}}
    write_bronze(docs_frame(spark, [real], "a"), bronze, "banxico")
    run(spark, bronze, out)
    now = published(spark, out)
    row = now.silver().filter("indicator_id = 'SF43718' AND obs_date = DATE'2026-08-28'").collect()
    assert len(row) == 1 and row[0]["value"] == 18.25 and row[0]["is_fallback"] is False
    cat = GoldCatalog(spark, now.long(), now.wide())
    long_csv, wide_csv = cat.export_csv(os.path.join(scratch, "csv"))
    assert spark.read.option("header", True).csv(wide_csv).count() == 401


def test_command_line_chain(scratch):
    """extract -> refresh -> export as three separate processes."""
    import subprocess
    import sys

    env = dict(os.environ, PYTHONPATH=str(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    bronze, out, csv = (os.path.join(scratch, x) for x in ("bronze", "out", "csv"))

    def run_cli(*args):
        r = subprocess.run([sys.executable, "-m", *args], env=env, capture_output=True, text=True, timeout=300)
        assert r.returncode == 0, r.stderr[-2000:]
        return r.stdout

    run_cli("indtables.plans.extract", bronze, "--end-date", "2026-08-28")
    assert "'indicators_wide': 401" in run_cli("indtables.plans.refresh", bronze, out)
    assert "'indicators_long': 438" in run_cli("indtables.plans.query", out, csv)


def test_incremental_refresh_matches_full(spark, scratch):
    """Incremental runs after each landing == one full run over all pulls."""
    from indtables.plans.extract import land_fallback_pulls

    bronze, inc, full = (os.path.join(scratch, x) for x in ("bronze", "inc", "full"))
    os.makedirs(os.path.join(bronze, "inegi"))
    assert run(spark, bronze, inc, incremental=True)["silver"] == 0  # nothing landed yet
    land_fixtures(spark, bronze)
    assert run(spark, bronze, inc, incremental=True)["silver"] == 8
    revised = {"bmx": {"series": [{"idSerie": "SF46410", "datos": [
        {"fecha": "04/03/2024", "dato": "77"}, {"fecha": "09/03/2024", "dato": "78"}, {"fecha": "x", "dato": "1"}]}]}}
    write_bronze(docs_frame(spark, [revised], "a"), bronze, "banxico")
    land_fallback_pulls(spark, bronze, dt.date(2024, 3, 9), lookback_days=10)
    assert run(spark, bronze, inc, incremental=True) == run(spark, bronze, full)
    pi, pf = published(spark, inc), published(spark, full)
    for t in ("silver", "long", "wide", "rejects"):
        a = sorted(map(repr, getattr(pi, t)().collect()))
        b = sorted(map(repr, getattr(pf, t)().collect()))
        assert a == b, t
    row = pi.silver().filter("indicator_id = 'SF46410' AND obs_date = DATE'2024-03-04'").collect()
    assert row[0]["value"] == 77.0  # the newer real pull revised the day


def test_incremental_merge_over_several_runs_and_a_lost_state_write(spark, scratch):
    from indtables.plans.extract import land_fallback_pulls

    bronze, inc = os.path.join(scratch, "bronze"), os.path.join(scratch, "inc")

    def pull(day_values, fallback=False):
        doc = {"is_fallback": fallback, "bmx": {"series": [{"idSerie": "SF43718", "datos": [
            {"fecha": d, "dato": v} for d, v in day_values]}]}}
        write_bronze(docs_frame(spark, [doc], "a"), bronze, "banxico")

    def same_as_full(tag):
        full = os.path.join(scratch, "full-" + tag)
        assert run(spark, bronze, inc, incremental=True) == run(spark, bronze, full)
        assert tables(spark, inc) == tables(spark, full), tag

    pull([("01/06/2026", "17.0"), ("02/06/2026", "17.1")])
    pull([("02/06/2026", "17.1")])
    # a backlog of pulls, drained one file per micro-batch
    assert run(spark, bronze, inc, incremental=True, max_files_per_batch=1)["silver"] == 2
    same_as_full("1")
    pull([("02/06/2026", "99.0"), ("03/06/2026", "17.3")], fallback=True)  # synthetic never beats real
    land_fallback_pulls(spark, bronze, dt.date(2026, 6, 5), lookback_days=6)
    same_as_full("2")
    same_as_full("3")  # nothing new
    saved = read_small(spark, os.path.join(inc, POINTER))
    pull([("03/06/2026", "17.25")])  # a real figure for a day that was synthetic
    run(spark, bronze, inc, incremental=True)
    # Lose the last pointer: the next run must redo the merge and agree.
    write_small(spark, os.path.join(inc, POINTER), saved)
    pull([("01/06/2026", "17.05")])  # a revision of a real figure
    same_as_full("4")
    got = {str(r["obs_date"]): (r["value"], r["is_fallback"]) for r in published(spark, inc).silver()
           .filter("indicator_id = 'SF43718'").collect()}
    assert got["2026-06-01"] == (17.05, False) and got["2026-06-02"] == (17.1, False)
    assert got["2026-06-03"] == (17.25, False)


def test_refresh_total_order(spark, scratch):
    """Same tables; part files follow one another in key order."""
    import glob

    import pyarrow.parquet as pq
    from indtables.plans.extract import land_fallback_pulls

    bronze = os.path.join(scratch, "bronze")
    land_fallback_pulls(spark, bronze, dt.date(2026, 8, 28))
    land_fixtures(spark, bronze)
    a, b = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    assert run(spark, bronze, a) == run(spark, bronze, b, total_order=True)
    assert tables(spark, a) == tables(spark, b)
    now, rows = published(spark, b), []
    for f in sorted(glob.glob(os.path.join(now.release.path("indicators_long"), "part-*.parquet"))):
        tbl = pq.read_table(f, columns=["source", "indicator_id", "obs_date"])
        rows += list(zip(*(tbl.column(c).to_pylist() for c in ("source", "indicator_id", "obs_date"))))
    assert rows == sorted(rows) and len(rows) == now.long().count()


def test_incremental_intake_fails_loudly_on_malformed_json(spark, scratch):
    bronze, inc = os.path.join(scratch, "bronze"), os.path.join(scratch, "inc")
    os.makedirs(os.path.join(bronze, "banxico"))
    with open(os.path.join(bronze, "banxico", "broken.json"), "w") as f:
        f.write('{"bmx": {"series": [ this is not json\n')
    with pytest.raises(Exception):
        run(spark, bronze, inc, incremental=True)
