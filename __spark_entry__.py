"""

Every query reads the driver's tables (``orders``, ``lineitem``, ...) whole,
maps them onto the observation fact and runs the library on them. The
oracle strings are independent DuckDB SQL over the same tables.

Float results are made engine-independent where summation order would
otherwise leak in: means and sums of money use an exact fixed-point sum
(integer cents: two decimals in the data), sums of percentages and means
a fixed point of 8 decimals. Both engines then compute bit-identical
doubles; nothing is rounded after the fact.
"""

from __future__ import annotations

from collections.abc import Callable

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from indtables.operators import reports as R
from indtables.operators.asof import asof_lookup
from indtables.operators.buckets import gold_long_bucketed
from indtables.operators.conform import (
    accepted,
    label_for,
    label_join,
    parse_feed_a,
    parse_feed_b,
    rejected,
    union_feeds,
)
from indtables.operators.long import gold_long
from indtables.operators.silver import dedupe_observations
from indtables.operators.wide import (
    RECENT_WINDOW_DAYS,
    calendar,
    bounds,
    calendar_join,
    date_bounds,
    dense_daily,
    distinct_labels,
    gold_wide,
    pivot_by_day,
    tall_rows,
    trim_recent,
    wide_labels,
)
from indtables.plans.query import GoldCatalog
from indtables.plans.refresh import Tables, published
from indtables.plans.refresh import run as refresh_run
from indtables.schemas import FEED_A_SCHEMA, LONG_SCHEMA, SILVER_COLUMNS, with_field
from indtables.session import ensure_checkpoint_dir
from indtables.sinks.writers import (
    read_in_buckets,
    write_bronze,
    write_csv,
    write_csv_file,
    write_in_buckets,
    write_parquet,
)
from indtables.sources.bronze import read_bronze
from indtables.sources.gold import read_csv_typed, read_gold, read_wide_csv
from indtables.sources.shaped import (
    as_json_text,
    from_json_text,
    lineitem_feed_b_docs,
    orders_feed_a_docs,
    orders_feed_b_docs,
)
from indtables.sources.synthetic import (
    PULL_LOOKBACK_DAYS,
    choose_fallback,
    feed_a_fallback_docs,
    feed_b_fallback_docs,
    pull_start,
)
from indtables.sources.tables import (
    lineitem_observations,
    lineitem_tie_break,
    observations,
    orders_observations,
    orders_tie_break,
    read_table,
)
from indtables.streaming.bronze_stream import conform_new_pulls, landed_rows

# The training-data operators are optional: where their subpackage cannot be
# imported, the other queries stay as they are.
try:
    import indtables.llm.queries as _llm

    import corpus_pipeline as _pipeline
except ImportError:
    _llm = _pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"
MONEY_SCALE = 2
PCT_SCALE = 8
# Labels for the orders priorities in the lookup checks; others keep the id.
ORDER_LABELS = {"1-URGENT": "urgent", "2-HIGH": "high"}
LONG_SUFFIX = "WHERE indicator_label = '1-URGENT' AND obs_date >= DATE '1998-01-01' ORDER BY obs_date"
WIDE_SUFFIX = "WHERE `2-HIGH` > 250000 ORDER BY calendar_date"
BOUND_SUFFIX = "WHERE indicator_label = :label AND value > :low"
BOUND_VALUES = {"label": "2-HIGH", "low": 150000.0}
KPI_COLUMNS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
KPI_DATE = "2001-08-01"

# The five TPC-H order priorities, the series of the orders fact.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


# ---------------------------------------------------------------- builders

def _orders(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "orders")


def _orders_silver(spark: SparkSession, root: str) -> DataFrame:
    return dedupe_observations(orders_observations(_orders(spark, root)), orders_tie_break())


def _lineitem_silver(spark: SparkSession, root: str, value: str = "l_extendedprice") -> DataFrame:
    obs = lineitem_observations(read_table(spark, root, "lineitem"), value)
    return dedupe_observations(obs, lineitem_tie_break())


def _orders_long(spark: SparkSession, root: str) -> DataFrame:
    return gold_long(_orders_silver(spark, root), mean_scale=MONEY_SCALE)


def _orders_wide(spark: SparkSession, root: str) -> DataFrame:
    return gold_wide(_written_silver(spark, root))


_written: dict[tuple, object] = {}


def _once(spark: SparkSession, root: str, what: str, build):
    """``build()`` once per application and input: what it wrote is kept."""
    key = (spark.sparkContext.applicationId, root, what)
    if key not in _written:
        _written[key] = build()
    return _written[key]


def _written_long(spark: SparkSession, root: str) -> DataFrame:
    """The long table as a user has it: written, so that a report's filter
    reaches the scan."""
    order = ["source", "indicator_id", "obs_date"]
    path = _once(spark, root, "long",
                 lambda: write_parquet(_orders_long(spark, root), _scratch(spark, "long"), order))
    return read_gold(spark, path)


def _written_silver(spark: SparkSession, root: str) -> DataFrame:
    path = _once(spark, root, "silver", lambda: write_parquet(_orders_silver(spark, root), _scratch(spark, "silver")))
    return read_gold(spark, path)


def _scratch(spark: SparkSession, what: str) -> str:
    """A fresh folder under the session's shared checkpoint dir."""
    return f"{ensure_checkpoint_dir(spark)}/harness/{what}-{uuid.uuid4().hex}"


def q_silver_dedup(spark, root):
    return _orders_silver(spark, root)


def q_gold_long(spark, root):
    return _orders_long(spark, root)


def q_gold_long_lineitem(spark, root):
    return gold_long(_lineitem_silver(spark, root), mean_scale=MONEY_SCALE)


def q_change_pct(spark, root):
    return _orders_long(spark, root).select("source", "indicator_id", "obs_date", "value", "change_pct")


def q_change_pct_guard(spark, root):
    """Discount series: many zero bases, so the guard is exercised."""
    long_ = gold_long(_lineitem_silver(spark, root, "l_discount"))
    return long_.select("source", "indicator_id", "obs_date", "value", "change_pct")


def q_rolling_avg_30d(spark, root):
    return _orders_long(spark, root).select("source", "indicator_id", "obs_date", "value", "rolling_avg_30d")


def q_gold_wide(spark, root):
    return _orders_wide(spark, root)


def q_wide_ffill(spark, root):
    return gold_wide(_written_silver(spark, root), recent_window_days=None)


def _written_lineitem(spark: SparkSession, root: str) -> DataFrame:
    path = _once(spark, root, "lineitem", lambda: write_parquet(_lineitem_silver(spark, root), _scratch(spark, "li")))
    return read_gold(spark, path)


def q_wide_dense_lineitem(spark, root):
    """The tall dense table: any number of series, no label list."""
    return dense_daily(_written_lineitem(spark, root))


def q_gold_wide_lineitem(spark, root):
    """The wide table of every supplier, one column each, turned back into (day,
    label, value) rows: DuckDB's PIVOT of a column list it has to look up cannot
    stand in a view, the rows can be compared."""
    return tall_rows(gold_wide(_written_lineitem(spark, root)))


def q_rolling_avg_plain(spark, root):
    """The default mean (plain ``avg``) over whole values, where it is exact."""
    long_ = gold_long(_lineitem_silver(spark, root, "l_quantity"))
    return long_.select("source", "indicator_id", "obs_date", "value", "rolling_avg_30d")


def q_report_sum_plain(spark, root):
    """A report's default SUM over whole values, every series in turn a label."""
    long_ = gold_long(_lineitem_silver(spark, root, "l_quantity"))
    all_one = long_.withColumn("indicator_label", F.lit("quantity"))
    return R.report_series_shipped(all_one, "quantity", "lineitem")


def q_distinct_labels(spark, root):
    return distinct_labels(_orders_silver(spark, root))


def q_date_bounds(spark, root):
    return date_bounds(_orders_silver(spark, root))


def _inputs(spark, root):
    silver = _written_silver(spark, root)
    return silver, bounds(silver)


def q_calendar(spark, root):
    _, inp = _inputs(spark, root)
    return calendar(spark, inp.min_date, inp.max_date)


def q_wide_pivot(spark, root):
    silver = _written_silver(spark, root)
    return pivot_by_day(silver, wide_labels(silver))


def q_calendar_join(spark, root):
    silver, inp = _inputs(spark, root)
    return calendar_join(calendar(spark, inp.min_date, inp.max_date), pivot_by_day(silver, wide_labels(silver)))


def q_wide_trim(spark, root):
    silver, inp = _inputs(spark, root)
    joined = calendar_join(calendar(spark, inp.min_date, inp.max_date), pivot_by_day(silver, wide_labels(silver)))
    return trim_recent(joined, inp.max_date, RECENT_WINDOW_DAYS)


def q_label_lookup(spark, root):
    obs = orders_observations(_orders(spark, root))
    label = label_for(F.col("indicator_id"), ORDER_LABELS).alias("indicator_label")
    return obs.select("o_orderkey", "indicator_id", label)


def q_label_join(spark, root):
    """Every customer, labelled by the first priority of its orders; customers
    without orders keep their id."""
    cust = read_table(spark, root, "customer")
    rows = cust.select("c_custkey", F.col("c_custkey").cast("string").alias("indicator_id"))
    labels = _orders(spark, root).select(F.col("o_custkey").cast("string").alias("indicator_id"),
                                         F.col("o_orderpriority").alias("label"))
    return label_join(rows, labels)


def _feed_a_candidates(spark, root):
    docs = from_json_text(as_json_text(orders_feed_a_docs(_orders(spark, root))), "a")
    return parse_feed_a(docs, labels=ORDER_LABELS, carry=["pull_id"])


def _feed_b_candidates(spark, root):
    docs = from_json_text(as_json_text(orders_feed_b_docs(_orders(spark, root))), "b")
    return parse_feed_b(docs, carry=["pull_id"])


def q_parse_feed_a(spark, root):
    return accepted(_feed_a_candidates(spark, root), carry=["pull_id"])


def q_parse_feed_b(spark, root):
    return accepted(_feed_b_candidates(spark, root), carry=["pull_id"])


def q_parse_defaults(spark, root):
    """P5: what absent fields become (flag, ids, labels), over both feeds."""
    cols = ["pull_id", "source", "indicator_id", "indicator_label", "is_fallback"]
    a = accepted(_feed_a_candidates(spark, root), carry=["pull_id"]).select(*cols)
    b = accepted(_feed_b_candidates(spark, root), carry=["pull_id"]).select(*cols)
    return union_feeds(a, b)


def q_value_cast(spark, root):
    """Every non-missing feed B value text, its number and its verdict."""
    return _feed_b_candidates(spark, root).select("pull_id", "raw_value", "value", "reject_reason")


def q_silver(spark, root):
    """L1: both feeds' documents (from orders) -> conformed -> deduped silver;
    the newest pull (highest pull id) wins among equally real rows."""
    a = accepted(_feed_a_candidates(spark, root), carry=["pull_id"])
    b = accepted(_feed_b_candidates(spark, root), carry=["pull_id"])
    return dedupe_observations(union_feeds(a, b), [F.col("pull_id").desc()])


def q_conform_rejects(spark, root):
    return rejected(_feed_b_candidates(spark, root), carry=["pull_id"])


def q_conform_rejects_a(spark, root):
    return rejected(_feed_a_candidates(spark, root), carry=["pull_id"])


def q_union_feeds(spark, root):
    a = accepted(_feed_a_candidates(spark, root))
    li = read_table(spark, root, "lineitem")
    b = accepted(parse_feed_b(from_json_text(as_json_text(lineitem_feed_b_docs(li)), "b")))
    return union_feeds(a, b)


def q_bronze_scan(spark, root):
    bronze = _scratch(spark, "bronze")
    write_bronze(orders_feed_a_docs(_orders(spark, root)), bronze, "banxico")
    schema = with_field(FEED_A_SCHEMA, "pull_id", LongType())
    docs = read_bronze(spark, bronze, "banxico", schema)
    return accepted(parse_feed_a(docs, labels=ORDER_LABELS, carry=["pull_id"]), carry=["pull_id"])


def q_stream_intake(spark, root):
    bronze = _scratch(spark, "bronze")
    write_bronze(orders_feed_a_docs(_orders(spark, root)), bronze, "banxico")
    landing = _scratch(spark, "landing")
    conform_new_pulls(spark, bronze, landing, f"{landing}-checkpoint", feeds=["a"], labels=ORDER_LABELS)
    return landed_rows(spark, landing).select(*SILVER_COLUMNS)


def _land_orders(spark, root, bronze, extra=None, prefix="0"):
    """Orders as feed A pulls with whole values (a plain mean is then exact);
    ``extra`` is added to the value."""
    price = F.floor("o_totalprice")
    value = (price if extra is None else price + extra).cast("string")
    write_bronze(orders_feed_a_docs(_orders(spark, root), value, prefix).drop("pull_id"), bronze, "banxico")


def _land_lineitem(spark, root, bronze):
    value = F.col("l_quantity").cast("long").cast("string")
    write_bronze(lineitem_feed_b_docs(read_table(spark, root, "lineitem"), value).drop("pull_id"), bronze, "inegi")


# Whole units that the second, overlapping pull adds to open orders.
REVISED = 7


def _full_refresh(spark, root) -> Tables:
    def build():
        bronze, out = _scratch(spark, "bronze"), _scratch(spark, "refresh")
        _land_orders(spark, root, bronze)
        _land_lineitem(spark, root, bronze)
        refresh_run(spark, bronze, out)
        return published(spark, out)

    return _once(spark, root, "refresh", build)


def _incremental_refresh(spark, root) -> Tables:
    """The orders land and are refreshed; then the line items and a second pull
    of every order, open ones revised, land and are merged."""
    def build():
        bronze, out = _scratch(spark, "bronze"), _scratch(spark, "refresh-inc")
        _land_orders(spark, root, bronze)
        refresh_run(spark, bronze, out, incremental=True)
        _land_lineitem(spark, root, bronze)
        _land_orders(spark, root, bronze, F.when(F.col("o_orderstatus") == "O", REVISED).otherwise(0), prefix="1")
        refresh_run(spark, bronze, out, incremental=True)
        return published(spark, out)

    return _once(spark, root, "refresh-inc", build)


# Where the first and the second of the three pulls end and begin.
FIRST_PULL_TO, SECOND_PULL_FROM = "1997-01-01", "1996-01-01"


def _three_pulls(spark, root) -> Tables:
    """Orders in three overlapping pulls, each refreshed incrementally: old ones, the
    newer ones from a year before that, and the open ones of all days, revised."""
    def build():
        bronze, out = _scratch(spark, "bronze"), _scratch(spark, "refresh-three")
        day = F.col("o_orderdate").cast("date")
        pulls = [(day < F.lit(FIRST_PULL_TO).cast("date"), 0), (day >= F.lit(SECOND_PULL_FROM).cast("date"), 0),
                 (F.col("o_orderstatus") == "O", REVISED)]
        for i, (some, extra) in enumerate(pulls):
            value = (F.floor("o_totalprice") + extra).cast("string")
            docs = orders_feed_a_docs(_orders(spark, root).filter(some), value, str(i))
            write_bronze(docs.drop("pull_id"), bronze, "banxico")
            refresh_run(spark, bronze, out, incremental=True)
        return published(spark, out)

    return _once(spark, root, "refresh-three", build)


def q_long_incremental(spark, root):
    return _three_pulls(spark, root).long()


def q_wide_incremental(spark, root):
    return _three_pulls(spark, root).wide()


def q_long_bucketed(spark, root):
    """Window partitions of a year of a supplier."""
    return gold_long_bucketed(_lineitem_silver(spark, root), bucket_days=365, mean_scale=MONEY_SCALE)


def q_long_stored_order(spark, root):
    """Long from silver that is stored in hash buckets of the series."""
    by = ["source", "indicator_id"]
    path = _once(spark, root, "buckets", lambda: write_in_buckets(
        _lineitem_silver(spark, root), _scratch(spark, "buckets"), by, [*by, "obs_date"], 16))
    return gold_long(read_in_buckets(spark, path), mean_scale=MONEY_SCALE)


def q_asof_lookup(spark, root):
    """The last order value of the line's priority known on its ship date, and how
    many days old it is then (null before the first)."""
    lines = read_table(spark, root, "lineitem").join(
        _orders(spark, root), F.col("l_orderkey") == F.col("o_orderkey")
    ).select("l_orderkey", "l_linenumber", F.col("o_orderpriority").alias("priority"),
             F.col("l_shipdate").cast("date").alias("ship_date"))
    found = asof_lookup(lines, _orders_silver(spark, root), ["priority"], "ship_date", series=["indicator_id"])
    age = F.datediff("ship_date", "asof_date").cast("double").alias("age_days")
    return found.select("l_orderkey", "l_linenumber", "priority", "ship_date", "asof_value", age)


def _refresh_counts(tables: Tables) -> DataFrame:
    def n(name, df):
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
    return union_feeds(n("silver", tables.silver()), n("rejects", tables.rejects()),
                       n("indicators_long", tables.long()), n("indicators_wide", tables.wide()))


def _refresh_rejects(tables: Tables) -> DataFrame:
    """The rejects with the pull they came from."""
    return tables.rejects().select("source", "indicator_id", "raw_date", "raw_value", "reason",
                                   F.col("_pull_stamp").alias("pull_stamp"))


def q_refresh_counts(spark, root):
    return _refresh_counts(_full_refresh(spark, root))


def q_refresh_silver(spark, root):
    return _full_refresh(spark, root).silver()


def q_refresh_long(spark, root):
    return _full_refresh(spark, root).long()


def q_refresh_wide(spark, root):
    return _full_refresh(spark, root).wide()


def q_refresh_rejects(spark, root):
    return _refresh_rejects(_full_refresh(spark, root))


def q_refresh_incremental_counts(spark, root):
    return _refresh_counts(_incremental_refresh(spark, root))


def q_refresh_incremental_silver(spark, root):
    return _incremental_refresh(spark, root).silver()


def q_refresh_incremental_long(spark, root):
    return _incremental_refresh(spark, root).long()


def q_refresh_incremental_wide(spark, root):
    return _incremental_refresh(spark, root).wide()


def q_refresh_incremental_rejects(spark, root):
    return _refresh_rejects(_incremental_refresh(spark, root))


def _pulls(spark, root, lookback):
    """One pull per customer, ending on the customer's last order day."""
    orders = _orders(spark, root)
    ends = orders.groupBy(F.col("o_custkey").alias("pull_id")).agg(F.max("o_orderdate").cast("date").alias("end_date"))
    return ends.withColumn("start_date", pull_start(F.col("end_date"), lookback))


def _synthetic_rows(pulls):
    docs = feed_a_fallback_docs(pulls, keep=["pull_id"])
    return accepted(parse_feed_a(docs, carry=["pull_id"]), carry=["pull_id"])


def q_fallback_daily(spark, root):
    rows = _synthetic_rows(_pulls(spark, root, PULL_LOOKBACK_DAYS))
    return rows.filter(F.col("indicator_id") == "SF43718")


def q_fallback_monthly(spark, root):
    rows = _synthetic_rows(_pulls(spark, root, PULL_LOOKBACK_DAYS))
    return rows.filter(F.col("indicator_id") == "SP1")


def q_fallback_registry(spark, root):
    cust = read_table(spark, root, "customer")
    docs = feed_b_fallback_docs(cust, id_col="c_custkey", label_col="c_name")
    return accepted(parse_feed_b(docs))


def _failed_customers(spark, root):
    return read_table(spark, root, "customer").filter(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("pull_id"))


def q_fallback_by_source(spark, root):
    """Each customer is a feed; feeds of customers in debt 'failed' and are
    replaced, whole, by their synthetic pull."""
    orders = _orders(spark, root)
    real = observations(orders, "orders", F.col("o_orderpriority"), F.col("o_orderdate"),
                        F.col("o_totalprice"), F.lit(False), keep=[F.col("o_custkey").alias("pull_id")])
    failed = _failed_customers(spark, root)
    return choose_fallback(real, _synthetic_rows(_pulls(spark, root, PULL_LOOKBACK_DAYS)), failed, "pull_id")


def q_fallback_by_indicator(spark, root):
    orders = _orders(spark, root)
    real = observations(orders, "inegi", F.col("o_custkey"), F.col("o_orderdate"), F.col("o_totalprice"),
                        F.lit(False))
    failed = _failed_customers(spark, root).select(F.col("pull_id").cast("string").alias("indicator_id"))
    cust = read_table(spark, root, "customer")
    synth = accepted(parse_feed_b(feed_b_fallback_docs(cust, id_col="c_custkey", label_col="c_name")))
    return choose_fallback(real, synth, failed, "indicator_id")


def _catalog(spark, root) -> GoldCatalog:
    wide = _once(spark, root, "wide", lambda: write_parquet(_orders_wide(spark, root), _scratch(spark, "wide")))
    return GoldCatalog(spark, _written_long(spark, root), wide)


def q_sql_suffix_long(spark, root):
    return _catalog(spark, root).query_long(LONG_SUFFIX)


def q_sql_suffix_wide(spark, root):
    return _catalog(spark, root).query_wide(WIDE_SUFFIX)


def q_sql_bound_values(spark, root):
    return _catalog(spark, root).query_long(BOUND_SUFFIX, BOUND_VALUES)


def q_row_counts(spark, root):
    return _catalog(spark, root).row_counts_frame()


def q_gold_scan_long(spark, root):
    path = write_parquet(_orders_long(spark, root), _scratch(spark, "gold-long"))
    return read_gold(spark, path)


def q_gold_scan_wide(spark, root):
    path = write_parquet(_orders_wide(spark, root), _scratch(spark, "gold-wide"))
    return read_gold(spark, path)


def q_csv_scan_typed(spark, root):
    path = write_csv(_orders_long(spark, root), _scratch(spark, "csv-long"))
    return read_csv_typed(spark, path, LONG_SCHEMA)


def q_csv_exact_file(spark, root):
    """The long table as one CSV file at a path of its own, read back typed."""
    path = write_csv_file(_orders_long(spark, root), f"{_scratch(spark, 'csv')}/indicators_long.csv",
                          ["source", "indicator_id", "obs_date"])
    return read_csv_typed(spark, path, LONG_SCHEMA)


def q_csv_scan_wide(spark, root):
    path = write_csv(_orders_wide(spark, root), _scratch(spark, "csv-wide"))
    return read_wide_csv(spark, path)


# Reports: the orders priorities stand in for the report's indicator labels.
def q_report_fx_spec(spark, root):
    return R.report_fx_spec(_written_long(spark, root), "1-URGENT")


def q_report_fx_shipped(spark, root):
    return R.report_fx_shipped(_written_long(spark, root), "1-URGENT", sum_scale=PCT_SCALE)


def q_report_inpc_spec(spark, root):
    return R.report_inpc_spec(_written_long(spark, root), "2-HIGH")


def q_report_inpc_shipped(spark, root):
    return R.report_inpc_shipped(_written_long(spark, root), "2-HIGH", sum_scale=PCT_SCALE)


def q_report_igae_spec(spark, root):
    return R.report_igae_spec(_written_long(spark, root), "3-MEDIUM", "4-NOT SPECIFIED")


def q_report_igae_shipped(spark, root):
    return R.report_igae_shipped(_written_long(spark, root), "3-MEDIUM", "4-NOT SPECIFIED", sum_scale=PCT_SCALE)


def q_report_headcount_spec(spark, root):
    return R.report_headcount_spec(_written_long(spark, root), "5-LOW", "orders")


def q_report_headcount_shipped(spark, root):
    return R.report_headcount_shipped(_written_long(spark, root), "5-LOW", "orders", sum_scale=PCT_SCALE)


def q_report_rate_spec(spark, root):
    return R.report_rate_spec(_written_long(spark, root), "4-NOT SPECIFIED", "orders")


def q_report_rate_shipped(spark, root):
    return R.report_rate_shipped(_written_long(spark, root), "4-NOT SPECIFIED", "orders", sum_scale=PCT_SCALE)


def q_kpi_latest(spark, root):
    return R.kpi_latest(_orders_wide(spark, root), KPI_COLUMNS)


def q_kpi_shipped(spark, root):
    return R.kpi_shipped(_orders_wide(spark, root), KPI_COLUMNS, KPI_DATE, sum_scale=MONEY_SCALE)


def q_fallback_callout(spark, root):
    return R.fallback_callout(_written_long(spark, root))


# ------------------------------------------------------------------ oracle

def _xsum(expr: str, scale: int, over: str = "") -> str:
    """DuckDB twin of ``exact_sum``."""
    f = 10**scale
    win = f" OVER {over}" if over else ""
    return f"(CAST(SUM(CAST(round(({expr}) * {f}) AS DECIMAL(38,0))){win} AS DOUBLE) / {f})"


def _obs_orders_sql() -> str:
    return """
    SELECT 'orders' AS source, o_orderpriority AS indicator_id, o_orderpriority AS indicator_label,
           CAST(o_orderdate AS DATE) AS obs_date, o_totalprice AS value,
           o_orderstatus = 'F' AS is_fallback, o_orderkey
    FROM orders"""


def _silver_sql(obs: str, tie: str) -> str:
    return f"""
    SELECT source, indicator_id, indicator_label, obs_date, value, is_fallback FROM (
      SELECT *, row_number() OVER (PARTITION BY source, indicator_id, obs_date
                                   ORDER BY is_fallback ASC, {tie}, value DESC) AS rn
      FROM ({obs}) o) t
    WHERE rn = 1"""


def _orders_silver_sql() -> str:
    return _silver_sql(_obs_orders_sql(), "o_orderkey DESC")


def _lineitem_silver_sql(value: str = "l_extendedprice") -> str:
    obs = f"""
    SELECT 'lineitem' AS source, CAST(l_suppkey AS VARCHAR) AS indicator_id,
           CAST(l_suppkey AS VARCHAR) AS indicator_label, CAST(l_shipdate AS DATE) AS obs_date,
           {value} AS value, l_returnflag = 'R' AS is_fallback,
           l_orderkey, l_linenumber, l_partkey
    FROM lineitem"""
    return _silver_sql(obs, "l_orderkey DESC, l_linenumber DESC, l_partkey DESC")


def _long_sql(silver: str) -> str:
    return f"""
    SELECT source, indicator_id, indicator_label, obs_date, value, is_fallback,
           CASE WHEN lag(value) OVER w IS NOT NULL AND lag(value) OVER w <> 0
                THEN (value - lag(value) OVER w) / lag(value) OVER w * 100 END AS change_pct,
           {_xsum("value", MONEY_SCALE, "r")} / COUNT(value) OVER r AS rolling_avg_30d
    FROM ({silver}) s
    WINDOW w AS (PARTITION BY source, indicator_id ORDER BY obs_date),
           r AS (PARTITION BY source, indicator_id ORDER BY obs_date
                 RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW)"""


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _wide_parts(silver: str, labels: list[str], names: dict[str, str] | None = None) -> str:
    n = names or {}
    piv = ", ".join(f"max(CASE WHEN indicator_label = '{l}' THEN value END) AS {_q(n.get(l, l))}" for l in labels)
    return f"""
    s AS ({silver}),
    b AS (SELECT min(obs_date) AS min_d, max(obs_date) AS max_d FROM s),
    cal AS (SELECT CAST(unnest(generate_series(min_d, max_d, INTERVAL 1 DAY)) AS DATE) AS calendar_date FROM b),
    piv AS (SELECT obs_date, {piv} FROM s GROUP BY obs_date),
    j AS (SELECT cal.calendar_date, piv.* EXCLUDE (obs_date)
          FROM cal LEFT JOIN piv ON cal.calendar_date = piv.obs_date)"""


def _trim(window_days: int | None) -> str:
    return "" if window_days is None else f"WHERE calendar_date >= (SELECT max_d - {window_days} FROM b)"


def _wide_sql(silver: str, labels: list[str], window_days: int | None, names: dict[str, str] | None = None) -> str:
    n = names or {}
    fill = ", ".join(
        f"last_value({_q(n.get(l, l))} IGNORE NULLS) OVER (ORDER BY calendar_date ROWS BETWEEN UNBOUNDED PRECEDING"
        f" AND CURRENT ROW) AS {_q(n.get(l, l))}"
        for l in labels
    )
    return f"""
    WITH {_wide_parts(silver, labels, names)},
    f AS (SELECT calendar_date, {fill} FROM j)
    SELECT * FROM f {_trim(window_days)}"""


def _money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,2)) AS DOUBLE)"


# Orders whose feed A document is malformed (see sources.shaped).
_A_BAD = """(o_orderstatus = 'O' AND (o_orderpriority = '4-NOT SPECIFIED'
              OR (o_orderpriority = '2-HIGH' AND month(o_orderdate) = 12)
              OR (o_orderpriority = '1-URGENT' AND month(o_orderdate) IN (11, 12))))"""


def _feed_a_rows(value: str, low_label: str = "''", labels: bool = True) -> str:
    named = "WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'" if labels else ""
    return f"""
    SELECT o_orderkey AS pull_id, 'banxico' AS source,
           CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS indicator_id,
           CASE o_orderpriority WHEN '5-LOW' THEN {low_label} {named}
                ELSE o_orderpriority END AS indicator_label,
           CAST(o_orderdate AS DATE) AS obs_date, {value} AS value,
           o_orderstatus = 'F' AS is_fallback
    FROM orders WHERE o_orderstatus <> 'P' AND NOT {_A_BAD}"""


def _feed_a_rejects(text: str, key: str = "o_orderkey AS pull_id") -> str:
    """``text``: SQL for a good value's text."""
    return f"""
    SELECT 'banxico' AS source, o_orderpriority AS indicator_id,
           CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%d')
                ELSE strftime(o_orderdate, '%d/%m/%Y') END AS raw_date,
           CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN {text}
                WHEN o_orderpriority = '2-HIGH' THEN 'NaN'
                WHEN month(o_orderdate) = 12 THEN {text} || 'd' ELSE '1e400' END AS raw_value,
           CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'bad_date'
                WHEN o_orderpriority = '2-HIGH' THEN 'not_a_number'
                WHEN month(o_orderdate) = 12 THEN 'bad_value' ELSE 'not_finite' END AS reason, {key}
    FROM orders WHERE {_A_BAD}"""


_PRICE_TEXT = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
_FEED_A_ROWS = _feed_a_rows(_money("o_totalprice"))

_FEED_B_ROWS = f"""
    SELECT o_orderkey AS pull_id, 'inegi' AS source, o_orderpriority AS indicator_id,
           CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'unknown' ELSE lower(o_orderpriority) END AS indicator_label,
           CASE WHEN o_orderpriority IN ('5-LOW', '2-HIGH') THEN make_date(year(o_orderdate), 1, 1)
                ELSE make_date(year(o_orderdate), month(o_orderdate), 1) END AS obs_date,
           {_money("o_totalprice")} AS value, o_orderstatus = 'F' AS is_fallback
    FROM orders
    WHERE o_orderstatus <> 'P' AND NOT (o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH'))"""

_REJECTS = """
    SELECT 'inegi' AS source, o_orderpriority AS indicator_id,
           CASE WHEN o_orderpriority = '1-URGENT'
                THEN strftime(o_orderdate, '%Y') || '/Q' || CAST(quarter(o_orderdate) AS VARCHAR)
                ELSE strftime(o_orderdate, '%Y') || '/' END AS raw_date,
           CASE WHEN o_orderpriority = '2-HIGH'
                THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || ' MXN'
                ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS raw_value,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'bad_period' ELSE 'bad_value' END AS reason,
           o_orderkey AS pull_id
    FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH')"""

_SILVER_COLS = "source, indicator_id, indicator_label, obs_date, value, is_fallback"


def _pull_ends(where: str = "") -> str:
    return (
        f"SELECT o_custkey AS pull_id, CAST(max(o_orderdate) AS DATE) AS end_d "
        f"FROM orders {where} GROUP BY o_custkey"
    )


def _synthetic_days(pulls: str, lookback: int, sid: str, label: str, value: str, month_start: bool) -> str:
    cond = "WHERE day(d) = 1" if month_start else ""
    return f"""
    SELECT pull_id, 'banxico' AS source, '{sid}' AS indicator_id, '{label}' AS indicator_label,
           CAST(d AS DATE) AS obs_date, CAST({value} AS DOUBLE) AS value, true AS is_fallback
    FROM (SELECT pull_id, unnest(generate_series(CAST(end_d - {lookback} AS TIMESTAMP), CAST(end_d AS TIMESTAMP),
                                                 INTERVAL 1 DAY)) AS d
          FROM ({pulls}) p) g {cond}"""


def _registry_rows(where: str = "") -> str:
    return f"""
    SELECT 'inegi' AS source, CAST(c_custkey AS VARCHAR) AS indicator_id, c_name AS indicator_label,
           make_date(2026, CAST(m AS BIGINT), 1) AS obs_date, CAST(100.0 AS DOUBLE) AS value, true AS is_fallback
    FROM customer, (SELECT unnest(range(1, 7)) AS m) months {where}"""


def _stamp_sql(prefix: str) -> str:
    return f"'{prefix}' || lpad(CAST(o_orderkey AS VARCHAR), 19, '0')"


def _refresh_tables(revised: bool) -> dict[str, str]:
    """Silver, long, wide, rejects and counts of the refresh queries. With
    ``revised`` a second pull of all orders has come, open ones changed."""
    whole = f"floor(o_totalprice){f' + CASE WHEN o_orderstatus = {chr(39)}O{chr(39)} THEN {REVISED} ELSE 0 END' if revised else ''}"
    # the second pull holds every order again, so its rows win over the first's
    a = _feed_a_rows(f"CAST({whole} AS DOUBLE)", labels=False)
    b = """
    SELECT l_orderkey * 8 + l_linenumber AS pull_id, 'inegi' AS source, CAST(l_suppkey AS VARCHAR) AS indicator_id,
           'supplier' AS indicator_label, make_date(year(l_shipdate), month(l_shipdate), 1) AS obs_date,
           CAST(l_quantity AS DOUBLE) AS value, l_returnflag = 'R' AS is_fallback
    FROM lineitem"""
    silver = _silver_sql(f"SELECT * FROM ({a}) a UNION ALL SELECT * FROM ({b}) b", "pull_id DESC")
    long_ = _long_sql(silver).replace(_xsum("value", MONEY_SCALE, "r") + " / COUNT(value) OVER r", "avg(value) OVER r")
    # a label fed by several series takes the lowest one of the day
    one = f"""
    SELECT indicator_label, obs_date, value FROM (
      SELECT *, row_number() OVER (PARTITION BY indicator_label, obs_date ORDER BY source, indicator_id) AS k
      FROM ({silver}) z) y WHERE k = 1"""
    labels = ["", "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "supplier"]
    wide = _wide_sql(one, labels, RECENT_WINDOW_DAYS, {"": "unlabelled"})
    texts = [("0", "floor(o_totalprice)")] + ([("1", whole)] if revised else [])
    rejects = " UNION ALL ".join(
        f"SELECT * FROM ({_feed_a_rejects(f'CAST(CAST({v} AS BIGINT) AS VARCHAR)', _stamp_sql(p) + ' AS pull_stamp')}) r{p}"
        for p, v in texts
    )
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM ({sql}) {name}"
        for name, sql in (("silver", silver), ("rejects", rejects), ("indicators_long", long_), ("indicators_wide", wide))
    )
    return {"silver": silver, "long": long_, "wide": wide, "rejects": rejects, "counts": counts}


def _three_pulls_sql() -> dict[str, str]:
    """Long and wide after three pulls: an order's last pull counts, and the open
    ones, all in the last, are revised."""
    value = f"floor(o_totalprice) + CASE WHEN o_orderstatus = 'O' THEN {REVISED} ELSE 0 END"
    pull = f"CASE WHEN o_orderstatus = 'O' THEN 2 WHEN o_orderdate >= DATE '{SECOND_PULL_FROM}' THEN 1 ELSE 0 END"
    rows = f"""
    SELECT a.*, {pull} AS pull FROM ({_feed_a_rows(f'CAST({value} AS DOUBLE)', labels=False)}) a
    JOIN orders ON o_orderkey = pull_id"""
    silver = _silver_sql(rows, "pull DESC, pull_id DESC")
    long_ = _long_sql(silver).replace(_xsum("value", MONEY_SCALE, "r") + " / COUNT(value) OVER r", "avg(value) OVER r")
    labels = ["", "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
    return {"long_incremental": long_, "wide_incremental": _wide_sql(silver, labels, RECENT_WINDOW_DAYS, {"": "unlabelled"})}


def _dense_sql(silver: str, gaps: bool = False) -> str:
    """Every day and label, filled forward; leading gaps only if asked for."""
    return f"""
    WITH s AS MATERIALIZED ({silver}),
    b AS (SELECT min(obs_date) AS min_d, max(obs_date) AS max_d FROM s),
    cal AS (SELECT CAST(unnest(generate_series(greatest(max_d - {RECENT_WINDOW_DAYS}, min_d), max_d,
                                               INTERVAL 1 DAY)) AS DATE) AS calendar_date FROM b),
    x AS (SELECT calendar_date, indicator_label FROM cal, (SELECT DISTINCT indicator_label FROM s) l)
    SELECT x.calendar_date, x.indicator_label, s.value
    FROM x ASOF {"LEFT" if gaps else ""} JOIN s ON x.indicator_label = s.indicator_label AND x.calendar_date >= s.obs_date"""


def _oracles() -> dict[str, str]:
    silver = _orders_silver_sql()
    long_ = _long_sql(silver)
    wide = _wide_sql(silver, PRIORITIES, RECENT_WINDOW_DAYS)
    key = "source, indicator_id, obs_date"
    lab = lambda l, extra="": f"FROM ({long_}) l WHERE indicator_label = '{l}' {extra}"
    x8 = lambda e: _xsum(e, PCT_SCALE)
    fx_a = f"SELECT {_SILVER_COLS} FROM ({_FEED_A_ROWS}) a"
    li_b = f"""
    SELECT 'inegi' AS source, CAST(l_suppkey AS VARCHAR) AS indicator_id, 'supplier' AS indicator_label,
           make_date(year(l_shipdate), month(l_shipdate), 1) AS obs_date, {_money("l_extendedprice")} AS value,
           l_returnflag = 'R' AS is_fallback
    FROM lineitem"""
    failed = "SELECT c_custkey FROM customer WHERE c_acctbal < 0"
    orders_only = "AND source = 'orders'"
    out = {
        "silver_dedup": silver,
        "gold_long": long_,
        "gold_long_lineitem": _long_sql(_lineitem_silver_sql()),
        "change_pct": f"SELECT {key}, value, change_pct FROM ({long_}) l",
        "change_pct_guard": (
            f"SELECT {key}, value, change_pct FROM ({_long_sql(_lineitem_silver_sql('l_discount'))}) l"
        ),
        "rolling_avg_30d": f"SELECT {key}, value, rolling_avg_30d FROM ({long_}) l",
        "gold_wide": wide,
        "wide_ffill": _wide_sql(silver, PRIORITIES, None),
        "distinct_labels": f"SELECT DISTINCT indicator_label FROM ({silver}) s",
        "date_bounds": f"SELECT min(obs_date) AS min_date, max(obs_date) AS max_date FROM ({silver}) s",
        "calendar": f"WITH {_wide_parts(silver, PRIORITIES)} SELECT calendar_date FROM cal",
        "wide_pivot": f"WITH {_wide_parts(silver, PRIORITIES)} SELECT * FROM piv",
        "calendar_join": f"WITH {_wide_parts(silver, PRIORITIES)} SELECT * FROM j",
        "wide_trim": f"WITH {_wide_parts(silver, PRIORITIES)} SELECT * FROM j {_trim(RECENT_WINDOW_DAYS)}",
        "label_lookup": """
            SELECT o_orderkey, o_orderpriority AS indicator_id,
                   CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
                        ELSE o_orderpriority END AS indicator_label
            FROM orders""",
        "label_join": """
            SELECT c.c_custkey, CAST(c.c_custkey AS VARCHAR) AS indicator_id,
                   COALESCE(o.priority, CAST(c.c_custkey AS VARCHAR)) AS indicator_label
            FROM customer c LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS priority FROM orders GROUP BY o_custkey) o
              ON o.o_custkey = c.c_custkey""",
        "parse_feed_a": _FEED_A_ROWS,
        "parse_feed_b": _FEED_B_ROWS,
        "conform_rejects": _REJECTS,
        "conform_rejects_a": _feed_a_rejects(_PRICE_TEXT),
        "wide_dense_lineitem": _dense_sql(_lineitem_silver_sql()),
        "gold_wide_lineitem": _dense_sql(_lineitem_silver_sql(), gaps=True),
        "rolling_avg_plain": f"""
            SELECT {key}, value, avg(value) OVER (
                     PARTITION BY source, indicator_id ORDER BY obs_date
                     RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW) AS rolling_avg_30d
            FROM ({_lineitem_silver_sql('l_quantity')}) s""",
        "report_sum_plain": f"""
            SELECT CAST(year(obs_date) AS INTEGER) AS obs_year, sum(value) AS sum_value
            FROM ({_lineitem_silver_sql('l_quantity')}) s GROUP BY 1""",
        "parse_defaults": f"""
            SELECT pull_id, source, indicator_id, indicator_label, is_fallback FROM ({_FEED_A_ROWS}) a
            UNION ALL
            SELECT pull_id, source, indicator_id, indicator_label, is_fallback FROM ({_FEED_B_ROWS}) b""",
        "value_cast": f"""
            SELECT o_orderkey AS pull_id,
                   CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O'
                        THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || ' MXN'
                        ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS raw_value,
                   CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN NULL
                        ELSE {_money("o_totalprice")} END AS value,
                   CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'bad_period'
                        WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN 'bad_value' END AS reject_reason
            FROM orders WHERE o_orderstatus <> 'P'""",
        "silver": f"""
            SELECT {_SILVER_COLS} FROM (
              SELECT *, row_number() OVER (PARTITION BY source, indicator_id, obs_date
                                           ORDER BY is_fallback ASC, pull_id DESC, value DESC,
                                                    indicator_label ASC) AS rn
              FROM (SELECT * FROM ({_FEED_A_ROWS}) a UNION ALL SELECT * FROM ({_FEED_B_ROWS}) b) u) t
            WHERE rn = 1""",
        "union_feeds": f"{fx_a} UNION ALL {li_b}",
        "bronze_scan": _FEED_A_ROWS,
        "stream_intake": fx_a,
        "fallback_daily": _synthetic_days(_pull_ends(), PULL_LOOKBACK_DAYS, "SF43718", "fx_rate_usd_mxn", "17.5", False),
        "fallback_monthly": _synthetic_days(_pull_ends(), PULL_LOOKBACK_DAYS, "SP1", "inpc_general", "130.0", True),
        "fallback_registry": _registry_rows(),
        "fallback_by_source": f"""
            SELECT o_custkey AS pull_id, 'orders' AS source, o_orderpriority AS indicator_id,
                   o_orderpriority AS indicator_label, CAST(o_orderdate AS DATE) AS obs_date,
                   o_totalprice AS value, false AS is_fallback
            FROM orders WHERE o_custkey NOT IN ({failed})
            UNION ALL
            {_synthetic_days(_pull_ends(f"WHERE o_custkey IN ({failed})"), PULL_LOOKBACK_DAYS, "SF43718",
                             "fx_rate_usd_mxn", "17.5", False)}
            UNION ALL
            {_synthetic_days(_pull_ends(f"WHERE o_custkey IN ({failed})"), PULL_LOOKBACK_DAYS, "SP1",
                             "inpc_general", "130.0", True)}""",
        "fallback_by_indicator": f"""
            SELECT 'inegi' AS source, CAST(o_custkey AS VARCHAR) AS indicator_id,
                   CAST(o_custkey AS VARCHAR) AS indicator_label, CAST(o_orderdate AS DATE) AS obs_date,
                   o_totalprice AS value, false AS is_fallback
            FROM orders WHERE o_custkey NOT IN ({failed})
            UNION ALL {_registry_rows("WHERE c_acctbal < 0")}""",
        "sql_suffix_long": f"SELECT * FROM ({long_}) l {LONG_SUFFIX.replace('`', chr(34))}",
        "sql_suffix_wide": f"SELECT * FROM ({wide}) w {WIDE_SUFFIX.replace('`', chr(34))}",
        "sql_bound_values": f"SELECT * FROM ({long_}) l WHERE indicator_label = '2-HIGH' AND value > 150000.0",
        "csv_exact_file": long_,
        "long_bucketed": _long_sql(_lineitem_silver_sql()),
        "long_stored_order": _long_sql(_lineitem_silver_sql()),
        "asof_lookup": f"""
            SELECT p.*, s.value AS asof_value, CAST(p.ship_date - s.obs_date AS DOUBLE) AS age_days
            FROM (SELECT l_orderkey, l_linenumber, o_orderpriority AS priority, CAST(l_shipdate AS DATE) AS ship_date
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey) p
            ASOF LEFT JOIN ({silver}) s ON p.priority = s.indicator_id AND p.ship_date >= s.obs_date""",
        "row_counts": f"""
            SELECT 'indicators_long' AS table_name, count(*) AS row_count FROM ({long_}) l
            UNION ALL SELECT 'indicators_wide', count(*) FROM ({wide}) w""",
        "gold_scan_long": long_,
        "gold_scan_wide": wide,
        "csv_scan_typed": long_,
        "csv_scan_wide": wide,
        "report_fx_spec": f"SELECT {key}, value, rolling_avg_30d {lab('1-URGENT')}",
        "report_fx_shipped": f"""
            SELECT CAST(day(obs_date) AS INTEGER) AS day_of_month, {x8("value")} AS sum_value,
                   {x8("rolling_avg_30d")} AS sum_rolling_avg_30d
            {lab('1-URGENT')} GROUP BY 1""",
        "report_inpc_spec": f"SELECT {key}, change_pct {lab('2-HIGH')}",
        "report_inpc_shipped": f"""
            SELECT CAST(year(obs_date) AS INTEGER) AS obs_year, {x8("change_pct")} AS sum_change_pct
            {lab('2-HIGH')} GROUP BY 1""",
        "report_igae_spec": f"""
            SELECT {key},
                   CASE WHEN indicator_label = '3-MEDIUM' THEN value END AS igae_level,
                   CASE WHEN indicator_label = '4-NOT SPECIFIED' THEN value END AS igae_yoy_pct
            FROM ({long_}) l WHERE indicator_label IN ('3-MEDIUM', '4-NOT SPECIFIED')""",
        "report_igae_shipped": f"""
            SELECT CAST(year(obs_date) AS INTEGER) AS obs_year,
                   {x8("CASE WHEN indicator_label = '3-MEDIUM' THEN value END")} AS sum_igae_level,
                   {x8("CASE WHEN indicator_label = '4-NOT SPECIFIED' THEN value END")} AS sum_igae_yoy_pct
            FROM ({long_}) l WHERE indicator_label IN ('3-MEDIUM', '4-NOT SPECIFIED') GROUP BY 1""",
        "report_headcount_spec": f"SELECT {key}, value {lab('5-LOW', orders_only)}",
        "report_headcount_shipped": f"""
            SELECT CAST(year(obs_date) AS INTEGER) AS obs_year, {x8("value")} AS sum_value
            {lab('5-LOW', "AND source = 'orders'")} GROUP BY 1""",
        "report_rate_spec": f"SELECT {key}, value {lab('4-NOT SPECIFIED', orders_only)}",
        "report_rate_shipped": f"""
            SELECT CAST(year(obs_date) AS INTEGER) AS obs_year, {x8("value")} AS sum_value
            {lab('4-NOT SPECIFIED', "AND source = 'orders'")} GROUP BY 1""",
        "kpi_latest": f"""
            SELECT max(calendar_date) AS calendar_date,
                   {", ".join(f"arg_max({_q(l)}, calendar_date) AS {_q(l)}" for l in KPI_COLUMNS)}
            FROM ({wide}) w""",
        "kpi_shipped": f"""
            SELECT max(calendar_date) AS max_calendar_date,
                   {", ".join(f"{_xsum(_q(l), MONEY_SCALE)} AS {_q('sum_' + l)}" for l in KPI_COLUMNS)}
            FROM ({wide}) w
            HAVING max(calendar_date) BETWEEN DATE '{KPI_DATE}' AND DATE '{KPI_DATE}'""",
        "fallback_callout": f"SELECT indicator_label, bool_or(is_fallback) AS any_fallback FROM ({long_}) l GROUP BY 1",
    }
    for prefix, revised in (("refresh", False), ("refresh_incremental", True)):
        out |= {f"{prefix}_{name}": sql for name, sql in _refresh_tables(revised).items()}
    out |= _three_pulls_sql()
    return out


# ---------------------------------------------------------------- contract

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: gold long (change + 30-day mean) over the orders fact."""
    return gold_long(_orders_silver(spark, SMOKE_DIR))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    g = globals()
    found = {name: g[f"q_{name}"] for name in QUERY_NAMES}
    if _llm is not None:
        found |= _llm.queries() | {"pipeline": _pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    o = _oracles()
    found = {k: o[k] for k in QUERY_NAMES if k in o}
    if _llm is not None:
        found |= _llm.oracle_sql()
        if _pipeline.ORACLE_SQL is not None:
            found["pipeline"] = _pipeline.ORACLE_SQL
    return found


QUERY_NAMES = [
    "silver_dedup", "gold_long", "gold_long_lineitem", "change_pct", "change_pct_guard", "rolling_avg_30d",
    "gold_wide", "wide_ffill", "distinct_labels", "date_bounds", "calendar", "wide_pivot", "calendar_join",
    "wide_trim", "label_lookup", "label_join", "parse_feed_a", "parse_feed_b", "parse_defaults", "value_cast",
    "conform_rejects", "conform_rejects_a", "silver", "union_feeds", "bronze_scan", "stream_intake", "refresh_counts",
    "refresh_silver", "refresh_long", "refresh_wide", "refresh_rejects", "refresh_incremental_counts",
    "refresh_incremental_silver", "refresh_incremental_long", "refresh_incremental_wide",
    "refresh_incremental_rejects", "long_incremental", "wide_incremental", "long_bucketed", "long_stored_order",
    "asof_lookup", "sql_bound_values", "csv_exact_file", "wide_dense_lineitem", "gold_wide_lineitem", "rolling_avg_plain",
    "report_sum_plain", "fallback_daily", "fallback_monthly", "fallback_registry",
    "fallback_by_source", "fallback_by_indicator", "sql_suffix_long", "sql_suffix_wide", "row_counts",
    "gold_scan_long", "gold_scan_wide", "csv_scan_typed", "csv_scan_wide", "report_fx_spec",
    "report_fx_shipped", "report_inpc_spec", "report_inpc_shipped", "report_igae_spec", "report_igae_shipped",
    "report_headcount_spec", "report_headcount_shipped", "report_rate_spec", "report_rate_shipped",
    "kpi_latest", "kpi_shipped", "fallback_callout",
]
