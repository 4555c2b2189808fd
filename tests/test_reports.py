"""Reports with their default labels, on the offline synthetic chain, where
every number can be worked out by hand."""

import datetime as dt
import os

import pytest

from indtables.operators import reports as R
from indtables.plans.extract import land_fallback_pulls
from indtables.plans.refresh import published, run

END = dt.date(2026, 8, 28)  # the published tiles' frozen date


@pytest.fixture(scope="module")
def gold(spark):
    import tempfile

    scratch = tempfile.mkdtemp(prefix="indtables-reports-")
    bronze, out = os.path.join(scratch, "bronze"), os.path.join(scratch, "out")
    land_fallback_pulls(spark, bronze, END)
    run(spark, bronze, out)
    now = published(spark, out)
    return now.long(), now.wide()


def test_fx_spec_and_shipped(gold):
    long_, _ = gold
    spec = R.report_fx_spec(long_).collect()
    assert len(spec) == 401 and {r["value"] for r in spec} == {17.5}
    assert {r["rolling_avg_30d"] for r in spec} == {17.5}
    shipped = {r["day_of_month"]: r for r in R.report_fx_shipped(long_, sum_scale=8).collect()}
    assert len(shipped) == 31
    # 401 days from 2025-07-24 to 2026-08-28: day 28 occurs 14 times; day 31
    # eight times (Jul, Aug, Oct, Dec 2025; Jan, Mar, May, Jul 2026)
    assert shipped[28]["sum_value"] == 14 * 17.5 and shipped[31]["sum_value"] == 8 * 17.5


def test_inpc_change_and_yearly_sums(gold):
    long_, _ = gold
    spec = R.report_inpc_spec(long_).collect()
    assert len(spec) == 13  # month starts 2025-08-01 .. 2026-08-01
    assert sorted(r["change_pct"] for r in spec if r["change_pct"] is not None) == [0.0] * 12
    years = {r["obs_year"]: r["sum_change_pct"] for r in R.report_inpc_shipped(long_).collect()}
    assert years == {2025: 0.0, 2026: 0.0}


def test_igae_and_employment(gold):
    long_, _ = gold
    igae = R.report_igae_spec(long_).collect()
    assert len(igae) == 12 and all((r["igae_level"] is None) != (r["igae_yoy_pct"] is None) for r in igae)
    assert R.report_igae_shipped(long_).collect()[0].asDict() == {
        "obs_year": 2026, "sum_igae_level": 600.0, "sum_igae_yoy_pct": 600.0}
    assert [r["sum_value"] for r in R.report_headcount_shipped(long_).collect()] == [600.0]
    assert [r["sum_value"] for r in R.report_rate_shipped(long_).collect()] == [600.0]
    assert len(R.report_rate_spec(long_).collect()) == 6
    assert R.report_headcount_spec(long_, source="banxico").count() == 0  # the source filter applies


def test_kpi_tiles(gold):
    _, wide = gold
    latest = R.kpi_latest(wide).collect()[0]
    assert latest["calendar_date"] == END
    assert (latest["fx_rate_usd_mxn"], latest["inpc_general"], latest["igae_ivf"], latest["desempleo_tasa"]) == (
        17.5, 130.0, 100.0, 100.0)
    shipped = R.kpi_shipped(wide, sum_scale=2).collect()
    assert len(shipped) == 1 and shipped[0]["sum_fx_rate_usd_mxn"] == 401 * 17.5
    assert R.kpi_shipped(wide, frozen_date="2026-08-27").count() == 0  # the frozen-date flaw


def test_fallback_callout(gold):
    long_, _ = gold
    flags = {r["indicator_label"]: r["any_fallback"] for r in R.fallback_callout(long_).collect()}
    assert len(flags) == 6 and all(flags.values())
