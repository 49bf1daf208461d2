"""Physical-plan shape: what a cluster would run."""

import datetime as dt
import re

import pytest

from clickmarts.config import MartConfig
from clickmarts.plans.events_mart import events_mart
from clickmarts.plans.sessions_mart import sessions_mart
from clickmarts.sources.fixtures import raw_events
from clickmarts.sources.shards import Property, read_export
from clickmarts.sources.sinks import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def export(spark):
    path = scratch_path(spark, "t-plan-export")
    raw_events(spark, SF).drop("business_unit").write.partitionBy("table_suffix").parquet(path)
    return [Property("site", path)]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_events_and_sessions_share_one_exchange(spark, export):
    cfg = MartConfig(window_layout="user")
    ev = events_mart(read_export(spark, export, cfg), cfg)
    plan = _plan(sessions_mart(ev, cfg))
    hashed = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(hashed) == 1 and hashed[0].startswith("user_pseudo_id"), hashed
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_events_mart_sorts_twice(spark, export):
    """Rank and back-fill share the user's time order, navigation and sequence the session's."""
    cfg = MartConfig(window_layout="user")
    plan = _plan(events_mart(read_export(spark, export, cfg), cfg))
    assert len(re.findall(r"(?<!\w)Sort \[", plan)) == 2, plan[:3000]


def test_users_rollup_adds_no_exchange(spark, export):
    from clickmarts.operators.users import users_rollup
    cfg = MartConfig(window_layout="user")
    ev = events_mart(read_export(spark, export, cfg), cfg)
    plan = _plan(users_rollup(sessions_mart(ev, cfg)))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_bounds_prune_partitions_and_columns(spark, export):
    cfg = MartConfig(window_layout="user", dag_max_days=2)
    raw = read_export(spark, export, cfg, preview=True, today=dt.date(2024, 1, 20))
    plan = _plan(events_mart(raw, cfg))
    assert re.search(r"PartitionFilters: \[[^\]]*table_suffix", plan)
    scanned = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)[0]
    names = {c.split("#")[0] for c in scanned.split(",")}
    assert {"event_params", "device", "items"} <= names
    assert not names & {"user_first_touch_timestamp", "user_ltv", "event_dimensions", "traffic_source"}


def test_no_python_udf_in_marts(spark, export):
    cfg = MartConfig(window_layout="user")
    ev = events_mart(read_export(spark, export, cfg), cfg)
    plan = _plan(sessions_mart(ev, cfg))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_day_filter_on_exploding_views_prunes_partitions(spark, export):
    from pyspark.sql import functions as F

    from clickmarts.operators.event_params import event_params_mart
    from clickmarts.operators.products import products_mart
    from clickmarts.sources.sinks import read_partitions, write_partitions
    cfg = MartConfig(window_layout="user")
    table = scratch_path(spark, "t-plan-events")
    write_partitions(events_mart(read_export(spark, export, cfg), cfg), table)
    events = read_partitions(spark, table)
    for view in (event_params_mart(events), products_mart(events)):
        plan = _plan(view.where(F.col("date_tz") >= F.lit(dt.date(2024, 1, 25))))
        assert re.search(r"PartitionFilters: \[[^\]]*date_tz", plan), plan[:2000]
