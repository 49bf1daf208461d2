"""Steps whose shuffles and passes must not outgrow their input: what rows carry, and how often they are derived."""

import datetime as dt

from pyspark.sql import functions as F

from clickmarts.config import MartConfig
from clickmarts.operators import sessions as ss
from clickmarts.plans.events_mart import events_mart
from clickmarts.plans.sessions_mart import sessions_mart
from clickmarts.sources import files
from clickmarts.sources.fixtures import raw_orders, whole_shards
from clickmarts.sources.sinks import scratch_path
from tests.builders import raw_df, raw_row

SF = "/root/testdata/sf0.001"


def _nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))


def _logical(df, *kinds):
    plan = df._jdf.queryExecution().optimizedPlan()
    return [n for n in _nodes(plan) if n.nodeName() in kinds]


def _columns(node):
    return {node.output().apply(i).name() for i in range(node.output().size())}


def _rows():
    out = [dict(t=i * 700, user=f"u{i % 3}", gsid=(i // 6 if i % 4 else None), url=f"https://ex.com/p{i}",
                name="session_start" if i % 6 == 0 else "page_view") for i in range(60)]
    return out + out[:7]  # rows that come twice


def _same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))


def test_instant_ranks_add_no_exchange(spark, raw_schema):
    """Records are shuffled by user once and sorted twice under both id scopes."""
    df = events_mart(raw_df(spark, raw_schema, _rows()), MartConfig(window_layout="user", id_scope="instant"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("- Sort [") + plan.count("+- Sort [") >= 1 and plan.count("Sort [") == 2


def test_sliced_windows_run_without_records(spark, raw_schema):
    """no window holds the parameters, and the layouts agree."""
    raw = raw_df(spark, raw_schema, _rows())
    sliced = events_mart(raw, MartConfig(window_layout="sliced"))
    windows = _logical(sliced, "Window")
    assert windows and not any("event_params" in _columns(w) for w in windows)
    plain = events_mart(raw, MartConfig(window_layout="user"))
    split = events_mart(raw, MartConfig(skew_threshold_rows=25))
    assert sliced.columns == plain.columns == split.columns
    assert _same(plain, sliced) and _same(plain, split)


def test_sliced_sessions_are_counted_in_a_narrow_branch(spark, raw_schema):
    """no distinct count among the records; the layouts agree."""
    raw = raw_df(spark, raw_schema, _rows())
    want = MartConfig(window_layout="user")
    plain = sessions_mart(events_mart(raw, want), want)
    for cfg in (MartConfig(window_layout="sliced"), MartConfig(skew_threshold_rows=5)):
        assert _same(plain, sessions_mart(events_mart(raw, cfg), cfg))


def test_fused_rollup_counts_without_parameters_or_distinct(spark, raw_schema):
    """rows that come twice count once, by one sort that carries no parameters."""
    cfg = MartConfig(window_layout="user")
    events = ss.default_dimensions(events_mart(raw_df(spark, raw_schema, _rows()), cfg))
    fused = ss.session_rollup(events.union(events))
    assert "distinct" not in fused._jdf.queryExecution().optimizedPlan().toString()
    counting = [w for w in _logical(fused, "Window") if "_composite" in _columns(w)]
    assert counting and not any("event_params" in _columns(w) for w in counting)
    counts = lambda df: sorted(map(tuple, df.select("user_pseudo_id", "session_id", "event_count").collect()))
    assert counts(fused) == counts(ss.session_rollup(events)) == counts(ss.session_rollup(events, "narrow"))
    assert any(n for _, _, n in counts(fused)) and any(n == 0 for _, _, n in counts(fused))


def test_order_lines_are_grouped_without_empty_item_fields(spark):
    """the grouped line has its own six values; the items have all fields."""
    df = raw_orders(spark, SF)
    grouped = [n for n in _logical(df, "Aggregate") if "_lines" in _columns(n)]
    assert len(grouped) == 1 and "promotion_name" not in grouped[0].schema().json()
    item = df.where(F.size("items") > 0).select(F.explode("items").alias("i")).select("i.*").first().asDict()
    assert item["item_id"] and item["item_name"] and item["price"] == item["price_in_usd"] and item["coupon"] is None


def test_shards_land_as_one_file_each_in_order_of_days(spark):
    """as many files a trigger are as many days, however many tasks wrote them."""
    days = ["20240103", "intraday_20240104", "20240101", "20240102"]
    rows = spark.range(400, numPartitions=7).withColumn("table_suffix", F.element_at(F.array(*map(F.lit, days)), (F.col("id") % 4 + 1).cast("int")))
    path = scratch_path(spark, "t-shards")
    whole_shards(rows).write.partitionBy("table_suffix").parquet(path)
    files.order_by_day(spark, path)
    found = {n: [x for x in files.names(spark, f"{path}/{n}") if x.endswith(".parquet")] for n in files.names(spark, path) if "=" in n}
    assert sorted(found) == sorted(f"table_suffix={d}" for d in days) and all(len(x) == 1 for x in found.values())
    fs, _ = files._fs(spark, path)
    time = lambda n: fs.getFileStatus(files._fs(spark, f"{path}/{n}/{found[n][0]}")[1]).getModificationTime()
    assert sorted(found, key=time) == [f"table_suffix={d}" for d in sorted(days, key=lambda d: d[-8:])]
    assert spark.read.parquet(path).count() == 400


def test_sessions_of_late_days_are_computed_once(spark, raw_schema, monkeypatch):
    """they are written before they are compared with the old ones and committed."""
    from clickmarts.plans import marts as module
    written = []
    monkeypatch.setattr(module, "materialize", lambda df, name, real=module.materialize: written.append(name) or real(df, name))
    rows = [dict(t=d * 86400 + i * 600, user=f"u{i}", gsid=d, name="session_start") for d in range(4) for i in range(3)]
    landed = [r for r in rows if r["t"] < 2 * 86400]
    read = lambda: spark.createDataFrame([raw_row(raw_schema, **r) for r in landed], raw_schema)
    marts = module.Marts(spark, scratch_path(spark, "t-anew"), read, derived=("sessions",))
    marts.build()
    landed = rows
    marts.rewrite_days([dt.date(2024, 1, 3), dt.date(2024, 1, 4)])
    marts.follow()
    assert written == ["sessions-anew"]
    full = sessions_mart(marts.events.read(), marts.cfg)
    assert full.count() == 12 and _same(marts.sessions.read(), full)
