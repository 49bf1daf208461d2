"""Hand-made raw export rows for unit tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

BASE_MICROS = 1_704_067_200_000_000  # 2024-01-01 00:00:00 UTC


def micros(seconds: float) -> int:
    return BASE_MICROS + int(round(seconds * 1_000_000))


def kv(key, s=None, i=None, f=None, d=None):
    return {"key": key, "value": {"string_value": s, "int_value": i, "float_value": f, "double_value": d}}


def _empty(dtype: T.DataType):
    if isinstance(dtype, T.StructType):
        return {f.name: _empty(f.dataType) for f in dtype.fields}
    if isinstance(dtype, T.ArrayType):
        return []
    return None


def raw_row(schema: T.StructType, *, name="page_view", t=0.0, user="u1", url=None, params=None,
            gsid=None, referrer=None, ignore_referrer=None, host="ex.com", sts_source=None,
            sts_medium=None, cts=None, items=None, bundle=None, suffix=None, bu="site", **extra):
    row = {f.name: _empty(f.dataType) for f in schema.fields}
    ts = micros(t)
    ps = list(params or [])
    if url is not None:
        ps.append(kv("page_location", s=url))
    if gsid is not None:
        ps.append(kv("ga_session_id", i=gsid))
    if referrer is not None:
        ps.append(kv("referrer", s=referrer))
    if ignore_referrer is not None:
        ps.append(kv("ignore_referrer", s=ignore_referrer))
    row.update({
        "event_name": name, "event_timestamp": ts, "event_params": ps,
        "event_bundle_sequence_id": bundle if bundle is not None else ts,
        "user_pseudo_id": user, "stream_id": bu, "business_unit": bu, "platform": "WEB",
        "items": items or [],
        "table_suffix": suffix or dt.datetime.fromtimestamp(ts / 1e6, dt.timezone.utc).strftime("%Y%m%d"),
    })
    row["device"]["web_info"]["hostname"] = host
    row["session_traffic_source_last_click"]["manual_campaign"]["source"] = sts_source
    row["session_traffic_source_last_click"]["manual_campaign"]["medium"] = sts_medium
    for k, v in (cts or {}).items():
        row["collected_traffic_source"][k] = v
    row.update(extra)
    return row


def raw_df(spark, schema, rows):
    from clickmarts.sources.shards import tag_shard
    return tag_shard(spark.createDataFrame([raw_row(schema, **r) for r in rows], schema))
