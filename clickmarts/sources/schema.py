"""The raw export's schema, merging of schemas, and shards of different versions.

An export's shards differ over time: records are added, numbers widen.  ``read_versions``
finds which days share a schema from one file footer a shard, and ``read_evolved`` reads
each run of days with its own schema and brings it to the merged one: missing records and
nested fields become typed NULLs, numbers widen field by field.  Types that do not widen
into one another are an error that names the field, never a silent cast.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from typing import Iterable, Optional, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmarts.sources import files

# ---------------------------------------------------------------------------
# The export's columns that the marts read, in the reference's order, with
# the widest types seen.
# ---------------------------------------------------------------------------
_VALUE = "struct<string_value:string,int_value:bigint,float_value:double,double_value:double>"
_PARAMS = f"array<struct<key:string,value:{_VALUE}>>"


def _record(*names: str) -> str:
    return "struct<" + ",".join(f"{n}:string" for n in names) + ">"



RAW_FIELDS = (
    ("event_name", "string"), ("event_timestamp", "bigint"), ("event_params", _PARAMS),
    ("event_previous_timestamp", "bigint"), ("event_value_in_usd", "double"),
    ("event_bundle_sequence_id", "bigint"), ("event_server_timestamp_offset", "bigint"),
    ("user_id", "string"), ("user_pseudo_id", "string"),
    ("privacy_info", _record("analytics_storage", "ads_storage", "uses_transient_token")),
    ("user_properties", _PARAMS), ("user_first_touch_timestamp", "bigint"),
    ("user_ltv", "struct<revenue:double,currency:string>"),
    ("device", _record("category", "mobile_brand_name", "mobile_model_name", "mobile_os_hardware_model",
                       "mobile_marketing_name", "operating_system", "operating_system_version", "language",
                       "is_limited_ad_tracking", "advertising_id", "vendor_id", "browser", "browser_version")[:-1]
     + f",web_info:{_record('browser', 'browser_version', 'hostname')}>"),
    ("geo", _record("continent", "country", "region", "city", "metro", "sub_continent")),
    ("app_info", _record("id")), ("traffic_source", _record("source", "medium", "name")),
    ("collected_traffic_source", _record(
        "manual_source", "manual_medium", "manual_campaign_name", "manual_campaign_id", "manual_content", "manual_term",
        "manual_creative_format", "manual_marketing_tactic", "manual_source_platform", "gclid", "dclid", "srsltid")),
    ("session_traffic_source_last_click",
     "struct<manual_campaign:" + _record("source", "medium", "campaign_name", "campaign_id", "content", "term",
                                         "creative_format", "marketing_tactic", "source_platform")
     + ",google_ads_campaign:" + _record("campaign_name", "campaign_id", "customer_id", "account_name", "ad_group_id",
                                         "ad_group_name") + ">"),
    ("stream_id", "string"), ("platform", "string"), ("event_dimensions", _record("hostname")),
    ("ecommerce", "struct<total_item_quantity:bigint,purchase_revenue_in_usd:double,purchase_revenue:double,"
                  "refund_value_in_usd:double,refund_value:double,shipping_value_in_usd:double,shipping_value:double,"
                  "tax_value_in_usd:double,tax_value:double,unique_items:bigint,transaction_id:string>"),
    ("items", "array<" + _record(
        "item_id", "item_name", "item_brand", "item_variant", "item_category", "item_category2", "item_category3",
        "item_category4", "item_category5", "coupon", "affiliation", "location_id", "item_list_id", "item_list_name",
        "item_list_index", "promotion_id", "promotion_name", "creative_name", "creative_slot")[:-1]
     + ",item_revenue_in_usd:double,quantity:bigint,price_in_usd:double,price:double>>"),
)


def raw_schema() -> T.StructType:
    """The widest known schema of a raw shard (without the suffix column)."""
    return T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in RAW_FIELDS))


#: Numbers that widen without loss: each type into those after it in its row.
_WIDER = ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.ByteType, T.ShortType, T.IntegerType, T.DoubleType),
          (T.FloatType, T.DoubleType))


def merge_types(a: T.DataType, b: T.DataType, where: str = "") -> T.DataType:
    """The type that holds both: records field by field (the first's order, then new fields),
    arrays and maps by their elements, numbers widened, NULL into anything."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merge_schemas([a, b], where)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_types(a.elementType, b.elementType, f"{where}[]"), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(merge_types(a.keyType, b.keyType, f"{where}.key"), merge_types(a.valueType, b.valueType, f"{where}.value"), True)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    for row in _WIDER:
        if type(a) in row and type(b) in row:
            return row[max(row.index(type(a)), row.index(type(b)))]()
    raise TypeError(f"{where or 'column'}: {a.simpleString()} and {b.simpleString()} do not widen into one type")


def merge_schemas(schemas: Sequence[T.StructType], where: str = "") -> T.StructType:
    """Recursive merge by field name (letters' case aside); every field may be NULL."""
    merged: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            path = f"{where}.{f.name}" if where else f.name
            before = merged.get(f.name.lower())
            merged[f.name.lower()] = T.StructField(
                before.name if before else f.name, merge_types(before.dataType, f.dataType, path) if before else f.dataType, True)
    return T.StructType(list(merged.values()))


def conformed(value: Optional[Column], have: Optional[T.DataType], want: T.DataType) -> Column:
    """``value`` of type ``have`` as type ``want``, which holds it; a missing value is a typed NULL."""
    if value is None or have is None:
        return F.lit(None).cast(want)
    if _same(have, want):
        return value
    if isinstance(want, T.StructType):
        known = {f.name.lower(): f for f in have.fields}
        fields = []
        for f in want.fields:
            own = known.get(f.name.lower())
            fields.append(conformed(value[own.name] if own else None, own.dataType if own else None, f.dataType).alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: conformed(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        return F.map_from_entries(F.transform(F.map_entries(value), lambda e: F.struct(
            conformed(e["key"], have.keyType, want.keyType).alias("key"),
            conformed(e["value"], have.valueType, want.valueType).alias("value"))))
    return value.cast(want)


def _same(a: T.DataType, b: T.DataType) -> bool:
    return a.simpleString() == b.simpleString()


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``, in its order and types."""
    known = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in schema.fields:
        own = known.get(f.name.lower())
        out.append(conformed(F.col(f"`{own.name}`") if own else None, own.dataType if own else None, f.dataType).alias(f.name))
    return df.select(*out)


@dataclass(frozen=True)
class SchemaVersion:
    """Shards that share a file schema."""

    shards: tuple[str, ...]
    schema: T.StructType


def read_versions(spark: SparkSession, path: str, suffix_col: str = "table_suffix",
                  first_day: Optional[dt.date] = None) -> list[SchemaVersion]:
    """The schema versions of an export's shards, by one file footer a shard (a shard is
    written by one export run).  Shards before ``first_day`` are not looked at."""
    prefix = f"{suffix_col}="
    by_schema: dict[str, list[str]] = {}
    kept: dict[str, T.StructType] = {}
    for name in files.names(spark, path):
        suffix = name.removeprefix(prefix)
        if suffix == name or (first_day is not None and suffix[-8:] < first_day.strftime("%Y%m%d")):
            continue
        schema = spark.read.option("mergeSchema", "false").parquet(f"{path}/{name}").schema
        by_schema.setdefault(schema.json(), []).append(suffix)
        kept[schema.json()] = schema
    return [SchemaVersion(tuple(shards), kept[key]) for key, shards in by_schema.items()]


def read_evolved(spark: SparkSession, path: str, schema: Optional[T.StructType] = None, suffix_col: str = "table_suffix",
                 versions: Optional[Iterable[SchemaVersion]] = None, first_day: Optional[dt.date] = None) -> DataFrame:
    """All shards of an export under one schema: ``schema`` (the raw one by default), widened
    by whatever its shards hold in those columns.  Shard folders of a version are read in one
    scan; bounds on the suffix still prune folders of every version."""
    versions = list(read_versions(spark, path, suffix_col, first_day) if versions is None else versions)
    want = schema or raw_schema()
    names = {f.name.lower() for f in want.fields}
    held = [T.StructType([f for f in v.schema.fields if f.name.lower() in names]) for v in versions]
    merged = merge_schemas([want, *held])
    parts = []
    for v, own in zip(versions, held):
        df = (spark.read.schema(T.StructType([*own.fields, T.StructField(suffix_col, T.StringType())]))
              .option("basePath", path).parquet(*[f"{path}/{suffix_col}={s}" for s in v.shards]))
        parts.append(conform(df, T.StructType([*merged.fields, T.StructField(suffix_col, T.StringType())])))
    if not parts:
        return spark.createDataFrame([], T.StructType([*merged.fields, T.StructField(suffix_col, T.StringType())]))
    return reduce(lambda a, b: a.unionByName(b), parts)
