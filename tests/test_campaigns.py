"""The campaign fixture fills every traffic source and record field."""

import pytest
from pyspark.sql import functions as F

from clickmarts.catalog import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["campaign_traffic_fields", "campaign_templates", "campaign_channels", "campaign_records"])
def test_no_column_is_empty(spark, name):
    df = REGISTRY[name](spark, SF)
    counts = df.agg(*[F.count(f"`{c}`").alias(c) for c in df.columns],
                    *[F.count_distinct(f"`{c}`").alias(f"d:{c}") for c in df.columns]).first().asDict()
    assert all(counts[c] > 0 and counts[f"d:{c}"] > 1 for c in df.columns), counts


def test_every_branch_and_every_precedence_occurs(spark):
    from clickmarts.catalog_tables import _campaign_events
    rows = _campaign_events(spark, "/root/testdata/sf0.01").select("source", "medium", "gclid", "event_traffic_source.*", "creative_format").collect()
    assert {r[0][0] for r in rows if r[0]} == {"m", "c", "u", "p"}  # session record, collected, URL, parameter
    assert {r["creative_format"] and r["creative_format"][0] for r in rows} == {"m", "c", None}
    mediums = {r[4] for r in rows}
    assert {"cpc", "referral", "(none)"} <= mediums and len(mediums) > 5
