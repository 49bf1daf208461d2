import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from clickmarts.session import local_session
    s = local_session("4", shuffle_partitions=8, app="clickmarts-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def raw_schema(spark):
    from pyspark.sql import types as T

    from clickmarts.sources.fixtures import raw_events

    def nullable(dt):
        if isinstance(dt, T.StructType):
            return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in dt.fields])
        if isinstance(dt, T.ArrayType):
            return T.ArrayType(nullable(dt.elementType), True)
        return dt

    return nullable(raw_events(spark, SF_SMALL).schema)
