from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adlens.session import get_spark  # noqa: E402
from adlens.sources import schema as S  # noqa: E402
from adlens.sources.model import Model  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir comes from the session defaults when configured;
    # adlens.session.checkpoint_root picks a local one only when it is unset.
    s = get_spark(master="local[4]", shuffle_partitions=8, app_name="adlens-tests",
                  extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def make_model(spark, tables: dict[str, list]) -> Model:
    """A Model from literal rows (missing tables are empty)."""
    from pyspark.sql import types as T

    def loose(sch):  # stored files are read as nullable; audits must see dirty rows
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in sch.fields])

    dfs = {}
    for name, sch in S.TABLES.items():
        dfs[name] = spark.createDataFrame(tables.get(name, []), loose(sch))
    dfs["cost_feed"] = spark.createDataFrame(tables.get("cost_feed", []), S.COST_FEED)
    return Model(**dfs)


@pytest.fixture(scope="session")
def seed(spark):
    from tests.fixtures.seed import rows
    return make_model(spark, rows())
