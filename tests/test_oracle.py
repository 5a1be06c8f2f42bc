"""Each query against its SQL twin, and row checks of those without one."""

import pytest

from __spark_entry__ import entry
from workload.oracles import ORACLES
from workload.queries import REGISTRY
from tests.compare import connect, differences

WITHOUT_SQL = {"kmeans_sweep", "cluster_labels", "projection_2d", "chart_i", "chart_k", "snap_points"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, connection, name):
    assert differences(REGISTRY[name](spark, sf_dir), ORACLES[name], connection) == []


def test_only_fitted_queries_lack_sql():
    assert set(REGISTRY) - set(ORACLES) == WITHOUT_SQL


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "station" and df.count() == 15
