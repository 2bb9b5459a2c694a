"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import checks
from cadastria.catalogue import QUERIES
from oracle.queries import ORACLE

SF = "/root/testdata/sf0.001"
SLOW = {"gbt_model", "ablation", "importance", "out_of_sample_metrics"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in checks.TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["annee", "code_departement", "prix_m2_median"]


def test_sql_only_for_registered_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLE) == SLOW


@pytest.mark.parametrize("name", [
    "safe_typing", "sale_grain", "fact_sales", "dim_place", "dim_calendar", "physical_stations",
    "spatial_range_join", "stations_in_radius", "commune_quartiles_k5", "gap_stats_k5", "yoy",
    "rolling_12m_median", "last12_vs_prev12", "dense_rank_place", "report_r5_communes",
    "report_r6_matrice", "role_filtered", "quantile_class", "price_range", "dq_table_fact",
    "dq_dirty_lines", "csv_by_name_union", "file_manifest_diff", "json_flatten", "training_set",
    "regression_metrics", "cluster_se_1d", "evolution_prix_m2_12m_monthly", "incremental_landing",
    "segment_errors", "measure_k11_prix_m2_median_12m", "nearest_station", "unit_totals",
    "land_two_level", "pivot_band_zone",
])
def test_query_equals_its_sql(spark, con, name):
    result = checks.compare(spark, con, name, SF)
    assert result.startswith(f"{name}: ok"), result
