import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cadastria.functions.constants import EARTH_RADIUS_M
from cadastria.operators import proximity
from cadastria.operators.proximity import DEPTH, dealt_points, nearest_site, within_radius
from cadastria.plans import star


def haversine(lat1, lon1, lat2, lon2):
    lat1, lon1, lat2, lon2 = map(np.radians, (lat1, lon1, lat2, lon2))
    a = np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin((lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(a))


@pytest.mark.parametrize("centre", [48.8, 0.0, -33.9, 69.5, 84.0])
def test_grid_join_equals_all_pairs(spark, centre):
    rng = np.random.default_rng(int(abs(centre)))
    spread = 0.4 / max(np.cos(np.radians(centre)), 0.05)
    p = pd.DataFrame({"id": range(300), "lat": centre + rng.uniform(-.3, .3, 300),
                      "lon": rng.uniform(-spread, spread, 300)})
    s = pd.DataFrame({"name": [f"s{i}" for i in range(60)],
                      "s_lat": centre + rng.uniform(-.3, .3, 60),
                      "s_lon": rng.uniform(-spread, spread, 60)})
    got = within_radius(spark.createDataFrame(p), spark.createDataFrame(s), 10000.0,
                        ("lat", "lon"), ("s_lat", "s_lon")).toPandas()
    d = haversine(p.lat.values[:, None], p.lon.values[:, None], s.s_lat.values, s.s_lon.values)
    want = {(i, f"s{j}") for i, j in zip(*np.where(d <= 10000.0))}
    assert set(zip(got.id, got.name)) == want and len(got) == len(want) > 0


def test_nearest_breaks_ties_by_name_and_counts_names(spark):
    pairs = spark.createDataFrame(
        [(1, "b", "RER", 100.0), (1, "a", "VAL", 100.0), (1, "c", "RER", 1000.0),
         (1, "c", "RER", 900.0), (1, "d", "RER", 1000.1), (2, "z", "RER", 4000.0)],
        "p int, name string, mode string, distance_m double")
    got = {r.p: (r.name, r.mode, r.distance_m, r.nb_sites_near)
           for r in nearest_site(pairs, ["p"], "name", ["mode"], 1000.0).collect()}
    assert got == {1: ("a", "VAL", 100.0, 3), 2: ("z", "RER", 4000.0, 0)}


def test_proximity_caps_far_sales_and_skips_unlocated_ones(spark):
    sales = spark.createDataFrame(
        [("near", 48.85, 2.35), ("far", 45.0, 2.35), ("none", None, None), ("near2", 48.85, 2.35)],
        "id_mutation string, latitude double, longitude double")
    stations = spark.createDataFrame(
        [("S", "RER", True, 48.851, 2.35), ("Tram", "TRAMWAY", False, 48.85, 2.35)],
        "nom_gare string, mode_principal string, est_transport_lourd boolean, latitude double, "
        "longitude double")
    planned = spark.createDataFrame(
        [("P", True, 48.86, 2.35), ("Q", False, 48.85, 2.35)],
        "nom_gare string, est_grand_paris_express boolean, latitude double, longitude double")
    points = star.distinct_points(sales)
    assert points.count() == 2
    got = {r.id_mutation: r for r in star.proximity(
        sales, star.point_proximity(points, stations, planned)).collect()}
    assert set(got) == {"near", "near2", "far"}
    assert (got["near"].gare_proche, got["near"].dist_gare_m, got["near"].nb_gares_1km) == (
        "S", 111.0, 1)
    assert got["near"].gare_gpe_proche == "P" and got["near"].dist_gpe_m == 1112.0
    assert (got["far"].dist_gare_m, got["far"].dist_gpe_m, got["far"].nb_gares_1km) == (
        5000.0, 10000.0, 0)
    banded = {r.id_mutation: r.tranche_dist_gare for r in star.banded_distances(
        spark.createDataFrame([(k, v.dist_gare_m, v.dist_gpe_m) for k, v in got.items()],
                              "id_mutation string, dist_gare_m double, dist_gpe_m double")
    ).filter(F.col("id_mutation") != "near2").collect()}
    assert banded == {"near": "1. Moins de 500 m", "far": "4. Plus de 2 km"}


@pytest.mark.parametrize("lat,lon", [(12.0, 180.0), (-89.97, 40.0), (89.9, 180.0), (89.995, 0.0), (-60.0, -180.0)])
def test_grid_wraps_and_holds_at_the_poles(spark, lat, lon):
    rng = np.random.default_rng(7)
    def spots(n):
        la = np.clip(lat + rng.uniform(-.2, .2, n), -90, 90)
        lo = (rng.uniform(0, 360, n) if abs(lat) > 89 else lon + rng.uniform(-.3, .3, n)) + 180
        return la, lo % 360 - 180
    (a, b), (c, d) = spots(300), spots(80)
    p = spark.createDataFrame(pd.DataFrame({"id": range(300), "lat": a, "lon": b}))
    s = spark.createDataFrame(pd.DataFrame({"name": [f"s{i}" for i in range(80)], "s_lat": c, "s_lon": d}))
    got = within_radius(p, s, 10000.0, ("lat", "lon"), ("s_lat", "s_lon")).toPandas()
    near = haversine(a[:, None], b[:, None], c, d) <= 10000.0
    want = {(i, f"s{j}") for i, j in zip(*np.where(near))}
    assert set(zip(got.id, got.name)) == want and len(got) == len(want) > 0


@pytest.mark.parametrize("lat,lon", [(48.85, 2.35), (12.0, 180.0), (89.97, 10.0), (-60.0, -180.0), (0.0, 0.0)])
def test_dense_cells_are_dealt_out_and_lose_no_pair(spark, lat, lon):
    """A third of the points in one cell, another third at a few metres from each other."""
    rng = np.random.default_rng(3)
    n, shares = 3000, 40
    wide = 0.05 / max(np.cos(np.radians(lat)), 0.01)
    la = np.concatenate([lat + rng.uniform(-.02, .02, n // 3), lat + .03 + rng.uniform(0, 1e-6, n // 3),
                         lat + rng.uniform(-.5, .5, n // 3)]).clip(-90, 90)
    lo = np.concatenate([lon + rng.uniform(-wide, wide, n // 3), lon + rng.uniform(0, 1e-6, n // 3),
                         lon + rng.uniform(-10 * wide, 10 * wide, n // 3)])
    lo = (lo + 180) % 360 - 180
    c = (lat + rng.uniform(-.15, .15, 50)).clip(-90, 90)
    d = (lon + rng.uniform(-3 * wide, 3 * wide, 50) + 180) % 360 - 180
    p = spark.createDataFrame(pd.DataFrame({"id": range(n), "lat": la, "lon": lo}))
    s = spark.createDataFrame(pd.DataFrame({"name": [f"s{i}" for i in range(50)], "s_lat": c, "s_lon": d}))
    got = within_radius(p, s, 5000.0, ("lat", "lon"), ("s_lat", "s_lon"), shares).toPandas()
    near = haversine(la[:, None], lo[:, None], c, d) <= 5000.0
    want = {(i, f"s{j}") for i, j in zip(*np.where(near))}
    assert set(zip(got.id, got.name)) == want and len(got) == len(want) > 0
    dealt, quarters = dealt_points(p, 5000.0, ("lat", "lon"), shares)
    groups = dealt.groupBy("_row", "_col", "_level", "_i", "_j", "_part").count().toPandas()
    # parts are dealt by hash, so not evenly
    assert groups["count"].sum() == n and groups["count"].max() <= 1.5 * n / shares
    assert 1 < quarters.count() <= shares * 4 ** DEPTH


def test_points_without_place_and_empty_sides(spark):
    p = spark.createDataFrame([(1, 48.0, 2.0), (2, None, 2.0), (3, 48.0, None)], "id int, lat double, lon double")
    s = spark.createDataFrame([("s", 48.0, 2.0), ("t", None, None)], "name string, s_lat double, s_lon double")
    join = lambda a, b: within_radius(a, b, 1000.0, ("lat", "lon"), ("s_lat", "s_lon")).collect()
    assert [(r.id, r.name, r.distance_m) for r in join(p, s)] == [(1, "s", 0.0)]
    assert join(p.limit(0), s) == join(p, s.limit(0)) == []


def test_pairs_of_few_points_and_sites_are_dealt_to_many_tasks(spark, monkeypatch):
    """200 points and 400 sites, a few kB, in one town: no task may hold most of their 80 000 pairs."""
    monkeypatch.setattr("cadastria.operators.proximity.PAIRS_A_TASK", 4000, raising=False)
    rng = np.random.default_rng(11)
    p = pd.DataFrame({"id": range(200), "lat": 48.80 + rng.uniform(0, .05, 200), "lon": 2.30 + rng.uniform(0, .05, 200)})
    s = pd.DataFrame({"name": [f"s{i}" for i in range(400)], "s_lat": 48.80 + rng.uniform(0, .05, 400), "s_lon": 2.30 + rng.uniform(0, .05, 400)})
    pairs = within_radius(spark.createDataFrame(p), spark.createDataFrame(s).coalesce(1), 10000.0, ("lat", "lon"), ("s_lat", "s_lon"))
    held = pairs.groupBy(F.spark_partition_id().alias("task")).count().toPandas()["count"]
    assert held.sum() == 200 * 400 and held.max() <= 200 * 400 / 4


def test_sites_of_one_file_are_copied_to_quarters_in_many_tasks(spark):
    """400 sites in one partition go to the quarters of 2 000 points: no task may make most of the copies."""
    rng = np.random.default_rng(12)
    p = pd.DataFrame({"id": range(2000), "lat": 48.80 + rng.uniform(0, .05, 2000), "lon": 2.30 + rng.uniform(0, .05, 2000)})
    s = pd.DataFrame({"name": [f"s{i}" for i in range(400)], "s_lat": 48.80 + rng.uniform(0, .05, 400), "s_lon": 2.30 + rng.uniform(0, .05, 400)})
    _, quarters = dealt_points(spark.createDataFrame(p), 10000.0, ("lat", "lon"), 64)
    around = proximity.site_cells(spark.createDataFrame(s).coalesce(1), 10000.0, ("s_lat", "s_lon"))
    copies = proximity.dealt_sites(around, quarters, 10000.0, ("s_lat", "s_lon"), 16)
    made = copies.groupBy(F.spark_partition_id().alias("task")).count().toPandas()["count"]
    assert made.sum() > 9 * 400 and made.max() <= made.sum() / 4
