import pytest

from cadastria.functions import constants as K
from cadastria.plans import extract

SCHEMA = ("code_commune string, nom_commune string, code_departement string, zone string, "
          "type_bien string, annee int, nb_ventes bigint, prix_m2_q1 double, "
          "prix_m2_median double, prix_m2_q3 double")


@pytest.fixture
def prices(spark):
    return spark.createDataFrame([
        ("75101", "Paris 1er", "75", K.ZONE_CITY, K.FLAT, 2024, 100, 11000.0, 12500.0, 14000.0),
        ("75101", "Paris 1er", "75", K.ZONE_CITY, K.FLAT, 2025, 120, 11500.0, 13000.0, 14500.0),
        ("92012", "Boulogne", "92", K.ZONE_INNER, K.FLAT, 2025, 80, 7000.0, 8000.0, 9000.0),
        ("93001", "Aubervilliers", "93", K.ZONE_INNER, K.FLAT, 2025, 40, 3500.0, 4000.0, 4500.0),
        ("75101", "Paris 1er", "75", K.ZONE_CITY, K.HOUSE, 2025, 6, 9000.0, 10000.0, 11000.0),
    ], SCHEMA)


def test_filter(prices):
    view = extract.filter_prices(prices, K.FLAT, 2025, [K.ZONE_INNER])
    assert sorted(r.code_commune for r in view.collect()) == ["92012", "93001"]
    row = extract.headline(view).head()
    assert (row.communes, row.ventes, row.prix_m2_median) == (2, 120, 6000.0)


def test_price_range_uses_the_latest_year(prices):
    row = extract.price_range(prices, "75101", K.FLAT, 40).head()
    assert (row.annee, row.nb_ventes, row.bas, row.median, row.haut) == (
        2025, 120, 460000.0, 520000.0, 580000.0)
    assert extract.price_range(prices, "99999", K.FLAT, 40).count() == 0
    assert extract.price_range(prices, "75101", K.FLAT, 0).count() == 0


def test_pivots(spark, prices):
    rows = extract.yearly_pivot(prices, ["75101", "92012"], K.FLAT).collect()
    assert [r.annee for r in rows] == [2024, 2025]
    assert rows[1]["Boulogne"] == 8000.0 and rows[0]["Boulogne"] is None
    bands = spark.createDataFrame([
        (K.ZONE_CITY, K.FLAT, 2025, "1. Moins de 500 m", 11000.0),
        (K.ZONE_CITY, K.FLAT, 2025, "2. 500 m à 1 km", 10500.0),
        (K.ZONE_INNER, K.FLAT, 2025, "1. Moins de 500 m", 6500.0),
    ], "zone string, type_bien string, annee int, tranche_dist_gare string, prix_m2_median double")
    rows = extract.band_pivot(bands, K.FLAT, 2025).collect()
    assert [r.tranche_dist_gare for r in rows] == ["1. Moins de 500 m", "2. 500 m à 1 km"]
    assert rows[0][K.ZONE_INNER] == 6500.0


def test_labels(prices):
    rows = extract.place_labels(prices, K.FLAT).collect()
    assert [r.libelle for r in rows] == ["Aubervilliers (93)", "Boulogne (92)", "Paris 1er (75)"]
    assert rows[2].annee == 2024


def test_small_groups_are_not_published(spark, tmp_path):
    import datetime as dt

    rows = [("A", K.FLAT, dt.date(2024, 1, d), 3000.0 + d, 50.0, True) for d in range(1, 6)]
    rows += [("B", K.FLAT, dt.date(2024, 1, d), 3000.0, 50.0, True) for d in range(1, 5)]
    rows += [("B", K.FLAT, dt.date(2024, 1, 9), 99.0, 50.0, False)]
    fact = spark.createDataFrame(
        rows, "geo_key string, type_bien string, date_mutation date, prix_m2 double, "
              "surface_habitable double, est_prix_m2_fiable boolean")
    places = spark.createDataFrame(
        [(k, k, k, "92", "D", K.ZONE_INNER, 48.0, 2.0) for k in "AB"],
        "geo_key string, code_commune string, nom_commune string, code_departement string, "
        "nom_departement string, zone string, latitude double, longitude double")
    got = extract.place_prices(fact, places)
    row = got.head()
    assert got.count() == 1 and (row.code_commune, row.nb_ventes) == ("A", 5)
    assert (row.prix_m2_q1, row.prix_m2_median, row.prix_m2_q3) == (3002.0, 3003.0, 3004.0)
    near = extract.place_prices(fact, places, approx=True).head()
    assert near.prix_m2_median == 3003.0
    extract.export({"prix": got}, str(tmp_path))
    assert len(list((tmp_path / "prix").glob("*.parquet"))) == 1
