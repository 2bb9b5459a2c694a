import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cadastria.functions import constants as K
from cadastria.plans import measures, reports, star
from cadastria.plans.measures import MEASURES, Context, Star, evaluate, secure, with_totals

FACT = ("transaction_id string, date_mutation date, geo_key string, bien_key string, "
        "code_departement string, type_bien string, valeur_fonciere double, "
        "surface_habitable double, prix_m2 double, est_vente_simple boolean, "
        "est_prix_m2_fiable boolean, dist_gare_m double, tranche_dist_gare string, "
        "tranche_dist_gpe string")


@pytest.fixture(scope="module")
def small(spark):
    def sale(i, day, geo, price, surface=50.0, reliable=True, simple=True, dist=300.0):
        m2 = round(price / surface, 2)
        return (str(i), dt.date.fromisoformat(day), geo, "flat", "00", K.FLAT, price, surface, m2,
                simple, reliable, dist, "1. Moins de 500 m", "4. Plus de 3 km")

    rows = [
        sale(1, "2022-03-10", "A", 200000.0), sale(2, "2022-09-01", "A", 300000.0),
        sale(3, "2023-03-05", "A", 250000.0), sale(4, "2023-03-20", "B", 150000.0, dist=800.0),
        sale(5, "2022-06-15", "B", 100000.0), sale(6, "2023-11-30", "C", 500000.0),
        sale(7, "2023-12-01", "A", 1000.0, reliable=False, simple=None, dist=None),
        sale(8, "2022-01-05", "C", 400000.0),
    ]
    fact = spark.createDataFrame(rows, FACT).withColumn(
        "date_key", F.date_format("date_mutation", "yyyyMMdd").cast("int"))
    places = spark.createDataFrame([
        ("A", "Alpha", "A", "92", "Dep92", K.ZONE_INNER, 30000.0, 100, 10.0),
        ("B", "Beta", "B", "77", "Dep77", K.ZONE_OUTER, 20000.0, 300, 30.0),
        ("C", "Gamma", "C", "75", "Paris", K.ZONE_CITY, None, None, None),
    ], "geo_key string, nom_commune string, code_commune string, code_departement string, "
       "nom_departement string, zone string, revenu_median_uc double, nb_dpe bigint, "
       "part_dpe_fg_pct double")
    segments = spark.createDataFrame(
        [("flat", K.FLAT, "T2", "50-80 m²", True)],
        "bien_key string, type_bien string, classe_pieces string, tranche_surface string, "
        "est_logement boolean")
    calendar = star.calendar(fact, F.lit("2023-06-01").cast("date"))
    gaps = fact.filter("est_prix_m2_fiable").withColumns({
        "prix_m2_predit": F.lit(4000.0),
        "ecart_pct": F.round((F.col("prix_m2") - 4000) / 4000 * 100, 1),
        "positionnement_prix": F.lit("x")})
    return Star(fact, calendar, places, segments, gaps)


def table(df, key):
    return {r[key]: r for r in df.collect()}


def test_plain_measures_without_axes(small):
    row = evaluate(small, ["nb_ventes", "volume_ventes", "prix_m2_median", "part_ventes_fiables",
                           "part_ventes_simples", "nb_ventes_ecartees", "part_ventes_500m"]).head()
    assert (row.nb_ventes, row.volume_ventes, row.nb_ventes_ecartees) == (8, 1901000.0, 1)
    assert row.prix_m2_median == pd.Series([4000, 6000, 5000, 3000, 2000, 10000, 8000]).median()
    assert row.part_ventes_fiables == row.part_ventes_simples == 7 / 8
    assert row.part_ventes_500m == 6 / 7


def test_prior_year_keeps_periods_without_current_sales(small):
    got = table(evaluate(small, ["nb_ventes", "nb_ventes_n1", "evolution_volume",
                                 "prix_m2_median_n1", "evolution_prix_m2"],
                         Context(("annee_mois",))), "annee_mois")
    assert got["2023-03"].nb_ventes == 2 and got["2023-03"].nb_ventes_n1 == 1
    assert got["2023-03"].evolution_volume == 1.0
    assert got["2023-03"].evolution_prix_m2 == 0.0
    assert got["2023-09"].nb_ventes is None and got["2023-09"].evolution_volume == -1.0
    assert got["2022-03"].evolution_volume is None
    assert "2024-01" not in got  # outside the calendar


def test_rolling_year_ends_with_the_period(small):
    got = table(evaluate(small, ["prix_m2_median_12m"], Context(("annee_mois",))), "annee_mois")
    # March 2023 sees April 2022 to March 2023
    assert got["2023-03"].prix_m2_median_12m == pd.Series([6000, 5000, 3000, 2000]).median()
    assert got["2022-02"].prix_m2_median_12m == 8000


def test_last_year_change_is_anchored_on_the_last_sale(small):
    got = table(evaluate(small, ["evolution_prix_m2_12m"], Context(("nom_commune",))),
                "nom_commune")
    # Alpha's last sale is 2023-12-01: 5000 against 4000 and 6000
    assert got["Alpha"].evolution_prix_m2_12m == 0.0
    assert got["Beta"].evolution_prix_m2_12m is None
    assert got["Gamma"].evolution_prix_m2_12m == 0.25
    sliced = table(evaluate(small, ["evolution_prix_m2_12m"],
                            Context(("nom_commune",), keep={"annee": [2022]})), "nom_commune")
    assert sliced["Alpha"].evolution_prix_m2_12m is None


def test_change_since_first_year_leaves_the_city_out(small):
    got = table(evaluate(small, ["evolution_depuis_1re_annee"], Context(("annee",))), "annee")
    assert got[2022].evolution_depuis_1re_annee == 0.0
    assert got[2023].evolution_depuis_1re_annee == 0.0  # 4000 against 4000
    by_zone = evaluate(small, ["evolution_depuis_1re_annee"], Context(("annee", "zone")))
    assert {r.zone for r in by_zone.collect()} == {K.ZONE_INNER, K.ZONE_OUTER}


def test_place_measures_ignore_sales(small):
    row = evaluate(small, ["revenu_median_communal", "part_passoires_dpe"],
                   Context(keep={"annee": [2023]})).head()
    assert row.revenu_median_communal == 25000.0
    assert row.part_passoires_dpe == pytest.approx((100 * .1 + 300 * .3) / 400)
    yearly = evaluate(small, ["nb_ventes", "revenu_median_communal"], Context(("annee",)))
    assert {r.revenu_median_communal for r in yearly.collect()} == {25000.0}


def test_rank_is_dense_and_descending(small):
    got = table(evaluate(small, ["rang_commune"], Context(("nom_commune",))), "nom_commune")
    assert {k: v.rang_commune for k, v in got.items()} == {"Gamma": 1, "Alpha": 2, "Beta": 3}


def test_roles_reach_facts_and_gaps_but_not_the_calendar(small):
    seen = secure(small, K.ZONE_INNER)
    assert seen.fact.count() == 4 and seen.gaps.count() == 3 and seen.places.count() == 1
    assert seen.calendar.count() == small.calendar.count()
    assert evaluate(small, ["nb_ventes"], role=K.ZONE_CITY).head().nb_ventes == 2
    with pytest.raises(ValueError):
        secure(small, "Provence")


def test_totals_are_medians_of_the_rows_not_of_the_cells(small):
    got = {(r.niveau, r.nom_departement): r.prix_m2_median
           for r in with_totals(small, Context(("nom_departement", "type_bien"))).collect()}
    assert got[(3, None)] == 5000.0 and got[(2, None)] == 5000.0
    assert got[(1, "Dep92")] == got[(0, "Dep92")] == 5000.0


def test_every_measure_and_report_runs(small):
    for m in MEASURES:
        axes = ("nom_commune",) if m == "rang_commune" else ("annee", "zone")
        assert m in evaluate(small, [m], Context(axes)).columns
    assert evaluate(small, MEASURES[:-1], Context(("zone",))).count() == 3
    assert reports.run_report(small, "r5_communes", {"annee": [2023]}).count() == 3
    assert [r.nom_commune for r in reports.top_places(small, 2).collect()] == ["Gamma", "Alpha"]
    with pytest.raises(ValueError):
        evaluate(small, ["inconnue"])


def test_hot_group_median_plan_counts_values_first(small):
    """Rows are hashed on group and value before anything is hashed on the group; a dimension too large
    to broadcast is met by its own key below that."""
    plan = evaluate(small, ["prix_m2_median"], Context(("zone",)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    first = [x for x in text.split("\n") if "Exchange hashpartitioning(" in x and "zone#" in x][-1]
    assert "_v#" in first


def test_calendar_days(spark):
    lines = spark.createDataFrame([(dt.date(2020, 3, 1),), (dt.date(2020, 5, 1),)],
                                  "date_mutation date")
    days = star.calendar(lines, F.lit("2019-01-01").cast("date"))
    assert days.count() == 366
    row = days.filter("date = '2020-02-29'").head()
    assert (row.date_key, row.annee_trimestre, row.annee_mois, row.nom_mois, row.semestre,
            row.semaine_iso, row.est_weekend) == (
        20200229, "2020-T1", "2020-02", "février", 1, 9, True)
    assert star.calendar(lines, F.lit("2021-02-01").cast("date")).count() == 731
    assert star.calendar(lines, F.lit("2021-02-01").cast("date"), "2020-01-01",
                         "2020-01-31").count() == 31


def test_measures_of_a_page_share_their_scans(spark, monkeypatch):
    """All values of a page come from one cube; plain aggregates are a second scan."""
    from cadastria.catalogue import star_of
    from cadastria.plans.warehouse import standin_warehouse

    star = star_of(standin_warehouse(spark, "/root/testdata/sf0.001"))
    scans = []
    rows = measures.context_rows
    monkeypatch.setattr(measures, "context_rows", lambda s, table, *a, **k: scans.append(table) or rows(s, table, *a, **k))
    reports.run_report(star, "r5_communes").collect()
    assert scans.count("fact") == 2
