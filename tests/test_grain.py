import datetime as dt

import pytest

from cadastria.operators.grain import LINE_COLUMNS, SALE_COLUMNS, distinct_lines, sale_grain

SCHEMA = ("id_mutation string, date_mutation date, valeur_fonciere double, code_postal string, "
          "code_commune string, nom_commune string, code_departement string, id_parcelle string, "
          "nombre_lots bigint, type_local string, surface_reelle_bati double, nombre_pieces bigint, "
          "surface_terrain double, longitude double, latitude double")


def line(**over):


    base = dict(id_mutation="m", date_mutation=dt.date(2024, 5, 2), valeur_fonciere=300000.0,
                code_postal="92100", code_commune="92012", nom_commune="Boulogne",
                code_departement="92", id_parcelle="p1", nombre_lots=1, type_local="Appartement",
                surface_reelle_bati=50.0, nombre_pieces=2, surface_terrain=None,
                longitude=2.24, latitude=48.84)
    return {**base, **over}


def sales(frame, lines):
    return {r.id_mutation: r for r in sale_grain(frame(SCHEMA, lines)).collect()}


def test_repeated_price_and_repeated_unit_count_once(frame):
    got = sales(frame, [line(), line(), line(surface_terrain=100.0), line(surface_terrain=80.0)])
    m = got["m"]
    assert (m.valeur_fonciere, m.nb_appartements, m.surface_habitable) == (300000.0, 1, 50.0)
    assert (m.nb_lignes_source, m.nb_valeurs_distinctes, m.nb_parcelles) == (3, 1, 1)
    assert m.surface_terrain == 100.0 and m.est_vente_simple is True
    assert m.type_bien == "Appartement"


def test_outbuilding_is_tolerated_business_is_not(frame):
    cellar = line(type_local="Dépendance", surface_reelle_bati=None, nombre_pieces=0)
    shop = line(type_local="Local industriel. commercial ou assimilé", surface_reelle_bati=30.0)
    got = sales(frame, [line(), cellar, *[{**x, "id_mutation": "b"} for x in (line(), shop)]])
    assert got["m"].est_vente_simple is True and got["m"].nb_dependances == 1
    assert got["b"].est_vente_simple is False and got["b"].nb_locaux_activite == 1


def test_identical_flats_on_a_parcel_collapse(frame):
    """A known limit of the rule that removes repeated units."""
    got = sales(frame, [line(nombre_lots=1), line(nombre_lots=2)])
    assert got["m"].nb_appartements == 1 and got["m"].nb_lignes_source == 2


def test_classes_and_unknown_surface(frame):
    def sale(i, **over):
        return line(id_mutation=i, **over)

    got = sales(frame, [
        sale("house", type_local="Maison"), sale("land", type_local=None, surface_terrain=500.0),
        sale("out", type_local="Dépendance"), sale("multi"), sale("multi", id_parcelle="p2"),
        sale("shop", type_local="Local industriel. commercial ou assimilé"),
        sale("unknown", surface_reelle_bati=None), sale("tiny", surface_reelle_bati=8.0),
        sale("prices"), sale("prices", valeur_fonciere=1.0),
    ])
    assert {k: v.type_bien for k, v in got.items()} == {
        "house": "Maison", "land": "Terrain / non bâti", "out": "Dépendance seule",
        "multi": "Multi-logements", "shop": "Local commercial", "unknown": "Appartement",
        "tiny": "Appartement", "prices": "Appartement"}
    assert got["unknown"].est_vente_simple is None and got["unknown"].surface_habitable is None
    assert got["tiny"].est_vente_simple is False and got["prices"].est_vente_simple is False
    assert got["prices"].nb_valeurs_distinctes == 2 and got["prices"].valeur_fonciere == 300000.0
    assert got["land"].nb_pieces is None and got["land"].nb_appartements == 0


def test_majority_commune_ties_and_missing(frame):
    got = sales(frame, [
        line(code_commune="B", nombre_lots=1), line(code_commune="A", nombre_lots=2),
        line(id_mutation="n", code_commune=None, nombre_lots=1),
        line(id_mutation="n", code_commune=None, nombre_lots=2),
        line(id_mutation="n", code_commune="A", nombre_lots=3),
        line(id_mutation="t", code_commune=None, nombre_lots=1),
        line(id_mutation="t", code_commune="Z", nombre_lots=2),
    ])
    assert (got["m"].code_commune, got["n"].code_commune, got["t"].code_commune) == ("A", None, "Z")


@pytest.fixture
def hot_lines(spark):
    """A third of all lines belong to one sale, and a third are copies of a single line."""
    from pyspark.sql import functions as F

    n = F.col("id")
    hot, copy = n % 3 == 0, n % 3 == 1
    return spark.range(0, 30000, numPartitions=8).select(
        F.when(hot, "hot").when(copy, "copy").otherwise(F.concat(F.lit("s"), (n % 500).cast("string")))
        .alias("id_mutation"),
        F.lit("2024-01-02").cast("date").alias("date_mutation"),
        F.lit(250000.0).alias("valeur_fonciere"), F.lit("92100").alias("code_postal"),
        F.when(copy, "92012").otherwise((n % 7).cast("string")).alias("code_commune"),
        F.lit("x").alias("nom_commune"), F.lit("92").alias("code_departement"),
        F.when(copy, "p").otherwise(n.cast("string")).alias("id_parcelle"),
        F.lit(1).cast("bigint").alias("nombre_lots"), F.lit("Maison").alias("type_local"),
        F.lit(40.5).alias("surface_reelle_bati"), F.lit(3).cast("bigint").alias("nombre_pieces"),
        F.when(copy, 10.0).otherwise(n / 4).alias("surface_terrain"),
        F.lit(2.0).alias("longitude"), F.lit(48.0).alias("latitude"))


def test_hot_sale_and_hot_copies_match_brute_force(spark, hot_lines):
    pdf = hot_lines.toPandas().drop_duplicates()
    got = sale_grain(hot_lines).toPandas().set_index("id_mutation")
    assert len(got) == pdf["id_mutation"].nunique() and list(got.columns) == SALE_COLUMNS[1:]
    land = pdf.groupby(["id_mutation", "id_parcelle"])["surface_terrain"].max().groupby(level=0).sum()
    for key in ("hot", "copy", "s2"):
        part = pdf[pdf.id_mutation == key]
        row = got.loc[key]
        assert row.nb_lignes_source == len(part) and row.nb_maisons == len(part)
        assert row.surface_habitable == pytest.approx(40.5 * len(part))
        assert row.surface_terrain == pytest.approx(land[key])
        counts = part["code_commune"].value_counts()
        assert row.code_commune == sorted(counts[counts == counts.max()].index)[0]
    assert distinct_lines(hot_lines).count() == len(pdf)


def test_hot_sale_plan_shuffles_on_more_than_the_sale(hot_lines):
    """Before the last, partially aggregated shuffle, rows are never hashed on the sale alone."""
    plan = sale_grain(hot_lines)._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.split("\n") if "Exchange hashpartitioning(id_mutation" in x]
    alone = [x for x in exchanges if "hashpartitioning(id_mutation#" in x
             and "," not in x.split("hashpartitioning(")[1].split(")")[0].replace(", 8", "")]
    assert len(alone) == 4  # one per branch, each right above a partial aggregate
    lines = plan.split("\n")
    for x in alone:
        assert "partial_" in lines[lines.index(x) + 1]


def test_lines_without_an_id_are_one_sale(spark):
    columns = [f"{c} {t}" for c, t in zip(LINE_COLUMNS, [
        "string", "date", "double", "string", "string", "string", "string", "string", "bigint",
        "string", "double", "bigint", "double", "double", "double"])]
    line = (None, dt.date(2020, 1, 1), 100.0, "75001", "101", "A", "75", "p1", 1, "Maison", 50.0, 2, 9.0, 2.0, 48.0)
    other = (*line[:7], "p2", *line[8:])
    sales = sale_grain(spark.createDataFrame([line, other, ("m", *line[1:])], ", ".join(columns))).collect()
    got = {r.id_mutation: (r.nb_parcelles, r.nb_maisons, r.valeur_fonciere, r.type_bien) for r in sales}
    assert got == {None: (2, 2, 100.0, "Multi-logements"), "m": (1, 1, 100.0, "Maison")}


def test_branches_written_one_by_one_give_the_same_sales(spark, hot_lines):
    """The last step then joins one row a sale from each branch; no shuffle of lines is left in it."""
    from cadastria.session import stored

    kept = []

    def keep(df):
        kept.append(stored(df))
        return kept[-1]

    staged = sale_grain(hot_lines, keep)
    n = hot_lines.select("id_mutation").distinct().count()
    assert [df.count() for df in kept] == [hot_lines.distinct().count(), n, n, n, n]
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "Aggregate" not in plan
    order = lambda df: sorted(map(tuple, df.collect()))
    assert order(staged) == order(sale_grain(hot_lines))


def test_the_landed_stand_in_is_not_shuffled_once_more(spark):
    from cadastria.plans.warehouse import standin_inputs, standin_warehouse

    sf = "/root/testdata/sf0.001"
    w = standin_warehouse(spark, sf)
    asked = []
    w.store.table = lambda name, build, *a: asked.append((name, build())) or asked[-1][1]
    try:
        w.raw_lines()
    finally:
        del w.store.table
    (name, df), = asked
    assert name == "raw_lines" and "REPARTITION" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.columns == standin_inputs(spark, sf).lines().columns
