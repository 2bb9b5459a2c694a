"""Every registered query: name -> (spark, folder of the star tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadastria.functions import columns as C
from cadastria.functions import constants as K
from cadastria.operators import grain, grouping, hedonic, proximity, quality, rolling
from cadastria.operators.quantiles import exact_quantiles
from cadastria.plans import boosted, checks, extract, marts, measures, model, reports, staging, star
from cadastria.plans import hedonic as station_effect
from cadastria.plans.measures import Context, Star, evaluate
from cadastria.plans.warehouse import Warehouse, standin_warehouse
from cadastria.session import delete_at_end, shared_folder, stored
from cadastria.sources import landing, standin
from cadastria.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to six digits, so that two engines agree on the last bits."""
    return df.withColumns({
        f.name: C.round_half_away(f"`{f.name}`", digits)
        for f in df.schema.fields if f.dataType.simpleString() == "double"
    })


def query(name: str) -> Callable[[Callable[[Warehouse], DataFrame]], Query]:
    """Register a query over the stand-in warehouse."""
    def add(make: Callable[[Warehouse], DataFrame]) -> Query:
        QUERIES[name] = lambda spark, sf: make(standin_warehouse(spark, sf))
        return QUERIES[name]

    return add


def source_query(name: str) -> Callable[[Query], Query]:
    """Register a query over the star tables themselves."""
    def add(make: Query) -> Query:
        QUERIES[name] = make
        return make

    return add


def star_of(w: Warehouse, gaps: bool = True) -> Star:
    return Star(w.fact(), w.calendar(), w.places(), w.segments(), w.gaps() if gaps else None)


# ---- the first slice: raw lines to yearly medians ----------------------------------------

@query("median_price_year_department")
def median_price_year_department(w: Warehouse) -> DataFrame:
    sales = star.priced_sales(grain.sale_grain(w.lines(), stored)).filter("est_prix_m2_fiable")
    keys = ["annee", "code_departement"]
    rows = sales.withColumn("annee", F.year("date_mutation"))
    return tidy(exact_quantiles(rows, keys, {"prix_m2_median": (F.col("prix_m2"), 0.5)},
                                bounded=True))


# ---- staging and grain -------------------------------------------------------------------

@query("safe_typing")
def safe_typing(w: Warehouse) -> DataFrame:
    return w.typed_sale_lines()


@query("distinct_units")
def distinct_units(w: Warehouse) -> DataFrame:
    return grain.distinct_units(w.lines())


@query("unit_totals")
def unit_totals(w: Warehouse) -> DataFrame:
    return grain.unit_totals(grain.distinct_units(w.lines()))


@query("land_two_level")
def land_two_level(w: Warehouse) -> DataFrame:
    return grain.land_totals(w.lines())


@query("majority_value")
def majority_value(w: Warehouse) -> DataFrame:
    return grouping.majority_value(
        grain.distinct_lines(w.lines()), ["id_mutation"],
        ["code_commune", "nom_commune", "code_postal"])


@query("sale_grain")
def sale_grain(w: Warehouse) -> DataFrame:
    return tidy(grain.sale_grain(w.lines(), stored))


@query("price_per_m2_flags")
def price_per_m2_flags(w: Warehouse) -> DataFrame:
    return star.priced_sales(w.sales()).select(
        "id_mutation", "est_vente_simple", "prix_m2", "est_prix_m2_fiable")


@query("room_surface_segments")
def room_surface_segments(w: Warehouse) -> DataFrame:
    return star.segment_columns(w.sales()).select(
        "id_mutation", "type_bien", "classe_pieces", "tranche_surface", "bien_key")


@query("physical_stations")
def physical_stations(w: Warehouse) -> DataFrame:
    return tidy(staging.stations(w.inputs.stations()).drop("geog"))


@query("planned_stations")
def planned_stations(w: Warehouse) -> DataFrame:
    return tidy(staging.planned_stations(w.inputs.planned()).drop("geog"))


@query("income_places")
def income_places(w: Warehouse) -> DataFrame:
    return staging.income(w.inputs.income())


@query("energy_shares")
def energy_shares(w: Warehouse) -> DataFrame:
    return staging.energy(w.inputs.energy())


# ---- geography ---------------------------------------------------------------------------

@query("spatial_range_join")
def spatial_range_join(w: Warehouse) -> DataFrame:
    pairs = star.station_pairs(star.distinct_points(w.sales()), w.stations())
    return tidy(pairs.select("lat_k", "lon_k", "gare_proche", "distance_m"), 3)


@query("nearest_station")
def nearest_station(w: Warehouse) -> DataFrame:
    pairs = star.station_pairs(star.distinct_points(w.sales()), w.stations())
    return tidy(proximity.nearest_site(
        pairs, ["lat_k", "lon_k"], "gare_proche", ["mode_gare_proche"]), 3)


@query("stations_in_radius")
def stations_in_radius(w: Warehouse) -> DataFrame:
    return star.point_proximity(
        star.distinct_points(w.sales()), w.stations(), w.planned()
    ).select("lat_k", "lon_k", "nb_gares_1km", "dist_gpe_m", "gare_gpe_proche")


@query("sale_proximity")
def sale_proximity(w: Warehouse) -> DataFrame:
    return star.proximity(w.sales(), w.point_proximity())


@query("distance_bands")
def distance_bands(w: Warehouse) -> DataFrame:
    return star.banded_distances(w.proximity()).select(
        "id_mutation", "tranche_dist_gare", "tranche_dist_gpe")


# ---- star and marts ----------------------------------------------------------------------

@query("dim_calendar")
def dim_calendar(w: Warehouse) -> DataFrame:
    return star.calendar(w.lines(), w.inputs.as_of)


@query("month_order")
def month_order(w: Warehouse) -> DataFrame:
    """Month names by their number, as reports sort them."""
    months = w.calendar().select("mois", "nom_mois").distinct()  # twelve rows
    return months.withColumn("rang", F.dense_rank().over(Window.orderBy("mois"))).orderBy("mois")


@query("dim_place")
def dim_place(w: Warehouse) -> DataFrame:
    return tidy(star.places(w.sales(), w.departments(), w.income(), w.energy()).drop("centroide"))


@query("dim_segment")
def dim_segment(w: Warehouse) -> DataFrame:
    return star.segments(w.sales())


@query("fact_sales")
def fact_sales(w: Warehouse) -> DataFrame:
    return tidy(star.fact(w.sales(), w.proximity()))


@query("gap_mart")
def gap_mart(w: Warehouse) -> DataFrame:
    return marts.price_gaps(w.fact(), w.predictions())


@query("market_position")
def market_position(w: Warehouse) -> DataFrame:
    return w.gaps().groupBy("positionnement_prix").agg(F.count("*").alias("nb_ventes"))


@query("yearly_median_evolution")
def yearly_median_evolution(w: Warehouse) -> DataFrame:
    return tidy(marts.planned_band_evolution(w.fact(), w.places(), w.inputs.city_department))


@query("commune_quartiles_k5")
def commune_quartiles_k5(w: Warehouse) -> DataFrame:
    return tidy(extract.place_prices(w.fact(), w.places()))


@query("approximate_quartiles")
def approximate_quartiles(w: Warehouse) -> DataFrame:
    """Element quartiles by department, type and year from merged daily sketches: what they count, and whether
    each is within one per cent of its rank among all prices."""
    daily = w.store.table("price_sketches", lambda: extract.daily_sketches(w.fact()))
    keys = ["code_departement", "type_bien", "annee"]
    errors = extract.quartile_errors(w.fact(), extract.approximate_quartiles(daily, keys), keys)
    return errors.select(*keys, "nb_ventes", *[
        (F.col(f"{name}_erreur") <= 0.01).alias(f"{name}_proche") for name in extract.QUARTILES])


@query("band_medians_k5")
def band_medians_k5(w: Warehouse) -> DataFrame:
    return tidy(extract.band_prices(w.fact(), w.places()))


@query("gap_stats_k5")
def gap_stats_k5(w: Warehouse) -> DataFrame:
    return tidy(extract.place_gaps(w.gaps(), w.places()))


@query("raw_band_gaps")
def raw_band_gaps(w: Warehouse) -> DataFrame:
    return tidy(extract.raw_band_gaps(w.fact(), w.places()))


@query("context_correlation")
def context_correlation(w: Warehouse) -> DataFrame:
    return tidy(extract.context_correlation(w.fact(), w.places()))


@query("quality_indicators")
def quality_indicators(w: Warehouse) -> DataFrame:
    return checks.quality_indicators(w)


# ---- period comparisons ------------------------------------------------------------------

@query("prior_year")
def prior_year(w: Warehouse) -> DataFrame:
    return tidy(evaluate(star_of(w, False), ["nb_ventes", "nb_ventes_n1", "prix_m2_median",
                                             "prix_m2_median_n1"], Context(("annee_mois",))))


@query("yoy")
def yoy(w: Warehouse) -> DataFrame:
    return tidy(evaluate(star_of(w, False), ["evolution_volume", "evolution_prix_m2"],
                         Context(("annee_trimestre", "type_bien"))))


@source_query("rolling_12m_median")
def rolling_12m_median(spark: SparkSession, sf: str) -> DataFrame:
    orders = standin.table(spark, sf, "orders")
    return tidy(rolling.rolling_quantile(
        orders, ["o_orderstatus"], "o_orderdate", F.col("o_totalprice"), 0.5, 12,
        "prix_median_12m"))


@query("last12_vs_prev12")
def last12_vs_prev12(w: Warehouse) -> DataFrame:
    return tidy(evaluate(star_of(w, False), ["evolution_prix_m2_12m"],
                         Context(("nom_departement", "type_bien"))))


@query("since_first_year")
def since_first_year(w: Warehouse) -> DataFrame:
    return tidy(evaluate(star_of(w, False), ["evolution_depuis_1re_annee"],
                         Context(("annee", "nom_departement"))))


@query("dense_rank_place")
def dense_rank_place(w: Warehouse) -> DataFrame:
    return tidy(evaluate(star_of(w, False), ["prix_m2_median", "rang_commune"],
                         Context(("nom_commune",), keep={"zone": [K.ZONE_INNER, K.ZONE_OUTER]})))


@query("top_places")
def top_places(w: Warehouse) -> DataFrame:
    return tidy(reports.top_places(star_of(w, False), 10))


@query("bottom_places")
def bottom_places(w: Warehouse) -> DataFrame:
    return tidy(reports.top_places(star_of(w, False), 10, cheapest=True))


# ---- measures and reports ----------------------------------------------------------------

# axes under which each measure is registered; the default is year by zone
AXES = {
    "prix_m2_median_12m": ("annee_mois", "zone"),
    "distance_mediane_gare": ("nom_departement",),
    "part_ventes_500m": ("nom_departement",),
    "revenu_median_communal": ("zone",),
    "part_passoires_dpe": ("zone",),
    "evolution_prix_m2_12m": ("zone",),
    "evolution_depuis_1re_annee": ("annee", "tranche_dist_gpe"),
    "rang_commune": ("nom_commune",),
    "ecart_median_modele": ("positionnement_prix", "zone"),
}


def measure_axes(name: str) -> tuple[str, ...]:
    return AXES.get(name, ("annee", "zone"))


def _measure(name: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: tidy(evaluate(star_of(w), [name], Context(measure_axes(name))))


for _i, _m in enumerate(measures.MEASURES, 1):
    query(f"measure_k{_i:02d}_{_m}")(_measure(_m))


@query("evolution_prix_m2_12m_monthly")
def evolution_prix_m2_12m_monthly(w: Warehouse) -> DataFrame:
    return tidy(evaluate(star_of(w, False), ["evolution_prix_m2_12m"],
                         Context(("annee_mois", "zone"))))


def _report(name: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: tidy(reports.run_report(star_of(w), name))


for _r in reports.REPORTS:
    query(f"report_{_r}")(_report(_r))


@query("report_sliced")
def report_sliced(w: Warehouse) -> DataFrame:
    """A page under slicers and a role."""
    return tidy(reports.run_report(
        star_of(w), "r5_communes", {"annee": [1999], "type_bien": [K.FLAT]}, K.ZONE_OUTER))


@query("role_filtered")
def role_filtered(w: Warehouse) -> DataFrame:
    return tidy(evaluate(star_of(w), ["nb_ventes", "nb_ventes_scorees", "prix_m2_median"],
                         Context(("annee",)), role=K.ZONE_INNER))


@query("role_reconciliation")
def role_reconciliation(w: Warehouse) -> DataFrame:
    return checks.role_reconciliation(w)


# ---- the explorer ------------------------------------------------------------------------

def _prices(w: Warehouse) -> DataFrame:
    return w.store.table("place_prices", lambda: extract.place_prices(w.fact(), w.places()))


def _bands(w: Warehouse) -> DataFrame:
    return w.store.table("band_prices", lambda: extract.band_prices(w.fact(), w.places()))


@query("explorer_view")
def explorer_view(w: Warehouse) -> DataFrame:
    return tidy(extract.filter_prices(_prices(w), K.FLAT, 1999, [K.ZONE_INNER, K.ZONE_OUTER])
                .orderBy(F.col("prix_m2_median").desc()))


@query("explorer_gaps")
def explorer_gaps(w: Warehouse) -> DataFrame:
    return tidy(extract.filter_gaps(
        extract.place_gaps(w.gaps(), w.places()), K.FLAT, K.ZONES, 30))


@query("quantile_class")
def quantile_class(w: Warehouse) -> DataFrame:
    view = extract.filter_prices(_prices(w), K.FLAT, 1999, K.ZONES)
    return tidy(grouping.colour_by_price(view).select(
        "code_commune", "prix_m2_median", "classe", "couleur", "rayon"))


@source_query("quantile_class_customers")
def quantile_class_customers(spark: SparkSession, sf: str) -> DataFrame:
    customers = standin.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return grouping.quantile_class(customers, "c_acctbal", ["c_custkey"], 5, "classe").drop("_k")


@query("price_range")
def price_range(w: Warehouse) -> DataFrame:
    return tidy(extract.price_ranges(_prices(w), 40.0))


@query("latest_row")
def latest_row(w: Warehouse) -> DataFrame:
    return tidy(extract.latest(_prices(w), ["code_commune", "type_bien"]))


@query("first_per_place")
def first_per_place(w: Warehouse) -> DataFrame:
    return extract.place_labels(_prices(w), K.FLAT)


@query("kpis")
def kpis(w: Warehouse) -> DataFrame:
    return tidy(extract.headline(_prices(w), ["annee", "type_bien"]))


PIVOT_PLACES = {"100": "NATION_0", "101": "NATION_1", "106": "NATION_6", "114": "NATION_14",
                "115": "NATION_15"}


@query("pivot_year_place")
def pivot_year_place(w: Warehouse) -> DataFrame:
    return tidy(extract.yearly_pivot(
        _prices(w), list(PIVOT_PLACES), K.FLAT, list(PIVOT_PLACES.values())))


@query("pivot_band_zone")
def pivot_band_zone(w: Warehouse) -> DataFrame:
    return tidy(extract.band_pivot(_bands(w), K.FLAT, 1999))


# ---- data quality ------------------------------------------------------------------------

def _table_checks(name: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: checks.check_table(w, name)


for _t in checks.TABLES:
    query(f"dq_table_{_t}")(_table_checks(_t))


@query("dq_dirty_lines")
def dq_dirty_lines(w: Warehouse) -> DataFrame:
    """Checks on the typed but unfiltered lines, which do fail."""
    return quality.run_checks("raw_lines", staging.typed_lines(w.raw_lines()), [
        quality.not_null("date_mutation"), quality.not_null("type_local"),
        quality.accepted_values("nature_mutation", [K.SALE_NATURE]),
        quality.accepted_range("valeur_fonciere", 0, inclusive=False),
        quality.accepted_range("surface_reelle_bati", K.MIN_DWELLING_M2, 45, severity="warn"),
        quality.unique("id_mutation"),
        quality.unique("id_mutation", "id_parcelle", "nombre_pieces"),
    ])


@source_query("dq_relationship")
def dq_relationship(spark: SparkSession, sf: str) -> DataFrame:
    """Orders without a line and lines without an order."""
    orders, lines = standin.table(spark, sf, "orders"), standin.table(spark, sf, "lineitem")
    return quality.run_checks(
        "orders", orders, [quality.relationship("o_orderkey", lines, "l_orderkey")]
    ).unionByName(quality.run_checks(
        "lineitem", lines, [quality.relationship("l_orderkey", orders, "o_orderkey")]))


@query("dq_coverage")
def dq_coverage(w: Warehouse) -> DataFrame:
    return tidy(checks.coverage_shares(w))


@query("dq_coverage_failures")
def dq_coverage_failures(w: Warehouse) -> DataFrame:
    return tidy(checks.coverage_failures(w, minimum=0.99))


@source_query("dq_freshness")
def dq_freshness(spark: SparkSession, sf: str) -> DataFrame:
    events = standin.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("string"))
    now = F.lit("2024-03-10 00:00:00").cast("timestamp")
    return tidy(quality.freshness(
        events, "ts", now, K.FRESHNESS_WARN_DAYS, K.FRESHNESS_ERROR_DAYS
    ).select("age_jours", "status"), 3)


@query("dq_gate")
def dq_gate(w: Warehouse) -> DataFrame:
    return quality.landing_gate(w.raw_lines(), w.departments(), K.MIN_RAW_ROWS)


@query("landing_volumes")
def landing_volumes(w: Warehouse) -> DataFrame:
    return quality.landing_volumes(w.raw_lines())


def _profile(name: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: checks.profile(w.raw_lines())[name]


for _p in ["volumetrie", "taux_nuls", "multi_lots", "types", "suspects"]:
    query(f"profile_{_p}")(_profile(_p))


# ---- landing -----------------------------------------------------------------------------

def _scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared folder, gone when the application ends."""
    path = f"{shared_folder(spark)}/scratch/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)
    delete_at_end(spark, path)
    return path


@query("csv_by_name_union")
def csv_by_name_union(w: Warehouse) -> DataFrame:
    """Raw lines written as compressed CSV under three different headers, then landed by name.

    Departments without a layout of their own, and lines without one, go with the plain layout.
    """
    raw = w.raw_lines()
    folder = _scratch(w.store.spark, "csv")
    dep = F.coalesce("code_departement", F.lit(""))
    columns = raw.columns
    layouts = {
        "plain": (~dep.isin("2", "3", "4"), raw),
        "shuffled": (dep.isin("2", "3"), raw.select(
            *reversed(columns), F.lit("x").alias("section_prefixe"))),
        "short": (dep == "4", raw.drop("nombre_lots")),
    }
    for name, (rows, df) in layouts.items():
        df.filter(rows).write.option("header", True).option("compression", "gzip").csv(
            f"{folder}/{name}")
    landed = landing.land_sales(w.store.spark, [f"{folder}/{n}" for n in layouts])
    return landed.drop(*landing.PROVENANCE)


@source_query("incremental_landing")
def incremental_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Events dropped as files in two deliveries under two headers; each run of the stream lands the
    unseen files."""
    folder, target = (f"{_scratch(spark, name)}/files" for name in ("inbox", "landed"))
    columns = ["event_id", "ts", "user_id", "event_type"]
    events = standin.table(spark, sf, "events").select(*columns)
    texts = events.withColumn("ts", F.col("ts").cast("string"))
    early = F.coalesce(F.col("ts") < "2024-01-16", F.lit(False))
    for delivery in (texts.filter(early), texts.filter(~early).select(
            *reversed(columns), F.lit("second").alias("origin"))):
        delivery.write.mode("append").option("header", True).csv(folder)
        incremental.land_new_files(spark, folder, columns, target)
    return spark.read.parquet(target).select(
        F.col("event_id").cast("bigint"), F.col("ts").cast("timestamp"),
        F.col("user_id").cast("bigint"), "event_type")


@query("file_manifest_diff")
def file_manifest_diff(w: Warehouse) -> DataFrame:
    """Files of the last year are new, those of one department were republished, one is gone."""
    lines = w.lines().withColumn("annee", F.year("date_mutation"))
    remote = lines.groupBy("annee", "code_departement").agg(
        F.max("date_mutation").cast("string").alias("last_modified"),
        F.count("*").cast("string").alias("content_length"),
    ).withColumns({
        "file": F.concat_ws("_", "annee", "code_departement"),
        "etag": F.when(F.col("code_departement") == "3", "").otherwise("e"),
    })
    length = F.when(F.col("code_departement") == "2", F.lit("0")).otherwise(
        F.col("content_length"))
    stored = remote.filter("annee < 2001").withColumn("content_length", length)
    known = remote.filter("NOT (annee = 1996 AND code_departement = '1')")
    return landing.manifest_diff(stored, known)


@source_query("scope_files")
def scope_files(spark: SparkSession, sf: str) -> DataFrame:
    """Published years discovered from a listing, crossed with the departments in scope."""
    listing = standin.table(spark, sf, "orders").select(
        F.concat(F.lit("/csv/"), F.year("o_orderdate").cast("string"), F.lit("/")).alias("href"))
    return landing.wanted_files(landing.discover_years(listing), standin.run(
        spark, sf, standin.SEED))


@source_query("json_flatten")
def json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Two-level aggregation documents, one per user, with at most one entry per event type."""
    events = standin.table(spark, sf, "events")
    counts = events.groupBy("user_id", "event_type").agg(F.count("*").alias("total"))
    inner = F.collect_list(F.struct(F.col("event_type").alias("value"), "total"))
    outer = counts.groupBy("user_id").agg(inner.alias("aggs")).select(F.to_json(F.struct(
        F.array(F.struct(F.col("user_id").cast("string").alias("value"), "aggs")).alias("aggs"),
    )).alias("value"))
    return landing.flatten_energy(outer)


@source_query("json_files")
def json_files(spark: SparkSession, sf: str) -> DataFrame:
    """The same counts as documents of many users each, one document a file, landed from their folder."""
    folder = f"{_scratch(spark, 'json')}/files"
    counts = standin.table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("total"))
    inner = F.collect_list(F.struct(F.col("event_type").alias("value"), "total"))
    users = counts.groupBy("user_id").agg(inner.alias("aggs"))
    part = F.pmod(F.col("user_id"), F.lit(40)).alias("part")
    documents = users.groupBy(part).agg(F.to_json(F.struct(F.collect_list(F.struct(
        F.col("user_id").cast("string").alias("value"), "aggs")).alias("aggs"))).alias("value"))
    documents.write.partitionBy("part").text(folder)
    return landing.read_energy(spark, folder)


@query("semicolon_csv")
def semicolon_csv(w: Warehouse) -> DataFrame:
    """Station lines as a published file, with semicolons and a point as text, and landed from it."""
    folder = f"{_scratch(w.store.spark, 'stations')}/file"
    point = F.concat(F.coalesce("latitude", F.lit("")), F.lit(", "), F.coalesce("longitude", F.lit("")))
    published = w.inputs.stations().select("nom_gares", "mode", "res_com", point.alias("geo_point_2d"), F.lit("x").alias("autre"))
    published.write.option("header", True).option("sep", ";").option("ignoreTrailingWhiteSpace", False).csv(folder)
    return landing.read_stations(w.store.spark, folder)


@source_query("income_of_departments")
def income_of_departments(spark: SparkSession, sf: str) -> DataFrame:
    """Customers laid out like the published income file, found by keywords, two departments of them."""
    folder = f"{_scratch(spark, 'income')}/file"
    customers = standin.table(spark, sf, "customer")
    text = lambda c: F.col(c).cast("string")
    customers.select(
        F.lpad(text("c_custkey"), 5, "0").alias("Code géographique"), F.col("c_name").alias("Libellé géographique"),
        text("c_nationkey").alias("[DISP] Nbre de ménages fiscaux"), text("c_custkey").alias("[DISP] Médiane (€)"),
        text("c_nationkey").alias("[DISP] 1er décile (€)"), text("c_custkey").alias("[DISP] 9e décile (€)"),
        F.col("c_mktsegment").alias("[DISP] Part des pensions (%)"),
    ).write.option("header", True).option("sep", ";").csv(folder)
    return landing.read_income(spark, folder, ["00", "01"], "https://example.org/filo-2021.csv")


@query("landing_provenance")
def landing_provenance(w: Warehouse) -> DataFrame:
    """Lines of one department landed from compressed files: all name their file and the time of loading."""
    folder = f"{_scratch(w.store.spark, 'provenance')}/files"
    w.raw_lines().filter("code_departement = '4'").write.option("header", True).option("compression", "gzip").csv(folder)
    return landing.land_sales(w.store.spark, folder).agg(
        F.count("*").alias("lignes"), F.count_if(F.col("_source_file").rlike(r"^part-.*\.csv\.gz$")).alias("fichier_nomme"),
        F.count_if(F.col("_loaded_at").try_cast("timestamp").isNotNull()).alias("date_de_charge"))


@query("reference_counts")
def reference_counts(w: Warehouse) -> DataFrame:
    """Rows of every reference table after its reload."""
    tables = {"stations": w.inputs.stations(), "projets": w.inputs.planned(), "energie": w.inputs.energy(),
              "departements": w.departments()}
    counts = landing.load_references(tables, _scratch(w.store.spark, "references"))
    return w.store.spark.createDataFrame(list(counts.items()), "reference string, lignes bigint")


@source_query("json_latest_resource")
def json_latest_resource(spark: SparkSession, sf: str) -> DataFrame:
    """Most recent CSV resource per catalogue; the key inside ``props`` makes the format."""
    events = standin.table(spark, sf, "events")
    key = F.get_json_object("props", "$.k").cast("int")
    resources = events.select(
        "event_type",
        F.when(key % 3 == 0, "csv").when(key % 3 == 1, "CSV").otherwise("xlsx").alias("format"),
        F.concat(F.lit("https://example.org/"), (2015 + key % 10).cast("string"), F.lit("/"),
                 F.col("event_id").cast("string")).alias("url"),
        F.when(key % 7 == 0, None).otherwise(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("last_modified"))
    return landing.latest_csv_resource(resources, ["event_type"]).withColumn(
        "millesime", C.vintage("url"))


@source_query("split_point")
def split_point(spark: SparkSession, sf: str) -> DataFrame:
    """Points as text; some are missing and some hold a latitude only."""
    key = F.col("c_custkey")
    text = F.when(key % 11 == 0, None).when(key % 13 == 0, F.lit("48.5")).otherwise(
        F.concat((key % 90).cast("string"), F.lit(".25 ,  "), (key % 7).cast("string"),
                 F.lit(".5, x")))
    customers = standin.table(spark, sf, "customer").select(
        "c_custkey", text.alias("geo_point_2d"))
    return landing.with_point(customers).drop("geo_point_2d")


@source_query("keyword_columns")
def keyword_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns found by keywords in accented, punctuated headers."""
    c = F.col
    headers = standin.table(spark, sf, "customer").select(
        c("c_custkey").cast("string").alias("Code géographique"),
        c("c_name").alias("Libellé géographique"),
        c("c_nationkey").alias("[DISP] Nbre de ménages fiscaux"),
        c("c_acctbal").alias("[DISP] Médiane (€)"),
        (c("c_acctbal") + 1).alias("[DEC] Médiane (€)"),
        (c("c_nationkey") + 1).alias("[DISP] 1er décile (€)"),
        (c("c_nationkey") + 2).alias("[DISP] 9e décile (€)"),
        c("c_mktsegment").alias("[DISP] Part des pensions, retraites et rentes (%)"))
    return landing.by_keywords(headers, K.INCOME_KEYWORDS)


@query("run_log")
def run_log(w: Warehouse) -> DataFrame:
    row = landing.run_log_row("run-1", "2001-12-31", w.raw_lines(), w.fact(), w.gaps())
    path = _scratch(w.store.spark, "run_log") + "/log"
    landing.append_run_log(row, path)
    return w.store.spark.read.parquet(path).drop("finished_at")


# ---- models ------------------------------------------------------------------------------

def _training(w: Warehouse) -> DataFrame:
    return w.store.table("training", lambda: model.training_set(w.fact(), w.places()))


@query("training_set")
def training_set(w: Warehouse) -> DataFrame:
    return tidy(model.training_set(w.fact(), w.places()))


@query("temporal_split")
def temporal_split(w: Warehouse) -> DataFrame:
    return model.temporal_split(_training(w)).groupBy("part").agg(
        F.count("*").alias("n"), F.min("annee").alias("de"), F.max("annee").alias("a"))


def _with_baseline(w: Warehouse) -> DataFrame:
    split = model.temporal_split(_training(w))
    return model.baseline(split.filter("part = 'train'"), split.filter("part != 'train'"))


@query("baseline_fallback")
def baseline_fallback(w: Warehouse) -> DataFrame:
    return tidy(_with_baseline(w).select(
        "transaction_id", "part", "prix_m2", "prediction_baseline"))


@query("regression_metrics")
def regression_metrics(w: Warehouse) -> DataFrame:
    return model.regression_metrics(_with_baseline(w), "prix_m2", "prediction_baseline", ["part"])


@query("segment_errors")
def segment_errors(w: Warehouse) -> DataFrame:
    test = _with_baseline(w).filter("part = 'test'")
    return tidy(model.segment_errors(test, "prediction_baseline", "code_departement"))


@query("gap_pct")
def gap_pct(w: Warehouse) -> DataFrame:
    return w.predictions()


@query("leave_one_group_out_mean")
def leave_one_group_out_mean(w: Warehouse) -> DataFrame:
    rows = _training(w).select("transaction_id", "annee", "code_commune", "type_bien", "prix_m2")
    return tidy(model.leave_one_group_out_mean(
        rows, ["code_commune", "type_bien"], F.log("prix_m2")))


def _demeaned(w: Warehouse) -> DataFrame:
    return _training(w).select(
        "transaction_id", "code_commune", F.log("surface_habitable").alias("x"), "y")


@query("group_demean")
def group_demean(w: Warehouse) -> DataFrame:
    return tidy(hedonic.demean(_demeaned(w), "code_commune", ["x", "y"]))


@query("within_slope")
def within_slope(w: Warehouse) -> DataFrame:
    return tidy(hedonic.within_slope(
        _training(w), "code_commune", F.log("surface_habitable"), F.col("y"), ["type_bien"]
    ).select("type_bien", "pente", "n", "groupes"))


@query("cluster_se_1d")
def cluster_se_1d(w: Warehouse) -> DataFrame:
    return tidy(hedonic.within_slope(
        _training(w), "code_commune", F.log("surface_habitable"), F.col("y"), ["type_bien"]
    ).select("type_bien", "erreur_standard"))


def _station_sales(w: Warehouse) -> DataFrame:
    return station_effect.station_sales(w.fact(), w.places())


@query("hedonic_segments")
def hedonic_segments(w: Warehouse) -> DataFrame:
    return station_effect.comparable_segments(_station_sales(w))


@query("hedonic_full")
def hedonic_full(w: Warehouse) -> DataFrame:
    return tidy(station_effect.station_effect(_station_sales(w)))


@query("hedonic_equations")
def hedonic_equations(w: Warehouse) -> DataFrame:
    return tidy(station_effect.station_equations(_station_sales(w)), 5)


@query("hedonic_report")
def hedonic_report(w: Warehouse) -> DataFrame:
    return station_effect.station_effect_report(_station_sales(w))


@query("ablation")
def ablation(w: Warehouse) -> DataFrame:
    """Boosted trees with and without enrichment against the baseline."""
    return boosted.evaluate_models(_training(w), fitted=_split_model(w))[0]


_FITTED: dict[str, PipelineModel] = {}


def _split_model(w: Warehouse) -> PipelineModel:
    """The enriched model of the temporal split, fitted once per warehouse."""
    if w.store.root not in _FITTED:
        split = model.temporal_split(_training(w))
        _FITTED[w.store.root] = boosted.fit_boosted(
            split.filter("part = 'train'"), boosted.ENRICHED, split.filter("part = 'valid'"))
    return _FITTED[w.store.root]


@query("importance")
def importance(w: Warehouse) -> DataFrame:
    return boosted.importance(_split_model(w), boosted.ENRICHED)


def _out_of_sample(w: Warehouse) -> DataFrame:
    return w.store.table("out_of_sample", lambda: boosted.out_of_sample(
        _training(w), boosted.retained_trees(_split_model(w))))


@query("out_of_sample_metrics")
def out_of_sample_metrics(w: Warehouse) -> DataFrame:
    """Errors over all years, each predicted by a model that has not seen it."""
    return boosted.out_of_sample_metrics(_out_of_sample(w))


@query("prediction_checks")
def prediction_checks(w: Warehouse) -> DataFrame:
    return boosted.prediction_checks(
        _training(w), _out_of_sample(w), boosted.importance(_split_model(w), boosted.ENRICHED))


@query("gbt_model")
def gbt_model(w: Warehouse) -> DataFrame:
    """Out-of-sample predictions of the boosted trees, one year left out at a time."""
    return _out_of_sample(w)
