"""Disclosure-controlled extracts and the explorer's computations on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastria.functions import columns as C
from cadastria.functions import constants as K
from cadastria.operators import sketches
from cadastria.operators.quantiles import approx_quantiles, exact_quantiles
from cadastria.plans.marts import located_fact
from cadastria.session import join_on

_PLACE = ["code_commune", "nom_commune", "code_departement", "nom_departement", "zone",
          "latitude", "longitude"]


def _published(rows: DataFrame, keys: list[str], specs: dict, minimum: int, approx: bool,
               bounded: dict[str, bool] | None = None, **more: Column) -> DataFrame:
    """Group counts and quantiles; groups below the minimum are not published."""
    counts = rows.groupBy(*keys).agg(
        F.count("*").alias("nb_ventes"), *[c.alias(n) for n, c in more.items()]
    ).filter(F.col("nb_ventes") >= minimum)
    if approx:
        return join_on(counts, approx_quantiles(rows, keys, specs), keys)
    small = {n: s for n, s in specs.items() if bounded is None or bounded[n]}
    large = {n: s for n, s in specs.items() if n not in small}
    out = join_on(counts, exact_quantiles(rows, keys, small, bounded=True), keys)
    if large:
        out = join_on(out, exact_quantiles(rows, keys, large), keys)
    return out


def place_prices(fact: DataFrame, places: DataFrame, minimum: int = K.MIN_GROUP_SALES,
                 approx: bool = False) -> DataFrame:
    """Quartiles per commune, type and year."""
    rows = fact.filter("est_prix_m2_fiable").select(
        "geo_key", "type_bien", F.year("date_mutation").alias("annee"), "prix_m2",
        "surface_habitable")
    keys = ["geo_key", "type_bien", "annee"]
    price = F.col("prix_m2")
    found = _published(rows, keys, {
        "prix_m2_q1": (price, 0.25), "prix_m2_median": (price, 0.5), "prix_m2_q3": (price, 0.75),
        "surface_mediane": (F.col("surface_habitable"), 0.5),
    }, minimum, approx, {"prix_m2_q1": True, "prix_m2_median": True, "prix_m2_q3": True,
                         "surface_mediane": False})
    # geo_key decides the other place columns, so they are joined after the aggregation
    return found.join(places.select("geo_key", *_PLACE), "geo_key").select(
        *_PLACE, "type_bien", "annee", "nb_ventes", "prix_m2_q1", "prix_m2_median", "prix_m2_q3",
        "surface_mediane")


def band_prices(fact: DataFrame, places: DataFrame, minimum: int = K.MIN_GROUP_SALES,
                approx: bool = False) -> DataFrame:
    """Median per zone, type, year and distance band."""
    rows = located_fact(fact, places, ["zone"]).filter(
        F.col("est_prix_m2_fiable") & F.col("tranche_dist_gare").isNotNull()
    ).withColumn("annee", F.year("date_mutation"))
    keys = ["zone", "type_bien", "annee", "tranche_dist_gare"]
    return _published(rows, keys, {"prix_m2_median": (F.col("prix_m2"), 0.5)}, minimum, approx)


def place_gaps(gaps: DataFrame, places: DataFrame, minimum: int = K.MIN_GROUP_SALES,
               approx: bool = False) -> DataFrame:
    """Spread of the market per commune and type."""
    gap = F.col("ecart_pct")
    found = _published(
        gaps.select("geo_key", "type_bien", "ecart_pct"), ["geo_key", "type_bien"],
        {"ecart_absolu_median_pct": (F.abs(gap), 0.5)}, minimum, approx,
        part_sous_marche_pct=C.share_pct(F.count_if(gap <= -20), F.count("*")),
        part_au_dessus_pct=C.share_pct(F.count_if(gap >= 20), F.count("*")))
    names = ["code_commune", "nom_commune", "code_departement", "zone"]
    return found.join(places.select("geo_key", *names), "geo_key").select(
        *names, "type_bien", "nb_ventes", "ecart_absolu_median_pct", "part_sous_marche_pct",
        "part_au_dessus_pct")


# The quartiles that are published.
QUARTILES = {"q1": 0.25, "mediane": 0.5, "q3": 0.75}


def daily_sketches(fact: DataFrame) -> DataFrame:
    """A sketch of the reliable prices per commune, type and day."""
    return sketches.sketched(fact.filter("est_prix_m2_fiable"),
                             ["code_departement", "geo_key", "type_bien", "date_mutation"], F.col("prix_m2"))


def approximate_quartiles(daily: DataFrame, keys: list[str]) -> DataFrame:
    """Element quartiles of any roll-up of the daily sketches; ``keys`` may use the year (annee)."""
    found = sketches.merged(daily.withColumn("annee", F.year("date_mutation")), keys)
    return found.select(*keys, sketches.count("sketch").alias("nb_ventes"),
                        *[sketches.quantile("sketch", p).alias(name) for name, p in QUARTILES.items()])


def quartile_errors(fact: DataFrame, approximate: DataFrame, keys: list[str]) -> DataFrame:
    """Rank errors of approximate quartiles against all reliable prices."""
    prices = fact.filter("est_prix_m2_fiable").withColumn("annee", F.year("date_mutation")).select(*keys, "prix_m2")
    price, counts = F.col("prix_m2"), [F.count("*").alias("n")]
    for name in QUARTILES:
        counts += [F.count_if(price < F.col(name)).alias(f"{name}_less"), F.count_if(price <= F.col(name)).alias(f"{name}_upto")]
    met = join_on(prices, approximate, keys).groupBy(*keys, "nb_ventes", *QUARTILES).agg(*counts)
    return met.select(*keys, "nb_ventes", *[
        sketches.rank_error(F.col(name), F.col(f"{name}_less"), F.col(f"{name}_upto"), F.col("n"), p).alias(f"{name}_erreur")
        for name, p in QUARTILES.items()])


def export(frames: dict[str, DataFrame], folder: str) -> None:
    """One Parquet folder per extract, in files of the advisory partition size: one file for a small extract."""
    for name, df in frames.items():
        df.hint("rebalance").write.mode("overwrite").parquet(f"{folder}/{name}")


# ---- the explorer ------------------------------------------------------------------------

def filter_prices(prices: DataFrame, kind: str, year: int, zones: list[str]) -> DataFrame:
    return prices.filter(
        (F.col("type_bien") == kind) & (F.col("annee") == year) & F.col("zone").isin(zones))


def filter_gaps(gaps: DataFrame, kind: str, zones: list[str], minimum: int) -> DataFrame:
    return gaps.filter(
        (F.col("type_bien") == kind) & F.col("zone").isin(zones)
        & (F.col("nb_ventes") >= minimum)).orderBy(F.col("ecart_absolu_median_pct").desc())


def latest(prices: DataFrame, keys: list[str]) -> DataFrame:
    """Row of the latest year per group."""
    others = [c for c in prices.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    return prices.groupBy(*keys).agg(F.max_by(row, F.col("annee")).alias("_r")).select(
        *keys, "_r.*")


def price_ranges(prices: DataFrame, surface: Column | float) -> DataFrame:
    """Price range for a surface from the quartiles of the latest year, in whole thousands."""
    m2 = surface if isinstance(surface, Column) else F.lit(float(surface))

    def thousands(c: str) -> Column:
        return C.round_half_even(m2 * F.col(c) / 1000.0, 0) * 1000.0

    return latest(prices, ["code_commune", "type_bien"]).filter(m2 > 0).select(
        "code_commune", "type_bien", "annee", "nb_ventes",
        thousands("prix_m2_q1").alias("bas"), thousands("prix_m2_median").alias("median"),
        thousands("prix_m2_q3").alias("haut"), "prix_m2_median")


def price_range(prices: DataFrame, commune: str, kind: str, surface: float) -> DataFrame:
    """At most one row; none for an unknown commune or a surface of zero."""
    chosen = prices.filter((F.col("code_commune") == commune) & (F.col("type_bien") == kind))
    return price_ranges(chosen, surface)


def yearly_pivot(prices: DataFrame, communes: list[str], kind: str,
                 names: list[str] | None = None) -> DataFrame:
    """Years in rows, the chosen communes in columns; known names spare a pass over the data."""
    chosen = prices.filter(
        (F.col("type_bien") == kind) & F.col("code_commune").isin(communes))
    return chosen.groupBy("annee").pivot("nom_commune", names).agg(
        C.exact_avg("prix_m2_median")).orderBy("annee")


def band_pivot(bands: DataFrame, kind: str, year: int | None = None) -> DataFrame:
    """Distance bands in rows, zones in columns."""
    chosen = bands.filter(F.col("type_bien") == kind)
    if year is not None:
        chosen = chosen.filter(F.col("annee") == year)
    return chosen.groupBy("tranche_dist_gare").pivot("zone", K.ZONES).agg(
        C.exact_avg("prix_m2_median")).orderBy("tranche_dist_gare")


def place_labels(prices: DataFrame, kind: str) -> DataFrame:
    """First year's row per commune with its label, for pick lists."""
    first = Window.partitionBy("code_commune").orderBy("annee")  # a few years per commune
    return prices.filter(F.col("type_bien") == kind).withColumn(
        "_r", F.row_number().over(first)).filter("_r = 1").select(
        "code_commune", "nom_commune", "code_departement", "annee",
        F.concat("nom_commune", F.lit(" ("), "code_departement", F.lit(")")).alias("libelle"),
    ).orderBy("libelle")


def headline(view: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Communes, sales and the median of the communes' medians."""
    keys = ["_all", *(by or [])]
    rows = view.withColumn("_all", F.lit(1))
    counts = rows.groupBy(*keys).agg(
        F.count("*").alias("communes"), F.sum("nb_ventes").alias("ventes"))
    medians = exact_quantiles(rows, keys, {"prix_m2_median": (F.col("prix_m2_median"), 0.5)},
                              bounded=True)
    return join_on(counts, medians, keys).drop("_all")


# ---- published tables --------------------------------------------------------------------

def context_correlation(fact: DataFrame, places: DataFrame, minimum: int = 30) -> DataFrame:
    """Correlation of commune context with the commune's median price, by zone."""
    rows = fact.filter("est_prix_m2_fiable")
    medians = _published(rows.select("geo_key", "prix_m2"), ["geo_key"],
                         {"prix_m2_median": (F.col("prix_m2"), 0.5)}, minimum, False)
    return medians.join(places, "geo_key").groupBy("zone").agg(
        F.count("*").alias("communes"),
        F.corr("revenu_median_uc", "prix_m2_median").alias("corr_revenu"),
        F.corr("part_dpe_fg_pct", "prix_m2_median").alias("corr_dpe_fg"))


def raw_band_gaps(fact: DataFrame, places: DataFrame, kind: str = K.FLAT) -> DataFrame:
    """Median price by zone and distance band, all years together."""
    rows = located_fact(fact, places, ["zone"]).filter(
        F.col("est_prix_m2_fiable") & F.col("tranche_dist_gare").isNotNull()
        & (F.col("type_bien") == kind))
    found = exact_quantiles(rows, ["zone", "tranche_dist_gare"],
                            {"m": (F.col("prix_m2"), 0.5)}, bounded=True)
    labels = [b for _, b in K.STATION_BANDS]
    pivoted = found.groupBy("zone").pivot("tranche_dist_gare", labels).agg(F.max("m"))
    # band labels hold dots and spaces; toDF names the columns without parsing them
    return pivoted.toDF("zone", *[f"bande_{i + 1}" for i in range(len(labels))])
