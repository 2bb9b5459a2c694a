"""Marts over the star: gaps to the expected price and evolution by distance to planned stations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastria.functions import columns as C
from cadastria.functions import constants as K
from cadastria.operators.quantiles import approx_quantiles, exact_quantiles
from cadastria.session import join_on

GAP_COLUMNS = [
    "transaction_id", "date_key", "geo_key", "bien_key", "date_mutation", "type_bien",
    "surface_habitable", "valeur_fonciere", "prix_m2", "prix_m2_predit", "ecart_pct",
    "positionnement_prix",
]


def price_gaps(fact: DataFrame, predictions: DataFrame) -> DataFrame:
    return fact.join(predictions, "transaction_id").withColumn(
        "positionnement_prix", C.market_position("ecart_pct")).select(*GAP_COLUMNS)


def located_fact(fact: DataFrame, places: DataFrame, columns: list[str]) -> DataFrame:
    """Inner star join that adds place columns; the fact's own department gives way."""
    own = [c for c in fact.columns if c not in columns]
    return fact.select(*own).join(
        places.select("geo_key", *columns), "geo_key")


def planned_band_evolution(fact: DataFrame, places: DataFrame,
                           city_department: str = K.CITY_DEPARTMENT,
                           approx: bool = False) -> DataFrame:
    """Yearly median per zone, type and band, and its change since the first year of the series."""
    keys = ["annee", "zone", "type_bien", "tranche_dist_gpe"]
    kept = located_fact(fact, places, ["zone"]).filter(
        F.col("est_prix_m2_fiable")
        & (F.col("code_departement") != city_department)
        & F.col("type_bien").isin(K.DWELLINGS)
        & F.col("tranche_dist_gpe").isNotNull()
    ).withColumn("annee", F.year("date_mutation"))
    spec = {"prix_m2_median": (F.col("prix_m2"), 0.5)}
    medians = (approx_quantiles(kept, keys, spec) if approx
               else exact_quantiles(kept, keys, spec, bounded=True))
    counts = kept.groupBy(*keys).agg(F.count("*").alias("nb_ventes"))
    series = Window.partitionBy(*keys[1:]).orderBy("annee")  # one row per year
    change = (F.col("prix_m2_median") / F.first("prix_m2_median").over(series) - 1) * 100
    return join_on(counts, medians, keys).withColumn(
        "evolution_depuis_debut_pct", C.round_half_away(change, 1))
