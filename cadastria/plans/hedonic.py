"""Effect of the distance to a station on the price, comparing sales of the same commune."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastria.functions import columns as C
from cadastria.functions import constants as K
from cadastria.operators.hedonic import Levels, fixed_effect_ols, normal_equations
from cadastria.plans.marts import located_fact

_SEGMENT = ["zone", "type_bien"]


def station_sales(fact: DataFrame, places: DataFrame) -> DataFrame:
    return located_fact(fact, places, ["zone"]).filter(
        F.col("est_prix_m2_fiable") & F.col("tranche_dist_gare").isNotNull()
        & (F.col("nb_pieces") > 0)
    ).select("prix_m2", "surface_habitable", "nb_pieces", "type_bien", "tranche_dist_gare",
             F.year("date_mutation").alias("annee"), "geo_key", "zone")


def comparable_segments(sales: DataFrame) -> DataFrame:
    """Segments with at least two bands and two communes; the others identify nothing."""
    return sales.groupBy(*_SEGMENT).agg(
        F.count_distinct("tranche_dist_gare").alias("bandes"),
        F.count_distinct("geo_key").alias("communes"),
    ).filter((F.col("bandes") >= 2) & (F.col("communes") >= 2))


def design(years: list[int]) -> tuple[list[Levels], dict[str, Column]]:
    """Band and year dummies and the numeric controls."""
    bands = [label for _, label in K.STATION_BANDS]
    levels = [Levels("tranche_dist_gare", bands, "last"),
              Levels("annee", years, "first", prefix="annee_")]
    return levels, {
        "log_surface": F.log("surface_habitable"),
        "nb_pieces": F.col("nb_pieces"),
        "maison": (F.col("type_bien") == K.HOUSE).cast("int"),
    }


def _compared(sales: DataFrame) -> tuple[DataFrame, list[Levels], dict[str, Column]]:
    """Dwellings of comparable segments and the design for all their years."""
    years = [r[0] for r in sales.select("annee").distinct().orderBy("annee").collect()]
    comparable = comparable_segments(sales).select(*_SEGMENT)
    kept = sales.filter(F.col("type_bien").isin(K.DWELLINGS)).join(
        comparable, _SEGMENT, "left_semi")
    return kept, *design(years)


def station_effect(sales: DataFrame, segment: tuple[str, ...] = tuple(_SEGMENT)) -> DataFrame:
    """All regressors per zone and type; the farthest band present is the reference."""
    kept, levels, numeric = _compared(sales)
    return fixed_effect_ols(kept, list(segment), "geo_key", levels, numeric, F.log("prix_m2"))


def station_equations(sales: DataFrame) -> DataFrame:
    """The normal equations of ``station_effect``, and by how much its coefficients miss them.

    ``reste`` is X'y - X'X b on the rows of the variables in use, NULL elsewhere.
    """
    kept, levels, numeric = _compared(sales)
    products = normal_equations(kept, _SEGMENT, "geo_key", levels, numeric, F.log("prix_m2"))
    effects = fixed_effect_ols(kept, _SEGMENT, "geo_key", levels, numeric, F.log("prix_m2")).select(
        *_SEGMENT, F.col("variable").alias("b"), "coefficient")
    fitted = products.join(effects, [*_SEGMENT, "b"]).groupBy(*_SEGMENT, "a").agg(
        F.sum(F.col("product") * F.col("coefficient")).alias("fitted"))
    used = effects.select(*_SEGMENT, F.col("b").alias("a"), F.lit("y").alias("b"))
    missed = used.join(fitted, [*_SEGMENT, "a"])
    return products.join(missed, [*_SEGMENT, "a", "b"], "left").select(
        *_SEGMENT, F.col("a").alias("terme_a"), F.col("b").alias("terme_b"),
        F.col("product").alias("produit"), (F.col("product") - F.col("fitted")).alias("reste"))


def station_effect_report(sales: DataFrame) -> DataFrame:
    """The published part: band effects in percent with their intervals, rounded."""
    effects = station_effect(sales)
    shown = ["effet_pct", "ic95_bas_pct", "ic95_haut_pct"]
    return effects.filter(F.col("variable").rlike("^[0-9]")).select(
        *_SEGMENT, "variable", *[C.round_half_even(c, 1).alias(c) for c in shown], "n", "groupes"
    ).orderBy(*_SEGMENT, "variable")
