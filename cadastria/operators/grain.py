"""From source lines to one row per sale.

The price is repeated on every line of a sale, units are repeated per land use, and communes may
differ between lines, so each fact about a sale is aggregated at its own grain and the results are
joined on the sale: units, parcels, prices, and the distinct lines themselves. Every branch reads
only its columns and aggregates before it shuffles. The first shuffle of a branch hashes on more
than the sale, so neither a sale with a third of all lines nor a block of exact copies lands in one
task; the second one moves partial aggregates only. All branches end up hashed on the sale, and the
joins need no further shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastria.functions import columns as C
from cadastria.functions import constants as K

_LAST = "\uffff"  # sorts after any code or name

LINE_COLUMNS = [
    "id_mutation", "date_mutation", "valeur_fonciere", "code_postal", "code_commune",
    "nom_commune", "code_departement", "id_parcelle", "nombre_lots", "type_local",
    "surface_reelle_bati", "nombre_pieces", "surface_terrain", "longitude", "latitude",
]
UNIT_COLUMNS = ["id_mutation", "id_parcelle", "type_local", "surface_reelle_bati", "nombre_pieces"]
SALE_COLUMNS = [
    "id_mutation", "date_mutation", "valeur_fonciere", "code_departement", "code_commune",
    "nom_commune", "code_postal", "nb_parcelles", "nombre_lots", "longitude", "latitude",
    "nb_lignes_source", "nb_valeurs_distinctes", "nb_appartements", "nb_maisons",
    "nb_dependances", "nb_locaux_activite", "surface_habitable", "nb_pieces", "surface_terrain",
    "type_bien", "est_vente_simple",
]


def distinct_lines(lines: DataFrame) -> DataFrame:
    """Address columns are left out on purpose: they decide what counts as a repeated line."""
    return lines.select(*LINE_COLUMNS).distinct()


def distinct_units(lines: DataFrame) -> DataFrame:
    """Two real flats with the same parcel, type, surface and rooms collapse into one."""
    return lines.filter(F.col("type_local").isNotNull()).select(*UNIT_COLUMNS).distinct()


def unit_totals(units: DataFrame) -> DataFrame:
    kind = F.col("type_local")
    dwelling = kind.isin(K.DWELLINGS)
    return units.groupBy("id_mutation").agg(
        F.count_if(kind == K.FLAT).alias("nb_appartements"),
        F.count_if(kind == K.HOUSE).alias("nb_maisons"),
        F.count_if(kind == K.OUTBUILDING).alias("nb_dependances"),
        F.count_if(kind.startswith(K.BUSINESS_PREFIX)).alias("nb_locaux_activite"),
        C.exact_sum(F.when(dwelling, F.col("surface_reelle_bati"))).alias("surface_habitable"),
        F.sum(F.when(dwelling, F.col("nombre_pieces"))).alias("nb_pieces"),
    )


def land_totals(lines: DataFrame) -> DataFrame:
    """Largest land surface per parcel, summed over the parcels of the sale."""
    return parcel_totals(lines).select("id_mutation", "surface_terrain")


def parcel_totals(lines: DataFrame) -> DataFrame:
    per_parcel = lines.groupBy("id_mutation", "id_parcelle").agg(
        F.max("surface_terrain").alias("surface_parcelle"))
    return per_parcel.groupBy("id_mutation").agg(
        F.count("id_parcelle").alias("nb_parcelles"),
        C.exact_sum("surface_parcelle").alias("surface_terrain"))


def price_totals(lines: DataFrame) -> DataFrame:
    """A repeated price counts once: the largest is the price of the sale."""
    per_price = lines.select("id_mutation", "valeur_fonciere").distinct()
    return per_price.groupBy("id_mutation").agg(
        F.max("valeur_fonciere").alias("valeur_fonciere"),
        F.count("valeur_fonciere").alias("nb_valeurs_distinctes"))


def _majority_code(name: str) -> Column:
    """Most frequent code, the smallest on ties, a missing one last. The frequency map of a sale
    holds communes or postcodes, which are finite administrative lists."""
    value = F.coalesce(F.col(name), F.lit(_LAST))
    return F.nullif(F.mode(value, deterministic=True), F.lit(_LAST)).alias(name)


def line_totals(distinct: DataFrame) -> DataFrame:
    """What depends on how many distinct lines state it."""
    def mean(name: str) -> Column:
        exact = F.sum(F.col(name).cast("decimal(18,8)")).cast("double")
        return C.ratio(exact, F.count(name)).alias(name)

    return distinct.groupBy("id_mutation").agg(
        F.min("date_mutation").alias("date_mutation"),
        F.min("code_departement").alias("code_departement"),
        _majority_code("code_commune"), _majority_code("nom_commune"),
        _majority_code("code_postal"),
        F.max("nombre_lots").alias("nombre_lots"), mean("longitude"), mean("latitude"),
        F.count("*").alias("nb_lignes_source"),
    )


def sale_grain(lines: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """One row per sale; lines without an id are one sale of their own.

    The id travels as a struct, which groups, hashes and joins like any value when it holds NULL.
    ``keep`` may write the distinct lines and what each branch gives as a table, so that the shuffles
    of one branch are gone before the next one begins.
    """
    c = F.col
    counts = ["nb_appartements", "nb_maisons", "nb_dependances", "nb_locaux_activite"]
    keyed = lines.withColumn("id_mutation", F.struct(c("id_mutation").alias("id")))
    sales = (
        keep(line_totals(keep(distinct_lines(keyed))))
        .join(keep(price_totals(keyed)), "id_mutation", "left")
        .join(keep(parcel_totals(keyed)), "id_mutation", "left")
        .join(keep(unit_totals(distinct_units(keyed))), "id_mutation", "left")
        .withColumns({n: F.coalesce(n, F.lit(0)) for n in counts})
        .withColumn("id_mutation", c("id_mutation.id"))
    )
    return sales.select(
        "*",
        C.sale_class(c("nb_appartements"), c("nb_maisons"), c("nb_locaux_activite"),
                     c("nb_dependances")).alias("type_bien"),
        C.simple_sale(c("nb_appartements"), c("nb_maisons"), c("nb_locaux_activite"),
                      c("nb_valeurs_distinctes"),
                      c("surface_habitable")).alias("est_vente_simple"),
    ).select(*SALE_COLUMNS)
