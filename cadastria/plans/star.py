"""Dimensions and the sales fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastria.functions import columns as C
from cadastria.functions import constants as K
from cadastria.operators.grouping import majority_value
from cadastria.operators.proximity import nearest_site, within_radius

_POINT = ["lat_k", "lon_k"]  # ten-thousandths of a degree, about 10 m


def calendar(lines: DataFrame, as_of: Column, start: str | None = None,
             end: str | None = None) -> DataFrame:
    """Every day from the first January of the data to the last December of data or ``as_of``."""
    bounds = lines.agg(F.min("date_mutation").alias("lo"), F.max("date_mutation").alias("hi"))
    first = F.lit(start).cast("date") if start else F.trunc("lo", "year").cast("date")
    last = F.lit(end).cast("date") if end else F.make_date(
        F.year(F.greatest("hi", as_of)), F.lit(12), F.lit(31))
    d = F.col("date")
    return bounds.select(F.explode(F.sequence(first, last)).alias("date")).select(
        C.date_key("date").alias("date_key"), "date",
        F.year(d).alias("annee"), F.quarter(d).alias("trimestre"),
        F.concat(F.date_format(d, "yyyy-'T'"), F.quarter(d).cast("string")).alias("annee_trimestre"),
        F.month(d).alias("mois"), F.date_format(d, "yyyy-MM").alias("annee_mois"),
        F.element_at(F.array(*[F.lit(m) for m in K.MONTH_NAMES]), F.month(d)).alias("nom_mois"),
        F.when(F.month(d) <= 6, 1).otherwise(2).alias("semestre"),
        F.weekofyear(d).alias("semaine_iso"), F.dayofweek(d).isin(1, 7).alias("est_weekend"),
    )


def places(sales: DataFrame, departments: DataFrame, income: DataFrame,
           energy: DataFrame) -> DataFrame:
    """One row per commune, with its majority name and postcode, centroid and context."""
    known = sales.filter(F.col("code_commune").isNotNull())
    named = majority_value(
        known, ["code_commune"], ["nom_commune", "code_postal", "code_departement"])
    located = known.groupBy("code_commune").agg(
        C.exact_avg("latitude").alias("latitude"), C.exact_avg("longitude").alias("longitude"),
    )
    return (
        named.join(located, "code_commune")
        .join(departments, "code_departement", "left")
        .join(income, "code_commune", "left")
        .join(energy, "code_commune", "left")
        .select(
            F.col("code_commune").alias("geo_key"), "code_commune", "nom_commune",
            F.col("code_postal").alias("code_postal_principal"), "code_departement",
            "nom_departement", "zone", "latitude", "longitude",
            C.point("longitude", "latitude").alias("centroide"),
            "revenu_median_uc", "revenu_d1_uc", "revenu_d9_uc",
            C.round_half_away(F.try_divide("revenu_d9_uc", "revenu_d1_uc"), 2)
            .alias("rapport_d9_d1"),
            "nb_menages_fiscaux", "millesime_revenus", "nb_dpe", "part_dpe_fg_pct",
            "part_dpe_ab_pct",
        )
    )


def segment_columns(df: DataFrame) -> DataFrame:
    classed = df.withColumns({
        "classe_pieces": C.room_class("nb_pieces", "type_bien"),
        "tranche_surface": C.surface_band("surface_habitable"),
    })
    return classed.withColumn(
        "bien_key", C.surrogate_key("type_bien", "classe_pieces", "tranche_surface"))


def segments(sales: DataFrame) -> DataFrame:
    return segment_columns(sales).select(
        "bien_key", "type_bien", "classe_pieces", "tranche_surface"
    ).distinct().withColumn("est_logement", F.col("type_bien").isin(K.DWELLINGS))


def _with_point(sales: DataFrame) -> DataFrame:
    return sales.withColumns({
        "lat_k": F.floor(F.abs("latitude") * 1e4 + 0.5) * F.signum("latitude").cast("bigint"),
        "lon_k": F.floor(F.abs("longitude") * 1e4 + 0.5) * F.signum("longitude").cast("bigint"),
    })


def distinct_points(sales: DataFrame) -> DataFrame:
    located = sales.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return _with_point(located.select("latitude", "longitude")).select(*_POINT).distinct().select(
        *_POINT, (F.col("lat_k") / 1e4).alias("lat_r"), (F.col("lon_k") / 1e4).alias("lon_r"))


def station_pairs(points: DataFrame, stations: DataFrame,
                  radius_m: float = K.STATION_RADIUS_M) -> DataFrame:
    heavy = stations.filter("est_transport_lourd").select(
        F.col("nom_gare").alias("gare_proche"), F.col("mode_principal").alias("mode_gare_proche"),
        F.col("latitude").alias("s_lat"), F.col("longitude").alias("s_lon"))
    return within_radius(points, heavy, radius_m, ("lat_r", "lon_r"), ("s_lat", "s_lon"))


def planned_pairs(points: DataFrame, planned: DataFrame,
                  radius_m: float = K.PLANNED_RADIUS_M) -> DataFrame:
    metro = planned.filter("est_grand_paris_express").select(
        F.col("nom_gare").alias("gare_gpe_proche"),
        F.col("latitude").alias("s_lat"), F.col("longitude").alias("s_lon"))
    return within_radius(points, metro, radius_m, ("lat_r", "lon_r"), ("s_lat", "s_lon"))


def point_proximity(points: DataFrame, stations: DataFrame, planned: DataFrame) -> DataFrame:
    """Nearest station, stations within a kilometre and nearest planned station per point.

    Beyond the radius the distance is capped at the radius: 'at least that far'.
    """
    near = nearest_site(station_pairs(points, stations), _POINT, "gare_proche",
                        ["mode_gare_proche"], K.NEAR_STATION_M)
    plan = nearest_site(planned_pairs(points, planned), _POINT, "gare_gpe_proche", [])
    near = near.withColumnsRenamed({"distance_m": "d_gare", "nb_sites_near": "n_near"})
    plan = plan.withColumnRenamed("distance_m", "d_gpe")
    return points.join(near, _POINT, "left").join(plan, _POINT, "left").select(
        *_POINT,
        C.round_half_away(F.coalesce("d_gare", F.lit(float(K.STATION_RADIUS_M)))).alias(
            "dist_gare_m"),
        "gare_proche", "mode_gare_proche",
        F.coalesce("n_near", F.lit(0)).alias("nb_gares_1km"),
        C.round_half_away(F.coalesce("d_gpe", F.lit(float(K.PLANNED_RADIUS_M)))).alias(
            "dist_gpe_m"),
        "gare_gpe_proche",
    )


PROXIMITY_COLUMNS = ["dist_gare_m", "gare_proche", "mode_gare_proche", "nb_gares_1km",
                     "dist_gpe_m", "gare_gpe_proche"]


def proximity(sales: DataFrame, points: DataFrame) -> DataFrame:
    """Proximity of every located sale. A building with very many sales is a hot join key; Spark
    broadcasts the point table when it is small and splits skewed partitions when it is not."""
    located = sales.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return _with_point(located.select("id_mutation", "latitude", "longitude")).join(
        points, _POINT, "left").select("id_mutation", *PROXIMITY_COLUMNS)


FACT_COLUMNS = [
    "transaction_id", "date_key", "geo_key", "bien_key", "date_mutation", "code_departement",
    "type_bien", "valeur_fonciere", "surface_habitable", "surface_terrain", "nb_pieces",
    "nb_appartements", "nb_maisons", "nb_dependances", "nb_locaux_activite", "nb_parcelles",
    "nombre_lots", "prix_m2", "est_vente_simple", "est_prix_m2_fiable", "latitude", "longitude",
    "dist_gare_m", "gare_proche", "mode_gare_proche", "nb_gares_1km", "tranche_dist_gare",
    "dist_gpe_m", "gare_gpe_proche", "tranche_dist_gpe", "nb_lignes_source",
]


def priced_sales(sales: DataFrame) -> DataFrame:
    priced = sales.withColumn(
        "prix_m2", C.price_per_m2("est_vente_simple", "valeur_fonciere", "surface_habitable"))
    return priced.withColumn("est_prix_m2_fiable", C.reliable_price("prix_m2"))


def banded_distances(df: DataFrame) -> DataFrame:
    """Bands of the already rounded distances; an unlocated sale has no band."""
    return df.withColumns({
        "tranche_dist_gare": C.banded("dist_gare_m", K.STATION_BANDS),
        "tranche_dist_gpe": C.banded("dist_gpe_m", K.PLANNED_BANDS),
    })


def fact(sales: DataFrame, proximity_by_sale: DataFrame) -> DataFrame:
    """One row per sale. Unusual prices are flagged, never removed."""
    enriched = priced_sales(segment_columns(sales)).join(proximity_by_sale, "id_mutation", "left")
    return banded_distances(enriched).withColumns({
        "transaction_id": F.col("id_mutation"),
        "date_key": C.date_key("date_mutation"),
        "geo_key": F.col("code_commune"),
    }).select(*FACT_COLUMNS)
