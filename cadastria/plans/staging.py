"""Typed and cleaned inputs, one function per source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastria.functions import columns as C
from cadastria.functions import constants as K

_OPTIONAL = ["adresse_numero", "adresse_nom_voie"]


def typed_lines(raw: DataFrame) -> DataFrame:
    c = F.col
    blanks = [*_OPTIONAL, "code_postal", "code_commune", "nom_commune", "code_departement"]
    present = [b for b in blanks if b in raw.columns]
    return raw.select(
        "id_mutation",
        C.safe_date("date_mutation").alias("date_mutation"),
        "nature_mutation",
        C.safe_float("valeur_fonciere").alias("valeur_fonciere"),
        *[C.blank_to_null(b).alias(b) for b in present],
        "id_parcelle",
        C.safe_int("nombre_lots").alias("nombre_lots"),
        C.blank_to_null("type_local").alias("type_local"),
        C.safe_float("surface_reelle_bati").alias("surface_reelle_bati"),
        C.safe_int("nombre_pieces_principales").alias("nombre_pieces"),
        *[C.safe_float(n).alias(n) for n in ("surface_terrain", "longitude", "latitude")],
    ).select(*[c(n) for n in _line_order(present)])


def _line_order(present: list[str]) -> list[str]:
    order = [
        "id_mutation", "date_mutation", "nature_mutation", "valeur_fonciere", "adresse_numero",
        "adresse_nom_voie", "code_postal", "code_commune", "nom_commune", "code_departement",
        "id_parcelle", "nombre_lots", "type_local", "surface_reelle_bati", "nombre_pieces",
        "surface_terrain", "longitude", "latitude",
    ]
    return [n for n in order if n not in _OPTIONAL or n in present]


def sale_lines(raw: DataFrame) -> DataFrame:
    """Valid sales only: known date, price above zero, plain sale."""
    return typed_lines(raw).filter(
        F.col("date_mutation").isNotNull()
        & (F.col("valeur_fonciere") > 0)
        & (F.col("nature_mutation") == K.SALE_NATURE)
    )


def _located(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "latitude": C.safe_float("latitude"), "longitude": C.safe_float("longitude"),
    }).filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).withColumns({
        "lat_r": C.round_half_away("latitude", 3), "lon_r": C.round_half_away("longitude", 3),
    })


def stations(raw: DataFrame) -> DataFrame:
    """One row per physical station: same name, same place to about 100 m."""
    lines = _located(raw.select(
        F.trim("nom_gares").alias("nom_gare"), F.upper(F.trim("mode")).alias("mode"),
        F.trim("res_com").alias("ligne"), "latitude", "longitude",
    ))
    mode = F.col("mode")
    heaviest = F.coalesce(
        *[F.when(F.bool_or(mode == m), F.lit(m)) for m in K.MODE_PRIORITY], F.min(mode))
    return lines.groupBy("nom_gare", "lat_r", "lon_r").agg(
        heaviest.alias("mode_principal"),
        F.bool_or(mode.isin(K.HEAVY_MODES)).alias("est_transport_lourd"),
        F.sort_array(F.collect_set("ligne")).alias("_lines"),
        C.exact_avg("latitude").alias("latitude"), C.exact_avg("longitude").alias("longitude"),
    ).select(
        C.station_key("nom_gare", "lat_r", "lon_r").alias("gare_id"), "nom_gare",
        "mode_principal", "est_transport_lourd",
        F.nullif(F.array_join("_lines", ", "), F.lit("")).alias("lignes"),
        F.size("_lines").cast("bigint").alias("nb_lignes"), "latitude", "longitude",
        C.point("longitude", "latitude").alias("geog"),
    )


def planned_stations(raw: DataFrame) -> DataFrame:
    lines = _located(
        raw.select(
            F.trim("nom_arret").alias("nom_gare"), F.trim("nom_projet").alias("projet"),
            F.lower(F.trim("mode")).alias("mode"), C.safe_int("phase").alias("phase"),
            F.trim("statut").alias("statut"), "latitude", "longitude",
        ).filter(F.col("mode") != K.EXCLUDED_PLANNED_MODE)
    )
    metro = F.lower("projet").rlike(K.PLANNED_METRO_PATTERN)
    return lines.groupBy("nom_gare", "lat_r", "lon_r").agg(
        F.sort_array(F.collect_set("projet")).alias("_projects"),
        F.min("mode").alias("mode"), F.bool_or(metro).alias("est_grand_paris_express"),
        F.min("phase").alias("phase"), F.min("statut").alias("statut"),
        C.exact_avg("latitude").alias("latitude"), C.exact_avg("longitude").alias("longitude"),
    ).select(
        C.station_key("nom_gare", "lat_r", "lon_r").alias("gare_projet_id"), "nom_gare",
        F.nullif(F.array_join("_projects", ", "), F.lit("")).alias("projets"), "mode",
        "est_grand_paris_express", "phase", "statut", "latitude", "longitude",
        C.point("longitude", "latitude").alias("geog"),
    )


def income(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("code_commune").isNotNull()).select(
        F.trim("code_commune").alias("code_commune"),
        F.trim("libelle_commune").alias("libelle_commune"),
        C.safe_int("nb_menages").alias("nb_menages_fiscaux"),
        C.safe_float("revenu_median").alias("revenu_median_uc"),
        C.safe_float("revenu_d1").alias("revenu_d1_uc"),
        C.safe_float("revenu_d9").alias("revenu_d9_uc"),
        C.safe_float("part_pensions_pct").alias("part_pensions_pct"),
        C.safe_int("millesime").alias("millesime_revenus"),
    )


def energy(raw: DataFrame) -> DataFrame:
    """The count is cast the hard way: a dirty count must fail the job."""
    label = F.upper(F.trim("etiquette_dpe"))
    kept = raw.filter(label.isin(K.ENERGY_LABELS)).select(
        F.trim("code_commune").alias("code_commune"), label.alias("etiquette"),
        F.col("nb_dpe").cast("bigint").alias("nb_dpe"),
    )
    good = F.sum(F.when(F.col("etiquette").isin(K.ENERGY_GOOD), F.col("nb_dpe")).otherwise(0))
    bad = F.sum(F.when(F.col("etiquette").isin(K.ENERGY_BAD), F.col("nb_dpe")).otherwise(0))
    return kept.groupBy("code_commune").agg(
        F.sum("nb_dpe").alias("nb_dpe"), good.alias("nb_dpe_ab"), bad.alias("nb_dpe_fg"),
    ).select(
        "*",
        C.share_pct(F.col("nb_dpe_fg"), F.col("nb_dpe")).alias("part_dpe_fg_pct"),
        C.share_pct(F.col("nb_dpe_ab"), F.col("nb_dpe")).alias("part_dpe_ab_pct"),
    )
