"""The checks of every table, in build order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastria.functions import columns as C
from cadastria.functions import constants as K
from cadastria.operators import quality as Q
from cadastria.plans.marts import located_fact
from cadastria.plans.measures import Star, secure
from cadastria.plans.warehouse import Warehouse


def _checks(w: Warehouse, name: str) -> list[Q.Check]:
    if name == "lines":
        seed = [r[0] for r in w.departments().select("code_departement").collect()]
        return [
            Q.not_null("id_mutation"), Q.not_null("date_mutation"), Q.not_null("valeur_fonciere"),
            Q.accepted_range("valeur_fonciere", 0, inclusive=False),
            Q.accepted_values("nature_mutation", [K.SALE_NATURE]),
            Q.not_null("code_departement"), Q.accepted_values("code_departement", seed),
        ]
    if name == "sales":
        return [
            Q.unique("id_mutation"), Q.not_null("id_mutation"), Q.not_null("valeur_fonciere"),
            Q.accepted_values("type_bien", K.SALE_CLASSES),
        ]
    if name == "proximity":
        return [
            Q.unique("id_mutation"), Q.not_null("id_mutation"),
            Q.not_null("dist_gare_m"), Q.accepted_range("dist_gare_m", 0, K.STATION_RADIUS_M),
            Q.not_null("nb_gares_1km"),
            Q.not_null("dist_gpe_m"), Q.accepted_range("dist_gpe_m", 0, K.PLANNED_RADIUS_M),
        ]
    if name == "fact":
        return [
            Q.unique("transaction_id"), Q.not_null("transaction_id"),
            Q.not_null("date_key"), Q.relationship("date_key", w.calendar(), "date_key"),
            Q.not_null("geo_key"), Q.relationship("geo_key", w.places(), "geo_key"),
            Q.not_null("bien_key"), Q.relationship("bien_key", w.segments(), "bien_key"),
            Q.accepted_range("valeur_fonciere", 0, inclusive=False),
            Q.accepted_range("prix_m2", 0, inclusive=False, severity="warn"),
            Q.accepted_values("tranche_dist_gare", [b for _, b in K.STATION_BANDS]),
            Q.accepted_values("tranche_dist_gpe", [b for _, b in K.PLANNED_BANDS]),
        ]
    if name == "places":
        return [
            Q.unique("geo_key"), Q.not_null("geo_key"), Q.not_null("zone"),
            Q.accepted_range("revenu_median_uc", 5000, 100000),
            Q.accepted_range("part_dpe_fg_pct", 0, 100),
        ]
    if name == "band_evolution":
        return [
            Q.unique("annee", "zone", "type_bien", "tranche_dist_gpe"),
            Q.not_null("prix_m2_median"), Q.accepted_range("prix_m2_median", 500, 30000),
        ]
    key = KEYS[name]
    return [Q.unique(key), Q.not_null(key)]


KEYS = {"calendar": "date_key", "segments": "bien_key", "predictions": "transaction_id",
        "gaps": "transaction_id", "departments": "code_departement"}
TABLES = ["lines", "sales", "proximity", "fact", "places", "calendar", "segments", "predictions",
          "gaps", "band_evolution", "departments"]


def check_table(w: Warehouse, name: str) -> DataFrame:
    """The report of a table's checks; row checks are counted by the write of the table if that is still to come."""
    found = _checks(w, name)
    marks = Q.row_marks(found)
    w.store.watch(name, marks)
    df = getattr(w, name)()
    return Q.run_checks(name, df, found, w.store.seen(name, len(marks)))


def coverage_shares(w: Warehouse) -> DataFrame:
    """Shares of simple sales with income, energy and transport context."""
    simple = located_fact(
        w.fact(), w.places(), ["revenu_median_uc", "part_dpe_fg_pct"]).filter("est_vente_simple")
    return Q.coverage_shares(simple, {
        "part_revenu": F.col("revenu_median_uc"), "part_dpe": F.col("part_dpe_fg_pct"),
        "part_transports": F.col("dist_gare_m"),
    })


def coverage_failures(w: Warehouse, minimum: float = K.MIN_COVERAGE) -> DataFrame:
    return coverage_shares(w).filter(
        (F.col("part_revenu") < minimum) | (F.col("part_dpe") < minimum)
        | (F.col("part_transports") < minimum))


def role_reconciliation(w: Warehouse) -> DataFrame:
    """Rows seen under every role against the sales counted per zone."""
    star = Star(w.fact(), w.calendar(), w.places(), w.segments())
    seen = None
    for role in K.ZONES:
        part = secure(star, role).fact.agg(F.count("*").alias("vues")).select(
            F.lit(role).alias("zone"), "vues")
        seen = part if seen is None else seen.unionByName(part)
    totals = located_fact(w.fact(), w.places(), ["zone"]).groupBy("zone").agg(
        F.count("*").alias("total"))
    return seen.join(totals, "zone", "left").select(
        "zone", "vues", F.coalesce("total", F.lit(0)).alias("total"),
        (F.col("vues") == F.coalesce("total", F.lit(0))).alias("concorde"))


def profile(raw: DataFrame) -> dict[str, DataFrame]:
    """Profile of the raw text lines."""
    price, surface = F.col("valeur_fonciere"), F.col("surface_reelle_bati")
    missing = price.isNull() | (price == "")
    value, built = C.safe_float(price), C.safe_float(surface)
    return {
        "volumetrie": raw.groupBy("code_departement").agg(F.count("*").alias("n"))
        .orderBy("code_departement"),
        "taux_nuls": raw.agg(F.count_if(missing).alias("nuls"), F.count("*").alias("total"))
        .withColumn("pct_nuls", C.share_pct(F.col("nuls"), F.col("total"), 2)),
        "multi_lots": raw.groupBy(C.safe_int("nombre_lots").alias("nb_lots"))
        .agg(F.count("*").alias("n")).orderBy("nb_lots"),
        "types": raw.groupBy("type_local").agg(F.count("*").alias("n"))
        .withColumn("type_local", F.coalesce("type_local", F.lit("(nul)")))
        .orderBy(F.col("n").desc()),
        "suspects": raw.agg(
            F.count_if(built == 0).alias("surface_zero"),
            F.count_if(built > 1000).alias("surface_gt_1000"),
            F.count_if(value < 1000).alias("valeur_lt_1000"),
            F.count_if(value > 20_000_000).alias("valeur_gt_20m")),
    }


def quality_indicators(w: Warehouse) -> DataFrame:
    """Raw rows, sales, shares of simple and reliable sales, sales left out, sales scored."""
    raw = w.raw_lines().select(F.count("*")).scalar()
    scored = w.gaps().select(F.count("*")).scalar()
    sales, reliable = F.count("*"), F.count_if("est_prix_m2_fiable")
    return w.fact().agg(
        sales.alias("ventes"),
        C.share_pct(F.count_if("est_vente_simple"), sales).alias("part_simples_pct"),
        C.share_pct(reliable, sales).alias("part_fiables_pct"),
        (sales - reliable).alias("ventes_ecartees"),
    ).withColumn("lignes_brutes", raw).withColumn("ventes_scorees", scored)
