"""The report pages as measure queries: axes, measures, filters and order of every visual."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastria.functions import constants as K
from cadastria.plans.measures import Context, Star, evaluate, with_totals


@dataclass(frozen=True)
class Report:
    measures: tuple[str, ...]
    context: Context = Context()
    order: tuple[tuple[str, bool], ...] = ()  # column, descending
    totals: bool = False


REPORTS: dict[str, Report] = {
    "r1_departements": Report(
        ("prix_m2_median",), Context(("nom_departement",)), (("prix_m2_median", True),)),
    "r2_trimestres_zones": Report(
        ("prix_m2_median",), Context(("annee_trimestre", "zone")), (("annee_trimestre", False),)),
    "r3_cartes_synthese": Report(
        ("surface_mediane", "nb_ventes", "evolution_prix_m2_12m", "prix_m2_median")),
    "r4_classes_pieces": Report(
        ("prix_m2_median",),
        Context(("classe_pieces",),
                drop={"classe_pieces": [K.ROOMS_UNKNOWN, K.ROOMS_NOT_DWELLING]}),
        (("classe_pieces", False),)),
    "r5_communes": Report(
        ("nb_ventes", "prix_m2_median", "evolution_prix_m2_12m", "surface_mediane",
         "prix_median_vente"),
        Context(("nom_commune", "nom_departement")), (("prix_m2_median", True),)),
    "r6_matrice": Report(
        ("prix_m2_median",), Context(("nom_departement", "type_bien")), totals=True),
    "r7_cartes_modele": Report(
        ("prix_m2_predit_median", "ecart_absolu_median", "part_sous_marche", "nb_ventes_scorees")),
    "r8_positionnement": Report(
        ("nb_ventes_scorees",), Context(("positionnement_prix",)),
        (("nb_ventes_scorees", True),)),
    "r9_reel_predit": Report(
        ("prix_m2_predit_median", "prix_m2_reel_median"), Context(("nom_commune",))),
    "r10_cartes_contexte": Report(
        ("part_passoires_dpe", "revenu_median_communal", "part_ventes_500m",
         "distance_mediane_gare")),
    "r11_revenu_prix": Report(
        ("revenu_median_communal", "prix_m2_median"), Context(("nom_commune",))),
    "r12_dpe_prix": Report(
        ("part_passoires_dpe", "prix_m2_median"), Context(("nom_commune",))),
    "r13_gares_zones": Report(
        ("prix_m2_median",),
        Context(("tranche_dist_gare", "zone"), present=("tranche_dist_gare",)),
        (("tranche_dist_gare", False),)),
    "r14_projet_annees": Report(
        ("evolution_depuis_1re_annee",),
        Context(("annee", "tranche_dist_gpe"), present=("tranche_dist_gpe",)),
        (("annee", False),)),
    "r15_cartes_qualite": Report(
        ("nb_ventes_ecartees", "nb_ventes", "part_ventes_fiables", "part_ventes_simples")),
    "r16_qualite_departements": Report(
        ("nb_ventes", "part_ventes_simples", "part_ventes_fiables", "nb_ventes_ecartees"),
        Context(("nom_departement",)), (("nb_ventes", True),)),
    "r17_types": Report(("nb_ventes",), Context(("type_bien",)), (("nb_ventes", True),)),
}


def run_report(star: Star, name: str, slicers: dict[str, list] | None = None,
               role: str | None = None) -> DataFrame:
    """A visual under the user's slicers and role."""
    report = REPORTS[name]
    ctx = report.context
    if slicers:
        ctx = Context(ctx.by, {**ctx.keep, **slicers}, ctx.drop, ctx.present)
    if report.totals:
        from cadastria.plans.measures import secure

        return with_totals(secure(star, role), ctx, report.measures[0])
    result = evaluate(star, list(report.measures), ctx, role)
    if report.order:
        result = result.orderBy(*[
            F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_first()
            for c, down in report.order
        ])
    return result


def top_places(star: Star, k: int, cheapest: bool = False) -> DataFrame:
    """The k dearest (or cheapest) communes; the limit is the feature."""
    ranked = evaluate(star, ["prix_m2_median", "nb_ventes"], Context(("nom_commune",)))
    price = F.col("prix_m2_median")
    return ranked.filter(price.isNotNull()).orderBy(
        price.asc() if cheapest else price.desc(), "nom_commune").limit(k)
