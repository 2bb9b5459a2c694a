"""SQL statement per registered query. Names and column names match the Spark side."""

from __future__ import annotations

from cadastria.catalogue import measure_axes
from cadastria.functions.constants import RAW_COLUMNS  # noqa: F401  (column contract)
from oracle.tables import bands, day, even, mean, rnd, statement, total  # noqa: F401

ORACLE: dict[str, str] = {}


def add(name: str, sql: str) -> None:
    ORACLE[name] = statement(sql)


def rounded(columns: str, source: str, digits: int = 6) -> str:
    """``columns``: names; those ending in ``~`` are doubles to be rounded."""
    parts = [f"{rnd(c[:-1], digits)} as {c[:-1]}" if c.endswith("~") else c
             for c in columns.replace(",", " ").split()]
    return f"select {', '.join(parts)} from {source}"


# ---- staging and grain -------------------------------------------------------------------

add("median_price_year_department", f"""select cast(year(date_mutation) as integer) as annee,
  code_departement, {rnd('median(prix_m2)')} as prix_m2_median
from (select *, case when est_vente_simple
    then {rnd('(valeur_fonciere / surface_habitable)', 2)} end as prix_m2 from sales)
where prix_m2 between 1000 and 30000 group by 1, 2""")
add("safe_typing", "select * from v_lines")
add("distinct_units", """select id_mutation, id_parcelle, type_local, surface_reelle_bati,
  nombre_pieces from units""")
add("unit_totals", """select id_mutation, n_flat as nb_appartements, n_house as nb_maisons,
  n_outbuilding as nb_dependances, n_business as nb_locaux_activite,
  dwelling_m2 as surface_habitable, rooms as nb_pieces from unit_counts""")
add("land_two_level", "select id_mutation, land_m2 as surface_terrain from land")
add("majority_value", """select id_mutation, code_commune, nom_commune, code_postal
from maj_commune a join maj_nom b using (id_mutation) join maj_postal c using (id_mutation)""")
add("sale_grain", rounded(
    "id_mutation, date_mutation, valeur_fonciere~, code_departement, code_commune, nom_commune, "
    "code_postal, nb_parcelles, nombre_lots, longitude~, latitude~, nb_lignes_source, "
    "nb_valeurs_distinctes, nb_appartements, nb_maisons, nb_dependances, nb_locaux_activite, "
    "surface_habitable~, nb_pieces, surface_terrain~, type_bien, est_vente_simple", "sales"))
add("price_per_m2_flags", """select transaction_id as id_mutation, est_vente_simple, prix_m2,
  est_prix_m2_fiable from fact""")
add("room_surface_segments", """select id_mutation, type_bien, classe_pieces, tranche_surface,
  bien_key from segmented""")
add("physical_stations", rounded(
    "gare_id, nom_gare, mode_principal, est_transport_lourd, lignes, nb_lignes, latitude~, "
    "longitude~", "stations"))
add("planned_stations", rounded(
    "gare_projet_id, nom_gare, projets, mode, est_grand_paris_express, phase, statut, latitude~, "
    "longitude~", "planned"))
add("income_places", "select * from v_income")
add("energy_shares", "select * from energy")

# ---- geography ---------------------------------------------------------------------------

add("spatial_range_join", f"""select lat_k, lon_k, gare_proche, {rnd('d', 3)} as distance_m
from pairs where d <= 5000""")
add("nearest_station", f"""select lat_k, lon_k, {rnd('d', 3)} as distance_m, gare_proche,
  mode_gare_proche from nearest""")
add("stations_in_radius", """select lat_k, lon_k, nb_gares_1km, dist_gpe_m, gare_gpe_proche
from point_prox""")
add("sale_proximity", "select * from proximity")
add("distance_bands", """select transaction_id as id_mutation, tranche_dist_gare,
  tranche_dist_gpe from fact where latitude is not null and longitude is not null""")

# ---- star and marts ----------------------------------------------------------------------

add("month_order", """select mois, nom_mois, cast(dense_rank() over (order by mois) as integer) as rang
from (select distinct mois, nom_mois from calendar)""")
add("dim_calendar", "select * from calendar")
add("dim_place", rounded(
    "geo_key, code_commune, nom_commune, code_postal_principal, code_departement, "
    "nom_departement, zone, latitude~, longitude~, revenu_median_uc~, revenu_d1_uc~, "
    "revenu_d9_uc~, rapport_d9_d1~, nb_menages_fiscaux, millesime_revenus, nb_dpe, "
    "part_dpe_fg_pct~, part_dpe_ab_pct~", "places"))
add("dim_segment", "select * from segments")
add("fact_sales", rounded(
    "transaction_id, date_key, geo_key, bien_key, date_mutation, code_departement, type_bien, "
    "valeur_fonciere~, surface_habitable~, surface_terrain~, nb_pieces, nb_appartements, "
    "nb_maisons, nb_dependances, nb_locaux_activite, nb_parcelles, nombre_lots, prix_m2~, "
    "est_vente_simple, est_prix_m2_fiable, latitude~, longitude~, dist_gare_m~, gare_proche, "
    "mode_gare_proche, nb_gares_1km, tranche_dist_gare, dist_gpe_m~, gare_gpe_proche, "
    "tranche_dist_gpe, nb_lignes_source", "fact"))
add("gap_mart", "select * from gaps")
add("market_position", """select positionnement_prix, count(*) as nb_ventes from gaps
group by 1""")
add("yearly_median_evolution", f"""select annee, zone, type_bien, tranche_dist_gpe, nb_ventes,
  {rnd('m')} as prix_m2_median,
  {rnd('''((m / first_value(m) over (partition by zone, type_bien, tranche_dist_gpe
    order by annee) - 1) * 100)''', 1)} as evolution_depuis_debut_pct
from (select r.annee, g.zone, r.type_bien, r.tranche_dist_gpe, count(*) as nb_ventes,
    median(r.prix_m2) as m
  from reliable r join places g using (geo_key)
  where r.code_departement <> '0' and r.type_bien in ('Appartement', 'Maison')
    and r.tranche_dist_gpe is not null group by all)""")
PRICES = ("code_commune, nom_commune, code_departement, nom_departement, zone, latitude~, "
          "longitude~, type_bien, annee, nb_ventes, prix_m2_q1~, prix_m2_median~, prix_m2_q3~, "
          "surface_mediane~")
add("commune_quartiles_k5", rounded(PRICES, "prices"))
# the sketches are random within their bound: what they count and that they keep it is certain
add("approximate_quartiles", """select code_departement, type_bien, cast(year(date_mutation) as integer) as annee,
  count(*) as nb_ventes, true as q1_proche, true as mediane_proche, true as q3_proche
from reliable group by 1, 2, 3""")
add("band_medians_k5", rounded(
    "zone, type_bien, annee, tranche_dist_gare, nb_ventes, prix_m2_median~", "band_prices"))
_GAPS = f"""(select g.code_commune, g.nom_commune, g.code_departement, g.zone, e.type_bien,
    count(*) as nb_ventes, {rnd('median(abs(ecart_pct))')} as ecart_absolu_median_pct,
    {rnd('(100e0 * count(*) filter (ecart_pct <= -20) / count(*))', 1)} as part_sous_marche_pct,
    {rnd('(100e0 * count(*) filter (ecart_pct >= 20) / count(*))', 1)} as part_au_dessus_pct
  from gaps e join places g using (geo_key) group by all)"""
add("gap_stats_k5", f"select * from {_GAPS} where nb_ventes >= 5")
_BAND_LABELS = ["1. Moins de 500 m", "2. 500 m à 1 km", "3. 1 à 2 km", "4. Plus de 2 km"]
add("raw_band_gaps", "select g.zone, " + ", ".join(
    f"{rnd(f'''median(prix_m2) filter (tranche_dist_gare = '{b}')''')} as bande_{i}"
    for i, b in enumerate(_BAND_LABELS, 1)
) + """ from reliable r join places g using (geo_key)
where r.type_bien = 'Appartement' and r.tranche_dist_gare is not null group by 1""")
add("context_correlation", f"""select zone, count(*) as communes,
  {rnd('corr(revenu_median_uc, m)')} as corr_revenu,
  {rnd('corr(part_dpe_fg_pct, m)')} as corr_dpe_fg
from (select geo_key, median(prix_m2) as m from reliable group by 1 having count(*) >= 30)
  join places using (geo_key) group by 1""")
add("quality_indicators", f"""select (select count(*) from v_raw) as lignes_brutes,
  count(*) as ventes,
  {rnd('(100e0 * count(*) filter (est_vente_simple) / count(*))', 1)} as part_simples_pct,
  {rnd('(100e0 * count(*) filter (est_prix_m2_fiable) / count(*))', 1)} as part_fiables_pct,
  count(*) - count(*) filter (est_prix_m2_fiable) as ventes_ecartees,
  (select count(*) from gaps) as ventes_scorees from fact""")

# ---- measures ----------------------------------------------------------------------------

# aggregate over fx, or over gx for the scored sales; rows of groups without a value are left out
_FX = {
    "nb_ventes": "count(*)",
    "volume_ventes": "cast(sum(cast(valeur_fonciere as decimal(18,2))) as double)",
    "prix_m2_median": "median(prix_m2) filter (est_prix_m2_fiable)",
    "prix_m2_moyen": ("cast(sum(cast(prix_m2 as decimal(24,6))) filter (est_prix_m2_fiable) "
                      "as double) / nullif(count(prix_m2) filter (est_prix_m2_fiable), 0)"),
    "prix_median_vente": "median(valeur_fonciere) filter (est_vente_simple)",
    "surface_mediane": "median(surface_habitable) filter (est_vente_simple)",
    "part_ventes_fiables": "count(*) filter (est_prix_m2_fiable) / count(*)",
    "part_ventes_simples": "count(*) filter (est_vente_simple) / count(*)",
    "nb_ventes_ecartees": "count(*) - count(*) filter (est_prix_m2_fiable)",
    "distance_mediane_gare": "median(dist_gare_m) filter (est_vente_simple)",
    "part_ventes_500m": ("count(*) filter (est_vente_simple and dist_gare_m < 500) / nullif("
                         "count(*) filter (est_vente_simple and dist_gare_m is not null), 0)"),
}
_GX = {
    "nb_ventes_scorees": "count(*)",
    "ecart_median_modele": "median(ecart_pct) / 100",
    "ecart_absolu_median": "median(abs(ecart_pct)) / 100",
    "part_sous_marche": "count(*) filter (ecart_pct <= -10) / count(*)",
    "prix_m2_predit_median": "median(prix_m2_predit)",
    "prix_m2_reel_median": "median(prix_m2)",
}
_COUNTS = ["nb_ventes", "nb_ventes_ecartees", "nb_ventes_scorees", "nb_ventes_n1"]
_MEDIAN_ONLY = ["prix_m2_median", "prix_median_vente", "surface_mediane", "distance_mediane_gare",
                "prix_m2_median_n1"]


def shown(name: str, expression: str) -> str:
    return f"{expression if name in _COUNTS else rnd(f'({expression})')} as {name}"


def grouped(axes: tuple[str, ...], names: list[str], source: str | None = None) -> str:
    kind = _FX if names[0] in _FX else _GX
    src = source or ("fx" if kind is _FX else "gx")
    cols = ", ".join([*axes, *[shown(n, kind[n]) for n in names]])
    sql = f"select {cols} from {src}" + (f" group by {', '.join(axes)}" if axes else "")
    if all(n in _MEDIAN_ONLY for n in names):
        sql = f"select * from ({sql}) where {' or '.join(f'{n} is not null' for n in names)}"
    return sql


def same(axes: tuple[str, ...], a: str, b: str) -> str:
    return " and ".join(f"{a}.{x} is not distinct from {b}.{x}" for x in axes) or "true"


def prior(axes: tuple[str, ...], which: str) -> str:
    agg = "count(*)" if which == "nb_ventes" else "median(prix_m2) filter (est_prix_m2_fiable)"
    keys = ", ".join(axes)
    return f"""(select coalesce(c.present, p.present) as present,
    {', '.join(f'coalesce(c.{x}, p.{x}) as {x}' for x in axes)}, c.v as cur, p.v as prev
  from (select true as present, {keys}, {agg} as v from fx group by {keys} having v is not null) c
  full join (select true as present, {keys}, {agg} as v from px group by {keys}
    having v is not null) p on {same(axes, 'c', 'p')})"""


_CHANGE = "(coalesce(cur, 0) - coalesce(prev, 0)) / nullif(cast(prev as double), 0)"


def rolling(axes: tuple[str, ...]) -> str:
    others = [a for a in axes if a != "annee_mois"]
    keys = ", ".join(["w.annee_mois", *[f"f.{o}" for o in others]])
    return f"""select {keys}, {rnd('median(prix_m2)')} as prix_m2_median_12m
from (select annee_mois, max(date) as fin from calendar group by 1) w
  join fx f on f.date_mutation <= w.fin
    and f.date_mutation > cast(w.fin - interval 12 month as date)
where est_prix_m2_fiable group by {keys}"""


def last_year(axes: tuple[str, ...], source: str = "fx") -> str:
    keys = ", ".join(axes)
    pre = f"{keys}, " if axes else ""
    mid = "cast(fin - interval 12 month as date)"
    pre_f = "".join(f"f.{a}, " for a in axes)
    by = f" group by {keys}" if axes else ""
    return f"""(select {pre} (coalesce(cur, 0) - coalesce(prev, 0)) / nullif(prev, 0)
    as evolution_prix_m2_12m from (
  select {pre} median(prix_m2) filter (date_mutation > {mid}) as cur,
    median(prix_m2) filter (date_mutation <= {mid}
      and date_mutation > cast({mid} - interval 12 month as date)) as prev
  from (select {pre_f} f.prix_m2, f.date_mutation, e.fin from {source} f
    join (select {pre} max(date_mutation) as fin from {source}{by}) e on {same(axes, 'f', 'e')}
    where f.est_prix_m2_fiable and f.date_mutation <= e.fin){by})
  where cur is not null or prev is not null)"""


def since_first(axes: tuple[str, ...], where: str = "true") -> str:
    """First axis is the year."""
    others = axes[1:]
    keys = ", ".join(others)
    outside = "est_prix_m2_fiable and coalesce(zone <> 'Paris', true)"
    return f"""select c.annee, {', '.join(f'c.{o}' for o in others)},
  {rnd('((c.m - b.m) / nullif(b.m, 0))')} as evolution_depuis_1re_annee
from (select annee, {keys}, median(prix_m2) as m from fx where {outside} and {where}
    group by annee, {keys}) c
  left join (select {', '.join(f'f.{o}' for o in others)}, median(prix_m2) as m
    from (select * from fx where {where}) f join (select {keys}, year(min(date_mutation)) as an0 from fx where {where}
        group by {keys}) z on {same(others, 'f', 'z')}
    where {outside} and year(f.date_mutation) = z.an0
    group by {', '.join(f'f.{o}' for o in others)}) b on {same(others, 'c', 'b')}"""


_PLACE = {
    "revenu_median_communal": mean("revenu_median_uc"),
    "part_passoires_dpe": (total("nb_dpe * part_dpe_fg_pct / 100e0")
                           + " / nullif(cast(sum(nb_dpe) as double), 0)"),
}


def ranked(where: str) -> str:
    return f"""(select nom_commune, m as prix_m2_median,
    dense_rank() over (order by coalesce(m, 0) desc) as rang_commune
  from (select nom_commune, median(prix_m2) filter (est_prix_m2_fiable) as m from fx
    where {where} group by 1) where m is not null)"""


def measure(name: str, axes: tuple[str, ...]) -> str:
    keys = ", ".join(axes)
    if name in _FX or name in _GX:
        return grouped(axes, [name])
    if name in _PLACE:
        return f"select {keys}, {rnd(f'({_PLACE[name]})')} as {name} from places group by {keys}"
    if name == "nb_ventes_n1":
        return f"select {keys}, prev as {name} from {prior(axes, 'nb_ventes')} where prev > 0"
    if name == "prix_m2_median_n1":
        return (f"select {keys}, {rnd('prev')} as {name} from {prior(axes, 'prix')} "
                "where prev is not null")
    if name == "evolution_volume":
        return f"select {keys}, {rnd(f'({_CHANGE})')} as {name} from {prior(axes, 'nb_ventes')}"
    if name == "evolution_prix_m2":
        return f"select {keys}, {rnd(f'({_CHANGE})')} as {name} from {prior(axes, 'prix')}"
    if name == "prix_m2_median_12m":
        return rolling(axes)
    if name == "evolution_prix_m2_12m":
        return f"select {keys}, {rnd(name)} as {name} from {last_year(axes)}"
    if name == "evolution_depuis_1re_annee":
        return since_first(axes)
    return f"select nom_commune, rang_commune from {ranked('true')}"


MEASURES = [
    "nb_ventes", "volume_ventes", "nb_ventes_n1", "evolution_volume", "prix_m2_median",
    "prix_m2_moyen", "prix_median_vente", "surface_mediane", "prix_m2_median_n1",
    "evolution_prix_m2", "prix_m2_median_12m", "part_ventes_fiables", "part_ventes_simples",
    "nb_ventes_ecartees", "nb_ventes_scorees", "ecart_median_modele", "ecart_absolu_median",
    "part_sous_marche", "prix_m2_predit_median", "prix_m2_reel_median", "evolution_prix_m2_12m",
    "distance_mediane_gare", "part_ventes_500m", "revenu_median_communal", "part_passoires_dpe",
    "evolution_depuis_1re_annee", "rang_commune",
]
for _i, _m in enumerate(MEASURES, 1):
    add(f"measure_k{_i:02d}_{_m}", measure(_m, measure_axes(_m)))

_month = ("annee_mois",)
add("prior_year", f"""select coalesce(n.annee_mois, p.annee_mois) as annee_mois,
  n.cur as nb_ventes, n.prev as nb_ventes_n1, {rnd('p.cur')} as prix_m2_median,
  {rnd('p.prev')} as prix_m2_median_n1
from {prior(_month, 'nb_ventes')} n full join {prior(_month, 'prix')} p using (annee_mois)""")
_quarter = ("annee_trimestre", "type_bien")
add("yoy", f"""select annee_trimestre, type_bien,
  {rnd(f"({_CHANGE.replace('cur', 'n.cur').replace('prev', 'n.prev')})")} as evolution_volume,
  {rnd(f"({_CHANGE.replace('cur', 'p.cur').replace('prev', 'p.prev')})")} as evolution_prix_m2
from {prior(_quarter, 'nb_ventes')} n full join {prior(_quarter, 'prix')} p
  using (annee_trimestre, type_bien)""")
add("rolling_12m_median", f"""select o.o_orderstatus, w.mois,
  {rnd('median(o.o_totalprice)')} as prix_median_12m
from (select distinct o_orderstatus, cast(date_trunc('month', o_orderdate) as date) as mois
    from orders) w
  join orders o on o.o_orderstatus = w.o_orderstatus
    and o.o_orderdate < w.mois + interval 1 month
    and o.o_orderdate >= w.mois - interval 11 month
group by 1, 2""")
_dep = ("nom_departement", "type_bien")
add("last12_vs_prev12", f"""select nom_departement, type_bien,
  {rnd('evolution_prix_m2_12m')} as evolution_prix_m2_12m from {last_year(_dep)}""")
add("since_first_year", since_first(("annee", "nom_departement")))
add("dense_rank_place", f"""select nom_commune, {rnd('prix_m2_median')} as prix_m2_median,
  rang_commune from {ranked("zone in ('Petite couronne', 'Grande couronne')")}""")
for _name, _way in (("top_places", "desc"), ("bottom_places", "asc")):
    add(_name, f"""select nom_commune, {rnd('m')} as prix_m2_median, nb_ventes
from (select nom_commune, median(prix_m2) filter (est_prix_m2_fiable) as m,
    count(*) as nb_ventes from fx group by 1) where m is not null
order by m {_way}, nom_commune limit 10""")

# ---- reports -----------------------------------------------------------------------------


def report(name: str, sql: str) -> None:
    add(f"report_{name}", sql)


report("r1_departements", grouped(("nom_departement",), ["prix_m2_median"]))
report("r2_trimestres_zones", grouped(("annee_trimestre", "zone"), ["prix_m2_median"]))
report("r3_cartes_synthese", f"""select {shown('surface_mediane', _FX['surface_mediane'])},
  count(*) as nb_ventes,
  (select {rnd('evolution_prix_m2_12m')} from {last_year(())}) as evolution_prix_m2_12m,
  {shown('prix_m2_median', _FX['prix_m2_median'])} from fx""")
report("r4_classes_pieces", grouped(
    ("classe_pieces",), ["prix_m2_median"],
    "(select * from fx where classe_pieces not in ('Inconnu', 'n/a'))"))


def place_table(where: str) -> str:
    axes = ("nom_commune", "nom_departement")
    cols = ", ".join(shown(n, _FX[n]) for n in
                     ["nb_ventes", "prix_m2_median", "surface_mediane", "prix_median_vente"])
    return f"""select t.*, {rnd('e.evolution_prix_m2_12m')} as evolution_prix_m2_12m
from (select nom_commune, nom_departement, {cols} from fx where {where} group by 1, 2) t
  left join {last_year(axes, f'(select * from fx where {where})')} e on {same(axes, 't', 'e')}"""


report("r5_communes", place_table("true"))
report("r6_matrice", f"""select * from (select cast(grouping(nom_departement) * 2
    + grouping(type_bien) as integer) as niveau, nom_departement, type_bien,
  {rnd('median(prix_m2) filter (est_prix_m2_fiable)')} as prix_m2_median
from fx group by cube (nom_departement, type_bien)) where prix_m2_median is not null""")
report("r7_cartes_modele", grouped(
    (), ["prix_m2_predit_median", "ecart_absolu_median", "part_sous_marche",
         "nb_ventes_scorees"]))
report("r8_positionnement", grouped(("positionnement_prix",), ["nb_ventes_scorees"]))
report("r9_reel_predit", grouped(
    ("nom_commune",), ["prix_m2_predit_median", "prix_m2_reel_median"]))
report("r10_cartes_contexte", f"""select
  (select {rnd(f"({_PLACE['part_passoires_dpe']})")} from places) as part_passoires_dpe,
  (select {rnd(f"({_PLACE['revenu_median_communal']})")} from places) as revenu_median_communal,
  {shown('part_ventes_500m', _FX['part_ventes_500m'])},
  {shown('distance_mediane_gare', _FX['distance_mediane_gare'])} from fx""")
for _r, _p in (("r11_revenu_prix", "revenu_median_communal"),
               ("r12_dpe_prix", "part_passoires_dpe")):
    report(_r, f"""select p.nom_commune, p.v as {_p}, m.prix_m2_median
from (select nom_commune, {rnd(f'({_PLACE[_p]})')} as v from places group by 1) p
  join ({grouped(('nom_commune',), ['prix_m2_median'])}) m using (nom_commune)""")
report("r13_gares_zones", grouped(
    ("tranche_dist_gare", "zone"), ["prix_m2_median"],
    "(select * from fx where tranche_dist_gare is not null)"))
report("r14_projet_annees", since_first(("annee", "tranche_dist_gpe"),
                                        "tranche_dist_gpe is not null"))
_QUALITY = ["nb_ventes", "part_ventes_simples", "part_ventes_fiables", "nb_ventes_ecartees"]
report("r15_cartes_qualite", grouped((), _QUALITY))
report("r16_qualite_departements", grouped(("nom_departement",), _QUALITY))
report("r17_types", grouped(("type_bien",), ["nb_ventes"]))

# the year slicer limits the place's sales, but the comparison window reaches back before it
_SLICE = "type_bien = 'Appartement' and zone = 'Grande couronne'"
_axes = ("nom_commune", "nom_departement")
add("report_sliced", f"""select t.*, {rnd('e.ev')} as evolution_prix_m2_12m
from (select nom_commune, nom_departement, {", ".join(shown(n, _FX[n]) for n in [
    "nb_ventes", "prix_m2_median", "surface_mediane", "prix_median_vente"])}
  from fx where {_SLICE} and annee = 1999 group by 1, 2) t
left join (select nom_commune, nom_departement,
    (coalesce(cur, 0) - coalesce(prev, 0)) / nullif(prev, 0) as ev from (
  select f.nom_commune, f.nom_departement,
    median(prix_m2) filter (date_mutation > cast(fin - interval 12 month as date)) as cur,
    median(prix_m2) filter (date_mutation <= cast(fin - interval 12 month as date)
      and date_mutation > cast(fin - interval 24 month as date)) as prev
  from fx f join (select nom_commune, nom_departement, max(date_mutation) as fin from fx
      where {_SLICE} and annee = 1999 group by 1, 2) z on {same(_axes, 'f', 'z')}
  where {_SLICE} and est_prix_m2_fiable and date_mutation <= fin group by 1, 2)) e
  on {same(_axes, 't', 'e')}""")
add("role_filtered", f"""select annee, nb_ventes, nb_ventes_scorees, prix_m2_median
from (select annee, count(*) as nb_ventes, {shown('prix_m2_median', _FX['prix_m2_median'])}
  from fx where zone = 'Petite couronne' group by 1)
left join (select annee, count(*) as nb_ventes_scorees from gx where zone = 'Petite couronne'
  group by 1) using (annee)""")
add("role_reconciliation", """select zone, count(*) as vues, count(*) as total,
  true as concorde from fx where zone is not null group by 1""")

# ---- the explorer ------------------------------------------------------------------------

add("explorer_view", rounded(PRICES, """prices where type_bien = 'Appartement' and annee = 1999
  and zone in ('Petite couronne', 'Grande couronne')"""))
add("explorer_gaps", f"""select * from {_GAPS}
where nb_ventes >= 30 and type_bien = 'Appartement'""")
_CLASS = "greatest(ceil((r - 1) * k / (n - 1)) - 1, 0)"
add("quantile_class", f"""select code_commune, {rnd('prix_m2_median')} as prix_m2_median,
  cast({_CLASS} as integer) as classe,
  ['#228B22AA', '#9ACD32AA', '#FFC800AA', '#FF7800AA', '#C81E1EAA'][
    1 + cast(floor({_CLASS} * 4 / greatest(k - 1, 1)) as integer)] as couleur,
  {rnd('(150 + 40 * sqrt(least(nb_ventes, 400)))')} as rayon
from (select *, row_number() over (order by prix_m2_median, code_commune) as r,
    count(*) over () as n,
    least(5, (select count(distinct prix_m2_median) from prices
      where type_bien = 'Appartement' and annee = 1999)) as k
  from prices where type_bien = 'Appartement' and annee = 1999)""")
add("quantile_class_customers", """select c_custkey, c_acctbal,
  cast(greatest(ceil((r - 1) * 5 / (n - 1)) - 1, 0) as integer) as classe
from (select c_custkey, c_acctbal, count(*) over () as n,
    row_number() over (order by c_acctbal, c_custkey) as r from customer)""")
_LATEST = """(select * from (select *, row_number() over (
    partition by code_commune, type_bien order by annee desc) as rn from prices) where rn = 1)"""
add("price_range", f"""select code_commune, type_bien, annee, nb_ventes,
  round_even(40 * prix_m2_q1 / 1000, 0) * 1000 as bas,
  round_even(40 * prix_m2_median / 1000, 0) * 1000 as median,
  round_even(40 * prix_m2_q3 / 1000, 0) * 1000 as haut,
  {rnd('prix_m2_median')} as prix_m2_median from {_LATEST}""")
add("latest_row", rounded(PRICES, _LATEST))
add("first_per_place", """select code_commune, nom_commune, code_departement, annee,
  nom_commune || ' (' || code_departement || ')' as libelle
from (select *, row_number() over (partition by code_commune order by annee) as rn
  from prices where type_bien = 'Appartement') where rn = 1""")
add("kpis", f"""select annee, type_bien, count(*) as communes,
  cast(sum(nb_ventes) as bigint) as ventes, {rnd('median(prix_m2_median)')} as prix_m2_median
from prices group by 1, 2""")
add("pivot_year_place", "select annee, " + ", ".join(
    f"""{rnd(f"({mean(f'case when code_commune = {100 + n}::varchar then prix_m2_median end')})")} as NATION_{n}"""
    for n in (0, 1, 6, 14, 15)
) + """ from prices where type_bien = 'Appartement'
  and code_commune in ('100', '101', '106', '114', '115') group by 1""")
add("pivot_band_zone", "select tranche_dist_gare, " + ", ".join(
    f"""{rnd(f"({mean(f'''case when zone = '{z}' then prix_m2_median end''')})")} as "{z}" """
    for z in ("Paris", "Petite couronne", "Grande couronne")
) + " from band_prices where type_bien = 'Appartement' and annee = 1999 group by 1")

# ---- data quality ------------------------------------------------------------------------


def check_row(table: str, check: str, column: str, failures: str, severity: str = "error") -> str:
    return f"""select '{table}' as table_name, '{check}' as check_name,
  '{column}' as column_name, '{severity}' as severity, cast(f as bigint) as failures,
  case when f = 0 then 'pass' else '{'warn' if severity == 'warn' else 'error'}' end as status
from (select {failures} as f)"""


def check_table(name: str, source: str, checks: list[tuple], query: str | None = None) -> None:
    rows = []
    for kind, column, *rest in checks:
        severity = rest[-1] if rest and rest[-1] == "warn" else "error"
        if kind == "not_null":
            f = f"(select count(*) from {source} where {column} is null)"
        elif kind == "accepted_values":
            f = f"(select count(*) from {source} where {column} not in ({rest[0]}))"
        elif kind == "accepted_range":
            f = f"(select count(*) from {source} where {rest[0]})"
        elif kind == "relationship":
            f = (f"(select count(*) from {source} where {column} is not null and {column} not in "
                 f"(select {rest[1]} from {rest[0]}))")
        else:
            null = f"where {column} is not null " if kind == "unique" else ""
            f = (f"(select count(*) from (select {column} from {source} {null}"
                 f"group by {column} having count(*) > 1))")
        rows.append(check_row(name, kind, column, f, severity))
    add(query or f"dq_table_{name}", "\nunion all ".join(rows))


check_table("lines", "v_lines", [
    ("not_null", "id_mutation"), ("not_null", "date_mutation"), ("not_null", "valeur_fonciere"),
    ("accepted_range", "valeur_fonciere", "valeur_fonciere <= 0"),
    ("accepted_values", "nature_mutation", "'Vente'"), ("not_null", "code_departement"),
    ("accepted_values", "code_departement", "select code_departement from seed"),
])
_CLASSES = ("'Appartement', 'Maison', 'Multi-logements', 'Local commercial', "
            "'Dépendance seule', 'Terrain / non bâti'")
check_table("sales", "sales", [
    ("unique", "id_mutation"), ("not_null", "id_mutation"), ("not_null", "valeur_fonciere"),
    ("accepted_values", "type_bien", _CLASSES)])
check_table("proximity", "proximity", [
    ("unique", "id_mutation"), ("not_null", "id_mutation"), ("not_null", "dist_gare_m"),
    ("accepted_range", "dist_gare_m", "dist_gare_m < 0 or dist_gare_m > 5000"),
    ("not_null", "nb_gares_1km"), ("not_null", "dist_gpe_m"),
    ("accepted_range", "dist_gpe_m", "dist_gpe_m < 0 or dist_gpe_m > 10000")])
check_table("fact", "fact", [
    ("unique", "transaction_id"), ("not_null", "transaction_id"), ("not_null", "date_key"),
    ("relationship", "date_key", "calendar", "date_key"), ("not_null", "geo_key"),
    ("relationship", "geo_key", "places", "geo_key"), ("not_null", "bien_key"),
    ("relationship", "bien_key", "segments", "bien_key"),
    ("accepted_range", "valeur_fonciere", "valeur_fonciere <= 0"),
    ("accepted_range", "prix_m2", "prix_m2 <= 0", "warn"),
    ("accepted_values", "tranche_dist_gare",
     "'1. Moins de 500 m', '2. 500 m à 1 km', '3. 1 à 2 km', '4. Plus de 2 km'"),
    ("accepted_values", "tranche_dist_gpe",
     "'1. Moins de 800 m', '2. 800 m à 1,5 km', '3. 1,5 à 3 km', '4. Plus de 3 km'")])
check_table("places", "places", [
    ("unique", "geo_key"), ("not_null", "geo_key"), ("not_null", "zone"),
    ("accepted_range", "revenu_median_uc", "revenu_median_uc < 5000 or revenu_median_uc > 100000"),
    ("accepted_range", "part_dpe_fg_pct", "part_dpe_fg_pct < 0 or part_dpe_fg_pct > 100")])
check_table("calendar", "calendar", [("unique", "date_key"), ("not_null", "date_key")])
check_table("segments", "segments", [("unique", "bien_key"), ("not_null", "bien_key")])
check_table("predictions", "predictions", [
    ("unique", "transaction_id"), ("not_null", "transaction_id")])
check_table("gaps", "gaps", [("unique", "transaction_id"), ("not_null", "transaction_id")])
_EVOLUTION = """(select r.annee, g.zone, r.type_bien, r.tranche_dist_gpe,
  median(r.prix_m2) as prix_m2_median from reliable r join places g using (geo_key)
  where r.code_departement <> '0' and r.type_bien in ('Appartement', 'Maison')
    and r.tranche_dist_gpe is not null group by all)"""
check_table("band_evolution", _EVOLUTION, [
    ("unique_combination", "annee,zone,type_bien,tranche_dist_gpe"),
    ("not_null", "prix_m2_median"),
    ("accepted_range", "prix_m2_median", "prix_m2_median < 500 or prix_m2_median > 30000")])
check_table("departments", "seed", [
    ("unique", "code_departement"), ("not_null", "code_departement")])
check_table("raw_lines", "v_typed", [
    ("not_null", "date_mutation"), ("not_null", "type_local"),
    ("accepted_values", "nature_mutation", "'Vente'"),
    ("accepted_range", "valeur_fonciere", "valeur_fonciere <= 0"),
    ("accepted_range", "surface_reelle_bati",
     "surface_reelle_bati < 9 or surface_reelle_bati > 45", "warn"),
    ("unique", "id_mutation"),
    ("unique_combination", "id_mutation,id_parcelle,nombre_pieces")], "dq_dirty_lines")
add("dq_relationship", check_row("orders", "relationship", "o_orderkey", """(select count(*)
  from orders where o_orderkey not in (select l_orderkey from lineitem))""")
    + "\nunion all " + check_row("lineitem", "relationship", "l_orderkey", """(select count(*)
  from lineitem where l_orderkey not in (select o_orderkey from orders))"""))
_COVERAGE = """(select count(g.revenu_median_uc) / cast(count(*) as double) as part_revenu,
  count(g.part_dpe_fg_pct) / cast(count(*) as double) as part_dpe,
  count(f.dist_gare_m) / cast(count(*) as double) as part_transports
from fact f join places g using (geo_key) where f.est_vente_simple)"""
_SHARES = "part_revenu~ part_dpe~ part_transports~"
add("dq_coverage", rounded(_SHARES, _COVERAGE))
add("dq_coverage_failures", rounded(_SHARES, _COVERAGE) + """
where part_revenu < 0.99 or part_dpe < 0.99 or part_transports < 0.99""")
_AGE = "(epoch(timestamp '2024-03-10 00:00:00') - floor(epoch(max(ts)))) / 86400e0"
add("dq_freshness", f"""select {rnd('age', 3)} as age_jours,
  case when age > 55 then 'error' when age > 35 then 'warn' else 'pass' end as status
from (select {_AGE} as age from events)""")
add("dq_gate", """select raw_rows, departements, missing_groups,
  raw_rows >= 1000000 and missing_groups = '' as passed
from (select count(*) as raw_rows, count(distinct code_departement) as departements,
  coalesce((select string_agg(code_departement, ', ' order by code_departement) from seed
    where code_departement not in (select code_departement from v_raw)), '') as missing_groups
  from v_raw)""")
add("landing_volumes", "select code_departement, count(*) as n from v_raw group by 1")
add("profile_volumetrie", "select code_departement, count(*) as n from v_raw group by 1")
add("profile_taux_nuls", f"""select nuls, total, {rnd('(100e0 * nuls / total)', 2)} as pct_nuls
from (select count(*) filter (valeur_fonciere is null or valeur_fonciere = '') as nuls,
  count(*) as total from v_raw)""")
add("profile_multi_lots", """select try_cast(nullif(nombre_lots, '') as bigint) as nb_lots,
  count(*) as n from v_raw group by 1""")
add("profile_types", """select coalesce(type_local, '(nul)') as type_local, count(*) as n
from v_raw group by 1""")
add("profile_suspects", """select
  count(*) filter (try_cast(surface_reelle_bati as double) = 0) as surface_zero,
  count(*) filter (try_cast(surface_reelle_bati as double) > 1000) as surface_gt_1000,
  count(*) filter (try_cast(valeur_fonciere as double) < 1000) as valeur_lt_1000,
  count(*) filter (try_cast(valeur_fonciere as double) > 20000000) as valeur_gt_20m
from v_raw""")

add("evolution_prix_m2_12m_monthly", f"""select annee_mois, zone,
  {rnd('((coalesce(cur, 0) - coalesce(prev, 0)) / nullif(prev, 0))')} as evolution_prix_m2_12m
from (select e.annee_mois, e.zone,
    median(f.prix_m2) filter (f.date_mutation > e.mid) as cur,
    median(f.prix_m2) filter (f.date_mutation <= e.mid) as prev
  from (select annee_mois, zone, max(date_mutation) as fin,
      cast(max(date_mutation) - interval 12 month as date) as mid from fx group by 1, 2) e
    join fx f on f.zone is not distinct from e.zone and f.date_mutation <= e.fin
      and f.date_mutation > cast(e.mid - interval 12 month as date)
  where f.est_prix_m2_fiable group by 1, 2)
where cur is not null or prev is not null""")
add("hedonic_equations", f"""select zone, type_bien, terme_a, terme_b, {rnd('p', 5)} as produit,
  case when terme_b = 'y' and n > 0 then 0e0 end as reste
from (select a.zone, a.type_bien, a.terme as terme_a, b.terme as terme_b, sum(a.c * b.c) as p,
    any_value(u.n) as n
  from hedonic_centred a join hedonic_centred b using (rid)
    left join hedonic_used u on u.zone = a.zone and u.type_bien = a.type_bien and u.terme = a.terme
  where a.terme <> 'y' group by 1, 2, 3, 4)""")
_EFFECTS = ", ".join(f"(exp(coefficient {sign}) - 1) * 100 as {name}" for name, sign in (
    ("effet_pct", ""), ("ic95_bas_pct", "- 1.96 * erreur_standard"), ("ic95_haut_pct", "+ 1.96 * erreur_standard")))
add("hedonic_full", rounded(
    "zone type_bien variable coefficient~ erreur_standard~ effet_pct~ ic95_bas_pct~ ic95_haut_pct~ n groupes",
    f"(select *, {_EFFECTS} from hedonic_effects)"))
add("hedonic_report", f"""select zone, type_bien, variable, {even('effet_pct', 1)} as effet_pct,
  {even('ic95_bas_pct', 1)} as ic95_bas_pct, {even('ic95_haut_pct', 1)} as ic95_haut_pct, n, groupes
from (select *, {_EFFECTS} from hedonic_effects) where regexp_matches(variable, '^[0-9]')""")
# what holds of the boosted model whatever its trees are
add("prediction_checks", """select unnest(['ventes_predites', 'ventes_en_double',
    'ventes_sans_prediction', 'annees_predites', 'ecarts_faux', 'predictions_non_entieres',
    'variables', 'importances_hors_total']) as controle,
  unnest([(select count(*) from training), 0, 0, (select count(distinct annee) from training), 0, 0,
    19, 0]) as valeur""")
# ---- landing -----------------------------------------------------------------------------

_CSV = ["id_mutation", "date_mutation", "nature_mutation", "valeur_fonciere", "code_postal",
        "code_commune", "nom_commune", "code_departement", "id_parcelle", "nombre_lots",
        "type_local", "surface_reelle_bati", "nombre_pieces_principales", "surface_terrain",
        "longitude", "latitude"]
add("csv_by_name_union", "select " + ", ".join(
    f"case when code_departement <> '4' then nullif({c}, '') end as {c}" if c == "nombre_lots"
    else f"nullif({c}, '') as {c}" for c in _CSV
) + """, cast(null as varchar) as adresse_numero, cast(null as varchar) as adresse_nom_voie,
  cast(null as varchar) as code_type_local from v_raw""")
add("incremental_landing", "select event_id, ts, user_id, event_type from events")
add("file_manifest_diff", """select cast(annee as varchar) || '_' || code_departement as file,
  case when annee = 1996 and code_departement = '1' then 'absent'
    when annee >= 2001 then 'nouveau' when code_departement = '2' then 'mis à jour'
    else 'cache' end as status
from (select distinct year(date_mutation) as annee, code_departement from v_lines)""")
add("scope_files", """select y.annee, d.code_departement,
  y.annee || '_' || d.code_departement || '.csv.gz' as file
from (select distinct cast(year(o_orderdate) as varchar) as annee from orders) y, seed d""")
add("json_flatten", """select cast(user_id as varchar) as code_commune,
  event_type as etiquette_dpe, count(*) as nb_dpe from events group by 1, 2""")
add("json_files", """select cast(user_id as varchar) as code_commune,
  event_type as etiquette_dpe, count(*) as nb_dpe from events group by 1, 2""")
add("semicolon_csv", "select nom_gares, mode, res_com, latitude, longitude from v_station_lines")
add("income_of_departments", """select lpad(cast(c_custkey as varchar), 5, '0') as code_commune, c_name as libelle_commune,
  cast(c_nationkey as varchar) as nb_menages, cast(c_custkey as varchar) as revenu_median, cast(c_nationkey as varchar) as revenu_d1,
  cast(c_custkey as varchar) as revenu_d9, c_mktsegment as part_pensions_pct, '2021' as millesime,
  'https://example.org/filo-2021.csv' as source_url
from customer where substr(lpad(cast(c_custkey as varchar), 5, '0'), 1, 2) in ('00', '01')""")
add("landing_provenance", """select count(*) as lignes, count(*) as fichier_nomme, count(*) as date_de_charge
from v_raw where code_departement = '4'""")
add("reference_counts", """select 'stations' as reference, count(*) as lignes from v_station_lines union all
select 'projets', count(*) from v_planned_lines union all select 'energie', count(*) from v_energy_lines union all
select 'departements', count(*) from region""")
add("json_latest_resource", """select event_type, url,
  nullif(regexp_extract(url, '(20[0-9][0-9])', 1), '') as millesime
from (select event_type, 'https://example.org/' || cast(2015 + k % 10 as varchar) || '/'
    || cast(event_id as varchar) as url, row_number() over (partition by event_type
    order by case when k % 7 = 0 then '' else strftime(ts, '%Y-%m-%d %H:%M:%S.%f') end desc) as rn
  from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events)
  where k % 3 in (0, 1)) where rn = 1""")
add("split_point", """select c_custkey,
  case when c_custkey % 11 = 0 then '' when c_custkey % 13 = 0 then '48.5'
    else cast(c_custkey % 90 as varchar) || '.25' end as latitude,
  case when c_custkey % 11 = 0 or c_custkey % 13 = 0 then null
    else cast(c_custkey % 7 as varchar) || '.5, x' end as longitude from customer""")
add("keyword_columns", """select cast(c_custkey as varchar) as code_commune,
  c_name as libelle_commune, c_nationkey as nb_menages, c_acctbal as revenu_median,
  c_nationkey + 1 as revenu_d1, c_nationkey + 2 as revenu_d9, c_mktsegment as part_pensions_pct
from customer""")
add("run_log", """select 'run-1' as run_id, '2001-12-31' as logical_date,
  (select count(*) from v_raw) as raw_rows,
  (select count(distinct code_departement) from v_raw) as departements,
  (select count(*) from fact) as ventes, (select count(*) from gaps) as ventes_scorees""")

# ---- models ------------------------------------------------------------------------------

add("training_set", rounded(
    "transaction_id, date_mutation, annee, mois, code_departement, code_commune, type_bien, "
    "surface_habitable~, nb_pieces, surface_terrain~, nb_dependances, latitude~, longitude~, "
    "commune_lat~, commune_lon~, dist_gare_m~, nb_gares_1km, dist_gpe_m~, revenu_median_uc~, "
    "rapport_d9_d1~, part_dpe_fg_pct~, prix_m2~, t~, y~", "training"))
add("temporal_split", """select part, count(*) as n, min(annee) as de, max(annee) as a
from split group by 1""")
add("baseline_fallback", f"""select transaction_id, part, {rnd('prix_m2')} as prix_m2,
  {rnd('prediction_baseline')} as prediction_baseline from based""")
_APE = "abs(prediction_baseline - prix_m2) / prix_m2"
add("regression_metrics", f"""select part, count(*) as n,
  {even('avg(abs(prediction_baseline - prix_m2))', 0)} as mae,
  {even(f'median({_APE}) * 100', 1)} as mdape_pct,
  {even(f'avg(case when {_APE} <= 0.10 then 1e0 else 0e0 end) * 100', 1)} as part_10_pct,
  {even('''1 - sum(pow(ln(prix_m2) - ln(prediction_baseline), 2))
    / (var_pop(ln(prix_m2)) * count(*))''', 3)} as r2_log
from based group by 1""")
add("segment_errors", f"""select code_departement, count(*) as n,
  {rnd('median(prix_m2)')} as prix_m2_median, {even(f'median({_APE}) * 100', 1)} as mdape_pct
from based where part = 'test' group by 1""")
add("gap_pct", "select * from predictions")
add("leave_one_group_out_mean", f"""select transaction_id, annee, code_commune, type_bien,
  prix_m2, {rnd('((ts - s) / nullif(tn - n, 0))')} as prediction
from training join (select code_commune, type_bien, annee, sum(y) as s, count(*) as n,
    sum(sum(y)) over (partition by code_commune, type_bien) as ts,
    sum(count(*)) over (partition by code_commune, type_bien) as tn
  from training group by 1, 2, 3) using (code_commune, type_bien, annee)""")
add("group_demean", f"""select code_commune, transaction_id,
  {rnd('ln(surface_habitable)')} as x, {rnd('y')} as y,
  {rnd('(ln(surface_habitable) - avg(ln(surface_habitable)) over (partition by code_commune))')}
    as x_centre,
  {rnd('(y - avg(y) over (partition by code_commune))')} as y_centre from training""")
_CENTRED = """(select type_bien, code_commune,
  ln(surface_habitable) - avg(ln(surface_habitable)) over w as xc, y - avg(y) over w as yc
from training window w as (partition by type_bien, code_commune))"""
_SLOPES = f"""(select type_bien, sum(xc * yc) / sum(xc * xc) as b, sum(xc * xc) as sxx,
  count(*) as n, count(distinct code_commune) as g from {_CENTRED} group by 1)"""
add("within_slope", f"""select type_bien, {rnd('b')} as pente, n, g as groupes from {_SLOPES}""")
add("cluster_se_1d", f"""select type_bien, {rnd('''(sqrt(sum(u * u) * (any_value(g) /
    (any_value(g) - 1e0)) * (any_value(n) - 1) / greatest(any_value(n) - 1 - any_value(g), 1))
    / any_value(sxx))''')} as erreur_standard
from (select c.type_bien, c.code_commune, sum(c.xc * (c.yc - s.b * c.xc)) as u,
    any_value(s.g) as g, any_value(s.n) as n, any_value(s.sxx) as sxx
  from {_CENTRED} c join {_SLOPES} s using (type_bien) group by 1, 2) group by 1""")
add("hedonic_segments", """select g.zone, r.type_bien,
  count(distinct r.tranche_dist_gare) as bandes, count(distinct r.geo_key) as communes
from reliable r join places g using (geo_key)
where r.tranche_dist_gare is not null and r.nb_pieces > 0 group by 1, 2
having bandes >= 2 and communes >= 2""")
