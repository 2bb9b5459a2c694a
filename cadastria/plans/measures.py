"""Named measures evaluated under a filter context.

A context is a set of axis columns, slicer filters and an optional role. Filters run from the
dimensions to the fact and the gap mart, never back. All plain aggregates of a table come from one
grouped aggregation, all quantiles from one value count; measures that move the period are separate
branches. Only group-level rows are joined in the end.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastria.functions import columns as C
from cadastria.functions import constants as K
from cadastria.operators.grouping import dense_rank
from cadastria.operators.quantiles import exact_quantiles, from_counts, value_counts
from cadastria.operators.rolling import windowed_quantile
from cadastria.session import join_on, stored

ALL = "_all"
_CALENDAR = ["date", "annee", "trimestre", "annee_trimestre", "mois", "annee_mois", "nom_mois",
             "semestre", "semaine_iso", "est_weekend"]
_PLACE = ["zone", "nom_commune", "code_commune", "nom_departement", "code_departement"]
_SEGMENT = ["type_bien", "classe_pieces", "tranche_surface", "est_logement"]
_DIMENSIONS = [("calendar", "date_key", _CALENDAR), ("places", "geo_key", _PLACE),
               ("segments", "bien_key", _SEGMENT)]


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    calendar: DataFrame
    places: DataFrame
    segments: DataFrame
    gaps: DataFrame | None = None
    #: value counts of the fact that several measures of one evaluation read
    cube: DataFrame | None = None


@dataclass(frozen=True)
class Context:
    """``keep``/``drop`` map a column to its wanted/unwanted values; ``present`` lists columns that
    must not be NULL."""

    by: tuple[str, ...] = ()
    keep: dict[str, list] = field(default_factory=dict)
    drop: dict[str, list] = field(default_factory=dict)
    present: tuple[str, ...] = ()

    @property
    def time_axes(self) -> list[str]:
        return [a for a in self.by if a in _CALENDAR]

    @property
    def other_axes(self) -> list[str]:
        return [a for a in self.by if a not in _CALENDAR]

    def without_time(self) -> Context:
        def clear(d: dict) -> dict:
            return {k: v for k, v in d.items() if k not in _CALENDAR}

        return replace(self, by=tuple(self.other_axes), keep=clear(self.keep),
                       drop=clear(self.drop),
                       present=tuple(p for p in self.present if p not in _CALENDAR))

    def only_time(self) -> Context:
        def chosen(d: dict) -> dict:
            return {k: v for k, v in d.items() if k in _CALENDAR}

        return replace(self, by=tuple(self.time_axes), keep=chosen(self.keep), drop=chosen(self.drop),
                       present=tuple(p for p in self.present if p in _CALENDAR))

    def columns(self) -> list[str]:
        return list(dict.fromkeys([*self.by, *self.keep, *self.drop, *self.present]))

    def predicate(self, owned: list[str]) -> list[Column]:
        conds = [F.col(c).isin(v) for c, v in self.keep.items() if c in owned]
        conds += [~F.col(c).isin(v) for c, v in self.drop.items() if c in owned]
        return conds + [F.col(c).isNotNull() for c in self.present if c in owned]


# ---- roles -------------------------------------------------------------------------------

def secure(star: Star, role: str | None) -> Star:
    """What a role may see: its zone's places, and the sales and gaps of those places."""
    if role is None:
        return star
    if role not in K.ZONES:
        raise ValueError(f"unknown role {role!r}")
    seen = star.places.filter(F.col("zone") == role)
    keys = seen.select("geo_key")
    return replace(
        star, places=seen, fact=star.fact.join(keys, "geo_key", "left_semi"),
        gaps=None if star.gaps is None else star.gaps.join(keys, "geo_key", "left_semi"),
    )


# ---- rows in context ---------------------------------------------------------------------

def context_rows(star: Star, table: str, ctx: Context, need: tuple[str, ...] = (),
                 months: int = 0) -> DataFrame:
    """Rows of the fact or the gaps with the axis columns joined and the filters applied.

    ``months`` moves every sale forward in the calendar: a sale seen 12 months later is last
    year's value of the period it lands in; outside the calendar it is not seen at all.
    """
    rows = getattr(star, table)
    wanted = list(dict.fromkeys([*ctx.columns(), *need]))
    if months:
        rows = rows.withColumn("date_mutation", F.add_months("date_mutation", months))
        rows = rows.withColumn("date_key", C.date_key("date_mutation"))
    for name, key, owned in _DIMENSIONS:
        columns = [w for w in wanted if w in owned]
        moved = name == "calendar" and months
        if columns or moved:
            conds = ctx.predicate(columns)
            dim = getattr(star, name).select(key, *columns).filter(_all(conds))
            rows = rows.drop(*columns).join(
                dim, key, "inner" if conds or moved else "left")
    own = [c for c in wanted if not any(c in owned for _, _, owned in _DIMENSIONS)]
    return rows.filter(_all(ctx.predicate(own))).withColumn(ALL, F.lit(1))


def _all(conds: list[Column]) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


# ---- measures ----------------------------------------------------------------------------

def _reliable() -> Column:
    return F.col("est_prix_m2_fiable")


def _simple() -> Column:
    return F.coalesce(F.col("est_vente_simple"), F.lit(False))


def _counted() -> Column:
    return F.nullif(F.count("*"), F.lit(0).cast("bigint"))


def _place_near(limit: int | None) -> Column:
    near = F.col("dist_gare_m")
    return F.count_if(_simple() & (near.isNotNull() if limit is None else near < limit))


# name -> (table, aggregate)
PLAIN: dict[str, tuple[str, Callable[[], Column]]] = {
    "nb_ventes": ("fact", _counted),
    "volume_ventes": ("fact", lambda: F.sum(
        F.col("valeur_fonciere").cast("decimal(18,2)")).cast("double")),
    "prix_m2_moyen": ("fact", lambda: C.exact_avg(F.when(_reliable(), F.col("prix_m2")))),
    "part_ventes_fiables": ("fact", lambda: C.ratio(F.count_if(_reliable()), F.count("*"))),
    "part_ventes_simples": ("fact", lambda: C.ratio(F.count_if(_simple()), F.count("*"))),
    "nb_ventes_ecartees": ("fact", lambda: F.count("*") - F.count_if(_reliable())),
    "part_ventes_500m": ("fact", lambda: C.ratio(_place_near(500), _place_near(None))),
    "nb_ventes_scorees": ("gaps", _counted),
    "part_sous_marche": ("gaps", lambda: C.ratio(
        F.count_if(F.col("ecart_pct") <= -10), F.count("*"))),
}

# name -> (table, value, whether the values have a small domain)
MEDIANS: dict[str, tuple[str, Callable[[], Column], bool]] = {
    "prix_m2_median": ("fact", lambda: F.when(_reliable(), F.col("prix_m2")), True),
    "distance_mediane_gare": ("fact", lambda: F.when(_simple(), F.col("dist_gare_m")), True),
    "prix_median_vente": ("fact", lambda: F.when(_simple(), F.col("valeur_fonciere")), False),
    "surface_mediane": ("fact", lambda: F.when(_simple(), F.col("surface_habitable")), False),
    "ecart_median_modele": ("gaps", lambda: F.col("ecart_pct"), True),
    "ecart_absolu_median": ("gaps", lambda: F.abs("ecart_pct"), True),
    "prix_m2_predit_median": ("gaps", lambda: F.col("prix_m2_predit"), True),
    "prix_m2_reel_median": ("gaps", lambda: F.col("prix_m2"), True),
}
_PERCENT = ["ecart_median_modele", "ecart_absolu_median"]

PLACE_MEASURES: dict[str, Callable[[], Column]] = {
    "revenu_median_communal": lambda: C.exact_avg("revenu_median_uc"),
    "part_passoires_dpe": lambda: F.try_divide(
        C.exact_sum(F.col("nb_dpe") * F.col("part_dpe_fg_pct") / 100.0),
        F.sum("nb_dpe").cast("double")),
}


def _plain(star: Star, ctx: Context, names: list[str]) -> dict[str, DataFrame]:
    out = {}
    for table in ("fact", "gaps"):
        chosen = [n for n in names if n in PLAIN and PLAIN[n][0] == table]
        if chosen:
            rows = context_rows(star, table, ctx)
            out[f"plain_{table}"] = rows.groupBy(ALL, *ctx.by).agg(
                *[PLAIN[n][1]().alias(n) for n in chosen])
    return out


def _medians(star: Star, ctx: Context, names: list[str], months: int = 0) -> dict[str, DataFrame]:
    out = {}
    for table in ("fact", "gaps"):
        for bounded in (True, False):
            chosen = [n for n in names
                      if n in MEDIANS and MEDIANS[n][0] == table and MEDIANS[n][2] == bounded]
            if not chosen:
                continue
            keys, specs = [ALL, *ctx.by], {n: (MEDIANS[n][1](), 0.5) for n in chosen}
            if table == "fact" and star.cube is not None:
                cells = cube_rows(star, ctx, chosen, months).groupBy(*keys, "_m", "_v").agg(F.sum("_n").alias("_n"))
                found = from_counts(cells, keys, specs, bounded)
            else:
                found = exact_quantiles(context_rows(star, table, ctx, months=months), keys, specs, bounded)
            scaled = {n: F.col(n) / 100.0 for n in chosen if n in _PERCENT}
            out[f"median_{table}_{bounded}"] = found.withColumns(scaled) if scaled else found
    return out


# ---- the cube ----------------------------------------------------------------------------

SALES = "ventes"  # the measure of the cube that counts every sale in context


def _cube_measures() -> dict[str, Column]:
    medians = {n: value() for n, (table, value, _) in MEDIANS.items() if table == "fact"}
    return {SALES: F.lit(0.0), **medians}


def with_cube(star: Star, ctx: Context, names: list[str]) -> Star:
    """``star`` with value counts by the other axes and day, if more than one branch would scan the fact for values.

    The counts hold for any time in context: periods, their prior years and windows are joined to the days.
    """
    medians = [n for n in names if n in MEDIANS and MEDIANS[n][0] == "fact"]
    scans = [*{MEDIANS[n][2] for n in medians}, *[n for n in names if n in ("prix_m2_median_n1", *_BRANCHES)]]
    if len(scans) < 2:
        return star
    needed = {SALES, *medians, "prix_m2_median"}
    specs = {n: (value, 0.5) for n, value in _cube_measures().items() if n in needed}
    axes = [ALL, *dict.fromkeys([*ctx.other_axes, "zone"])]
    counts = value_counts(context_rows(star, "fact", ctx.without_time(), need=("zone",)), [*axes, "date_mutation"], specs)
    ids = F.array(*[F.lit(n) for n in specs])
    return replace(star, cube=stored(counts.withColumn("measure", F.element_at(ids, F.col("_m") + 1)).drop("_m")))


def cube_rows(star: Star, ctx: Context, measures: list[str], months: int = 0) -> DataFrame:
    """Counts of ``measures``, numbered in their order (_m), in the time of ``ctx``."""
    cube = star.cube.filter(F.col("measure").isin(measures)).withColumn("date_key", C.date_key("date_mutation"))
    number = F.array_position(F.array(*[F.lit(m) for m in measures]), F.col("measure")) - 1
    rows = context_rows(replace(star, cube=cube), "cube", ctx.only_time(), months=months)
    return rows.withColumn("_m", number.cast("int"))


def _sale_days(star: Star, ctx: Context, need: tuple[str, ...] = ()) -> DataFrame:
    """The days of all sales in context, with the axes."""
    return context_rows(star, "fact", ctx, need) if star.cube is None else cube_rows(star, ctx, [SALES])


def _reliable_counts(star: Star, ctx: Context, keys: list[str], need: tuple[str, ...] = ()) -> DataFrame:
    """Counts (keys, _m, _v, _n) of reliable prices in context."""
    if star.cube is not None:
        return cube_rows(star, ctx, ["prix_m2_median"])
    rows = context_rows(star, "fact", ctx, need).filter(_reliable())
    return value_counts(rows, keys, {"prix": (F.col("prix_m2"), 0.5)})


def _prior_year(star: Star, ctx: Context, names: list[str]) -> dict[str, DataFrame]:
    """Same period last year: every sale seen twelve months later."""
    out = {}
    if "nb_ventes_n1" in names:
        if star.cube is not None:
            count = F.sum("_n")
            rows = cube_rows(star, ctx, [SALES], months=12)
        else:
            count = _counted()
            rows = context_rows(star, "fact", ctx, months=12)
        out["n1_count"] = rows.groupBy(ALL, *ctx.by).agg(count.alias("nb_ventes_n1"))
    if "prix_m2_median_n1" in names:
        found = _medians(star, ctx, ["prix_m2_median"], months=12)["median_fact_True"]
        out["n1_median"] = found.withColumnRenamed("prix_m2_median", "prix_m2_median_n1")
    return out


def _day(date: Column | str) -> Column:
    return F.unix_date(date)


def _daily(star: Star, ctx: Context) -> DataFrame:
    """Counts of reliable prices by group of the other axes and day, whatever the time in context."""
    axes = [ALL, *ctx.other_axes]
    counts = _reliable_counts(star, ctx.without_time(), [*axes, "date_mutation"]).select(
        F.struct(*axes).alias("_g"), _day("date_mutation").alias("_at"), "_v", "_n")
    return counts if star.cube is not None else stored(counts)


def _rolling(star: Star, ctx: Context) -> DataFrame:
    """Median over the twelve months that end with the last day of each period."""
    days = star.calendar.filter(_all(ctx.predicate(_CALENDAR))).withColumn(ALL, F.lit(1))
    daily = _daily(star, ctx)
    periods = days.groupBy(ALL, *ctx.time_axes).agg(F.max("date").alias("_end")).select(
        F.struct(ALL, *ctx.time_axes).alias("_w"), (_day(F.add_months("_end", -12)) + 1).alias("_from"), _day("_end").alias("_to"))
    # every period for every member of the other axes
    groups = daily.select("_g").distinct()
    windows = groups.join(periods, F.col(f"_g.{ALL}") == F.col(f"_w.{ALL}"))
    found = windowed_quantile(daily, windows, 0.5, "prix_m2_median_12m")
    return found.select(F.col(f"_g.{ALL}").alias(ALL), *[
        F.col(f"_w.{a}" if a in ctx.time_axes else f"_g.{a}").alias(a) for a in ctx.by], "prix_m2_median_12m")


def _last_year_change(star: Star, ctx: Context) -> DataFrame:
    """Twelve months up to the last sale in context against the twelve months before."""
    keys, others = [ALL, *ctx.by], [ALL, *ctx.other_axes]
    ends = _sale_days(star, ctx).groupBy(*keys).agg(F.max("date_mutation").alias("_end"))
    middle, start = F.add_months("_end", -12), F.add_months(F.add_months("_end", -12), -12)
    side = lambda name, first, last: F.struct(
        F.lit(name).alias("side"), (_day(first) + 1).alias("_from"), _day(last).alias("_to"))
    windows = ends.select(*keys, F.explode(F.array(side("cur", middle, F.col("_end")), side("prev", start, middle))).alias("_s")).select(
        F.struct(*others).alias("_g"), F.struct(*keys, "_s.side").alias("_w"), "_s._from", "_s._to")
    found = windowed_quantile(_daily(star, ctx), windows, 0.5, "_value").select("_w.*", "_value")
    of = lambda name: F.max(F.when(F.col("side") == name, F.col("_value")))
    return found.groupBy(*keys).agg(C.blank_change(of("cur"), of("prev")).alias("evolution_prix_m2_12m"))


def _since_first_year(star: Star, ctx: Context) -> DataFrame:
    """Change since the first year with sales, outside the city; blank without a current value."""
    keys, others = [ALL, *ctx.by], [ALL, *ctx.other_axes]
    outside = F.coalesce(F.col("zone") != K.ZONE_CITY, F.lit(True))
    whole = ctx.without_time()
    first = _sale_days(star, whole, ("zone",)).groupBy(*others).agg(F.year(F.min("date_mutation")).alias("_first"))

    def median(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
        cells = counts.groupBy(*keys, "_m", "_v").agg(F.sum("_n").alias("_n"))
        return from_counts(cells, keys, {name: (F.col("prix_m2"), 0.5)}, bounded=True)

    zoned = list(dict.fromkeys([*others, "zone"]))
    early = _reliable_counts(star, whole, [*zoned, "date_mutation"], ("zone",)).filter(outside)
    base = median(join_on(early, first, others).filter(F.year("date_mutation") == F.col("_first")), others, "_base")
    now = _reliable_counts(star, ctx, list(dict.fromkeys([*keys, "zone"])), ("zone",)).filter(outside)
    current = median(now, keys, "_cur")
    return join_on(current, base, others, "left").select(
        *keys, F.try_divide(F.col("_cur") - F.col("_base"), F.col("_base"))
        .alias("evolution_depuis_1re_annee"))


def _place_measures(star: Star, ctx: Context, names: list[str]) -> tuple[list[str], DataFrame]:
    """Unweighted over places: neither time nor sales reach the place dimension."""
    axes = [ALL, *[a for a in ctx.by if a in _PLACE]]
    rows = star.places.withColumn(ALL, F.lit(1)).filter(_all(ctx.predicate(_PLACE)))
    return axes, rows.groupBy(*axes).agg(*[PLACE_MEASURES[n]().alias(n) for n in names])


_CHANGES = {
    "evolution_volume": ("nb_ventes", "nb_ventes_n1"),
    "evolution_prix_m2": ("prix_m2_median", "prix_m2_median_n1"),
}
_BRANCHES: dict[str, Callable[[Star, Context], DataFrame]] = {
    "prix_m2_median_12m": _rolling,
    "evolution_prix_m2_12m": _last_year_change,
    "evolution_depuis_1re_annee": _since_first_year,
}
RANK = "rang_commune"
MEASURES = [
    "nb_ventes", "volume_ventes", "nb_ventes_n1", "evolution_volume", "prix_m2_median",
    "prix_m2_moyen", "prix_median_vente", "surface_mediane", "prix_m2_median_n1",
    "evolution_prix_m2", "prix_m2_median_12m", "part_ventes_fiables", "part_ventes_simples",
    "nb_ventes_ecartees", "nb_ventes_scorees", "ecart_median_modele", "ecart_absolu_median",
    "part_sous_marche", "prix_m2_predit_median", "prix_m2_reel_median", "evolution_prix_m2_12m",
    "distance_mediane_gare", "part_ventes_500m", "revenu_median_communal", "part_passoires_dpe",
    "evolution_depuis_1re_annee", RANK,
]


def evaluate(star: Star, measures: list[str], ctx: Context = Context(),
             role: str | None = None) -> DataFrame:
    """One row per axis member for which any measure has a value."""
    unknown = [m for m in measures if m not in MEASURES]
    if unknown:
        raise ValueError(f"unknown measures {unknown}")
    star = secure(star, role)
    names = list(measures)
    for m in measures:
        names += _CHANGES.get(m, ())
        names += ["prix_m2_median"] if m == RANK else []
    names = list(dict.fromkeys(names))
    star = with_cube(star, ctx, names)
    branches = [
        *_plain(star, ctx, names).values(),
        *_medians(star, ctx, names).values(),
        *_prior_year(star, ctx, names).values(),
        *[make(star, ctx) for name, make in _BRANCHES.items() if name in names],
    ]
    keys = [ALL, *ctx.by]
    result = None
    for branch in branches:
        result = branch if result is None else join_on(result, branch, keys, "full")
    places = [n for n in names if n in PLACE_MEASURES]
    if places:
        axes, found = _place_measures(star, ctx, places)
        result = found if result is None else join_on(result, found, axes, "left")
    for name, (cur, prev) in _CHANGES.items():
        if name in names:
            result = result.withColumn(name, C.blank_change(F.col(cur), F.col(prev)))
    if RANK in names:
        result = dense_rank(result, "prix_m2_median", RANK)
    return result.select(*[c for c in ctx.by if c in result.columns], *measures)


def with_totals(star: Star, ctx: Context, measure: str = "prix_m2_median") -> DataFrame:
    """Matrix of a median with row, column and grand totals; medians do not add up, so totals are
    taken over value counts, which are small next to the rows."""
    table, value, bounded = MEDIANS[measure]
    rows, columns = ctx.by
    spec = {measure: (value(), 0.5)}
    counts = value_counts(context_rows(star, table, ctx), [rows, columns], spec)
    cells = counts.groupingSets(
        [[rows, columns, "_m", "_v"], [rows, "_m", "_v"], [columns, "_m", "_v"], ["_m", "_v"]],
        rows, columns, "_m", "_v",
    ).agg(
        (F.grouping(rows).cast("int") * 2 + F.grouping(columns).cast("int")).alias("niveau"),
        F.sum("_n").alias("_n"),
    )
    return from_counts(cells, ["niveau", rows, columns], spec, bounded)
