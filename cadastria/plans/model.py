"""Price model: training set, split, baseline, metrics, out-of-sample predictions, boosted trees."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastria.functions import columns as C
from cadastria.operators.quantiles import exact_quantiles, totals_from_counts, value_counts
from cadastria.session import checkpointed, join_on

# Model columns and the origin of the continuous time variable.
CATEGORIES = ["code_departement", "code_commune", "type_bien"]
NUMBERS = ["surface_habitable", "nb_pieces", "surface_terrain", "nb_dependances", "latitude",
           "longitude", "commune_lat", "commune_lon", "mois", "t"]
ENRICHMENT = ["dist_gare_m", "nb_gares_1km", "dist_gpe_m", "revenu_median_uc", "rapport_d9_d1",
              "part_dpe_fg_pct"]
TIME_ORIGIN = "2021-01-01"

FitFn = Callable[[DataFrame], object]  # returns something with transform(df) -> df + prediction


def training_set(fact: DataFrame, places: DataFrame) -> DataFrame:
    """Reliable sales with place context, log target and centroid fallback for coordinates."""
    context = places.select(
        "geo_key", F.col("latitude").alias("commune_lat"), F.col("longitude").alias("commune_lon"),
        "revenu_median_uc", "rapport_d9_d1", "part_dpe_fg_pct")
    day = F.col("date_mutation")
    return fact.filter("est_prix_m2_fiable").join(context, "geo_key").select(
        "transaction_id", "date_mutation", F.year(day).alias("annee"), F.month(day).alias("mois"),
        "code_departement", F.col("geo_key").alias("code_commune"), "type_bien",
        "surface_habitable", "nb_pieces",
        F.coalesce("surface_terrain", F.lit(0.0)).alias("surface_terrain"), "nb_dependances",
        F.coalesce("latitude", "commune_lat").alias("latitude"),
        F.coalesce("longitude", "commune_lon").alias("longitude"),
        "commune_lat", "commune_lon", "dist_gare_m", "nb_gares_1km", "dist_gpe_m",
        "revenu_median_uc", "rapport_d9_d1", "part_dpe_fg_pct", "prix_m2",
        (F.datediff(day, F.lit(TIME_ORIGIN).cast("date")) / 365.25).alias("t"),
        F.log("prix_m2").alias("y"),
    )


def temporal_split(df: DataFrame, year: str = "annee") -> DataFrame:
    """'test' is the last year, 'valid' the one before, 'train' everything older."""
    last = df.select(F.max(year)).scalar()
    behind = last - F.col(year)
    return df.withColumn(
        "part", F.when(behind == 0, "test").when(behind == 1, "valid").otherwise("train"))


# ---- baseline ----------------------------------------------------------------------------

def baseline(train: DataFrame, other: DataFrame, target: str = "prix_m2") -> DataFrame:
    """Median of commune and type, else of department and type, else of everything.

    One pass over the training rows: prices are counted once, the three medians are roll-ups of the counts.
    """
    place, dep, kind = "code_commune", "code_departement", "type_bien"
    price = {"_m": (F.col(target), 0.5)}
    counts = value_counts(train, [place, dep, kind], price)
    levels = checkpointed(totals_from_counts(counts, [[place, kind], [dep, kind], []], price))

    def medians(level: int, keys: list[str], name: str) -> DataFrame:
        return levels.filter(F.col("_set") == level).select(*keys, F.col("_m").alias(name))

    overall = medians(2, [], "_m").scalar()
    return (
        other.join(medians(0, [place, kind], "_place"), [place, kind], "left")
        .join(medians(1, [dep, kind], "_dep"), [dep, kind], "left")
        .withColumn("prediction_baseline", F.coalesce("_place", "_dep", overall))
        .drop("_place", "_dep")
    )


# ---- metrics -----------------------------------------------------------------------------

def regression_metrics(df: DataFrame, actual: str, predicted: str,
                       by: list[str] | None = None) -> DataFrame:
    """MAE, median relative error, share within 10 % and R2 on logs; one row per ``by`` group."""
    keys = ["_all", *(by or [])]
    y, p = F.col(actual), F.col(predicted)
    ape = F.abs(p - y) / y
    rows = df.withColumn("_all", F.lit(1)).withColumn("_ape", ape)
    sums = rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        C.exact_avg(F.abs(p - y)).alias("mae"),
        F.avg((ape <= 0.10).cast("double")).alias("within"),
        F.sum(F.pow(F.log(y) - F.log(p), F.lit(2.0))).alias("sse"),
        (F.var_pop(F.log(y)) * F.count("*")).alias("sst"),
    )
    medians = exact_quantiles(rows, keys, {"mdape": (F.col("_ape"), 0.5)})
    r2 = F.when(F.col("sst") > 0, 1 - F.col("sse") / F.col("sst")).otherwise(
        F.when(F.col("sse") == 0, 1.0).otherwise(0.0))
    return join_on(sums, medians, keys).select(
        *(by or []), "n",
        C.round_half_even("mae", 0).alias("mae"),
        C.round_half_even(F.col("mdape") * 100, 1).alias("mdape_pct"),
        C.round_half_even(F.col("within") * 100, 1).alias("part_10_pct"),
        C.round_half_even(r2, 3).alias("r2_log"),
    )


def segment_errors(df: DataFrame, predicted: str, by: str, actual: str = "prix_m2") -> DataFrame:
    """Median relative error per segment, hardest first; a missing segment is left out."""
    kept = df.filter(F.col(by).isNotNull())
    ape = F.abs(F.col(predicted) - F.col(actual)) / F.col(actual)
    counts = kept.groupBy(by).agg(F.count("*").alias("n"))
    medians = exact_quantiles(kept, [by], {
        "prix_m2_median": (F.col(actual), 0.5), "mdape": (ape, 0.5)})
    return join_on(counts, medians, [by]).select(
        by, "n", "prix_m2_median",
        C.round_half_even(F.col("mdape") * 100, 1).alias("mdape_pct"),
    ).orderBy(F.col("mdape_pct").desc(), by)


# ---- out of sample -----------------------------------------------------------------------

def leave_one_group_out(df: DataFrame, fit: FitFn, group: str = "annee",
                        parallelism: int = 4) -> DataFrame:
    """Predict every group with a model fitted on the others; back from logs to prices.

    The loop runs over the distinct groups (years), never over rows; fits are independent jobs, so
    a few of them are submitted at a time, as cross-validation does.
    """
    groups = [r[0] for r in df.select(group).distinct().orderBy(group).collect()]
    if len(groups) < 2:
        raise ValueError(f"at least two values of {group!r} are needed, found {groups}")
    with ThreadPool(min(parallelism, len(groups))) as pool:
        models = pool.map(lambda g: fit(df.filter(F.col(group) != g)), groups)
    held = [m.transform(df.filter(F.col(group) == g)) for m, g in zip(models, groups, strict=True)]
    out = held[0]
    for part in held[1:]:
        out = out.unionByName(part)
    return out.withColumn("prix_m2_predit", F.exp("prediction"))


def leave_one_group_out_mean(df: DataFrame, by: list[str], target: Column,
                             group: str = "annee") -> DataFrame:
    """The same with the mean of ``target`` per ``by`` as the model, in closed form: the sums of
    everything minus the sums of the own group. No refit, one small join."""
    values = df.withColumn("_y", target.cast("decimal(20,12)"))
    per_group = values.groupBy(*by, group).agg(F.sum("_y").alias("_s"), F.count("_y").alias("_n"))
    total = per_group.groupBy(*by).agg(F.sum("_s").alias("_ts"), F.sum("_n").alias("_tn"))
    rest = join_on(per_group, total, by).select(
        *by, group,
        C.ratio(F.col("_ts") - F.col("_s"), F.col("_tn") - F.col("_n")).alias("prediction"))
    return join_on(df, rest, [*by, group], "left")


def scored(df: DataFrame) -> DataFrame:
    """Predictions in whole euros and the gap to the already rounded prediction."""
    rounded = df.withColumn("prix_m2_predit", C.round_half_even(F.exp("prediction"), 0))
    return rounded.withColumn("ecart_pct", C.gap_pct("prix_m2", "prix_m2_predit"))


def mean_log_model_predictions(fact: DataFrame, by: list[str]) -> DataFrame:
    """Out-of-sample predictions of the mean-log model, one row per reliable sale."""
    rows = fact.filter("est_prix_m2_fiable").select(
        "transaction_id", "prix_m2", F.year("date_mutation").alias("annee"), *by)
    return scored(leave_one_group_out_mean(rows, by, F.log("prix_m2"))).select(
        "transaction_id", "prix_m2_predit", "ecart_pct")
