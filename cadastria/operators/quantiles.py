"""Exact grouped quantiles that stay distributed when one group holds most of the rows.

The plain ``percentile`` aggregate ships one value map per map task to the single task that owns a
group. Here the rows are first counted per (group, value), which spreads any hot group over the
cluster; what happens next depends on the values:

* ``bounded=True``: the value domain is small by construction (cents between 1 000 and 30 000,
  whole metres up to 10 000, tenths of a percent), so one group has few distinct values and the
  frequency form of ``percentile`` finishes the work;
* otherwise the wanted ranks are located in order-preserving value buckets first, and only the
  buckets that hold a wanted rank are sorted.

Both give the interpolated quantile, the one a spreadsheet or pandas would give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_DOUBLING = 1024
_SMALLEST = 1075  # doublings below one that a double can hold
Spec = tuple[Column, float]


def value_bucket(v: Column) -> Column:
    """Non-decreasing in ``v``; 0.07 % of the value wide at any magnitude, on either side of zero."""
    size = F.abs(v)
    inside = (F.floor(F.log2(size) * BUCKETS_PER_DOUBLING) + _SMALLEST * BUCKETS_PER_DOUBLING + 1)
    last = 2 * _SMALLEST * BUCKETS_PER_DOUBLING
    return F.when(v == 0, 0).when(size == float("inf"), F.signum(v) * last).otherwise(
        F.signum(v) * inside).cast("int")


def _values(specs: dict[str, Spec]) -> dict[str, Column]:
    """Distinct value expressions; several quantiles of one value are counted once."""
    return {str(value): value for value, _ in specs.values()}


def _measure_of(specs: dict[str, Spec]) -> dict[str, int]:
    order = list(_values(specs))
    return {alias: order.index(str(value)) for alias, (value, _) in specs.items()}


def value_counts(df: DataFrame, keys: list[str], specs: dict[str, Spec]) -> DataFrame:
    """Long (keys, _m, _v, _n): how often each value of each measure occurs in each group.

    Missing values and NaN don't count.
    """
    tagged = [
        F.struct(F.lit(i).alias("_m"), value.cast("double").alias("_v"))
        for i, value in enumerate(_values(specs).values())
    ]
    long = df.select(*keys, F.explode(F.array(*tagged)).alias("_t")).select(
        *keys, "_t._m", "_t._v").filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return long.groupBy(*keys, "_m", "_v").agg(F.count("*").alias("_n"))


def from_counts(counts: DataFrame, keys: list[str], specs: dict[str, Spec],
                bounded: bool) -> DataFrame:
    return _by_frequency(counts, keys, specs) if bounded else _by_rank(counts, keys, specs)


def totals_from_counts(counts: DataFrame, sets: list[list[str]], specs: dict[str, Spec]) -> DataFrame:
    """Quantiles of bounded values for several groupings of one table of counts.

    One row per grouping (``_set``, its place in ``sets``) and group; keys that a grouping leaves out are NULL.
    """
    keys = list(dict.fromkeys(k for s in sets for k in s))
    tagged = counts.withColumn("_set", F.explode(F.lit(list(range(len(sets))))))
    kept = {k: F.when(F.col("_set").isin([i for i, s in enumerate(sets) if k in s]), F.col(k)).alias(k) for k in keys}
    rolled = tagged.groupBy("_set", *kept.values(), "_m", "_v").agg(F.sum("_n").alias("_n"))
    return _by_frequency(rolled, ["_set", *keys], specs)


def exact_quantiles(df: DataFrame, keys: list[str], specs: dict[str, Spec],
                    bounded: bool = False) -> DataFrame:
    """One row per group that has a value: ``keys`` and one column per spec (value, probability)."""
    return from_counts(value_counts(df, keys, specs), keys, specs, bounded)


def approx_quantiles(df: DataFrame, keys: list[str], specs: dict[str, Spec],
                     accuracy: int = 10_000) -> DataFrame:
    """Element quantiles from mergeable sketches, as a warehouse's approximate function returns."""
    return df.groupBy(*keys).agg(
        *[F.percentile_approx(v, F.lit(p), accuracy).alias(a) for a, (v, p) in specs.items()]
    )


def _by_frequency(counts: DataFrame, keys: list[str], specs: dict[str, Spec]) -> DataFrame:
    measure = _measure_of(specs)
    return counts.groupBy(*keys).agg(*[
        F.expr(f"percentile(_v, {p}D, _n) FILTER (WHERE _m = {measure[alias]})").alias(alias)
        for alias, (_, p) in specs.items()
    ])


def _by_rank(counts: DataFrame, keys: list[str], specs: dict[str, Spec]) -> DataFrame:
    measure = _measure_of(specs)
    probs = [
        sorted({p for a, (_, p) in specs.items() if measure[a] == m})
        for m in range(len(_values(specs)))
    ]
    # one struct for the group and the measure: it joins and hashes as a whole, NULLs included
    placed = counts.select(
        F.struct(*keys, "_m").alias("_k"), "_v", "_n", value_bucket(F.col("_v")).alias("_b")
    ).filter(F.col("_b").isNotNull())  # as the join will infer; both uses then share the counts
    group = Window.partitionBy("_k")
    wanted_probs = F.element_at(
        F.array(*[F.array(*[F.lit(float(p)) for p in ps]) for ps in probs]), F.col("_k._m") + 1)
    wanted = (
        placed.groupBy("_k", "_b").agg(F.sum("_n").alias("_bn"))
        .withColumn("_upto", F.sum("_bn").over(
            group.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_total", F.sum("_bn").over(group))
        .withColumn("_p", F.explode(wanted_probs))
        .withColumn("_pos", (F.col("_total") - 1) * F.col("_p"))
        .withColumn("_below", F.col("_upto") - F.col("_bn"))
        .withColumn("_lo", F.floor("_pos")).withColumn("_hi", F.ceil("_pos"))
        .filter((F.col("_below") <= F.col("_hi")) & (F.col("_lo") < F.col("_upto")))
        .select("_k", "_b", "_below", "_p", "_pos", "_lo", "_hi")
    )
    inside = Window.partitionBy("_k", "_b", "_p").orderBy("_v")
    ranked = (
        placed.join(wanted, ["_k", "_b"])
        .withColumn("_to", F.col("_below") + F.sum("_n").over(
            inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_from", F.col("_to") - F.col("_n"))
        .select(*[F.col(f"_k.{c}").alias(c) for c in [*keys, "_m"]], "_p", "_v", "_pos", "_lo",
                "_hi", "_from", "_to")
    )
    aggs = []
    for alias, (_, p) in specs.items():
        mine = (F.col("_m") == measure[alias]) & (F.col("_p") == float(p))

        def at(rank: str, mine: Column = mine) -> Column:
            hit = mine & (F.col("_from") <= F.col(rank)) & (F.col(rank) < F.col("_to"))
            return F.max(F.when(hit, F.col("_v")))

        frac = F.max(F.when(mine, F.col("_pos") - F.col("_lo")))
        aggs.append((at("_lo") * (1.0 - frac) + at("_hi") * frac).alias(alias))
    return ranked.groupBy(*keys).agg(*aggs)
