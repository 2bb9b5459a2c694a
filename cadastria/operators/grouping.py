"""Majority value, global ranks and quantile classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastria.functions import constants as K
from cadastria.session import checkpointed

_ROW_BITS = 33


def frequency_order(count: Column, value: Column) -> Column:
    """Most frequent first, then smallest value; a missing value is a value, but the last one."""
    return F.struct((-count).alias("n"), value.isNull().alias("missing"), value.alias("v"))


def majority_value(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Most frequent value per group for several columns, with partial aggregation throughout."""
    tagged = F.array(*[
        F.struct(F.lit(v).alias("_c"), F.col(v).cast("string").alias("_v")) for v in values
    ])
    counts = (
        df.select(*keys, F.explode(tagged).alias("_t"))
        .groupBy(*keys, F.col("_t._c").alias("_c"), F.col("_t._v").alias("_v"))
        .agg(F.count("*").alias("_n"))
    )
    order = frequency_order(F.col("_n"), F.col("_v"))
    return counts.groupBy(*keys).agg(*[
        F.min_by(F.when(F.col("_c") == v, F.col("_v")), F.when(F.col("_c") == v, order)).alias(v)
        for v in values
    ])


def global_row_number(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """1..n over the whole frame: a range-partitioned sort plus one offset per partition.

    The sorted frame is checkpointed, since range bounds are sampled and must not be drawn twice.
    """
    placed = checkpointed(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    part = F.shiftright("_pos", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )  # one row per partition
    row = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + row + 1)
        .drop("_part", "_pos", "_offset")
    )


def dense_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """Dense rank of ``value``, descending, over the whole frame; a missing value ranks as 0."""
    score = F.coalesce(F.col(value), F.lit(0.0))
    scored = df.withColumn("_score", score)
    ranks = global_row_number(
        scored.select("_score").distinct(), [F.col("_score").desc()], name
    )
    return scored.join(ranks, "_score").drop("_score")


def quantile_class(df: DataFrame, value: str, tie: list[str], classes: int,
                   name: str) -> DataFrame:
    """Equal-frequency class 0..k-1 on first-come ranks; fewer classes if values are few."""
    rows = df.select(F.count("*")).scalar()
    values = df.select(F.count_distinct(value)).scalar()
    ranked = global_row_number(df, [F.col(value), *[F.col(t) for t in tie]], "_r")
    sized = ranked.withColumn("_k", F.least(F.lit(classes), values)).withColumn("_n", rows)
    spread = (F.col("_r") - 1) * F.col("_k") / (F.col("_n") - 1).cast("double")
    return sized.withColumn(name, F.when(F.col("_k") < 2, 0).otherwise(
        F.greatest(F.ceil(spread) - 1, F.lit(0))).cast("int")).drop("_r", "_n")


def colour_by_price(df: DataFrame, value: str = "prix_m2_median",
                    tie: tuple[str, ...] = ("code_commune",)) -> DataFrame:
    """Palette colour per price class and a map radius that grows with the number of sales."""
    classed = quantile_class(df, value, list(tie), len(K.PALETTE), "classe")
    last = len(K.PALETTE) - 1
    step = F.floor(F.col("classe") * last / F.greatest(F.col("_k") - 1, F.lit(1)))
    return (
        classed
        .withColumn("couleur", F.element_at(F.array(*[F.lit(c) for c in K.PALETTE]),
                                            (step + 1).cast("int")))
        .withColumn("rayon", 150.0 + 40.0 * F.sqrt(F.least(F.col("nb_ventes"), F.lit(400))))
        .drop("_k")
    )
