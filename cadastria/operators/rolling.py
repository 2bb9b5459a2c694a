"""Quantiles over sliding windows, from prefix counts rather than copies of the rows.

Rows are counted per (group, time, value). A window holds what the running count at its end has more than
the one before its start, so its rank is found in value buckets from two prefixes each, whatever its length:
wide buckets first, then the narrow ones in the wide bucket that holds the rank. Only values in that narrow
bucket, 0.07 % of a value wide, are copied into the windows that want them and sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastria.operators.quantiles import value_bucket, value_counts
from cadastria.session import stored

#: Narrow buckets in a wide one: 32 wide ones cover a doubling of the value.
NARROW = 32


def _in_windows(cells: DataFrame, windows: DataFrame, bucket: str) -> DataFrame:
    """(_g, _w, bucket, _n) of every bucket that a window holds, by the difference of two prefixes.

    ``cells`` are counts by group, bucket and time. A window asks every bucket of its group for the
    running count at its end and before its start; no count is copied.
    """
    asked = cells.select("_g", bucket).distinct().join(
        windows.select("_g", "_w", F.explode(F.array(
            F.struct(F.col("_to").alias("_at"), F.lit(1).alias("_sign")),
            F.struct((F.col("_from") - 1).alias("_at"), F.lit(-1).alias("_sign")))).alias("_q")), "_g"
    ).select("_g", bucket, "_q._at", F.lit(0).cast("bigint").alias("_n"), "_w", "_q._sign")
    known = cells.select("_g", bucket, "_at", "_n", F.lit(None).cast(windows.schema["_w"].dataType).alias("_w"),
                         F.lit(None).cast("int").alias("_sign"))
    upto = F.sum("_n").over(Window.partitionBy("_g", bucket).orderBy("_at").rangeBetween(Window.unboundedPreceding, 0))
    return (known.unionByName(asked).withColumn("_p", upto).filter(F.col("_sign").isNotNull())
            .groupBy("_g", "_w", bucket).agg(F.sum(F.col("_sign") * F.col("_p")).alias("_n")).filter("_n > 0"))


def _holding(counts: DataFrame, bucket: str, prob: float | None = None) -> DataFrame:
    """The buckets that hold the ranks a window wants, with how many values are below each.

    ``counts`` are those of all buckets, with ``prob``, or those of a bucket found before: then they carry what is below it
    and the ranks.
    """
    if prob is not None:
        pos = (F.sum("_n").over(Window.partitionBy("_g", "_w")) - 1) * F.lit(float(prob))
        counts = counts.withColumns({"_pos": pos, "_under": F.lit(0).cast("bigint")})
    inside = Window.partitionBy("_g", "_w", "_under").orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    return (counts.withColumn("_upto", F.col("_under") + F.sum("_n").over(inside))
            .withColumn("_below", F.col("_upto") - F.col("_n"))
            .filter((F.col("_below") <= F.ceil("_pos")) & (F.floor("_pos") < F.col("_upto")))
            .select("_g", "_w", bucket, "_pos", F.col("_below").alias("_under"), "_upto"))


def _copied(found: DataFrame, windows: DataFrame, cells: DataFrame, bucket: str, finer: str) -> DataFrame:
    """Counts of ``finer`` inside the buckets found, each in the windows that want it."""
    wanted = found.join(windows, ["_g", "_w"])
    met = cells.join(wanted, ["_g", bucket]).filter(F.col("_at").between(F.col("_from"), F.col("_to")))
    return met.groupBy("_g", "_w", "_pos", "_under", finer).agg(F.sum("_n").alias("_n"))


def windowed_quantile(counts: DataFrame, windows: DataFrame, prob: float, name: str) -> DataFrame:
    """(_g, _w, name): the interpolated quantile of every window that holds a value.

    ``counts`` has a group (_g), a time as a whole number (_at), a value (_v) and its count (_n); ``windows``
    has the group, a name (_w) and the first and last time (_from, _to), both included. Both are read by every
    step, so they should be tables.
    """
    values = counts.withColumn("_b", value_bucket(F.col("_v")))
    narrow = values.groupBy("_g", "_b", "_at").agg(F.sum("_n").alias("_n")).withColumn(
        "_wide", F.floor(F.col("_b") / NARROW).cast("int"))
    wide = narrow.groupBy("_g", "_wide", "_at").agg(F.sum("_n").alias("_n"))
    in_wide = _holding(_in_windows(wide, windows, "_wide"), "_wide", prob)
    in_narrow = _holding(_copied(in_wide, windows, narrow, "_wide", "_b"), "_b")
    found = _holding(_copied(in_narrow, windows, values, "_b", "_v"), "_v")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_under") <= rank) & (rank < F.col("_upto")), F.col("_v")))

    share = F.max(F.col("_pos") - F.floor("_pos"))
    return found.groupBy("_g", "_w").agg(
        (at(F.floor("_pos")) * (1.0 - share) + at(F.ceil("_pos")) * share).alias(name))


def rolling_quantile(df: DataFrame, keys: list[str], date: str, value: Column, prob: float,
                     months: int, name: str) -> DataFrame:
    """Quantile of the last ``months`` months for every month that has rows; a row without a date is in none."""
    month = F.year(date) * 12 + F.month(date)
    counts = stored(value_counts(df.withColumn("_at", month).filter("_at is not null"), [*keys, "_at"], {name: (value, prob)}).select(
        F.struct(*keys).alias("_g"), "_at", "_v", "_n"))
    windows = counts.select("_g", F.col("_at").alias("_w"), (F.col("_at") - (months - 1)).alias("_from"),
                            F.col("_at").alias("_to")).distinct()
    first = F.make_date(F.floor((F.col("_w") - 1) / 12).cast("int"), F.pmod(F.col("_w") - 1, F.lit(12)) + 1, F.lit(1))
    return windowed_quantile(counts, windows, prob, name).select(
        *[F.col(f"_g.{k}").alias(k) for k in keys], first.alias("mois"), name)
