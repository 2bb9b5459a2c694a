"""Data checks: each counts failing rows; errors stop the build, warnings are reported."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT = "table_name string, check_name string, column_name string, severity string, " \
         "failures bigint, status string"


@dataclass(frozen=True)
class Check:
    """``row`` marks a failing row (folded into one pass per table); ``count`` gives a one-row frame
    with the number of ``failures`` for checks that need a shuffle."""

    name: str
    column: str
    row: Callable[[], Column] | None = None
    count: Callable[[DataFrame], DataFrame] | None = None
    severity: str = "error"


def not_null(column: str) -> Check:
    return Check("not_null", column, row=lambda: F.col(column).isNull())


def accepted_values(column: str, values: list) -> Check:
    return Check("accepted_values", column, row=lambda: ~F.col(column).isin(values))


def accepted_range(column: str, low: float | None = None, high: float | None = None,
                   inclusive: bool = True, severity: str = "error") -> Check:
    def row() -> Column:
        c, bad = F.col(column), F.lit(False)
        if low is not None:
            bad = bad | ((c < low) if inclusive else (c <= low))
        if high is not None:
            bad = bad | ((c > high) if inclusive else (c >= high))
        return bad

    return Check("accepted_range", column, row=row, severity=severity)


def unique(*columns: str) -> Check:
    """Groups that occur more than once; a single NULL key is not a duplicate."""
    def count(df: DataFrame) -> DataFrame:
        known = df.filter(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
        return known.groupBy(*columns).agg(F.count("*").alias("n")).agg(
            F.count_if(F.col("n") > 1).alias("failures"))

    name = "unique" if len(columns) == 1 else "unique_combination"
    return Check(name, ",".join(columns), count=count)


def relationship(column: str, parent: DataFrame, key: str) -> Check:
    """Child rows without a parent; a NULL child is not checked. Children are counted per key
    before they meet the parents, so a hot key travels as one row."""
    def count(df: DataFrame) -> DataFrame:
        keys = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).agg(
            F.count("*").alias("n"))
        orphans = keys.join(parent.select(F.col(key).alias("_k")), "_k", "left_anti")
        return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))

    return Check("relationship", column, count=count)


def coverage(df: DataFrame, columns: dict[str, Column], minimum: float) -> DataFrame:
    """One row of shares of known values; empty unless a share is below the minimum."""
    return coverage_shares(df, columns).filter(
        " OR ".join(f"{name} < {minimum}D" for name in columns))


def coverage_shares(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.agg(*[
        F.try_divide(F.count(c).cast("double"), F.count("*").cast("double")).alias(name)
        for name, c in columns.items()
    ])


def row_marks(checks: list[Check]) -> list[Column]:
    """What the row checks mark, for a count while the table is written."""
    return [c.row() for c in checks if c.row is not None]


def run_checks(table_name: str, df: DataFrame, checks: list[Check], seen: list[int] | None = None) -> DataFrame:
    """Report of all checks of a table: row checks share one scan, the others one plan each.

    With ``seen``, the counts of the row checks from the write of the table, there is no scan for them.
    """
    rows = [c for c in checks if c.row is not None]
    parts = []
    if rows and seen is not None:
        counted = [(c.name, c.column, c.severity, n) for c, n in zip(rows, seen, strict=True)]
        parts.append(df.sparkSession.createDataFrame(
            counted, "check_name string, column_name string, severity string, failures bigint"))
    elif rows:
        entries = F.array(*[
            F.struct(F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"),
                     F.lit(c.severity).alias("severity"), F.col(f"_{i}").alias("failures"))
            for i, c in enumerate(rows)
        ])
        parts.append(
            df.agg(*[F.count_if(c.row()).alias(f"_{i}") for i, c in enumerate(rows)])
            .select(F.explode(entries).alias("e")).select("e.*"))
    for c in checks:
        if c.count is not None:
            parts.append(c.count(df).select(
                F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"),
                F.lit(c.severity).alias("severity"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = F.when(F.col("failures") == 0, "pass").otherwise(
        F.when(F.col("severity") == "warn", "warn").otherwise("error"))
    return out.select(F.lit(table_name).alias("table_name"), "check_name", "column_name",
                      "severity", "failures", status.alias("status"))


class QualityError(RuntimeError):
    pass


def enforce(report: DataFrame) -> DataFrame:
    """Raise if a check of severity 'error' failed; the report has one row per check."""
    bad = report.filter("status = 'error'").collect()
    if bad:
        raise QualityError("; ".join(
            f"{r.table_name}.{r.column_name}: {r.check_name} ({r.failures})" for r in bad))
    return report


def freshness(df: DataFrame, loaded_at: str, now: Column, warn_days: int,
              error_days: int) -> DataFrame:
    """Age of the latest load in days and its status."""
    last = df.agg(F.max(F.col(loaded_at).try_cast("timestamp")).alias("derniere_charge"))
    age = (F.unix_seconds(now) - F.unix_seconds("derniere_charge")) / 86400.0
    return last.select("derniere_charge", age.alias("age_jours")).withColumn(
        "status", F.when(F.col("age_jours") > error_days, "error")
        .when(F.col("age_jours") > warn_days, "warn").when(F.col("age_jours").isNull(), "error")
        .otherwise("pass"))


def landing_volumes(raw: DataFrame, group: str = "code_departement") -> DataFrame:
    return raw.groupBy(group).agg(F.count("*").alias("n"))


def landing_gate(raw: DataFrame, expected: DataFrame, minimum_rows: int,
                 group: str = "code_departement") -> DataFrame:
    """Total rows, groups present, groups missing and the verdict of the blocking landing check."""
    volumes = landing_volumes(raw, group)
    missing = expected.select(group).distinct().join(volumes, group, "left_anti").select(
        F.concat_ws(", ", F.sort_array(F.collect_list(group)))).scalar()
    totals = volumes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"), F.count(group).alias("departements"))
    return totals.withColumn("missing_groups", missing).withColumn(
        "passed", (F.col("raw_rows") >= minimum_rows) & (F.col("missing_groups") == ""))


def require_landing(gate: DataFrame) -> DataFrame:
    row = gate.head()
    if not row.passed:
        raise QualityError(
            f"landing refused: {row.raw_rows} rows, missing groups [{row.missing_groups}]")
    return gate


def require_coverage(failures: DataFrame) -> None:
    """``failures`` has a row for every share that is too small."""
    found = failures.head()
    if found is not None:
        raise QualityError(f"coverage too small: {found.asDict()}")


def require_fresh(found: DataFrame) -> None:
    """Refuses what ``freshness`` calls an error; a warning passes."""
    row = found.head()
    if row is None or row.status == "error":
        raise QualityError(f"data too old: {row.age_jours if row else None} days")


def require_rows(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise QualityError(f"empty source: {name}")
    return df
