"""Fixed-effect least squares with cluster-robust errors, by a tree of triangular factors.

Cross products square the condition number of a design; orthogonal factors don't. Rows of a cell (segment,
group, dummy levels) differ in the numeric variables only, so a task first reduces its rows of a cell to the
triangular factor of [1, numeric variables, y], at most as many rows as columns. Factors are rows like any
others: those of a cell from all tasks are reduced once more, then the dummies are put beside the constant
and the cells of a group give its factor. With the constant as first column, what is below its first row is
the factor of the variables centred by group. Factors of groups are reduced to one of their segment, and
only that, k + 1 wide, reaches the driver; the score of a group follows from its own factor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastria.session import checkpointed, join_on

RESULT = ("variable string, coefficient double, erreur_standard double, effet_pct double, "
          "ic95_bas_pct double, ic95_haut_pct double, n bigint, groupes bigint")
_FACTOR = "_n bigint, _r array<double>, _lo array<double>, _hi array<double>"
Z95 = 1.96
#: Singular values below this part of the largest, of scaled columns, count as zero.
RANK = 1e-11


@dataclass(frozen=True)
class Levels:
    """A family of dummies: column, its values in order, which present one is the reference."""

    column: str
    values: list
    reference: str  # 'first' or 'last'
    prefix: str = ""

    def names(self) -> list[str]:
        return [f"{self.prefix}{v}" for v in self.values]


@dataclass(frozen=True)
class Fit:
    key: tuple
    used: list[int]
    beta: np.ndarray
    bread: np.ndarray
    n: int
    groups: int


def demean(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Columns centred by group; means are aggregated with map-side combine and joined back."""
    means = df.groupBy(group).agg(*[F.avg(c).alias(f"_mean_{c}") for c in columns])
    return df.join(means, group).withColumns(
        {f"{c}_centre": F.col(c) - F.col(f"_mean_{c}") for c in columns}
    ).drop(*[f"_mean_{c}" for c in columns])


def cells(df: DataFrame, segment: list[str], group: str, levels: list[Levels],
          numeric: dict[str, Column], y: Column) -> DataFrame:
    """Counts, extremes, sums and cross sums of the numeric variables and y per cell."""
    names = [f"v{i}" for i in range(len(numeric) + 1)]
    rows = df.select(*segment, group, *[lv.column for lv in levels], *[
        c.cast("double").alias(n) for n, c in zip(names, [*numeric.values(), y], strict=True)])
    sums = [F.count("*").alias("n")]
    for i, a in enumerate(names):
        sums += [F.sum(a).alias(f"s{i}"), F.min(a).alias(f"lo{i}"), F.max(a).alias(f"hi{i}")]
        sums += [F.sum(F.col(a) * F.col(b)).alias(f"p{i}_{j}")
                 for j, b in enumerate(names) if j >= i]
    return rows.groupBy(*segment, group, *[lv.column for lv in levels]).agg(*sums)


def _triangles(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The triangular factor of every run of rows; runs begin at ``starts``. Shape: runs x columns x columns.

    Modified Gram-Schmidt over all runs at once; its factor is as accurate as that of reflections.
    """
    rest = values.astype(float)
    width = rest.shape[1]
    run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(rest))))
    out = np.zeros((len(starts), width, width))
    for j in range(width):
        # scaled, so that squares neither vanish nor overflow
        size = np.maximum.reduceat(np.abs(rest[:, j]), starts)
        unit = rest[:, j] / np.where(size > 0, size, 1.0)[run]
        length = np.sqrt(np.add.reduceat(unit * unit, starts))
        out[:, j, j] = length * size
        unit /= np.where(length > 0, length, 1.0)[run]
        if j + 1 < width:
            out[:, j, j + 1:] = np.add.reduceat(unit[:, None] * rest[:, j + 1:], starts)
            rest[:, j + 1:] -= unit[:, None] * out[run, j, j + 1:]
    return out


def _reduced(pdf: pd.DataFrame, keys: list[str], names: list[str]) -> pd.DataFrame:
    """The rows of each cell as those of its triangular factor; counts and extremes go to the first row."""
    number = pdf.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
    order = np.argsort(number, kind="stable")
    pdf, number = pdf.iloc[order], number[order]
    starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
    width = len(names)
    factors = _triangles(pdf[names].to_numpy(float), starts)
    first = np.arange(len(starts)) * width
    cells_ = pdf[keys].iloc[starts]
    out = cells_.iloc[np.repeat(np.arange(len(starts)), width)].reset_index(drop=True)
    out[names] = factors.reshape(-1, width)
    for c, how, empty in [("n", np.add, 0), *[(f"lo{i}", np.fmin, np.nan) for i in range(width - 2)],
                          *[(f"hi{i}", np.fmax, np.nan) for i in range(width - 2)]]:
        column = np.full(len(out), empty, float)
        column[first] = how.reduceat(pdf[c].to_numpy(float), starts)
        out[c] = column
    # rows of zeros say nothing
    return out[(out[names] != 0).any(axis=1).to_numpy() | (out["n"] > 0).to_numpy()]


def cell_factors(df: DataFrame, segment: list[str], group: str, levels: list[Levels],
                 numeric: dict[str, Column], y: Column) -> DataFrame:
    """Rows of the triangular factors of [1, numeric variables, y] per cell.

    Reduced in the tasks that read the rows, shuffled by cell and reduced again as sorted streams: a task holds
    a batch and one cell's factor. ``n`` and the extremes of the variables are on one row of a cell and reduction.
    """
    keys = [*segment, group, *[lv.column for lv in levels]]
    names = ["one", *[f"v{i}" for i in range(len(numeric) + 1)]]
    values = [c.cast("double") for c in (*numeric.values(), y)]
    rows = df.select(*keys, F.lit(1.0).alias("one"), *[c.alias(n) for n, c in zip(names[1:], values, strict=True)],
                     F.lit(1.0).alias("n"), *[c.alias(f"{side}{i}") for side in ("lo", "hi")
                                              for i, c in enumerate(values[:-1])]).dropna(subset=names)

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield _reduced(pdf, keys, names)

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = _reduced(pdf if held is None else pd.concat([held, pdf]), keys, names)
            # the last cell may go on in the next batch
            last = pdf[keys].iloc[-1]
            same = np.logical_and.reduce([(pdf[c] == last[c]) | (pdf[c].isna() & pd.isna(last[c])) for c in keys])
            held = pdf[same]
            yield pdf[~same]
        if held is not None:
            yield held

    schema = rows.schema
    return rows.mapInPandas(reduced, schema).repartition(*keys).sortWithinPartitions(*keys).mapInPandas(merged, schema)


def _group_factor(pdf: pd.DataFrame, keys: list[str], levels: list[Levels], numeric: int) -> pd.DataFrame:
    """The factor of one group's variables, centred, from the factors of its cells; y is the last."""
    dummies = np.concatenate(
        [[(pdf[lv.column] == v).to_numpy(float) for v in lv.values] for lv in levels], axis=0
    ).T if levels else np.zeros((len(pdf), 0))
    ones, values = pdf[["one"]].to_numpy(float), pdf[[f"v{i}" for i in range(numeric + 1)]].to_numpy(float)
    full = _triangles(np.concatenate([ones, dummies * ones, values], axis=1), np.array([0]))[0]
    counted = pdf["n"].to_numpy(float) > 0
    lows = [*dummies[counted].min(axis=0), *[np.nanmin(pdf[f"lo{i}"]) for i in range(numeric)]]
    highs = [*dummies[counted].max(axis=0), *[np.nanmax(pdf[f"hi{i}"]) for i in range(numeric)]]
    return pd.DataFrame({
        **{c: [pdf[c].iloc[0]] for c in keys}, "_n": [int(pdf["n"].sum())], "_r": [full[1:, 1:].ravel()],
        "_lo": [np.array(lows, float)], "_hi": [np.array(highs, float)],
    })


def group_factors(df: DataFrame, segment: list[str], group: str, levels: list[Levels],
                  numeric: dict[str, Column], y: Column) -> DataFrame:
    """One row per (segment, group): count, triangular factor of the centred variables and y, extremes."""
    keys, width = [*segment, group], len(numeric)
    types = dict(df.select(*keys).dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keys] + [_FACTOR])

    def per_group(pdf: pd.DataFrame) -> pd.DataFrame:
        return _group_factor(pdf, keys, levels, width)

    return cell_factors(df, segment, group, levels, numeric, y).groupBy(*keys).applyInPandas(per_group, schema)


def segment_factors(factors: DataFrame, segment: list[str], k: int) -> DataFrame:
    """(segment, _r): the factors of all groups of a segment in one, each task's first."""
    types = dict(factors.select(*segment).dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in segment] + ["_r array<double>"])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            for key, part in pdf.groupby(segment, dropna=False):
                stacked = np.concatenate([np.asarray(r).reshape(k + 1, k + 1) for r in part["_r"]])
                if key in held:
                    stacked = np.concatenate([held[key], stacked])
                held[key] = _triangles(stacked, np.array([0]))[0]
        yield pd.DataFrame([(*key, r.ravel()) for key, r in held.items()], columns=[*segment, "_r"])

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        return next(partial(iter([pdf])))

    return factors.select(*segment, "_r").mapInPandas(partial, schema).groupBy(*segment).applyInPandas(whole, schema)


def _array_totals(products: DataFrame, segment: list[str], column: str,
                  combine: str = "sum") -> DataFrame:
    """Element-wise totals over the groups of a segment, as one array in order."""
    long = products.select(*segment, F.posexplode(column).alias("_i", "_v"))
    per = long.groupBy(*segment, "_i").agg(getattr(F, combine)("_v").alias("_v"))
    ordered = F.sort_array(F.collect_list(F.struct("_i", "_v")))  # k or k*k entries
    return per.groupBy(*segment).agg(ordered["_v"].alias(column))


def normal_equations(df: DataFrame, segment: list[str], group: str, levels: list[Levels],
                     numeric: dict[str, Column], y: Column) -> DataFrame:
    """(segment, a, b, product): sums of products of the variables centred by group; b is ``y`` too."""
    names = [*[n for lv in levels for n in lv.names()], *numeric, "y"]
    k = len(names) - 1
    factors = segment_factors(group_factors(df, segment, group, levels, numeric, y), segment, k)
    cell = lambda r, i, j: F.get(r, i * (k + 1) + j)
    pairs = factors.select(*segment, "_r", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("i")).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(k))).alias("j"))
    product = F.aggregate(F.sequence(F.lit(0), F.least("i", "j")), F.lit(0.0),
                          lambda total, h: total + cell(F.col("_r"), h, F.col("i")) * cell(F.col("_r"), h, F.col("j")))
    at = lambda i: F.get(F.lit(names), F.col(i))
    return pairs.select(*segment, at("i").alias("a"), at("j").alias("b"), product.alias("product"))


def _solved(r: np.ndarray, used: list[int], scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and (X'X)^-1 of the used columns; of all solutions, where there are many, the shortest."""
    u, s, v = np.linalg.svd(r[:, used] / scale, full_matrices=False)
    kept = s > RANK * s.max(initial=0.0)
    inverse = np.divide(1.0, s, out=np.zeros_like(s), where=kept)
    root = (v.T * inverse) / scale[:, None]
    return root @ (u.T @ r[:, -1]), root @ root.T


def fit_segments(factors: DataFrame, segment: list[str], levels: list[Levels],
                 names: list[str]) -> list[Fit]:
    """Solve every segment from its triangular factor; one small system each, on the driver."""
    k = len(names)
    totals = factors.groupBy(*segment).agg(
        F.sum("_n").alias("n"), F.count("*").alias("g"))
    for column, how in (("_lo", "min"), ("_hi", "max")):
        totals = join_on(totals, _array_totals(factors, segment, column, how), segment)
    out = []
    for row in join_on(totals, segment_factors(factors, segment, k), segment).collect():
        lo, hi = np.array(row["_lo"]), np.array(row["_hi"])
        omitted, at = set(), 0
        for lv in levels:
            present = [i for i in range(at, at + len(lv.values)) if hi[i] > 0]
            omitted.update(present[:1] if lv.reference == "first" else present[-1:])
            at += len(lv.values)
        used = [i for i in range(k) if lo[i] < hi[i] and i not in omitted]
        beta, bread = _solved(np.array(row["_r"]).reshape(k + 1, k + 1), used, (hi - lo)[used])
        out.append(Fit(tuple(row[s] for s in segment), used, beta, bread, row["n"], row["g"]))
    return out


def cluster_meat(factors: DataFrame, segment: list[str], fits: list[Fit],
                 k: int) -> dict[tuple, np.ndarray]:
    """Sum over groups of score times its transpose; each task adds up its own groups first."""
    betas = {}
    for f in fits:
        betas[f.key] = np.zeros(k)
        betas[f.key][f.used] = f.beta
    types = dict(factors.select(*segment).dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in segment] + ["_meat array<double>"])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            for key, r in zip(pdf[segment].itertuples(index=False, name=None), pdf["_r"], strict=True):
                r = np.asarray(r).reshape(k + 1, k + 1)
                score = r[:, :k].T @ (r[:, k] - r[:, :k] @ betas[key])
                sums[key] = sums.get(key, 0.0) + np.outer(score, score)
        yield pd.DataFrame(
            [(*key, m.ravel()) for key, m in sums.items()], columns=[*segment, "_meat"])

    parts = factors.select(*segment, "_r").mapInPandas(partial, schema)
    return {
        tuple(r[s] for s in segment): np.array(r["_meat"]).reshape(k, k)
        for r in _array_totals(parts, segment, "_meat").collect()
    }


def fixed_effect_ols(df: DataFrame, segment: list[str], group: str, levels: list[Levels],
                     numeric: dict[str, Column], y: Column) -> DataFrame:
    """Coefficients, clustered errors, effect in percent and its 95 % interval per segment.

    Groups count as parameters in the small-sample correction; with one group errors are undefined.
    Variables that are constant over a segment are left out of it.
    """
    names = [n for lv in levels for n in lv.names()] + list(numeric)
    factors = checkpointed(group_factors(df, segment, group, levels, numeric, y))
    fits = fit_segments(factors, segment, levels, names)
    meats = cluster_meat(factors, segment, fits, len(names))
    rows = []
    for f in fits:
        k = len(f.used) + f.groups
        scale = (f.groups / (f.groups - 1) * (f.n - 1) / max(f.n - k, 1)
                 if f.groups > 1 else float("nan"))
        meat = meats[f.key][np.ix_(f.used, f.used)]
        se = np.sqrt(np.diag(f.bread @ meat @ f.bread) * scale)
        for i, b, e in zip(f.used, f.beta, se, strict=True):
            percents = [float(np.expm1(v) * 100) for v in (b, b - Z95 * e, b + Z95 * e)]
            rows.append((*f.key, names[i], float(b), float(e), *percents, int(f.n),
                         int(f.groups)))
    types = dict(df.select(*segment).dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in segment] + [RESULT])
    return df.sparkSession.createDataFrame(rows, schema)


def within_slope(df: DataFrame, group: str, x: Column, y: Column,
                 segment: list[str]) -> DataFrame:
    """One regressor: slope and clustered error in closed form, without leaving the JVM."""
    n, sx, sy = F.col("n"), F.col("s0"), F.col("s1")
    p = cells(df, segment, group, [], {"x": x}, y).select(
        *segment, group, "n", (F.col("p0_1") - sx * sy / n).alias("xy"),
        (F.col("p0_0") - sx * sx / n).alias("xx"))
    slopes = p.groupBy(*segment).agg(
        F.try_divide(F.sum("xy"), F.sum("xx")).alias("pente"), F.sum("xx").alias("sxx"),
        F.sum("n").alias("total"), F.count("*").alias("groupes"))
    score = F.col("xy") - F.col("xx") * F.col("pente")
    meat = p.join(slopes, segment).groupBy(*segment).agg(
        F.sum(score * score).alias("meat"))
    g, rows = F.col("groupes"), F.col("total")
    scale = F.try_divide(g, g - 1) * (rows - 1) / F.greatest(rows - 1 - g, F.lit(1))
    return slopes.join(meat, segment).select(
        *segment, "pente", (F.sqrt(F.col("meat") * scale) / F.col("sxx")).alias("erreur_standard"),
        rows.alias("n"), "groupes")
