import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cadastria.operators.grouping import (
    colour_by_price,
    dense_rank,
    global_row_number,
    majority_value,
    quantile_class,
)
from cadastria.operators.quantiles import approx_quantiles, exact_quantiles, totals_from_counts, value_bucket, value_counts
from cadastria.operators import sketches
from cadastria.operators.rolling import rolling_quantile, windowed_quantile


def skewed(n=6000, seed=1):
    """One group holds a third of all rows, one has a single row, one value is very frequent."""
    rng = np.random.default_rng(seed)
    g = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 40, n))
    v = np.round(rng.normal(0, 5000, n), 2)
    v[rng.random(n) < 0.2] = 1234.5
    pdf = pd.DataFrame({"g": g, "v": v})
    pdf.loc[len(pdf)] = [99, -7.0]
    pdf["g"] = pdf["g"].astype(int)
    return pdf


@pytest.mark.parametrize("bounded", [True, False])
def test_exact_quantiles_match_brute_force(spark, bounded):
    pdf = skewed()
    df = spark.createDataFrame(pdf)
    got = exact_quantiles(df, ["g"], {
        "q1": (F.col("v"), 0.25), "med": (F.col("v"), 0.5), "q9": (F.abs("v"), 0.9),
        "pos": (F.when(F.col("v") > 0, F.col("v")), 0.5),
    }, bounded).toPandas().set_index("g").sort_index()
    by = pdf.groupby("g")["v"]
    np.testing.assert_allclose(got["q1"], by.quantile(0.25).sort_index(), rtol=1e-12)
    np.testing.assert_allclose(got["med"], by.median().sort_index(), rtol=1e-12)
    np.testing.assert_allclose(got["q9"], by.apply(lambda s: s.abs().quantile(0.9)), rtol=1e-12)
    want = pdf[pdf.v > 0].groupby("g")["v"].median()
    assert np.isnan(got.loc[99, "pos"]) and len(got) == len(want) + 1
    np.testing.assert_allclose(got["pos"].dropna(), want.sort_index(), rtol=1e-12)


def test_null_group_keys_are_kept(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    for bounded in (True, False):
        got = {r.g: r.m for r in exact_quantiles(
            df, ["g"], {"m": (F.col("v"), 0.5)}, bounded).collect()}
        assert got == {None: 2.0, "a": 5.0}


def test_approximate_quantile_is_an_element(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "v double").withColumn(
        "g", F.lit(1))
    assert approx_quantiles(df, ["g"], {"m": (F.col("v"), 0.5)}).head().m in (4.0, 5.0)


def test_majority_value_ties_and_nulls(spark):
    rows = [(1, "b"), (1, "a"), (2, "z"), (2, "z"), (2, "a"), (3, None), (3, "q"), (4, None),
            (4, None), (4, "a")]
    got = {r.k: r.v for r in majority_value(
        spark.createDataFrame(rows, "k int, v string"), ["k"], ["v"]).collect()}
    assert got == {1: "a", 2: "z", 3: "q", 4: None}


def test_global_row_number_with_a_hot_value(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": np.arange(3000), "v": rng.integers(0, 50, 3000)})
    pdf.loc[pdf.index % 3 == 0, "v"] = 7
    got = global_row_number(
        spark.createDataFrame(pdf), [F.col("v"), F.col("id")], "r").toPandas()
    want = pdf.sort_values(["v", "id"]).reset_index(drop=True)
    got = got.sort_values("r")
    assert got["r"].tolist() == list(range(1, 3001))
    assert got["id"].tolist() == want["id"].tolist()


def test_dense_rank_treats_missing_as_zero(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 9.0), ("c", 5.0), ("d", None)],
                               "n string, v double")
    assert {r.n: r.r for r in dense_rank(df, "v", "r").collect()} == {
        "b": 1, "a": 2, "c": 2, "d": 3}


@pytest.mark.parametrize("n", [2, 5, 7, 13, 23, 100])
def test_quantile_class_matches_equal_frequency_cut(spark, n):
    pdf = pd.DataFrame({"id": range(n), "v": np.random.default_rng(n).permutation(n) * 1.0})
    got = quantile_class(spark.createDataFrame(pdf), "v", ["id"], 5, "c").toPandas()
    k = min(5, n)
    want = pd.qcut(pdf["v"].rank(method="first"), k, labels=False)
    assert got.sort_values("id")["c"].tolist() == want.tolist()


def test_colours_run_from_cheapest_to_dearest(spark):
    from cadastria.functions.constants import PALETTE

    df = spark.createDataFrame(
        [("75101", 13000.0, 120), ("92012", 8000.0, 80), ("93001", 4000.0, 500)],
        "code_commune string, prix_m2_median double, nb_ventes bigint")
    got = {r.code_commune: r for r in colour_by_price(df).collect()}
    assert got["93001"].couleur == PALETTE[0] and got["75101"].couleur == PALETTE[-1]
    assert got["93001"].rayon == 150 + 40 * 20
    assert colour_by_price(df.limit(0)).count() == 0


def test_rolling_quantile_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    days = pd.to_datetime("2020-01-01") + pd.to_timedelta(rng.integers(0, 900, 800), "D")
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 800), "d": days, "v": rng.normal(0, 1, 800)})
    got = rolling_quantile(spark.createDataFrame(pdf), ["g"], "d", F.col("v"), 0.5, 12, "m")
    pdf["month"] = pdf["d"].dt.to_period("M")
    for r in got.collect():
        end = pd.Period(r.mois, "M")
        part = pdf[(pdf.g == r.g) & (pdf.month <= end) & (pdf.month > end - 12)]
        assert r.m == pytest.approx(part["v"].median())
    assert got.count() == pdf.groupby(["g", "month"]).ngroups


def test_no_bucket_holds_much_of_small_values(spark):
    v = spark.range(1_000_000).select((F.rand(5) * 0.3).alias("v"))
    largest = v.groupBy(value_bucket(F.col("v"))).count().agg(F.max("count")).head()[0]
    assert largest <= 1000


def test_buckets_keep_the_order_of_any_doubles(spark):
    values = [float("-inf"), -1e300, -5.0, -1e-300, -5e-324, 0.0, 5e-324, 1e-300, 0.1, 0.2, 1.0, 1e300, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", value_bucket(F.col("v")).alias("b"))
    buckets = [r.b for r in df.orderBy("v").collect()]
    assert buckets == sorted(buckets) and len(set(buckets)) == len(values)


def test_nan_does_not_count(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", float("nan")), ("a", None), ("b", float("nan"))], "k string, v double")
    got = exact_quantiles(df, ["k"], {"m": (F.col("v"), 0.5)}).collect()
    assert [(r.k, r.m) for r in got] == [("a", 2.0)]


def test_windowed_quantile_of_any_window(spark):
    """Ties, negative values, a group with most rows, windows without rows and ones that end between rows."""
    rng = np.random.default_rng(9)
    n = 4000
    pdf = pd.DataFrame({"g": np.where(rng.random(n) < 0.6, 0, rng.integers(1, 6, n)), "t": rng.integers(0, 90, n),
                        "v": np.where(rng.random(n) < 0.4, rng.integers(-3, 4, n), np.round(rng.normal(0, 900, n), 1))})
    windows = pd.DataFrame([(g, i, a, a + w) for g in range(7) for i, (a, w) in enumerate(
        zip(rng.integers(-20, 100, 12), rng.integers(0, 60, 12)))], columns=["g", "w", "a", "b"])
    counts = spark.createDataFrame(pdf).groupBy("g", "t", "v").count().select(
        F.struct("g").alias("_g"), F.col("t").cast("int").alias("_at"), F.col("v").alias("_v"), F.col("count").alias("_n"))
    asked = spark.createDataFrame(windows).select(
        F.struct("g").alias("_g"), F.struct("w").alias("_w"), F.col("a").cast("int").alias("_from"), F.col("b").cast("int").alias("_to"))
    for prob in (0.5, 0.1, 0.99):
        got = {(r._g.g, r._w.w): r.q for r in windowed_quantile(counts, asked, prob, "q").collect()}
        want = {}
        for r in windows.itertuples():
            part = pdf[(pdf.g == r.g) & (pdf.t >= r.a) & (pdf.t <= r.b)]
            if len(part):
                want[(r.g, r.w)] = part.v.quantile(prob)
        assert got == pytest.approx(want)


def test_sketches_merge_within_their_bound(spark):
    """Many small sketches merged over two levels are as good as one over all rows; one group has most."""
    rng = np.random.default_rng(12)
    n = 60_000
    pdf = pd.DataFrame({"g": np.where(rng.random(n) < 0.7, "hot", "cold"), "day": rng.integers(0, 300, n),
                        "v": np.where(rng.random(n) < 0.2, 7.0, rng.lognormal(3, 2, n))})
    df = spark.createDataFrame(pdf)
    daily = sketches.sketched(df.unionByName(df.limit(3).withColumn("v", F.lit(None).cast("double"))), ["g", "day"], F.col("v"))
    weekly = sketches.merged(daily.withColumn("week", F.floor(F.col("day") / 7)), ["g", "week"])
    got = sketches.merged(weekly, ["g"]).select(
        "g", sketches.count("sketch").alias("n"), *[sketches.quantile("sketch", p).alias(f"q{i}") for i, p in enumerate((0.01, 0.5, 0.9))])
    for r in got.collect():
        part = pdf[pdf.g == r.g].v
        assert r.n == len(part)
        for value, p in ((r.q0, 0.01), (r.q1, 0.5), (r.q2, 0.9)):
            assert value in part.values
            assert (part < value).mean() - 0.01 <= p <= (part <= value).mean() + 0.01


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert sketches.merged(sketches.sketched(empty, ["g"], F.col("v")), ["g"]).count() == 0


def test_rank_error(spark):
    row = spark.range(1).select(*[sketches.rank_error(F.lit(0), F.lit(a), F.lit(b), F.lit(10), 0.5).alias(f"e{i}")
                                  for i, (a, b) in enumerate([(4, 6), (6, 7), (2, 4)])]).head()
    assert (row.e0, row.e1, row.e2) == (0.0, pytest.approx(0.1), pytest.approx(0.1))


def test_groupings_of_one_count_table_equal_their_own_quantiles(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"a": rng.choice(["x", "y", "z"], 900), "b": rng.choice(["p", "q"], 900),
                        "v": rng.integers(0, 50, 900) / 4.0})
    pdf.loc[:20, "a"] = None
    pdf.loc[30:60, "v"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    specs = {"m": (F.col("v"), 0.5), "q1": (F.col("v"), 0.25), "other": (F.col("v") * 2, 0.5)}
    sets = [["a", "b"], ["b"], []]
    got = totals_from_counts(value_counts(df, ["a", "b"], specs), sets, specs).collect()
    for i, keys in enumerate(sets):
        rows = {tuple(r[k] for k in keys): (r.m, r.q1, r.other) for r in got if r["_set"] == i}
        alone = exact_quantiles(df.withColumn("one", F.lit(1)), keys or ["one"], specs, bounded=True).collect()
        assert rows == {tuple(r[k] for k in keys): (r.m, r.q1, r.other) for r in alone}
        assert all(r[k] is None for r in got if r["_set"] == i for k in {"a", "b"} - set(keys))
