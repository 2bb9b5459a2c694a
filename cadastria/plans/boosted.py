"""Boosted-tree price model on MLlib: features, early stopping with patience, ablation, gain importance."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Imputer,
    SQLTransformer,
    StringIndexer,
    TargetEncoder,
    VectorAssembler,
)
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastria.functions import columns as C
from cadastria.plans import model as M
from cadastria.session import delete_at_end, shared_folder

BASE = [*M.CATEGORIES, *M.NUMBERS]
ENRICHED = [*BASE, *M.ENRICHMENT]
# The most trees, rounds without a smaller error on the valid year that end the boosting, and the depth
# at which a tree grown level by level has as many leaves as one of 127 grown leaf by leaf.
TREES, PATIENCE, DEPTH = 3000, 100, 7


def _sql(expressions: list[str]) -> SQLTransformer:
    return SQLTransformer(statement=f"SELECT *, {', '.join(expressions)} FROM __THIS__")


def _stages(features: list[str]) -> tuple[list, list[str]]:
    """Stages and final columns. Trees here need complete numbers, so gaps are imputed and flagged;
    communes are too many for a tree split, so categories carry the training mean of the target."""
    cats = [c for c in features if c in M.CATEGORIES]
    nums = [c for c in features if c not in M.CATEGORIES]
    flagged = [c for c in nums if c in M.ENRICHMENT]
    inputs = _sql([f"CAST({c} AS DOUBLE) AS {c}_d" for c in nums]
                  + [f"CAST({c} IS NULL AS DOUBLE) AS {c}_na" for c in flagged])
    index = StringIndexer(inputCols=cats, outputCols=[f"{c}_i" for c in cats],
                          handleInvalid="keep")
    encode = TargetEncoder(inputCols=[f"{c}_i" for c in cats], outputCols=[f"{c}_e" for c in cats],
                           labelCol="y", targetType="continuous", smoothing=10.0,
                           handleInvalid="keep")
    # the encoded column still calls itself nominal; an expression makes it a plain number
    numbers = _sql([f"{c}_e + 0D AS {c}_t" for c in cats])
    impute = Imputer(inputCols=[f"{c}_d" for c in nums], outputCols=[f"{c}_f" for c in nums])
    columns = [*[f"{c}_t" for c in cats], *[f"{c}_f" for c in nums], *[f"{c}_na" for c in flagged]]
    assemble = VectorAssembler(inputCols=columns, outputCol="features")
    return [inputs, index, encode, numbers, impute, assemble], columns


def kept_prefix(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """How many trees the smallest error so far needs when ``patience`` rounds without a smaller one end
    the boosting, and whether they have ended it."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The model of the first ``n`` trees; boosting adds trees, so it is what ``n`` rounds would have given."""
    jvm, gateway, java = SparkSession.active()._jvm, SparkSession.active().sparkContext._gateway, model._java_obj
    regression = jvm.org.apache.spark.ml.regression
    trees = gateway.new_array(regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(jvm.double, n)
    for i, (tree, weight) in enumerate(zip(list(java.trees())[:n], list(java.treeWeights())[:n])):
        trees[i], weights[i] = tree, weight
    cut = GBTRegressionModel(regression.GBTRegressionModel(f"{java.uid()}_{n}", trees, weights))
    return model._copyValues(cut)


def fit_boosted(train: DataFrame, features: list[str], valid: DataFrame | None = None,
                trees: int = TREES, depth: int = DEPTH, step: float = 0.05,
                seed: int = 42, patience: int = PATIENCE) -> PipelineModel:
    """Encoders are fitted on the training rows only; ``valid`` only stops the boosting.

    A fit can't go on where another has ended, but a longer one begins with the trees of a shorter
    one: each has a seed of its own. So the number of rounds is doubled until ``patience`` is used up or
    ``trees`` is reached, which costs at most twice the last fit. One pass over ``valid`` gives the error
    of every prefix of the trees; the best is kept.
    """
    shared_folder(train.sparkSession)  # a long boosting checkpoints its residuals there
    stages, _ = _stages(features)
    fitted = Pipeline(stages=stages).fit(train)
    rows = fitted.transform(train).select("features", "y").persist()
    held = fitted.transform(valid).select("features", "y").persist() if valid is not None else None

    def boosted(rounds: int) -> GBTRegressionModel:
        return GBTRegressor(featuresCol="features", labelCol="y", maxIter=rounds, maxDepth=depth,
                            stepSize=step, minInstancesPerNode=40, subsamplingRate=0.8,
                            featureSubsetStrategy="0.8", checkpointInterval=25, seed=seed).fit(rows)

    rounds = trees if held is None else min(trees, patience + max(1, patience // 4))
    model = boosted(rounds)
    if held is not None:
        kept, over = kept_prefix(model.evaluateEachIteration(held, "squared"), patience)
        while not over and rounds < trees:
            rounds = min(trees, 2 * rounds)
            model = boosted(rounds)
            kept, over = kept_prefix(model.evaluateEachIteration(held, "squared"), patience)
        model = first_trees(model, kept)
        held.unpersist()
    rows.unpersist()
    return PipelineModel(stages=[*fitted.stages, model])


def predict_prices(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("pred", F.exp("prediction"))


def retained_trees(model: PipelineModel) -> int:
    """Trees that are left after early stopping."""
    return model.stages[-1].getNumTrees


def splits(model: PipelineModel) -> DataFrame:
    """The inner nodes of all trees: tree, node, the place of the split's variable, how many rows met
    the split (n) and by how much it lowered their squared error in all (gain)."""
    spark = SparkSession.active()
    path = f"{shared_folder(spark)}/models/{uuid.uuid4().hex}"
    model.stages[-1].save(path)
    delete_at_end(spark, path)
    node = F.col("nodeData")
    n = F.get(node["impurityStats"], F.lit(0))
    # a node's gain is per row
    return spark.read.parquet(f"{path}/data").filter(node["leftChild"] >= 0).select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), node["split"]["featureIndex"].alias("place"),
        n.alias("n"), (node["gain"] * n).alias("gain"))


def importance(model: PipelineModel, features: list[str]) -> DataFrame:
    """Share of the total gain of all splits per variable; a missing-value flag counts with its variable."""
    _, columns = _stages(features)
    places = SparkSession.active().createDataFrame(
        [(i, c.rsplit("_", 1)[0]) for i, c in enumerate(columns)], "place int, variable string")
    per = (places.join(splits(model), "place", "left").groupBy("variable")
           .agg(F.coalesce(F.sum("gain"), F.lit(0.0)).alias("gain")))
    total = F.col("_t")
    # one row a variable
    return per.join(per.agg(F.sum("gain").alias("_t")), how="cross").select(
        "variable", C.round_half_even(F.col("gain") / F.nullif(total, F.lit(0.0)) * 100, 1).alias("part_pct")
    ).orderBy(F.col("part_pct").desc(), "variable")


def evaluate_models(sales: DataFrame, trees: int = TREES, depth: int = DEPTH, patience: int = PATIENCE,
                    fitted: PipelineModel | None = None) -> tuple[DataFrame, PipelineModel]:
    """Boosted trees with and without enrichment and the median baseline, on the two last years."""
    split = M.temporal_split(sales)
    train, valid = split.filter("part = 'train'"), split.filter("part = 'valid'")
    model = fitted or fit_boosted(train, ENRICHED, valid, trees, depth, patience=patience)
    plain = fit_boosted(train, BASE, valid, trees, depth, patience=patience)
    held = split.filter("part != 'train'")
    predicted = {
        "modele_enrichi": predict_prices(model, held).select("part", "prix_m2", "pred"),
        "modele_sans_enrichissement": predict_prices(plain, held).select(
            "part", "prix_m2", "pred"),
        "baseline": M.baseline(train, held).select(
            "part", "prix_m2", F.col("prediction_baseline").alias("pred")),
    }
    report = None
    for name, df in predicted.items():
        one = M.regression_metrics(df, "prix_m2", "pred", ["part"]).withColumn(
            "modele", F.lit(name))
        report = one if report is None else report.unionByName(one)
    return report, model


def out_of_sample(sales: DataFrame, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """Every sale predicted by a model that has not seen its year, with the gap to it.

    ``trees`` is what early stopping has left: a year's model has no year of its own to stop on.
    """
    fit: Callable[[DataFrame], PipelineModel] = lambda df: fit_boosted(
        df, ENRICHED, None, trees, depth)
    return M.scored(M.leave_one_group_out(sales, fit)).select(
        "transaction_id", "annee", "prix_m2", "prix_m2_predit", "ecart_pct")


def out_of_sample_metrics(scored: DataFrame) -> DataFrame:
    """Error measures of the out-of-sample predictions over all years together."""
    rows = scored.withColumn("part", F.lit("toutes_annees"))
    return M.regression_metrics(rows, "prix_m2", "prix_m2_predit", ["part"])


def prediction_checks(sales: DataFrame, scored: DataFrame, gains: DataFrame) -> DataFrame:
    """What holds exactly whatever the trees are, as (controle, valeur)."""
    again = C.gap_pct("prix_m2", "prix_m2_predit")
    count = F.count("*").alias("valeur")
    whole = F.col("prix_m2_predit") == C.round_half_even("prix_m2_predit", 0)
    parts = {
        "ventes_predites": scored.agg(count),
        "ventes_en_double": scored.groupBy("transaction_id").agg(count).filter("valeur > 1").agg(count),
        "ventes_sans_prediction": sales.join(scored, "transaction_id", "left_anti").agg(count),
        "annees_predites": scored.select("annee").distinct().agg(count),
        "ecarts_faux": scored.filter(~again.eqNullSafe(F.col("ecart_pct"))).agg(count),
        "predictions_non_entieres": scored.filter(~whole).agg(count),
        "variables": gains.agg(count),
        # shares are rounded to a tenth each
        "importances_hors_total": gains.agg(
            (F.abs(F.sum("part_pct") - 100.0) > 0.05 * F.count("*")).cast("bigint").alias("valeur")),
    }
    rows = [df.select(F.lit(name).alias("controle"), F.col("valeur").cast("bigint")) for name, df in parts.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
