"""The whole monthly build: land, gate, transform, check, score, publish, log."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastria.functions import constants as K
from cadastria.operators import quality as Q
from cadastria.plans import boosted, checks, extract, model
from cadastria.plans import hedonic as station_effect
from cadastria.plans.warehouse import Inputs, Warehouse
from cadastria.sources import landing
from cadastria.streaming import incremental


@dataclass
class Settings:
    """Where the inputs lie and where the published tables go."""

    sales: str | list[str]
    stations: DataFrame
    planned: DataFrame
    income: DataFrame
    energy: DataFrame
    departments: DataFrame
    output: str
    city_department: str = K.CITY_DEPARTMENT
    minimum_rows: int = K.MIN_RAW_ROWS
    minimum_coverage: float = K.MIN_COVERAGE
    as_of: Column | None = None
    trees: int = boosted.TREES
    depth: int = boosted.DEPTH
    patience: int = boosted.PATIENCE
    run_id: str = "manual"
    logical_date: str = ""
    checked: list[str] = field(default_factory=lambda: [
        "departments", "lines", "sales", "proximity", "fact", "places", "calendar", "segments"])


def build(spark: SparkSession, s: Settings) -> Warehouse:
    """Write every published table below ``output``; a failed check stops the build there."""
    raw_path = f"{s.output}/raw"
    raw = incremental.refresh(spark, s.sales, K.RAW_COLUMNS, raw_path)
    Q.require_landing(Q.landing_gate(raw, s.departments, s.minimum_rows))
    # files that are as they were keep the day they were loaded, the manifest has the day they were looked at
    seen = spark.read.parquet(f"{raw_path}/manifest")
    Q.require_fresh(Q.freshness(seen, "_loaded_at", F.current_timestamp(),
                                K.FRESHNESS_WARN_DAYS, K.FRESHNESS_ERROR_DAYS))
    inputs = Inputs(
        lines=lambda: raw, stations=lambda: s.stations, planned=lambda: s.planned,
        income=lambda: s.income, energy=lambda: s.energy, departments=lambda: s.departments,
        city_department=s.city_department, as_of=s.as_of)
    w = Warehouse(spark, f"{s.output}#{s.run_id}", inputs)
    for name in s.checked:
        Q.enforce(checks.check_table(w, name))
    Q.require_coverage(checks.coverage_failures(w, s.minimum_coverage))
    predictions = publish_model(w, s)
    w.use_predictions(predictions)
    for name in ("predictions", "gaps", "band_evolution"):
        Q.enforce(checks.check_table(w, name))
    for name, table in (("fact", w.fact()), ("dim_temps", w.calendar()), ("dim_geo", w.places()),
                        ("dim_bien", w.segments()), ("mart_ecarts", w.gaps()),
                        ("mart_proximite", w.band_evolution())):
        landing.overwrite(table, f"{s.output}/{name}")
    extract.export({
        "prix_communes": extract.place_prices(w.fact(), w.places()),
        "prix_gares": extract.band_prices(w.fact(), w.places()),
        "ecarts_communes": extract.place_gaps(w.gaps(), w.places()),
    }, f"{s.output}/extract")
    landing.append_run_log(
        landing.run_log_row(s.run_id, s.logical_date, raw, w.fact(), w.gaps()),
        f"{s.output}/runs")
    return w


def publish_model(w: Warehouse, s: Settings) -> DataFrame:
    """Out-of-sample predictions and the evaluation, importance and station-effect reports."""
    sales = w.store.table("training", lambda: model.training_set(w.fact(), w.places()))
    metrics, fitted = boosted.evaluate_models(sales, s.trees, s.depth, s.patience)
    landing.overwrite(report("performance", "modele", metrics), f"{s.output}/report_performance")
    landing.overwrite(boosted.importance(fitted, boosted.ENRICHED),
                      f"{s.output}/report_importance")
    test = boosted.predict_prices(
        fitted, model.temporal_split(sales).filter("part = 'test'"))
    for by in ("code_departement", "type_bien"):
        landing.overwrite(model.segment_errors(test, "pred", by), f"{s.output}/report_erreur_{by}")
    landing.overwrite(
        station_effect.station_effect_report(
            station_effect.station_sales(w.fact(), w.places())),
        f"{s.output}/report_effet_gare")
    scored = boosted.out_of_sample(sales, boosted.retained_trees(fitted), s.depth)
    path = f"{s.output}/predictions"
    landing.overwrite(scored, f"{s.output}/out_of_sample")
    scored = w.store.spark.read.parquet(f"{s.output}/out_of_sample")
    landing.overwrite(boosted.out_of_sample_metrics(scored),
                      f"{s.output}/report_hors_echantillon")
    landing.overwrite(scored.select("transaction_id", "prix_m2_predit", "ecart_pct"), path)
    return w.store.spark.read.parquet(path)


def report(section: str, key: str, metrics: DataFrame) -> DataFrame:
    """Long form of a metrics table: section, key, part, metric, value."""
    names = ["mae", "mdape_pct", "part_10_pct", "r2_log"]
    return metrics.unpivot([key, "part"], names, "metric", "value").select(
        F.lit(section).alias("section"), F.col(key).alias("key"), "part", "metric", "value")

