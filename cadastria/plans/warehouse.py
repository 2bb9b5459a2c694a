"""The property warehouse: inputs in, named tables out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastria.functions import constants as K
from cadastria.operators import grain
from cadastria.plans import marts, staging, star
from cadastria.plans.model import mean_log_model_predictions
from cadastria.session import stored
from cadastria.sources import standin
from cadastria.sources.store import TableStore

Source = Callable[[], DataFrame]


@dataclass
class Inputs:
    """Raw text tables, as landing delivers them."""

    lines: Source
    stations: Source
    planned: Source
    income: Source
    energy: Source
    departments: Source
    city_department: str = K.CITY_DEPARTMENT
    as_of: Column | None = None


def standin_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    def sql(template: str) -> Source:
        return lambda: standin.run(spark, sf_dir, template)

    return Inputs(
        lines=sql(standin.RAW_LINES), stations=sql(standin.STATION_LINES),
        planned=sql(standin.PLANNED_LINES), energy=sql(standin.ENERGY_LINES),
        departments=sql(standin.SEED), income=lambda: standin.income_raw(spark, sf_dir),
        city_department=standin.CITY_DEPARTMENT, as_of=F.lit(standin.AS_OF).cast("date"),
    )


class Warehouse:
    """Text inputs as they are; staging, grain, star and marts as written tables."""

    def __init__(self, spark: SparkSession, scope: str, inputs: Inputs):
        self.inputs = inputs
        self.store = TableStore(spark, scope)
        self._predictions: DataFrame | None = None

    def raw_lines(self) -> DataFrame:
        return self.inputs.lines()

    def typed_sale_lines(self) -> DataFrame:
        return staging.sale_lines(self.inputs.lines())

    def departments(self) -> DataFrame:
        return self.inputs.departments()

    def stations(self) -> DataFrame:
        return self.store.table("stations", lambda: staging.stations(self.inputs.stations()))

    def planned(self) -> DataFrame:
        return self.store.table(
            "planned_stations", lambda: staging.planned_stations(self.inputs.planned()))

    def income(self) -> DataFrame:
        return self.store.table("income", lambda: staging.income(self.inputs.income()))

    def energy(self) -> DataFrame:
        return self.store.table("energy", lambda: staging.energy(self.inputs.energy()))

    # written tables
    def lines(self) -> DataFrame:
        """Typed once, because every branch of the sale grain reads other columns of it."""
        return self.store.table("lines", self.typed_sale_lines)

    def sales(self) -> DataFrame:
        return self.store.table("sales", lambda: grain.sale_grain(self.lines(), stored))

    def point_proximity(self) -> DataFrame:
        return self.store.table("point_proximity", lambda: star.point_proximity(
            star.distinct_points(self.sales()), self.stations(), self.planned()))

    def proximity(self) -> DataFrame:
        return self.store.table(
            "proximity", lambda: star.proximity(self.sales(), self.point_proximity()))

    def fact(self) -> DataFrame:
        return self.store.table("fact", lambda: star.fact(self.sales(), self.proximity()))

    def calendar(self) -> DataFrame:
        as_of = self.inputs.as_of if self.inputs.as_of is not None else F.current_date()
        return self.store.table("calendar", lambda: star.calendar(self.lines(), as_of))

    def places(self) -> DataFrame:
        return self.store.table("places", lambda: star.places(
            self.sales(), self.departments(), self.income(), self.energy()))

    def segments(self) -> DataFrame:
        return self.store.table("segments", lambda: star.segments(self.sales()))

    def use_predictions(self, predictions: DataFrame) -> None:
        """Score with another model than the mean-log one."""
        self._predictions = predictions

    def predictions(self) -> DataFrame:
        if self._predictions is not None:
            return self._predictions
        return self.store.table(
            "predictions", lambda: mean_log_model_predictions(self.fact(), ["type_bien"]))

    def gaps(self) -> DataFrame:
        return self.store.table(
            "gaps", lambda: marts.price_gaps(self.fact(), self.predictions()))

    def band_evolution(self) -> DataFrame:
        return self.store.table("band_evolution", lambda: marts.planned_band_evolution(
            self.fact(), self.places(), self.inputs.city_department))


_OPEN: dict[tuple[str, str], Warehouse] = {}


def standin_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One warehouse per application and data folder, so its tables are written once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        inputs = standin_inputs(spark, sf_dir)
        _OPEN[key] = w = Warehouse(spark, sf_dir, inputs)
        # landed once: laying the stand-in over the star tables is a join
        lines = inputs.lines
        inputs.lines = lambda: w.store.table("raw_lines", lines)
    return _OPEN[key]
