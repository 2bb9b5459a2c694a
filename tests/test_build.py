"""The whole build from files, on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from cadastria.functions import constants as K
from cadastria.operators.quality import QualityError
from cadastria.plans.build import Settings, build
from cadastria.sources import landing, standin
from cadastria.streaming import incremental

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def settings(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("build")
    raw = standin.raw_lines(spark, SF)
    raw.write.option("header", True).option("compression", "gzip").csv(f"{folder}/in/a")
    return Settings(
        sales=[f"{folder}/in/a"], stations=standin.run(spark, SF, standin.STATION_LINES),
        planned=standin.run(spark, SF, standin.PLANNED_LINES),
        income=standin.income_raw(spark, SF), energy=standin.run(spark, SF, standin.ENERGY_LINES),
        departments=standin.run(spark, SF, standin.SEED), output=f"{folder}/out",
        city_department=standin.CITY_DEPARTMENT, minimum_rows=1000,
        as_of=F.lit(standin.AS_OF).cast("date"), trees=2, depth=2, run_id="r1",
        logical_date="2002-01-01", minimum_coverage=0.5)


def test_build_publishes_everything(spark, settings):
    w = build(spark, settings)
    assert w.fact().count() == 12539
    scored = w.gaps().count()
    assert scored == w.fact().filter("est_prix_m2_fiable").count()
    log = spark.read.parquet(f"{settings.output}/runs").head()
    assert (log.run_id, log.ventes, log.ventes_scorees, log.departements) == (
        "r1", 12539, scored, 5)
    for name in ("fact", "dim_temps", "dim_geo", "dim_bien", "mart_ecarts", "report_hors_echantillon",
                 "report_performance", "report_importance", "report_erreur_type_bien",
                 "report_effet_gare", "extract/prix_communes", "extract/prix_gares",
                 "extract/ecarts_communes", "mart_proximite"):
        assert spark.read.parquet(f"{settings.output}/{name}").count() > 0


def test_files_that_are_as_they_were_are_not_read_again(spark, settings, monkeypatch):
    raw = f"{settings.output}/raw"
    before = spark.read.parquet(f"{raw}/manifest").select(*landing.META, "file")
    assert landing.changed_files(before, landing.manifest(spark, settings.sales)).count() == 0
    monkeypatch.setattr(landing, "read_csv_by_name", None)
    again = incremental.refresh(spark, settings.sales, K.RAW_COLUMNS, raw)
    assert again.count() == standin.raw_lines(spark, SF).count()


def test_thin_coverage_blocks(spark, settings):
    from dataclasses import replace

    with pytest.raises(QualityError, match="coverage"):
        build(spark, replace(settings, minimum_coverage=1.01, output=settings.output + "3"))


def test_gate_blocks_a_short_landing(spark, settings):
    from dataclasses import replace

    with pytest.raises(QualityError):
        build(spark, replace(settings, minimum_rows=10**9, output=settings.output + "2"))
