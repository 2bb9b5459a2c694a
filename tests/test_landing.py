import datetime as dt
import gzip
import json

import pytest

from cadastria.functions import constants as K
from cadastria.operators import quality as Q
from cadastria.plans import staging
from cadastria.sources import landing
from cadastria.streaming import incremental


def write_gz(path, header, rows):
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join([header, *rows]) + "\n")


def test_files_with_other_headers_are_bound_by_name(spark, tmp_path):
    write_gz(tmp_path / "2024_75.csv.gz", "id_mutation,date_mutation,valeur_fonciere,section",
             ["m1,2024-01-01,100000,AB", 'm2,,"",CD'])
    write_gz(tmp_path / "2024_92.csv.gz", "valeur_fonciere,id_mutation", ["n/a,m3"])
    write_gz(tmp_path / "2025_92.csv.gz", "valeur_fonciere,id_mutation", ["5,m4"])
    got = landing.land_sales(spark, str(tmp_path))
    assert got.columns == [*K.RAW_COLUMNS, "_source_file", "_loaded_at"]
    assert {f.dataType.simpleString() for f in got.schema.fields} == {"string"}
    rows = {r.id_mutation: r for r in got.collect()}
    assert rows["m1"].valeur_fonciere == "100000" and rows["m3"].valeur_fonciere == "n/a"
    assert rows["m2"].date_mutation is None and rows["m2"].valeur_fonciere is None
    assert rows["m4"].date_mutation is None and rows["m4"]._source_file == "2025_92.csv.gz"
    assert dt.datetime.fromisoformat(rows["m1"]._loaded_at)


def test_full_reload_is_idempotent(spark, tmp_path):
    write_gz(tmp_path / "a.csv.gz", "id_mutation", ["m1", "m2"])
    for _ in range(2):
        landing.overwrite(landing.land_sales(spark, str(tmp_path / "a.csv.gz")),
                          str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_manifest_statuses(spark):
    def meta(rows):
        return spark.createDataFrame(
            rows, "file string, last_modified string, content_length string, etag string")

    stored = meta([("same", "a", "1", "e"), ("grown", "a", "1", "e"), ("gone", "a", "1", "e"),
                   ("blank", None, None, None), ("part", "a", "1", "e")])
    remote = meta([("same", "a", "1", "e"), ("grown", "b", "2", "e"), ("new", "a", "1", "e"),
                   ("blank", None, None, None), ("part", "a", None, "")])
    got = {r.file: r.status for r in landing.manifest_diff(stored, remote).collect()}
    assert got == {"same": "cache", "grown": "mis à jour", "gone": "absent", "new": "nouveau",
                   "blank": "mis à jour", "part": "cache"}
    assert {r.file for r in landing.changed_files(stored, remote).collect()} == {
        "grown", "new", "blank"}


def test_manifest_of_real_files(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"123")
    row = landing.manifest(spark, str(tmp_path)).head()
    assert row.content_length == "3" and row.last_modified


def test_years_and_scope(spark):
    index = spark.createDataFrame([("../",), ("/geo/2023/",), ("2024/",), ("2024/",), ("note.txt",)],
                                  "href string")
    years = landing.discover_years(index)
    assert [r.annee for r in years.collect()] == ["2023", "2024"]
    files = landing.wanted_files(years, landing.departments_seed(spark))
    assert files.count() == 16 and "2024_75.csv.gz" in {r.file for r in files.collect()}
    assert landing.chosen_years("2023, 2024", ["1"]) == ["2023", "2024"]
    assert landing.chosen_years("auto", []) == K.FALLBACK_YEARS


def test_reference_sources(spark, tmp_path):
    (tmp_path / "gares.csv").write_text(
        "nom_gares;mode;res_com;geo_point_2d;autre\n Nation ;metro ;M1;48.848, 2.396;x\n"
        " Nation ;RER;A;48.848, 2.396;x\nVide;TRAM;T1;;x\n", encoding="utf-8")
    raw = landing.read_stations(spark, str(tmp_path / "gares.csv"))
    assert raw.columns == ["nom_gares", "mode", "res_com", "latitude", "longitude"]
    row = staging.stations(raw).head()
    assert (row.nom_gare, row.mode_principal, row.lignes, row.nb_lignes) == (
        "Nation", "RER", "A, M1", 2)
    (tmp_path / "revenus-2021.csv").write_text(
        "[DISP] Médiane (€);Code géographique;Libellé géographique;[DISP] Nbre de ménages fiscaux;"
        "[DISP] 1er décile (€);[DISP] 9e décile (€);[DISP] Part des pensions (%)\n"
        "25000;75101;Paris 1er;9000;11000;60000;20,1\n;13001;Aix;1;1;1;1\n", encoding="utf-8")
    income = landing.read_income(spark, str(tmp_path / "revenus-2021.csv"), ["75"])
    row = staging.income(income).head()
    assert income.count() == 1 and row.revenu_median_uc == 25000.0
    assert row.millesime_revenus == 2021 and row.part_pensions_pct is None
    with pytest.raises(ValueError):
        landing.by_keywords(spark.createDataFrame([(1,)], "x int"), K.INCOME_KEYWORDS)


def test_energy_documents(spark, tmp_path):
    doc = {"aggs": [{"value": "75101", "aggs": [{"value": "a", "total": 3},
                                                {"value": "G", "total": 1}]},
                    {"value": "75102"}, {"value": "75103", "aggs": [{"value": "X", "total": 9}]}]}
    (tmp_path / "75.json").write_text(json.dumps(doc))
    raw = landing.read_energy(spark, str(tmp_path))
    assert raw.count() == 3
    row = staging.energy(raw).collect()
    assert [(r.code_commune, r.nb_dpe, r.part_dpe_fg_pct, r.part_dpe_ab_pct) for r in row] == [
        ("75101", 4, 25.0, 75.0)]
    with pytest.raises(Exception):
        staging.energy(spark.createDataFrame(
            [("1", "A", "dirty")], "code_commune string, etiquette_dpe string, nb_dpe string")
        ).collect()


def test_energy_documents_of_another_shape(spark):
    documents = [
        {"aggs": [{"value": 75101, "aggs": [{"value": "A", "total": "3"}, {"value": "B", "total": 4.0, "more": [1]}]}], "took": 5},
        {"aggs": {"75102": {"aggs": {"C": {"total": 7}, "D": 9}}, "75103": {"note": "none"}}},
        {"aggs": "soon"}, {"error": {"code": 503}}, [1, 2], None]
    rows = [(json.dumps(d),) for d in documents] + [("<html>not JSON",), (None,)]
    got = landing.flatten_energy(spark.createDataFrame(rows, "value string"))
    assert got.dtypes == [("code_commune", "string"), ("etiquette_dpe", "string"), ("nb_dpe", "bigint")]
    assert sorted(map(tuple, got.collect())) == [
        ("75101", "A", 3), ("75101", "B", 4), ("75102", "C", 7), ("75102", "D", 9)]


def test_latest_resource(spark):
    rows = [("csv", "u1", "2020"), ("CSV", "u2", "2021"), ("xlsx", "u3", "2023"), ("csv", "u4", None)]
    got = landing.latest_csv_resource(
        spark.createDataFrame(rows, "format string, url string, last_modified string"))
    assert got.head().url == "u2"
    with pytest.raises(ValueError):
        landing.require_resource(spark.createDataFrame(
            [("xlsx", "u3", "2023")], "format string, url string, last_modified string"))


def test_empty_source_is_refused(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "x string")
    assert landing.load_references({"t": df}, str(tmp_path)) == {"t": 1}
    with pytest.raises(ValueError):
        landing.load_references({"t": df.limit(0)}, str(tmp_path))
    with pytest.raises(Q.QualityError):
        Q.require_rows(df.limit(0), "t")


def test_stream_lands_each_file_once_and_by_name(spark, tmp_path):
    inbox, target = tmp_path / "in", tmp_path / "out"
    inbox.mkdir()
    (inbox / "a.csv").write_text('id,v\n1,x\n2,"y, z"\n')
    incremental.land_new_files(spark, str(inbox), ["id", "v"], str(target))
    (inbox / "b c é.csv").write_text("v,w,id\nz,0,3\n,0,4\n")
    for _ in range(2):
        incremental.land_new_files(spark, str(inbox), ["id", "v"], str(target))
    got = spark.read.parquet(str(target))
    assert sorted((r.id, r.v or "", r._source_file) for r in got.collect()) == [
        ("1", "x", "a.csv"), ("2", "y, z", "a.csv"), ("3", "z", "b c é.csv"), ("4", "", "b c é.csv")]
    # the same folder into another target starts anew
    incremental.land_new_files(spark, str(inbox), ["id"], str(tmp_path / "other"))
    assert spark.read.parquet(str(tmp_path / "other")).count() == 4


def test_stream_refuses_an_unknown_header(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.csv").write_text("x,y\n1,2\n")
    with pytest.raises(Exception, match="no known header"):
        incremental.land_new_files(spark, str(inbox), ["id", "v"], str(tmp_path / "out"))


def test_stream_opens_new_files_only_and_replaces_a_repeated_batch(spark, tmp_path, monkeypatch):
    inbox, target = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    opened = []
    plain = landing.read_csv_by_name
    monkeypatch.setattr(landing, "read_csv_by_name", lambda s, paths, *a, **k: opened.append(
        sorted(p.rsplit("/", 1)[1] for p in paths)) or plain(s, paths, *a, **k))
    for i, name in enumerate("abc"):
        (inbox / f"{name}.csv").write_text(f"id,v\n{i},id\nid,v\n")
        incremental.land_new_files(spark, str(inbox), ["id", "v"], target, files_per_batch=1)
    assert opened == [["a.csv"], ["b.csv"], ["c.csv"]]
    # a row that looks like the header is a row
    assert sorted((r.id, r.v) for r in spark.read.parquet(target).collect()) == [
        ("0", "id"), ("1", "id"), ("2", "id"), ("id", "v"), ("id", "v"), ("id", "v")]
    incremental.land_files(spark, [str(inbox / "b.csv")], ["id", "v"], target, ["id"])
    assert spark.read.parquet(target).count() == 6


def test_required_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,w\n1,2\n")
    assert landing.read_csv_by_name(spark, str(tmp_path), ["id", "v"], required=["id"]).head().v is None
    with pytest.raises(ValueError, match="no known header"):
        landing.read_csv_by_name(spark, str(tmp_path), ["id", "v"], required=["v"])


def input_bytes(spark):
    executors = spark._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalInputBytes() for i in range(executors.size()))


def test_headers_are_found_without_reading_the_files(spark, tmp_path):
    line = "1,2,3,4\n" * (1 << 20)
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(f"a,b,c,{i}\n" + line)
    write_gz(tmp_path / "packed.csv.gz", "z,y", ["0,0"])
    (tmp_path / "empty.csv").write_text("")
    spark.range(1).count()
    before = input_bytes(spark)
    files = landing.file_paths(spark, str(tmp_path))
    got = {path.rsplit("/", 1)[1]: header for path, header in landing.file_headers(spark, files).items()}
    assert got == {"0.csv": "a,b,c,0", "1.csv": "a,b,c,1", "2.csv": "a,b,c,2", "packed.csv.gz": "z,y"}
    import time
    time.sleep(1)
    assert input_bytes(spark) - before < 1 << 20


def test_header_of_a_file_of_many_splits_is_its_first_line(spark, tmp_path):
    """Every split has a first row; only the one at the beginning of the file is read for the header."""
    import time
    for i in range(2):
        (tmp_path / f"{i}.csv").write_text(f"a,b,{i}\n" + "1,2,3\n" * (1 << 20))
    small = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k"}
    was = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        files = landing.file_paths(spark, str(tmp_path))
        assert spark.read.text(files[0]).rdd.getNumPartitions() > 50
        time.sleep(1)
        before = input_bytes(spark)
        assert sorted(landing.file_headers(spark, files).values()) == ["a,b,0", "a,b,1"]
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    time.sleep(1)
    assert input_bytes(spark) - before < 1 << 20


def test_refresh_follows_the_source(spark, tmp_path):
    inbox, target = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    rows = lambda: sorted((r.id, r.v) for r in incremental.refresh(
        spark, str(inbox), ["id", "v"], target).collect())
    (inbox / "a é+%20 1.csv").write_text("id,v\n1,x\n")
    (inbox / "b.csv").write_text("v,id\ny,2\n")
    assert rows() == [("1", "x"), ("2", "y")]
    loaded = {r._source_file: r._loaded_at for r in incremental.landed(spark, ["id", "v"], target).collect()}
    (inbox / "a é+%20 1.csv").write_text("id,v\n1,changed\n3,z\n")
    (inbox / "c.csv").write_text("id\n4\n")
    assert rows() == [("1", "changed"), ("2", "y"), ("3", "z"), ("4", None)]
    again = {r._source_file: r._loaded_at for r in incremental.landed(spark, ["id", "v"], target).collect()}
    assert again["b.csv"] == loaded["b.csv"] and again["a é+%20 1.csv"] > loaded["a é+%20 1.csv"]
    (inbox / "b.csv").unlink()
    assert rows() == [("1", "changed"), ("3", "z"), ("4", None)]


def test_paths_with_spaces_and_accents_land(spark, tmp_path):
    folder = tmp_path / "a b"
    folder.mkdir()
    write_gz(folder / "x é+1%.csv.gz", "valeur_fonciere,id_mutation", ["5,m4"])
    rows = landing.land_sales(spark, str(folder)).collect()
    assert [(r.id_mutation, r._source_file) for r in rows] == [("m4", "x é+1%.csv.gz")]


def test_only_changed_files_are_reloaded(spark, tmp_path):
    inbox, target = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    (inbox / "a.csv").write_text("id,v\n1,x\n")
    (inbox / "b.csv").write_text("v,id\ny,2\n")
    none = spark.createDataFrame([], landing.manifest(spark, str(inbox)).schema)
    stored = incremental.refresh_changed(spark, str(inbox), ["id", "v"], target, none).collect()
    (inbox / "a.csv").write_text("id,v\n1,changed\n7,new\n")
    kept = spark.createDataFrame(stored, none.schema)
    status = {r.file.rsplit("/", 1)[1]: r.status for r in landing.manifest_diff(
        kept, landing.manifest(spark, str(inbox))).collect()}
    assert status == {"a.csv": K.FILE_UPDATED, "b.csv": K.FILE_CACHED}
    incremental.refresh_changed(spark, str(inbox), ["id", "v"], target, kept)
    got = spark.read.parquet(target).collect()
    assert sorted((r.id, r.v) for r in got) == [("1", "changed"), ("2", "y"), ("7", "new")]


def test_republished_file_replaces_its_rows(spark, tmp_path):
    schema = "id string, _source_file string"
    landed = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b")], schema)
    again = spark.createDataFrame([("1", "a"), ("9", "a")], schema)
    assert sorted(r.id for r in incremental.replace_files(landed, again).collect()) == [
        "1", "3", "9"]
    target = str(tmp_path / "t")
    incremental.refresh_partitions(spark, landed, target)
    incremental.refresh_partitions(spark, again, target)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == ["1", "3", "9"]


# ---- checks ------------------------------------------------------------------------------

def test_checks_report_failures_and_severity(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", -1.0), (None, None), ("c", 0.0)],
                               "k string, v double")
    parent = spark.createDataFrame([("a",)], "k string")
    report = Q.run_checks("t", df, [
        Q.not_null("k"), Q.unique("k"), Q.unique("k", "v"), Q.accepted_values("k", ["a"]),
        Q.accepted_range("v", 0, inclusive=False, severity="warn"),
        Q.accepted_range("v", -1, 1), Q.relationship("k", parent, "k")])
    got = [(r.check_name, r.failures, r.status) for r in report.collect()]
    assert sorted(got) == sorted([
        ("not_null", 1, "error"), ("accepted_values", 1, "error"), ("accepted_range", 2, "warn"),
        ("accepted_range", 0, "pass"), ("unique", 1, "error"), ("unique_combination", 0, "pass"),
        ("relationship", 1, "error")])
    with pytest.raises(Q.QualityError):
        Q.enforce(report)
    assert Q.enforce(report.filter("status != 'error'")).count() == 3


def test_row_checks_are_counted_by_the_write(spark):
    from cadastria.sources.store import TableStore

    df = spark.createDataFrame([("a", 1.0), ("a", -1.0), (None, None), ("c", 0.0)], "k string, v double").repartition(3)
    found = [Q.not_null("k"), Q.unique("k"), Q.accepted_range("v", 0, inclusive=False, severity="warn"), Q.accepted_values("k", ["a"])]
    store = TableStore(spark, "observed")
    store.watch("t", Q.row_marks(found))
    table = store.table("t", lambda: df)
    assert store.seen("t", 3) == [1, 2, 1] and store.seen("t", 2) is None
    # the report is the same, and its row checks need no scan
    report = lambda seen: sorted(map(tuple, Q.run_checks("t", table, found, seen).collect()))
    assert report(store.seen("t", 3)) == report(None)
    only_rows = [c for c in found if c.row is not None]
    plan = Q.run_checks("t", table, only_rows, store.seen("t", 3))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    # a table that is there already is scanned
    plain = TableStore(spark, "observed late")
    plain.table("t", lambda: df)
    plain.watch("t", Q.row_marks(found))
    assert plain.seen("t", 3) is None


def test_landing_gate_and_freshness(spark):
    from pyspark.sql import functions as F

    raw = spark.createDataFrame([("75",), ("92",), ("92",)], "code_departement string")
    seed = landing.departments_seed(spark)
    gate = Q.landing_gate(raw, seed, 2).head()
    assert not gate.passed and gate.missing_groups == "77, 78, 91, 93, 94, 95"
    with pytest.raises(Q.QualityError):
        Q.require_landing(Q.landing_gate(raw, seed, 2))
    few = seed.filter("code_departement in ('75', '92')")
    assert Q.require_landing(Q.landing_gate(raw, few, 3)).head().raw_rows == 3
    assert not Q.landing_gate(raw, few, 4).head().passed
    loads = spark.createDataFrame([("2024-01-01T00:00:00+00:00",), ("bad",)], "t string")
    for day, status in (("2024-02-01", "pass"), ("2024-02-10", "warn"), ("2024-03-01", "error")):
        now = F.lit(day).cast("timestamp")
        assert Q.freshness(loads, "t", now, 35, 55).head().status == status
