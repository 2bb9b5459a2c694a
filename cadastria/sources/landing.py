"""Landing of raw files as text: nothing is cleaned here, and the schema never changes."""

from __future__ import annotations

import re
import unicodedata
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastria.functions import columns as C
from cadastria.functions import constants as K

PROVENANCE = ["_source_file", "_loaded_at"]


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def source_file() -> Column:
    """Name of the file a row was read from; the path is percent-encoded, and a plus is a plus."""
    name = F.substring_index(F.col("_metadata.file_path"), "/", -1)
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


#: Files whose first lines are looked for at a time.
JOBS = 16


def file_paths(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The files below ``paths``, from their listing."""
    return sorted(r["path"] for r in spark.read.format("binaryFile").load(paths).select("path").collect())


def file_headers(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """The first line of every file that has one.

    A large file is read as several splits, and only the one at its beginning holds the header. A limit that ends a job takes
    the splits in their order, so it stops after the first buffer, packed or not; inside a union it would take the line of any
    split. So there is a small job a file, and the names of the files are all that the driver handles.
    """
    def first_line(file: str) -> list[tuple[str, str]]:
        beginning = spark.read.text(file).filter(F.col("_metadata.file_block_start") == 0)
        return [(file, r["value"]) for r in beginning.select("value").limit(1).collect()]

    with ThreadPool(JOBS) as pool:
        return dict(pair for pairs in pool.map(first_line, files) for pair in pairs)


def _split_header(header: str, sep: str) -> list[str]:
    return [h.strip().strip('"') for h in header.lstrip("﻿").split(sep)]


def read_csv_by_name(spark: SparkSession, paths: str | list[str], keep: list[str],
                     sep: str = ",", required: list[str] | None = None) -> DataFrame:
    """CSV files whose headers differ in order or content, bound by column name.

    Spark binds CSV columns by position, so there is one read per distinct header; the driver handles
    file names and headers only, as it does for any read of files. Columns outside ``keep`` are dropped, absent ones
    are NULL. With ``required``, a file that lacks one of those columns is an error.
    """
    by_header: dict[str, list[str]] = {}
    for file, header in file_headers(spark, file_paths(spark, paths)).items():
        by_header.setdefault(header, []).append(file)
    parts = []
    for header, files in by_header.items():
        names = _split_header(header, sep)
        if missing := [c for c in required or [] if c not in names]:
            raise ValueError(f"no known header in {files[0]}: {missing} not among {names}")
        # a repeated name would be ambiguous: the first one wins
        labels = [n if n not in names[:i] else f"_dup{i}" for i, n in enumerate(names)]
        part = (
            spark.read.schema(text_schema(labels)).option("header", True).option("sep", sep)
            .option("encoding", "UTF-8").csv(files)
        )
        present = [n for n in keep if n in labels]
        # an empty cell is a missing value, quoted or not
        parts.append(part.select(*[C.blank_to_null(n).alias(n) for n in present],
                                 source_file().alias("_source_file")))
    if not parts:
        parts = [spark.createDataFrame([], text_schema([*keep, "_source_file"]))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*[
        F.col(k) if k in out.columns else F.lit(None).cast("string").alias(k) for k in keep
    ], "_source_file")


def stamped(df: DataFrame) -> DataFrame:
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return df.withColumn("_loaded_at", now)


def land_sales(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All sale files as text with provenance; blank cells are NULL."""
    return stamped(read_csv_by_name(spark, paths, K.RAW_COLUMNS))


def overwrite(df: DataFrame, path: str) -> None:
    """Full reload: one write replaces the table, so a rerun gives the same rows."""
    df.write.mode("overwrite").parquet(path)


# ---- scope -------------------------------------------------------------------------------

def discover_years(index: DataFrame, column: str = "href") -> DataFrame:
    """Distinct four-digit folder names of a listing."""
    year = F.regexp_extract(F.col(column), r"(?:^|/)(\d{4})/?$", 1)
    return index.select(year.alias("annee")).filter("annee != ''").distinct().orderBy("annee")


def wanted_files(years: DataFrame, departments: DataFrame) -> DataFrame:
    """Every (year, department) with its file name; both lists are short by nature."""
    names = departments.agg(F.sort_array(F.collect_set("code_departement")).alias("d"))
    pairs = years.withColumn("code_departement", F.explode(names.scalar()))
    return pairs.select(
        "annee", "code_departement",
        F.concat_ws("", "annee", F.lit("_"), "code_departement", F.lit(".csv.gz")).alias("file"))


def chosen_years(setting: str, discovered: list[str]) -> list[str]:
    """'auto' follows what is published (or the fallback), otherwise a comma-separated list."""
    if setting.strip().lower() != "auto":
        return [v.strip() for v in setting.split(",") if v.strip()]
    return discovered or list(K.FALLBACK_YEARS)


# ---- change detection --------------------------------------------------------------------

def manifest(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row of comparable metadata per file, without reading any content."""
    return spark.read.format("binaryFile").load(paths).select(
        F.col("path").alias("file"), F.col("modificationTime").cast("string").alias(
            "last_modified"),
        F.col("length").cast("string").alias("content_length"),
        F.lit(None).cast("string").alias("etag"))


META = ["last_modified", "content_length", "etag"]


def manifest_diff(stored: DataFrame, remote: DataFrame) -> DataFrame:
    """Status of every file: absent at the source, unchanged, new or republished.

    Only metadata that the source states is compared; if it states none, the file is reloaded.
    """
    s = stored.select("file", *[F.col(m).alias(f"s_{m}") for m in META], F.lit(1).alias("_s"))
    r = remote.select("file", *META, F.lit(1).alias("_r"))
    stated = [F.col(m).isNotNull() & (F.col(m) != "") for m in META]
    same = F.lit(True)
    for m, there in zip(META, stated, strict=True):
        same = same & (~there | F.coalesce(F.col(f"s_{m}") == F.col(m), F.lit(False)))
    comparable = stated[0] | stated[1] | stated[2]
    return r.join(s, "file", "full").select(
        "file",
        F.when(F.col("_r").isNull(), K.FILE_ABSENT)
        .when(F.col("_s").isNull(), K.FILE_NEW)
        .when(comparable & same, K.FILE_CACHED)
        .otherwise(K.FILE_UPDATED).alias("status"))


def changed_files(stored: DataFrame, remote: DataFrame) -> DataFrame:
    return manifest_diff(stored, remote).filter(
        F.col("status").isin(K.FILE_NEW, K.FILE_UPDATED)).select("file")


# ---- reference sources -------------------------------------------------------------------

def _read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("sep", ";").option(
        "inferSchema", False).csv(path)


def with_point(df: DataFrame, column: str = "geo_point_2d") -> DataFrame:
    lat, lon = C.split_point(column)
    return df.withColumns({"latitude": lat, "longitude": lon})


def _present(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*[k for k in keep if k in df.columns])


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return _present(with_point(_read_text_csv(spark, path)), K.STATION_COLUMNS)


def read_planned_stations(spark: SparkSession, path: str) -> DataFrame:
    return _present(with_point(_read_text_csv(spark, path)), K.PLANNED_COLUMNS)


def normalised(header: str) -> str:
    """Header without accents or punctuation, for robust matching."""
    plain = unicodedata.normalize("NFKD", header).encode("ascii", "ignore").decode()
    return " ".join(re.findall(r"[a-z0-9]+", plain.lower()))


def by_keywords(df: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """Columns found by keywords in their normalised header; the first match wins."""
    chosen = []
    for target, words in wanted.items():
        found = [c for c in df.columns if all(w in normalised(c) for w in words)]
        if not found:
            raise ValueError(f"no column for {target}: {words}")
        chosen.append(F.col("`" + found[0].replace("`", "``") + "`").alias(target))
    return df.select(*chosen)


def in_departments(df: DataFrame, departments: list[str], column: str = "code_commune") -> DataFrame:
    return df.filter(F.substring(column, 1, 2).isin(departments))


def read_income(spark: SparkSession, path: str, departments: list[str],
                source_url: str | None = None) -> DataFrame:
    found = in_departments(by_keywords(_read_text_csv(spark, path), K.INCOME_KEYWORDS),
                           departments)
    url = F.lit(source_url or path)
    return found.withColumns({"millesime": C.vintage(url), "source_url": url})


def require_resource(resources: DataFrame) -> str:
    """The URL of the most recent CSV; a list without one is an error."""
    found = latest_csv_resource(resources).head()
    if found is None or found.url is None:
        raise ValueError("no CSV among the resources")
    return found.url


def latest_csv_resource(resources: DataFrame, by: list[str] | None = None) -> DataFrame:
    """URL of the most recent CSV of a resource list; a missing date sorts lowest."""
    csv = resources.filter(F.lower(F.coalesce("format", F.lit(""))) == "csv")
    return csv.groupBy(*(by or [])).agg(
        F.max_by("url", F.coalesce("last_modified", F.lit(""))).alias("url"))


def entries(df: DataFrame, document: str, path: str) -> DataFrame:
    """The columns of ``df`` and ``entry``, one row per element of the list (or object) at ``path`` of a variant.

    ``name`` is the element's own "value", else its key in an object. Where there is nothing at ``path`` there is no row.
    """
    inner = F.try_variant_get(F.col(document).outer(), path, "variant")
    found = df.lateralJoin(df.sparkSession.tvf.variant_explode(inner))
    name = F.coalesce(F.try_variant_get("value", "$.value", "string"), F.col("key"))
    return found.select(*df.columns, name.alias("name"), F.col("value").alias("entry"))


def flatten_energy(documents: DataFrame, column: str = "value") -> DataFrame:
    """Two-level aggregation documents to (commune, label, count); no inner list, no row.

    Documents are read as variants, so one of another shape is no loss: numbers may be texts, lists may be objects
    by name, and what else a document holds doesn't matter. What isn't JSON gives no rows.
    """
    doc = documents.select(F.try_parse_json(column).alias("doc"))
    communes = entries(doc, "doc", "$.aggs").select(F.col("name").alias("code_commune"), F.col("entry").alias("commune"))
    labels = entries(communes, "commune", "$.aggs")
    # an object by label may hold the bare count
    total = F.coalesce(F.try_variant_get("entry", "$.total", "bigint"), F.try_variant_get("entry", "$", "bigint"))
    return labels.select("code_commune", F.col("name").alias("etiquette_dpe"), total.alias("nb_dpe"))


def read_energy(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return flatten_energy(spark.read.text(paths, wholetext=True))


def departments_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    schema = "code_departement string, nom_departement string, zone string"
    if path is None:
        return spark.createDataFrame(K.DEPARTMENTS, schema)
    return spark.read.schema(schema).option("header", True).csv(path)


def load_references(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Overwrite every reference table, refusing empty ones; returns the row counts."""
    counts = {}
    for name, df in tables.items():
        seen = F.count(F.lit(1)).alias("n")
        obs = Observation(name)
        stamped(df).observe(obs, seen).write.mode("overwrite").parquet(f"{folder}/{name}")
        counts[name] = obs.get["n"]
        if counts[name] == 0:
            raise ValueError(f"empty source: {name}")
    return counts


def run_log_row(run_id: str, logical_date: str, raw: DataFrame, fact: DataFrame,
                gaps: DataFrame) -> DataFrame:
    """One row of run figures, computed where the tables are."""
    count = F.count("*")
    return raw.agg(
        count.alias("raw_rows"), F.count_distinct("code_departement").alias("departements"),
    ).select(
        F.lit(run_id).alias("run_id"), F.lit(logical_date).alias("logical_date"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("finished_at"),
        "raw_rows", "departements", fact.select(count).scalar().alias("ventes"),
        gaps.select(count).scalar().alias("ventes_scorees"),
    )


def append_run_log(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)
