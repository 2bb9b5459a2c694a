"""The pipeline on a small fixture, stage by stage, against plain implementations."""

from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from cadastria.llm import rules
from cadastria.llm.suffixes import whole_characters

from . import brute
from .conftest import SCHEMA, edge_rows, prose

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def fixture_rows() -> list[tuple]:
    passage = " ".join(f"passage{i}" for i in range(60))
    rows = [r for r in edge_rows() if r[0] is not None and not (r[1] and "\x00" in r[1])]
    rows += [(100 + i, prose(200 + i, 90) + "\n" + passage + " " + prose(300 + i, 40), "en", "s", 9) for i in range(4)]
    near = prose(77, 150).split()
    rows += [(200 + i, " ".join(near[:70] + [f"other{i}"] + near[71:]), "en", "s", 9) for i in range(5)]
    return rows + [(300, prose(88, 80) + " mail a.b@c.example.org and 10.0.0.1", "en", "s", 9)]


def stages(spark):
    docs = spark.createDataFrame(fixture_rows(), SCHEMA).repartition(3)
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), stage_schema(name, docs))
        yield name, docs


def stage_schema(name, docs):
    return docs.schema if name != "pack" else (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


@pytest.fixture(scope="module")
def kept(spark):
    return {name: docs.collect() for name, docs in stages(spark)}


def test_rules(kept):
    want = {r[0] for r in fixture_rows() if brute.kept_by_rules(r[1], rules.RULES, rules.STOP_WORDS)}
    assert {r["doc_id"] for r in kept["quality_rules"]} == want and not {16, 18} & want


def test_near_duplicates(kept):
    rows = [(r["doc_id"], r["text"]) for r in kept["quality_rules"]]
    want = {i for (i, _), c in zip(rows, brute.components(rows)) if i == c}
    got = [r["doc_id"] for r in kept["near_duplicates"]]
    assert sorted(got) == sorted(want) and 200 in got and not {201, 202, 203, 204} & set(got)


def test_repeated_strings(kept):
    before = kept["near_duplicates"]
    texts = [r["text"].encode() for r in before]
    want = {r["doc_id"]: brute.rest_of(t, whole_characters(t, runs)).decode()
            for r, t, runs in zip(before, texts, brute.repeated_runs(texts))}
    got = {r["doc_id"]: r["text"] for r in kept["repeated_strings"]}
    assert got == want and all(len(t) == r["n_chars"] or t == old["text"] for r, (t, old) in zip(
        kept["repeated_strings"], ((got[r["doc_id"]], next(b for b in before if b["doc_id"] == r["doc_id"])) for r in kept["repeated_strings"])))
    assert "passage30" not in got[100] and got[300].endswith("10.0.0.1")


def test_personal_data(kept):
    texts = {r["doc_id"]: r["text"] for r in kept["personal_data"]}
    assert texts[300].endswith("mail <email> and <ip>")
    for r in kept["repeated_strings"]:
        if not brute.base_spans(r["text"]):
            assert texts[r["doc_id"]] == r["text"]
        assert not brute.base_spans(texts[r["doc_id"]])


def test_packing(kept):
    library = Tokenizer.from_file(BYTE_BPE)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in kept["pack"]:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["offset"] + r["length"]))
    docs = {r["doc_id"]: r["text"] for r in kept["personal_data"]}
    assert set(by_doc) == set(docs)
    for doc_id, rows in by_doc.items():
        n = len(library.encode(docs[doc_id], add_special_tokens=False).ids) + 1
        rows.sort(key=lambda r: r["start"])
        assert [r["start"] for r in rows] == [0, *np.cumsum([r["length"] for r in rows])[:-1]] and rows[0]["doc_tokens"] == n
    for spans in by_sequence.values():
        spans.sort()
        assert [a for a, _ in spans] == [0, *[b for _, b in spans[:-1]]] and spans[-1][1] <= 2048


def test_columns_are_kept_and_empty_tables_pass(spark, clashing):
    docs = clashing.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
        if name != "pack":
            assert docs.columns == clashing.columns


def test_queries_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in names and "op9_rules" in entry.oracle_sql() and "pipeline" not in entry.oracle_sql()
