import hashlib
import random

import numpy as np
import pytest

from cadastria.llm import suffixes

from . import brute
from .conftest import SCHEMA, edge_rows, prose


def compare(df, rows):
    texts = [(r[1] or "").encode() for r in rows]
    want = []
    for (doc_id, *_), text, runs in zip(rows, texts, brute.repeated_runs(texts)):
        rest = brute.rest_of(text, runs)
        want.append((doc_id, len(text), len(text) - len(rest), len(runs), hashlib.sha256(rest).hexdigest()))
    got = [tuple(r) for r in suffixes.removed(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_edge_rows(edges):
    compare(edges, edge_rows())


def random_texts(seed: int) -> list[tuple]:
    """Texts built from shared parts of about the length that counts."""
    pick = random.Random(seed)
    parts = [prose(seed * 100 + i, 30)[:n] for i, n in enumerate((198, 199, 200, 201, 150, 120, 300))] + ["ab" * 120, "z" * 250, "é" * 110]
    return [(i, "".join(pick.choice(parts) if pick.random() < 0.6 else prose(pick.randrange(10 ** 6), 6) for _ in range(pick.randrange(1, 6))),
             None, None, None) for i in range(80)]


def test_shared_parts(spark):
    rows = random_texts(1)
    compare(spark.createDataFrame(rows, SCHEMA).repartition(7), rows)


def test_long_texts_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "STRETCH", 300)
    rows = random_texts(2)[:40]
    compare(spark.createDataFrame(rows, SCHEMA).repartition(3), rows)


def test_index_family_at_any_batch_size():
    random_ = np.random.default_rng(3)
    for _ in range(100):
        values = np.array([b"%03d" % x for x in random_.integers(0, 60, random_.integers(1, 80))], "S200")
        groups = np.sort(random_.integers(0, 4, len(values)))
        # a string is of one group
        values = np.array([v + b"%d" % g for v, g in zip(values, groups)], "S200")
        family, at, found = suffixes.IndexFamily(), 0, []
        while at < len(values):
            n = int(random_.integers(1, 9))
            found += family.add(values[at:at + n], groups[at:at + n], np.arange(at, min(at + n, len(values)))).tolist()
            at += n
        same, counts = np.unique(values, return_counts=True)
        assert sorted(found) == np.flatnonzero(np.isin(values, same[counts > 1])).tolist()
        assert len(family.levels) <= 8


def test_family_compares_bytes():
    a, b = b"\x00" * 200, b"\x00" * 199 + b"a"
    family = suffixes.IndexFamily()
    for i, text in enumerate((a, b, b"a" + b"\x00" * 199, b)):
        found = family.add(np.ndarray(1, "S200", np.frombuffer(text, np.uint8), strides=(1,)), np.zeros(1), np.array([i]))
    assert sorted(found) == [1, 3]


@pytest.mark.parametrize("rows", [1, 3, 50])
def test_runs_over_many_batches(spark, monkeypatch, rows):
    monkeypatch.setattr(suffixes, "RUN_ROWS", rows)
    monkeypatch.setattr(suffixes, "ARRAY_BYTES", 300 * rows)
    monkeypatch.setattr(suffixes, "SAMPLED", 1)
    monkeypatch.setattr(suffixes, "HOT", 9)
    monkeypatch.setattr(suffixes, "CUT_BYTES", 2000)
    passage = prose(60, 90)
    texts = [(i, prose(1000 + i, 30) + passage[i % 3:] + prose(2000 + i // 2, 30), None, None, None) for i in range(40)]
    texts += [(100 + i, *r[1:]) for i, r in enumerate(random_texts(4)[:40])]
    compare(spark.createDataFrame(texts, SCHEMA).repartition(6), texts)


def test_empty_table(nothing):
    assert suffixes.removed(nothing).count() == 0
    assert suffixes.without_repeats(nothing).count() == 0


def test_characters_stay_whole(spark, clashing):
    left = suffixes.without_repeats(clashing)
    assert left.columns == clashing.columns
    texts = {r["doc_id"]: r for r in left.collect()}
    assert texts[0]["text"] == texts[1]["text"] == "" and texts[0]["n_chars"] == 0
    assert texts[4]["text"] is None and texts[5]["text"] == ""
    # the shared bytes begin behind the first byte of é and end behind the first byte of ü
    assert suffixes.whole_characters("aéb".encode(), [(2, 4)]) == [(3, 4)]
    assert suffixes.whole_characters("aéb".encode(), [(0, 2)]) == [(0, 1)]
    assert suffixes.whole_characters("é".encode(), [(1, 2)]) == []
    shared = "ß" * 120
    rows = [(1, "é" + shared + "ä", None, None, 1), (2, "ã" + shared + "å", None, None, 1)]
    got = {r["doc_id"]: r["text"] for r in suffixes.without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: "éä", 2: "ãå"}


def test_hot_heads_are_dealt_by_string(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SAMPLED", 1)
    monkeypatch.setattr(suffixes, "HOT", 6)
    monkeypatch.setattr(suffixes, "CUT_BYTES", 4000)
    passage = prose(60, 90)
    # neighbours of the passage that differ, and that are the same in part
    rows = [(i, prose(1000 + i, 30) + passage[i % 3:] + prose(2000 + i // 2, 30), None, None, None) for i in range(60)]
    rows += [(100 + i, *r[1:]) for i, r in enumerate(random_texts(3))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    compare(df, rows)
    texts = suffixes.with_ids(df)
    sorted_out = suffixes.judged(suffixes.suffixes(texts))
    most = lambda frame, key: max(r["count"] for r in frame.groupBy(key).count().collect())
    assert most(sorted_out.filter(sorted_out["kind"] == suffixes.OPEN), "head") > 20
    met = suffixes.to_compare(suffixes.packed(texts), sorted_out)
    assert most(met.filter(met["kind"] == suffixes.OPEN), "key") < 6 * 2
    assert most(met.filter(met["kind"] == suffixes.FRESH), "key") <= met.filter(met["kind"] == suffixes.FRESH).count() // 50
