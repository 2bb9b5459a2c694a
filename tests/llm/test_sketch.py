import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from cadastria.llm import sketch

from .conftest import SCHEMA, edge_rows, prose


def lists(seed: int, n: int, at_most: int) -> list[np.ndarray]:
    random_ = np.random.default_rng(seed)
    return [random_.integers(0, 1 << 63, random_.integers(0, at_most), dtype=np.uint64) for _ in range(n)]


def test_differences_are_recovered_at_any_size():
    random_ = np.random.default_rng(1)
    a, b = [], []
    for x, y, shared in zip(lists(2, 60, 40), lists(3, 60, 300), lists(4, 60, 2000)):
        a.append(random_.permutation(np.concatenate([x, shared])))
        b.append(random_.permutation(np.concatenate([y, shared])))
    for x, y, (only_x, only_y) in zip(a, b, sketch.differing(a, b)):
        assert set(only_x.tolist()) == set(x.tolist()) - set(y.tolist())
        assert set(only_y.tolist()) == set(y.tolist()) - set(x.tolist())


def test_too_small_tables_are_seen():
    keys = lists(5, 1, 400)[0]
    table = sketch.Sketches.of([keys], [sketch.CELLS // sketch.PARTS])
    assert len(keys) > 100 and table.recovered() == [None]


def test_tables_have_a_cell_for_every_digest():
    n = np.array([0, 1, 12, 13, 24, 25, 1000, 12 << 20])
    cells = sketch.part_cells(n) * sketch.PARTS
    assert cells.tolist() == [12, 12, 12, 24, 24, 48, 1536, 12 << 20]


def test_folded_tables_are_the_small_tables():
    keys = lists(6, 30, 500)
    small = np.full(30, 8)
    large = small << np.arange(30) % 5
    folded = sketch.Sketches.of(keys, large).folded(np.arange(30)[::-1], small)
    assert folded.texts([0] * 30) == sketch.Sketches.of(keys[::-1], small).texts([0] * 30)


def test_fingerprints_are_read_back():
    keys = [*lists(7, 40, 300), np.zeros(0, np.uint64)]
    texts = sketch.fingerprints(keys).texts([len(x) for x in keys])
    tables, counts = sketch.Sketches.read(texts)
    assert tables.texts(counts) == texts and counts == [len(x) for x in keys]


def test_stored_fingerprints_of_versions_tell_what_changed(spark):
    """Two versions of 60 to 400 sentences: fingerprints alone give the digests, or nothing if too much differs."""
    pick = random.Random(9)
    rows, want = [], []
    for i in range(40):
        old = [f"Sentence {i} {k} {pick.random()}." for k in range(pick.randrange(60, 400))]
        new = list(old)
        for k in pick.sample(range(len(old)), pick.choice([0, 1, 12, 25])):
            new[k] = f"Changed {pick.random()}."
        if i % 5 == 4:
            new = [f"All new {pick.random()}." for _ in range(2 * len(old))]
        a, b = (sketch.digests(" ".join(x)) for x in (old, new))
        rows.append((i, *sketch.fingerprints([a, b]).texts([len(a), len(b)])))
        want.append((set(a.tolist()) - set(b.tolist()), set(b.tolist()) - set(a.tolist()), ratio(set(a.tolist()), set(b.tolist()))))
    rows += [(40, None, rows[0][1]), (41, None, None)]
    got = (spark.createDataFrame(rows, "i int, a string, b string").repartition(3)
           .select("i", sketch.stored_difference("a", "b").alias("d")).orderBy("i").collect())
    for row, (first, second, like) in zip(got, want):
        if row["i"] % 5 == 4:
            assert row["d"]["first"] is row["d"]["likeness"] is None
        else:
            assert [{k % 2 ** 64 for k in row["d"][side]} for side in ("first", "second")] == [first, second]
            assert row["d"]["likeness"] == like
    assert [r["d"]["likeness"] for r in got[40:]] == [None, None]


def test_columns_of_the_same_name_do_no_harm(spark):
    rows = [(i, prose(i, 5), "x", 1, 2.0, 3) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, part int, near_next double, __part int")
    plain = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    assert sorted(sketch.edited_and_next(df).collect()) == sorted(sketch.edited_and_next(plain).collect())


def test_likeness():
    a, b = sketch.digests("One. Two.\nThree"), sketch.digests("One. Two.\nFour\nFive")
    assert sketch.likeness([a, a, a[:0], a[:0]], [b, a, a[:0], a]) == [2 / 5, 1.0, 1.0, 0.0]
    # repeats count
    assert sketch.likeness([sketch.digests("A.\nA.\nA.")], [sketch.digests("A.")]) == [1 / 3]


def key(r):
    return (r[0] is None, -(r[0] or 0), r[1] or "")


def test_edited_and_next(edges):
    rows = sorted(edge_rows(), key=key)
    want = []
    for (doc_id, text, *_), (_, after, *_) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        x, y, z = map(set_of, (text, edited, after))
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), ratio(x, y), ratio(x, z)))
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in sketch.edited_and_next(edges).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def set_of(text):
    return set(sketch.digests(text).tolist())


def ratio(x, y):
    return len(x & y) / len(x | y) if x | y else 1.0


def test_equal_texts_have_equal_fingerprints(edges):
    rows = sketch.edited_and_next(edges).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert by_id[0] == by_id[1] and len(by_id[0]) == 1 and by_id[4] == by_id[5]
    assert by_id[0] != by_id[2]


def test_single_row_and_empty_table(spark, nothing):
    one = sketch.edited_and_next(spark.createDataFrame([(7, "abcdef", None, None, None)], SCHEMA)).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and one["near_next"] == 1.0
    assert sketch.edited_and_next(nothing).count() == 0


def test_many_partitions(spark):
    pick = random.Random(2)
    rows = [(i, prose(i, pick.randrange(1, 30)), None, None, None) for i in pick.sample(range(10 ** 9), 300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    ordered = sorted(rows, key=key)
    want = {a[0]: hashlib.sha256((a[1][:len(a[1]) - len(a[1]) // 2] + b[1][:len(a[1]) // 2]).encode()).hexdigest()
            for a, b in zip(ordered, ordered[1:] + ordered[:1])}
    assert {r["doc_id"]: r["edited_sha256"] for r in sketch.edited_and_next(df).collect()} == want


def test_no_two_stretches_share_a_partition(spark):
    """As many stretches as partitions, of about equal length: hashed, some partitions would get several and others none."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = spark.range(1000 * parts).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    dealt = sketch.beside_next(docs).groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("__part").alias("k"), F.count("*").alias("n"))
    got = {r["p"]: (r["k"], r["n"]) for r in dealt.collect()}
    assert len(got) == parts and {k for k, _ in got.values()} == {1}
    assert max(n for _, n in got.values()) < 2000


def test_documents_are_beside_the_next_across_slices(spark):
    """A stretch has more text than is compared at once, so the next document often is in another slice."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = [f"{i}. " * 20000 + f"\nEnd {i}." for i in range(30 * parts)]
    assert sum(map(len, texts)) > 2 * parts * sketch.COMPARED_BYTES
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = {i: hashlib.sha256(sketch.edit(t, texts[i - 1]).encode()).hexdigest() for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["edited_sha256"] for r in sketch.edited_and_next(df).select("doc_id", "edited_sha256").collect()} == want
