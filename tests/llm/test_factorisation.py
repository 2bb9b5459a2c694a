import itertools
import zlib

import numpy as np
import pyarrow as pa

from cadastria.llm import factorisation as fm

from .conftest import SCHEMA, edge_rows, prose


def test_pairwise_sum_by_squares():
    random_ = np.random.default_rng(1)
    machine = fm.Machine(0.3, random_.normal(size=fm.FEATURES), random_.normal(size=(fm.FEATURES, 4)))
    x = fm.vectors(pa.array(["one two two three", "", "a!\n#b"]))
    for row, margin in enumerate(machine.margins(x)):
        at = slice(x.first[row], x.first[row + 1])
        entries = list(zip(x.index[at].tolist(), x.value[at].tolist()))
        want = 0.3 + sum(machine.weights[i] * v for i, v in entries) + sum(
            machine.factors[i] @ machine.factors[j] * v * w for (i, v), (j, w) in itertools.combinations(entries, 2))
        assert abs(want - margin) < 1e-9


def test_vectors_don_t_depend_on_the_batch():
    texts = [r[1] or "" for r in edge_rows()]
    together = fm.vectors(pa.array(texts))
    for i, text in enumerate(texts):
        alone, at = fm.vectors(pa.array([text])), slice(together.first[i], together.first[i + 1])
        assert sorted(zip(alone.index, alone.value)) == sorted(zip(together.index[at], together.value[at]))


def test_learns_what_only_pairs_tell():
    # either word alone says nothing
    texts = [f"{a} {b}" for a in ("left", "right") for b in ("up", "down")] * 100
    labels = np.array([float((t.split()[0] == "left") == (t.split()[1] == "up")) for t in texts])
    scores = fm.learned(fm.vectors(pa.array(texts)), labels, epochs=40).scores(fm.vectors(pa.array(texts)))
    assert ((scores > 0.5) == (labels == 1)).all()


def test_held_out_rows_are_told_apart(spark):
    junk = lambda i: " ".join(w.upper() + "!!" for w in prose(i, 40).split())
    rows = [(i, prose(i, 40) if i % 3 else junk(i), "xx", None, 1) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)] + [(5, None), (None, 1)], "doc_id long, quality int")
    got = fm.scored(docs, fm.trained(docs, labels)).collect()
    assert len(got) == 400
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["doc_id"] % 3 > 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_held_out_labels_change_nothing(spark):
    rows = [(i, prose(i, 20), None, None, 1) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    def model(flip):
        labels = [(i, (i % 2) ^ (flip and zlib.crc32(str(i).encode()) % 5 == 0)) for i in range(60)]
        return fm.trained(docs, spark.createDataFrame([(i, int(q)) for i, q in labels], "doc_id long, quality int"))
    a, b = model(False), model(True)
    assert (a.weights == b.weights).all() and a.bias == b.bias


def test_edge_rows_without_labels(edges, nothing, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = fm.scored(edges, fm.trained(edges, none)).collect()
    assert len(got) == len(edge_rows()) and all(abs(r["score"] - 0.5) < 0.05 for r in got)
    assert fm.scored(nothing, fm.trained(nothing, none)).count() == 0
