import hashlib
import random
import re

import numpy as np
import pytest

from cadastria.llm import scatter

from .conftest import SCHEMA, edge_rows, prose


def plain_version(doc_id, text, rate=100, spm_rate=50, seed=7):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, len(lines), "plain", None, None, text, text
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    p, m, s = ("".join(lines[i:j]) for i, j in ((0, a), (a, b), (b, len(lines))))
    spm = h[3] % 100 < spm_rate
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(lines), "spm" if spm else "psm", len(p), len(m), out, text


def check(df, rows, **options):
    got = scatter.restored(scatter.transformed(df, **options)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "text")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((plain_version(r[0], r[1], **options) for r in rows), key=repr)


def line_rows():
    pick = random.Random(4)
    pieces = ["a\n", "\n", "é ü\n", "<", "<P", "P>", "S>", ">", "word ", "𝄞\n", "\r\n", "\x00", prose(1, 5)]
    rows = [(i, "".join(pick.choice(pieces) for _ in range(pick.randrange(12))), None, None, None) for i in range(400)]
    marked = ["x <P> y", "<M>", "a\n<S>\nb", "<<P>", "<P\n>", "< P>"]
    return rows + [(1000 + i, t, None, None, None) for i, t in enumerate(marked)] + [(2000, "line\n" * 200_000, None, None, None)]


def test_edge_rows(edges):
    check(edges, edge_rows())


def test_lines_marks_and_characters(spark):
    check(spark.createDataFrame(line_rows(), SCHEMA).repartition(5), line_rows())


@pytest.mark.parametrize("options", [{"rate": 40}, {"spm_rate": 0}, {"spm_rate": 100, "seed": 11}])
def test_rates(spark, options):
    check(spark.createDataFrame(line_rows()[:200], SCHEMA), line_rows()[:200], **options)


def test_clashing_names_and_empty_table(spark, clashing, nothing):
    df = clashing
    for name in ("n", "form", "output", "h1", "prefix_chars"):
        df = df.withColumn(name, df["n_chars"])
    check(df, edge_rows()[:12])
    assert scatter.restored(scatter.transformed(nothing)).collect() == []


def test_every_part_may_be_empty():
    data = np.frombuffer(b"ab\ncd\n", np.uint8)
    for a in range(3):
        for b in range(3):
            h = [np.array([x]) for x in (a, b, 0, 0)]
            for spm_rate, form in ((100, "spm"), (0, "psm")):
                cuts = scatter.Cuts(data, np.array([0, 6]), h, 100, spm_rate)
                out, offsets = scatter.scattered(data, np.array([0, 6]), cuts)
                back, _ = scatter.gathered(out, offsets, np.array([form]))
                assert bytes(back) == b"ab\ncd\n" and len(out) == 15


def test_missing_mark_is_an_error():
    data = np.frombuffer(b"<P>a<S>b", np.uint8)
    with pytest.raises(ValueError):
        scatter.gathered(data, np.array([0, 8]), np.array(["psm"]))
