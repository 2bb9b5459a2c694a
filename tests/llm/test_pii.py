import random

import numpy as np
from pyspark.sql import functions as F

from cadastria.llm import pii

from . import brute
from .conftest import CARD, MAIL, SCHEMA, edge_rows


def spans_of(df):
    return pii.with_spans(df).select("doc_id", "text", pii.as_text(F.col("base")).alias("base"), pii.as_text(F.col("all")).alias("all")).collect()


def check(df):
    for r in spans_of(df):
        want = [f"{kind}:{a}:{b}" for a, _, b, kind in brute.base_spans(r["text"])]
        assert r["base"] == ",".join(want), r["text"]
        assert set(want) <= set(r["all"].split(",")) | {""}


def test_edge_rows(edges):
    check(edges)
    text = edge_rows()[19][1]
    found = next(r["all"] for r in spans_of(edges) if r["doc_id"] == 19)
    assert found.split(",")[0] == f"email:{text.index(MAIL)}:{text.index(MAIL) + len(MAIL)}"
    assert f"card:{text.index(CARD)}:{text.index(CARD) + len(CARD)}" in found and "ip:" in found and "phone:" in found


def test_random_texts(spark):
    pick = random.Random(3)
    parts = ["1", "23", CARD, ".", "256", "255", "a", "@", "x.co", "-", " ", "+", "(", ")", "é", "😀", "+49 30 123456",
             "a@b.cd_e@f.gh", "0.0.0.0", "1.2.3.4.5.6.7.8", "_", "%", "000255", "\n"]
    rows = [(i, "".join(pick.choice(parts) for _ in range(pick.randrange(25)))) for i in range(1500)]
    rows.append((-1, " ".join(f"u{i}@ex.com" for i in range(2000))))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_running_sums(spark):
    rows = [([],), ([5],), (list(range(1, 600)),), ([0] * 256,), (list(range(257)),)]
    got = spark.createDataFrame(rows, "x array<long>").select("x", pii.running(F.col("x")).alias("s")).collect()
    for r in got:
        assert r["s"] == np.cumsum(r["x"], dtype=int).tolist()


def test_credentials_are_found_by_the_classifier(spark):
    pick = random.Random(9)
    rows = []
    for i in range(200):
        code = "".join(pick.choice("0123456789") + pick.choice("abcdef") for _ in range(20))  # no digits in a row
        long_word = "".join(pick.choice("abcdefgh") for _ in range(30))
        rows.append((i, f"stones and token = \"{code}\" under water" if i % 2 else f"stones {long_word} under water"))
    for r in spans_of(spark.createDataFrame(rows, "doc_id long, text string")):
        want = "secret:20:60" if r["doc_id"] % 2 else ""
        assert r["all"] == want and r["base"] == ""


def test_reliabilities_recover_good_and_bad_labelers():
    random_ = np.random.default_rng(4)
    truth = random_.random(20_000) < 0.4
    right = [0.95, 0.9, 0.6, 0.85, 0.55]
    votes = np.stack([np.where(random_.random(len(truth)) < p, truth, ~truth).astype(int) for p in right], axis=1)
    votes[random_.random(votes.shape) < 0.3] = -1
    rows, where, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    seen = pii.Patterns(np.full(len(rows), 4), rows, counts.astype(float))
    p, found = pii.reliabilities(seen)
    assert np.abs(found[4].mean(axis=0) - np.array(right)).max() < 0.06
    weights = pii.span_classifier(seen, p)
    decided = (pii.features(seen.kinds, rows) @ weights > 0)[where.ravel()]
    assert (decided == truth).mean() > 0.9


def test_hidden_in_documents(clashing, edges, nothing):
    left = pii.redacted_docs(clashing)
    assert left.columns == clashing.columns and sorted(map(repr, left.collect())) == sorted(map(repr, clashing.collect()))
    changed = {r["doc_id"]: r for r in pii.redacted_docs(edges).collect()}
    assert changed[19]["text"] == "Write to <email> or call <phone>, card <card>, host <ip> and 1.2.3.256."
    assert changed[19]["n_chars"] == len(changed[19]["text"]) and changed[4]["text"] is None
    assert pii.redacted_docs(nothing).count() == 0


def test_overlapping_spans_are_hidden_once(spark):
    # the digits of the phone number are a card number too
    rows = [(1, "+4539 1488 0343 646 and x", None, None, 1), (2, "", None, None, 0)]
    got = pii.redacted_docs(spark.createDataFrame(rows, SCHEMA)).filter("doc_id = 1").first()["text"]
    assert got == "<phone> and x"


def test_native(edges):
    plan = pii.with_candidates(edges)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


PROBES = {
    'the password = "hu$ter2!" is old': ("password", "hu$ter2!"),
    "password: hunter2abc and more": ("password", "hunter2abc"),
    "IBAN DE89 3704 0044 0532 0130 00 please": ("account", "DE89 3704 0044 0532 0130 00"),
    "pay to GB82WEST12345698765432 today": ("account", "GB82WEST12345698765432"),
    "call 030 1234567 after noon": ("local_phone", "030 1234567"),
    "Tel: 0711/4567890.": ("local_phone", "0711/4567890"),
    "see org/path/to/some-very-long-article-title-2024 there": None,
    "DE89 3704 0044 0532 0130 01 is no account": None,
    "password = changeme": None,
    "the password: required": None,
    "between 05-12-2024 and 06-12-2024": None,
    "item 0042 12345 of 99": None,
}


def test_kinds_that_only_votes_settle(spark):
    """Each probe among plain texts, as one of many and as the only one."""
    texts = list(PROBES)
    rows = [(i, t) for i, t in enumerate(texts * 3)] + [(1000 + i, "stones under water 12 345 on 2024-05-01") for i in range(50)]
    found = {r["text"]: r["all"] for r in spans_of(spark.createDataFrame(rows, "doc_id long, text string"))}
    for text, want in PROBES.items():
        at = text.index(want[1]) if want else 0
        assert found[text] == (f"{want[0]}:{at}:{at + len(want[1])}" if want else ""), text
    assert found["stones under water 12 345 on 2024-05-01"] == ""


def test_account_numbers_check(spark):
    rows = [("DE89370400440532013000", True), ("GB82WEST12345698765432", True), ("FR1420041010050500013M02606", True),
            ("DE89370400440532013001", False), ("NL91ABNA0417164300", True), ("NL19ABNA0417164300", False)]
    got = spark.createDataFrame(rows, "v string, ok boolean").select("ok", pii.ninety_seven(F.col("v")).alias("got")).collect()
    assert all(r.ok == r.got for r in got)


def test_rows_and_repeats_keep_their_columns(spark, clashing):
    df = spark.createDataFrame([(1, "write to a@b.cd"), (1, "write to a@b.cd"), (None, None), (2, "")], "doc_id long, text string")
    got = pii.with_spans(df)
    assert got.columns == ["doc_id", "text", "candidates", "base", "all"] and got.count() == 4
    assert sorted(len(r.base) for r in got.collect()) == [0, 0, 1, 1]
    assert pii.with_spans(clashing).columns == [*clashing.columns] and pii.with_spans(clashing).count() == clashing.count()


def test_clean_documents_are_left_alone(spark):
    """Of the given documents without a base span, nearly all have no other one."""
    import os
    path = "/root/testdata/sf0.1/documents.parquet"
    if not os.path.exists(path):
        return
    rows = spans_of(spark.read.parquet(path).select("doc_id", "text"))
    kinds = [{s.split(":")[0] for s in r["all"].split(",") if s} for r in rows]
    assert sum(bool(k & {"password", "account", "local_phone"}) for k in kinds) <= 0.001 * len(rows)
    hexes = [r for r in rows if "secret" in r["all"]]
    assert hexes and all('token = "' in r["text"].lower() for r in hexes)


def test_texts_without_candidates_are_not_shuffled(spark, edges, monkeypatch):
    """They pass beside the join; what shares a slot with a text that has candidates meets it, and nothing changes."""
    order = lambda df: sorted(map(tuple, df.collect()), key=repr)
    found = pii.with_spans(edges)
    plan = found._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    rest, some = (plan.children().apply(i).toString() for i in (0, 1))
    assert "__own" not in rest and "__own" in some
    assert "SortMergeJoin" not in rest and rest.count("Join") == 1 and "strategy=broadcast" in rest
    got, hidden = order(found), order(pii.redacted_docs(edges))
    monkeypatch.setattr(pii, "SLOTS", 1)
    assert order(pii.with_spans(edges)) == got and order(pii.redacted_docs(edges)) == hidden
