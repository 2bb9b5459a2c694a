import hypothesis
import hypothesis.strategies as st
from pyspark.sql import functions as F

from cadastria.llm import rules

from . import brute
from .conftest import edge_rows


def test_counts_and_base_verdict(edges):
    names = list(brute.rule_counts(""))
    got = sorted(map(repr, edges.transform(rules.with_verdict).select("doc_id", *names).collect()))
    want = edges.sparkSession.createDataFrame(
        [(r[0], *brute.rule_counts(r[1]).values()) for r in edge_rows()],
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean")
    assert got == sorted(map(repr, want.collect()))


def test_windows_against_brute_force(spark):
    texts: list[str] = []

    @hypothesis.settings(max_examples=300, database=None)
    @hypothesis.given(st.lists(st.sampled_from(["a", "b", "a", "é", "#x", "\n", " ", " ", "\x0b"]), max_size=40))
    def gather(parts):
        texts.append(" ".join(parts))

    gather()
    rows = rules.with_counts(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    for r in rows:
        want = brute.rule_counts(r["text"])
        assert {k: r[k] for k in want if k != "base_failed"} == {k: v for k, v in want.items() if k != "base_failed"}, r["text"]


def test_bounds_are_inclusive(spark):
    def kept(text: str, rule: rules.Rule) -> bool:
        return rules.with_verdict(spark.createDataFrame([(text,)], "text string"), [rule]).first()["kept"]

    text = " ".join(f"w{i:02d}" for i in range(98)) + " #aa #bb"  # 100 words, 2 symbols
    assert kept(text, rules.Rule("n_symbols", "n_words", most=2))
    assert not kept(text, rules.Rule("n_symbols", "n_words", most=1))
    assert kept(text, rules.Rule("n_symbols", "n_words", least=2))
    assert not kept(text, rules.Rule("n_symbols", "n_words", least=3))


def test_rejected_go_and_columns_stay(clashing, nothing):
    left = rules.rejected_removed(clashing)
    assert left.columns == clashing.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 1, 2, 3, 11]
    assert rules.rejected_removed(nothing).count() == 0
    assert [r["kept"] for r in rules.with_verdict(clashing).filter(F.col("doc_id") == 4).collect()] == [False]


def test_no_python_and_no_shuffle(edges):
    plan = rules.with_verdict(edges)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.split("InMemoryTableScan")[0]
