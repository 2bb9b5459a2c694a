import hashlib
import random
import zlib

import numpy as np
import pytest

from cadastria.llm import prefixtrie
from cadastria.llm.prefixtrie import ITEM

SCHEMA = "conv_id long, turn long, role string, text string"


def digest_of(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def plain_version(rows, stride=100, most=5):
    """Nodes by dictionaries of prefixes."""
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            own.setdefault(conv_id, []).append((turn is not None, turn, digest_of(role, text) + len(text).to_bytes(4, "big"), role, text))
    own = {c: [(r, t) for *_, r, t in sorted(turns, key=lambda x: (x[0], x[1] or 0, x[2]))] for c, turns in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % (most + 1)
        whole[c] = tuple(own.get(c - c % stride, [])[:h] + own[c][h:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
    return sorted((min(cs), len(p), min(members[p[:-1]]) if p else -1, len(cs), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in cs if len(whole[c]) == len(p)))).encode()).hexdigest())
                  for p, cs in members.items())


def result(df, **options):
    rows = prefixtrie.nodes(prefixtrie.rebuilt(df, **options)).collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in rows)


def talk_rows(seed, n, texts=3, longest=9):
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(pick.randrange(1, longest)):
            rows.append((c * pick.choice([1, 1, 3]), turn, pick.choice(["user", "assistant"]), "x" * pick.randrange(texts)))
    return rows


EDGES = [(None, 0, "user", "left out"), (5, None, "user", "first"), (5, 0, None, None), (5, 0, None, None), (5, 0, "user", ""), (6, 0, "us", "er"),
         (6, 1, "use", "r"), (7, 0, "user", "é𝄞" * 40_000), (8, 0, "user", ""), (103, 2, "user", "a"), (103, 1, "user", "b"), (-7, 0, "user", "n"),
         (205, 0, "user", "p"), (200, 0, "user", "q"), (200, 1, "user", "r"), (10 ** 12, 0, "user", "z")]


@pytest.mark.parametrize("rows", [EDGES, talk_rows(1, 400), talk_rows(2, 150, 2, 4), talk_rows(3, 60, 2, 40)], ids=["edges", "many", "short", "long"])
def test_equals_dictionaries(spark, rows):
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(3)) == plain_version(rows)


@pytest.mark.parametrize("chunk", [1, 2, 7])
def test_nodes_over_many_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(prefixtrie, "CHUNK_ROWS", chunk)
    rows = talk_rows(4, 250, 2, 6)
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(3)) == plain_version(rows)
    assert result(spark.createDataFrame(rows, SCHEMA), most=0) == plain_version(rows, most=0)


def test_copies_and_hot_first_turn(spark):
    same = [(c, t, "user", f"t{t}") for c in range(0, 900, 3) for t in range(6)]
    rows = same + [(c, t, "user", "t0" if t == 0 else f"{c}") for c in range(1, 900, 3) for t in range(3)]
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(5), most=0) == plain_version(rows, most=0)


def test_empty_table_and_clashing_names(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
    rows = talk_rows(5, 40)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("key", "block", "item", "ids", "n", "node", "depth"):
        df = df.withColumn(name, df["turn"])
    assert result(df) == plain_version(rows)


def test_turnless_conversation_ends_at_the_root(spark):
    # the first turns come from a conversation that isn't there, and there are no others
    c = next(c for c in range(101, 199) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(c, 0, "user", "only")]
    assert result(spark.createDataFrame(rows, SCHEMA)) == plain_version(rows) == [
        (c, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_range_minimum():
    values = np.random.default_rng(1).integers(0, 9, 37)
    low, high = np.array([(a, b) for a in range(37) for b in range(a, 37)]).T
    assert prefixtrie.RangeMinimum(values)(low, high).tolist() == [values[a:b + 1].min() for a, b in zip(low, high)]


def test_shared_depth():
    a, b, c = (bytes([x]) * ITEM for x in (1, 2, 3))
    assert [prefixtrie.shared_depth(*p) for p in ((b"", a), (a + b, a + c), (a, a + b), (a + b, a + b), (a, b))] == [0, 1, 1, 2, 0]
