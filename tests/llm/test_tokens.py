import zlib
from collections import defaultdict

import hypothesis
import hypothesis.strategies as st
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cadastria.llm import packing, pieces

from .conftest import edge_rows

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = st.lists(st.sampled_from(["a", " ", "  ", "▁", "the", "ing", "é", "\n", "\x00", "　", "👍", "<|endoftext|>", "0", "'s", "<s>"]), max_size=25).map("".join)


@hypothesis.settings(max_examples=300, database=None, deadline=None)
@hypothesis.given(st.one_of(TEXTS, st.text(max_size=30)))
def test_same_ids_as_the_libraries(text):
    ours = packing.encode(packing.encoding(BYTE_BPE), text).tolist()
    assert ours == library().encode(text, add_special_tokens=False).ids + [1]
    sp = pieces.processor(PIECES)
    got = pieces.ChunkTable(PIECES).encode([text])[0]
    assert np.frombuffer(got, "<u4").tolist() == sp.encode(text, add_bos=True, add_eos=True)


def library(cache=[]):  # noqa: B006
    if not cache:
        cache.append(Tokenizer.from_file(BYTE_BPE))
    return cache[0]


def test_pieces_round_trip(edges):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = []
    for r in edge_rows():
        ids = sp.encode(r[1] or "", add_bos=True, add_eos=True)
        want.append((r[0], np.array(ids, "<u4").tobytes(), sp.decode(ids)))
    got = [(r["doc_id"], bytes(r["ids"]), r["text"]) for r in pieces.round_trip(edges, PIECES).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_chunk_table_starts_anew(monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_ENTRIES", 3)
    table, sp = pieces.ChunkTable(PIECES), pieces.processor(PIECES)
    for text in ("one two three four", "five six seven", "one " + "x" * 100, ""):
        assert np.frombuffer(table.encode([text])[0], "<u4").tolist() == sp.encode(text, add_bos=True, add_eos=True)
    assert "x" * 100 not in table.ids


def test_models_that_cross_markers_are_refused(monkeypatch):
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "id_to_piece", lambda self, i: "a▁b")
    with pytest.raises(ValueError):
        pieces.processor.__wrapped__(PIECES)


def test_packing_keeps_every_id_once(edges):
    rows = [r.asDict() for r in packing.packed(edges, BYTE_BPE, 64).collect()]
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for members in by_sequence.values():
        members.sort(key=lambda r: r["offset"])
        ends = [r["offset"] + r["length"] for r in members]
        assert [r["offset"] for r in members] == [0, *ends[:-1]] and ends[-1] <= 64
    for doc_id, text, *_ in edge_rows():
        ids = np.array(library().encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        copies = sum(r[0] == doc_id for r in edge_rows())
        if doc_id is None or copies > 1:
            continue
        own = sorted(by_doc[doc_id], key=lambda r: r["start"])
        assert [r["start"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1].tolist()]
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in own)
        assert sum(r["length"] for r in own) == len(ids) == own[0]["doc_tokens"]
    assert len(by_doc[4]) == 2 and all(r["length"] == 1 for r in by_doc[4])


def test_plan_places_every_length():
    histogram = {64: 3, 40: 10, 30: 4, 24: 11, 10: 7, 1: 25}
    patterns = packing.plan(histogram, 64)
    placed = defaultdict(int)
    for sizes, count in patterns:
        assert sum(sizes) <= 64 and count > 0
        for size in sizes:
            placed[size] += count
    assert placed == histogram
    slots = packing.Slots(patterns, 64)
    seen = set()
    for size, n in histogram.items():
        sequence, offset = slots.find(size, np.arange(n))
        seen |= {(s, o + d) for s, o in zip(sequence.tolist(), offset.tolist()) for d in range(size)}
    assert len(seen) == sum(k * n for k, n in histogram.items())


def test_empty_table(nothing):
    assert packing.packed(nothing, BYTE_BPE).count() == 0
    assert pieces.round_trip(nothing, PIECES).count() == 0
