"""Tokens, token files and packing against the plain library and brute force."""

import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sensorloom.llm import packing, token_file
from sensorloom.llm.tokens import Encoder, default_vocabulary
from sensorloom.session import new_path

PLAIN = Tokenizer.from_file(default_vocabulary())
FAST = Encoder(default_vocabulary(), entries=50)
ROWS = [(5, "a b. c, d"), (3, None), (3, ""), (3, ""), (9, "x\n\ny  z"), (None, "no id here"), (1, "the word " * 3000), (12, "a <|endoftext|>b"), (7, "\tt\n")]


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab.,'sé1 \n\t 　\x1c\x85²-", "<|endoftext|>"]), max_size=40).map("".join))
def test_encoder_matches_library(text):
    assert np.frombuffer(FAST.text(text), "<u4").tolist() == ids_of(text)[:-1]


class Counted:
    """A tokenizer that counts what is asked of it."""

    def __init__(self, inner):
        self.inner, self.calls = inner, 0

    def __getattr__(self, name):
        self.calls += 1
        return getattr(self.inner, name)


def test_new_pieces_of_a_text_are_encoded_in_one_go():
    fast = Encoder(default_vocabulary())
    fast.tokenizer = Counted(fast.tokenizer)
    text = "start " + " ".join(f"w{i}x w{i}x, word{chr(97 + i % 26)};\nq{i}'s {i}. é{i}²" for i in range(50)) * 3
    assert np.frombuffer(fast.text(text), "<u4").tolist() == ids_of(text)[:-1]
    assert fast.tokenizer.calls <= 2
    assert np.frombuffer(fast.text(text), "<u4").tolist() == ids_of(text)[:-1] and fast.tokenizer.calls <= 3


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=300))
def test_elias_fano(values):
    values.sort()
    ef = token_file.EliasFano.encode(values)
    assert ef.values().tolist() == values
    assert [ef.select(i) for i in range(len(values))] == values


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], []])
def test_token_file(spark, documents, rows):
    path = new_path(spark, "tokens")
    token_file.write_token_file(documents(rows), path)
    got = token_file.read_token_file(spark, path).orderBy("start").collect()
    at = 0
    assert len(got) == len(rows)
    for r, (doc_id, text) in zip(got, in_order(rows)):
        ids = ids_of(text)
        assert (r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (doc_id, at, len(ids), ids)
        at += len(ids)


def test_best_fill_is_closest():
    rng = np.random.default_rng(3)
    for _ in range(60):
        items = rng.integers(1, 30, rng.integers(1, 10)).tolist()
        room = int(rng.integers(1, 60))
        sums = {0}
        for x in items:
            sums |= {s + x for s in sums}
        used = packing.best_fill(dict(Counter(items)), room)
        assert sum(w * n for w, n in used.items()) == max(s for s in sums if s <= room)
        assert all(n <= Counter(items)[w] for w, n in used.items())


@pytest.mark.parametrize("counts", [{700: 50}, {1: 3}, {3: 1000, 512: 7, 1023: 9}, {i: i % 7 for i in range(1, 1024)}, {}])
def test_plan_places_every_id_once(counts):
    spans, ids = {}, Counter()
    for of, a, b, cut, length, sequence, per, at, shift in packing.plan(dict(counts)):
        for r in range(a, b):
            t = r - a + shift
            spans.setdefault(sequence + t // per, []).append((at + t % per * length, length))
            ids.update((of, r, cut + k) for k in range(length))
    assert ids == Counter((w, r, k) for w, n in counts.items() for r in range(n) for k in range(w))
    sizes = []
    for parts in spans.values():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        sizes.append(at)
    assert sum(s != 1024 for s in sizes) <= 1


@pytest.mark.parametrize("rows", [ROWS, []])
def test_pack(documents, rows):
    docs = documents([r for r in rows])
    pieces = packing.encode_pieces(docs, capacity=16)
    placed = packing.layout(pieces, capacity=16)
    got = packing.checksums(placed, pieces).collect()
    every = sorted(b"".join(np.array(ids_of(t), "<u4").tobytes() for _, t in rows[i : i + 1]) for i in range(len(rows)))
    packed = packing.sequences(placed, pieces).collect()
    assert sum(r.length for r in got) == sum(len(x) // 4 for x in every) == sum(r.n_tokens for r in packed)
    assert sum(r.n_tokens != 16 for r in packed) <= 1
    known = {}
    for d, t in rows:
        known.setdefault(d, []).append(np.array(ids_of(t), "<u4"))
    for r in got:
        assert any(zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and len(x) == r.doc_tokens for x in known[r.doc_id])
    by_sequence = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packed}
    for r in got:
        assert zlib.crc32(by_sequence[r.sequence_id][r.offset : r.offset + r.length].tobytes()) == r.ids_crc32


def test_groups_of_texts(monkeypatch):
    """New pieces of many texts are encoded in at most two goes, and odd texts of a group don't change the others."""
    from sensorloom.llm import tokens

    odd = ["a  b", "\tx", "x　y", "ʼn ɐb", "don't go", "été, Zoë.", "12 a1", "é ́", "\r\n", "a\n\nb", "<|endoftext|> x", None, ""]
    fresh = Encoder(default_vocabulary(), entries=50)
    want = [FAST.whole(t or "") for t in odd]
    assert list(fresh.texts(odd)) == want and [fresh.text(t) for t in odd] == want and not list(fresh.texts([]))
    monkeypatch.setattr(tokens, "GROUP", 30)
    assert list(fresh.texts(odd * 5)) == want * 5
    monkeypatch.undo()
    calls = []
    split = fresh._split
    monkeypatch.setattr(fresh, "_split", lambda tokenizer, pieces: (calls.append(len(pieces)), split(tokenizer, pieces)))
    texts = [f"word{i}, other{i} letters{'abcdefghij'[i % 10]}\nend" for i in range(200)]
    assert list(fresh.texts(texts)) == [FAST.whole(t) for t in texts] and len(calls) <= 2


def test_pieces_at_hand_take_few_bytes():
    fresh = Encoder(default_vocabulary())
    text = " ".join(f"piece{i}" for i in range(50_000))
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    assert fresh.text(text) == fresh.whole(text)
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert held < 100 * 50_000


def test_pieces_met_last_stay(monkeypatch):
    fresh = Encoder(default_vocabulary(), entries=300)
    asked, learn = [], fresh._learn
    monkeypatch.setattr(fresh, "_learn", lambda pieces: asked.extend(pieces) or learn(pieces))
    often = "x " + " ".join(f"o{i}" for i in range(200))
    for k in range(20):
        text = f"{often} " + " ".join(f"s{k}x{i}," for i in range(100))
        assert fresh.text(text) == fresh.whole(text)
    assert sum(p.startswith("o") for p in asked) == 200 and len(fresh.names) == len(fresh.ids) == 300
