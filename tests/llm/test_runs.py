import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorloom.llm import corpus_queries, runs


def plain(words):
    """Every run of a list, by comparing it with itself at all distances: ``start, end, period``."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        start = 0
        for i in range(len(words) - q + 1):
            if i == len(words) - q or words[i] != words[i + q]:
                if i - start >= q:
                    found.setdefault((start, i + q), q)
                start = i + 1
    return sorted((a, q, b) for (a, b), q in found.items())


def same(words):
    got = [(a, q, b) for a, b, q in runs.runs_of(np.array(words)).tolist()]
    assert got == plain(words)


def power(root, n, shift=0):
    return [root[(i + shift) % len(root)] for i in range(n)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120))
def test_random_words(words):
    same(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 300), st.lists(st.integers(0, 3), max_size=5))
def test_powers(root, n, tail):
    same([3] + power(root, n) + tail + power(root, n // 2))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=1, max_size=4), st.integers(1, 150), st.integers(1, 150), st.integers(0, 3), st.integers(0, 3), st.lists(st.integers(0, 2), max_size=2))
def test_touching_regions_of_one_period(root, n, m, left, right, between):
    one, two = power(root, n, left), power(root, m, right)
    same(one + between + two)
    same(one + two + one + between + two)


def test_nested_powers():
    words = [0, 1]
    for k in range(4):
        words = words * (k + 2) + words[: k + 1] + [k % 2]
    same(words[:900])


def test_fibonacci_and_thue_morse():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    same(b[:600])
    same([int(i).bit_count() & 1 for i in range(600)])


def test_colliding_hashes(monkeypatch):
    rng = np.random.default_rng(0)
    words = np.concatenate([np.tile(rng.integers(0, 9, 40), 4), rng.integers(0, 9, 300)])
    want = runs.runs_of(words).tolist()
    monkeypatch.setattr(runs, "PRIMES", (13, 13))
    got = runs.runs_of(words).tolist()
    for start, end, q in got:
        assert (words[start : end - q] == words[start + q : end]).all()
    assert {tuple(r) for r in got} >= {(0, 160, 40)} and {tuple(r) for r in want} >= {(0, 160, 40)}


def test_many_texts_as_one_array():
    rng = np.random.default_rng(5)
    texts = [np.array(power(rng.integers(0, 3, rng.integers(1, 30)).tolist(), int(rng.integers(0, 400)))) for _ in range(200)] + [np.empty(0, np.int64)]
    for one, many in zip(map(runs.runs_of, texts), runs.runs_of_many(texts)):
        assert one.tolist() == many.tolist()


def expected(i, text):
    """The registered query's row for one document, by its definition."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(i).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
    found = [(a, b - a, q) for a, q, b in plain(words) if b - a >= 12]
    lost = {k for a, n_, q in found for k in range(a + q, a + n_)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = min(((-n_, a, q) for a, n_, q in found), default=None)
    top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (i, len(found), *top, sha("".join(f"{a},{n_},{q}\n" for a, n_, q in found)), sha(" ".join(w for k, w in enumerate(words) if k not in lost)))


@pytest.fixture
def folder(spark, tmp_path):
    def make(rows):
        schema = "doc_id long, text string, h string, words string, n_runs int, runs string"
        spark.createDataFrame([(i, t, "h", "w", 1, "r") for i, t in rows], schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
        return str(tmp_path)

    return make


def test_query_equals_brute_force(spark, folder):
    rng = np.random.default_rng(7)
    texts = [None, "", " \t\n", "x", "a " * 30, "a b\tc\x0bd " * 9 + "é"]
    texts += [" ".join(f"w{x}" for x in rng.integers(0, 3 + k % 50, rng.integers(0, 150))) for k in range(400)]
    texts += [" ".join(["one two three four five six seven"] * k + ["end"] + ["same line again"] * k) for k in range(1, 12)]
    rows = list(enumerate(texts))
    got = corpus_queries.op11_periodic_runs(spark, folder(rows)).collect()
    assert sorted(tuple(r) for r in got) == [expected(i, t) for i, t in rows]


def test_operator_on_odd_tables(spark, folder):
    docs = spark.read.parquet(folder([(None, "a b " * 10), (None, None), (1, "x y z " * 20_000), (1, "x")]) + "/documents.parquet")
    got = {(r.doc_id, r.n_words): (tuple(map(tuple, r.runs)), r.collapsed) for r in runs.periodic_runs(docs).collect()}
    assert got == {(None, 20): (((0, 20, 2),), "a b"), (None, 0): ((), ""), (1, 60_000): (((0, 60_000, 3),), "x y z"), (1, 1): ((), "x")}
    assert runs.periodic_runs(docs.limit(0)).collect() == []
