"""Jaccard components against brute force, and planted near copies through the pipeline's stage."""

from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from sensorloom.llm import jaccard, simhash
from sensorloom.llm.common import located
from test_groups import forest_roots

RNG = np.random.default_rng(4)


def words(n):
    return ["".join(RNG.choice(list("abcdefghijklmnop"), 6)) for _ in range(n)]


def plain_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def likeness(a, b):
    a, b = plain_set(a), plain_set(b)
    return len(a & b) / len(a | b) if a | b else 0.0


def planted(shingles, changed):
    """Two texts of so many shingles each, of which so many differ."""
    one = words(shingles + 4)
    return " ".join(one), " ".join(one[: len(one) - changed] + words(changed))


# Shingles and changed ones, and the similarity they make.
BANDS = {(36, 4): 0.8, (38, 2): 0.9, (39, 1): 0.95, (36, 5): 31 / 41, (360, 40): 0.8, (361, 41): 320 / 402}


def test_planted_pairs(spark, documents):
    rows, band = [], {}
    for k in range(6):
        for shape, share in BANDS.items():
            one, two = planted(*shape)
            assert likeness(one, two) == pytest.approx(share)
            rows += [(len(rows), one), (len(rows) + 1, two)]
            band[len(rows) - 1] = share
    docs = documents(rows)
    before = {r.doc_id for r in simhash.near_dedup(docs).select("doc_id").collect()}
    assert any(share >= 0.8 and d in before for d, share in band.items())
    kept = corpus_pipeline.near(spark, docs, "")
    assert kept.columns == docs.columns
    got = {r.doc_id for r in kept.select("doc_id").collect()}
    assert {d for d, share in band.items() if share >= 0.8}.isdisjoint(got)
    # Pairs below the similarity go only if their fingerprints are near.
    assert got == {d for d, _ in rows if d in before and band.get(d, 0) < 0.8}


def test_components(spark, documents):
    """Small limits, so that shingles shared by many are met in several tiles and turns."""
    base, line = words(60), words(12)
    rows = [(i, " ".join(words(30))) for i in range(20)]
    for i in range(60):
        text = list(base)
        for at in RNG.choice(60, 1 + i % 4, replace=False):
            text[at] = words(1)[0]
        rows.append((100 + i, " ".join(text)))
    rows += [(200 + i, " ".join(words(9) + line)) for i in range(30)]
    rows += [(300, None), (301, ""), (302, "one two"), (303, "ONE two"), (None, " ".join(base)), (304, "one two three")]
    whole = located(documents(rows))
    groups = jaccard.near_groups(whole, whole.select("_file", "_row"), few=3, tile=8).collect()
    ids = [d if d is not None else -1 for d, _ in rows]
    text = {(-1 if d is None else d): t for d, t in rows}
    root = forest_roots(ids, lambda a, b: likeness(text[a], text[b]) >= 0.8)
    component = {(-1 if r.doc_id is None else r.doc_id): r.component for r in groups}
    assert len(groups) == len(rows)
    assert all((component[a] == component[b]) == (root[a] == root[b]) for a, b in combinations(ids, 2))
    assert 1 < len({root[d] for d in range(100, 160)}) < 60
