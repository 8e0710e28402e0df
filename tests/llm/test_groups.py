"""Exact and near duplicates, mixing and fingerprints against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sensorloom.llm import exact_dedup, mixing, simhash, weighted
from sensorloom.llm.common import components
from sensorloom.session import new_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = re.compile(r"[\x20\x09-\x0D]")
ROWS = [(1, "a b c"), (2, "a  bc\n"), (3, None), (4, ""), (5, " \t"), (6, "é x"), (6, "é x"), (None, "abc"), (8, "Abc"), (9, "w " * 5000), (10, " ")]


@pytest.mark.parametrize("rows", [ROWS, []])
def test_exact_groups(documents, rows):
    got = exact_dedup.exact_groups(documents(rows)).collect()
    groups = {}
    for d, t in rows:
        groups.setdefault(BLANK.sub("", t or ""), []).append((-len(t or ""), d is None, d or 0))
    want = Counter()
    for d, t in rows:
        key = BLANK.sub("", t or "")
        best = min(groups[key])
        want[d, None if best[1] else best[2], len(groups[key]), hashlib.sha256(key.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) <= {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_keeps_columns(documents):
    docs = documents(ROWS)
    out = exact_dedup.exact_dedup(docs)
    assert out.columns == docs.columns and out.count() == len({BLANK.sub("", t or "") for _, t in ROWS})


def test_false_hits_are_split(documents, monkeypatch):
    monkeypatch.setattr(F, "sha2", lambda c, n: F.lit("00" * 32))
    got = exact_dedup.exact_groups(documents(ROWS)).collect()
    sizes = Counter(BLANK.sub("", t or "") for _, t in ROWS)
    assert Counter(r.group_size for r in got) == Counter(sizes[BLANK.sub("", t or "")] for _, t in ROWS)


def test_state_goes_on_over_runs(spark, tmp_path, documents):
    log, checkpoint = str(tmp_path / "log"), new_path(spark, "state")
    place = exact_dedup.located(documents(ROWS))
    for part in ("doc_id < 5", "doc_id >= 5 or doc_id is null"):
        exact_dedup.arrivals(place.filter(part)).coalesce(1).write.mode("append").parquet(log)
        schema = spark.read.parquet(log).schema
        state = {bytes(r.digest): r.n for r in exact_dedup.run_stream(spark, log, schema, checkpoint, maxFilesPerTrigger="1").collect()}
    assert sorted(state.values()) == sorted(Counter(BLANK.sub("", t or "") for _, t in ROWS).values())


def plain_fingerprint(text, n=4):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", "One", "a b c d e É f", "x " * 70000, "A b \x0b c\x1cd"])
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) == plain_fingerprint(text)


def forest_roots(nodes, near):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and near(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("tile", [4096, 8])
def test_links_lose_no_component(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 63, 30)
    prints = {int(s) for s in seeds} | {0}
    for s in seeds[:12].tolist():
        for _ in range(20):
            bits = rng.choice(64, rng.integers(1, 9), replace=False)
            prints.add(int(s ^ sum(1 << int(b) for b in bits)) & ((1 << 64) - 1))
    signed = {p - (1 << 64) if p >= 1 << 63 else p: p for p in prints}
    rows = [(i, fp) for i, fp in enumerate(sorted(signed))] + [(1000, min(signed)), (None, 0)]
    got = simhash.near_groups(spark.createDataFrame(rows, "doc_id long, fp long")).collect()
    want = forest_roots(sorted(signed), lambda a, b: (signed[a] ^ signed[b]).bit_count() <= 4)
    low = {}
    for d, fp in rows:
        if d is not None:
            low[want[fp]] = min(low.get(want[fp], d), d)
    assert len(got) == len(rows) and all(r.component_id == low[want[r.fp]] for r in got)


def test_near_dedup(documents):
    docs = documents(ROWS)
    out = simhash.near_dedup(docs)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} >= {9, 10} and simhash.near_dedup(documents([])).count() == 0


def test_components_of_a_long_path(spark):
    path = [(i, i + 1) for i in range(200)] + [(500, 500), (900, 901)]
    got = {r.node: r.root for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and got[901] == 900


def test_targets(spark):
    rows = [("a", 100), ("b", 1000), ("c", 10), (None, 400), ("d", 0)]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "source string, source_size long")).collect()}
    assert got["c"] == 20 and got["d"] == 0 and got["a"] == 200
    # 1.5 * 1510 words, less 220, are shared by b (weight 1) and null (weight 1), null stopping at 800.
    assert got[None] == 800 and abs(got["b"] - (1.5 * 1510 - 220 - 800)) < 1e-9


def test_mix(documents):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(n), None, ["a", "a", "b", None][i % 4]) for i, n in enumerate(rng.integers(0, 40, 900))] + [(4, None, None, "a"), (8, "x y", None, "a"), (8, "x y", None, "a")]
    first = mixing.mix(documents(rows)).collect()
    again = mixing.mix(documents(rows, files=2)).collect()
    assert Counter((r.doc_id, r.size, r.copies) for r in first) == Counter((r.doc_id, r.size, r.copies) for r in again)
    assert Counter((r.doc_id, r.size) for r in first) == Counter((d, len(WORD.findall(t or ""))) for d, t, *_ in rows)
    assert all(0 <= r.copies <= 2 for r in first)
    for source in ("a", "b", None):
        mine = [r for r in first if r.source == source]
        assert abs(sum(r.size * r.copies for r in mine) - mine[0].target) <= 40
    docs = documents(rows)
    assert mixing.mixed(docs).count() == sum(r.copies for r in first) and mixing.mixed(docs).columns == docs.columns
    assert mixing.mix(documents([])).count() == 0


def test_pivotal_keeps_expectation(spark):
    rows = [(str(g), f"{g}-{i}", 3.0 + i % 5, 0.3) for g in range(300) for i in range(10)]
    taken = mixing.pivotal(spark.createDataFrame(rows, "grp string, key string, size double, p double"), fan_in=4).filter("taken").count()
    assert abs(taken / len(rows) - 0.3) < 0.02


def jaccard(a, b):
    a, b = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    most = sum((a | b).values())
    return sum((a & b).values()) / most if most else 1.0


def test_weighted_sampling(documents):
    rng = np.random.default_rng(4)
    rows = [(int(i), " ".join(f"w{int(x)}" for x in rng.zipf(1.5, rng.integers(1, 200)) % 50)) for i in rng.permutation(80)]
    rows += [(200, None), (201, ""), (202, "one"), (202, "one"), (None, "é \U0001f600 b")]
    got = weighted.fingerprint_with_edits(documents(rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t in order]
    found = Counter()
    wrong = []
    for i, ((d, _), text) in enumerate(zip(order, texts)):
        following = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        key = (d, len(text), hashlib.sha256(edited.encode()).hexdigest())
        found[key] += 1
        r = next(r for r in got if (r.doc_id, r.n_chars, r.edited_sha256) == key)
        wrong += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, following)]
        same = [q.fingerprint for q in got if q.doc_id == d and q.n_chars == len(text)]
        assert r.fingerprint in same
    assert found == Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got)
    assert np.sqrt(np.mean(np.square(wrong))) < 0.07 and abs(np.mean(wrong)) < 0.02
    assert weighted.fingerprint_with_edits(documents([])).count() == 0


def test_weighted_draws(spark):
    """A term is the sample as often as its weight says; a draw takes three hashes and two logarithms."""
    bags = spark.range(20_000).select("id", F.explode(F.array(F.lit(1), F.lit(3), F.lit(6))).alias("weight"))
    drawn = bags.select("id", "weight", weighted.sample_of(F.xxhash64("id", "weight"), F.ln("weight"), 5).alias("a"))
    first = drawn.groupBy("id").agg(F.min_by("weight", "a").alias("weight")).groupBy("weight").count().collect()
    assert all(abs(r["count"] / 20_000 - r["weight"] / 10) < 0.015 for r in first) and len(first) == 3
    plan = spark.range(1).select("id", F.ln("id").alias("w")).select(weighted.sample_of(F.col("id"), F.col("w"), 5).alias("a"))._jdf.queryExecution().analyzed().toString().split("\n")[0]

    def calls(name):
        found = set()
        for m in re.finditer(rf"\b{name}\(", plan):
            depth, end = 1, m.end()
            while depth:
                depth, end = depth + {"(": 1, ")": -1}.get(plan[end], 0), end + 1
            found.add(plan[m.start() : end])
        return len(found)

    assert calls("xxhash64") == 3 and calls("ln") == 2
