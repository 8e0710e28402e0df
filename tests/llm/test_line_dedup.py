import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorloom.llm import line_dedup

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def plain(texts, min_docs, min_chars):
    holders = defaultdict(set)
    for i, t in enumerate(texts):
        for line in (t or "").split("\n"):
            holders[key_of(line)].add(i)
    lost = {k for k, v in holders.items() if len(v) >= min_docs and len(k) >= min_chars}
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key_of(x) not in lost]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def check(documents, texts, min_docs=3, min_chars=1):
    rows = [(i, t) for i, t in enumerate(texts)]
    found = line_dedup.line_dedup(documents(rows), min_docs=min_docs, min_chars=min_chars).collect()
    assert [(r.n_lines, r.n_dropped, r.kept) for r in sorted(found)] == plain(texts, min_docs, min_chars)


def test_random_texts(documents):
    rng = random.Random(3)
    stock = ["Menu", "menu ", "\tMENU\r", "", "  ", "share this", "é", "É", "\x0bx\x0c", "a b", "A  b", " menu"]
    stock += [f"line {i}" for i in range(60)]
    texts = [None, "", "\n", "\n\n", "menu\n"]
    texts += ["\n".join(rng.choice(stock) for _ in range(rng.choice([1, 2, 5, 40]))) for _ in range(150)]
    for min_docs, min_chars in ((3, 1), (10, 1), (3, 0), (5, 5)):
        check(documents, texts, min_docs, min_chars)


def test_no_hot_and_only_hot_hashes(documents, monkeypatch):
    texts = ["a\nb\nc", "c\nb", "b\nx", "b\nc\ny"] * 2
    for part in (1, 2, 4096):
        monkeypatch.setattr(line_dedup, "HOT_PART", part)
        check(documents, texts, 4)


def test_repeats_inside_one_document_count_once(documents):
    check(documents, ["again\n" * 50, "again", "other"], 3)


def test_long_text_and_hot_line(documents):
    long = "\n".join(f"own {i}\nshared {i % 9}" for i in range(50_000))
    blanks = "x" + " " * 500_000 + "y\n" + "\t" * 500_000
    check(documents, [long, blanks] + ["\n".join(f"shared {i}" for i in range(9))] * 12 + ["Shared 1\nmine"] * 3, 10)


def test_empty_table_null_and_repeated_ids(spark, documents):
    assert line_dedup.line_dedup(documents([])).collect() == []
    rows = [(None, "same\nown"), (None, "same"), (1, "same\nown"), (1, "same\nown")]
    found = line_dedup.line_dedup(documents(rows), min_docs=4)
    assert sorted(r.kept for r in found.collect()) == ["", "own", "own", "own"]


def test_clashing_columns(spark):
    names = "_file _row at lines pos line key h1 h2 hot found n kept".split()
    rows = [(i, "menu\nown", *(["x"] * len(names))) for i in range(4)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    found = line_dedup.line_dedup(docs, min_docs=4)
    assert sorted((r.doc_id, r.n_dropped, r.kept) for r in found.collect()) == [(i, 2, "") for i in range(4)]


@pytest.fixture(scope="module")
def keys(spark):
    from pyspark.sql import functions as F

    def run(texts):
        rows = spark.createDataFrame([(t,) for t in texts], "text string")
        return rows.select(F.split(line_dedup._keyed(F.col("text")), "\n", -1), F.transform(line_dedup.lines_of(F.col("text")), line_dedup.line_key)).collect()

    return run


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZ \t\n\r\x0b\x0c é"), max_size=30), min_size=200, max_size=200))
def test_keys_of_whole_texts_and_of_lines_agree(keys, texts):
    for t, (whole, each) in zip(texts, keys(texts)):
        assert whole == each == [key_of(x) for x in t.split("\n")]
