"""Columns with the names operators use inside come back untouched from every operator that carries columns."""

import numpy as np
import pytest

import corpus_pipeline
from sensorloom.llm import exact_dedup, jaccard, langid, mixing, packing, simhash, surrogates, toxicity, token_file, weighted
from sensorloom.llm.common import located, set_aside, stored

NAMES = "_file _row _copies _again _found _label n_entities score lang_pred block fp key copies found label h1 id size again mentions _own_0 a.b".split()
ADDED = {"n_entities", "score", "lang_pred"}


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rng = np.random.default_rng(1)
    text = lambda k: " ".join("".join(rng.choice(list("kalomitu"), 5)) for _ in range(30)) + (" ask Mr Braun, +49 (30) 123-4567" if k % 3 == 0 else "")
    rows = [(i, text(i), "pq"[i % 2], "st"[i % 2], *[f"{n}{i}" for n in NAMES[2:]], 1, 1) for i in range(24)]
    rows += [(24, *rows[3][1:]), (25, *rows[3][1:])]
    schema = ", ".join(["doc_id long, text string, lang string, source string", *[f"`{n}` string" for n in NAMES[2:]], "_file long, _row long"])
    path = str(tmp_path_factory.mktemp("clash") / "docs.parquet")
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def same_rows(got, docs, added=()):
    """Every row has the columns of the input, as its document had them, but for the text and added ones."""
    names = [c for c in docs.columns if c not in (*added, "text")]
    quoted = [f"`{c}`" for c in names]
    assert got.columns == [c for c in docs.columns if c not in added] + list(added)
    want = {r.doc_id: r for r in docs.select(*quoted).collect()}
    rows = got.select(*quoted).collect()
    assert all(r == want[r.doc_id] for r in rows)
    return sorted(r.doc_id for r in rows)


def test_carrying_operators(docs):
    assert len(same_rows(exact_dedup.exact_dedup(docs), docs)) == 24
    assert len(same_rows(simhash.near_dedup(docs), docs)) == 24
    taken = same_rows(mixing.mixed(docs), docs)
    assert 26 <= len(taken) <= 52
    assert same_rows(surrogates.pseudonymise(docs, b"k"), docs, ["n_entities"]) == list(range(26))
    net = langid.train([b"kalo mitu"] * 4, ["p"] * 4)
    assert same_rows(langid.predict(docs, net), docs, ["lang_pred", "score"]) == list(range(26))
    assert same_rows(langid.keep_identified(docs, net, 0.0), docs) == list(range(26))


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels=labels)
    assert same_rows(toxicity.score(docs, model), docs, ["score"]) == list(range(26))


def test_operators_that_read_two_columns(spark, docs, tmp_path):
    token_file.write_token_file(docs, f"{tmp_path}/tokens")
    assert token_file.read_token_file(spark, f"{tmp_path}/tokens").count() == 26
    assert weighted.fingerprint_with_edits(docs).count() == 26
    assert packing.pack(docs).selectExpr("sum(length) = sum(IF(start = 0, doc_tokens, 0))").first()[0]


def test_stages(spark, docs):
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        was, now = now, stored(stage(spark, now, ""), "clash-stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            same_rows(now, docs)
    assert now.count() > 0


def test_reserved_names_are_told(docs):
    with pytest.raises(ValueError, match="_file"):
        located(docs)
    with pytest.raises(ValueError, match="no column"):
        set_aside(docs, text="body")
    mine, back = set_aside(docs, body="text")
    whole = located(mine)
    assert "body" in whole.columns and back(whole).columns == docs.columns
    assert jaccard.near_groups(located(set_aside(docs, doc_id="doc_id", text="text")[0]), located(set_aside(docs, doc_id="doc_id", text="text")[0]).select("_file", "_row")).count() == 26
