"""The whole pipeline against brute force, stage by stage."""

from collections import Counter

import numpy as np

import corpus_pipeline
from sensorloom.llm.common import stored
from test_groups import BLANK, WORD, forest_roots, plain_fingerprint

KINDS = {"p": "ka lo mi tu", "q": "sch ung ein keit"}


def texts():
    rng = np.random.default_rng(8)

    def make(kind, n=40):
        return " ".join("".join(rng.choice(KINDS[kind].split(), 3)) for _ in range(n))

    rows = [(i, make("pq"[i % 2]), "pq"[i % 2], ["a", "b", None][i % 3]) for i in range(120)]
    long = make("p", 4000)
    rows += [(200, long, None, "a"), (201, long + " kalomi", "p", "b"), (202, rows[3][1] + "  ", "q", "a"), (203, rows[3][1], "q", "b")]
    return rows + [(300, None, "p", "a"), (301, "", None, None), (302, "12 34 !", "q", "b")]


def test_stages(spark, documents):
    rows = texts()
    text, source = {r[0]: r[1] or "" for r in rows}, {r[0]: r[3] for r in rows}
    docs = documents(rows)
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        columns, docs = docs.columns, stored(stage(spark, docs, ""), "test-stage")
        kept.append(docs)
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
    language, exact, near, mixed = [sorted(r.doc_id for r in d.select("doc_id").collect()) for d in kept[:-1]]
    assert language == [d for d, *_ in rows if d < 300]

    best = {}
    for d in language:
        key = BLANK.sub("", text[d])
        best[key] = min(best.get(key, (0, d)), (-len(text[d]), d))
    assert exact == sorted(d for _, d in best.values())

    prints = {d: plain_fingerprint(text[d]) for d in exact}
    root = forest_roots(exact, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert root[200] == root[201]
    assert Counter(root[d] for d in near) == Counter(set(root.values()))

    copies, size = Counter(mixed), {d: len(WORD.findall(text[d])) for d in near}
    assert set(copies) <= set(near) and max(copies.values()) <= 2
    share = {s: sum(size[d] for d in near if source[d] == s) for s in ("a", "b", None)}
    total = sum(size[d] * n for d, n in copies.items())
    assert abs(total - 1.5 * sum(share.values())) <= 3 * max(size.values())

    pieces = kept[-1].collect()
    length, tokens, places = Counter(), {}, {}
    for r in pieces:
        length[r.doc_id] += r.length
        tokens[r.doc_id] = r.doc_tokens
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert length == Counter({d: tokens[d] * n for d, n in copies.items()})
    for row in places.values():
        ends = np.cumsum([n for _, n in sorted(row)]).tolist()
        assert [o for o, _ in sorted(row)] == [0, *ends[:-1]] and ends[-1] <= 1024


def test_empty_table(spark, documents):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), "test-stage")
    assert docs.count() == 0
