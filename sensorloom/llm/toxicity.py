"""A toxicity classifier that is regularised by counterfactual sentences.

A document's logit is a bias plus the weights of the features it has: its words, and the first
four to six letters of its words, which tell compounds and inflected forms.  Weights are learnt
by proximal gradient steps under an L1 penalty, so words without bearing keep weight 0 and long
texts gather no noise.  Every labelled text that names a group of people gets two twins: in one
the identity term is swapped for another of the same kind, in the other for none.  The squared
differences between their logits are penalised: groups are scored alike, and a neutral mention
of any of them can't carry weight of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import set_aside, stored

SAMPLE_PER_LABEL = 3000
SAMPLE_CHARS = 20_000
LEAST_DOCUMENTS = 4
PREFIXES = (4, 5, 6)
PENALTY = 5.0

# Identity terms by kind; a swap takes another term of the same kind and language.
IDENTITY_TERMS = {
    ("en", "gender"): "woman man girl boy",
    ("en", "genders"): "women men girls boys",
    ("en", "religion"): "muslim christian jewish hindu buddhist atheist",
    ("en", "religions"): "muslims christians jews hindus buddhists atheists",
    ("en", "origin"): "black white asian african european arab latino",
    ("en", "people"): "immigrants refugees foreigners migrants",
    ("en", "orientation"): "gay straight lesbian bisexual transgender",
    ("en", "ability"): "blind deaf disabled autistic",
    ("de", "gender"): "frau mann mädchen junge",
    ("de", "genders"): "frauen männer",
    ("de", "religion"): "muslim christ jude hindu buddhist",
    ("de", "origin"): "türke deutscher araber afrikaner asiate",
    ("de", "people"): "einwanderer flüchtlinge ausländer migranten",
    ("es", "gender"): "mujer hombre niña niño",
    ("es", "genders"): "mujeres hombres",
    ("es", "religion"): "musulmán cristiano judío hindú budista",
    ("es", "people"): "inmigrantes refugiados extranjeros migrantes",
    ("fr", "gender"): "femme homme fille garçon",
    ("fr", "genders"): "femmes hommes",
    ("fr", "religion"): "musulman chrétien juif hindou bouddhiste",
    ("fr", "people"): "immigrés réfugiés étrangers migrants",
}

WORD = re.compile(r"\w+")


def _swaps() -> dict[str, str]:
    out = {}
    for terms in IDENTITY_TERMS.values():
        terms = terms.split()
        out |= {a: b for a, b in zip(terms, terms[1:] + terms[:1]) if a not in out}
    return out


SWAPS = _swaps()


def features(words: set[str]) -> set[str]:
    """Features of a text by its distinct words."""
    out = {"w:" + w for w in words}
    for n in PREFIXES:
        out |= {f"{n}:{w[:n]}" for w in words if len(w) > n}
    return out


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def twins_of(words: set[str]) -> list[set[str]]:
    """Counterfactuals: the words with all identity terms swapped, and without them; none if there are none."""
    named = words & SWAPS.keys()
    return [(words - named) | {SWAPS[w] for w in named}, words - named] if named else []


@dataclass
class Classifier:
    bias: float
    weights: dict[str, float]

    def prepared(self):
        """Weights by word, and by prefix for every length."""
        words = {k[2:]: v for k, v in self.weights.items() if k.startswith("w:")}
        starts = [(n, {k[2:]: v for k, v in self.weights.items() if k.startswith(f"{n}:")}) for n in PREFIXES]
        return words, starts

    def scorer(self):
        by_word, starts = self.prepared()

        def logit(text: str | None) -> float:
            words = words_of(text)
            total = self.bias + sum(by_word[w] for w in by_word.keys() & words)
            for n, by_start in starts:
                total += sum(by_start[s] for s in by_start.keys() & {w[:n] for w in words if len(w) > n})
            return total

        return logit


def train(texts: list[set[str]], twins: list[tuple[int, set[str]]], labels: np.ndarray, **options) -> Classifier:
    """Fit on feature sets; ``twins`` has, for rows that name a group, the features of a counterfactual."""
    names = sorted(set().union(*texts, *[t for _, t in twins]))
    place = {f: i for i, f in enumerate(names)}
    number = lambda t: np.array(sorted(place[f] for f in t), np.int64)
    return descend(names, [number(t) for t in texts], [(i, number(t)) for i, t in twins], labels, **options)


def descend(
    names: list[str], rows: list[np.ndarray], twins: list[tuple[int, np.ndarray]], labels: np.ndarray, penalty: float = PENALTY, steps: int = 400, l1: float = 2e-4
) -> Classifier:
    """Fit on rows of feature numbers by proximal steps of adapted length, both labels weighing alike.

    With one label only, the classifier gives every text that label's rate, smoothed.
    """
    n, d = len(rows), len(names)
    rate = (labels.sum() + 1) / (n + 2)
    bias, w = float(np.log(rate / (1 - rate))), np.zeros(d)
    if n == 0 or labels.min() == labels.max():
        return Classifier(bias, {})
    owner, flat = np.repeat(np.arange(n), [len(r) for r in rows]), np.concatenate(rows)
    # What a twin lacks (+1) and has more (-1).
    apart = [(k, sign, some) for k, (i, other) in enumerate(twins) for sign, some in ((1.0, np.setdiff1d(rows[i], other)), (-1.0, np.setdiff1d(other, rows[i])))]
    sizes = [len(some) for _, _, some in apart]
    pair = np.repeat(np.array([k for k, _, _ in apart], np.int64), sizes)
    sign = np.repeat(np.array([x for _, x, _ in apart]), sizes)
    place = np.concatenate([np.zeros(0, np.int64), *[some for _, _, some in apart]])
    weight = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (n - labels.sum()))
    seen, lift = np.zeros(d), 0.0
    for _ in range(steps):
        logits = bias + np.bincount(owner, w[flat], n)
        error = weight * (1 / (1 + np.exp(-logits)) - labels)
        g = np.bincount(flat, error[owner], d)
        if len(pair):
            change = np.bincount(pair, sign * w[place], len(twins))
            g += 2 * penalty / len(twins) * np.bincount(place, sign * change[pair], d)
        seen += g * g
        pace = 0.3 / (np.sqrt(seen) + 1e-4)
        v = w - pace * g
        w = np.sign(v) * np.maximum(np.abs(v) - pace * l1, 0)
        lift += error.sum() ** 2
        bias -= 0.3 * error.sum() / (np.sqrt(lift) + 1e-4)
    return Classifier(float(bias), {names[i]: float(w[i]) for i in np.flatnonzero(w)})


def sample(docs: DataFrame, id_col: str, text_col: str, label_col: str, per_label: int = SAMPLE_PER_LABEL, labels: DataFrame | None = None) -> tuple:
    """Arguments of ``descend``: about ``per_label`` texts of each label, chosen by a hash of the id.

    Only texts of at most ``SAMPLE_CHARS`` characters are learnt from, and only features that at
    least ``LEAST_DOCUMENTS`` of the chosen texts have; only their numbers reach the driver.
    ``labels`` has ids and labels, if ``docs`` has no label; ids are drawn from it first, so that
    only texts of drawn ids are moved.
    """
    rows = docs.filter(F.length(F.coalesce(F.col(text_col), F.lit(""))) <= SAMPLE_CHARS)
    marks = (rows if labels is None else labels).filter(F.col(label_col).isin(0, 1))
    known = marks if labels is None else marks.join(rows.select(id_col), id_col)
    counts = {r[0]: r[1] for r in known.groupBy(label_col).count().collect()}
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = [min(1.0, per_label / max(1, counts.get(k, 0))) for k in (0, 1)]
    chosen = marks.filter(draw < F.when(F.col(label_col) == 1, share[1]).otherwise(share[0]))
    if labels is not None:
        drawn = stored(chosen.select(id_col, label_col).join(rows.select(id_col), id_col, "left_semi"), "toxic-drawn")
        chosen = rows.select(id_col, text_col).join(drawn, id_col)
    key = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    chosen = stored(chosen.select(key.alias("key"), F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")), "toxic-sample")

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row per text and per twin (version above 0), with hashed features."""
        for frame in frames:
            for at in range(0, len(frame), 256):
                out: list[tuple] = []
                for row in frame.iloc[at : at + 256].itertuples():
                    words = words_of(row.text)
                    out += [(row.key, i, row.label, sorted(features(v))) for i, v in enumerate((words, *twins_of(words)))]
                yield pd.DataFrame(out, columns=["key", "version", "label", "features"])

    every = stored(chosen.mapInPandas(found, "key long, version int, label int, features array<string>"), "toxic-features")
    often = every.filter("version = 0").select(F.explode("features").alias("name")).groupBy("name").count().filter(F.col("count") >= LEAST_DOCUMENTS)
    often = stored(often.select("name", F.xxhash64("name").alias("number")), "toxic-names")
    named = often.toArrow().sort_by([("number", "ascending")])
    numbers, names = named["number"].to_numpy(), named["name"].to_pylist()
    flat = every.select("key", "version", "label", F.explode("features").alias("name")).join(often, "name")
    lists = flat.groupBy("key", "version").agg(F.collect_set("number").alias("numbers"))
    got = every.select("key", "version", "label").distinct().join(lists, ["key", "version"], "left").toArrow().sort_by([("version", "ascending"), ("key", "ascending")])
    found_rows = [np.searchsorted(numbers, np.sort(np.array([] if r is None else r.values.to_numpy(), np.int64))) for r in (x if x.is_valid else None for x in got["numbers"])]
    keys, versions = got["key"].to_pylist(), got["version"].to_pylist()
    texts = [r for r, v in zip(found_rows, versions) if v == 0]
    place = {k: i for i, k in enumerate(keys[: len(texts)])}
    twins = [(place[k], r) for k, v, r in zip(keys, versions, found_rows) if v]
    return names, texts, twins, np.array(got["label"].to_pylist()[: len(texts)], float)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", labels: DataFrame | None = None) -> Classifier:
    """Learn from a bounded sample of the rows with label 0 or 1; other labels, and null, are not learnt from.

    Labels are a column of ``docs``, or a table ``labels`` with the ids of documents.
    """
    return descend(*sample(docs, id_col, text_col, label_col, labels=labels))


def score(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """Add ``score``, the probability that a whole text is toxic.  Null and empty texts get the bias alone.

    A column ``score`` of ``docs`` is replaced; others stay, whatever their names.
    """
    mine, back = set_aside(docs, text=text_col)

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        logit = model.scorer()
        for texts in batches:
            yield pd.Series(1 / (1 + np.exp(-np.clip([logit(t) for t in texts], -500, 500))), dtype="float64")

    return back(mine.withColumn("score", probability(F.col("text"))), "score")


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether a document's labels are kept from training."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.pmod(F.crc32(key.cast("binary")), F.lit(folds)) == 0
