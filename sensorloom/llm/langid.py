"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read a text's UTF-8 bytes from both ends; at every position a linear
layer on both states gives the probabilities of the languages, and a document's probabilities
are the means over its positions.  The network is trained in numpy by backpropagation through
time on windows of labelled texts.  Whole texts are labelled: they are cut into windows, and
all windows of a batch of documents run side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import set_aside

HIDDEN = 12
WINDOW = 64
SAMPLE_PER_LANGUAGE = 800
STEPS = 260
BATCH = 128
LANES = 4096
UNDETERMINED = "und"


@dataclass
class Network:
    """``x``: input rows by byte, ``u``: recurrent weights, ``b``: bias of the candidate's recurrent part, per direction."""

    languages: list[str]
    x: np.ndarray  # (2, 256, 3H): update, reset, candidate
    u: np.ndarray  # (2, H, 3H)
    b: np.ndarray  # (2, H)
    w: np.ndarray  # (2, H, L)
    c: np.ndarray  # (L,)

    def parts(self) -> list[np.ndarray]:
        return [self.x, self.u, self.b, self.w, self.c]


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * v) + 0.5


def _softmax(v: np.ndarray, axis: int) -> np.ndarray:
    e = np.exp(v - v.max(axis=axis, keepdims=True))
    return e / e.sum(axis=axis, keepdims=True)


def loss_and_gradients(net: Network, data: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over all positions of windows ``data`` (B, T), and its gradients by backpropagation through time."""
    n, steps = data.shape
    hidden, kinds = net.u.shape[1], len(net.languages)
    both = np.stack([data, data[:, ::-1]])  # each direction in its own order
    h = np.zeros((2, n, hidden))
    kept, states = [], np.empty((2, steps, n, hidden))
    for t in range(steps):
        seen = np.stack([net.x[0][both[0, :, t]], net.x[1][both[1, :, t]]])
        back = h @ net.u
        z = _sigmoid(seen[..., :hidden] + back[..., :hidden])
        r = _sigmoid(seen[..., hidden : 2 * hidden] + back[..., hidden : 2 * hidden])
        inner = back[..., 2 * hidden :] + net.b[:, None]
        cand = np.tanh(seen[..., 2 * hidden :] + r * inner)
        kept.append((h, z, r, inner, cand))
        h = cand + z * (h - cand)
        states[:, t] = h
    logits = states[0] @ net.w[0] + states[1, ::-1] @ net.w[1] + net.c
    p = _softmax(logits, -1)
    truth = np.zeros((n, kinds))
    truth[np.arange(n), labels] = 1
    loss = -np.log(p[:, np.arange(n), labels] + 1e-12).mean()
    d = (p - truth) / (n * steps)
    gw = np.stack([np.einsum("tnh,tnl->hl", states[0], d), np.einsum("tnh,tnl->hl", states[1, ::-1], d)])
    out = np.stack([d @ net.w[0].T, (d @ net.w[1].T)[::-1]])
    gx, gu, gb = np.zeros_like(net.x), np.zeros_like(net.u), np.zeros_like(net.b)
    later = np.zeros((2, n, hidden))
    for t in reversed(range(steps)):
        h, z, r, inner, cand = kept[t]
        g = out[:, t] + later
        dz = g * (h - cand) * z * (1 - z)
        dc = g * (1 - z) * (1 - cand * cand)
        dr = dc * inner * r * (1 - r)
        di = dc * r
        here = np.concatenate([dz, dr, di], -1)
        seen = np.concatenate([dz, dr, dc], -1)
        for k in range(2):
            np.add.at(gx[k], both[k, :, t], seen[k])
        gu += h.transpose(0, 2, 1) @ here
        gb += di.sum(1)
        later = g * z + here @ net.u.transpose(0, 2, 1)
    return loss, [gx, gu, gb, gw, d.sum((0, 1))]


def train(windows: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, seed: int = 0) -> Network:
    """Train on windows of bytes; languages are drawn alike often, whatever their counts.

    Without any labelled text the network knows no language, and every text is ``und``.
    """
    languages = sorted(set(labels))
    if not languages:
        return Network([UNDETERMINED], *[np.zeros(s) for s in ((2, 256, 3), (2, 1, 3), (2, 1), (2, 1, 1), (1,))])
    rng = np.random.default_rng(seed)
    kinds = len(languages)
    net = Network(
        languages,
        rng.normal(0, 0.3, (2, 256, 3 * hidden)),
        rng.normal(0, 1 / np.sqrt(hidden), (2, hidden, 3 * hidden)),
        np.zeros((2, hidden)),
        rng.normal(0, 1 / np.sqrt(hidden), (2, hidden, kinds)),
        np.zeros(kinds),
    )
    length = max(1, min(WINDOW, max(map(len, windows), default=1)))
    rows = [np.frombuffer(w, np.uint8) for w in windows]
    by = [[i for i, label in enumerate(labels) if label == name and len(rows[i])] for name in languages]
    by = [(k, rows_of) for k, rows_of in enumerate(by) if rows_of]
    first, second = [np.zeros_like(p) for p in net.parts()], [np.zeros_like(p) for p in net.parts()]
    for step in range(1, steps + 1):
        data, truth = np.full((batch, length), 32, np.uint8), np.empty(batch, np.int64)
        for j in range(batch):
            truth[j], choice = by[j % len(by)]
            row = rows[choice[rng.integers(len(choice))]]
            at = rng.integers(max(1, len(row) - length + 1))
            piece = row[at : at + length]
            data[j, : len(piece)] = piece
        _, gradients = loss_and_gradients(net, data, truth)
        norm = np.sqrt(sum((g * g).sum() for g in gradients))
        rate = 0.02 * min(1, step / 20) * (1 - 0.9 * step / steps)
        for p, g, m, v in zip(net.parts(), gradients, first, second):
            g = g * min(1, 1 / (norm + 1e-12))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


class Labeller:
    """The network prepared for many windows at once, states laid out by unit."""

    def __init__(self, net: Network):
        self.languages, h = net.languages, net.u.shape[1]
        self.hidden = h
        # Gates are written as 0.5 * tanh(v / 2) + 0.5; the halves go into the weights.
        half = np.repeat([0.5, 0.5, 1.0], h).astype(np.float32)
        self.x = [np.ascontiguousarray((net.x[k] * half).T.astype(np.float32)) for k in range(2)]
        self.u = [np.ascontiguousarray((net.u[k] * half).T.astype(np.float32)) for k in range(2)]
        self.b = [net.b[k][:, None].astype(np.float32) for k in range(2)]
        self.w = np.concatenate([net.w[0], net.w[1]]).T.astype(np.float32)
        self.c = net.c[:, None].astype(np.float32)

    def positions(self, data: np.ndarray) -> np.ndarray:
        """Probabilities (T, L, N) at every position of windows ``data`` (T, N)."""
        steps, n = data.shape
        h3, h1 = 3 * self.hidden, self.hidden
        states = np.empty((steps, 2 * h1, n), np.float32)
        for k in range(2):
            h = np.zeros((h1, n), np.float32)
            for t in range(steps) if k == 0 else range(steps - 1, -1, -1):
                seen = self.x[k].take(data[t], axis=1)
                back = self.u[k] @ h
                gates = seen[: 2 * h1]
                gates += back[: 2 * h1]
                np.tanh(gates, out=gates)
                gates *= 0.5
                gates += 0.5
                inner = back[2 * h1 : h3]
                inner += self.b[k]
                inner *= gates[h1:]
                inner += seen[2 * h1 :]
                np.tanh(inner, out=inner)
                h = np.subtract(h, inner)
                h *= gates[:h1]
                h += inner
                states[t, k * h1 : (k + 1) * h1] = h
        v = np.matmul(self.w, states)
        v += self.c
        v -= v.max(axis=1, keepdims=True)
        np.exp(v, out=v)
        v /= v.sum(axis=1, keepdims=True)
        return v

    def documents(self, texts: list[str]) -> np.ndarray:
        """Mean probabilities (documents, L) over all positions of whole texts; zeros for an empty text."""
        raw = [t.encode("utf-8", "replace") for t in texts]
        total = np.zeros((len(raw), len(self.languages)))
        sizes = np.array([len(b) for b in raw], np.int64)
        counts = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(raw)), counts)
        flat = np.frombuffer(b"".join(b + b" " * (-len(b) % WINDOW) for b in raw), np.uint8).reshape(-1, WINDOW)
        order = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        valid = np.minimum(WINDOW, sizes[owner] - order * WINDOW)
        for a in range(0, len(owner), LANES):
            p = self.positions(np.ascontiguousarray(flat[a : a + LANES].T))
            p *= (np.arange(WINDOW)[:, None] < valid[a : a + LANES])[:, None, :]
            np.add.at(total, owner[a : a + LANES], p.sum(axis=0).T)
        return total / np.maximum(sizes, 1)[:, None]

    def labels(self, text: str) -> list[str]:
        """The language of every byte of a text."""
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        padded = np.append(raw, np.full(-len(raw) % WINDOW, 32, np.uint8)).reshape(-1, WINDOW)
        best = self.positions(np.ascontiguousarray(padded.T)).argmax(axis=1).T.ravel()[: len(raw)]
        return [self.languages[i] for i in best]


def sample(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = SAMPLE_PER_LANGUAGE) -> tuple[list[bytes], list[str]]:
    """About ``per_language`` windows of texts of every language, chosen by a hash of the id.

    At most 512 characters of a chosen text are read, from a place the hash gives too.
    """
    rows = labelled.filter(F.col(lang_col).isNotNull() & (F.length(F.col(text_col)) > 0))
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    if not counts:
        return [], []
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_language / n))])
    at = F.floor(F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("place")), F.greatest(F.lit(1), F.length(F.col(text_col)) - 511)) + 1)
    chosen = rows.filter(draw < share[F.col(lang_col)]).select(F.col(lang_col).alias("lang"), F.col(text_col).substr(at.cast("int"), F.lit(512)).alias("piece"))
    found = sorted((r["lang"], r["piece"]) for r in chosen.collect())
    return [piece.encode("utf-8", "replace") for _, piece in found], [lang for lang, _ in found]


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> Network:
    """Train on a bounded sample of the rows that have a language."""
    return train(*sample(labelled, id_col, text_col, lang_col, per_language))


def predict(docs: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``, its mean probability over all positions.

    A text that is null or has no letter is ``und`` with score 0.  Only the text is read.
    Columns of ``docs`` of these two names are replaced; others stay, whatever their names.
    """
    mine, back = set_aside(docs, text=text_col)
    labeller = Labeller(net)

    @F.pandas_udf("lang_pred string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows, names, scores = texts.tolist(), [UNDETERMINED] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(rows) if t and any(map(str.isalpha, t))]
            # As many whole texts at once as fill the lanes.
            while known:
                some, size = [], 0
                while known and size < WINDOW * LANES:
                    size += len(rows[known[-1]])
                    some.append(known.pop())
                p = labeller.documents([rows[i] for i in some])
                for i, best in zip(some, p.argmax(axis=1)):
                    names[i] = labeller.languages[best]
                scores[some] = np.clip(p.max(axis=1), 0, 1) if labeller.languages != [UNDETERMINED] else 0
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return back(mine.withColumn("label", label(F.col("text"))).select("*", "label.*"), "lang_pred", "score")


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a document's labels are kept from training."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.pmod(F.crc32(key.cast("binary")), F.lit(folds)) == fold


def keep_identified(docs: DataFrame, net: Network, least: float = 0.35, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language the network can tell: not ``und``, and a score of at least ``least``."""
    mine, back = set_aside(docs, text=text_col)
    return back(predict(mine, net).filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)))
