"""URL rules by a cascade of Bloom filters: exact membership without a join.

The first filter holds the listed keys.  Of the corpus's complete key universe, the unlisted
keys that pass it go into the second; the listed keys that pass that one go into the third; and
so on until a level lets nothing through by mistake.  A key of the universe is listed exactly if
the first level that rejects it is an odd one, counted from 0.  Filters are built from word-wise
ORs, reduced before the shuffle, and only their words reach the driver: a filter's size follows
the list and is checked.  A list beyond ``MAX_BITS`` is tested by a join instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import stored

MAX_BITS = 1 << 28
FIRST_RATE = 1 / 64
LATER_RATE = 1 / 2
HASHES = 16


@dataclass
class Level:
    words: np.ndarray  # unsigned 64-bit
    hashes: int


def hashed(key: Column) -> list[Column]:
    """Two independent 64-bit hashes of a key."""
    return [F.xxhash64(key, F.lit(0)).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2")]


def _places(h1: np.ndarray, h2: np.ndarray, level: int, hashes: int, bits: int) -> np.ndarray:
    """Bit numbers (keys, hashes); every level uses multiples of its own."""
    times = np.arange(level * HASHES, level * HASHES + hashes, dtype=np.uint64)
    mixed = h1.view(np.uint64)[:, None] + times * (h2.view(np.uint64)[:, None] | np.uint64(1))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(20)) % np.uint64(bits)


def _passes(level: Level, number: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    places = _places(h1, h2, number, level.hashes, 64 * len(level.words))
    return ((level.words[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1)).all(axis=1)


@dataclass
class Cascade:
    levels: list[Level]

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether keys of the universe are listed."""
        rejected = np.full(len(h1), len(self.levels))
        rest = np.arange(len(h1))
        for number, level in enumerate(self.levels):
            passes = _passes(level, number, h1[rest], h2[rest])
            rejected[rest[~passes]] = number
            rest = rest[passes]
        return rejected % 2 == 1


def _filter(keys: DataFrame, n: int, number: int) -> Level:
    """A Bloom filter of ``n`` keys given by ``h1, h2``."""
    rate = LATER_RATE if number else FIRST_RATE
    bits = 64 * ceil(max(1, n) * log2(1 / rate) / log(2) / 64)
    if bits > MAX_BITS:
        raise OverflowError(f"{n} keys need {bits} bits, above {MAX_BITS}")
    hashes = max(1, round(log2(1 / rate)))

    def words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            at = _places(f["h1"].to_numpy(), f["h2"].to_numpy(), number, hashes, bits).ravel()
            word, back = np.unique(at >> np.uint64(6), return_inverse=True)
            value = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(value, back, np.uint64(1) << (at & np.uint64(63)))
            yield pd.DataFrame({"word": word.astype(np.int64), "value": value.view(np.int64)})

    rows = keys.mapInPandas(words, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).collect()
    out = np.zeros(bits // 64, np.uint64)
    out[[r["word"] for r in rows]] = np.array([r["value"] for r in rows], np.int64).view(np.uint64)
    return Level(out, hashes)


def _passing(level: Level, number: int):
    @F.pandas_udf("boolean")
    def passes(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(_passes(level, number, h1.to_numpy(), h2.to_numpy()))

    return passes


def build(universe: DataFrame, listed: DataFrame) -> Cascade:
    """The cascade for the column ``key`` of both; it is exact for every key of ``universe`` or ``listed``."""
    inside = stored(listed.select("key").distinct().select(*hashed(F.col("key"))), "cascade-listed")
    outside = stored(universe.select("key").distinct().join(listed.select("key"), "key", "left_anti").select(*hashed(F.col("key"))), "cascade-others")
    levels: list[Level] = []
    mine, others = inside, outside
    while n := mine.count():
        number, level = len(levels), _filter(mine, n, len(levels))
        levels.append(level)
        mine, others = stored(others.filter(_passing(level, number)("h1", "h2")), "cascade-level"), mine
    return Cascade(levels)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> list[Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    parts = r"^([^/?#]*)([^?#]*)"
    return [F.translate(F.regexp_extract(rest, parts, 1), UPPER, LOWER).alias("host"), F.regexp_extract(rest, parts, 2).alias("path")]


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Keys a rule for this url could have, longest first: the last labels of the host and the start of the path.

    ``shapes`` are the pairs (labels of the host, length of the path) that rules have.
    """
    keys = []
    for labels, length in shapes:
        # The last labels, or the whole host if it has no more.
        suffix = F.substring_index(host, ".", -labels)
        fits = (F.length(path) >= length) & (F.size(F.split(suffix, r"\.")) == labels)
        keys.append(F.when(fits, F.concat(suffix, F.substring(path, 1, length))))
    found = F.array_distinct(F.filter(F.array(*keys), lambda k: k.isNotNull())) if keys else F.array().cast("array<string>")
    longest = F.transform(found, lambda k: F.struct((-F.length(k)).alias("order"), k.alias("key")))
    return F.transform(F.array_sort(longest), lambda s: s["key"])


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", otherwise: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page by rows ``host, path, verdict`` of ``rules``.

    A rule fits its host and all subdomains if the url's path starts with the rule's; the longest
    rule wins (of equally long ones the first by code point).  A key listed for both verdicts is
    blocked.  Without a rule the verdict is ``otherwise``.  Null urls have an empty host and path;
    repeated pages are judged alike; empty tables give empty results; other columns aren't read.
    """
    lists = rules.select(F.concat("host", "path").alias("key"), "verdict", F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("length"))
    shapes = sorted((r["labels"], r["length"]) for r in lists.select("labels", "length").distinct().collect())
    parts = pages.select(F.col(id_col).cast("long").alias("page_id"), *host_and_path(F.col(url_col)))
    keyed = parts.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), shapes))
    universe = stored(keyed.select(F.explode("keys").alias("key")).distinct(), "url-universe")
    blocked = lists.filter("verdict = 'block'").select("key")
    allowed = lists.filter("verdict = 'allow'").select("key")
    try:
        cascades = [build(universe, blocked), build(universe, allowed)]
    except OverflowError:
        return _judge_by_join(keyed, lists, otherwise)

    @F.pandas_udf("number int, blocked boolean")
    def first_listed(h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
        sizes = np.array([len(x) for x in h1], np.int64)
        one = np.concatenate([np.zeros(0, np.int64), *h1]).astype(np.int64)
        two = np.concatenate([np.zeros(0, np.int64), *h2]).astype(np.int64)
        block, allow = (c.listed(one, two) for c in cascades)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        number = np.arange(len(one)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        hit = np.flatnonzero(block | allow)[::-1]
        out, bad = np.zeros(len(sizes), np.int32), np.zeros(len(sizes), bool)
        out[owner[hit]] = number[hit] + 1  # the first of a page is written last
        bad[owner[hit]] = block[hit]
        return pd.DataFrame({"number": out, "blocked": bad})

    hashes = F.transform("keys", lambda k: F.struct(*hashed(k)))
    found = keyed.withColumn("f", first_listed(hashes["h1"], hashes["h2"]))
    verdict = F.when(F.col("f.number") == 0, otherwise).when(F.col("f.blocked"), "block").otherwise("allow")
    return found.select("page_id", "host", "path", F.when(F.col("f.number") > 0, F.get("keys", F.col("f.number") - 1)).alias("rule"), verdict.alias("verdict"))


def _judge_by_join(keyed: DataFrame, lists: DataFrame, otherwise: str) -> DataFrame:
    """The same by a join of the distinct urls' keys with the lists, for lists that no filter of ``MAX_BITS`` holds."""
    hits = keyed.select("host", "path", F.posexplode("keys").alias("at", "key")).distinct().join(lists.groupBy("key").agg(F.max("verdict").alias("v")), "key")
    best = hits.groupBy("host", "path").agg(F.min_by(F.struct("key", "v"), "at").alias("b"))
    return keyed.join(best, ["host", "path"], "left").select("page_id", "host", "path", F.col("b.key").alias("rule"), F.coalesce("b.v", F.lit(otherwise)).alias("verdict"))
