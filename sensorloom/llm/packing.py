"""Packing token sequences by minimum bin slack over remaining lengths.

Documents give whole sequences as long as they fill them; what is left of each is one of fewer
than ``capacity`` lengths.  Only how many there are of each length is counted, so the packing
itself works on at most ``capacity - 1`` numbers, whatever the size of the table.  A window
takes the longest remaining length, then the multiset of others that comes closest to the
capacity: bit sets of reachable sums, one shift per power of two of a length's count, and a walk
back through them that finds how often each length is used.  The same window is repeated as
often as the counts allow.  Slack that no remaining piece fits is filled by cutting one.

The plan says which ranks of a length go to which sequences; rows find their place by joining
their rank with it.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import stored
from sensorloom.llm.token_file import END_ID
from sensorloom.llm.tokens import default_vocabulary, encoder

CAPACITY = 1024


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How often each length is used in a multiset whose sum is as close below ``room`` as can be.

    Longer lengths come first, and a sum that needs fewer short ones is preferred.
    """
    reach, seen = 1, []
    full = (1 << (room + 1)) - 1
    for length in sorted((w for w, n in counts.items() if n > 0 and w <= room), reverse=True):
        seen.append((length, reach))
        left, step = min(counts[length], room // length), 1
        while left:
            take = min(step, left)
            reach |= reach << (length * take) & full
            left, step = left - take, step * 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used = {}
    for length, before in reversed(seen):
        times = 0
        while not before >> total & 1:
            total, times = total - length, times + 1
        if times:
            used[length] = times
    return used


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Places of all remainders, as rows ``(of, rank_from, rank_to, cut, length, sequence, per, at, shift)``.

    Of the remainders of length ``of``, those with rank from ``rank_from`` (incl.) to ``rank_to`` give
    their ``length`` ids from ``cut`` on.  The one with rank ``r`` is number ``t = r - rank_from + shift``
    of its kind and lies in sequence ``sequence + t div per`` at ``at + (t mod per) * length``.
    """
    supply = {w: deque([(w, 0, 0, n)]) for w, n in counts.items() if n > 0}
    left = {w: n for w, n in counts.items() if n > 0}
    rows, sequence = [], 0

    def take(length: int, n: int) -> Iterator[tuple]:
        left[length] -= n
        if not left[length]:
            del left[length]
        while n:
            of, cut, a, b = supply[length].popleft()
            if b - a > n:
                supply[length].appendleft((of, cut, a + n, b))
                b = a + n
            n -= b - a
            yield of, cut, a, b

    while left:
        longest = max(left)
        others = left | {longest: left[longest] - 1}
        used = best_fill(others, capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        slack = capacity - sum(w * n for w, n in used.items())
        times = min(left[w] // n for w, n in used.items())
        spare = {w: left[w] - used.get(w, 0) for w in left}
        cut_from = min((w for w, n in spare.items() if n > 0 and w > slack), default=None) if slack else None
        if cut_from:
            times = max(1, min(times, left[cut_from] // (used.get(cut_from, 0) + 1)))
        at = 0
        for length, per in sorted(used.items(), reverse=True):
            shift = 0
            for of, cut, a, b in take(length, per * times):
                rows.append((of, a, b, cut, length, sequence, per, at, shift))
                shift += b - a
            at += length * per
        if cut_from:
            shift = 0
            for of, cut, a, b in list(take(cut_from, times)):
                rows.append((of, a, b, cut, slack, sequence, 1, at, shift))
                supply.setdefault(cut_from - slack, deque()).append((of, cut + slack, a, b))
                shift += b - a
            left[cut_from - slack] = left.get(cut_from - slack, 0) + times
        sequence += times
    return rows


PIECES = "doc_id long, part int, row long, start long, length int, doc_tokens long, number long, ids binary"


def encode_pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text and an end id, cut at multiples of ``capacity``, where the documents lie.

    ``number`` counts pieces of one length within a part of the table.  A null text counts as empty.
    """
    vocabulary = vocabulary or default_vocabulary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, row, numbers = encoder(vocabulary), TaskContext.get().partitionId(), 0, {}
        end, step = END_ID.to_bytes(4, "little"), 4 * capacity
        names = [c.split()[0] for c in PIECES.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        columns, held = [[] for _ in names], 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            for c in columns:
                c.clear()
            return out

        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            for name, ids in zip(batch.column(0).to_pylist(), tokens.texts(texts)):
                ids += end
                for a in range(0, len(ids), step):
                    piece = ids[a : a + step]
                    n = len(piece) // 4
                    numbers[n] = numbers.get(n, -1) + 1
                    for c, v in zip(columns, (name, part, row, a // 4, n, len(ids) // 4, numbers[n], piece)):
                        c.append(v)
                    row, held = row + 1, held + len(piece)
                    if held > 1 << 22:
                        yield flush()
                        held = 0
        if columns[0]:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(encode, PIECES)
    return stored(rows.withColumn("ids_crc32", F.crc32("ids")), "pack-pieces")


def layout(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequence and offset of every piece; remainders that were cut to fill a sequence give several rows.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, part, row, cut``;
    ``ids_crc32`` is null where a remainder was cut.
    """
    spark = pieces.sparkSession
    narrow = pieces.drop("ids")
    per_part = stored(narrow.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    # At most ``capacity`` lengths reach the driver, and as many plan rows as windows use them.
    totals = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    full = totals.pop(capacity, 0)
    rows = plan(totals, capacity)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    ranked = narrow.join(per_part.select("part", "length", before.alias("before")), ["part", "length"]).withColumn("rank", F.col("number") + F.col("before"))
    whole = ranked.filter(F.col("length") == capacity).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("rank").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "part", "row", F.lit(0).alias("cut")
    )
    schema = "of int, rank_from long, rank_to long, cut int, size int, sequence long, per long, at long, shift long"
    places = F.broadcast(spark.createDataFrame(rows, schema))
    t = F.col("rank") - F.col("rank_from") + F.col("shift")
    rest = ranked.join(places, (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))).select(
        "doc_id",
        (F.col("start") + F.col("cut")).alias("start"),
        F.col("size").alias("length"),
        F.when(F.col("size") == F.col("length"), F.col("ids_crc32")).alias("ids_crc32"),
        "doc_tokens",
        (F.lit(full) + F.col("sequence") + F.floor(t / F.col("per"))).alias("sequence_id"),
        (F.col("at") + F.pmod(t, F.col("per")) * F.col("size")).alias("offset"),
        "part",
        "row",
        "cut",
    )
    return whole.unionByName(rest)


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their place: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every id lies in exactly one piece; sequences have ``capacity`` ids, but for one at most.  A
    null or empty text is one end id; rows with one id are documents of their own; an empty
    table gives no pieces; other columns aren't read.
    """
    pieces = encode_pieces(docs, vocabulary, capacity, id_col, text_col)
    return checksums(layout(pieces, capacity), pieces)


def checksums(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """Fill in the checksums of cut remainders from their ids; others are stored with the pieces."""
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    # Stored first, as their size tells whether the ids need to be shuffled for them.
    cut = stored(placed.filter("ids_crc32 is null").drop("ids_crc32"), "pack-cut").join(pieces.select("part", "row", "ids"), ["part", "row"])
    cut = cut.withColumn("ids_crc32", F.crc32(F.substring(F.col("ids"), F.col("cut") * 4 + 1, F.col("length") * 4)))
    return placed.filter("ids_crc32 is not null").select(*out).unionByName(cut.select(*out))


def sequences(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """The packed ids: ``sequence_id``, ``n_tokens``, ``ids`` (unsigned 32-bit), ``doc_ids`` in order."""
    bits = placed.drop("doc_id", "start").join(pieces.select("part", "row", "doc_id", "ids"), ["part", "row"])
    bits = bits.withColumn("ids", F.substring(F.col("ids"), F.col("cut") * 4 + 1, F.col("length") * 4))
    rows = bits.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("p"), F.sum("length").alias("n_tokens"))
    return rows.select("sequence_id", "n_tokens", F.concat_ws("", F.transform("p", lambda x: F.hex(x["ids"]))).alias("h"), F.col("p.doc_id").alias("doc_ids")).select(
        "sequence_id", "n_tokens", F.unhex("h").alias("ids"), "doc_ids"
    )
