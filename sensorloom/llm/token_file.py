"""Token files: a concatenated id array with Elias-Fano coded document ends.

Documents are dealt by range of their id, in order, and encoded where they lie.  A file is a
folder that Spark writes and commits: one row per block of whole documents, with the block's
ids, its documents' ends as an Elias-Fano sequence, and a select index.  Ends count from the
block's first id, so no table of 64-bit offsets is kept: an end takes about
``2 + log2(ids per document)`` bits.  Blocks know how many ids precede them in their part;
only one total per part is summed up when a file is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log2

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import partitions
from sensorloom.llm.tokens import default_vocabulary, encoder

BLOCK_IDS = 1 << 18
BLOCK_DOCS = 1 << 16
END_ID = 0
SELECT_EVERY = 64

SCHEMA = """part int, block int, first long, n_ids long, doc_ids array<long>, low_bits int, low binary, high binary,
index binary, width int, ids binary"""


class EliasFano:
    """A non-decreasing sequence of integers in near-minimal space.

    The ``low_bits`` lower bits of every value stand packed in ``low``; the rest stand in unary
    in ``high``, where value ``i`` sets bit ``(value >> low_bits) + i``.  ``index`` holds the
    place of every 64th set bit, from which ``select`` counts on.
    """

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, index: bytes):
        self.n, self.low_bits, self.low, self.high, self.index = n, low_bits, low, high, index

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if n == 0:
            return cls(0, 0, b"", b"", b"")
        bits = max(0, floor(log2(max(1, int(values[-1])) / n)))
        shifts = np.arange(bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1, np.uint8)
        high[places] = 1
        return cls(n, bits, low, np.packbits(high, bitorder="little").tobytes(), places[::SELECT_EVERY].astype("<u4").tobytes())

    def _low(self, i: int) -> int:
        start = i * self.low_bits
        word = int.from_bytes(self.low[start >> 3 : (start + self.low_bits + 7 >> 3) or None], "little") if self.low_bits else 0
        return word >> (start & 7) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Value ``i``, read from a few bytes."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place = int(np.frombuffer(self.index, "<u4", 1, i // SELECT_EVERY * 4)[0])
        left, at = i % SELECT_EVERY, place >> 3
        byte = self.high[at] >> (place & 7) << (place & 7)
        while (ones := byte.bit_count()) <= left:
            left, at = left - ones, at + 1
            byte = self.high[at]
        for _ in range(left):
            byte &= byte - 1
        place = at * 8 + (byte & -byte).bit_length() - 1
        return (place - i) << self.low_bits | self._low(i)

    def values(self) -> np.ndarray:
        """All values."""
        places = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.n]
        high = (places - np.arange(self.n)) << self.low_bits
        if not self.low_bits:
            return high
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), count=self.n * self.low_bits, bitorder="little")
        return high + bits.reshape(self.n, self.low_bits) @ (1 << np.arange(self.low_bits))


def write_token_file(docs: DataFrame, path: str, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append the end id, and write the ids in ascending order of ``id_col``.

    A null text counts as empty and yields the end id alone; null ids come first; rows with one
    id are ordered by text.  An empty table gives a file without blocks; other columns are not
    read.  A block holds whole documents, so a text needs to fit in a worker, as it does anyway.
    """
    spark, vocabulary = docs.sparkSession, vocabulary or default_vocabulary()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    placed = rows.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = encoder(vocabulary), TaskContext.get().partitionId()
        width = 2 if tokens.tokenizer.get_vocab_size() <= 1 << 16 else 4
        end = np.array([END_ID], "<u4").tobytes()
        names, ends, held, first, block = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4").astype(f"<u{width}")
            ef = EliasFano.encode(ends)
            columns = [[part], [block], [first], [len(ids)], [names], [ef.low_bits], [ef.low], [ef.high], [ef.index], [width], [ids.tobytes()]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], COLUMNS)

        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            for name, ids in zip(batch.column(0).to_pylist(), tokens.texts(texts)):
                ids += end
                names.append(name)
                held.append(ids)
                ends.append((ends[-1] if ends else 0) + len(ids) // 4)
                if ends[-1] >= BLOCK_IDS or len(names) >= BLOCK_DOCS:
                    yield close()
                    first, block = first + ends[-1], block + 1
                    names, ends, held = [], [], []
        if names:
            yield close()

    placed.mapInArrow(encode, SCHEMA).write.option("compression", "zstd").parquet(path)


COLUMNS = [c.split()[0] for c in SCHEMA.replace("\n", " ").split(", ")]


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a file: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids`` (unsigned 32-bit)."""
    blocks = spark.read.schema(SCHEMA).parquet(path)
    # One row per written part: as many as the writing job had tasks.
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n = len(r["doc_ids"])
                ends = EliasFano(n, r["low_bits"], r["low"], r["high"], r["index"]).values().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                ids = np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["part"]] * n, pa.int32()),
                        pa.array(r["doc_ids"], pa.int64()),
                        pa.array(starts + r["first"]),
                        pa.array(ends - starts),
                        pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    ],
                    ["part", "doc_id", "start", "n_tokens", "ids"],
                )

    docs = blocks.mapInArrow(decode, "part int, doc_id long, start long, n_tokens long, ids binary")
    return docs.join(F.broadcast(before), "part").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids")
