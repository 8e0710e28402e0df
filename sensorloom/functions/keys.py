"""Feature key lists: arrays of ``(label, metainfo)`` structs that name tensor channels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_list(labels: Column, metainfo: Column) -> Column:
    return F.zip_with(labels, metainfo, lambda l, m: F.struct(l.alias("label"), m.alias("metainfo")))


def labels(keys: Column) -> Column:
    return F.transform(keys, lambda k: k.getField("label"))


def metainfo(keys: Column) -> Column:
    return F.transform(keys, lambda k: k.getField("metainfo"))


def length(keys: Column) -> Column:
    return F.size(keys)


def index(keys: Column, label: str) -> Column:
    """0-based position of a label; an error if it is missing."""
    at = F.array_position(labels(keys), label)
    return F.when(at > 0, at - 1).otherwise(F.raise_error(F.lit(f"no label {label}")).cast("bigint"))


def find(keys: Column, label: str) -> Column:
    """0-based position of a label, or null."""
    at = F.array_position(labels(keys), label)
    return F.when(at > 0, at - 1)


def find_pair(keys: Column, label: Column, meta: Column) -> Column:
    """0-based position of a label and metainfo pair, or null."""
    at = F.array_position(keys, F.struct(label.alias("label"), meta.alias("metainfo")))
    return F.when(at > 0, at - 1)


def index_pair(keys: Column, label: str, meta: str) -> Column:
    at = find_pair(keys, F.lit(label), F.lit(meta))
    return F.coalesce(at, F.raise_error(F.lit(f"no pair ({label}, {meta})")).cast("bigint"))


def index_metainfo(keys: Column, meta: Column) -> Column:
    """Positions whose metainfo matches."""
    at = F.transform(keys, lambda k, i: F.when(k.getField("metainfo") == meta, i))
    return F.filter(at, lambda i: i.isNotNull())


def filter_metainfo(keys: Column, meta: Column) -> Column:
    return F.filter(keys, lambda k: k.getField("metainfo") == meta)


def has_label(keys: Column, label: Column) -> Column:
    return F.exists(keys, lambda k: k.getField("label") == label)


def has_all_labels(keys: Column, wanted: Column) -> Column:
    return F.size(F.array_except(wanted, labels(keys))) == 0


def part(keys: Column, start: int, stop: int) -> Column:
    """Half-open slice by position."""
    return F.slice(keys, start + 1, max(0, stop - start))


def take(keys: Column, positions: Column) -> Column:
    """Entries at the given positions."""
    return F.transform(positions, lambda i: F.get(keys, i))


def concat(a: Column, b: Column) -> Column:
    return F.concat(a, b)


def equal(a: Column, b: Column) -> Column:
    """Equality of labels; metainfo does not count."""
    return labels(a) == labels(b)


def dump(keys: Column) -> Column:
    """``"label, metainfo"`` strings."""
    return F.transform(keys, lambda k: F.concat_ws(", ", k.getField("label"), k.getField("metainfo")))


def load(lines: Column) -> Column:
    """Key list of ``"label, metainfo"`` strings."""
    def entry(line):
        parts = F.split(line, ", ")
        return F.struct(F.get(parts, F.lit(0)).alias("label"), F.get(parts, F.lit(1)).alias("metainfo"))

    return F.transform(lines, entry)


def prefix(label: Column) -> Column:
    """Label without its last ``_part`` if it has a numbered part, else the label itself."""
    return F.when(label.rlike(r"^.+_\d+"), F.regexp_replace(label, "_[^_]*$", "")).otherwise(label)


def condense(keys: Column) -> Column:
    """``prefix (metainfo) xN`` of neighbouring similar keys, joined by commas."""
    runs = F.aggregate(
        keys,
        F.expr("cast(array() as array<struct<p:string,m:string,n:int>>)"),
        lambda acc, k: F.when(
            (F.size(acc) > 0)
            & (F.try_element_at(acc, F.lit(-1)).getField("p") == prefix(k.getField("label")))
            & (F.try_element_at(acc, F.lit(-1)).getField("m") == k.getField("metainfo")),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        prefix(k.getField("label")).alias("p"),
                        k.getField("metainfo").alias("m"),
                        (F.try_element_at(acc, F.lit(-1)).getField("n") + 1).alias("n"),
                    )
                ),
            ),
        ).otherwise(
            F.concat(
                acc,
                F.array(
                    F.struct(
                        prefix(k.getField("label")).alias("p"), k.getField("metainfo").alias("m"), F.lit(1).alias("n")
                    )
                ),
            )
        ),
    )
    return F.array_join(
        F.transform(runs, lambda r: F.concat(r.getField("p"), F.lit(" ("), r.getField("m"), F.lit(") x"), r.getField("n").cast("string"))),
        ", ",
    )
