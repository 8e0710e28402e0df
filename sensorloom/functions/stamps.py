"""Stamps and names.  Inside the library a stamp is an integer; seconds appear at the edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NANOS = 1_000_000_000


def nanos(sec: Column, nanosec: Column) -> Column:
    return sec.cast("bigint") * NANOS + nanosec.cast("bigint")


def split_nanos(ns: Column) -> tuple[Column, Column]:
    """Whole seconds and remaining nanoseconds."""
    rest = F.pmod(ns, F.lit(NANOS))
    return F.call_function("div", ns - rest, F.lit(NANOS)), rest


def seconds(ns: Column) -> Column:
    return ns.cast("double") / 1e9


def micros(ts: str) -> Column:
    """Microseconds of a timestamp column; the session must run in UTC for zone-less ones."""
    return F.unix_micros(F.col(ts).cast("timestamp"))


def seconds_text(sec: Column) -> Column:
    """Seconds with nine decimals, ``nan`` when missing."""
    return F.when(sec.isNull(), F.lit("nan")).otherwise(F.format_string("%.9f", sec))


def stamp_from_name(name: Column) -> Column:
    """Seconds coded in a file name: extension dropped, ``-`` read as decimal point."""
    return F.replace(F.split(name, r"\.")[0], F.lit("-"), F.lit(".")).cast("double")


def frame_name(idx: Column) -> Column:
    """Eight-digit file stem of a frame index."""
    return F.format_string("%08d", idx)


def qualified_name(group: Column, name: Column) -> Column:
    return F.concat_ws("/", group, name)
