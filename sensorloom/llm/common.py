"""Helpers shared by the operators: intermediate tables, parallelism, connected components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import new_path, shared_dir

# White space and words of the contracts, as patterns of Java and of RE2.
SPACE = r"[\x20\x09-\x0D]+"


def partitions(spark: SparkSession) -> int:
    """Number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends at a table that outlives executors."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        below = shared_dir(spark).split(":", 1)[-1].strip("/") + "/"
        for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
            if below not in folder:
                raise ValueError(f"{folder} is not a table of this session")
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_file`` (a hash of the path) and ``_row``, the place of every row's content.

    A frame that isn't read from files is written to the shared folder first.  Columns of these
    names are an error: see ``set_aside``.
    """
    if clash := {"_file", "_row"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns {sorted(clash)} are reserved here")
    place = [F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    try:
        return docs.select("*", *place)
    except AnalysisException:
        return stored(docs, "content").select("*", *place)


def set_aside(docs: DataFrame, **roles: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """Rename all columns, so that none clashes with those an operator makes.

    ``roles`` gives some columns names: ``set_aside(docs, text="body")`` calls the column ``body``
    ``text``.  The second result brings a frame back to the columns of ``docs`` in their order, and
    ``added`` ones after them; of a name that both have, the added column stays.
    """
    of = {column: role for role, column in roles.items()}
    if missing := [c for c in of if c not in docs.columns]:
        raise ValueError(f"no column {missing}")
    names = [of.get(c, f"_own_{i}") for i, c in enumerate(docs.columns)]

    def back(frame: DataFrame, *added: str) -> DataFrame:
        kept = [F.col(mine).alias(c) for mine, c in zip(names, docs.columns) if c not in added]
        return frame.select(*kept, *added)

    return docs.select(*[F.col(f"`{c}`").alias(mine) for mine, c in zip(names, docs.columns)]), back


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest node of every node's connected component, for nodes that have an edge.

    ``edges`` has columns ``a`` and ``b`` of one orderable type.  Every round gives each node the
    smallest node among itself and its neighbours, then lets nodes point to where that one
    points; the number of rounds grows with the logarithm of the longest path.  A hub's
    neighbours are reduced by partial minima before the shuffle, so its rows meet in no task.
    Returns ``node`` and ``root``.
    """
    edges = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = stored(edges, name)
    tree = None
    while True:
        # Every node's smallest neighbour (or itself), then where that one points.
        both = edges.select(F.col("b").alias("node"), F.col("a").alias("to")).union(edges.select(F.col("a").alias("node"), F.col("a").alias("to")))
        first = stored(both.groupBy("node").agg(F.min("to").alias("root")), name)
        low = stored(_point_on(first, first), name)
        before, tree = [first, edges], low if tree is None else stored(_point_on(was := tree, low), name)
        if tree is not low:
            before.append(was)
        # Edges between nodes that still point apart.
        edges = stored(
            edges.join(low.select(F.col("node").alias("a"), F.col("root").alias("_a")), "a")
            .join(low.select(F.col("node").alias("b"), F.col("root").alias("_b")), "b")
            .filter("_a <> _b")
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
            .distinct(),
            name,
        )
        discard(*before, *([low] if tree is not low else []))
        if edges.isEmpty():
            return tree


def _point_on(tree: DataFrame, by: DataFrame) -> DataFrame:
    up = by.select(F.col("node").alias("root"), F.col("root").alias("_up"))
    return tree.join(up, "root", "left").select("node", F.coalesce("_up", "root").alias("root"))
