"""Registered queries over the given tables, each with its SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions.stamps import micros

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function ``Tables -> DataFrame`` under its name."""

    def add(fn):
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__, run.__doc__ = key, fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql
        return fn

    return add


def components(embeddings: DataFrame, n: int) -> DataFrame:
    """The first components of vectors as double columns ``e0 …``."""
    return embeddings.selectExpr("vec_id", "label", *[f"cast(embedding[{i}] as double) as e{i}" for i in range(n)])


class Tables:
    """The given tables by name, and the reading of some as sensor data."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table

    def log(self) -> DataFrame:
        """events as a message log: topic, run, arrival number, stamp and payload."""
        return self.events.select(
            F.col("event_type").alias("topic"),
            F.col("user_id").alias("run"),
            F.col("event_id").alias("seq"),
            micros("ts").alias("t"),
            "value",
            "props",
        )

    def vectors(self, n: int = 64) -> DataFrame:
        """embeddings with the first components as double columns ``e0 …``."""
        return components(self.embeddings, n)

    def edges(self) -> DataFrame:
        """Frame tree map > region > nation > customer."""
        region = self.region.select(F.col("r_name").alias("child"), F.lit("map").alias("parent"))
        nation = self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_name").alias("child"), F.col("r_name").alias("parent")
        )
        customer = self.customer.join(self.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_name").alias("child"), F.col("n_name").alias("parent")
        )
        return region.unionByName(nation).unionByName(customer)


# The same reading in SQL, for use as a common table expression.
LOG = """log AS (SELECT event_type AS topic, user_id AS run, event_id AS seq, epoch_us(ts) AS t, value, props FROM events)"""
EDGES = """edges AS (
  SELECT r_name AS child, 'map' AS parent FROM region
  UNION ALL SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def vectors_sql(n: int) -> str:
    parts = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(n))
    return f"v AS (SELECT vec_id, label, {parts} FROM embeddings)"


TOPICS = ["click", "error", "purchase", "signup", "view"]
TOPIC_ROWS = "(VALUES ('click'),('error'),('purchase'),('signup'),('view')) AS topics(topic)"
SECOND = 1_000_000
HOUR = 3600 * SECOND
