"""Registered queries over ``documents``: thin uses of the operators at their production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import exact_dedup, langid, line_dedup, mixing, packing, runs, simhash, surrogates, token_file, toxicity, weighted
from sensorloom.llm.common import stored
from sensorloom.llm.registry import query, table
from sensorloom.session import new_path

# A secret in production; fixed here so that reruns agree.
SURROGATE_KEY = b"registered query"


@query()
def op1_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token file of all documents, written and read back: place, length and checksum of every document's ids."""
    path = new_path(spark, "tokens")
    token_file.write_token_file(table(spark, sf_dir, "documents"), path)
    read = token_file.read_token_file(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query(
    r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents)
SELECT doc_id,
  first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
  count(*) OVER (PARTITION BY h) AS group_size,
  row_number() OVER (PARTITION BY h ORDER BY n DESC, doc_id) = 1 AS kept,
  h AS text_sha256
FROM d"""
)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of every group of equal texts stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("_file", "_row")


@query()
def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query()
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    prints = stored(simhash.fingerprints(table(spark, sf_dir, "documents")), "simhash-prints")
    groups = simhash.near_groups(prints)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in packed sequences."""
    return packing.pack(table(spark, sf_dir, "documents")).select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query()
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the folds that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", langid.held_out())
    net = langid.fit(docs.filter("not held_out"))
    return langid.predict(docs.select("doc_id", "text", "held_out"), net).select("doc_id", "held_out", "lang_pred", "score")


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the labels that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", toxicity.held_out())
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs.filter("not held_out"), labels=labels)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op2_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, with their likeness and that of the next document."""
    return weighted.fingerprint_with_edits(table(spark, sf_dir, "documents"))


@query()
def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of all documents with surrogates for personal data."""
    return surrogates.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key=SURROGATE_KEY)


@query(
    r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
many AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (key IN (FROM many)) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (key NOT IN (FROM many)), '')) AS kept_sha256
FROM keyed GROUP BY doc_id"""
)
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten documents share."""
    found = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in a tenth of the documents, the words from one on repeat with a period, both drawn from the identifier."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("words"))
    n = F.size("words")
    placed = words.withColumn("a", (F.col("g") % F.when(n > 0, n)).cast("int"))
    period = placed.withColumn("p", (F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8))).cast("int"))
    turns = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), turns))
    moved = F.concat(F.slice("words", 1, F.col("a")), F.slice(again, 1, n - F.col("a")))
    planted = (F.col("h") % 10 == 0) & (n > 0)
    return period.select("doc_id", F.when(planted, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest run, digest of all runs and collapsed text of every document."""
    found = runs.periodic_runs(planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text")))
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("by"), r["start"].alias("start"), r["period"].alias("period"))))
    rows = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(rows, "\n"), F.lit("\n"))).otherwise("")
    each = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), first.alias("first"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length = -F.col("first.by")
    return each.select(
        "doc_id",
        "n_runs",
        F.col("first.start").alias("start"),
        length.alias("length"),
        F.col("first.period").alias("period"),
        F.floor(1000 * length / F.col("first.period")).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
