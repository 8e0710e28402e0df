"""Queries on images, grids and feature key lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.functions import keys as k
from sensorloom.operators import raster
from sensorloom.operators.skew import join_hot
from sensorloom.plans.registry import query

PIXEL = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
PIXEL_SQL = ", ".join(PIXEL)
BOUNDS = """b AS (SELECT l_suppkey AS f, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY l_suppkey),
r AS (SELECT l_suppkey AS f, l_extendedprice AS x, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice) - 1 AS i, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem),
k AS (SELECT f, max(CASE WHEN i = round_even(n * 0.01::DOUBLE, 0) THEN x END) AS lower, max(CASE WHEN i = round_even(n * 0.99::DOUBLE, 0) - 1 THEN x END) AS upper FROM r GROUP BY f)"""


@query(
    f"""WITH {BOUNDS} SELECT {PIXEL_SQL}, l_extendedprice, CASE WHEN hi > lo THEN CAST(trunc((l_extendedprice - lo) / (hi - lo) * 255.0) AS INTEGER) END AS level
FROM lineitem JOIN b ON l_suppkey = f"""
)
def minmax_scale(t):
    """Pixels stretched to 0…255 per image."""
    rows = t.lineitem.select(*PIXEL, "l_extendedprice")
    return raster.normalise(rows, ["l_suppkey"], "l_extendedprice", ["l_orderkey", "l_partkey"], raster.MINMAX).select(
        *PIXEL, "l_extendedprice", "level"
    )


@query(
    f"""WITH {BOUNDS} SELECT {PIXEL_SQL}, l_extendedprice,
CASE WHEN upper > lower THEN CAST(trunc((least(greatest(l_extendedprice, lower), upper) - lower) / (upper - lower) * 255.0) AS INTEGER) END AS level
FROM lineitem JOIN k ON l_suppkey = k.f"""
)
def rank_clip(t):
    """Pixels clipped to the 1 % and 99 % ranks of their image, then stretched."""
    rows = t.lineitem.select(*PIXEL, "l_extendedprice")
    return raster.normalise(rows, ["l_suppkey"], "l_extendedprice", ["l_orderkey", "l_partkey"], raster.RANKED).select(
        *PIXEL, "l_extendedprice", "level"
    )


@query(
    f"""WITH {BOUNDS} SELECT {PIXEL_SQL}, l_extendedprice,
CASE WHEN hi < 35000 THEN CASE WHEN hi > lo THEN CAST(trunc((l_extendedprice - lo) / (hi - lo) * 255.0) AS INTEGER) END
  WHEN upper > lower THEN CAST(trunc((least(greatest(l_extendedprice, lower), upper) - lower) / (upper - lower) * 255.0) AS INTEGER) END AS level
FROM lineitem JOIN k ON l_suppkey = k.f JOIN b ON l_suppkey = b.f"""
)
def adaptive_clip(t):
    """Dark images stretched whole, bright ones between their rank bounds."""
    rows = t.lineitem.select(*PIXEL, "l_extendedprice")
    return raster.normalise(rows, ["l_suppkey"], "l_extendedprice", ["l_orderkey", "l_partkey"], raster.ADAPTIVE).select(
        *PIXEL, "l_extendedprice", "level"
    )


@query(
    """SELECT l_suppkey, round(quantile_cont(l_extendedprice, 0.05), 6) AS p05, round(quantile_cont(1 / (l_extendedprice + 1e-6), 0.95), 12) AS inv95
FROM lineitem WHERE l_extendedprice <> 0 GROUP BY l_suppkey"""
)
def depth_percentile(t):
    """5 % of non-zero depth and 95 % of inverse depth per image, exact."""
    rows = t.lineitem.select("l_suppkey", "l_extendedprice").filter(F.col("l_extendedprice") != 0)
    rows = rows.withColumn("inv", raster.inverse_depth(F.col("l_extendedprice")))
    low = raster.percentile(rows, ["l_suppkey"], "l_extendedprice", 0.05, "p05")
    high = raster.percentile(rows, ["l_suppkey"], "inv", 0.95, "inv95")
    return low.join(high, "l_suppkey").select(
        "l_suppkey", F.round("p05", 6).alias("p05"), F.round("inv95", 12).alias("inv95")
    )


@query(
    f"""SELECT {PIXEL_SQL}, 1 / (CASE WHEN l_linenumber = 1 THEN 0.0 ELSE l_quantity END + 1e-6::DOUBLE) AS inverse FROM lineitem"""
)
def inverse_depth(t):
    """Inverse depth with NaN read as zero."""
    depth = F.when(F.col("l_linenumber") == 1, F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    return t.lineitem.select(*PIXEL, raster.inverse_depth(depth).alias("inverse"))


@query(
    f"""SELECT {PIXEL_SQL}, CAST(trunc(l_discount * 255) AS INTEGER) * 65536 + CAST(trunc(l_tax * 255) AS INTEGER) * 256 + CAST(trunc(l_quantity / 255 * 255) AS INTEGER) AS rgb
FROM lineitem"""
)
def rgb_pack(t):
    """Three channels packed into one number."""
    rgb = raster.pack_rgb(F.col("l_discount"), F.col("l_tax"), F.col("l_quantity") / 255)
    return t.lineitem.select(*PIXEL, rgb.alias("rgb"))


@query(
    """SELECT l_suppkey, l_linenumber, l_partkey, l_orderkey, l_quantity FROM lineitem WHERE l_quantity - 25 <> 0"""
)
def sparse_pixels(t):
    """Coordinates and values of non-empty pixels."""
    return t.lineitem.filter(F.col("l_quantity") - 25 != 0).select(
        "l_suppkey", "l_linenumber", "l_partkey", "l_orderkey", "l_quantity"
    )


@query(
    """WITH m AS (SELECT l_suppkey, max(l_tax * 12.6) AS top FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, top > 1 AS over, round(CASE WHEN top <= 1 THEN l_tax * 12.6 * 255 ELSE l_tax * 12.6 END, 6) AS scaled
FROM lineitem JOIN m USING (l_suppkey)"""
)
def range_flag(t):
    """Images beyond the unit range are flagged and left alone; others are scaled to 0…255."""
    rows = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_tax") * 12.6).alias("x"))
    top = rows.groupBy("l_suppkey").agg(F.max("x").alias("top"))
    flagged = join_hot(rows, top, ["l_suppkey"], ["l_orderkey", "l_partkey"], "inner")
    scaled = F.when(F.col("top") <= 1, F.col("x") * 255).otherwise(F.col("x"))
    return flagged.select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", (F.col("top") > 1).alias("over"), F.round(scaled, 6).alias("scaled")
    )


@query(
    f"""WITH c AS (SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN '{raster.MASK_SOURCE}' ELSE l_returnflag END AS layer, l_discount * 2 AS value FROM lineitem),
a AS (SELECT * FROM c UNION ALL SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber, '{raster.MASK_LAYER}', CASE WHEN value >= 0.1 THEN value END FROM c WHERE layer = '{raster.MASK_SOURCE}'
  UNION ALL SELECT DISTINCT l_suppkey, l_partkey, l_orderkey, l_linenumber, '{raster.FLAT_LAYER}', 0.0::DOUBLE FROM c)
SELECT l_suppkey, layer, count(*) AS n, count(value) AS n_valid, round(sum(value), 6) AS total FROM a GROUP BY l_suppkey, layer"""
)
def derived_layers(t):
    """Grid layers with the visible mask and a flat layer added, summed up."""
    cells = t.lineitem.select(
        "l_suppkey", "l_partkey", "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "A", F.lit(raster.MASK_SOURCE)).otherwise(F.col("l_returnflag")).alias("layer"),
        (F.col("l_discount") * 2).alias("value"),
    )
    valid = F.when(~F.isnan("value"), F.col("value"))
    return raster.derived_layers(cells, "layer", "value").groupBy("l_suppkey", "layer").agg(
        F.count(F.lit(1)).alias("n"), F.count(valid).alias("n_valid"), F.round(F.sum(valid), 6).alias("total")
    )


WANTED = ["widget", "red", "small", "hot"]


@query(
    """WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS have FROM part)
SELECT p_partkey, array_to_string(list_filter(['widget', 'red', 'small', 'hot'], lambda l: list_contains(have, l)), '|') AS kept,
len(list_filter(['widget', 'red', 'small', 'hot'], lambda l: list_contains(have, l))) < 4 AS missing FROM w"""
)
def layer_subset(t):
    """Wanted layers in the wanted order, with a flag for missing ones."""
    kept, missing = raster.layer_subset(F.split("p_name", " "), WANTED)
    return t.part.select("p_partkey", F.array_join(kept, "|").alias("kept"), missing.alias("missing"))


@query(
    """WITH l AS (SELECT p_partkey, string_split(p_name, ' ') || [p_brand] AS labels, [p_type, p_type, 'brand'] AS meta, 'feat_' || p_size AS extra FROM part)
SELECT p_partkey, 4 AS n, CAST(list_position(labels, 'widget') - 1 AS BIGINT) AS at_widget,
CASE WHEN labels[1] = 'red' AND meta[1] = 'SMALL' THEN 0 WHEN labels[2] = 'red' AND meta[2] = 'SMALL' THEN 1 END::BIGINT AS at_pair,
'2' AS at_brand, labels[3] || ', brand' AS dumped, list_contains(labels, 'red') AS has_red, labels[2] AS sliced, labels[3] || '|' || labels[1] AS taken,
true AS same_after_load, list_contains(labels, 'red') AND list_contains(labels, 'widget') AS has_all, 'feat' AS prefix,
CASE WHEN labels[1] = labels[2] THEN labels[1] || ' (' || p_type || ') x2' ELSE labels[1] || ' (' || p_type || ') x1, ' || labels[2] || ' (' || p_type || ') x1' END
  || ', ' || labels[3] || ' (brand) x1, feat (rand) x2' AS condensed
FROM l JOIN part USING (p_partkey)"""
)
def keylist_ops(t):
    """Key lists: concatenation, look-up, slices, text form and comparison."""
    names = F.concat(F.split("p_name", " "), F.array("p_brand"))
    meta = F.array(F.col("p_type"), F.col("p_type"), F.lit("brand"))
    extra = F.array(F.struct(F.concat(F.lit("feat_"), F.col("p_size").cast("string")).alias("label"), F.lit("rand").alias("metainfo")))
    base = t.part.select("p_partkey", k.key_list(names, meta).alias("base"), extra.alias("extra"))
    both = base.withColumn("keys", k.concat(F.col("base"), F.col("extra")))
    keys, short = F.col("keys"), F.col("base")
    return both.select(
        "p_partkey",
        k.length(keys).alias("n"),
        k.find(keys, "widget").alias("at_widget"),
        k.find_pair(keys, F.lit("red"), F.lit("SMALL")).alias("at_pair"),
        F.array_join(k.index_metainfo(keys, F.lit("brand")).cast("array<string>"), "|").alias("at_brand"),
        F.array_join(k.dump(k.filter_metainfo(keys, F.lit("brand"))), "|").alias("dumped"),
        k.has_label(keys, F.lit("red")).alias("has_red"),
        F.array_join(k.labels(k.part(keys, 1, 2)), "|").alias("sliced"),
        F.array_join(k.labels(k.take(keys, F.lit([2, 0]))), "|").alias("taken"),
        k.equal(k.load(k.dump(keys)), keys).alias("same_after_load"),
        k.has_all_labels(keys, F.lit(["red", "widget"])).alias("has_all"),
        k.prefix(F.get(k.labels(keys), F.lit(3))).alias("prefix"),
        k.condense(k.concat(keys, F.col("extra"))).alias("condensed"),
    )


# Fixed values of the rectification query: raw camera, distortion, new camera, image size.
RAW, DISTORTION, NEW = (40.0, 40.0, 8.0, 8.0), (-0.2, 0.05, 0.001, -0.001, 0.0), (38.0, 38.0, 8.0, 8.0)


@query(
    """WITH px AS (SELECT l_suppkey AS f, CAST(l_partkey % 16 AS INTEGER) AS u, CAST(l_orderkey % 16 AS INTEGER) AS v, max(l_quantity) AS g FROM lineitem GROUP BY ALL),
c AS (SELECT *, (u - 8.0::DOUBLE) / 38.0 AS x, (v - 8.0::DOUBLE) / 38.0 AS y FROM px),
r AS (SELECT *, x * x + y * y AS r2 FROM c),
d AS (SELECT *, 1 + r2 * (-0.2::DOUBLE + r2 * (0.05::DOUBLE + r2 * 0.0)) AS radial FROM r),
s AS (SELECT f, u, v, (x * radial + x * y * 0.002::DOUBLE + (r2 + x * x * 2) * -0.001::DOUBLE) * 40 + 8 AS us, (y * radial + (r2 + y * y * 2) * 0.001::DOUBLE + x * y * -0.002::DOUBLE) * 40 + 8 AS vs FROM d),
q AS (SELECT f, u, v, CAST(floor(us) + du AS INTEGER) AS su, CAST(floor(vs) + dv AS INTEGER) AS sv, (1 - abs(us - floor(us) - du)) * (1 - abs(vs - floor(vs) - dv)) AS w
  FROM s, (VALUES (0), (1)) a(du), (VALUES (0), (1)) b(dv))
SELECT q.f, q.u, q.v, round(sum(w * coalesce(px.g, 0)), 6) AS g FROM q LEFT JOIN px ON px.f = q.f AND px.u = su AND px.v = sv GROUP BY q.f, q.u, q.v"""
)
def rectify_map(t):
    """Images undistorted by bilinear sampling."""
    px = t.lineitem.groupBy(
        F.col("l_suppkey").alias("f"),
        (F.col("l_partkey") % 16).cast("int").alias("u"),
        (F.col("l_orderkey") % 16).cast("int").alias("v"),
    ).agg(F.max("l_quantity").alias("g"))
    out = raster.rectify(px, ["f"], "g", RAW, DISTORTION, NEW, "plumb_bob")
    return out.withColumn("g", F.round("g", 6))
