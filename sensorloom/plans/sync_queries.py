"""Queries on the message log: grids, as-of matching, validity, interpolation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.model import REGISTRY, registry_table
from sensorloom.operators import asof, audit, interp, queued, sync
from sensorloom.operators.ordered import index_rows, split_points
from sensorloom.operators.skew import join_hot
from sensorloom.plans.export import synchronise
from sensorloom.plans.registry import HOUR, LOG, SECOND, TOPIC_ROWS, TOPICS, query

TOL = HOUR // 2

GRID = f"""{LOG},
b AS (SELECT min(t) AS s, max(t) AS e FROM log),
steps AS (SELECT s, unnest(range(0, CAST((e - s + {HOUR - 1}) // {HOUR} AS BIGINT))) AS idx FROM b),
grid AS (SELECT idx, s + idx * {HOUR} AS target FROM steps),
tg AS (SELECT topic, idx, target FROM grid CROSS JOIN {TOPIC_ROWS})"""
BACK = f"""{GRID},
m AS (SELECT tg.topic, idx, target, log.t AS match, target - log.t AS err
      FROM tg ASOF LEFT JOIN log ON tg.topic = log.topic AND log.t <= tg.target)"""


def backward(t):
    """Latest message per topic and hour, with its error; other query modules use it, too."""
    log = t.log()
    return asof.match_grid(log, asof.grid_bounds(log, [], "t", HOUR), TOPICS, HOUR)


@query(f"WITH {LOG} SELECT seq, topic, t, value FROM log WHERE topic IN ('click', 'view')")
def scan_topics(t):
    """Messages of the configured topics; the filter reaches the Parquet scan."""
    return t.log().filter(F.col("topic").isin("click", "view")).select("seq", "topic", "t", "value")


@query(f"WITH {GRID} SELECT idx, target FROM grid")
def time_grid(t):
    """Hourly targets over the whole log, end excluded."""
    return asof.time_grid(asof.grid_bounds(t.log(), [], "t", HOUR), [], HOUR)


@query(f"WITH {BACK} SELECT topic, idx, target, match, err FROM m")
def sync_backward(t):
    """Latest message of every topic at or before every hour."""
    return backward(t)


@query(
    f"""WITH {GRID},
p AS (SELECT tg.*, log.t AS pt, log.seq AS ps FROM tg ASOF LEFT JOIN log ON tg.topic = log.topic AND log.t <= tg.target),
n AS (SELECT p.*, log.t AS nt, log.seq AS ns FROM p ASOF LEFT JOIN log ON p.topic = log.topic AND log.t >= p.target),
c AS (SELECT *, CASE WHEN nt IS NULL THEN pt WHEN pt IS NULL THEN nt
        WHEN target - pt < nt - target OR (target - pt = nt - target AND ps < ns) THEN pt ELSE nt END AS match FROM n)
SELECT topic, idx, target, match, abs(target - match) AS err FROM c"""
)
def sync_nearest(t):
    """Nearest message of every topic on either side of every hour."""
    log = t.log()
    return asof.match_grid(log, asof.grid_bounds(log, [], "t", HOUR), TOPICS, HOUR, nearest=True)


@query(f"WITH {BACK} SELECT topic, idx, target, match, err FROM m WHERE err < {TOL}")
def sync_tolerance(t):
    """Matches strictly within the tolerance."""
    return sync.within_tolerance(backward(t), TOL)


@query(
    f"""WITH {BACK}
SELECT idx, target, bool_and(coalesce(err < {TOL}, false)) AS valid FROM m GROUP BY idx, target"""
)
def valid_mask(t):
    """Steps at which every topic is in tolerance."""
    return sync.valid_steps(backward(t), TOL)


@query(
    f"""WITH {BACK},
k AS (SELECT idx, target FROM m GROUP BY idx, target HAVING bool_and(coalesce(err < {TOL}, false)))
SELECT idx, target, row_number() OVER (ORDER BY target) - 1 AS frame FROM k"""
)
def reindex(t):
    """Valid steps numbered without gaps."""
    return synchronise(t.log(), TOPICS, HOUR, TOL).frames.select("idx", "target", "frame")


@query(
    f"""WITH {BACK},
s AS (SELECT idx, bool_and(coalesce(err < {TOL}, false)) AS valid FROM m GROUP BY idx),
r AS (SELECT count(*) FILTER (WHERE valid) AS kept, count(*) AS total FROM s)
SELECT topic, count(*) FILTER (WHERE coalesce(err >= {TOL}, true)) AS bad, any_value(kept) AS kept, any_value(total) AS total
FROM m, r GROUP BY topic"""
)
def sync_report(t):
    """Steps kept, and out of tolerance per topic."""
    return sync.sync_report(backward(t), TOL)


@query(
    f"""WITH {BACK},
w AS (SELECT topic, t AS match, arg_max(value, seq) AS value, max(seq) AS seq FROM log GROUP BY topic, t)
SELECT m.topic, idx, target, match, err, value, seq FROM m JOIN w USING (topic, match)"""
)
def attach_payload(t):
    """Matched steps with the payload of their stamp."""
    return sync.attach_payload(backward(t), t.log(), ["topic"], ["value", "seq"])


PERIOD = 173 * SECOND
BASE = 1_704_067_200 * SECOND


@query(
    f"""WITH {LOG},
f AS (SELECT o_orderkey, {BASE} + o_orderkey * {PERIOD} AS t FROM orders),
p AS (SELECT f.*, log.t AS pt, log.seq AS ps FROM f ASOF LEFT JOIN log ON log.t <= f.t),
n AS (SELECT p.*, log.t AS nt, log.seq AS ns FROM p ASOF LEFT JOIN log ON log.t >= p.t),
c AS (SELECT t, CASE WHEN nt IS NULL THEN ps WHEN pt IS NULL THEN ns
        WHEN t - pt < nt - t OR (t - pt = nt - t AND ps < ns) THEN ps ELSE ns END AS match_seq,
        least(coalesce(t - pt, nt - t), coalesce(nt - t, t - pt)) AS err FROM n)
SELECT row_number() OVER (ORDER BY t) - 1 AS idx, t, match_seq, err FROM c WHERE err <= {60 * SECOND}"""
)
def nearest_cutoff(t):
    """Frames with a message at most one minute away, numbered without gaps.

    A frame whose stamp lies beyond the 64-bit range is far from every message.
    """
    stamp = F.try_add(F.lit(BASE), F.try_multiply(F.col("o_orderkey"), F.lit(PERIOD)))
    frames = t.orders.select(stamp.alias("t")).filter(F.col("t").isNotNull())
    log = t.log()
    splits = split_points(frames.unionAll(log.select("t")), ["t"])
    found = asof.match_nearest(frames, log, [], cutoff=60 * SECOND, splits=splits)
    return index_rows(found.select("t", F.col("match.s").alias("match_seq"), "err"), [], ["t"], splits=splits)


# The catalogue of the fan-out query: one topic feeds two outputs.
OUTPUTS = [("sensors", "fast", "click"), ("sensors", "slow", "click"), ("state", "view", "view"), ("state", "buy", "purchase")]


@query(
    f"""WITH {LOG}
SELECT grp || '/' || name AS output, seq, value FROM log JOIN (VALUES {", ".join(map(str, OUTPUTS))}) c(grp, name, topic) USING (topic)"""
)
def topic_fanout(t):
    """Every message once per catalogue entry of its topic."""
    catalog = t.spark.createDataFrame(OUTPUTS, "grp string, name string, topic string")
    out = sync.fan_out(t.log().select("topic", "seq", "value"), catalog)
    return out.select(F.concat_ws("/", "grp", "name").alias("output"), "seq", "value")


@query(
    r"""WITH p AS (SELECT page_id, url, length(html) AS size, regexp_extract(url, '//([^/]+)', 1) AS host FROM pages),
img AS (SELECT page_id, '/' || host || CASE WHEN contains(url, '?') THEN '/image_raw/compressed'
          WHEN contains(url, '#') THEN '/image/compressed' ELSE '/compressed' END AS topic, host FROM p),
info AS (SELECT '/' || host || '/camera_info' AS info_topic, max(size) AS size FROM p WHERE starts_with(url, 'https') GROUP BY host)
SELECT page_id, topic, '/' || host || '/camera_info' AS info_topic, size FROM img LEFT JOIN info
  ON '/' || img.host || '/camera_info' = info.info_topic"""
)
def derived_key_join(t):
    """Image topics with the calibration topic derived from their name, where one exists."""
    host = F.regexp_extract("url", "//([^/]+)", 1)
    suffix = (
        F.when(F.contains("url", F.lit("?")), "/image_raw/compressed")
        .when(F.contains("url", F.lit("#")), "/image/compressed")
        .otherwise("/compressed")
    )
    images = t.pages.select("page_id", F.concat(F.lit("/"), host, suffix).alias("topic"))
    info = (
        t.pages.filter(F.col("url").startswith("https"))
        .select(F.concat(F.lit("/"), host, F.lit("/camera_info")).alias("info_topic"), F.length("html").alias("size"))
        .groupBy("info_topic")
        .agg(F.max("size").cast("bigint").alias("size"))
    )
    keyed = images.withColumn("info_topic", sync.camera_info_topic(F.col("topic")))
    return join_hot(keyed, info, ["info_topic"], ["page_id"]).select("page_id", "topic", "info_topic", "size")


@query("SELECT doc_id AS topic FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_topics(t):
    """Configured topics that never occur."""
    return audit.absent(
        t.documents.select(F.col("doc_id").alias("topic")), t.labels.select(F.col("doc_id").alias("topic")), "topic"
    )


# Type names drawn for the catalogue checks: the registered ones and six unknown ones.
DRAWN = [*REGISTRY, *[f"Unknown{i}" for i in range(6)]]
DRAWN_SQL = "[" + ", ".join(f"'{n}'" for n in DRAWN) + "]"
KNOWN_SQL = ", ".join(f"('{s.name}', '{s.time_spec}')" for s in REGISTRY.values())


@query(
    f"""SELECT DISTINCT {DRAWN_SQL}[p_partkey % {len(DRAWN)} + 1] AS type FROM part
WHERE {DRAWN_SQL}[p_partkey % {len(DRAWN)} + 1] NOT IN (SELECT n FROM (VALUES {KNOWN_SQL}) r(n, s))"""
)
def missing_types(t):
    """Configured types without converter."""
    wanted = t.part.select(F.get(F.lit(DRAWN), (F.col("p_partkey") % len(DRAWN)).cast("int")).alias("type"))
    return audit.absent(wanted, registry_table(t.spark), "type")


@query(
    f"""WITH e AS (SELECT event_id, value, {DRAWN_SQL}[event_id % {len(DRAWN)} + 1] AS type FROM events)
SELECT time_spec, type, count(*) AS n, round(sum(value), 6) AS total FROM e JOIN (VALUES {KNOWN_SQL}) r(type, time_spec) USING (type)
GROUP BY time_spec, type"""
)
def type_dispatch(t):
    """Messages routed by type name to their registered converter."""
    kind = F.get(F.lit(DRAWN), (F.col("event_id") % len(DRAWN)).cast("int"))
    routed = t.events.select("value", kind.alias("type")).join(registry_table(t.spark), "type")
    return routed.groupBy("time_spec", "type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total")
    )


@query(
    f"""WITH {LOG},
l AS (SELECT run, row_number() OVER (PARTITION BY run ORDER BY seq) - 1 AS idx, value AS lv FROM log WHERE topic = 'click'),
r AS (SELECT run, row_number() OVER (PARTITION BY run ORDER BY seq) - 1 AS idx, value AS rv FROM log WHERE topic = 'view')
SELECT run, idx, lv, rv, CASE WHEN l.lv IS NULL THEN 'right_only' WHEN r.rv IS NULL THEN 'left_only' ELSE 'paired' END AS status
FROM l FULL JOIN r USING (run, idx)"""
)
def stereo_zip(t):
    """Left and right frames paired by run and index, with unpaired ones flagged."""
    def side(topic, name):
        return index_rows(t.log().filter(F.col("topic") == topic).select("run", "seq", F.col("value").alias(name)), ["run"], ["seq"]).drop("seq")

    return audit.zip_streams(side("click", "lv"), side("view", "rv"), ["run", "idx"])


SLOP = 12 * HOUR


def _mutual_sql(other: str, n: int) -> str:
    return f"""
x{n} AS (SELECT p.run, p.t, p.seq, o.t AS ot, o.seq AS oseq, abs(p.t - o.t) AS d
         FROM log p JOIN log o ON p.run = o.run AND p.topic = 'click' AND o.topic = '{other}' AND abs(p.t - o.t) <= {SLOP}),
y{n} AS (SELECT *, row_number() OVER (PARTITION BY run, seq ORDER BY d, oseq) AS a,
                   row_number() OVER (PARTITION BY run, oseq ORDER BY d, seq) AS b FROM x{n}),
z{n} AS (SELECT run, t, seq, ot AS t_{n}, oseq AS seq_{n} FROM y{n} WHERE a = 1 AND b = 1)"""


@query(
    f"""WITH {LOG},{_mutual_sql('view', 1)},{_mutual_sql('purchase', 2)}
SELECT run, t, seq, t_1, seq_1, t_2, seq_2, greatest(t, t_1, t_2) - least(t, t_1, t_2) AS spread
FROM z1 JOIN z2 USING (run, t, seq) WHERE greatest(t, t_1, t_2) - least(t, t_1, t_2) <= {SLOP}"""
)
def approx_sync(t):
    """Sets of click, view and purchase that are mutually nearest within twelve hours."""
    return sync.approximate_sync(t.log(), ["run"], ["click", "view", "purchase"], SLOP)


SYNCED, QUEUE = ["click", "view", "purchase"], 5


def _queue_sync_sql() -> str:
    """The rule message by message: one step per message of every run."""
    n = len(SYNCED)
    none = "CAST([] AS STRUCT(t BIGINT, s BIGINT)[])"
    queued = [f"CASE WHEN m.i = {i} THEN list_sort(list_append(q{i}, own))[-{QUEUE}:] ELSE q{i} END AS a{i}" for i in range(n)]
    near = [
        f"CASE WHEN i = {i} THEN own ELSE (SELECT {{'t': c.t, 's': c.s}} FROM (SELECT list_sort(list_transform(a{i}, lambda x: {{'d': abs(x.t - own.t), 't': x.t, 's': x.s}}))[1] AS c)) END AS c{i}"
        for i in range(n)
    ]
    stamps = ", ".join(f"c{i}.t" for i in range(n))
    full = " AND ".join(f"len(a{i}) > 0" for i in range(n))
    held = "list_contains(CASE i " + " ".join(f"WHEN {i} THEN a{i}" for i in range(n)) + " END, own)"
    left = ", ".join(f"CASE WHEN hit THEN list_filter(a{i}, lambda x: x <> c{i}) ELSE a{i} END" for i in range(n))
    kinds = " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(SYNCED))
    return f"""WITH RECURSIVE {LOG},
m AS (SELECT run, {{'t': t, 's': seq}} AS own, CASE topic {kinds} END AS i, row_number() OVER (PARTITION BY run ORDER BY seq) AS n
  FROM log WHERE topic IN ({", ".join(f"'{x}'" for x in SYNCED)})),
st AS (
  SELECT run, 0::BIGINT AS n, {", ".join(f"{none} AS q{i}" for i in range(n))}, {none} AS match FROM m GROUP BY run
  UNION ALL
  SELECT run, n, {left}, CASE WHEN hit THEN [{", ".join(f"c{i}" for i in range(n))}] ELSE {none} END FROM (
    SELECT *, {held} AND {full} AND greatest({stamps}) - least({stamps}) <= {SLOP} AS hit FROM (
      SELECT *, {", ".join(near)} FROM (
        SELECT m.run, m.n, m.i, m.own, {", ".join(queued)} FROM st JOIN m ON m.run = st.run AND m.n = st.n + 1))))
SELECT run, {", ".join(f"match[{i + 1}].t AS t_{i}, match[{i + 1}].s AS seq_{i}" for i in range(n))} FROM st WHERE len(match) > 0"""


QUEUE_SYNC = _queue_sync_sql()


@query(QUEUE_SYNC)
def approx_sync_queue(t):
    """Sets of click, view and purchase by queues of five in arrival order."""
    return queued.queue_sync(t.log(), ["run"], SYNCED, SLOP, QUEUE)[0]


def _linear_sql(targets: str, key: str) -> str:
    on = f"q.{key} = log.{key} AND " if key else ""
    on2 = f"p.{key} = log.{key} AND " if key else ""
    return f"""
p AS (SELECT q.*, log.t AS pt, log.value AS pv FROM {targets} q ASOF LEFT JOIN log ON {on}log.t <= q.t),
n AS (SELECT p.*, log.t AS nt, log.value AS nv FROM p ASOF LEFT JOIN log ON {on2}log.t >= p.t),
i AS (SELECT *, CASE
    WHEN pt IS NULL AND nt IS NULL THEN NULL
    WHEN pt IS NULL THEN CASE WHEN nt - t <= {2 * HOUR} THEN nv END
    WHEN nt IS NULL THEN CASE WHEN t - pt <= {2 * HOUR} THEN pv END
    WHEN pt = nt THEN pv ELSE pv + (nv - pv) * (CAST(t - pt AS DOUBLE) / CAST(nt - pt AS DOUBLE)) END AS raw FROM n)"""


@query(
    f"""WITH {GRID}, q0 AS (SELECT topic, idx, target AS t FROM tg),{_linear_sql('q0', 'topic')}
SELECT topic, t, round(raw, 6) AS value FROM i"""
)
def interp_linear(t):
    """Every topic's value interpolated at every hour; ends held for two hours."""
    log = t.log()
    bounds = asof.grid_bounds(log, [], "t", HOUR)
    targets = asof.topic_grid(bounds, [], TOPICS, HOUR).select("topic", F.col("target").alias("t"))
    splits = split_points(log.select("t"), ["t"])
    out = interp.interpolate(targets, log, ["topic"], ["value"], 2 * HOUR, splits=splits)
    return out.select("topic", "t", F.round("value", 6).alias("value"))


@query(
    f"""WITH l0 AS (SELECT event_id, epoch_us(ts) AS t, event_type, value FROM events),
log AS (SELECT t, value FROM l0 WHERE event_type = 'view'),
q0 AS (SELECT DISTINCT t FROM l0 WHERE event_type = 'click'),{_linear_sql('q0', '')}
SELECT t, round(raw, 6) AS value FROM i"""
)
def interp_match_topic(t):
    """One topic interpolated at the stamps of another."""
    log = t.log()
    clicks, views = log.filter(F.col("topic") == "click"), log.filter(F.col("topic") == "view")
    out = interp.interpolate(clicks, views, [], ["value"], 2 * HOUR)
    return out.select("t", F.round("value", 6).alias("value"))


@query(
    f"""WITH {GRID}, views AS (SELECT * FROM log WHERE topic = 'view'),
q0 AS (SELECT DISTINCT 'MATCH_TARGET' AS mode, target AS t FROM tg
  UNION ALL SELECT DISTINCT 'MATCH_TOPIC', t FROM log WHERE topic = 'click' UNION ALL SELECT DISTINCT 'UNCHANGED', t FROM views),{_linear_sql('q0', '').replace("log", "views")}
SELECT mode, t, round(raw, 6) AS value FROM i"""
)
def interp_modes(t):
    """One topic at the stamps of the grid, of another topic and of its own."""
    log = t.log()
    clicks, views = log.filter(F.col("topic") == "click"), log.filter(F.col("topic") == "view")
    grid = asof.time_grid(asof.grid_bounds(log, [], "t", HOUR), [], HOUR).select(F.col("target").alias("t"))
    modes = [interp.MATCH_TARGET, interp.MATCH_TOPIC, interp.UNCHANGED]
    asked = [interp.target_stamps(m, views, grid, clicks, []).withColumn("mode", F.lit(m)) for m in modes]
    targets = asked[0].unionByName(asked[1]).unionByName(asked[2])
    splits = split_points(log.select("t"), ["t"])
    out = interp.interpolate(targets, views, [], ["value"], 2 * HOUR, splits=splits)
    return targets.join(out, "t").select("mode", "t", F.round("value", 6).alias("value"))


@query(
    f"""WITH {LOG} SELECT topic, run, max(seq) AS seq, arg_max(t, seq) AS t, arg_max(value, seq) AS value
FROM log GROUP BY topic, run"""
)
def latest_per_key(t):
    """Last logged record per topic and run."""
    return sync.latest_per_key(t.log(), ["topic", "run"], ["t", "value"])


@query(
    f"""WITH {LOG}, x AS (SELECT seq, topic, t AS log_t, CASE WHEN topic = 'error' THEN NULL ELSE t - 250000 END AS stamp FROM log)
SELECT seq, coalesce(stamp, log_t) AS stamp, log_t AS forced FROM x"""
)
def stamp_choice(t):
    """Header stamp unless headerless, and the forced log time."""
    x = t.log().withColumn("log_t", F.col("t")).withColumn(
        "header", F.when(F.col("topic") != "error", F.col("t") - 250_000)
    )
    return x.select(
        "seq",
        sync.choose_stamp("log_t", "header").alias("stamp"),
        sync.choose_stamp("log_t", "header", use_log_time=True).alias("forced"),
    )
