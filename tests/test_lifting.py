import math
import operator
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import lifting, tree

POSE = "child string, parent string, x double, y double, z double, qx double, qy double, qz double, qw double"


def random_forest(n, seed):
    """Deep branches: a frame hangs below one of the three before it, now and then below a new root."""
    rng = random.Random(seed)
    return [(f"n{i}", f"root{i}" if rng.random() < 0.05 else f"n{max(0, i - rng.randint(1, 3))}") for i in range(1, n)]


def path(parent, node):
    out = [node]
    while out[-1] in parent and parent[out[-1]] != out[-1]:
        out.append(parent[out[-1]])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_common_ancestors_match_paths(spark, seed):
    edges = random_forest(80, seed)
    parent, rng = dict(edges), random.Random(seed)
    cost = {c: rng.randint(1, 9) for c in parent}
    names = sorted({*parent, *parent.values(), "unknown"})
    asked = [(rng.choice(names), rng.choice(names)) for _ in range(300)] + [("n0", "n0"), ("unknown", "unknown")]
    table = lifting.ancestors(spark.createDataFrame([(c, p, cost[c]) for c, p in edges], "child string, parent string, cost int"), {"cost": operator.add})
    got = {(r.f1, r.f2): (r.lca, r.lca_depth, r.cost) for r in lifting.common_ancestor(spark.createDataFrame(asked, "f1 string, f2 string"), table).collect()}
    assert len(got) == len(set(asked))
    for a, b in asked:
        up, down = path(parent, a), path(parent, b)
        lca = next((f for f in up if f in down), None)
        if lca is None:
            assert got[(a, b)] == (None, None, None)
            continue
        between = up[: up.index(lca)] + down[: down.index(lca)]
        assert got[(a, b)] == (lca, len(path(parent, lca)) - 1, sum(cost[f] for f in between) if between else None)


def test_long_chain_takes_a_row_per_power(spark):
    """A chain of 100,000 frames: whole paths would hold five thousand million entries."""
    n = 100_000
    edges = spark.range(n).select(
        F.concat(F.lit("n"), F.col("id") + 1).alias("child"), F.concat(F.lit("n"), "id").alias("parent"), F.lit(1).cast("bigint").alias("hops")
    )
    table = lifting.ancestors(edges, {"hops": operator.add})
    assert len(table.levels) == 17 and sum(level.count() for level in table.levels) <= n * 17
    assert table.tops.filter(F.col("steps") != F.expr("cast(substr(node, 2) as bigint)")).count() == 0
    asked = [("n100000", "n77777"), ("n0", "n99999"), ("n65536", "n65535"), ("n5", "n5")]
    got = {(r.f1, r.f2): (r.lca, r.lca_depth, r.hops) for r in lifting.common_ancestor(spark.createDataFrame(asked, "f1 string, f2 string"), table).collect()}
    assert got == {
        ("n100000", "n77777"): ("n77777", 77777, 22223), ("n0", "n99999"): ("n0", 0, 99999), ("n65536", "n65535"): ("n65535", 65535, 1), ("n5", "n5"): ("n5", 5, None),
    }


def test_cycles_self_loops_and_null_edges(spark):
    rows = [("p", "q"), ("q", "r"), ("r", "p"), ("t", "p"), ("z", "z"), ("w", "z"), ("a", None), (None, "b"), ("c", "d")]
    edges = spark.createDataFrame(rows, "child string, parent string")
    table = lifting.ancestors(edges)
    got = {r.node: (r.top, r.steps, r.cyclic) for r in table.tops.collect()}
    assert got == {**{n: (None, None, True) for n in "pqrt"}, "z": ("z", 1, False), "w": ("z", 2, False), "c": ("d", 1, False)}
    asked = spark.createDataFrame([("w", "z"), ("p", "q"), ("p", "p"), ("c", "d"), (None, "c")], "f1 string, f2 string")
    met = {(r.f1, r.f2): r.lca for r in lifting.common_ancestor(asked, table).collect()}
    assert met == {("w", "z"): "z", ("p", "q"): None, ("p", "p"): "p", ("c", "d"): "d", (None, "c"): None}


def test_no_edges(spark):
    table = lifting.ancestors(spark.createDataFrame([], "child string, parent string, hops int"), {"hops": operator.add})
    assert table.levels == [] and table.tops.count() == 0
    asked = spark.createDataFrame([("a", "a"), ("a", "b")], "f1 string, f2 string")
    got = {(r.f1, r.f2): (r.lca, r.lca_depth, r.hops) for r in lifting.common_ancestor(asked, table).collect()}
    assert got == {("a", "a"): ("a", 0, None), ("a", "b"): (None, None, None)}


def planar(yaw, x, y):
    m = np.eye(4)
    m[:2, :2] = [[math.cos(yaw), -math.sin(yaw)], [math.sin(yaw), math.cos(yaw)]]
    m[:2, 3] = x, y
    return m


def test_products_match_numpy_and_stop_at_missing_matrices(spark):
    edges = random_forest(60, 3)
    parent, rng = dict(edges), random.Random(5)
    missing = {"n20", "n33"}
    local = {c: (rng.uniform(-3, 3), rng.uniform(-5, 5), rng.uniform(-5, 5)) for c in parent if c not in missing}
    statics = tree.static_matrices(
        spark.createDataFrame([(c, parent[c], x, y, 0.0, 0.0, 0.0, math.sin(a / 2), math.cos(a / 2)) for c, (a, x, y) in local.items()], POSE)
    )
    names = sorted({*parent, *parent.values(), "unknown"})
    asked = [(rng.choice(names), rng.choice(names)) for _ in range(300)] + [("unknown", "unknown")]
    asked = sorted(set(asked))
    rows = tree.chain_transform(spark.createDataFrame(asked, "f1 string, f2 string"), spark.createDataFrame(edges, "child string, parent string"), statics)
    got = {(r.f1, r.f2): r.matrix for r in rows.collect()}
    n_paths = 0
    for a, b in asked:
        up, down = path(parent, a), path(parent, b)
        lca = next((f for f in up if f in down), None)
        between = None if lca is None else up[: up.index(lca)] + down[: down.index(lca)]
        if between is None or missing & set(between):
            assert got[(a, b)] is None
            continue
        m = np.eye(4)
        for f in up[: up.index(lca)]:
            m = m @ np.linalg.inv(planar(*local[f]))
        for f in reversed(down[: down.index(lca)]):
            m = m @ planar(*local[f])
        n_paths += 1
        assert np.allclose(np.array(got[(a, b)]).reshape(4, 4), m)
    assert n_paths > 50


def in_order(spark, rows, kinds):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{kinds}, pos int").repartition(3)


@pytest.mark.parametrize("block_rows, seed", [(9, 2), (1000, 3)])
def test_paths_followed_in_blocks_give_the_same_table(spark, block_rows, seed):
    """Blocks that hold some frames, and all; a tenth of the frames lies far from its parent, some values are null."""
    rng = random.Random(seed)
    edges = [(c, p if rng.random() < 0.9 else f"n{rng.randrange(int(c[1:]))}") for c, p in random_forest(120, seed)]
    edges += [("p", "q"), ("q", "r"), ("r", "p"), ("t", "p"), ("z", "z"), ("w", "z"), ("v", "w"), ("a", None), (None, "b")]
    rng.shuffle(edges)
    rows = [(c, p, rng.randint(1, 9) if rng.random() < 0.95 else None, rng.choice([1.5, 2.0, None])) for c, p in edges]
    table = in_order(spark, rows, "child string, parent string, cost int, low double")
    folds = {"cost": operator.add, "low": F.greatest}
    plain, blocks = lifting.ancestors(table, folds), lifting.ancestors(table, folds, ["pos"], block_rows)
    assert sorted(map(tuple, blocks.tops.select(plain.tops.columns).collect()), key=str) == sorted(map(tuple, plain.tops.collect()), key=str)
    names = sorted({x for e in edges for x in e if x} | {"unknown"})
    asked = spark.createDataFrame([(rng.choice(names), rng.choice(names)) for _ in range(300)], "f1 string, f2 string")
    got = [sorted(map(tuple, lifting.common_ancestor(asked, x).collect()), key=str) for x in (plain, blocks)]
    assert got[0] == got[1] and len(got[0]) > 250
    assert len(blocks.levels) == blocks.tops.agg(F.max("steps")).first()[0].bit_length()


def test_long_chain_in_order_takes_no_level_and_few_rounds(spark, monkeypatch):
    """Only parents in other blocks are doubled, and neighbours need no jump of more than one edge."""
    n, stored = 300_000, []
    monkeypatch.setattr(lifting, "_stored", lambda state, jump, real=lifting._stored: stored.append(real(state, jump)) or stored[-1])
    edges = spark.range(n).select(
        F.concat(F.lit("n"), F.col("id") + 1).alias("child"), F.concat(F.lit("n"), "id").alias("parent"), F.lit(1).cast("bigint").alias("hops"), "id"
    )
    table = lifting.ancestors(edges, {"hops": operator.add}, order=["id"])
    assert table.tops.filter(F.col("steps") != F.expr("cast(substr(node, 2) as bigint)")).count() == 0
    assert all(state.count() <= 20 for state, _, _ in stored) and len(stored) <= 6
    asked = [("n300000", "n299999"), ("n5", "n6"), ("n0", "n7")]
    got = {(r.f1, r.f2): (r.lca, r.lca_depth, r.hops) for r in lifting.common_ancestor(spark.createDataFrame(asked, "f1 string, f2 string"), table).collect()}
    assert got == {asked[0]: ("n299999", 299999, 1), asked[1]: ("n5", 5, 1), asked[2]: ("n0", 0, 7)}
    assert len(table.built) == 1
