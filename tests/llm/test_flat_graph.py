import random

import duckdb
import numpy as np
import pytest

from mercata.llm import flat_graph as fg
from mercata.llm import registry

SCHEMA = "vec_id long, embedding array<double>, label int, key string, vec string, n int, `a.b` int"


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute(rows, limit=0.93):
    """Sorted (vec_id, n_links, component_id, kept) of (vec_id, vector, label), by all pairs."""
    n = len(rows)
    near = [[] for _ in range(n)]
    for i in range(n):
        for j in range(i):
            (_, v, a), (_, w, b) = rows[i], rows[j]
            if a is not None and a == b and good(v) and good(w) and len(v) == len(w):
                v, w = np.array(v, float), np.array(w, float)
                if v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= limit:
                    near[i].append(j)
                    near[j].append(i)
    top = list(range(n))
    for _ in range(n):
        new = [min([top[i], *(top[j] for j in near[i])]) for i in range(n)]
        if new == top:
            break
        top = new
    out = []
    for i, (d, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if top[j] == top[i] and rows[j][0] is not None]
        low = min(ids, default=None)
        out.append((d, len(near[i]), low, d == low))
    return sorted(out, key=str)


def run(spark, rows, **how):
    frame = spark.createDataFrame([(d, None if v is None else [None if x is None else float(x) for x in v], a, "k", "v", 1, 2) for d, v, a in rows], SCHEMA)
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in fg.near_vectors(frame.repartition(4), **how).collect()), key=str)


def clustered(seed, n=260, dim=16):
    r = np.random.default_rng(seed)
    base = r.normal(size=(40, dim))
    return [(i, (base[r.integers(0, 40)] + r.normal(size=dim) * r.choice([0.05, 0.2, 0.5])).tolist(), int(r.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("how", [{}, {"shard": 30, "probes": 2}, {"shard": 30, "whole": 6}])
def test_links_equal_all_pairs(spark, how):
    rows = clustered(1)
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(30)] + [(2000, [2 * x for x in rows[0][1]], rows[0][2])]
    told = []
    assert run(spark, rows, told=told.append, recall=1.0, **how) == brute(rows)
    assert told[-1] == 1.0


def test_dense_component_with_a_rim(spark):
    """A large component around one direction: most members are never compared, those at its edge are."""
    r = np.random.default_rng(5)
    middle = r.normal(size=12)
    rows = [(i, (middle + r.normal(size=12) * s).tolist(), 1) for i, s in enumerate([0.05] * 200 + [0.25] * 60 + [0.4] * 40)]
    rows += [(900, rows[3][1], 1), (901, rows[250][1], 1)]
    want = brute(rows)
    assert run(spark, rows, whole=32) == want == run(spark, rows)
    assert len({x[1] for x in want}) > 10


def test_no_cell_emits_more_links_than_rows(spark):
    r = np.random.default_rng(6)
    for n in (200, 400):
        rows = [(i, (np.ones(8) + r.normal(size=8) * 0.05).tolist(), 1) for i in range(n)]
        classes = spark.createDataFrame([(i.to_bytes(16, "big"), "8 1", np.array(v).tobytes()) for i, v, _ in rows], "key binary, family string, vec binary")
        assert fg._links(classes, spark.sparkContext.broadcast({}), 3, 8, 0.93).count() == n - 1


def test_graph_reaches_every_node_from_the_medoid():
    r = np.random.default_rng(2)
    for v in (r.normal(size=(500, 24)), np.concatenate([r.normal(size=(300, 24)), r.normal(size=24) + 0.01 * r.normal(size=(300, 24))])):
        unit = v / np.linalg.norm(v, axis=1, keepdims=True)
        edges = fg.robust_edges(unit)
        seen, todo = set(), [fg.medoid(unit)]
        while todo:
            i = todo.pop()
            if i not in seen:
                seen.add(i)
                todo += edges[i].tolist()
        assert len(seen) == len(unit)
        assert all(len(e) <= 3 * fg.DEGREE and i not in e for i, e in enumerate(edges))


def test_search_from_the_medoid_finds_planted_neighbours():
    """Queries that are no members: only the walk finds them."""
    r = np.random.default_rng(3)
    unit = fg._unit(r.normal(size=(1500, 32)))
    at = r.integers(0, 1500, 200)
    queries = fg._unit(unit[at] + 0.03 * r.normal(size=(200, 32)))
    lists = fg.robust_edges(unit)
    edges = np.full((1500, max(map(len, lists))), 1500)
    for i, e in enumerate(lists):
        edges[i, :len(e)] = e
    rows, cols = fg.range_search(unit.astype(np.float32), edges, queries.astype(np.float32), np.full(200, 1500), fg.medoid(unit), fg.EXPAND, 0.93)
    found = set(zip(rows.tolist(), cols.tolist(), strict=True))
    assert sum((i, j) in found for i, j in enumerate(at.tolist())) >= 180
    assert all(unit[j] @ queries[i] >= 0.92 for i, j in found)


def test_odd_rows_and_empty_table(spark):
    nan, inf = float("nan"), float("inf")
    a, b = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 3.0], 1), (5, [1.0, nan, 3.0], 1), (6, [inf, 1.0, 1.0], 1),
            (7, a, None), (8, a, None), (9, a, 1), (10, a, 1), (10, a, 1), (11, a, 2), (None, a, 1), (None, b, 3), (None, b, 3), (12, b, 1), (13, b, 1),
            (13, a, 5), (14, a[:2], 1), (15, [1e200, 2e200, 3e200], 1), (16, [1e-200, 2e-200, 3e-200], 7), (17, [-x for x in a], 1), (18, [3.0], 1), (19, [4.0], 1)]
    got = run(spark, rows)
    small = [(d, None if v is None else [x if x is None or abs(x) < 1e100 or not np.isfinite(x) else x / 1e200 for x in v], c) for d, v, c in rows]
    small = [(d, [x * 1e200 for x in v] if d == 16 else v, c) for d, v, c in small]
    assert got == brute(small)
    assert fg.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_equals_its_sql(spark, sf):
    got = sorted(tuple(r[c] for c in ("vec_id", "n_links", "component_id", "kept")) for r in registry.op13_flat_graph(spark, sf).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert got == sorted(con.execute(registry.oracle_sql()["op13_flat_graph"]).fetchall())
