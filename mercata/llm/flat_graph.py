"""Near-duplicate vectors over a flat, robust-pruned graph.

1. Equal vectors of a label are one class; classes of a label and length form a group.  Groups are
   cut into shards around centres drawn from themselves (one class in ``SHARD`` by hash, at most
   ``CENTRES`` in all, so their broadcast is bounded); every class lies in its ``OVERLAP`` nearest.
2. Each shard (in blocks of ``BLOCK``) builds a graph: nearest members and a few far ones are pruned
   robustly, an edge stays unless a kept one leads there.  The adjacency lists of a class from all
   its shards are united.
3. Every class searches its ``probes`` nearest shards: best first from the shard's medoid for
   ``expand`` steps (where it is a member, also from itself and for ``EXPAND_OWN``), then outwards
   over every node within range until there are no more.  Hits are checked on the original vectors in double precision.  A cell
   returns links that join two of its components only: fewer than its rows, however dense it is.
4. Components over those links.  The recall is audited: a sample is compared with all rows; below
   ``RECALL`` the search is run again, twice as wide.
5. Links are counted exactly inside the components.  Members within half the angle of the limit
   around a component's mean are linked to each other without a comparison (the angles add up);
   only the others are compared with all members, in blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import pin, width
from mercata.llm.components import components

COSINE = 0.93
SHARD = 500        # classes per shard that the number of centres aims at
CENTRES = 4_096    # centres in all, at most
OVERLAP = 2
PROBES = 3
EXPAND = 24        # nodes a search opens before it keeps to the range
EXPAND_OWN = 4     # the same where the query is a node of the graph and has its own edges
BLOCK = 2_048      # members of a shard that are searched together
SLICE = 16_384     # queries of a cell
DEGREE = 16
ALPHA = 1.2
NEAR, FAR = 48, 16  # candidates for a node's edges
AUDIT = 4_096      # classes compared with all rows
RECALL = 0.99
WHOLE = 2_048      # members up to which a component is compared in one task
SLACK = 0.05       # a search goes on over nodes so little out of range
_EDGE = 1e-9       # cosines this close to the limit are taken from the exact sums
_ID, _VEC, _GROUP = "__llm_id", "__llm_vec", "__llm_group"


def _matrix(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)


def _unit(full: np.ndarray) -> np.ndarray:
    big = full / np.abs(full).max(axis=1, keepdims=True)  # no overflow of the squares
    return big / np.linalg.norm(big, axis=1, keepdims=True)


def _linked(a: np.ndarray, b: np.ndarray, limit: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (both whole blocks) are near enough: a matrix of booleans."""
    s = _unit(a) @ _unit(b).T
    out = s >= limit
    for i, j in zip(*np.nonzero(np.abs(s - limit) < _EDGE), strict=True):
        out[i, j] = exact_cosine(a[i], b[j]) >= limit
    return out


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of two vectors as one plain expression in double precision; powers of two taken out change no digit of it."""
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max())[1]) for x in (a, b))
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


def _sorted_cells(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Consecutive rows of one key in a batch, as (key, rows); a key may come again in the next batch."""
    for batch in batches:
        for k, rows in groupby(batch.to_pylist(), key=lambda r: tuple(r[c] for c in key)):
            yield k, list(rows)


def _whole_cells(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """All rows of each key; for cells of bounded size."""
    at, held = None, []
    for k, rows in _sorted_cells(batches, key):
        if k != at and held:
            yield at, held
            held = []
        at = k
        held += rows
    if held:
        yield at, held


# ---- classes and shards

def _classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [v.values.to_numpy(zero_copy_only=False).astype("<f8").tobytes() for v in batch.column(_VEC)]
        keys = [hashlib.md5(f"{g}\0".encode() + v, usedforsecurity=False).digest() for g, v in zip(batch.column(_GROUP).to_pylist(), raw, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(_ID), pa.array(keys, pa.binary()), batch.column(_GROUP), pa.array(raw, pa.binary())],
                                         names=["vec_id", "key", "family", "vec"])


def _placed(batches: Iterator[pa.RecordBatch], shared, probes: int) -> Iterator[pa.RecordBatch]:
    """The nearest shards of each class, nearest first."""
    centres = shared.value  # family -> (numbers, unit vectors)
    for batch in batches:
        families, vecs = batch.column("family").to_pylist(), batch.column("vec").to_pylist()
        shards: list = [None] * batch.num_rows
        for family in set(families):
            rows = [i for i, f in enumerate(families) if f == family]
            if family not in centres:
                for i in rows:
                    shards[i] = [family]
                continue
            numbers, unit = centres[family]
            near = np.argsort(-(_unit(_matrix([vecs[i] for i in rows])) @ unit.T), axis=1, kind="stable")[:, :probes]
            for i, at in zip(rows, near, strict=True):
                shards[i] = [f"{family} {numbers[j]}" for j in at]
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("vec"), pa.array(shards, pa.list_(pa.string()))],
                                         names=["key", "vec", "shards"])


def _centres(classes: DataFrame, shard: int) -> dict:
    """Centres of the groups that are larger than a shard; at most ``CENTRES`` vectors come to the driver."""
    total = classes.count()
    every = max(shard, -(-2 * total // CENTRES))
    large = classes.groupBy("family").count().where(F.col("count") > every).select("family")
    drawn = classes.join(large, "family").where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).orderBy(F.xxhash64("key"), "key").limit(CENTRES)
    out: dict = {}
    for n, r in enumerate(drawn.select("family", "vec").collect()):
        out.setdefault(r.family, []).append((n, bytes(r.vec)))
    return {f: ([n for n, _ in of], _unit(_matrix([v for _, v in of]))) for f, of in out.items()}


# ---- the graph

def robust_edges(unit: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> list[np.ndarray]:
    """Neighbours of each row: candidates by distance, each dropped if ``alpha`` times nearer to a kept one; and the way back."""
    m = len(unit)
    s = unit @ unit.T
    np.fill_diagonal(s, -2)
    near = min(NEAR, m - 1)
    far = np.random.default_rng(m).integers(0, m, (m, FAR))
    candidates = np.concatenate([np.argpartition(-s, near - 1, axis=1)[:, :near], far, np.full((m, 1), medoid(unit))], axis=1)
    rows = np.arange(m)[:, None]
    order = np.argsort(-s[rows, candidates], axis=1, kind="stable")
    candidates = np.take_along_axis(candidates, order, axis=1)
    to_node = np.sqrt(np.maximum(2 - 2 * s[rows, candidates], 0))
    open_ = candidates != rows
    kept = np.zeros_like(open_)
    for j in range(candidates.shape[1]):
        take = open_[:, j] & (kept.sum(axis=1) < degree)
        kept[:, j] = take
        between = np.sqrt(np.maximum(2 - 2 * s[candidates[:, j, None], candidates], 0))
        between[candidates[:, j, None] == candidates] = 0  # the diagonal
        open_ &= ~(take[:, None] & (alpha * between <= to_node))
    a = np.repeat(np.arange(m), kept.sum(axis=1))
    b = candidates[kept]
    both = np.unique(np.concatenate([a * m + b, b * m + a]))
    a, b = both // m, both % m
    order = np.lexsort((-s[a, b], a))
    cuts = np.searchsorted(a, np.arange(1, m))
    # nodes that many others point to keep the edges of their own and the nearest ways back
    own = [set(candidates[i][kept[i]].tolist()) for i in range(m)]
    return [np.array(sorted(own[i] | set(of[:2 * degree].tolist())), np.int64) for i, of in enumerate(np.split(b[order], cuts))]


def medoid(unit: np.ndarray) -> int:
    """Row nearest to the mean direction."""
    return int((unit @ unit.sum(axis=0)).argmax())


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _whole_cells(batches, ["shard", "block"]):
        keys = [r["key"] for r in rows]
        edges = robust_edges(_unit(_matrix([r["vec"] for r in rows]))) if len(rows) > 1 else [np.zeros(0, np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([[keys[j] for j in e] for e in edges], pa.list_(pa.binary()))],
                                         names=["key", "edges"])


# ---- the search

def range_search(unit: np.ndarray, edges: np.ndarray, queries: np.ndarray, selves: np.ndarray, start: int, expand: int, limit: float):
    """(query, member) numbers of the members found within ``limit`` of each query.

    ``edges`` is padded with ``len(unit)``; ``selves`` is the member that a query is, or that number.
    """
    m, n = len(unit), len(queries)
    score = np.full((n, m + 1), -np.inf, np.float32)
    score[:, m] = np.inf  # padding counts as seen
    waiting = np.full((n, m), -np.inf, np.float32)  # scores of nodes seen and not opened
    every = np.arange(n)

    def visit(rows: np.ndarray, cols: np.ndarray) -> None:
        for a in range(0, len(rows), 65_536):
            r, c = rows[a:a + 65_536], cols[a:a + 65_536]
            score[r, c] = waiting[r, c] = np.einsum("ij,ij->i", queries[r], unit[c])

    visit(every, np.full(n, start))
    own = np.flatnonzero(selves < m)
    visit(own, selves[own])
    for _ in range(min(expand, m)):
        best = waiting.argmax(axis=1)
        live = np.flatnonzero(~np.isneginf(waiting[every, best]))
        if not len(live):
            break
        waiting[live, best[live]] = -np.inf
        rows, cols = np.repeat(live, edges.shape[1]), edges[best[live]].ravel()
        new = np.isneginf(score[rows, cols])  # a node's edges are distinct
        visit(rows[new], cols[new])
    while True:
        rows, cols = np.nonzero(waiting >= limit - SLACK)
        if not len(rows):
            return np.nonzero(score[:, :m] >= limit - 1e-5)
        waiting[rows, cols] = -np.inf
        for a in range(0, len(rows), 65_536):
            mark = np.zeros((n, m + 1), bool)
            mark[np.repeat(rows[a:a + 65_536], edges.shape[1]), edges[cols[a:a + 65_536]].ravel()] = True
            visit(*np.nonzero(mark & np.isneginf(score)))


class _Joined:
    """Components of a cell's keys, and the links that joined two of them."""

    def __init__(self) -> None:
        self.top: dict[bytes, bytes] = {}
        self.links: list[tuple[bytes, bytes]] = []

    def find(self, x: bytes) -> bytes:
        top = self.top
        while top.get(x, x) != x:
            top[x] = top.get(top[x], top[x])
            x = top[x]
        return x

    def join(self, a: bytes, b: bytes) -> None:
        x, y = self.find(a), self.find(b)
        if x != y:
            self.top[max(x, y)] = min(x, y)
            self.links.append((a, b))


def _searched(batches: Iterator[pa.RecordBatch], expand: int, limit: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, members before queries: links that join components of the cell."""
    cell, members, joined, index = None, [], _Joined(), None

    def index_of() -> tuple:
        full = _matrix([r["vec"] for r in members])
        unit = _unit(full)
        place = {r["key"]: i for i, r in enumerate(members)}
        lists = [[place[k] for k in r["edges"] if k in place] for r in members]
        edges = np.full((len(members), max(1, max(map(len, lists)))), len(members), np.int64)
        for i, of in enumerate(lists):
            edges[i, :len(of)] = of
        return full, unit.astype(np.float32), place, edges, medoid(unit)

    for key, rows in _sorted_cells(batches, ["shard", "block", "slice"]):
        if key != cell:
            cell, members, joined, index = key, [], _Joined(), None
        members += [r for r in rows if not r["asks"]]
        asked = [r for r in rows if r["asks"]]
        if asked and members:
            index = index or index_of()
            full, unit, place, edges, start = index
            own, others = [r for r in asked if r["key"] in place], [r for r in asked if r["key"] not in place]
            for some, steps in [(of[a:a + 256], k) for of, k in ((own, min(EXPAND_OWN, expand)), (others, expand)) for a in range(0, len(of), 256)]:
                q = _matrix([r["vec"] for r in some])
                selves = np.array([place.get(r["key"], len(members)) for r in some])
                found = range_search(unit, edges, _unit(q).astype(np.float32), selves, start, steps, limit)
                for i, j in zip(*(x.tolist() for x in found), strict=True):
                    x, y = some[i]["key"], members[j]["key"]
                    if x != y and joined.find(x) != joined.find(y) and exact_cosine(q[i], full[j]) >= limit:
                        joined.join(x, y)
            out, joined.links = joined.links, []
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.binary()) for k in (0, 1)], names=["a", "b"])


def _in_blocks(rows: DataFrame, by: str, size: int, name: str) -> DataFrame:
    """``rows`` with the number of blocks of their ``by`` and their own block."""
    blocks = rows.groupBy(by).agg(F.ceil(F.count("*") / size).cast("int").alias(f"{name}s"))
    return rows.join(blocks, by).withColumn(name, F.pmod(F.xxhash64("key", F.lit(name)), F.col(f"{name}s")).cast("int"))


def _links(classes: DataFrame, shared, probes: int, expand: int, limit: float) -> DataFrame:
    """Links that connect what the graph search finds."""
    n = width(classes.sparkSession)
    placed = pin(classes.mapInArrow(lambda it: _placed(it, shared, probes), "key binary, vec binary, shards array<string>"), "graph-placed")
    members = placed.select("key", "vec", F.explode(F.slice("shards", 1, OVERLAP)).alias("shard"))
    stored = pin(_in_blocks(members, "shard", BLOCK, "block"), "graph-members")
    built = stored.repartition(n, "shard", "block").sortWithinPartitions("shard", "block", "key") \
        .mapInArrow(_built, "key binary, edges array<binary>")
    graph = built.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("edges"))).alias("edges"))
    queries = pin(_in_blocks(placed.select("key", "vec", F.explode("shards").alias("shard")), "shard", SLICE, "slice"), "graph-queries")
    blocks = stored.select("shard", "blocks").distinct()
    slices = queries.select("shard", "slices").distinct()
    columns = ["shard", "block", "slice", "asks", "key", "vec", "edges"]
    ask = queries.join(blocks, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("asks", F.lit(True)).withColumn("edges", F.lit(None).cast("array<binary>")).select(columns)
    hold = stored.join(graph, "key").join(slices, "shard").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))) \
        .withColumn("asks", F.lit(False)).select(columns)
    cell = ["shard", "block", "slice"]
    return hold.union(ask).repartition(n, *cell).sortWithinPartitions(*cell, "asks", "key") \
        .mapInArrow(lambda it: _searched(it, expand, limit), "a binary, b binary")


def _audited(batches: Iterator[pa.RecordBatch], shared, limit: float) -> Iterator[pa.RecordBatch]:
    """Links of the sample: how many there are, and how many lie inside a component."""
    sample = shared.value  # family -> (keys, labels, vectors)
    for batch in batches:
        there = held = 0
        rows = batch.to_pylist()
        for family in {r["family"] for r in rows} & sample.keys():
            mine = [r for r in rows if r["family"] == family]
            keys, labels, vecs = sample[family]
            near = _linked(vecs, _matrix([r["vec"] for r in mine]), limit)
            for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
                if keys[i] != mine[j]["key"]:
                    there += 1
                    held += labels[i] == mine[j]["label"]
        yield pa.RecordBatch.from_arrays([pa.array([there]), pa.array([held])], names=["there", "held"])


def audit_recall(labelled: DataFrame, limit: float = COSINE, sample: int = AUDIT) -> float:
    """Share of the true links of ``sample`` classes (smallest hashes) that lie inside a component, against all rows.

    ``labelled(key, family, vec, label)``; the sample's vectors are broadcast, the rows stay where they are.
    """
    taught: dict = {}
    for r in labelled.orderBy(F.xxhash64("key"), "key").limit(sample).collect():
        taught.setdefault(r.family, []).append((bytes(r.key), bytes(r.label), bytes(r.vec)))
    shared = labelled.sparkSession.sparkContext.broadcast({f: ([k for k, _, _ in of], [x for _, x, _ in of], _matrix([v for _, _, v in of]))
                                                           for f, of in taught.items()})
    r = labelled.mapInArrow(lambda it: _audited(it, shared, limit), "there long, held long").agg(F.sum("there"), F.sum("held")).first()
    return r[1] / r[0] if r[0] else 1.0


# ---- exact counts inside the components

def _counted_whole(batches: Iterator[pa.RecordBatch], limit: float) -> Iterator[pa.RecordBatch]:
    for _, rows in _whole_cells(batches, ["label"]):
        v = _matrix([r["vec"] for r in rows])
        near = _linked(v, v, limit)
        np.fill_diagonal(near, False)
        yield pa.RecordBatch.from_arrays([pa.array([r["key"] for r in rows], pa.binary()), pa.array(near @ np.array([r["n"] for r in rows], np.int64))],
                                         names=["key", "others"])


def _summed(batches: Iterator[pa.RecordBatch], final: bool) -> Iterator[pa.RecordBatch]:
    """Sums of directions by component: of a batch, or (rows sorted by it) of all."""
    def out(label, total) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([label], pa.binary()), pa.array([total.astype("<f8").tobytes()], pa.binary())], names=["label", "total"])

    at = total = None
    for (label,), rows in _sorted_cells(batches, ["label"]):
        part = _matrix([r["total"] for r in rows]).sum(axis=0) if final else _unit(_matrix([r["vec"] for r in rows])).sum(axis=0)
        if label != at and total is not None:
            yield out(at, total)
            total = None
        at, total = label, part if total is None else total + part
    if total is not None:
        yield out(at, total)


def _cored(batches: Iterator[pa.RecordBatch], limit: float) -> Iterator[pa.RecordBatch]:
    """Is a member within half the limit's angle of its component's mean?"""
    inside = math.cos(math.acos(limit) / 2) + 1e-6
    for batch in batches:
        if not batch.num_rows:
            continue
        core = np.array([bool(m @ u >= inside) for m, u in ((_unit(_matrix([t]))[0], _unit(_matrix([v]))[0])
                                                            for t, v in zip(batch.column("total").to_pylist(), batch.column("vec").to_pylist(), strict=True))])
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("label", "key", "vec", "n")), pa.array(core)], names=["label", "key", "vec", "n", "core"])


def _counted_rim(batches: Iterator[pa.RecordBatch], limit: float) -> Iterator[pa.RecordBatch]:
    """Cells of members and rim members: weights of the links between them, for both sides.  Two rim members count once a side."""
    for _, rows in _whole_cells(batches, ["label", "block", "slice"]):
        held, rim = [r for r in rows if not r["asks"]], [r for r in rows if r["asks"]]
        if not held or not rim:
            continue
        near = _linked(_matrix([r["vec"] for r in rim]), _matrix([r["vec"] for r in held]), limit)
        near &= np.array([r["key"] for r in rim], object)[:, None] != np.array([r["key"] for r in held], object)
        core = np.array([r["core"] for r in held])
        to_rim = near @ np.array([r["n"] for r in held], np.int64)
        to_core = (near.T @ np.array([r["n"] for r in rim], np.int64)) * core
        some = np.flatnonzero(to_core)
        yield pa.RecordBatch.from_arrays([pa.array([r["key"] for r in rim] + [held[i]["key"] for i in some], pa.binary()),
                                          pa.array(np.concatenate([to_rim, to_core[some]]))], names=["key", "others"])


def _link_counts(members: DataFrame, limit: float, whole: int) -> DataFrame:
    """``key, others``: rows of other classes linked with each class, from ``members(label, key, vec, n)`` of the components."""
    n = width(members.sparkSession)
    large = pin(members.groupBy("label").count().where(F.col("count") > whole).select("label"), "graph-large")
    small = members.join(large, "label", "left_anti").select("label", "key", "vec", "n").repartition(n, "label").sortWithinPartitions("label", "key")
    counts = small.mapInArrow(lambda it: _counted_whole(it, limit), "key binary, others long")
    if large.isEmpty():
        return counts
    big = pin(members.join(large, "label", "left_semi").select("label", "key", "vec", "n"), "graph-large-members")
    sums = big.mapInArrow(lambda it: _summed(it, False), "label binary, total binary").repartition(n, "label").sortWithinPartitions("label") \
        .mapInArrow(lambda it: _summed(it, True), "label binary, total binary")
    cored = pin(big.join(sums, "label").select("label", "key", "vec", "n", "total").mapInArrow(
        lambda it: _cored(it, limit), "label binary, key binary, vec binary, n long, core boolean"), "graph-cored")
    weight = cored.where("core").groupBy("label").agg(F.sum("n").alias("of"))
    inner = cored.where("core").join(weight, "label").select("key", (F.col("of") - F.col("n")).alias("others"))
    held = pin(_in_blocks(cored, "label", whole, "block"), "graph-held")
    rim = pin(_in_blocks(cored.where("not core"), "label", whole, "slice"), "graph-rim")
    columns = ["label", "block", "slice", "asks", "key", "vec", "n", "core"]
    ask = rim.join(held.select("label", "blocks").distinct(), "label") \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asks", F.lit(True)).select(columns)
    hold = held.join(rim.select("label", "slices").distinct(), "label") \
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).withColumn("asks", F.lit(False)).select(columns)
    cell = ["label", "block", "slice"]
    edge = hold.union(ask).repartition(n, *cell).sortWithinPartitions(*cell, "asks", "key") \
        .mapInArrow(lambda it: _counted_rim(it, limit), "key binary, others long")
    return counts.union(inner).union(edge).groupBy("key").agg(F.sum("others").alias("others"))


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", limit: float = COSINE,
                 shard: int = SHARD, probes: int = PROBES, expand: int = EXPAND, recall: float = RECALL, whole: int = WHOLE,
                 told: Callable[[float], None] = lambda r: None) -> DataFrame:
    """One row per row: vec_id, n_links, component_id (smallest id connected), kept (is it that row's id?).

    Rows are compared if their labels are equal and not null and their vectors of one length.
    Vectors that are null, empty, zero, or hold null or non-finite parts link with nothing; their
    component is their own id.  Every other row counts as a link, also one of the same id; rows of
    one id are judged by their own vectors.  A component whose ids are all null has a null id and
    keeps its rows.  Other columns are not read; no rows give none.  ``told`` gets each audited recall.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias(_ID), F.col(f"`{label_col}`").cast("string").alias("of"),
                          F.col(f"`{vec_col}`").cast("array<double>").alias(_VEC))
    good = F.col("of").isNotNull() & F.col(_VEC).isNotNull() \
        & F.coalesce(F.forall(_VEC, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) \
        & F.coalesce(F.exists(_VEC, lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    taking = rows.where("good").select(_ID, _VEC, F.concat_ws(" ", F.size(_VEC).cast("string"), "of").alias(_GROUP)) \
        .mapInArrow(_classed, "vec_id long, key binary, family string, vec binary")
    taking = pin(taking, "graph-rows")
    classes = pin(taking.groupBy("key").agg(F.first("family").alias("family"), F.first("vec").alias("vec"), F.count("*").alias("n"),
                                            F.min("vec_id").alias("id")), "graph-classes")
    centres = _centres(classes, shard)
    most = max((len(n) for n, _ in centres.values()), default=1)
    shared = spark.sparkContext.broadcast(centres)
    while True:
        links = _links(classes, shared, probes, expand, limit)
        of = pin(components(links).select(F.col("node").alias("key"), "label"), "graph-labels")
        labelled = pin(classes.join(of, "key", "left").withColumn("label", F.coalesce("label", "key")), "graph-labelled")
        reached = audit_recall(labelled, limit)
        told(reached)
        if reached >= recall or (probes >= most and expand >= BLOCK):
            break
        probes, expand = min(2 * probes, most), 2 * expand
    counts = _link_counts(labelled.join(of.select("label").distinct(), "label", "left_semi").select("label", "key", "vec", "n"), limit, whole)
    smallest = labelled.groupBy("label").agg(F.min("id").alias("component_id"))
    per_class = labelled.join(smallest, "label").join(counts, "key", "left") \
        .select("key", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    done = taking.select("vec_id", "key").join(per_class, "key").select("vec_id", "n_links", "component_id")
    alone = rows.where("not good").select(F.col(_ID).alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col(_ID).alias("component_id"))
    return done.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


# The same rows in DuckDB's SQL, by comparing all pairs.
ORACLE = r"""
WITH RECURSIVE good AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93
), reached(a, b) AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) c ON c.a = vec_id
LEFT JOIN (SELECT a, min(b) AS low FROM reached GROUP BY a) r ON r.a = vec_id
"""
