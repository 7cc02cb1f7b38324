"""Embedding near-duplicates: vectors linked by cosine, found by a subspace pigeonhole join.

Method: unit vectors with cosine ``c`` are at squared distance ``2 - 2c``. After
a random rotation the coordinates are split into blocks; two vectors within the
whole distance are, in at least one block, within that block's proportional
share of it. Each block is range-joined on its own: its space is cut into cells
by the signs of its first coordinates, and a vector visits the cells that its
ball of the block's radius reaches. Whatever passes in a block is verified in
full, in double precision on the given numbers, and counted in the first block
in which it passes, so the union of candidates holds each pair once.

Equal vectors collapse into one with a weight before the join. A cell above
``tile_rows`` is dealt into tiles; a task holds one tile and streams its
visitors by, so its memory is bounded. Tasks hand on link counts per vector and
a spanning forest of the links, never all pairs of a group.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components link with nothing and are their own component; vectors of
different lengths do not link; rows with a null id count as links but never
name a component; repeated ids are kept row by row; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditpulse.llm.common import cut, small_batches
from creditpulse.llm.components import components, union

SLACK = 1e-5  # of squared distances, for single-precision candidate tests
PAIRS = 1 << 16  # candidate pairs verified at a time


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_edges(dim: int, blocks: int) -> list[int]:
    return [round(i * dim / blocks) for i in range(min(blocks, dim) + 1)] if dim >= blocks else list(range(dim + 1))


class Vectors:
    """Vectors of one length: given numbers, and unit vectors rotated."""

    def __init__(self, raw: np.ndarray, weight: np.ndarray, node: np.ndarray, turn: np.ndarray):
        self.raw, self.weight, self.node = raw.astype(np.float64), weight, node
        # Scaled first, so that squares neither overflow nor vanish.
        self.raw = self.raw / np.abs(self.raw).max(axis=1, keepdims=True)
        self.norm = np.sqrt((self.raw * self.raw).sum(axis=1))
        self.turned = ((self.raw / self.norm[:, None]) @ turn).astype(np.float32)


def passing(x: Vectors, y: Vectors, i: np.ndarray, j: np.ndarray, block: int, edges: list[int], limit: float) -> np.ndarray:
    """Of the pairs ``(i, j)``, those whose first passing block is ``block``."""
    diff = (x.turned[i].astype(np.float64) - y.turned[j]) ** 2
    dim = edges[-1]
    ok = diff[:, edges[block]:edges[block + 1]].sum(axis=1) <= limit * (edges[block + 1] - edges[block]) / dim + SLACK
    for b in range(block):
        ok &= ~(diff[:, edges[b]:edges[b + 1]].sum(axis=1) <= limit * (edges[b + 1] - edges[b]) / dim + SLACK)
    return ok


def links(x: Vectors, y: Vectors, block: int, edges: list[int], threshold: float, same: bool):
    """Index arrays of linked pairs between two sets (within one set if ``same``: ``i < j``)."""
    limit = 2 - 2 * threshold
    lo, hi = edges[block], edges[block + 1]
    budget = np.float32(limit * (hi - lo) / edges[-1] + 10 * SLACK)
    a, b = x.turned[:, lo:hi], y.turned[:, lo:hi]
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    for start in range(0, len(b), 1024):
        near = aa[:, None] + bb[None, start:start + 1024] - 2 * (a @ b[start:start + 1024].T)
        i, j = np.nonzero(near <= budget)
        j = j + start
        if same:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), PAIRS):
            p, q = i[at:at + PAIRS], j[at:at + PAIRS]
            ok = passing(x, y, p, q, block, edges, limit)
            p, q = p[ok], q[ok]
            cosine = np.einsum("ij,ij->i", x.raw[p], y.raw[q]) / (x.norm[p] * y.norm[q])
            yield p[cosine >= threshold], q[cosine >= threshold]


def reached(turned: np.ndarray, splits: int, budget: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own cell of each row, and (row, cell) for every other cell its ball reaches."""
    own = ((turned[:, :splits] > 0) @ (1 << np.arange(splits))).astype(np.int64) if splits else np.zeros(len(turned), np.int64)
    patterns = np.arange(1 << splits)
    flips = (patterns[:, None] >> np.arange(splits)) & 1  # crossing to a cell costs the squares of the flipped coordinates
    cost = (turned[:, :splits].astype(np.float64) ** 2) @ flips.T
    row, pattern = np.nonzero(cost <= budget + 10 * SLACK)
    return own, row[pattern > 0], (own[row] ^ patterns[pattern])[pattern > 0]


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9,
                 blocks: int = 4, tile_rows: int = 8192, seed: int = 11) -> DataFrame:
    """id, ``n_links``, ``component_id`` and ``kept`` of every row."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    # Null components are refused too: forall() is then null.
    finite = F.forall("vec", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce((F.size("vec") > 0) & finite & F.exists("vec", lambda x: x != 0), F.lit(False))
    distinct = (rows.where(valid).groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
                .withColumn("node", F.monotonically_increasing_id()))
    distinct = cut(distinct, "emb-distinct")
    n = distinct.count()
    splits = max(0, math.ceil(math.log2(max(1, n / tile_rows))))

    def visits(batches):
        for batch in batches:
            vec, weight, node = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            dims = np.diff(vec.offsets.to_numpy())
            flat, offsets = vec.values.to_numpy(), vec.offsets.to_numpy()
            for dim in np.unique(dims):
                pick = np.flatnonzero(dims == dim)
                raw = flat[offsets[pick][:, None] + np.arange(dim)]
                v = Vectors(raw, weight[pick], node[pick], rotation(dim, seed))
                edges = block_edges(dim, blocks)
                for b in range(len(edges) - 1):
                    lo, hi = edges[b], edges[b + 1]
                    own, row, cell = reached(v.turned[:, lo:hi], min(splits, hi - lo), (2 - 2 * threshold) * (hi - lo) / dim)
                    row, cell = row[cell > own[row]], cell[cell > own[row]]  # a pair of cells meets in the larger
                    every = np.r_[np.arange(len(pick)), row]
                    body = raw.astype("<f8")
                    yield pa.record_batch([
                        pa.array(np.full(len(every), dim), pa.int32()), pa.array(np.full(len(every), b), pa.int32()),
                        pa.array(np.r_[own, cell]), pa.array(np.r_[np.zeros(len(pick), bool), np.ones(len(row), bool)]),
                        pa.array(v.node[every]), pa.array(v.weight[every]),
                        pa.array([body[i].tobytes() for i in every], pa.binary())],
                        names=["dim", "block", "cell", "visitor", "node", "weight", "body"])

    placed = distinct.repartition("node").select("vec", "weight", "node").mapInArrow(
        visits, "dim int, block int, cell long, visitor boolean, node long, weight long, body binary")
    # Tiles: a member of tile t is at home there and visits the lower tiles of its own cell.
    name = ["dim", "block", "cell"]
    big = cut(distinct.select("vec", "weight", "node").mapInArrow(cells_only(visits), "dim int, block int, cell long")
              .groupBy(*name).count().where(F.col("count") > tile_rows)
              .select(*name, F.ceil(F.col("count") / tile_rows).cast("int").alias("tiles")), "emb-tiles")
    tiles = F.coalesce("tiles", F.lit(1))
    mine = F.pmod(F.xxhash64("node"), tiles).cast("int")
    dealt = (placed.join(big, name, "left").withColumn("mine", mine)
             .withColumn("tile", F.explode(F.sequence(F.lit(0), F.when(F.col("visitor"), tiles - 1).otherwise(F.col("mine")))))
             .select(F.concat_ws("/", *name, "tile").alias("task"), "dim", "block",
                     (F.col("visitor") | (F.col("tile") != F.col("mine"))).alias("visitor"), "node", "weight", "body"))
    found = (dealt.repartition("task").sortWithinPartitions("task", "visitor")
             .mapInArrow(joiner(threshold, blocks, seed), "a long, b long, n long"))
    found = cut(found, "emb-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    roots = components(found.where("b is not null").select("a", "b"))
    known = cut(distinct.join(counts, "node", "left").join(roots, "node", "left")
                .select("vec", "id", "weight", F.coalesce("links", F.lit(0)).alias("links"),
                        F.coalesce("root", "node").alias("root")), "emb-known")
    least = known.groupBy("root").agg(F.min("id").alias("component"))
    known = cut(known.join(least, "root").select("vec", "weight", "links", "component"), "emb-classes")
    rows = rows.withColumn("vec", F.when(valid, F.col("vec")))
    return rows.join(known, "vec", "left").select(
        F.col("id").alias(id_col), F.coalesce(F.col("links") + F.col("weight") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("weight").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id")
    ).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


def cells_only(visits):
    """The homes of ``visits``, names alone."""
    def run(batches):
        for batch in visits(batches):
            yield batch.filter(pa.compute.invert(batch.column("visitor"))).select(["dim", "block", "cell"])

    return run


def joiner(threshold: float, blocks: int, seed: int):
    """Joins each task's homes with one another and with its visitors, which are
    sorted behind them. Emits ``(node, null, linked weight)`` and ``(node, node, null)``."""
    def vectors(cols, dim):
        raw = np.frombuffer(b"".join(cols[2]), "<f8").reshape(-1, dim)
        return Vectors(raw, np.array(cols[1], np.int64), np.array(cols[0], np.int64), rotation(dim, seed))

    def out(a, b, n):
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "n"])

    class Task:
        def __init__(self, dim, block):
            self.dim, self.block, self.edges = dim, block, block_edges(dim, blocks)
            self.parts, self.home = ([], [], []), None

        def settle(self):
            """All homes are in: join them with one another."""
            self.home = h = vectors(self.parts, self.dim)
            self.parent, self.linked = np.arange(len(h.node)), np.zeros(len(h.node), np.int64)
            for i, j in links(h, h, self.block, self.edges, threshold, True):
                np.add.at(self.linked, i, h.weight[j])
                np.add.at(self.linked, j, h.weight[i])
                self.parent = union(self.parent, i, j)

        def visit(self, cols):
            if self.home is None:
                self.settle()
            h, v = self.home, vectors(cols, self.dim)
            linked, parent = np.zeros(len(v.node), np.int64), np.r_[self.parent, len(h.node) + np.arange(len(v.node))]
            for i, j in links(h, v, self.block, self.edges, threshold, False):
                np.add.at(self.linked, i, v.weight[j])
                np.add.at(linked, j, h.weight[i])
                parent = union(parent, i, len(h.node) + j)
            hit = np.flatnonzero(linked)
            self.parent = parent[:len(h.node)]
            if len(hit):
                yield out(v.node[hit], [None] * len(hit), linked[hit])
                yield out(v.node[hit], h.node[parent[len(h.node) + hit]], [None] * len(hit))

        def close(self):
            if self.home is None:
                self.settle()
            h, hit = self.home, np.flatnonzero(self.linked)
            if len(hit):
                yield out(h.node[hit], [None] * len(hit), self.linked[hit])
                yield out(h.node[hit], h.node[self.parent[hit]], [None] * len(hit))

    def run(batches):
        name, task = None, None
        for batch in batches:
            names = batch.column("task").to_pylist()
            visitor = batch.column("visitor").to_numpy(zero_copy_only=False)
            change = [0] + [i for i in range(1, len(names)) if names[i] != names[i - 1] or visitor[i] != visitor[i - 1]]
            for start, stop in zip(change, [*change[1:], len(names)]):
                if names[start] != name:
                    if task:
                        yield from task.close()
                    name = names[start]
                    task = Task(batch.column("dim")[start].as_py(), batch.column("block")[start].as_py())
                cols = [batch.column(c).slice(start, stop - start).to_pylist() for c in ("node", "weight", "body")]
                if visitor[start]:
                    yield from task.visit(cols)
                else:
                    for part, new in zip(task.parts, cols):
                        part.extend(new)
        if task:
            yield from task.close()

    return run
