"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are told apart by ranges of their norm. Within a range, largest inner product becomes
smallest distance by one more coordinate: x/M is completed to length 1 (M: largest norm of the
range), a query is scaled to length 1. Each table hashes a vector by
floor((a . x + b) / w) under normally distributed a. A query visits its own bucket and buckets
perturbed by one step in some coordinates, in the order of their expected distance to the
query; candidates of all tables and ranges are ranked by the exact inner product in double precision.

Vectors are dealt to blocks of about ``BLOCK``, and every block has its own buckets, so what a
query finds in a block does not depend on the size of the table. Queries meet the blocks in
rounds: one block first, then as many more as it has met so far. From the second round on a
block reports only what is no worse than the worst of the best that the query has already, so
about as many rows leave a round as there are answers. A query whose buckets held fewer than
``ENOUGH`` vectors of a block is compared with the whole block: too few to tell near from far by.

Equal vectors are one candidate, which stands for its smallest ids.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.llm.hashing import mix
from ledgerspark.session import release, written

#: Tables, coordinates per hash, width of a cell and probes per table. Set for vectors whose
#: neighbours are hardly nearer than the rest; nearer neighbours need less.
TABLES, COORDINATES, CELL, PROBES = 20, 12, 2.5, 80
#: Vectors of a block, about, and queries that meet it in one task. Both are repeated per meeting.
BLOCK, QUERIES = 16_384, 8_192
#: Vectors of a block that a query scores at least.
ENOUGH = 2_000
#: Largest by smallest norm of a range.
RATIO = 1.25


def probe_sets(coordinates: int, probes: int) -> np.ndarray:
    """Perturbations by rank of distance, most promising first: +1 where a rank is moved.

    Ranks order the 2 m borders of a cell by the query's distance to them; ranks j and 2m-1-j
    are the two borders of one coordinate, so never both. Scores are the expected squares.
    """
    m = coordinates
    near = np.arange(1, m + 1)
    first = near * (near + 1) / (4 * (m + 1) * (m + 2))
    far = 1 - near / (m + 1) + near * (near + 1) / (4 * (m + 1) * (m + 2))
    cost = np.concatenate([first, far[::-1]])
    out, heap = [np.zeros(2 * m, bool)], [(cost[0], (0,))]
    while heap and len(out) < probes:
        total, chosen = heapq.heappop(heap)
        if not any(2 * m - 1 - k in chosen for k in chosen):
            moved = np.zeros(2 * m, bool)
            moved[list(chosen)] = True
            out.append(moved)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
    return np.array(out)


@dataclass
class Hashing:
    """The random functions, drawn from a fixed seed: every task has the same."""

    size: int
    norms: list[float]  # the largest of each hashed range
    tables: int
    coordinates: int
    cell: float

    def __post_init__(self):
        random = np.random.default_rng(7)
        self.a = random.normal(size=(self.tables, self.size + 1, self.coordinates))
        self.b = random.uniform(0, self.cell, (self.tables, self.coordinates))

    def _places(self, vectors: np.ndarray, table: int) -> np.ndarray:
        return (vectors @ self.a[table] + self.b[table]) / self.cell

    def _number(self, cells: np.ndarray, table: int, within: np.ndarray) -> np.ndarray:
        """``within``: the range, in a shape that fits the cells without their last axis."""
        out = np.broadcast_to(within * self.tables + table + 1, cells.shape[:-1]).astype(np.uint64)
        for k in range(cells.shape[-1]):
            out = mix(out * np.uint64(31) + cells[..., k].astype(np.int64).view(np.uint64))
        return out.view(np.int64)

    def buckets(self, vectors: np.ndarray, within: np.ndarray) -> np.ndarray:
        scaled = vectors / np.array(self.norms)[within][:, None]
        rest = np.sqrt(np.maximum(0, 1 - (scaled ** 2).sum(axis=1, keepdims=True)))
        full = np.hstack([scaled, rest])
        return np.stack([self._number(np.floor(self._places(full, t)), t, within) for t in range(self.tables)], axis=1)

    def probed(self, vectors: np.ndarray, sets: np.ndarray) -> np.ndarray:
        """Buckets to visit by query, table, range and probe."""
        full = np.hstack([vectors / np.linalg.norm(vectors, axis=1, keepdims=True), np.zeros((len(vectors), 1))])
        m, out = self.coordinates, []
        for t in range(self.tables):
            places = self._places(full, t)
            cells = np.floor(places)
            below = places - cells
            order = np.argsort(np.hstack([below, 1 - below]), axis=1, kind="stable")
            steps = np.zeros((len(vectors), len(sets), m))
            rows = np.arange(len(vectors))
            for rank in range(2 * m):
                border = order[:, rank]
                steps[rows[:, None], np.flatnonzero(sets[:, rank])[None, :], (border % m)[:, None]] += np.where(border < m, -1, 1)[:, None]
            moved = (cells[:, None, :] + steps)[:, None]
            out.append(np.concatenate([self._number(moved, t, np.int64(r)) for r in range(len(self.norms))], axis=1))
        return np.stack(out, axis=1)


def usable(vector: Column) -> Column:
    """Not null, not empty, every component finite and some not zero."""
    value = F.coalesce(vector, F.array().cast("array<double>"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(value, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0)


def _classes(rows: DataFrame, most: int) -> DataFrame:
    """``cid, vector, ids``: distinct vectors with their ``most`` smallest ids; cid is the least.

    Each task keeps the smallest ids of its own rows first, so a vector that a third of all rows
    have comes to one short list per task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("id").to_pylist(), batch.column("vector")
            values, found = np.array(lists.flatten(), np.float64), {}
            ends = np.concatenate([[0], np.cumsum(np.array(lists.value_lengths(), np.int64))])
            values += 0.0  # -0.0 and 0.0 are equal
            for k, i in enumerate(ids):
                found.setdefault(values[ends[k]:ends[k + 1]].tobytes(), []).append(i)
            vectors = [np.frombuffer(v, np.float64) for v in found]
            yield pa.RecordBatch.from_arrays([pa.array(vectors, pa.list_(pa.float64())), pa.array([sorted(x)[:most] for x in found.values()], pa.list_(pa.int64()))], ["vector", "ids"])

    part = rows.mapInArrow(run, "vector array<double>, ids array<long>")
    ids = F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, most)
    return part.groupBy("vector").agg(ids.alias("ids")).select(F.col("ids")[0].alias("cid"), "vector", "ids")


def _first(cids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best, ties to the smaller id."""
    if len(scores) > k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((cids[near], -scores[near]))[:k]]


def _searcher(k: int, hashing: Hashing, sets: np.ndarray):
    """Searches a block of vectors for some queries: ``qid, cid, score, scored``.

    Vectors of range -1 have a norm that cannot be hashed and are scored for every query.
    """
    def search(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))]
        if len(vectors) and len(asked):
            x, cids, within = np.stack(vectors["vector"]), vectors["cid"].to_numpy(), vectors["within"].to_numpy(np.int64)
            always, mine = within < 0, np.flatnonzero(within >= 0)
            cells = hashing.buckets(x[mine], within[mine]).ravel() if len(mine) else np.zeros(0, np.int64)
            order = np.argsort(cells, kind="stable")
            members = mine[order // hashing.tables]
            buckets, first, sizes = np.unique(cells[order], return_index=True, return_counts=True)
            step = max(1, 500 // max(1, len(hashing.norms)))
            for at in range(0, len(asked), step):
                part = asked.iloc[at:at + step]
                queries = np.stack(part["vector"])
                wanted = hashing.probed(queries, sets).reshape(len(part), -1) if len(mine) else np.zeros((len(part), 0), np.int64)
                place = np.minimum(np.searchsorted(buckets, wanted), len(buckets) - 1)
                held = buckets[place] == wanted
                for r, (qid, bound) in enumerate(zip(part["qid"], part["bound"])):
                    visited = place[r][held[r]]
                    n = sizes[visited]
                    met = always.copy()
                    met[members[np.repeat(first[visited] - np.cumsum(n) + n, n) + np.arange(n.sum())]] = True
                    found = np.flatnonzero(met)
                    if len(found) < ENOUGH:
                        found = np.arange(len(x))
                    scores = x[found] @ queries[r]
                    good = scores >= bound
                    kept, scores = found[good], scores[good]
                    best = _first(cids[kept], scores, k)
                    out.append((np.full(len(best), qid), cids[kept[best]], scores[best], np.full(len(best), len(found))))
        q, c, s, n = map(np.concatenate, zip(*out))
        return pd.DataFrame({"qid": q, "cid": c, "score": s, "scored": n})

    return search


def nearest(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES, coordinates: int = COORDINATES, cell: float = CELL, probes: int = PROBES) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found, or all candidates if there are fewer.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
    rows without id or of another length than most rows have. Repeated ids are one candidate
    per distinct vector. Ties go to the smaller id. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    vector = F.col(vector_col).cast("array<double>")
    own = rows.where(F.col(id_col).isNotNull() & usable(vector)).select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"), is_query.alias("asks"))
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    length = own.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return empty
    own = own.where(F.size("vector") == length["n"])
    # Own rows are left out at the end, so one more is looked for.
    classes = written(_classes(own.select("id", "vector"), k + 1))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v))
    largest = classes.agg(F.max(norm)).first()[0]
    if not largest:  # none left, or all too short to have a norm
        largest = 1.0
    level = F.coalesce(F.floor((F.lit(float(np.log(largest))) - F.log(norm)) / F.lit(float(np.log(RATIO)))), F.lit(-1)).cast("long")
    classes = classes.withColumn("level", level)
    # One row per range of norms: a few, whatever the number of vectors.
    ranges = classes.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("norm")).orderBy("level").collect()
    hashed = [r for r in ranges if 0 < r["norm"] < float("inf")]
    hashing, sets = Hashing(length["n"], [r["norm"] for r in hashed], tables, coordinates, cell), probe_sets(coordinates, probes)
    blocks = max(1, -(-sum(r["n"] for r in ranges) // BLOCK))
    numbers = [x for j, r in enumerate(hashed) for x in (F.lit(r["level"]), F.lit(j).cast("long"))]
    within = F.coalesce(F.create_map(*numbers)[F.col("level")], F.lit(-1).cast("long")) if hashed else F.lit(-1).cast("long")
    stored = classes.select("cid", "vector", within.alias("within"), F.pmod(F.xxhash64("cid"), F.lit(blocks)).alias("block"))
    # Zeros of either sign are one vector.
    plain = F.transform("vector", lambda v: v + F.lit(0.0))
    asking = written(own.where("asks").select("id", plain.alias("vector")).join(classes.select("cid", "vector"), "vector").select(F.col("id").alias("query_id"), F.col("cid").alias("qid")).distinct())
    queries = written(classes.join(asking.select(F.col("qid").alias("cid")).distinct(), "cid").select(F.col("cid").alias("qid"), "vector"))
    asked, best, met = queries.count(), None, 0
    while met < blocks:
        more = min(max(met, 1), blocks - met)
        deals = max(1, -(-asked * more // (blocks * QUERIES)))
        bounds = best.groupBy("qid").agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("n")).where(F.col("n") > k).select("qid", "bound") if best else spark.createDataFrame([], "qid long, bound double")
        own_block = F.pmod(F.xxhash64("qid"), F.lit(blocks))
        turns = F.explode(F.sequence(F.lit(met).cast("long"), F.lit(met + more - 1).cast("long"))).alias("turn")
        visits = queries.join(bounds, "qid", "left").select("qid", "vector", F.coalesce("bound", F.lit(float("-inf"))).alias("bound"), turns)
        visits = visits.withColumn("block", F.pmod(own_block + F.col("turn"), F.lit(blocks))).withColumn("deal", F.pmod(F.xxhash64("qid", F.lit(1)), F.lit(deals))).drop("turn")
        offered = stored.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))))
        new = offered.groupBy("block", "deal").cogroup(visits.groupBy("block", "deal")).applyInPandas(_searcher(k + 1, hashing, sets), "qid long, cid long, score double, scored long")
        new = new.select("qid", "cid", "score")
        place = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "cid"))
        earlier, best = best, written((best.unionByName(new) if best else new).withColumn("place", place).where(F.col("place") <= k + 1).drop("place"))
        if earlier:
            release(earlier)
        met += more
    ranked = best
    named = ranked.join(classes.select("cid", "ids"), "cid").select("qid", "score", F.explode("ids").alias("vec_id"))
    answers = asking.join(named, "qid").where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = answers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
