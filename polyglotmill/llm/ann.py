"""Approximate nearest neighbours (operator 3): vantage-point trees per shard.

Nearness is the largest inner product, |q| |x| cos. The trees hold directions
(vectors of norm 1), whose Euclidean distance d gives cos = 1 - d^2 / 2, and
the norms beside them. A shard's entries are cut into bands of like norms, and
every band grows one tree. A node keeps the range of its distances to the
vantage point and its largest and smallest norm. By the triangle inequality,
the query's direction is at least `gap` from all of a node's directions; so no
product in it exceeds |q| times a norm of the node times 1 - (gap relax)^2 / 2,
and the node is skipped if that is less than the k-th best product so far.
relax = 1 is exact search; larger factors skip more. Norms of any size and
spread only scale the bounds.

Equal vectors are one entry of the index, with their smallest ids; entries are
dealt by length and a hash of the vector to shards of about SHARD_ROWS. The
queries stream past each shard of their length. Shard results, k ids a query,
meet in one aggregation. Scores are computed again on the original vectors in
double precision, with the same summation for every pair; order is by score,
then by smaller vec_id. Entries whose products are too close to tell at the
k-th place are told apart by that sum, and ties by id, before any is left out.

Cases: null or zero vectors, and vectors with a null or non-finite component,
take no part, nor do null ids. Vectors of different lengths have no product:
each length is searched by itself. A query's own row (by vec_id) is never its
neighbour. Fewer than k candidates are all returned. An id with several vectors
asks with each, and is found with each; every pair of ids counts once, by its
best score. An empty table gives no rows. Rows repeating vec_id and vector are
one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, map_arrow

K = 20
RELAX = 1.1
#: Distinct vectors in a shard, about; bounds a task's memory.
SHARD_ROWS = 16_384
LEAF_ROWS = 256
#: A band's largest norm is at most so many times its smallest one, unless it has fewer rows than a leaf.
BAND = 1.25
QUERY_BLOCK = 1024
#: Products that differ by less than this part of |q| |x| are compared by the exact sum.
CLOSE = 1e-11


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array of doubles) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    finite = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    return finite.where(F.exists("v", lambda x: x != 0)).dropDuplicates(["vec_id", "v"])


class Tree:
    """Vantage-point trees over the rows of x, one for each band of norms; ids are the rows' smallest vec_ids."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, leaf: int = LEAF_ROWS):
        self.x, self.ids, self.leaf = x, ids, leaf
        largest = np.abs(x).max(axis=1, keepdims=True)  # so that no square leaves the range of doubles
        scaled = x / largest
        length = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
        self.norm, self.unit = length * largest[:, 0], scaled / length[:, None]
        order = np.argsort(-self.norm, kind="stable")
        self.bands, start = [], 0
        while start < len(order):
            end = int(np.searchsorted(-self.norm[order], -self.norm[order[start]] / BAND, side="right"))
            end = min(max(end, start + leaf), len(order))
            self.bands.append(self._node(order[start:end], 0))
            start = end

    def _node(self, rows: np.ndarray, depth: int) -> tuple:
        """(largest norm, smallest norm, rows of a leaf) or (largest, smallest, vantage row, two of (low, high, node))."""
        norms = float(self.norm[rows].max()), float(self.norm[rows].min())
        if len(rows) <= self.leaf:
            return (*norms, rows)
        vantage = rows[(depth * 7919) % len(rows)]
        far = np.sqrt(np.maximum(2 - 2 * (self.unit[rows] @ self.unit[vantage]), 0))
        order = np.argsort(far, kind="stable")
        half = len(rows) // 2
        sides = [(far[part].min(), far[part].max(), self._node(rows[part], depth + 1)) for part in (order[:half], order[half:])]
        return (*norms, vantage, *sides)

    def search(self, q: np.ndarray, k: int, relax: float) -> np.ndarray:
        """For each query, the numbers of its k best rows (or all), in any order; -1 where there are fewer."""
        largest = np.abs(q).max(axis=1, keepdims=True)
        scaled = q / largest
        length = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
        self.q, self.to = q, scaled / length[:, None]
        self.k, self.relax = k, relax
        # Products are kept divided by |q|.
        self.best, self.who = np.full((len(q), k), -np.inf), np.full((len(q), k), -1)
        for band in self.bands:  # large norms first
            self._visit(band, np.arange(len(q)))
        return self.who

    def _visit(self, node: tuple, of: np.ndarray) -> None:
        if not len(of):
            return
        if len(node) == 3:
            self._leaf(node[2], of, node[0])
            return
        most, least, vantage, near, far = node
        d = np.sqrt(np.maximum(2 - 2 * (self.to[of] @ self.unit[vantage]), 0))
        inside = d < (near[1] + far[0]) / 2
        for first, second, these in ((near, far, inside), (far, near, ~inside)):
            for low, high, child in (first, second):
                some, at = of[these], d[these]
                gap = np.maximum(np.maximum(low - at, at - high) - CLOSE, 0) * self.relax
                cos = 1 - gap * gap / 2
                bound = cos * np.where(cos > 0, child[0], child[1])
                self._visit(child, some[bound >= self.best[some].min(axis=1) - CLOSE * most])

    def _leaf(self, rows: np.ndarray, of: np.ndarray, most: float) -> None:
        s = np.concatenate([self.best[of], (self.to[of] @ self.unit[rows].T) * self.norm[rows]], axis=1)
        who = np.concatenate([self.who[of], np.broadcast_to(rows, (len(of), len(rows)))], axis=1)
        keep = np.argpartition(-s, self.k - 1, axis=1)[:, : self.k]
        kth = np.take_along_axis(s, keep, 1).min(axis=1)
        # Where more than k rows reach the k-th product, as far as it can be told, the exact sums and the ids decide.
        reach = s >= (kth - CLOSE * most)[:, None]
        for i in np.flatnonzero((reach.sum(axis=1) > self.k) & np.isfinite(kth)):
            some = np.flatnonzero(reach[i])
            exact = (self.x[who[i, some]] * self.q[of[i]]).sum(axis=1)
            keep[i] = some[np.lexsort((self.ids[who[i, some]], -exact))[: self.k]]
        self.best[of], self.who[of] = np.take_along_axis(s, keep, 1), np.take_along_axis(who, keep, 1)


def search(vectors: DataFrame, query_rule, k: int = K, relax: float = RELAX, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row for which query_rule (a condition on vec_id) holds, its k nearest other rows."""
    rows = cut(usable(vectors))
    queries = rows.where(query_rule)
    # Ids beyond the k + 1 smallest of equal vectors can't be among a query's k best: ties go to smaller ids.
    # Salted, so that a vector that fills much of the table is not gathered in one task.
    salted = rows.groupBy("v", F.pmod("vec_id", F.lit(64)).alias("salt")).agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).select("v", F.slice("ids", 1, k + 1).alias("ids"))
    index = cut(salted.groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids")))
    lengths = cut(index.groupBy(F.size("v").alias("length")).agg(F.ceil(F.count("*") / F.lit(shard_rows)).alias("shards")))
    total = lengths.agg(F.coalesce(F.sum("shards"), F.lit(0))).first()[0]
    shard = F.pmod(F.xxhash64("v"), F.col("shards")).cast("int")
    dealt = index.withColumn("length", F.size("v")).join(lengths, "length").select("length", shard.alias("shard"), F.lit(0).alias("kind"), "ids", "v")
    every = F.explode(F.sequence(F.lit(0), (F.col("shards") - 1).cast("int")))
    asked = queries.withColumn("length", F.size("v")).join(lengths, "length").select("length", every.alias("shard"), F.lit(1).alias("kind"), F.array("vec_id").alias("ids"), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, held, ids, now = None, [], [], None

        def vectors_of(batch: pa.RecordBatch) -> np.ndarray:
            return batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)

        def answer(qs: np.ndarray, qids: list[int]) -> pa.RecordBatch:
            out_i, out_s = [], []
            for q, qid, found in zip(qs, qids, tree.search(qs, k + 1, relax)):
                found = found[found >= 0]
                score = (tree.x[found, :] * q).sum(axis=1)
                pairs = sorted((-s, i) for s, e in zip(score.tolist(), found.tolist()) for i in ids[e] if i != qid)[:k]
                out_i.append([i for _, i in pairs])
                out_s.append([-s for s, _ in pairs])
            return pa.RecordBatch.from_arrays([pa.array(qids, pa.int64()), pa.array(out_i, pa.list_(pa.int64())), pa.array(out_s, pa.list_(pa.float64()))], ["query_id", "ids", "scores"])

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in range(3))))
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(edges[:-1], edges[1:]):
                part = batch.slice(a, b - a)
                if not part.num_rows:
                    continue
                length, own, kind = keys[a]
                if (length, own) != now:
                    tree, held, ids, now = None, [], [], (length, own)
                if kind == 0:
                    held.append(vectors_of(part))
                    ids += part.column(3).to_pylist()
                    continue
                if not held:
                    continue
                if tree is None:
                    tree = Tree(np.concatenate(held), np.array([x[0] for x in ids]))
                qs, qids = vectors_of(part), [i[0] for i in part.column(3).to_pylist()]
                for s in range(0, len(qs), QUERY_BLOCK):
                    yield answer(qs[s : s + QUERY_BLOCK], qids[s : s + QUERY_BLOCK])

    spread = dealt.unionByName(asked).repartition(max(1, int(total)), "length", "shard").sortWithinPartitions("length", "shard", "kind")
    parts = map_arrow(spread, run, "query_id long, ids array<long>, scores array<double>")
    flat = parts.select("query_id", F.explode(F.arrays_zip(F.col("scores").alias("score"), F.col("ids").alias("vec_id"))).alias("x")).select("query_id", F.col("x.score").alias("score"), F.col("x.vec_id").alias("vec_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = flat.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
