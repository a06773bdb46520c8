"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are fitted on a bounded sample (``sample_rows``); every row is then
routed to its leaf in every tree.  A query walks all trees through one priority
queue, the node with the best margin first, until the leaves it has met hold
``search_share`` of the rows (several trees' copies count each); the rows of
those leaves are reranked by the exact cosine.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass
class Forest:
    """Inner nodes (normals, cuts, children); a child below 0 is leaf ~child."""

    normals: np.ndarray
    cuts: np.ndarray
    children: np.ndarray
    roots: list[int]
    leaves: int

    def route(self, unit: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree (rows x trees)."""
        out = np.empty((len(unit), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            node = np.full(len(unit), root)
            live = np.flatnonzero(node >= 0)
            while len(live):
                at = node[live]
                side = np.einsum("ij,ij->i", unit[live], self.normals[at]) >= self.cuts[at]
                node[live] = self.children[at, side.astype(np.int64)]
                live = live[node[live] >= 0]
            out[:, t] = ~node
        return out

    def search(self, unit: np.ndarray, held: np.ndarray, want: float) -> list[int]:
        """Leaves to look at for one query, best first, until they hold ``want``
        rows; one queue for all trees, ordered by the worst margin on the way."""
        margin = self.normals @ unit - self.cuts if len(self.cuts) else np.empty(0)
        queue = [(-np.inf, root) for root in self.roots]
        heapq.heapify(queue)
        got, n = [], 0
        while queue and n < want:
            bound, node = heapq.heappop(queue)
            if node < 0:
                got.append(~node)
                n += int(held[~node])
                continue
            m = margin[node]
            heapq.heappush(queue, (max(bound, -m), int(self.children[node, 1])))
            heapq.heappush(queue, (max(bound, m), int(self.children[node, 0])))
        return got


def fit(sample: np.ndarray, trees: int, leaf_rows: int, seed: int = 1) -> Forest:
    """Trees over unit rows: a node's direction is the difference of two of its
    rows, drawn at random, its cut the median; rows that no draw tells apart
    stay together in one leaf."""
    rng = np.random.Generator(np.random.PCG64(seed))
    normals, cuts, children, roots, leaves = [], [], [], [], 0
    for _ in range(trees):
        todo = [(np.arange(len(sample)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            node = None
            for _ in range(5 if len(rows) > leaf_rows else 0):
                a, b = rng.choice(len(rows), 2, replace=False)
                direction = sample[rows[a]] - sample[rows[b]]
                seen = sample[rows] @ direction
                cut = np.median(seen)
                right = seen >= cut
                if 0 < right.sum() < len(rows):
                    node = len(cuts)
                    size = np.linalg.norm(direction)
                    normals.append(direction / size), cuts.append(cut / size), children.append([0, 0])
                    todo += [(rows[~right], node, 0), (rows[right], node, 1)]
                    break
            if node is None:
                node, leaves = ~leaves, leaves + 1
            if parent < 0:
                roots.append(node)
            else:
                children[parent][side] = node
    width = sample.shape[1]
    return Forest(np.array(normals).reshape(-1, width), np.array(cuts), np.array(children, np.int64).reshape(-1, 2), roots, leaves)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; a row's value depends on it alone."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(rows that take part, width): vec_id not null, no null or non-finite
    component, not all zero, and of the most frequent width."""
    v = F.col("embedding")
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast(kind).alias("embedding")).filter("vec_id is not null")
    limit = F.lit(float("inf"))
    rows = rows.filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)) & F.exists(v, lambda x: x != 0))
    width = rows.groupBy(F.size(v).alias("width")).count().orderBy(F.desc("count"), "width").first()
    return (rows.filter(F.size(v) == width[0]), width[0]) if width else (rows, 0)


def neighbours(vectors: DataFrame, every: int = 50, k: int = 5, trees: int = 16, leaf_rows: int = 64, sample_rows: int = 32_768,
               search_share: float = 1.5, shard_leaves: int = 16, block_rows: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row whose
    vec_id is divisible by ``every``, among all other rows.

    Rows named by ``usable`` take part, the others don't.  Equal vectors are one
    class in the index, whose k + 1 least vec_ids stand for all (no other can be
    among the k nearest); a repeated row is a row of its own; ties go to the
    smaller vec_id; with fewer candidates than k all come back; an empty table
    gives an empty result; other columns are not looked at."""
    schema = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    rows, width = usable(vectors)
    if not width:
        return spark.createDataFrame([], schema)
    kind = rows.schema["embedding"].dataType.simpleString()
    first = Window.partitionBy("embedding").orderBy("vec_id")
    classes = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1).groupBy("embedding").agg(
        F.array_sort(F.collect_list("vec_id")).alias("members")).withColumn("class", F.element_at("members", 1))
    total = classes.count()
    keep = F.pmod(F.xxhash64(F.lit("sample"), "class"), F.lit(1 << 40)) < min(1 << 40, (sample_rows << 40) // max(1, total))
    drawn = classes.filter(keep).select("class", "embedding").toArrow().sort_by("class")
    forest = fit(_unit(_matrix(drawn.column("embedding"), width)) if drawn.num_rows else np.zeros((0, width)), trees, leaf_rows)
    shared = spark.sparkContext.broadcast(forest)  # as large as the sample, not as the table

    def count_leaves(batches):
        held = np.zeros(shared.value.leaves, np.int64)
        for batch in batches:
            held += np.bincount(shared.value.route(_unit(_matrix(batch.column(0), width))).ravel(), minlength=len(held))
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["leaf", "n"])

    held = np.zeros(forest.leaves, np.int64)
    for r in classes.select("embedding").mapInArrow(count_leaves, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).collect():
        held[r.leaf] = r.n
    blocks = spark.sparkContext.broadcast((held + block_rows - 1) // block_rows)
    sizes = spark.sparkContext.broadcast(held)

    def place(batches):
        for batch in batches:
            leaf = shared.value.route(_unit(_matrix(batch.column(1), width)))
            for t in range(leaf.shape[1]):
                own = leaf[:, t]
                block = batch.column(0).to_numpy() % np.maximum(1, blocks.value[own])
                yield pa.RecordBatch.from_arrays([pa.array(own // shard_leaves), pa.array(block), pa.array(own), *batch.columns],
                                                 ["shard", "block", "leaf", "class", "embedding", "members"])

    def walk(batches):
        for batch in batches:
            unit = _unit(_matrix(batch.column(1), width))
            for i in range(batch.num_rows):
                met = np.sort(np.array(shared.value.search(unit[i], sizes.value, search_share * total), np.int64))
                for block in range(int(blocks.value[met].max(initial=0))):
                    leaf = met[blocks.value[met] > block]
                    shard, first = np.unique(leaf // shard_leaves, return_index=True)
                    take = pa.array(np.full(len(shard), i))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard), pa.array(np.full(len(shard), block)), pa.ListArray.from_arrays(pa.array(np.r_[first, len(leaf)], pa.int32()), pa.array(leaf)),
                         batch.column(0).take(take), batch.column(1).take(take)], ["shard", "block", "leaves", "query", "embedding"])

    index = classes.select("class", "embedding", "members").mapInArrow(
        place, f"shard long, block long, leaf long, class long, embedding {kind}, members array<long>")
    asked = rows.filter(F.col("vec_id") % every == 0)
    found = asked.select("embedding").join(classes.select("embedding", "class"), "embedding").select(F.col("class").alias("query"), "embedding").dropDuplicates(["query"])
    visits = found.mapInArrow(walk, f"shard long, block long, leaves array<long>, query long, embedding {kind}")

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            v, q = _matrix(left.column("embedding"), width), _matrix(right.column("embedding"), width)
            uv, uq = _unit(v), _unit(q)
            leaf, lists = left.column("leaf").to_numpy(), right.column("leaves").combine_chunks()
            met, asker = lists.flatten().to_numpy(), np.repeat(np.arange(len(q)), lists.value_lengths().to_numpy())
            for x in np.unique(met):
                a, b = np.flatnonzero(leaf == x), asker[met == x]
                if not len(a):
                    continue
                near, n = uq[b] @ uv[a].T, min(len(a), k + 1)
                least = np.partition(near, len(a) - n, axis=1)[:, len(a) - n]
                i, j = np.nonzero(near >= least[:, None] - 1e-9)  # with all ties; the exact score decides
                parts.append((b[i], a[j]))
        b, a = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.int64),) * 2
        score = cosines(q[b], v[a]) if parts else np.empty(0)
        query = right.column("query").to_numpy()[b]
        own = left.column("class").to_numpy()[a]
        order = np.lexsort((own, -score, query))
        order = order[np.r_[True, (query[order][1:] != query[order][:-1]) | (own[order][1:] != own[order][:-1])][: len(order)]]
        query, a, score = query[order], a[order], score[order]  # once each, if a shard holds leaves of two trees
        start = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.empty(0, np.int64)
        place = np.arange(len(query)) - np.repeat(start, np.diff(np.r_[start, len(query)]))
        keep = place < k + 1
        take = pa.array(a[keep])
        return pa.table({"query": pa.array(query[keep], pa.int64()), "class": left.column("class").take(take), "score": pa.array(score[keep], pa.float64()),
                         "members": left.column("members").take(take)})

    pairs = index.groupBy("shard", "block").cogroup(visits.groupBy("shard", "block")).applyInArrow(
        rerank, "query long, class long, score double, members array<long>")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    # several trees find the same pair; k + 1 classes hold the k nearest rows beside the query's own
    near = pairs.dropDuplicates(["query", "class"]).withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
    lists = near.groupBy("query").agg(F.collect_list(F.struct("score", "members")).alias("near"))
    mine = asked.join(classes.select("embedding", F.col("class").alias("query")), "embedding").select(F.col("vec_id").alias("query_id"), "query")

    pairs_of = F.flatten(F.transform("near", lambda c: F.transform(c["members"], lambda m: F.struct((-c["score"]).alias("less"), m.alias("vec_id")))))
    ranked = mine.join(lists, "query").select("query_id", F.array_sort(pairs_of).alias("all"))
    # one row with the query's own id is the query itself: with equal vectors it stands among the members
    own = F.array_position(F.transform("all", lambda c: c["vec_id"]), F.col("query_id"))
    rest = F.when(own == 0, F.col("all")).otherwise(F.concat(F.slice("all", 1, F.greatest(own - 1, F.lit(0)).cast("int")), F.slice("all", own.cast("int") + 1, F.size("all"))))
    return ranked.select("query_id", F.posexplode(F.slice(rest, 1, k))).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.vec_id").alias("vec_id"), (-F.col("col.less")).alias("score"))
