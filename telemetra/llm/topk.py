"""Exact top-k search by no-random-access aggregation over sorted lists.

The score of a query q and a vector x is the integer inner product, a sum over components,
so every component is a list of vectors sorted by its value, read from the top for a
positive query weight and from the bottom for a negative one. Candidates are read in blocks
that keep their own lists. In a block, for a batch of queries:

1. **Read** the next stretch of every list; the depth doubles from a quarter of the list.
2. **Bounds**: a component that a list has shown counts with its value; one not shown yet lies
   between the list's far end and its frontier. The upper bound of all candidates is
   ``max(X, frontier)``, and the lower bound the shown values or the far end, times the
   weights: two matrix products a sign.
3. **Stop** a query when few candidates, seen or not, have an upper bound that reaches its k-th best lower
   bound or the k-th best score it has carried over from the task's earlier blocks. Ties with
   that bound stay in. At full depth both bounds are the score.
4. **Resolve** the final scores of the candidates that are left, and merge them with the
   query's best so far, ties by smaller id.

A task emits each query's best k of its own candidates; a grouped limit, applied before and
after the shuffle, merges the tasks. Candidates never move. Queries are broadcast in slabs
of at most ``SLAB_COMPONENTS`` components, one scan of the candidates a slab; a slab's rows
are picked by the hash of their position in the written query table.

Components are ``floor(SCALE * x)``, within ``LIMIT``; vectors that are null, or hold null, NaN or
infinite components, take no part. A missing component of a shorter vector counts as 0.
Rows with the query's id are its own and no candidates for it; a null id is no query, and
comes last among ties. Repeated rows are searched and found as often as they occur. An empty
table gives an empty result; with fewer than k candidates all are returned. Further columns
are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.llm.common import cut, release

SCALE = 1024
K = 10
QUERY_MODULUS = 100
#: largest absolute component; products of up to 4,096 components fit 63 bits
LIMIT = 1 << 25
#: candidates a block, and queries whose bounds are held at once
BLOCK, BATCH = 4096, 256
#: components of the queries that are broadcast together (8 bytes each)
SLAB_COMPONENTS = 1 << 20
NO_SCORE = -(1 << 63)


def takes_part(vector: Column) -> Column:
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(ok, F.lit(False))


def components(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale).cast("long"),
                                                            F.lit(LIMIT)), F.lit(-LIMIT)))


def matrix(lists: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of a list array as a matrix, shorter ones filled with 0."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    out = np.zeros((len(lists), max(width, int(sizes.max(initial=0)))), dtype=np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = flat
    return out


class Block:
    """Candidates with a sorted list for every component."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, values: np.ndarray):
        self.ids, self.known, self.values = ids, known, values
        self.lists = np.sort(values, axis=0)

    def bounds(self, depth: int, positive: np.ndarray, negative: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(upper, lower) score bounds, candidates by queries, when ``depth`` entries of every list are read."""
        x, lists, n = self.values, self.lists, len(self.values)
        top, bottom = lists[n - depth], lists[depth - 1]
        upper = np.maximum(x, top) @ positive + np.minimum(x, bottom) @ negative
        if depth == n:
            return upper, upper
        lower = np.where(x >= top, x, lists[0]) @ positive + np.where(x <= bottom, x, lists[-1]) @ negative
        return upper, lower


class Best:
    """The k best candidates so far of each of ``m`` queries."""

    def __init__(self, m: int, k: int):
        self.m, self.k = m, k
        self.query = np.zeros(0, np.int64)
        self.score, self.id, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        query, score = np.concatenate([self.query, query]), np.concatenate([self.score, score])
        ids, known = np.concatenate([self.id, ids]), np.concatenate([self.known, known])
        order = np.lexsort((ids, ~known, -score, query))
        place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        order = order[place < self.k]
        self.query, self.score, self.id, self.known = query[order], score[order], ids[order], known[order]

    def floors(self) -> np.ndarray:
        """The k-th best score of every query that has k, else the smallest integer."""
        out = np.full(self.m, NO_SCORE, dtype=np.int64)
        start = np.searchsorted(self.query, np.arange(self.m))
        full = np.searchsorted(self.query, np.arange(self.m), side="right") - start >= self.k
        out[full] = self.score[start[full] + self.k - 1]
        return out


def search_block(block: Block, queries: np.ndarray, query_ids: np.ndarray, best: Best,
                 trace: list[tuple[int, int, int]] | None = None) -> None:
    """Add the block's best candidates of these queries to ``best``.

    ``trace`` gets (depth, length of the lists, queries that stopped there).
    """
    n, k = len(block.values), best.k
    reach = int(np.abs(block.values).max(initial=0)) * int(np.abs(queries).max(initial=0)) * queries.shape[1]
    kind = np.float64 if 4 * reach < 1 << 53 else np.int64               # both exact; only the first has fast products
    x = block.values
    part = Block.__new__(Block)
    part.values, part.lists = x.astype(kind), block.lists.astype(kind)
    weights = queries.T.astype(kind)
    floors = best.floors().astype(kind)
    active, depth = np.arange(len(queries)), max(1, (n + 3) // 4)
    while len(active):
        w = weights[:, active]
        upper, lower = part.bounds(depth, np.maximum(w, 0), np.minimum(w, 0))
        own = block.known[:, None] & (block.ids[:, None] == query_ids[None, active])
        floor = floors[active]
        if n > k:
            hidden = np.where(own, kind(NO_SCORE), lower)
            floor = np.maximum(floor, np.partition(hidden, n - k, axis=0)[n - k])
        alive = (upper >= floor[None, :]) & ~own
        left = alive.sum(0)
        done = (left <= max(4 * k, n // 64)) | (depth == n)
        at, which = np.nonzero(alive[:, done])
        if trace is not None:
            trace.append((depth, n, int(done.sum())))
        which = active[done][which]
        score = np.empty(len(at), dtype=np.int64)
        for i in range(0, len(at), 1 << 16):
            j = slice(i, i + (1 << 16))
            score[j] = (x[at[j]] * queries[which[j]]).sum(1)
        best.add(which, score, block.ids[at], block.known[at])
        active, depth = active[~done], min(n, 2 * depth)


def local_best(vectors: DataFrame, ids: np.ndarray, numbers: np.ndarray, values: np.ndarray, k: int) -> DataFrame:
    """(n, query_id, vec_id, score): each task's best k candidates of the queries of one slab."""
    slab = vectors.sparkSession.sparkContext.broadcast((ids, numbers, values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, told, queries = slab.value
        starts = range(0, len(queries), BATCH)
        best = [Best(len(queries[j:j + BATCH]), k) for j in starts]
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(i, BLOCK)
                x = matrix(rows.column(1), queries.shape[1])
                wide = np.pad(queries, ((0, 0), (0, x.shape[1] - queries.shape[1])))
                known = rows.column(0).is_valid().to_numpy(zero_copy_only=False)
                block = Block(rows.column(0).fill_null(0).to_numpy(), known, x)
                for j, b in zip(starts, best):
                    search_block(block, wide[j:j + BATCH], query_ids[j:j + BATCH], b)
        for j, b in zip(starts, best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(told[j + b.query]), pa.array(query_ids[j + b.query]), pa.array(b.id, mask=~b.known), pa.array(b.score)],
                names=["n", "query_id", "vec_id", "score"])
        release()
    return vectors.mapInArrow(run, "n long, query_id long, vec_id long, score long")


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = K,
           scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for every row where ``is_query`` holds."""
    v = F.col(vector)
    rows = vectors.filter(takes_part(v)).select(
        F.col(id_col).cast("long").alias("id"), components(v, scale).alias("v"), is_query.alias("q"))
    queries = cut(rows.filter(F.col("q") & F.col("id").isNotNull()).select("id", "v")
                  .withColumn("n", F.monotonically_increasing_id()), "topk-queries")
    count, width = queries.agg(F.count("*"), F.max(F.size("v"))).first()
    slabs = -(-count * max(1, width or 0) // SLAB_COMPONENTS)
    found = None
    for s in range(slabs):
        slab = queries.filter(F.pmod(F.hash("n"), F.lit(slabs)) == s).toArrow().combine_chunks()
        if slab.num_rows:
            column = lambda c: slab.column(c).chunk(0)  # noqa: E731, B023
            part = local_best(rows.select("id", "v"), column("id").to_numpy(), column("n").to_numpy(), matrix(column("v")), k)
            found = part if found is None else found.unionByName(part)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("n").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


SQL = f"""
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: greatest(least(floor({SCALE} * x::DOUBLE), {LIMIT}), -{LIMIT})::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id,
         coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0)::BIGINT AS score
  FROM kept q JOIN kept c ON c.vec_id IS DISTINCT FROM q.vec_id WHERE q.vec_id % {QUERY_MODULUS} = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored)
WHERE rank <= {K}
"""
