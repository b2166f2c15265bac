"""Centroid clustering on bit planes: exact k-means steps by AND and popcount.

A vector of 64 integer components becomes one unsigned 64-bit word per bit plane: bit i of
plane b is bit b of component i in two's complement, the highest plane with a negative
weight. Centroids are packed likewise, and

    v . c = sum over planes b, b' of weight(b) weight(b') popcount(V_b AND C_b')

so dot products, norms and squared distances are exact integers. The planes are packed once
and written below ``spark.checkpoint.dir``; every round scans that narrow table, assigns
each vector to its nearest centroid and adds up bits per cluster and component inside the
tasks. What leaves a task is one sum per cluster and component, whatever its rows; the
driver sees ``k`` x 64 sums a round. A centroid that has no vector stays where it is.

Rows take part if they have exactly 64 components, none null, NaN or infinite; other rows
are not returned. Components are ``floor(SCALE * x)``; beyond ``LIMIT`` they are set to it, since
their squared distances wouldn't fit 64 bits. Repeated rows count as often as they occur.
A null id is kept, but comes last among the first centroids; equal ids are told apart by
their components. With fewer than ``k`` vectors there are fewer centroids; an empty table gives
an empty result. Further columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from telemetra.llm.common import cut, release

WIDTH = 64
SCALE = 64
K, ROUNDS = 16, 3
LIMIT = 1 << 26


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def components(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component, as long."""
    return F.transform(vector, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale).cast("long"),
                                                            F.lit(LIMIT)), F.lit(-LIMIT)))


def kept_vectors(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v): the rows that take part, with integer components."""
    v = F.col(vector)
    return vectors.filter((F.size(v) == WIDTH) & F.forall(v, lambda x: finite(x.cast("double")))) \
        .select(F.col(id_col).alias("id"), components(v).alias("v"))


def plane_weights(planes: int) -> np.ndarray:
    """Value of a bit in each plane (two's complement)."""
    w = np.left_shift(np.int64(1), np.arange(planes, dtype=np.int64))
    w[-1] = -w[-1]
    return w


def pack_planes(values: np.ndarray, planes: int) -> np.ndarray:
    """(n, 64) integers to (n, planes) uint64 words."""
    out = np.empty((len(values), planes), dtype=np.uint64)
    for b in range(planes):
        bits = (values >> b & 1).astype(np.uint8)
        out[:, b] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of packed vectors (n, planes) with packed centroids (k, planes): (n, k)."""
    w, total = plane_weights(a.shape[1]), np.zeros((len(a), len(b)), dtype=np.int64)
    for i in range(a.shape[1]):
        for j in range(b.shape[1]):
            total += w[i] * w[j] * np.bitwise_count(a[:, i, None] & b[None, :, j]).astype(np.int64)
    return total


def norms(a: np.ndarray) -> np.ndarray:
    """Squared lengths of packed vectors."""
    w, total = plane_weights(a.shape[1]), np.zeros(len(a), dtype=np.int64)
    for i in range(a.shape[1]):
        for j in range(a.shape[1]):
            total += w[i] * w[j] * np.bitwise_count(a[:, i] & a[:, j]).astype(np.int64)
    return total


def cluster_sums(packed: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """(k, 64) componentwise sums: bits counted per cluster, component and plane, times the plane's weight."""
    w, total = plane_weights(packed.shape[1]), np.zeros((k, WIDTH), dtype=np.int64)
    member = (cluster[None, :] == np.arange(k)[:, None]).astype(np.float32)
    for start in range(0, len(packed), 1 << 16):                      # counts stay exact in float32
        part = slice(start, start + (1 << 16))
        for b in range(packed.shape[1]):
            words = np.ascontiguousarray(packed[part, b]).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(words, axis=1, bitorder="little").astype(np.float32)
            total += w[b] * (member[:, part] @ bits).astype(np.int64)
    return total


def packed_table(vectors: DataFrame, planes: int) -> DataFrame:
    """(id, planes, norm) of (id, v)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy().reshape(-1, WIDTH)
            words = pack_planes(values, planes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in words], pa.binary()), pa.array(norms(words))],
                names=["id", "planes", "norm"])
        release()
    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {kind}, planes binary, norm long")


def nearest(batch: pa.RecordBatch, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(planes, cluster, squared distance) of a batch of packed rows; ties go to the smaller number."""
    words = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<u8").reshape(batch.num_rows, -1)
    distance = batch.column(2).to_numpy()[:, None] - 2 * dots(words, centroids) + norms(centroids)[None, :]
    cluster = distance.argmin(1)
    return words, cluster, distance[np.arange(len(cluster)), cluster]


def round_sums(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, i, n, total): vectors and componentwise sums of the clusters around ``centroids``."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, WIDTH), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            words, cluster, _ = nearest(batch, centroids)
            total += cluster_sums(words, cluster, k)
            n += np.bincount(cluster, minlength=k)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(held, WIDTH).astype(np.int32)), pa.array(np.tile(np.arange(WIDTH, dtype=np.int32), len(held))),
             pa.array(np.repeat(n[held], WIDTH)), pa.array(total[held].ravel())], names=["cluster", "i", "n", "total"])
    return packed.mapInArrow(run, "cluster int, i int, n long, total long") \
        .groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def assigned(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, cluster, distance = nearest(batch, centroids)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                             names=["id", "cluster", "distance"])
        release()
    kind = packed.schema["id"].dataType.simpleString()
    return packed.mapInArrow(run, f"id {kind}, cluster int, distance long")


def first_centroids(vectors: DataFrame, k: int = K) -> list[list[int]]:
    """The ``k`` vectors with the smallest SHA-256 of ``1:<id>``, in hash order."""
    order = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    return [list(r["v"]) for r in vectors.orderBy(order.asc_nulls_last(), "v").limit(k).select("v").collect()]


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = K,
            rounds: int = ROUNDS) -> tuple[DataFrame, list[list[int]]]:
    """((id, cluster, distance) of every vector that takes part, the final centroids)."""
    kept = kept_vectors(vectors, id_col, vector)
    centroids = first_centroids(kept, k)
    low, high = kept.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    planes = 1 + max((max(-(low + 1), high).bit_length() if centroids else 0), 1)
    packed = cut(packed_table(kept, planes), "bit-planes")
    for _ in range(rounds if centroids else 0):
        for r in round_sums(packed, pack_planes(np.array(centroids, dtype=np.int64), planes)).collect():
            centroids[r["cluster"]][r["i"]] = r["total"] // r["n"]
    if not centroids:
        return vectors.sparkSession.createDataFrame([], f"id {kept.schema['id'].dataType.simpleString()}, cluster int, distance long") \
            .withColumnRenamed("id", id_col), []
    return assigned(packed, pack_planes(np.array(centroids, dtype=np.int64), planes)).withColumnRenamed("id", id_col), centroids


def cluster_report(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per vector: cluster, squared distance, its sums over the cluster and over all, the centroid's digest."""
    found, centroids = cluster(vectors, id_col, vector)
    found = cut(found, "clusters")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    spread = {r["cluster"]: int(r["d"]) for r in
              found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    told = [(c, str(spread[c]), str(sum(spread.values())), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
            for c, v in enumerate(centroids) if c in spread]
    small = found.sparkSession.createDataFrame(told, "cluster int, a string, b string, centroid_sha256 string")
    as_long = lambda c: F.least(F.col(c).cast("decimal(38,0)"), most).cast("long")
    return found.join(F.broadcast(small), "cluster").select(
        id_col, "cluster", "distance", as_long("a").alias("cluster_inertia"), as_long("b").alias("inertia"), "centroid_sha256")


def sql(k: int = K, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for the rows of op12: plain distances, the rounds unrolled."""
    steps, last = "", "c0"
    for r in range(1, rounds + 1):
        steps += f""",
a{r} AS (SELECT rid, v, arg_min(c, (d, c)) AS c FROM (
         SELECT k.rid, k.v, {last}.c, list_sum(list_transform(range(1, {WIDTH + 1}), lambda i: (k.v[i] - {last}.v[i]) * (k.v[i] - {last}.v[i]))) AS d
         FROM kept k, {last}) GROUP BY rid, v),
s{r} AS (SELECT c, list(m ORDER BY i) AS v FROM (
         SELECT c, i, floor_div AS m FROM (
           SELECT c, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS floor_div
           FROM (SELECT c, unnest(v) AS x, unnest(range(1, {WIDTH + 1})) AS i FROM a{r}) GROUP BY c, i)) GROUP BY c),
c{r} AS (SELECT p.c, coalesce(s.v, p.v) AS v FROM {last} p LEFT JOIN s{r} s ON s.c = p.c)"""
        last = f"c{r}"
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: greatest(least(floor({SCALE} * x::DOUBLE), {LIMIT}), -{LIMIT})::HUGEINT) AS v
  FROM embeddings WHERE len(embedding) = {WIDTH}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
         SELECT sha256('1:' || vec_id) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT {k})){steps},
ends AS (SELECT rid, vec_id, min(d) AS d, arg_min(c, (d, c)) AS c FROM (
           SELECT k.rid, k.vec_id, {last}.c, list_sum(list_transform(range(1, {WIDTH + 1}), lambda i: (k.v[i] - {last}.v[i]) * (k.v[i] - {last}.v[i]))) AS d
           FROM kept k, {last}) GROUP BY rid, vec_id)
SELECT e.vec_id, e.c::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY e.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(f.v, ',')) AS centroid_sha256
FROM ends e JOIN {last} f ON f.c = e.c
"""
