"""Lloyd's clustering of integer vectors with exact sums, the nearest centroid by Orchard's search.

Every centroid has a list of all centroids in ascending distance from it. The search for a vector walks
the list of the closest centroid so far. A centroid that is closer becomes the closest one, and its list is
walked from its start; centroids are marked once their distance is known, and not measured twice. The walk stops
at the first centroid that lies strictly beyond twice the distance of the vector: by the triangle
inequality none from there on is closer, and none is as close. All is integer arithmetic on squared
distances (four times the square stands for twice the distance), so ties are exact; the smaller number wins.
A batch of vectors takes each step together.

A round is one pass over the stored vectors with the centroids broadcast (``k`` times ``DIMENSIONS`` numbers,
whatever the data); tasks send one row of sums per centroid and batch, which Spark adds up. Only the new
centroids reach the driver.

Vectors with another number of components, or with a null or non-finite one, are left out. Components beyond
``LIMIT`` in size count as ``LIMIT``; a distance or sum that a 64-bit number cannot hold is null. Rows that repeat
are vectors of their own. A null id comes after all others in the choice of the first centroids and is
kept as null; equal ids are ordered by their vectors. With fewer vectors than centroids there are
fewer centroids; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.storage import discard, materialize

DIMENSIONS = 64
SCALE = 256
#: Integers keep their order and their sums fit a decimal up to here.
LIMIT = 1 << 62
# Squared distances of vectors within this size fit 64 bits, also four times over.
_PLAIN = 1 << 26
_LONG = 1 << 63


def integer_vectors(table: DataFrame, idx: str, vector: str, dimensions: int) -> DataFrame:
    """``(vec_id, v array<long>)`` of the vectors that are complete."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    kept = table.select(F.col(idx).cast("long").alias("vec_id"), x.alias("x")).filter(F.size("x") == dimensions)
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    edge = float(LIMIT)
    scaled = F.transform("x", lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-edge)), F.lit(edge))))
    return kept.filter(finite).select("vec_id", scaled.alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of their ids."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(key.asc_nulls_last(), "v").limit(k).select("v").collect()
    return as_matrix([r["v"] for r in rows])


def as_matrix(rows: list) -> np.ndarray:
    """64-bit integers where squares fit, else Python's integers."""
    plain = all(-_PLAIN <= c <= _PLAIN for row in rows for c in row)
    return np.array(rows, np.int64 if plain else object).reshape(len(rows), len(rows[0]) if rows else 0)


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every centroid the numbers of all centroids, closest first, and four times their squared distances."""
    apart = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(2)
    order = np.argsort(apart, axis=1, kind="stable")
    return order, np.take_along_axis(apart, order, 1)


def nearest(vectors: np.ndarray, centroids: np.ndarray, order: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(number, squared distance)`` of the closest centroid of every vector."""
    n, k = len(vectors), len(centroids)
    rows = np.arange(n)
    best = np.zeros(n, np.int64)
    distance = ((vectors - centroids[0]) ** 2).sum(1)
    place = np.zeros(n, np.int64)
    visited = np.zeros((n, k), bool)
    visited[:, 0] = True
    while len(rows):
        # A list is left where it ends, or where its next centroid lies beyond twice the distance.
        rows = rows[place[rows] < k]
        rows = rows[apart[best[rows], place[rows]] <= 4 * distance[rows]]
        candidate = order[best[rows], place[rows]]
        place[rows] += 1
        new = ~visited[rows, candidate]
        some, candidate = rows[new], candidate[new]
        visited[some, candidate] = True
        found = ((vectors[some] - centroids[candidate]) ** 2).sum(1)
        closer = (found < distance[some]) | (found == distance[some]) & (candidate < best[some])
        moved = some[closer]
        best[moved], distance[moved], place[moved] = candidate[closer], found[closer], 0
    return best, distance


def _blocks(parts: Iterator[pa.RecordBatch], at: int, dimensions: int, size: int = 2048):
    """Batches with their vectors as a matrix."""
    for part in parts:
        for start in range(0, part.num_rows, size):
            piece = part.slice(start, size)
            flat = piece.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            yield piece, flat if len(flat) == 0 or max(-int(flat.min()), int(flat.max())) <= _PLAIN else flat.astype(object)


def _shared(spark, centroids: np.ndarray):
    return spark.sparkContext.broadcast((centroids, *neighbour_lists(centroids)))


def _search(vectors: np.ndarray, centroids: np.ndarray, order: np.ndarray, apart: np.ndarray):
    if vectors.dtype != centroids.dtype:
        vectors, centroids, apart = (x.astype(object) for x in (vectors, centroids, apart))
    return nearest(vectors, centroids, order, apart)


def next_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids moved to the floor of the mean of their vectors; those without any stay."""
    k, dimensions = centroids.shape
    shared = _shared(vectors.sparkSession, centroids)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dimensions), object), np.zeros(k, np.int64)
        for _, block in _blocks(parts, 0, dimensions):
            cluster, _ = _search(block, *shared.value)
            order = np.argsort(cluster, kind="stable")
            present, starts = np.unique(cluster[order], return_index=True)
            if len(present):
                sums[present] += np.add.reduceat(block[order], starts, axis=0).astype(object)
            counts += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(counts)
        texts = [[str(x) for x in sums[c]] for c in used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used]), pa.array(texts, pa.list_(pa.string()))], names=["cluster", "n", "s"])

    parts = vectors.select("v").mapInArrow(run, "cluster int, n long, s array<string>")
    moved = [row.tolist() for row in centroids]
    # At most one row per centroid and component.
    cells = parts.select("cluster", "n", F.posexplode("s").alias("i", "x")).groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).cast("string").alias("s"))
    for row in cells.collect():
        moved[row["cluster"]][row["i"]] = int(row["s"]) // row["n"]
    shared.destroy()
    return as_matrix(moved)


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(vec_id, cluster, distance)`` with the squared distance as text, which has no bound."""
    dimensions = centroids.shape[1]
    shared = _shared(vectors.sparkSession, centroids)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, block in _blocks(parts, 1, dimensions):
            cluster, distance = _search(block, *shared.value)
            exact = pa.array([str(d) for d in distance.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(cluster, pa.int32()), exact], names=["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "v").mapInArrow(run, "vec_id long, cluster int, distance string")


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def cluster(table: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, idx: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """Every kept vector with its cluster, distance, the sums of distances and the digest of its centroid."""
    spark = table.sparkSession
    # Numbers of a stored row are read once a round; the source may be wider.
    vectors = materialize(integer_vectors(table, idx, vector, dimensions), "cluster-vectors")
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        discard(vectors)
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        centroids = next_centroids(vectors, centroids)
    assigned = materialize(assign(vectors, centroids), "cluster-assigned")
    discard(vectors)
    sums = {r["cluster"]: int(r["d"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("string").alias("d")).collect() if r["d"] is not None}

    def fits(x: int | None) -> int | None:
        return x if x is not None and x < _LONG else None

    # One row per centroid.
    whole = fits(sum(sums.values()))
    rows = [(c, fits(sums.get(c)), whole, centroid_digest(centroids[c])) for c in range(len(centroids))]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = assigned.join(F.broadcast(facts), "cluster")
    distance = F.col("distance").try_cast("long")
    return out.select("vec_id", "cluster", distance.alias("distance"), "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int = 40, rounds: int = 5, seed: int = 2) -> str:
    def assigned(c: str) -> str:
        return f"""
            SELECT id, arg_min(c, d * {2 * k} + c) AS c, min(d) AS d FROM (
                SELECT v.id, {c}.c, sum((v.x - {c}.x) * (v.x - {c}.x)) AS d FROM v JOIN {c} USING (i) GROUP BY v.id, {c}.c) GROUP BY id"""

    parts = [
        f"""e AS MATERIALIZED (
            SELECT row_number() OVER () AS id, vec_id, embedding FROM embeddings
            WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS})""",
        f"""v AS MATERIALIZED (
            SELECT id, unnest(range({DIMENSIONS})) AS i, CAST(floor({SCALE} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM e)""",
        f"first AS (SELECT id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM e QUALIFY c < {k})",
        "c0 AS MATERIALIZED (SELECT c, i, x FROM first JOIN v USING (id))",
    ]
    for r in range(1, rounds + 1):
        parts.append(f"""c{r} AS MATERIALIZED (
            SELECT o.c, o.i, CAST(CASE WHEN n IS NULL THEN o.x ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS x
            FROM c{r - 1} o LEFT JOIN (
                SELECT a.c, v.i, sum(v.x) AS s, count(*) AS n FROM ({assigned(f"c{r - 1}")}) a JOIN v USING (id) GROUP BY a.c, v.i) m ON m.c = o.c AND m.i = o.i)""")
    parts.append(f"a AS MATERIALIZED ({assigned(f'c{rounds}')})")
    parts.append(f"h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c)")
    return "WITH " + ",\n".join(parts) + """
        SELECT e.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.h AS centroid_sha256
        FROM a JOIN e USING (id) JOIN h USING (c)"""


OP_SQL = _sql()
