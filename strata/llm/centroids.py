"""Centroid clustering by a bisector tournament.

Vectors become integers, ``floor(SCALE * x)``.  A round assigns every vector to
its nearest centroid and moves each centroid to the floor of its vectors' mean.
The nearest is found without distances: for centroids i < j the plane halfway
between them has the integer normal ``2 (c_i - c_j)`` and the threshold
``|c_i|^2 - |c_j|^2``, and the sign of ``normal . x - threshold`` tells which is
nearer; zero means a tie, which the smaller number wins.  One centroid after the
other challenges the winner so far, so k - 1 sign tests leave the nearest, whose
distance alone is computed.

A round is a map over the vectors that adds up sums within each task and sends a
row for each centroid's component, so nothing grows with a cluster's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import small_batches, written

SCALE = 64
#: Up to this size of all components every product and sum of a test is exact in
#: doubles (64 components: 2 * 2^21 * 2^22 * 64 = 2^50); others use Python's integers.
SMALL = 1 << 21
LIMB = 32  # bits of a part of a sum


class Bisectors:
    """The planes between every two centroids."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, object)
        squares = (self.centroids**2).sum(1)
        self.normal = 2 * (self.centroids[:, None, :] - self.centroids[None, :, :])
        self.threshold = squares[:, None] - squares[None, :]
        self.small = max(abs(v) for c in centroids for v in c) <= SMALL
        if self.small:
            self.near = (self.centroids.astype("f8"), self.normal.astype("f8"), self.threshold.astype("f8"))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid for each row of
        ``x``: doubles of at most ``SMALL``, or Python integers."""
        fast = self.small and x.dtype != object
        centroids, normal, threshold = self.near if fast else (self.centroids, self.normal, self.threshold)
        x = x if fast else x.astype(object) if x.dtype == object else x.astype("i8").astype(object)
        best = np.zeros(len(x), "i8")
        for j in range(1, len(centroids)):
            side = np.einsum("nd,nd->n", x, normal[best, j]) if fast else (x * normal[best, j]).sum(1)
            best = np.where(side >= threshold[best, j], best, j)
        return best, ((x - centroids[best]) ** 2).sum(1)


def _integer(x: float) -> int:
    """floor(SCALE * x), also where the product leaves the range of doubles."""
    return int(x) * SCALE if abs(x) >= 2**53 else int(np.floor(SCALE * x))


def integers(vectors: pa.ListArray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integer vectors) of the small and of the large vectors."""
    x = np.asarray(vectors.flatten()).astype("f8").reshape(-1, width)
    small = (np.abs(x) <= SMALL / SCALE).all(1)
    yield np.flatnonzero(small), np.floor(SCALE * x[small])
    if not small.all():
        large = np.empty((int((~small).sum()), width), object)
        large[:] = [[_integer(v) for v in row] for row in x[~small].tolist()]
        yield np.flatnonzero(~small), large


def kept_vectors(table: DataFrame, width: int, column: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows with exactly ``width`` components, none null, NaN or infinite."""
    v = F.col(column).cast("array<double>")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") == width) & F.coalesce(usable.eqNullSafe(True), F.lit(False)))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors with the smallest sha256 of ``seed:vec_id``, repeated ids by
    their components; a missing id counts as empty text."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [[_integer(x) for x in r["v"]] for r in vectors.select(key.alias("h"), "v").orderBy("h", "v").limit(k).collect()]  # k rows


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after a round; those without vectors stay."""
    width, planes = len(centroids[0]), Bisectors(centroids)

    def run(batches):
        sums = np.zeros((len(centroids), width), object)
        counts = np.zeros(len(centroids), "i8")
        for b in batches:
            for _, x in integers(b.column(0), width):
                best, _ = planes.nearest(x)
                counts += np.bincount(best, minlength=len(centroids))
                part = x.astype("i8") if x.dtype != object else x
                for c in np.unique(best).tolist():
                    sums[c] += part[best == c].sum(0).astype(object)
        out = []
        for c in np.flatnonzero(counts).tolist():
            out.append((c, -1, int(counts[c])))
            for d, total in enumerate(sums[c].tolist()):
                sign, total, at = (-1 if total < 0 else 1), abs(total), d
                while total:
                    out.append((c, at, sign * (total & ((1 << LIMB) - 1))))
                    total, at = total >> LIMB, at + width
        cols = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int32(), pa.int32(), pa.int64()))], names=["c", "slot", "value"])

    sums = vectors.select("v").mapInArrow(run, "c int, slot int, value long").groupBy("c", "slot").agg(F.sum("value").alias("value"))
    total: dict[int, list[int]] = {}
    count: dict[int, int] = {}
    for c, slot, value in sums.collect():  # a row for each component of each centroid, and part of a sum
        if slot < 0:
            count[c] = value
        else:
            total.setdefault(c, [0] * width)[slot % width] += value << (LIMB * (slot // width))
    return [[t // count[c] for t in total.get(c, [0] * width)] if c in count else old for c, old in enumerate(centroids)]


def assign(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance) of each vector, the distance as a decimal
    text, exact for components of any size."""
    width, planes = len(centroids[0]), Bisectors(centroids)

    def run(batches):
        for b in batches:
            cluster, distance = np.zeros(b.num_rows, "i4"), np.zeros(b.num_rows, object)
            for rows, x in integers(b.column(1), width):
                best, apart = planes.nearest(x)
                cluster[rows], distance[rows] = best, apart
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster), pa.array([str(int(d)) for d in distance.tolist()], pa.string())], names=["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "v").mapInArrow(run, "vec_id long, cluster int, distance string")


def _long(x: Column) -> Column:
    return x.try_cast("long")


def cluster(table: DataFrame, k: int = 16, rounds: int = 3, width: int = 64, seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of
    each usable vector (exactly ``width`` components, all finite) of ``table``
    (vec_id, embedding).

    Other rows, and those of null vectors, give no row.  Repeated rows are
    vectors of their own; a null vec_id stays null.  With fewer than ``k``
    vectors each starts a centroid; an empty table gives no rows.  Distances and
    inertias past a long's range are null (their clusters are exact all the same).
    """
    small_batches(table.sparkSession, 4000)
    vectors = kept_vectors(table, width)
    centroids = first_centroids(vectors, k, seed)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centroids:
        return table.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    found = written(assign(vectors, centroids), "assigned")
    # Sums of at most 38 digits; null past them.
    by = found.groupBy("cluster").agg(F.try_sum(F.col("distance").try_cast("decimal(38,0)")).alias("inertia"), F.max(F.length("distance")).alias("digits"))
    rows = by.collect()  # k rows
    whole = all(r["digits"] <= 38 and r["inertia"] is not None for r in rows)
    fits = lambda v: int(v) if v is not None and int(v) < 2**63 else None
    total = fits(sum(int(r["inertia"]) for r in rows)) if whole else None
    facts = [(r["cluster"], fits(r["inertia"]) if r["digits"] <= 38 else None, total, hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()) for r in rows]
    facts = table.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", _long(F.col("distance")).alias("distance"), "cluster_inertia", "inertia", "centroid_sha256")


#: DuckDB SQL for ``cluster(embeddings)``.
def oracle(k: int = 16, rounds: int = 3, width: int = 64, seed: int = 1) -> str:
    apart = "list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [
        f"""kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width})""",
        f"""c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c, v FROM (SELECT * FROM kept ORDER BY sha256('{seed}:' || vec_id) LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT vec_id, any_value(k.v) AS v, min(CAST({apart} AS BIGINT) * {k} + c.c) AS best FROM kept k CROSS JOIN c{i} c GROUP BY vec_id)")
        if i < rounds:
            parts.append(
                f"""s{i} AS (
  SELECT c, d, sum(x) AS s, count(*) AS n FROM (SELECT best % {k} AS c, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM a{i}) GROUP BY c, d)"""
            )
            parts.append(f"m{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS v FROM s{i} GROUP BY c)")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m ON m.c = c.c)")
    last = f"""SELECT vec_id, CAST(best % {k} AS INTEGER) AS cluster, best // {k} AS distance,
  CAST(sum(best // {k}) OVER (PARTITION BY best % {k}) AS BIGINT) AS cluster_inertia, CAST(sum(best // {k}) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.best % {k}"""
    return "WITH " + ",\n".join(parts) + "\n" + last
