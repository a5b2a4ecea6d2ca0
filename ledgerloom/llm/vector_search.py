"""Approximate nearest neighbours by collision counting over sorted single projections.

Vectors are scaled to length 1, so the largest cosine is the least distance. Every vector is projected
on `PROJECTIONS` random normal directions, and each direction keeps the projections of a block of
vectors as one sorted array. For a radius R a query opens in each array the window of half width
`HALF * R` around its own projection. A vector at distance s falls into one window with chance
2 * Phi(HALF * R / s) - 1, which only depends on s / R, so growing windows stand for ever wider
buckets without new hashes (virtual rehashing). Every vector in a window collides; those with at
least `threshold` collisions are verified by their cosine in double precision.

A query starts at a radius below the distance of its `limit`-th best vector so far, and the radius
grows by `STEP`, each time counting only what the windows gained, until it reaches that distance: then
every nearer vector has been verified but for a chance of `MISS`, the binomial tail at the threshold.
No cap on candidates ends a search earlier. A first bound comes from a
sample of vectors, `SEED_VALUES` numbers in all.

Vectors are dealt into blocks of about `BLOCK` rows and queries into groups of about `GROUP`; each
pair of both is one unit of work, so a unit's memory does not grow with the input. The work does grow
as queries times blocks, as the contract's queries grow with the vectors. Of equal vectors only the
first `limit` + 1 ids can be among a query's nearest, so the others are left out by a rank that starts
before the shuffle, and a hot vector costs no more than others.

Defined cases: null, empty and zero vectors, and those with a null or non-finite component, take no
part; vectors of another length than the query's are no candidates; rows that repeat an id are
candidates of their own, but a query's own id is never its candidate; a query id on several rows is
searched by the first of its vectors; rows without id take no part; ties go to the smaller id; no rows
give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, erf, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import saved

PROJECTIONS = 80
HALF = 1.36
STEP = 1.15
MISS = 1e-3
BLOCK = 8_192
GROUP = 4_096
SEED_VALUES = 1 << 18
SEED = 12
SLACK = 1e-9  # cosines and distances are rounded; a tie must not end a search
NO_BOUND = -2.0
#: Smallest first radius, steps below the bound's distance at which a search starts, and a distance
#: beyond all others.
FIRST, START, FARTHEST = 1e-3, 4, 2.5


def collision_chance(ratio: float) -> float:
    """Chance that a vector at distance `ratio` radii falls into a window."""
    return erf(HALF / ratio / sqrt(2))


def collisions_needed(projections: int, miss: float) -> int:
    """The largest count that a vector within the radius reaches but for a chance of `miss`."""
    p, below = collision_chance(1.0), 0.0
    for count in range(projections + 1):
        below += comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if below > miss:
            return count
    return projections


def usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def scaled(vectors) -> np.ndarray:
    """Vectors in double precision, scaled by powers of two, which changes no cosine."""
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of every row of x with y."""
    return (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum())


class SortedProjections:
    """The sorted arrays of one block of vectors of one length."""

    def __init__(self, unit: np.ndarray, projections: int = PROJECTIONS):
        draw = np.random.default_rng([SEED, unit.shape[1]])
        self.directions = draw.standard_normal((unit.shape[1], projections))
        values = unit @ self.directions
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(values.T, self.order, axis=1)
        self.count = len(unit)

    def windows(self, centre: np.ndarray, half: float) -> tuple[list[int], list[int]]:
        """First place and end of the window in every array."""
        low = [int(a.searchsorted(x, "left")) for a, x in zip(self.sorted, centre - half, strict=True)]
        high = [int(a.searchsorted(x, "right")) for a, x in zip(self.sorted, centre + half, strict=True)]
        return low, high


class Collisions:
    """Collisions of every vector of a block with one query, for growing radii."""

    def __init__(self, index: SortedProjections, centre: np.ndarray):
        self.index, self.centre = index, centre
        self.total = np.zeros(index.count, np.int64)
        self.low, self.high = index.windows(centre, 0.0)
        self.high = self.low

    def grow(self, radius: float) -> np.ndarray:
        """Adds what the windows of this radius hold beyond those of the last one."""
        low, high = self.index.windows(self.centre, HALF * radius)
        gained = [
            row[at:end]
            for row, a, b, c, d in zip(self.index.order, low, self.low, self.high, high, strict=True)
            for at, end in ((a, b), (c, d))
        ]
        self.total += np.bincount(np.concatenate(gained), minlength=self.index.count)
        self.low, self.high = low, high
        return self.total


def distance_of(cosine: float) -> float:
    return sqrt(max(0.0, 2 - 2 * cosine))


class Block:
    """The vectors of one block, and searches among them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int, miss: float):
        self.ids, self.vectors = ids, vectors
        norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        self.index = SortedProjections(vectors / norms, projections)
        self.needed = collisions_needed(projections, miss)

    def nearest(self, query_id: int, query: np.ndarray, bound: float, limit: int):
        """(ids, cosines) of the nearest vectors with a cosine of `bound` or more, at most `limit`."""
        unit = query / np.sqrt((query * query).sum())
        collisions = Collisions(self.index, unit @ self.index.directions)
        open_ = self.ids != query_id
        at, found = np.zeros(0, np.int64), np.zeros(0)
        radius = max(FIRST, distance_of(bound) / STEP**START)
        while True:
            new = np.flatnonzero((collisions.grow(radius) >= self.needed) & open_)
            open_[new] = False
            cosine = cosines(self.vectors[new], query)
            near = cosine >= bound
            at, found = np.append(at, new[near]), np.append(found, cosine[near])
            order = np.lexsort((self.ids[at], -found))[:limit]
            at, found = at[order], found[order]
            if len(at) == limit:
                bound = max(bound, found[-1])
            # Without a bound all vectors are wanted, and windows without ends hold them.
            reach = distance_of(bound) + SLACK if bound > NO_BOUND else float("inf")
            if radius >= reach:
                return self.ids[at], found
            radius = min(radius * STEP, reach) if radius < FARTHEST else reach


def usable_vectors(vectors: DataFrame, limit: int) -> DataFrame:
    """(vec_id, embedding, dim): usable rows, of equal vectors those of the first `limit` + 1 ids.

    Of rows that repeat an id and its vector the first `limit` stay. Written once.
    """
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable("embedding")).select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
    )
    among_equals = Window.partitionBy("embedding").orderBy("vec_id")
    ranked = rows.select(
        "*", F.dense_rank().over(among_equals).alias("number"), F.rank().over(among_equals).alias("first"),
        F.row_number().over(among_equals).alias("place"),
    )
    return saved(
        ranked.filter((F.col("number") <= limit + 1) & (F.col("place") - F.col("first") < limit))
        .select("vec_id", "embedding", F.size("embedding").alias("dim"))
    )


def query_vectors(vectors: DataFrame, divisor: int) -> DataFrame:
    """(query_id, vector, dim): one usable vector of every id divisible by `divisor`."""
    rows = vectors.filter(
        F.col("vec_id").isNotNull() & (F.col("vec_id") % divisor == 0) & usable("embedding")
    )
    by_id = Window.partitionBy("query_id").orderBy("vector")
    return (
        rows.select(
            F.col("vec_id").cast("long").alias("query_id"),
            F.col("embedding").cast("array<double>").alias("vector"),
        )
        .withColumn("place", F.row_number().over(by_id)).filter("place = 1")
        .select("query_id", "vector", F.size("vector").alias("dim"))
    )


def bounded(queries: DataFrame, vectors: DataFrame, limit: int) -> DataFrame:
    """Adds `bound`: a cosine that `limit` vectors of a sample of bounded size reach; written once."""
    draw = F.xxhash64("vec_id", F.lit(SEED))
    dims = [r["dim"] for r in vectors.groupBy("dim").count().orderBy(F.desc("count")).limit(1).collect()]
    rows = max(limit + 1, SEED_VALUES // max(dims, default=1))
    sample = vectors.filter(F.col("dim").isin(dims)).orderBy(draw, "vec_id").limit(rows).collect()
    ids = np.array([r["vec_id"] for r in sample], np.int64)
    seeds = scaled([r["embedding"] for r in sample]) if sample else np.zeros((0, 0))

    def bound(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in rows:
            out = batch.copy()
            values = []
            for query_id, vector in zip(batch["query_id"], batch["vector"], strict=True):
                others = seeds[ids != query_id]
                if len(others) < limit or len(vector) != others.shape[1]:
                    values.append(NO_BOUND)
                    continue
                best = np.sort(cosines(others, scaled([vector])[0]))[-limit]
                values.append(float(best) - SLACK)
            out["bound"] = values
            yield out

    return saved(queries.mapInPandas(bound, "query_id long, vector array<double>, dim int, bound double"))


def search(
    vectors: DataFrame,
    divisor: int = 50,
    limit: int = 5,
    projections: int = PROJECTIONS,
    miss: float = MISS,
    block: int = BLOCK,
    group: int = GROUP,
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows of every row whose id is divisible."""
    every = usable_vectors(vectors, limit)
    queries = bounded(query_vectors(vectors, divisor), every, limit)
    blocks = max(1, ceil(every.count() / block))
    groups = max(1, ceil(queries.count() / group))
    numbers = F.sequence(F.lit(0), F.lit(groups - 1))
    left = every.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)).cast("int"))
    left = left.withColumn("group", F.explode(numbers))
    right = queries.withColumn("group", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    unit = ["block", "group", "dim"]

    def nearest(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(asked):
            held = Block(rows["vec_id"].to_numpy(np.int64), scaled(rows["embedding"]), projections, miss)
            vectors = scaled(asked["vector"])
            for query_id, query, bound in zip(asked["query_id"], vectors, asked["bound"], strict=True):
                ids, cosine = held.nearest(query_id, query, bound, limit)
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids, "score": cosine}))
        if not out:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return pd.concat(out)

    found = saved(
        left.groupBy(*unit).cogroup(right.groupBy(*unit))
        .applyInPandas(nearest, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
    return ranked.select("query_id", "rank", "vec_id", "score")
