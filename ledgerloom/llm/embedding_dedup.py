"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, with multiprobe.

A vector is rotated by three rounds of random signs and a Hadamard transform. The nearest vertex of
the cross-polytope (the largest coordinate and its sign) is one hash; a table's bucket joins `depth`
of them. Each vector also enters the buckets where one hash is replaced by its second vertex. The
depth follows the number of vectors, so buckets of unrelated vectors stay small; the number of tables
follows from the depth: a simulation with fixed seed gives the chance that two vectors at the
threshold meet in a table, and tables are added until a link is missed with chance `MISS` at most.

Pairs that meet are verified by their cosine in double precision, inside blocks: a bucket of any size
is dealt over pairs of blocks of about `BLOCK` rows. A pair counts in the first bucket it meets in,
so counts add up without listing pairs; for components each block sends a few links per vector.
Equal vectors are one class before all this, so copies cost nothing.

Defined cases: null, empty and zero vectors, and those with a null or non-finite component, link
with nothing; vectors of other lengths link with nothing; rows that repeat an id are vectors of
their own; a null id comes out as it is, and components take the smallest id known (null if none);
no rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import saved, shuffle_width
from ledgerloom.llm.components import connected_components, spanning

THRESHOLD = 0.9
MISS = 1e-5
BUCKET_ROWS = 64
BLOCK = 1024
SEED = 4
ROUNDS = 3
SIMULATED = 4_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast transform along the last axis, whose length is a power of two."""
    size, half = x.shape[-1], 1
    shape = x.shape
    while half < size:
        y = x.reshape(*shape[:-1], size // (2 * half), 2, half)
        x = np.stack([y[..., 0, :] + y[..., 1, :], y[..., 0, :] - y[..., 1, :]], axis=-2)
        x = x.reshape(shape)
        half *= 2
    return x / np.sqrt(size)


class Hasher:
    """Buckets of vectors of one length."""

    def __init__(self, length: int, depth: int, tables: int):
        self.size = max(2, 1 << (length - 1).bit_length())
        self.depth, self.tables = depth, tables
        draw = np.random.default_rng(SEED)
        shape = (ROUNDS, tables, depth, self.size)
        self.signs = np.where(draw.random(shape) < 0.5, -1.0, 1.0)

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, tables, 1 + depth): the bucket, then one per hash with its second vertex."""
        x = np.zeros((len(vectors), 1, 1, self.size))
        x[:, 0, 0, : vectors.shape[1]] = vectors
        for signs in self.signs:
            x = hadamard(x * signs)
        near = np.argpartition(-np.abs(x), 1, axis=-1)[..., :2]
        value = np.take_along_axis(x, near, axis=-1)
        swap = np.abs(value[..., 0]) < np.abs(value[..., 1])
        vertex = near * 2 + (value > 0)
        first = np.where(swap, vertex[..., 1], vertex[..., 0]).astype(np.int64)
        second = np.where(swap, vertex[..., 0], vertex[..., 1]).astype(np.int64)
        place = (2 * self.size) ** np.arange(self.depth, dtype=np.int64)
        main = (first * place).sum(axis=-1)
        probes = main[..., None] + (second - first) * place
        return np.concatenate([main[..., None], probes], axis=-1)


def meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(pairs, tables): whether two vectors share a bucket, given their buckets."""
    return (a[..., :, None] == b[..., None, :]).any(axis=(-1, -2))


def tables_needed(length: int, depth: int, threshold: float, miss: float) -> int:
    """Tables after which a pair at the threshold has not met with chance `miss` at most."""
    draw = np.random.default_rng(SEED)
    x = draw.standard_normal((SIMULATED, length))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = draw.standard_normal((SIMULATED, length))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    norm = np.linalg.norm(z, axis=1, keepdims=True)
    z /= np.where(norm > 0, norm, 1)
    y = threshold * x + np.sqrt(1 - threshold**2) * z
    hasher = Hasher(length, depth, 4)
    chance = min(0.999, max(0.01, float(meeting(hasher.buckets(x), hasher.buckets(y)).mean())))
    return max(1, int(np.ceil(np.log(miss) / np.log(1 - chance))))


def depth_for(rows: int, length: int) -> int:
    """Hashes per bucket, so that unrelated vectors share a bucket with about `BUCKET_ROWS`."""
    vertices = 2 * max(2, 1 << (length - 1).bit_length())
    depth = 1
    while rows * (depth + 1) / vertices**depth > BUCKET_ROWS and vertices ** (depth + 1) < 1 << 62:
        depth += 1
    return depth


def classes_of(vectors: DataFrame) -> DataFrame:
    """(node, embedding, weight) of distinct usable vectors."""
    usable = (
        (F.size("embedding") > 0)
        & F.forall(
            "embedding",
            lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
        )
        & F.exists("embedding", lambda x: x != 0)
    )
    classes = (
        vectors.filter(F.coalesce(usable, F.lit(False)))
        .groupBy("embedding")
        .agg(F.count(F.lit(1)).alias("weight"))
    )
    return saved(classes.withColumn("node", F.monotonically_increasing_id()))


def unit_vectors(embeddings) -> np.ndarray:
    x = np.stack([np.asarray(e, np.float64) for e in embeddings])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def bucket_rows(classes: DataFrame, shape: dict[int, tuple[int, int]]) -> DataFrame:
    """(node, dim, tab, bucket): every bucket of every class."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashers = {dim: Hasher(dim, *s) for dim, s in shape.items()}
        for batch in batches:
            lengths = batch["embedding"].map(len)
            for dim, part in batch.groupby(lengths):
                for at in range(0, len(part), 500):
                    some = part.iloc[at : at + 500]
                    found = hashers[dim].buckets(unit_vectors(some["embedding"]))
                    rows, tables, probes = found.shape
                    yield pd.DataFrame(
                        {
                            "node": np.repeat(some["node"].to_numpy(), tables * probes),
                            "dim": np.int32(dim),
                            "tab": np.tile(np.repeat(np.arange(tables, dtype=np.int32), probes), rows),
                            "bucket": found.ravel(),
                        }
                    )

    return classes.select("node", "embedding").mapInPandas(
        find, "node long, dim int, tab int, bucket long"
    )


def block_units(rows: DataFrame, block: int) -> DataFrame:
    """Rows of buckets with company, dealt to pairs of blocks: unit (low, high) and own block."""
    bucket = ["dim", "tab", "bucket"]
    sizes = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(float(block))).cast("int")
    dealt = rows.join(sizes, bucket).withColumn("blocks", blocks)
    dealt = dealt.withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(
        *bucket, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "own", "node",
    )


def first_meetings(hasher: Hasher, x, left, right, table: int, bucket: int) -> np.ndarray:
    """Which pairs (rows `left`, `right` of x) meet in this bucket for the first time."""
    used, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    keys = hasher.buckets(x[used])
    a, b = keys[at[: len(left)]], keys[at[len(left) :]]
    fresh = np.ones(len(left), bool)
    for t in range(table):
        fresh &= ~meeting(a[:, t], b[:, t])
    same = a[:, table, :, None] == b[:, table, None, :]
    lowest = np.where(same, a[:, table, :, None], np.iinfo(np.int64).max).min(axis=(1, 2))
    return fresh & (lowest == bucket)


UNIT = ["dim", "tab", "bucket", "low", "high"]


def verified(units: DataFrame, shape: dict[int, tuple[int, int]], threshold: float) -> DataFrame:
    """(node, links, tied): links found in a block, and a link (or the node itself) for components.

    `units` comes sorted by unit within partitions.
    """

    def check(unit: tuple, rows: pd.DataFrame, hashers: dict) -> pd.DataFrame | None:
        dim, table, bucket, low, high = unit
        x = unit_vectors(rows["embedding"])
        own = rows["own"].to_numpy()
        ends = [np.flatnonzero(own == low), np.flatnonzero(own == high)]
        if not len(ends[0]) or not len(ends[1]):
            return None
        close = x[ends[0]] @ x[ends[1]].T >= threshold
        if low == high:
            close = np.triu(close, 1)
        left, right = np.nonzero(close)
        if not len(left):
            return None
        left, right = ends[0][left], ends[1][right]
        if dim not in hashers:
            hashers[dim] = Hasher(dim, *shape[dim])
        fresh = np.concatenate(
            [
                first_meetings(hashers[dim], x, left[at : at + 20_000], right[at : at + 20_000], table, bucket)
                for at in range(0, len(left), 20_000)
            ]
        )
        left, right = left[fresh], right[fresh]
        if not len(left):
            return None
        weight, node = rows["weight"].to_numpy(), rows["node"].to_numpy()
        links = np.bincount(left, weight[right], len(rows)) + np.bincount(right, weight[left], len(rows))
        tied = node[spanning(left, right, len(rows))]
        found = links > 0
        return pd.DataFrame(
            {"node": node[found], "links": links[found].astype(np.int64), "tied": tied[found]}
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashers: dict = {}
        held: list[pd.DataFrame] = []
        for batch in batches:
            if held:
                batch = pd.concat([*held, batch], ignore_index=True)
            if batch.empty:
                continue
            keys = batch[UNIT].to_numpy(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            # The last unit may go on in the next batch.
            for start, end in zip(starts[:-1], starts[1:], strict=True):
                out = check(tuple(int(k) for k in keys[start]), batch.iloc[start:end], hashers)
                if out is not None:
                    yield out
            held = [batch.iloc[starts[-1] :]]
        if held:
            last = held[0]
            out = check(tuple(int(k) for k in last[UNIT].iloc[0]), last, hashers)
            if out is not None:
                yield out

    return units.mapInPandas(run, "node long, links long, tied long")


def find_links(classes: DataFrame, threshold: float) -> DataFrame:
    """(node, links, tied) over all blocks of all buckets."""
    shape = {}
    for row in classes.groupBy(F.size("embedding").alias("dim")).count().collect():
        depth = depth_for(row["count"], row["dim"])
        shape[row["dim"]] = (depth, tables_needed(row["dim"], depth, threshold, MISS))
    units = block_units(bucket_rows(classes, shape), BLOCK)
    dealt = (
        units.join(classes, "node")
        .repartition(shuffle_width(classes.sparkSession), *UNIT)
        .sortWithinPartitions(*UNIT)
    )
    return saved(verified(dealt, shape, threshold))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row per vector."""
    vectors = vectors.select("vec_id", "embedding")
    classes = classes_of(vectors)
    found = find_links(classes, threshold)
    roots = connected_components(found, "node", "tied")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = (
        classes.join(counts, "node", "left")
        .join(roots, "node", "left")
        .select(
            F.col("embedding").alias("of"),
            F.coalesce("root", "node").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        )
    )
    joined = saved(vectors.join(known, F.col("embedding") == F.col("of"), "left").drop("of", "embedding"))
    lowest = joined.filter("root IS NOT NULL").groupBy("root").agg(F.min("vec_id").alias("lowest"))
    component = F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("lowest"))
    return joined.join(lowest, "root", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
