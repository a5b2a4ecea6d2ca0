"""N-gram Jaccard join: near-duplicate texts by a size-aware heavy-light set join.

A document is its set of distinct word shingles; copies of a set are one node. Shingles have one
global order, rarest first as their words' frequencies tell. A set of size s that is similar to
another misses at most d = floor(s * (1 - threshold)) of its shingles there, so by the order

- small sets (size up to the boundary) enumerate the pairs in their first d + 2 shingles: two similar
  small sets share such a pair;
- large sets, and small ones that can be similar to a large one, are listed under their first d + 1
  shingles: two similar sets of which one is large share such a list.

The boundary is chosen by cost from the histogram of sizes. Lists are light or heavy:

- shingles with heavy lists (of a passage that many texts share) are put last in the order, and the
  sets that have them are listed anew, among themselves, under their next shingles; where a set's
  stored shingles do not reach, all of its shingles are read again;
- in every list all sets are verified against the smallest node first; lists whose sets are then in
  one component need nothing more;
- before sets are fetched, pairs are ruled out whose stored shingles alone differ too much;
- what is left of light lists is verified pair by pair;
- what is left of heavy lists is dealt over pairs of blocks, where the sets outside the largest
  component scan the inverted lists of the block: first with stored shingles, which ties sets that
  may be similar into clusters, then with whole sets, once for each cluster.

Links that join no two components yet are all that is looked for, so large groups are not expanded
into all pairs; every link between components is found. Sets are compared by values of their
shingles (a rank above 56 bits of hash), nodes by 64-bit hashes of their sets.

Defined cases: null, empty and blank texts have an empty set and link with nothing; texts with fewer
words than a shingle are one shingle; rows that repeat an id are rows of their own; a null id comes
out as it is, and a component takes the smallest id known (null if none); no rows give no rows.
Other columns are ignored, or kept by `kept_documents`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import discard, held, released, saved, shuffle_width
from ledgerloom.llm.components import connected_components, spanning
from ledgerloom.llm.hashing import (
    BYTE_BASE,
    WORD_BASE,
    Powers,
    mixed,
    run_hashes,
    word_hashes_of,
)

WORD_BUCKETS = 65_536
SIZE_BINS = 4_096
LIST_COST = 4  # cost of an entry of a shingle's list, in entries of a pair's list
LIGHT = 16
SPARE = 16
MAX_SENT = 200_000
BLOCK = 1_024
EMPTY = 0  # the node of empty sets


def lost(size, percent: int):
    """Most shingles of a set that a similar set lacks."""
    return size * (100 - percent) // 100


class Shingler:
    """Ordered shingle values of texts."""

    def __init__(self, words: int, commonness: np.ndarray):
        self.words, self.commonness = words, commonness
        self.of_bytes, self.of_words = Powers(BYTE_BASE), Powers(WORD_BASE)

    def sets(self, texts: pd.Series) -> Iterator[np.ndarray]:
        """The set of every text."""
        return map(self.tokens, word_hashes_of(texts, self.of_bytes, lower=True))

    def tokens(self, hashes: np.ndarray) -> np.ndarray:
        """The sorted distinct values of a text's words: commonness above, hash below."""
        n = len(hashes)
        if not n:
            return np.zeros(0, np.int64)
        k = min(self.words, n)
        at = np.arange(n - k + 1)
        runs = run_hashes(hashes, at, at + k, self.of_words)
        level = self.commonness[(hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)]
        sums = np.concatenate([[0], np.cumsum(level)])
        rank = (sums[at + k] - sums[at]) // k
        return np.unique((rank << 56) | (runs >> np.uint64(8)).astype(np.int64))

    def node(self, tokens: np.ndarray) -> int:
        if not len(tokens):
            return EMPTY
        total = mixed(tokens.view(np.uint64)).sum(dtype=np.uint64) + np.uint64(len(tokens))
        return int(mixed(np.array([total], np.uint64)).view(np.int64)[0])


def pair_keys(prefix: np.ndarray, size: int, percent: int, boundary: int) -> np.ndarray:
    """The lists that a small set enters: one for every pair of its first shingles."""
    if not 2 <= size <= boundary:
        return np.zeros(0, np.int64)
    some = mixed(prefix[: lost(size, percent) + 2].view(np.uint64))
    a, b = np.triu_indices(len(some), 1)
    return mixed(some[a] * np.uint64(3) + some[b]).view(np.int64)


def corpus_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed words and of texts by number of words, over all texts; both of fixed size."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = Powers(BYTE_BASE)
        total = np.zeros(WORD_BUCKETS + SIZE_BINS, np.int64)
        held: list[np.ndarray] = []
        for batch in batches:
            for hashes in word_hashes_of(batch["text"], powers, lower=True):
                at = (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)
                held.append(at)
                if sum(map(len, held)) > WORD_BUCKETS:
                    total[:WORD_BUCKETS] += np.bincount(np.concatenate(held), minlength=WORD_BUCKETS)
                    held = []
                total[WORD_BUCKETS + min(len(hashes), SIZE_BINS - 1)] += 1
        if held:
            total[:WORD_BUCKETS] += np.bincount(np.concatenate(held), minlength=WORD_BUCKETS)
        found = np.flatnonzero(total)
        yield pd.DataFrame({"place": found, "n": total[found]})

    counts = docs.select("text").mapInPandas(count, "place long, n long")
    total = np.zeros(WORD_BUCKETS + SIZE_BINS, np.int64)
    for row in counts.groupBy("place").agg(F.sum("n").alias("n")).collect():
        total[row["place"]] = row["n"]
    return total[:WORD_BUCKETS], total[WORD_BUCKETS:]


def commonness(counts: np.ndarray) -> np.ndarray:
    """0 (rare) to 120 (common) for every hashed word, by its share of all words."""
    share = (counts + 1) / (counts.sum() + len(counts))
    return np.clip((np.log(share) + 20) * 6, 0, 120).astype(np.int64)


def choose_boundary(sizes: np.ndarray, percent: int) -> int:
    """The largest small size: cheapest in list entries, given how many texts have each size."""
    s = np.arange(len(sizes))
    d = lost(s, percent)
    pairs = np.cumsum(sizes * (d + 2) * (d + 1) // 2)
    lists = sizes * (d + 1) * LIST_COST
    listed = lists.sum() - np.concatenate([[0], np.cumsum(lists)])
    first = np.maximum(0, -(-percent * (s + 1) // 100))
    return int(np.argmin(pairs + listed[np.minimum(first, len(sizes))]))


def signatures(
    docs: DataFrame, words: int, percent: int
) -> tuple[DataFrame, np.ndarray, int]:
    """Signed rows, written once, the words' commonness and the boundary of small sets.

    A row holds doc_id, text_key, node, size, `head` (the first shingles, one more than may be
    missing) and `more` (the next ones).
    """
    counts, sizes = corpus_counts(docs)
    level, boundary = commonness(counts), choose_boundary(sizes, percent)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["node", "size", "head", "more"]

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words, level)
        for batch in batches:
            rows = []
            for tokens in shingler.sets(batch["text"]):
                first = lost(len(tokens), percent) + 1
                rows.append(
                    (
                        shingler.node(tokens), len(tokens), tokens[:first],
                        tokens[first : 2 * first + SPARE],
                    )
                )
            out = batch[["row", "text_key"]].copy()
            for name, values in zip(names, zip(*rows, strict=True), strict=True):
                out[name] = list(values)
            yield out

    keyed = docs.select(
        F.struct("doc_id").alias("row"), "text", F.xxhash64("text").alias("text_key")
    )
    schema = (
        f"row struct<doc_id: {kind}>, text_key long, node long, size long, "
        "head array<long>, more array<long>"
    )
    signed = keyed.mapInPandas(sign, schema)
    return saved(signed.select("row.doc_id", "text_key", *names)), level, boundary


def token_sets(docs: DataFrame, wanted: DataFrame, words: int, level: np.ndarray) -> DataFrame:
    """(node, tokens) for rows (node, text_key) of `wanted`, from the texts; written once."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words, level)
        for batch in batches:
            tokens = list(shingler.sets(batch["text"]))
            yield pd.DataFrame({"node": [shingler.node(t) for t in tokens], "tokens": tokens})

    texts = docs.select("text", F.xxhash64("text").alias("text_key"))
    one_each = texts.join(wanted.select("text_key"), "text_key", "left_semi")
    found = one_each.dropDuplicates(["text_key"]).select("text")
    sets = found.mapInPandas(cut, "node long, tokens array<long>")
    return saved(sets.dropDuplicates(["node"]))


def similar_sizes(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def likely(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their stored shingles do not rule out.

    Up to the smaller of two prefixes' ends all shingles of both sets are known, so those that only
    one of them has are missing from the other.
    """
    left = prefixes.select(F.col("node").alias("a"), F.col("size").alias("sa"), F.col("prefix").alias("pa"))
    right = prefixes.select(F.col("node").alias("b"), F.col("size").alias("sb"), F.col("prefix").alias("pb"))

    def end(prefix: str, size: str) -> Column:
        whole = F.size(prefix) >= F.col(size)
        return F.when(whole, F.lit((1 << 63) - 1)).otherwise(F.element_at(prefix, -1))

    known = F.least(end("pa", "sa"), end("pb", "sb"))
    both = pairs.select("a", "b").distinct().join(left, "a").join(right, "b").withColumn("known", known)

    def only(one: str, other: str) -> Column:
        return F.size(F.array_except(F.filter(one, lambda t: t <= F.col("known")), F.col(other)))

    apart = only("pa", "pb") + only("pb", "pa")
    fit = apart * (100 + percent) <= (F.col("sa") + F.col("sb")) * (100 - percent)
    return saved(both.filter(fit).select("a", "b"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar; written once."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - both
    joined = pairs.join(left, "a").join(right, "b")
    return saved(joined.filter(100 * both >= percent * union).select("a", "b"))


def shared_lists(rows: DataFrame) -> DataFrame:
    """Rows (key, node, size) of lists with company, with the list's length n."""
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return rows.join(counts, "key")


def missing(percent: int) -> Column:
    """Most shingles of a set of this size that a similar set lacks."""
    return F.floor(F.col("size") * (100 - percent) / F.lit(100)).cast("int")


def first_lists(signed: DataFrame, percent: int, boundary: int) -> DataFrame:
    """Shared lists of pairs of shingles (small sets) and of single shingles; written once.

    The keys of pairs follow from the stored shingles, so they are made here and never stored.
    """

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["node", "size"]].copy()
            out["keys"] = [
                np.concatenate([
                    pair_keys(np.concatenate([head, more]), size, percent, boundary),
                    head[: len(head) if 100 * size >= percent * (boundary + 1) else 0],
                ])
                for size, head, more in zip(
                    batch["size"], batch["head"], batch["more"], strict=True
                )
            ]
            yield out

    stored = signed.filter("size > 1").select("node", "size", "head", "more")
    keys = stored.mapInPandas(keyed, "node long, size long, keys array<long>")
    rows = keys.select(F.explode("keys").alias("key"), "node", "size")
    # Copies of a set meet in all its lists; they are one row once unshared keys are gone.
    return saved(shared_lists(shared_lists(rows).select("key", "node", "size").distinct()))


def relisted(signed: DataFrame, lists: DataFrame, docs: DataFrame, words: int, level, percent: int,
             boundary: int) -> DataFrame:
    """Rows (key, node, size) that list the sets of heavy lists anew, heavy shingles put last."""
    heavy = lists.filter(F.col("n") > LIGHT)
    last = heavy.select("key").distinct()
    moved = heavy.groupBy("node").agg(F.count(F.lit(1)).cast("int").alias("gone"))
    sets = signed.select("node", "size", "head", "more").join(moved, "node").dropDuplicates(["node"])
    listed = 100 * F.col("size") >= percent * (boundary + 1)
    reach = F.when(listed, 2 * F.col("gone") + SPARE // 2).otherwise(F.size("more"))
    tokens = F.concat("head", F.slice("more", F.lit(1), reach))
    rows = sets.select("node", "size", F.posexplode(tokens).alias("at", "key"))
    light = rows.join(last, "key", "left_anti").groupBy("node", "size").agg(
        F.sort_array(F.collect_list(F.struct("at", "key"))).alias("tokens")
    )
    needed = missing(percent) + 1
    enough = saved(light.filter(F.size("tokens") >= needed).select(
        "node", "size", F.slice("tokens", F.lit(1), needed).alias("tokens")
    ))
    new = enough.select(F.explode("tokens").alias("t"), "node", "size").select("t.key", "node", "size")
    short = saved(moved.select("node").join(enough, "node", "left_anti"))
    if short.isEmpty():
        return new
    wanted = signed.join(short, "node", "left_semi").groupBy("node").agg(
        F.min("text_key").alias("text_key")
    )
    every = token_sets(docs, wanted, words, level)
    rows = every.select(
        "node", F.size("tokens").cast("long").alias("size"),
        F.posexplode("tokens").alias("at", "key"),
    )
    ordered = rows.join(last.select("key", F.lit(1).alias("late")), "key", "left").groupBy(
        "node", "size"
    ).agg(F.sort_array(F.collect_list(
        F.struct(F.coalesce("late", F.lit(0)).alias("late"), "at", "key")
    )).alias("tokens"))
    full = ordered.select("node", "size", F.explode(F.slice("tokens", F.lit(1), needed)).alias("t"))
    return new.unionByName(full.select("t.key", "node", "size"))


def against_smallest(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of every list's smallest node and its other sets."""
    first = lists.groupBy("key").agg(F.min(F.struct("node", "size")).alias("first"))
    joined = lists.join(first, "key").filter(F.col("node") > F.col("first.node"))
    fit = similar_sizes(F.col("size"), F.col("first.size"), percent)
    return joined.filter(fit).select(F.col("first.node").alias("a"), F.col("node").alias("b"))


def divided(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of lists that hold more than one component, with `root`."""
    rooted = lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rooted.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.min("node").alias("smallest")
    )
    return rooted.join(several.filter("low < high"), "key").drop("low", "high")


def light_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in light lists, but for those with the smallest node."""
    rest = rows.filter((F.col("n") <= LIGHT) & (F.col("node") > F.col("smallest")))
    one = rest.select("key", F.col("node").alias("a"), F.col("size").alias("sa"), F.col("root").alias("ra"))
    two = rest.select("key", F.col("node").alias("b"), F.col("size").alias("sb"), F.col("root").alias("rb"))
    fit = similar_sizes(F.col("sa"), F.col("sb"), percent)
    return one.join(two, "key").filter((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & fit)


UNIT = ["key", "low", "high"]


class Block:
    """The sets of one pair of blocks, with inverted lists."""

    def __init__(self, rows: pd.DataFrame):
        self.root, self.node, self.own = (rows[c].to_numpy() for c in ("root", "node", "own"))
        self.size = rows["size"].to_numpy()
        self.sets = [np.asarray(t) for t in rows["tokens"]]
        self.count = np.array([len(t) for t in self.sets])
        self.starts = np.concatenate([[0], np.cumsum(self.count)[:-1]])
        self.flat = np.concatenate(self.sets)
        order = np.argsort(self.flat, kind="stable")
        self.sorted = self.flat[order]
        self.holders = np.repeat(np.arange(len(self.sets)), self.count)[order]
        whole = self.count >= self.size
        self.end = np.where(whole, np.iinfo(np.int64).max, [t[-1] for t in self.sets])
        self.crossing = rows["low"].iloc[0] != rows["high"].iloc[0]

    def overlaps(self, i: int) -> np.ndarray:
        """Shingles that every set shares with set i, by a scan of its inverted lists."""
        start = np.searchsorted(self.sorted, self.sets[i], "left")
        length = np.searchsorted(self.sorted, self.sets[i], "right") - start
        place = np.repeat(start - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
        found = self.holders[place + np.arange(length.sum())]
        return np.bincount(found, minlength=len(self.sets))

    def apart(self, i: int) -> np.ndarray:
        """Least number of shingles in which every set differs from set i, as far as known.

        Shortened values may tie at an end, so only those below it count as known.
        """
        mine = np.searchsorted(self.sets[i], self.end, "left")
        theirs = np.add.reduceat(self.flat < self.end[i], self.starts, dtype=np.int64)
        return mine + theirs - 2 * self.overlaps(i)

    def near(self, percent: int) -> Iterator[tuple[int, np.ndarray]]:
        """Sets outside the largest component, and the sets of other components near to them."""
        names, counts = np.unique(self.root, return_counts=True)
        for i in np.flatnonzero(self.root != names[counts.argmax()]):
            total = self.size + self.size[i]
            near = self.apart(i) * (100 + percent) <= total * (100 - percent)
            near &= self.root != self.root[i]
            if self.crossing:
                near &= self.own != self.own[i]
            if near.any():
                yield i, np.flatnonzero(near)


def over_blocks(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Sets near to each other in heavy lists, block by block; `sets` has node and tokens.

    The pairs (a, b) tie together all sets that are near to each other: for whole sets those that
    links join, for prefixes those that links may join.
    """
    blocks = F.ceil(F.col("n") / F.lit(float(BLOCK))).cast("int")
    dealt = rows.withColumn("blocks", blocks)
    dealt = dealt.withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = dealt.select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "own", "node", "root", "size", "smallest",
    ).join(sets, "node")

    def check(rows: pd.DataFrame) -> pd.DataFrame | None:
        rows = rows.sort_values("node")
        block = Block(rows)
        found = []
        for i, near in block.near(percent):
            found.append((np.full(len(near), i), near))
        if not found:
            return None
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        label = spanning(a, b, len(rows))
        tied = np.flatnonzero(label != np.arange(len(rows)))
        return pd.DataFrame({"a": block.node[tied], "b": block.node[label[tied]]})

    def units_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if batch.empty:
                continue
            keys = batch[UNIT].to_numpy(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            for start, end in zip(starts[:-1], starts[1:], strict=True):
                yield batch.iloc[start:end]
            held = batch.iloc[starts[-1] :]
        if held is not None:
            yield held

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sent: set[tuple[int, int]] = set()
        for rows in units_of(batches):
            out = check(rows)
            if out is None:
                continue
            if len(sent) > MAX_SENT:
                sent.clear()
            new = [pair for pair in zip(out["a"], out["b"], strict=True) if pair not in sent]
            sent.update(new)
            if new:
                yield pd.DataFrame(new, columns=["a", "b"])

    # Lists of one group mostly have one smallest node; together they repeat fewer pairs.
    parts = units.repartition(shuffle_width(units.sparkSession), "smallest", "low", "high")
    return saved(parts.sortWithinPartitions(*UNIT).mapInPandas(run, "a long, b long"))


def components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, text_key, n_shingles and component_id of every row."""
    signed, level, boundary = signatures(docs.select("doc_id", "text"), words, percent)
    lists = first_lists(signed, percent, boundary)
    light = lists.filter(F.col("n") <= LIGHT)
    anew = relisted(signed, lists, docs, words, level, percent, boundary)
    every = saved(light.unionByName(shared_lists(anew)))
    discard(lists)
    prefixes = saved(
        signed.select("node", "size", F.concat("head", "more").alias("prefix"))
        .join(every.select("node").distinct(), "node", "left_semi")
        .dropDuplicates(["node"])
    )
    whole, signed = signed, saved(signed.drop("head", "more"))
    discard(whole)

    def sets_of(nodes: DataFrame) -> DataFrame:
        rows = signed.join(nodes.distinct(), "node", "left_semi").groupBy("node")
        return token_sets(docs, rows.agg(F.min("text_key").alias("text_key")), words, level)

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("node"))

    star = likely(against_smallest(every, percent), prefixes, percent)
    star_sets = sets_of(ends(star))
    links = verified(star, star_sets, percent)
    discard(star, star_sets)
    left = saved(divided(every, connected_components(links)))
    pairs = likely(light_pairs(left, percent), prefixes, percent)
    crowded = left.filter(F.col("n") > LIGHT)
    # Every block's row carries them: values shortened to 31 bits keep the order, and ties only make
    # sets look nearer; whole sets are compared by whole values.
    short = F.transform("prefix", lambda t: F.shiftright(t, 32).cast("int"))
    stored = prefixes.select("node", short.alias("tokens"))
    near = saved(connected_components(over_blocks(crowded, stored, percent)))
    discard(prefixes)
    sets = sets_of(ends(pairs).unionByName(near.select("node")))
    once = crowded.select("node", "size", "root").distinct()
    clusters = once.join(near.select("node", F.col("root").alias("key")), "node")
    clusters = clusters.withColumn("smallest", F.col("key"))
    links = links.unionByName(verified(pairs, sets, percent)).unionByName(
        over_blocks(shared_lists(clusters), sets, percent)
    )
    roots = connected_components(links)
    found = (
        signed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    )
    lowest = (
        found.filter(F.col("node") != EMPTY).groupBy("root").agg(F.min("doc_id").alias("lowest"))
    )
    component = F.when(F.col("node") == EMPTY, F.col("doc_id")).otherwise(F.col("lowest"))
    return found.join(lowest, "root", "left").select(
        "doc_id", "text_key", F.col("size").alias("n_shingles"), component.alias("component_id")
    )


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    return components(docs, words, percent).drop("text_key")


def kept_documents(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group, that of the smallest id, with all its columns.

    Of rows that repeat an id in one group one stays, the smallest by its text's hash; of equal rows
    one stays. Rows without id and without words stay.
    """
    found = components(docs, words, percent)
    best = found.filter("doc_id IS NOT NULL AND doc_id = component_id AND n_shingles > 0")
    chosen = best.groupBy("doc_id").agg(F.min("text_key").alias("chosen"))
    wordless = ~F.coalesce(F.rlike("text", F.lit(r"[^ \t\n\x0B\f\r]")), F.lit(False))
    # The row holds the text, which is not to be moved twice.
    named = held(docs).select(
        "doc_id", "row", F.xxhash64("text").alias("text_key"), wordless.alias("wordless")
    )
    # Texts are compared apart from the join's key, so that one shuffle by id serves both steps.
    same_text = F.col("text_key").bitwiseXOR(F.col("key")) == 0
    one = named.join(
        chosen.select(F.col("doc_id").alias("id"), F.col("chosen").alias("key")),
        (F.col("doc_id") == F.col("id")) & same_text,
        "left_semi",
    ).dropDuplicates(["doc_id"])
    rest = named.filter(F.col("wordless") | F.col("doc_id").isNull())
    return released(one.unionByName(rest), docs.columns)
