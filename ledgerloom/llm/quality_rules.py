"""Quality rules: counts of every text, and a hashed n-gram likelihood ratio of target to corpus.

Words and pairs of adjacent words are hashed into a fixed number of buckets. Two multinomials are
counted: the raw corpus (all documents) and the trusted target (documents labelled good). The target is smoothed towards the corpus, and a bucket weighs

    ln((target count + pull * corpus share) / (target size + pull)) - ln(corpus share)

in whole millionths, so sums do not depend on their order. A document's score is the mean weight of
its n-grams, which makes it independent of length.

How far junk and clean texts lie apart depends on the size of the corpus: in a small one most pairs
of clean texts are new to the target, in a large one all n-grams share buckets. So one threshold is
calibrated for the whole input on all labelled documents that pass the base rules. A good one is
scored with its own n-grams taken out of the target, as unlabelled texts are no part of the target
either; that score is made beside the plain one, so texts are read twice in all. The threshold has the
least sum of both error rates, in the middle of its gap; with fewer than `MIN_CALIBRATION` documents
of either label there is none, and the base rules decide.

The trusted target is counted over all documents labelled good, the raw corpus over all documents. The
main path holds expressions, a join with the labels and one aggregate with as many groups as buckets.
The labels are bitmaps of 64 ids a row, so their table stays under Spark's broadcast threshold for long,
and no text is shuffled then; beyond it Spark shuffles. The weights, as many numbers as buckets at
every input size, are saved arrays that tasks get as scalar subqueries.

Defined cases: null, empty and blank texts have no words and fail the base rules; null ids join no
label; without trusted documents all weights are 0 and the base rules decide; labels repeated for a
document count once; repeated documents are scored each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import held, released, saved, split_at_spaces
from ledgerloom.operators import match

BUCKETS = 65_536
PULL = 10_000.0
#: No document is so unlikely that this rejects it: a mean of logarithms of positive shares.
KEEP_ALL = -1_000 * 1_000_000
#: Up to this number of trusted ids are broadcast without asking Spark.
TRUSTED = 1_000
MIN_CALIBRATION = 5
#: Width, in millionths, of the bins of ratios that tasks rank; a mean of weights has a bounded range.
BIN = 1_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MILLION = 1_000_000
SYMBOLS = "[#*$%&|<>]"


def _indices(count: Column) -> Column:
    """0 to count - 1; no element when count is not positive."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
        F.array().cast("array<int>")
    )


def with_words(docs: DataFrame) -> DataFrame:
    """Adds `parts` (cut at every white-space character), `words` and `hashes`."""
    return (
        docs.withColumn("parts", split_at_spaces(F.col("text")))
        .withColumn("words", F.filter("parts", lambda w: w != ""))
        .withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    )


def ngram_buckets(hashes: str, buckets: int) -> Column:
    """Buckets of all words, then of all pairs of adjacent words."""
    h = F.col(hashes)
    firsts = F.greatest(F.size(h) - 1, F.lit(0))

    def bucket(x: Column) -> Column:
        # Never null, which lets the numbers be sorted as such.
        if buckets & (buckets - 1) == 0:
            return x.bitwiseAND(F.lit(buckets - 1).cast("long")).cast("int")
        return F.coalesce(F.pmod(x, F.lit(buckets)).cast("int"), F.lit(0))

    pairs = F.zip_with(
        F.slice(h, F.lit(1), firsts), F.slice(h, F.lit(2), firsts), lambda a, b: bucket(F.xxhash64(a, b))
    )
    return F.concat(F.transform(h, bucket), pairs)


def _positions_of_equal(keys: str, same: Callable, position: Callable) -> Column:
    """Positions of the sorted `keys` that equal a neighbour; `same` and `position` read an index."""
    count = F.size(F.col(keys))
    equal = F.filter(_indices(count - 1), lambda i: same(i, i + 1))
    both = F.flatten(F.transform(equal, lambda i: F.array(position(i), position(i + 1))))
    return F.sort_array(F.array_distinct(both))


def _covered(positions: str) -> Column:
    """Words covered by windows of three that start at the sorted positions."""
    p = F.col(positions)
    gaps = F.transform(
        _indices(F.size(p)),
        lambda i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - F.get(p, i), F.lit(3))),
    )
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)


def with_repeated_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in windows of three found twice or more, the first included.

    A text whose window hashes all differ has none. In others, window hashes and positions are packed
    into one number and sorted. Neighbours of equal hash are compared word by word; if two different
    windows of a text share a hash, that text's windows are sorted as strings instead.
    """
    h, w = F.col("hashes"), F.col("words")
    n = F.size(h) - 2
    df = df.withColumn("bits", F.length(F.bin(F.greatest(n, F.lit(1)).cast("long"))))

    starts = F.slice(h, F.lit(1), F.greatest(n, F.lit(0)))
    windows = F.transform(starts, lambda first, i: F.xxhash64(first, F.get(h, i + 1), F.get(h, i + 2)))
    df = df.withColumn("windows", windows)
    again = F.size(F.array_distinct("windows")) < F.size("windows")

    def packed(window: Column, i: Column) -> Column:
        both = F.call_function("shiftleft", window, F.col("bits")).bitwiseOR(i.cast("long"))
        return F.coalesce(both, F.lit(0).cast("long"))

    to_sort = F.when(again, F.transform("windows", packed)).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("packed", F.sort_array(to_sort))

    def hash_at(i: Column) -> Column:
        return F.call_function("shiftright", F.get("packed", i), F.col("bits"))

    def position(i: Column) -> Column:
        high = F.call_function("shiftleft", hash_at(i), F.col("bits"))
        return (F.get("packed", i) - high).cast("int")

    def same_hash(i: Column, j: Column) -> Column:
        differ = F.get("packed", i).bitwiseXOR(F.get("packed", j))
        return F.call_function("shiftright", differ, F.col("bits")) == 0

    df = df.withColumn("positions", _positions_of_equal("packed", same_hash, position))

    def text_window(i: Column) -> Column:
        return F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    # Windows that share a hash: as many different texts as hashes, unless hashes collide.
    texts = F.size(F.array_distinct(F.transform("positions", text_window)))
    hashes = F.size(
        F.array_distinct(
            F.transform(
                "positions",
                lambda i: F.call_function("shiftleft", F.get("windows", i), F.col("bits")),
            )
        )
    )
    strings = F.sort_array(
        F.transform(_indices(n), lambda i: F.struct(text_window(i).alias("t"), i.alias("i")))
    )
    df = df.withColumn("collided", texts != hashes)
    df = df.withColumn("strings", F.when(F.col("collided"), strings))
    exact = _positions_of_equal(
        "strings",
        lambda i, j: F.get("strings", i)["t"] == F.get("strings", j)["t"],
        lambda i: F.get("strings", i)["i"],
    )
    df = df.withColumn("positions", F.when(F.col("collided"), exact).otherwise(F.col("positions")))
    return df.withColumn("n_repeat_words", _covered("positions"))


def with_counts(df: DataFrame, *others: str) -> DataFrame:
    """The base counts of a frame with `text`, `parts`, `words` and `hashes`, beside doc_id and `others`."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^ \t\n\x0B\f\r]")))
    df = df.withColumn("lines", lines)
    return with_repeated_words(df).select(
        "doc_id",
        *others,
        "hashes",
        F.size("words").cast("long").alias("n_words"),
        (F.length(text) - (F.size("parts") - 1)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, "")))
        .cast("long")
        .alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def label_marks(labels: DataFrame) -> DataFrame:
    """(word, labelled, good): bitmaps of all labelled ids and of those labelled good, 64 ids a row."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("doc_id").bitwiseAND(63).cast("int"))
    return (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
        .groupBy(F.shiftright("doc_id", 6).alias("word"))
        .agg(
            F.bit_or(bit).alias("labelled"),
            F.coalesce(F.bit_or(F.when(F.col("quality") == 1, bit)), F.lit(0).cast("long")).alias("good"),
        )
    )


def with_mark(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Adds `good`: whether a document is labelled good, null for those without a label."""
    words = docs.withColumn("word", F.shiftright(F.col("doc_id").cast("long"), 6))
    found = match.left_lookup(words, marks, ["word"], by="text")
    place = F.col("doc_id").cast("long").bitwiseAND(63).cast("int")

    def has(bits: str) -> Column:
        return F.call_function("shiftright", F.col(bits), place).bitwiseAND(1) == 1

    mark = F.when(has("labelled"), has("good"))
    return found.withColumn("mark", mark).drop("word", "labelled", "good").withColumnRenamed("mark", "good")


def trusted_sample(labels: DataFrame, most: int = TRUSTED) -> list | DataFrame:
    """All documents labelled good: a list of at most `most` ids, the marks of the labels if more."""
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    ids = [r["doc_id"] for r in good.limit(most + 1).collect()]
    return ids if len(ids) <= most else saved(label_marks(labels))


def ngram_counts(docs: DataFrame, trusted: list | DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, raw, target): n-grams of all documents, and of the trusted ones among them.

    A list of trusted ids is of bounded size, so it is broadcast and no text is shuffled; how a table
    of marks is joined is up to Spark.
    """
    if isinstance(trusted, list):
        rows = [(i, 1) for i in trusted]
        trusted = F.broadcast(label_marks(docs.sparkSession.createDataFrame(rows, "doc_id long, quality int")))
    grams = with_words(with_mark(docs.select("doc_id", "text"), trusted)).select(
        F.coalesce(F.col("good"), F.lit(False)).cast("long").alias("good"),
        F.explode(ngram_buckets("hashes", buckets)).alias("bucket"),
    )
    return grams.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.sum("good").alias("target")
    )


def weight_of(target: Column, share: Column, all_target: Column, pull: float) -> Column:
    smoothed = (target + F.lit(pull) * share) / (all_target + F.lit(pull))
    return F.round((F.log(smoothed) - F.log(share)) * MILLION).cast("int")


def ngram_weights(counts: DataFrame, pull: float = PULL) -> DataFrame:
    """(bucket, raw, target, weight, weight_without, all_raw, all_target).

    `weight` is the weight of the bucket in whole millionths, `weight_without` that with one n-gram less
    in the target.
    """
    total = counts.agg(F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target"))
    all_raw = total.select(F.col("all_raw").cast("double")).scalar()
    all_target = total.select(F.col("all_target").cast("double")).scalar()
    share = F.col("raw") / all_raw
    without = F.greatest(F.col("target") - 1, F.lit(0))
    return counts.select(
        "bucket", "raw", "target",
        weight_of(F.col("target"), share, all_target, pull).alias("weight"),
        weight_of(without, share, all_target, pull).alias("weight_without"),
        all_raw.alias("all_raw"), all_target.alias("all_target"),
    )


@dataclass
class Weights:
    """Arrays of columns of `ngram_weights`, as long as there are buckets at any input.

    They are scalar subqueries. As constants they would be spelled out wherever a plan names them, in
    every description of it that the driver makes.
    """

    share: Column
    log_share: Column
    target: Column
    weight: Column
    weight_without: Column
    all_target: float
    buckets: int
    pull: float

    def without(self, bucket: Column, own: Column) -> Column:
        """The weight of a bucket with `own` n-grams less in the target, as `weight_of` has it."""
        others = F.greatest(F.get(self.target, bucket) - own, F.lit(0)) + F.lit(self.pull) * F.get(self.share, bucket)
        smoothed = F.log(others / F.lit(self.all_target + self.pull))
        return F.rint((smoothed - F.get(self.log_share, bucket)) * MILLION).cast("int")


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, pull: float = PULL) -> Weights:
    """The weights of all buckets, counted over all documents."""
    counts = saved(ngram_counts(docs, trusted_sample(labels), buckets))
    found = ngram_weights(counts, pull).withColumn("share", F.col("raw") / F.col("all_raw"))
    found = found.withColumn("log_share", F.log("share"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    kinds = {"share": "double", "log_share": "double", "target": "long", "weight": "long", "weight_without": "long"}
    values = (F.coalesce(c, F.lit(0)).cast(kind).alias(c) for c, kind in kinds.items())
    whole = every.join(found, "bucket", "left").agg(
        F.sort_array(F.collect_list(F.struct("bucket", *values))).alias("all")
    )

    def named(name: str) -> Column:
        return F.struct(F.lit(name).alias("name"), *(
            (F.col("all")[name] if kinds[name] == kind else F.lit(None)).cast(f"array<{kind}>").alias(kind)
            for kind in ("double", "long")
        ))

    # A row for each array: Spark would join subqueries of one row into one struct, which is looked up slower.
    rows = saved(whole.select(F.inline(F.array(*map(named, kinds)))))
    arrays = {c: rows.filter(F.col("name") == c).select(kind).scalar() for c, kind in kinds.items()}
    all_target = counts.agg(F.coalesce(F.sum("target"), F.lit(0)).cast("double")).first()[0]
    return Weights(**arrays, all_target=all_target, buckets=buckets, pull=pull)


def with_own_ngrams(df: DataFrame) -> DataFrame:
    """Adds n_ngrams and, null unless `good`, `ordered` n-grams and `runs`: (bucket, own) of those there again."""
    df = df.withColumn("ordered", F.when(F.col("good"), F.sort_array("grams")))
    again = F.filter("ordered", lambda b, i: b == F.get("ordered", i - 1))
    df = df.withColumn("again", again)
    ends = F.filter(
        _indices(F.size("again")), lambda i: ~F.get("again", i).eqNullSafe(F.get("again", i + 1))
    )
    df = df.withColumn("ends", F.when(F.col("good"), ends))
    runs = F.transform(
        "ends",
        lambda end, i: F.struct(
            F.get("again", end).alias("bucket"),
            (end - F.coalesce(F.get("ends", i - 1), F.lit(-1)) + 1).cast("long").alias("own"),
        ),
    )
    return df.withColumns({"n_ngrams": F.size("grams").cast("long"), "runs": runs})


def with_sums(df: DataFrame, weights: Weights) -> DataFrame:
    """Adds `ratio_sum`, the sum of weights, and `own_sum`, that without the own n-grams in the target.

    `own_sum` is null unless `good`. Every n-gram first counts as the only one of its bucket; buckets
    that a text has again are then put right, with the number of its n-grams there.
    """
    # Functions of elements take no subqueries, so they read columns. Spark puts each subquery in the
    # place of its column, as that is used once, in the next step; a column used twice would be copied
    # into every row.
    held_as = {
        "weight_of": weights.weight, "single_of": weights.weight_without, "one_of": weights.weight_without,
        "target_of": weights.target, "share_of": weights.share, "log_share_of": weights.log_share,
    }
    here = replace(
        weights, target=F.col("target_of"), share=F.col("share_of"), log_share=F.col("log_share_of")
    )
    zero = F.lit(0).cast("long")

    def total(array: str, grams: str) -> Column:
        return F.aggregate(grams, zero, lambda total, b: total + F.get(F.col(array), b))

    def correction(run: Column) -> Column:
        one = F.get(F.col("one_of"), run["bucket"])
        return run["own"] * (here.without(run["bucket"], run["own"]) - one)

    more = F.aggregate("runs", zero, lambda total, run: total + correction(run))
    return df.select("*", *(c.alias(name) for name, c in held_as.items())).select(
        *(c for c in df.columns if c not in ("grams", "ordered", "runs")),
        total("weight_of", "grams").alias("ratio_sum"),
        F.when(F.col("good"), total("single_of", "ordered") + more).alias("own_sum"),
    )


def scored(docs: DataFrame, marks: DataFrame, weights: Weights, payload: str = "doc_id") -> DataFrame:
    """Counts and sums of every row (doc_id, text), and what calibration needs of labelled ones; written.

    `payload` is a column that goes with the row.
    """
    row = with_mark(docs, marks).select(
        F.col(payload).alias("doc_id"), "text", "good",
        F.when(F.col("good").isNotNull(), F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("key")))
        .alias("labelled"),
    )
    counted = with_counts(with_words(row), "good", "labelled")
    grams = counted.withColumn("grams", ngram_buckets("hashes", weights.buckets))
    # Written here: a later filter would otherwise be copied into every step of the counts.
    return saved(
        with_sums(with_own_ngrams(grams), weights).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            base_failed().alias("base_failed"), "n_ngrams", "ratio_sum", "good", "labelled", "own_sum",
        )
    )


def calibrated_threshold(rows: DataFrame, marks: DataFrame) -> int:
    """The threshold between all labelled documents that pass the base rules, in millionths."""
    counts = marks.select(F.bit_count("good").alias("good"), F.bit_count("labelled").alias("all")).agg(
        F.sum("good").alias("good"), F.sum(F.col("all") - F.col("good")).alias("bad")
    ).first()
    if min(counts["good"] or 0, counts["bad"] or 0) < MIN_CALIBRATION:
        return KEEP_ALL
    ratio = F.when(F.col("good"), F.col("own_sum")).otherwise(F.col("ratio_sum")) / F.col("n_ngrams")
    # Repeated rows of a document count once.
    points = (
        rows.filter("good IS NOT NULL AND NOT base_failed")
        .groupBy("labelled", "good").agg(F.max(ratio).alias("ratio"))
    )
    return threshold_of(points)


def threshold_of(points: DataFrame) -> int:
    """`best_threshold` of a table (ratio, good) of any size.

    Tasks rank the ratios of a bin; what comes before a bin is a sum over bins.
    """
    ratios = saved(
        points.groupBy("ratio").agg(
            F.count_if(F.col("good")).alias("good"), F.count_if(~F.col("good")).alias("bad")
        ).withColumn("bin", F.floor(F.col("ratio") / BIN))
    )
    total = ratios.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    if min(total["good"] or 0, total["bad"] or 0) < MIN_CALIBRATION:
        return KEEP_ALL
    # As many bins as the range of a mean of weights has, at any input.
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = ratios.groupBy("bin").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.min("ratio").alias("least")
    ).select(
        "bin", F.coalesce(F.sum("good").over(before), F.lit(0)).alias("good_before"),
        F.coalesce(F.sum("bad").over(before), F.lit(0)).alias("bad_before"),
        F.lead("least").over(Window.orderBy("bin")).alias("least_after"),
    )
    in_bin = Window.partitionBy("bin").orderBy("ratio")
    # Errors when the documents up to a ratio are rejected.
    rejected_good = F.col("good_before") + F.sum("good").over(in_bin)
    rejected_bad = F.col("bad_before") + F.sum("bad").over(in_bin)
    places = ratios.join(bins, "bin").select(
        "ratio", F.coalesce(F.lead("ratio").over(in_bin), F.col("least_after")).alias("after"),
        (rejected_good / total["good"] + 1 - rejected_bad / total["bad"]).alias("errors"),
    )
    best = places.filter("after IS NOT NULL").agg(
        F.min(F.struct("errors", "ratio", "after")).alias("best")
    ).select("best.*").first()
    if best["errors"] is None or best["errors"] >= 1:
        return KEEP_ALL
    return round((best["ratio"] + best["after"]) / 2)


def best_threshold(ratio: np.ndarray, good: np.ndarray) -> int:
    """The threshold of the least sum of both error rates, in the middle of its gap."""
    if min(good.sum(), (~good).sum()) < MIN_CALIBRATION:
        return KEEP_ALL
    order = np.argsort(ratio, kind="stable")
    ratio, good = ratio[order], good[order]
    # Errors when the documents before a place are rejected; only places between unlike ratios.
    errors = np.cumsum(good) / good.sum() + 1 - np.cumsum(~good) / (~good).sum()
    errors = np.where(ratio[1:] > ratio[:-1], errors[:-1], 2)
    at = int(np.argmin(errors))
    if errors[at] >= 1:
        return KEEP_ALL
    return round((ratio[at] + ratio[at + 1]) / 2)


def kept(threshold_millionths: int) -> Column:
    likely = F.col("ratio_sum") >= F.lit(threshold_millionths) * F.col("n_ngrams")
    return ~F.col("base_failed") & likely


def assess(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    pull: float = PULL,
    threshold_millionths: int | None = None,
) -> DataFrame:
    """One row per document: counts, base_failed, kept, n_ngrams and ratio_sum (millionths).

    Without a threshold the calibrated one is used.
    """
    weights, marks = fit(docs, labels, buckets, pull), saved(label_marks(labels))
    rows = scored(docs.select("doc_id", "text"), marks, weights)
    threshold = calibrated_threshold(rows, marks) if threshold_millionths is None else threshold_millionths
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", kept(threshold).alias("kept"), "n_ngrams", "ratio_sum",
    )


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns.

    A row travels with its counts as one struct, so no join brings verdicts and texts together.
    """
    weights, marks = fit(docs, labels), saved(label_marks(labels))
    rows = scored(held(docs), marks, weights, payload="row")
    passed = rows.filter(kept(calibrated_threshold(rows, marks)))
    return released(passed.select(F.col("doc_id").alias("row")), docs.columns)
