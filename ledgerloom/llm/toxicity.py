"""Toxicity: a convolutional classifier over hashed word embeddings, trained in numpy.

A text's words (runs of letters, lower case) become three hashed symbols each, the word and two stems
(its first letters), whose embeddings add up. Filters of several widths run over all words, maxima over the whole
text feed a softmax, and the score is the probability of label 1. The network learns from all labelled
texts, whole. They are dealt into shards of about `SHARD` texts; each shard trains the network on its own
for a part of the steps, the parameters of all shards are averaged, and the next round goes on from
there (one shard does all steps in one round). After training, a second threshold is calibrated for each
language on the fifth of the labelled texts that is kept out of training: the one with the best F1,
`MIDDLE` where a language has too few.

Defined cases: null text, empty text and text without letters are scored as a text without words;
without labels of both kinds every score is 0; rows with null ids are scored, but teach nothing;
repeated labels of a document count once, the highest; no rows give no rows. Other columns are
ignored.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import convnet
from ledgerloom.llm.common import saved
from ledgerloom.llm.language_id import fold
from ledgerloom.llm.quality_rules import label_marks, with_mark

SYMBOLS = 65_536
STEMS = (4, 6)
#: Texts and words of a shard, about; rounds of training where there are several shards.
SHARD, SHARD_WORDS = 6_000, 4_000_000
ROUNDS = 3
#: Parameters are averaged in runs of this many.
RUN = 16_384
#: Decimals of the scores that thresholds are calibrated on.
DECIMALS = 5
DIM, WIDTHS, FILTERS = 8, (1, 2, 3), 8
STEPS, BATCH, RATE, SEED = 900, 48, 0.01, 5
MIDDLE = 0.5
MIN_CALIBRATION = 20
CHUNK = 300


def symbols(text: Column) -> Column:
    """Hashed word and hashed stems of every word, packed into one number."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(\p{L}+)"))

    def hashed(w: Column) -> Column:
        packed = F.pmod(F.xxhash64(w), F.lit(SYMBOLS - 1)) + 1
        for length in STEMS:
            stem = F.xxhash64(F.substring(w, 1, length), F.lit(length))
            packed = packed * SYMBOLS + F.pmod(stem, F.lit(SYMBOLS - 1)) + 1
        return packed

    return F.transform(found, hashed)


def unpacked(packed: np.ndarray) -> np.ndarray:
    """(words, 1 + stems) symbol ids."""
    rest, out = np.asarray(packed, np.int64), []
    for _ in STEMS:
        out.append(rest % SYMBOLS)
        rest = rest // SYMBOLS
    return np.stack([rest, *out], axis=1)


def scores(net: convnet.ConvNet, texts: list[np.ndarray]) -> np.ndarray:
    ids, starts = convnet.flat([unpacked(t) for t in texts], max(net.widths))
    return convnet.probabilities(net, ids, starts)[:, 1].astype(np.float64)


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(shard, share, toxic, lang, symbols) of all labelled texts; written once.

    `share` is a hash of the id as a number in [0, 1); the rows of a document share their shard.
    """
    marks = label_marks(labels.filter("toxic IN (0, 1)").select("doc_id", F.col("toxic").alias("quality")))
    share = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    rows = saved(
        with_mark(docs.select("doc_id", "lang", "text"), saved(marks)).filter("good IS NOT NULL")
        .select(
            F.xxhash64("doc_id").alias("shard"), share.alias("share"), F.col("good").cast("int").alias("toxic"),
            "lang", symbols(F.col("text")).alias("symbols"),
        )
    )
    size = rows.agg(F.count("*").alias("rows"), F.sum(F.size("symbols")).alias("words")).first()
    shards = max(1, ceil(size["rows"] / SHARD), ceil((size["words"] or 0) / SHARD_WORDS))
    return rows.withColumn("shard", F.pmod("shard", F.lit(shards)).cast("int"))


def _ordered(rows: pd.DataFrame) -> tuple[list[np.ndarray], pd.DataFrame, np.ndarray]:
    """Texts of a shard, their rows and which are kept out, in an order fixed by content.

    Repeated rows of a document teach once.
    """
    rows = rows.assign(symbols=[np.asarray(s, np.int64).tobytes() for s in rows["symbols"]])
    rows = rows.drop_duplicates(["share", "toxic", "lang", "symbols"])
    rows = rows.sort_values(["share", "toxic", "symbols"], kind="stable").reset_index(drop=True)
    return [np.frombuffer(s, np.int64) for s in rows["symbols"]], rows, np.arange(len(rows)) % 5 == 4


def averaged(rows: DataFrame, net: convnet.ConvNet, after: int, end: int) -> np.ndarray:
    """All parameters after these steps, averaged over shards by the texts they learn from."""

    def learn(shard: pd.DataFrame) -> pd.DataFrame:
        texts, marked, out = _ordered(shard)
        toxic = marked["toxic"].to_numpy(np.int64)[~out]
        learned = [unpacked(t) for t, o in zip(texts, out, strict=True) if not o]
        if len(learned):
            seed = SEED + int(shard["shard"].iloc[0])
            own = copy.deepcopy(net)
            convnet.train(own, learned, toxic, STEPS, BATCH, RATE, seed, after=after, end=end)
            flat = np.concatenate([p.ravel() for p in own.parameters()])
        else:
            flat = np.zeros(0, np.float32)
        parts = [flat[at : at + RUN].astype(np.float32).tobytes() for at in range(0, len(flat), RUN)]
        return pd.DataFrame({"run": range(len(parts)), "texts": len(learned), "part": parts})

    def mean(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values(["texts", "part"])
        total = sum(n * np.frombuffer(p, np.float32).astype(float) for n, p in zip(parts["texts"], parts["part"], strict=True))
        part = (total / parts["texts"].sum()).astype(np.float32).tobytes()
        return pd.DataFrame({"run": parts["run"].iloc[:1], "part": [part]})

    learned = saved(rows.groupBy("shard").applyInPandas(learn, "run int, texts long, part binary"))
    means = learned.groupBy("run").applyInPandas(mean, "run int, part binary").orderBy("run").collect()
    # As many numbers as the network has parameters, at any input.
    return np.concatenate([np.frombuffer(r["part"], np.float32) for r in means] or [np.zeros(0, np.float32)])


def trained(rows: DataFrame) -> convnet.ConvNet:
    net = convnet.new_net(SYMBOLS, DIM, WIDTHS, FILTERS, 2, SEED)
    rounds = 1 if rows.filter("shard > 0").isEmpty() else min(ROUNDS, STEPS)
    for n in range(rounds):
        flat, at = averaged(rows, net, STEPS * n // rounds, STEPS * (n + 1) // rounds), 0
        for p in net.parameters() if len(flat) else []:
            p[...] = flat[at : at + p.size].reshape(p.shape)
            at += p.size
    return net


def kept_out_scores(rows: DataFrame, net: convnet.ConvNet) -> DataFrame:
    """(lang, score, clean, toxic): counts of the texts kept out of training by rounded score."""

    def score(shard: pd.DataFrame) -> pd.DataFrame:
        texts, marked, out = _ordered(shard)
        check = [t for t, o in zip(texts, out, strict=True) if o]
        found = [scores(net, check[i : i + CHUNK]) for i in range(0, len(check), CHUNK)]
        return pd.DataFrame(
            {"lang": marked["lang"][out], "toxic": marked["toxic"][out], "score": np.concatenate(found or [np.zeros(0)])}
        )

    return (
        rows.groupBy("shard").applyInPandas(score, "lang string, toxic int, score double")
        .filter("lang IS NOT NULL")
        .groupBy("lang", F.round("score", DECIMALS).alias("score"))
        .agg(F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic"))
    )


def best_threshold(score: np.ndarray, counts: np.ndarray) -> float:
    """The threshold of the best F1 (the middle of the gap below the lowest score it accepts).

    `counts` holds the clean and the toxic texts of every score, each score once.
    """
    if counts.sum(axis=0).min() < MIN_CALIBRATION:
        return MIDDLE
    order = np.argsort(-score, kind="stable")
    ranked, counts = score[order], counts[order]
    f1 = 2 * np.cumsum(counts[:, 1]) / (np.cumsum(counts.sum(axis=1)) + counts[:, 1].sum())
    at = int(np.argmax(f1))
    return float((ranked[at] + ranked[at + 1]) / 2) if at + 1 < len(ranked) else float(ranked[at])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[convnet.ConvNet | None, dict[str, float]]:
    """The network, and the calibrated threshold of every language."""
    rows = labelled_texts(docs, labels)
    kinds = rows.agg(F.min("toxic").alias("least"), F.max("toxic").alias("most")).first()
    if kinds["least"] == kinds["most"]:
        return None, {}
    net = trained(rows)
    # As many rows of a language as rounded scores, at any input.
    points = kept_out_scores(rows, net).toPandas()
    thresholds = {
        lang: best_threshold(of["score"].to_numpy(float), of[["clean", "toxic"]].to_numpy(np.int64))
        for lang, of in points.groupby("lang")
    }
    return net, {lang: value for lang, value in thresholds.items() if value != MIDDLE}


def score_documents(docs: DataFrame, net: convnet.ConvNet | None) -> DataFrame:
    """All columns of `docs` and `score`, from whole texts."""
    if net is None:
        return docs.withColumn("score", F.lit(0.0))

    @F.pandas_udf("double")
    def toxicity(packed: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in packed:
            parts = [
                scores(net, batch.iloc[at : at + CHUNK].tolist())
                for at in range(0, len(batch), CHUNK)
            ]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn("score", toxicity(symbols(F.col("text"))))


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, and `flagged` by the threshold of the stated language."""
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    docs = docs.select("doc_id", "text", "lang", held_out.alias("held_out"))
    learned = labels.filter(~F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)))
    net, thresholds = fit(docs.filter(~F.col("held_out")), learned)
    scored = score_documents(docs, net)
    threshold = F.lit(MIDDLE)
    for lang, value in thresholds.items():
        threshold = F.when(F.col("lang") == lang, value).otherwise(threshold)
    return scored.select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        (F.col("score") >= threshold).alias("flagged"),
    )
