"""Language identification by a convolutional network over bytes.

A text's UTF-8 bytes are cut into windows of fixed length, the last one padded. Filters of several
widths run over the windows of a batch, their maxima feed a softmax, and a text's score is the mean
of its windows' probabilities, weighted by their bytes. All windows of a text are read.

The network learns from a bounded sample of labelled texts (`SAMPLE` texts, about as many of each
language and at least one of every language, up to `SAMPLE_WINDOWS` evenly spaced windows of each);
the parameters grow with the number of languages only and go to the tasks with the function.

Documents are kept from a least score on, half way between chance (1 / number of languages) and the
`LOW_QUANTILE` of the scores of all rightly identified texts in the held-out fold. Copies count once,
told by two hashes, so no text is shuffled; the quantile is exact, found by counts of bins.

Defined cases: null text and text without a letter are `und` with score 0; without any labelled text
everything is `und` and nothing is kept; if only the held-out fold has labelled texts, documents to
keep are told by a network that learned from these; with fewer than `MIN_CALIBRATION` held-out texts
the least score is a quarter of the way from chance to 1; of more than `SAMPLE` languages those with
the fewest texts are not learned, and their documents get another language; empty texts teach no language; rows with null or repeated ids are scored each; no rows give no rows. Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import convnet
from ledgerloom.llm.common import held, released, saved

UNKNOWN = "und"
WINDOW = 192
SAMPLE = 4_000
SAMPLE_WINDOWS = 4
WIDTHS, FILTERS, DIM = (2, 3, 4), 12, 8
STEPS, BATCH, RATE, SEED = 1_000, 64, 0.01, 10
CHUNK = 256
MIN_CALIBRATION = 20
LOW_QUANTILE = 0.001
#: Bins that a range of scores is counted in at a time.
BINS = 1_000

LETTER = regex.compile(r"\p{L}")


def text_windows(text: str | None, window: int) -> np.ndarray:
    """(windows, window) byte ids: byte + 1, 0 for padding."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    count = -(-len(data) // window)
    out = np.zeros(count * window, np.int64)
    out[: len(data)] = data
    out[: len(data)] += 1
    return out.reshape(count, window)


def sample_texts(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame | None:
    """Rows (text, lang): about `sample` texts chosen by a hash of the text, some of every language."""
    draw = F.pmod(F.xxhash64("text", F.lit(SEED)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    texts = labelled.filter(F.length("text") > 0).select("text", "lang", draw.alias("draw"))
    counts = (
        texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("draw").alias("low"))
        .orderBy(F.desc("n"), "lang").limit(sample).collect()
    )
    if not counts:
        return None
    each = sample / len(counts)
    # The lowest draw of a language is always in; a row for each language, so at most `sample` rows.
    wanted = texts.sparkSession.createDataFrame(
        [(r["lang"], max(each / r["n"], r["low"] + 1e-9)) for r in counts],
        "wanted_lang string, below double",
    )
    chosen = (F.col("lang") == F.col("wanted_lang")) & (F.col("draw") < F.col("below"))
    # Copies draw alike, so they count once.
    return texts.join(F.broadcast(wanted), chosen).select("text", "lang").distinct()


def sample_windows(labelled: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, list[str]]:
    """Windows and languages of a bounded sample."""
    texts = sample_texts(labelled, sample)
    if texts is None:
        return np.zeros((0, WINDOW), np.int64), []

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                windows = text_windows(text, WINDOW)
                at = np.unique(np.linspace(0, len(windows) - 1, SAMPLE_WINDOWS).astype(int))
                rows += [(lang, windows[i].astype(np.uint16).tobytes()) for i in at]
            yield pd.DataFrame(rows, columns=["lang", "window"])

    rows = texts.mapInPandas(cut, "lang string, window binary").collect()
    rows = sorted((r["lang"], bytes(r["window"])) for r in rows)
    windows = np.array([np.frombuffer(w, np.uint16) for _, w in rows], np.int64)
    return windows.reshape(len(rows), WINDOW), [lang for lang, _ in rows]


class Model:
    """The trained network as tables: a filter's response is a sum of looked-up rows."""

    def __init__(self, net: convnet.ConvNet, languages: list[str]):
        self.languages = languages
        self.dense, self.dense_bias = net.dense, net.dense_bias
        self.bias = net.filter_bias
        self.widths = net.widths
        # For pairs of neighbouring bytes, and for the single byte left over by odd widths.
        one = [[net.embedding @ f for f in filters] for filters in net.filters]
        self.pairs = [
            [
                (t[j][:, None, :] + t[j + 1][None, :, :]).reshape(-1, t[j].shape[1])
                for j in range(0, len(t) - 1, 2)
            ]
            for t in one
        ]
        self.single = [t[-1] if len(t) % 2 else None for t in one]

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        symbols = 257
        n, length = windows.shape
        wide = np.zeros((n, length + 4), np.int32)
        wide[:, :length] = windows
        pair = wide[:, :-1] * symbols + wide[:, 1:]
        features = []
        for k, width in enumerate(self.widths):
            total = None
            for j, table in enumerate(self.pairs[k]):
                part = table.take(pair[:, 2 * j : 2 * j + length], axis=0)
                total = part if total is None else np.add(total, part, out=total)
            if self.single[k] is not None:
                part = self.single[k].take(wide[:, width - 1 : width - 1 + length], axis=0)
                total = part if total is None else np.add(total, part, out=total)
            features.append(np.maximum(total.max(axis=1) + self.bias[k], 0))
        return convnet.softmax(np.concatenate(features, axis=1) @ self.dense + self.dense_bias)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of every text; windows of many texts are computed together."""
        windows = [text_windows(t, WINDOW) for t in texts]
        counts = np.array([len(w) for w in windows])
        total = np.zeros((len(texts), len(self.languages)))
        owner = np.repeat(np.arange(len(texts)), counts)
        if counts.sum():
            every = np.concatenate(windows)
            weight = (every > 0).sum(axis=1)
            for at in range(0, len(every), CHUNK):
                p = self.probabilities(every[at : at + CHUNK])
                np.add.at(total, owner[at : at + CHUNK], p * weight[at : at + CHUNK, None])
        sums = total.sum(axis=1)
        best = total.argmax(axis=1)
        langs, scores = [], []
        for i, text in enumerate(texts):
            if text and sums[i] > 0 and LETTER.search(text):
                langs.append(self.languages[best[i]])
                scores.append(float(min(1.0, total[i, best[i]] / sums[i])))
            else:
                langs.append(UNKNOWN)
                scores.append(0.0)
        return langs, scores


def fit(labelled: DataFrame) -> Model | None:
    """Train on rows (text, lang); null texts and languages teach nothing."""
    labelled = labelled.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    windows, langs = sample_windows(labelled)
    if not langs:
        return None
    languages = sorted(set(langs))
    number = {lang: i for i, lang in enumerate(languages)}
    net = convnet.new_net(257, DIM, WIDTHS, FILTERS, len(languages), SEED)
    target = np.array([number[lang] for lang in langs])
    rows = [w[:, None] for w in windows]
    return Model(convnet.train(net, rows, target, STEPS, BATCH, RATE, SEED), languages)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of `docs` with lang_pred and score; clashing columns must be dropped before."""

    @F.pandas_udf("lang_pred string, score double")
    def identify(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            langs, scores = [], []
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500].tolist()
                one, two = model.predict(part)
                langs += one
                scores += two
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    if model is None:
        none = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
        return docs.select("*", none.alias("identified"))
    return docs.select("*", identify("text").alias("identified"))


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string")) % folds


def identify_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learns outside the held-out fold only."""
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    docs = docs.select("doc_id", "text", "lang", held_out.alias("held_out"))
    model = fit(docs.filter(~F.col("held_out")))
    return predict(docs.drop("lang"), model).select(
        "doc_id", "held_out", "identified.lang_pred", "identified.score"
    )


def least_score(right: np.ndarray, languages: int) -> float:
    """The least score to keep, from the scores of rightly identified held-out texts."""
    chance = 1 / languages
    if len(right) < MIN_CALIBRATION:
        return chance + (1 - chance) / 4
    return (chance + float(np.quantile(right, LOW_QUANTILE))) / 2


def score_at(scores: DataFrame, rank: int) -> float:
    """The score of a rank, from 0 for the least, in a table (score) of any size.

    The bin that holds the rank is cut into finer ones until it holds a single value.
    """
    score = F.col("score")
    low, high = 0.0, 1.0
    while low < high:
        place = F.floor((score - low) / (high - low) * BINS)
        bins = (
            scores.filter(score.between(low, high)).groupBy(place.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
            .orderBy("bin").collect()
        )
        for of in bins:
            if rank < of["n"]:
                break
            rank -= of["n"]
        low, high = of["low"], of["high"]
    return low


def least_score_of(scores: DataFrame, languages: int) -> float:
    """`least_score` of a table (score) of any size."""
    count = scores.count()
    if count < MIN_CALIBRATION:
        return least_score(np.zeros(count), languages)
    at = (count - 1) * LOW_QUANTILE
    below, above = score_at(scores, math.floor(at)), score_at(scores, math.ceil(at))
    return (1 / languages + below + (at - math.floor(at)) * (above - below)) / 2


def calibrated_score(held_out: DataFrame, model: Model) -> float:
    """The least score by all held-out rows (text, lang) with a language."""
    labelled = held_out.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    right = F.col("identified.lang_pred") == F.col("lang")
    # Copies count once. No filter on what was predicted, as Spark would predict once for it and once more.
    scores = (
        predict(labelled, model)
        .groupBy(F.xxhash64("text").alias("key"), F.xxhash64(F.lit(SEED), "text").alias("other_key"))
        .agg(F.max(F.when(right, F.col("identified.score"))).alias("score"))
    )
    return least_score_of(saved(scores.select("score").filter("score IS NOT NULL")), len(model.languages))


def kept_documents(docs: DataFrame, min_score: float | None = None) -> DataFrame:
    """The rows, with all their columns, whose language is known with at least this score.

    Without a score the calibrated one is used.
    """
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = fit(docs.filter(~held_out)) or fit(docs)
    if model is not None and min_score is None:
        min_score = calibrated_score(docs.filter(held_out), model)
    known = F.col("identified.lang_pred") != UNKNOWN
    if model is not None:
        known = known & (F.col("identified.score") >= min_score)
    return released(predict(held(docs), model).filter(known), docs.columns)
