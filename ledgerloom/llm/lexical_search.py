"""Ranked lexical search, reversed: documents stream past an inverted index of the items' terms.

The items are the stated query set. Their distinct terms make an inverted index, term to items, which
is broadcast; items are dealt into groups so that no index holds much more than `INDEX_PAIRS` pairs,
and each group has its own pass. Documents are read twice and never shuffled:

1. Every task counts, over its documents, how many have a term at all (N), all their terms (L) and
   how many hold each indexed term (df). Only these sums leave a task.
2. Every task numbers the terms of a batch of texts, keeps the counts of indexed ones, weighs them and
   follows their lists, which adds each document's score to its items. An item's heap holds the best
   `limit` documents of the task so far; only scores that beat its worst one enter.

The heaps, at most `limit` rows per item and task, are merged in two steps, first for groups of
tasks, so that no single task reads the heaps of all tasks.

All arithmetic but the logarithm of a weight is in 64-bit integers. Terms are compared by their exact
bytes.

Defined cases: null and empty texts have no term and do not count; items without a term have no row;
rows that repeat an item id are one item with the terms of all of them, also for the null id; rows
that repeat a document id are documents of their own; documents without id are ranked after others of
equal score; equal rows take any order among themselves; no documents or no items give no rows.
Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import saved
from ledgerloom.llm.tokens import binary, lower_bytes, numbered, parts, places, runs

LIMIT = 10
INDEX_PAIRS = 500_000
MERGE_GROUPS = 64
SATURATION, MILLE = 1_000_000_000, 1_000

#: Bytes of terms: digits, letters, and all of characters beyond ASCII.
TERM = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])


def terms_of(texts: list[bytes]):
    """(spellings, number, text): distinct terms, and the number and the text of each occurrence."""
    data = lower_bytes(texts, b"\n")
    firsts, ends = runs(data, TERM)
    spellings, number = numbered(data, TERM, firsts, ends)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    return spellings, number, np.searchsorted(text_ends, firsts, "right")


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the distinct terms of every item; written once."""
    kind = items.schema["item_id"].dataType.simpleString()

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, texts in parts(batch["text"]):
                spellings, number, text = terms_of(texts)
                words = np.array(spellings.to_pylist(), object)
                yield pd.DataFrame({
                    "id": batch["id"].iloc[first + text].to_numpy(), "term": words[number],
                })

    # The id travels in a struct, so that null ids stay nulls of their own kind.
    rows = items.select(F.struct("item_id").alias("id"), "text")
    found = rows.mapInPandas(find, f"id struct<item_id: {kind}>, term binary")
    return saved(found.select("id.item_id", "term").distinct())


class Index:
    """Terms in order, and the items of each; items are numbered by place in `items`."""

    def __init__(self, pairs: list[tuple]):
        self.items = sorted({p[0] for p in pairs}, key=lambda i: (i is None, i))
        place = {item: n for n, item in enumerate(self.items)}
        terms = sorted({bytes(p[1]) for p in pairs})
        number = {term: n for n, term in enumerate(terms)}
        self.terms = binary(terms)
        term = np.array([number[bytes(p[1])] for p in pairs], np.int64)
        item = np.array([place[p[0]] for p in pairs], np.int64)
        order = np.lexsort((item, term))
        self.lists = item[order]
        self.starts = np.searchsorted(term[order], np.arange(len(terms) + 1))

    def counts(self, texts: list[bytes]):
        """(n, text, term, tf): terms of every text, and the counts of indexed terms in each."""
        spellings, number, text = terms_of(texts)
        n = np.bincount(text, minlength=len(texts))
        known = places(spellings, self.terms)[number] if len(number) else number.astype(np.int64)
        held = known >= 0
        pair, tf = np.unique(text[held] * len(self.terms) + known[held], return_counts=True)
        return n, pair // len(self.terms), pair % len(self.terms), tf

    def added(self, count: int, text: np.ndarray, term: np.ndarray, value: np.ndarray) -> np.ndarray:
        """(texts, items): the values of each text's terms, added along the terms' lists."""
        length = self.starts[term + 1] - self.starts[term]
        before = np.cumsum(length) - length
        place = np.repeat(self.starts[term] - before, length) + np.arange(length.sum())
        total = np.zeros(count * len(self.items), np.int64)
        np.add.at(total, np.repeat(text, length) * len(self.items) + self.lists[place], np.repeat(value, length))
        return total.reshape(count, len(self.items))


def statistics(docs: DataFrame, index: Index) -> tuple[int, int, np.ndarray]:
    """N, L and the df of every indexed term, over all documents."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(index)
    width = len(index.terms)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(width + 2, np.int64)
        for batch in batches:
            for _, texts in parts(batch["text"]):
                n, _, term, _ = shared.value.counts(texts)
                total[:width] += np.bincount(term, minlength=width)
                total[width:] += (n > 0).sum(), n.sum()
        place = np.flatnonzero(total)
        yield pd.DataFrame({"place": place, "n": total[place]})

    sums = docs.select("text").mapInPandas(count, "place long, n long")
    total = np.zeros(width + 2, np.int64)
    for row in sums.groupBy("place").agg(F.sum("n").alias("n")).collect():
        total[row["place"]] = row["n"]
    shared.unpersist()
    return int(total[width]), int(total[width + 1]), total[:width]


def weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """What a term adds to a document of n terms that holds it tf times."""
    m = 100 - 90 + (90 * n * documents) // all_terms
    return weight * ((SATURATION * tf) // (MILLE * tf + 8 * m))


class Heaps:
    """The best `limit` documents of every item: entries (score, whether with id, -id)."""

    def __init__(self, items: int, limit: int):
        self.limit = limit
        self.heaps: list[list[tuple[int, bool, int]]] = [[] for _ in range(items)]
        #: Scores from which a document may enter.
        self.least = np.ones(items, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        text, item = np.nonzero(scores >= self.least)
        for t, i in zip(text.tolist(), item.tolist(), strict=True):
            heap, entry = self.heaps[i], (int(scores[t, i]), bool(known[t]), -int(ids[t]))
            if len(heap) < self.limit:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            else:
                continue
            if len(heap) == self.limit:
                self.least[i] = heap[0][0]

    def rows(self, items: list) -> list[tuple]:
        return [
            (items[i], -entry[2] if entry[1] else None, entry[0])
            for i, heap in enumerate(self.heaps)
            for entry in heap
        ]


def best_of_tasks(docs: DataFrame, items: DataFrame, index: Index, limit: int) -> DataFrame:
    """(item, doc_id, score, task): every task's heaps; items as their places in the index."""
    documents, all_terms, df = statistics(docs, index)
    weight = weights(documents, df)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        heaps = Heaps(len(index.items), limit)
        for batch in batches:
            known, ids = batch["known"].to_numpy(bool), batch["id"].to_numpy(np.int64)
            for first, texts in parts(batch["text"]):
                n, text, term, tf = index.counts(texts)
                value = impacts(weight[term], tf, n[text], documents, all_terms)
                rows = slice(first, first + len(texts))
                heaps.add(index.added(len(texts), text, term, value), ids[rows], known[rows])
        rows = heaps.rows(list(range(len(index.items))))
        yield pd.DataFrame({
            "item": pd.array([r[0] for r in rows], "Int32"),
            "doc_id": pd.array([r[1] for r in rows], "Int64"),
            "score": pd.array([r[2] for r in rows], "Int64"),
        })

    # Absent ids travel as a mark, since pandas would turn the others into floating-point numbers.
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNotNull().alias("known"), "text")
    found = rows.mapInPandas(search, "item int, doc_id long, score long")
    return found.withColumn("task", F.spark_partition_id() % MERGE_GROUPS)


def merged(heaps: DataFrame, limit: int) -> DataFrame:
    """(item, rank, doc_id, score): the best of all heaps, first within groups of tasks."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    within = Window.partitionBy("item", "task").orderBy(*order)
    some = heaps.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= limit)
    over_all = Window.partitionBy("item").orderBy(*order)
    return some.withColumn("rank", F.row_number().over(over_all)).filter(F.col("rank") <= limit)


def search(docs: DataFrame, items: DataFrame, limit: int = LIMIT, index_pairs: int = INDEX_PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's best documents with a score above 0."""
    pairs = item_terms(items)
    groups = max(1, -(-pairs.count() // index_pairs))
    group = F.pmod(F.xxhash64("item_id"), F.lit(groups))
    kind = items.schema["item_id"].dataType.simpleString()
    spark, out = docs.sparkSession, None
    for k in range(groups):
        # At most about `index_pairs` pairs: the index of one group of the query set.
        rows = [tuple(r) for r in pairs.filter(group == k).collect()]
        if not rows:
            continue
        index = Index(rows)
        # The heaps are written, so the index of a group can go before the next one comes.
        best = merged(saved(best_of_tasks(docs, items, index, limit)), limit)
        names = spark.createDataFrame(list(enumerate(index.items)), f"item int, item_id {kind}")
        part = best.join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out
