"""Substring dedup: removes words inside windows that also start in an earlier document.

A window is `WINDOW` consecutive words. Grouping all windows would move as many rows as there are
words, so a count-min sketch sifts them first. Texts are dealt to units of about `UNIT` characters by
a hash, in one shuffle that all passes share:

1. Every unit builds its own sketch of all its windows: `ROWS` rows of counters, each row as wide as
   the corpus has characters, about six counters a window. A unit's counters that are not zero are
   cut into shards of `SHARD` counters and packed, so a sketch of any width is merged piece by piece.
2. Every shard adds up the sketches of all units in one dense array, and tells each unit by one bit
   for each of its counters whether two or more windows are counted there.
3. A window whose counters all reach two is estimated to be repeated; only such windows go on. Sums
   of counters never fall below a window's count, so none that occurs twice is lost.
4. These are grouped exactly. A unit sends each of its windows once, with its smallest document id,
   and learns by one bit whether an earlier document has it. So copies meet inside units first, and a
   window that every document holds is one row of each unit.
5. Words covered by a window with a smaller first document go; the text keeps the other words,
   joined by single spaces.

Counters hold 0, 1 and 2, where 2 stands for more. Windows are told apart by two 64-bit polynomial
hashes of 64-bit word hashes. All steps are one plan: a lost executor costs its own units and shards.

Defined cases: null, empty and short texts have no window; documents with a null id neither lose nor
take words; rows that repeat an id are one document; repeated rows give repeated results (equal rows
share a unit); no rows give no rows. Other columns are ignored, or kept by `deduplicated_documents`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructType

from ledgerloom.llm.hashing import BYTE_BASE, WORD_BASE, Powers, mixed, run_hashes, word_hashes_of

WINDOW = 50
UNIT = 4_000_000
SHARD = 1 << 25
LEAST_WIDTH = 1 << 10
ROWS = 2

# Odd multiplier of the second window hash and one number for each row of the sketch (arbitrary).
SECOND_BASE = 0xA0761D6478BD642F
SEEDS = (np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3))

#: Texts and their starts (none: null) to columns of values.
Derive = Callable[[list[str], list], list[pa.Array]]

PIECES = "unit long, shard long, n long, body binary"


class Shape(NamedTuple):
    """Words of a window, counters of a row and of a shard, number of units."""

    window: int
    width: int
    shard: int
    units: int


def shape_of(docs: DataFrame, window: int, unit: int, shard: int) -> Shape:
    """Units and width that suit the number of characters in texts that are long enough."""
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return Shape(window, max(LEAST_WIDTH, size), shard, size // unit + 1)


class Windows:
    """All windows of a unit's texts: two hashes, the row of the text and the first word."""

    def __init__(self, texts: list[str], window: int):
        of_bytes, first, second = Powers(BYTE_BASE), Powers(WORD_BASE), Powers(SECOND_BASE)
        parts = []
        for row, hashes in enumerate(word_hashes_of(texts, of_bytes)):
            at = np.arange(max(0, len(hashes) - window + 1))
            parts.append(
                (
                    run_hashes(hashes, at, at + window, first),
                    run_hashes(hashes, at, at + window, second),
                    np.full(len(at), row),
                    at,
                )
            )
        self.hash, self.check, self.row, self.start = map(np.concatenate, zip(*parts, strict=True))


def counters(hashes: np.ndarray, shape: Shape) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each row of a unit's sketch: its counters above zero, every window's one, the counts."""
    for seed in SEEDS[:ROWS]:
        places = (mixed(hashes ^ seed) % np.uint64(shape.width)).astype(np.int64)
        yield np.unique(places, return_inverse=True, return_counts=True)


def runs(shards: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) of every run of equal numbers."""
    if len(shards):
        cuts = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1], [True]]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(shards[a]), int(a), int(b)


def packed(*columns: np.ndarray) -> bytes:
    """Columns of numbers, each as planes of bytes, which the shuffle's compression likes best."""
    return b"".join(c.view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)


def unpacked(body: bytes, n: int, *kinds: str) -> list[np.ndarray]:
    columns, at = [], 0
    for kind in kinds:
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(body, np.uint8, n * width, at).reshape(width, n)
        columns.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += n * width
    return columns


def flags(bits: np.ndarray) -> bytes:
    return np.packbits(bits).tobytes()


def read_flags(body: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(body, np.uint8), count=n).astype(bool)


def pieces(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else ((), (), (), ())
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    named = zip(("unit", "shard", "n", "body"), columns, kinds, strict=True)
    return pa.table({name: pa.array(list(c), kind) for name, c, kind in named})


def unit_sketch(unit: int, texts: list[str], shape: Shape) -> pa.Table:
    """The sketch of a unit's windows, in shards: places as differences, and which counts pass one."""
    out = []
    shards = -(-shape.width // shape.shard)
    for row, (places, _, counts) in enumerate(counters(Windows(texts, shape.window).hash, shape)):
        for shard, a, b in runs(places // shape.shard):
            steps = np.diff(places[a:b], prepend=shard * shape.shard).astype(np.uint32)
            several = (counts[a:b] > 1).astype(np.uint8)
            out.append((unit, row * shards + shard, b - a, packed(steps, several)))
    return pieces(out)


def merged_sketch(rows: pa.Table, shape: Shape) -> pa.Table:
    """One shard of the sum of all sketches, as a bit for every counter that a unit sent."""
    total = np.zeros(min(shape.shard, shape.width), np.uint8)
    sent = list(zip(*(rows[c].to_pylist() for c in ("unit", "shard", "n", "body")), strict=True))

    def places(n: int, body: bytes) -> tuple[np.ndarray, np.ndarray]:
        steps, several = unpacked(body, n, "uint32", "uint8")
        return np.cumsum(steps, dtype=np.int64), several

    for _, _, n, body in sent:
        at, several = places(n, body)
        total[at] = np.minimum(total[at] + 1 + several, 2)
    return pieces([(u, s, n, flags(total[places(n, body)[0]] >= 2)) for u, s, n, body in sent])


class Candidates:
    """A unit's windows that the merged sketch takes for repeated, and the groups of equal ones."""

    def __init__(self, ids: list[int], texts: list[str], replies: pa.Table, shape: Shape):
        every = Windows(texts, shape.window)
        order = np.argsort(np.array(replies["shard"], dtype=np.int64), kind="stable")
        counts, bodies = replies["n"].to_pylist(), replies["body"].to_pylist()
        bits = [read_flags(bodies[i], counts[i]) for i in order]
        repeated = np.concatenate([*bits, np.zeros(0, bool)])
        chosen, used = np.ones(len(every.hash), bool), 0
        for places, own, _ in counters(every.hash, shape):
            chosen &= repeated[used : used + len(places)][own]
            used += len(places)
        kept = np.flatnonzero(chosen)
        docs = np.array(ids, np.int64)[every.row[kept]]
        by = np.lexsort((docs, every.check[kept], every.hash[kept]))
        kept, self.docs = kept[by], docs[by]
        self.hash, self.check = every.hash[kept], every.check[kept]
        self.row, self.start = every.row[kept], every.start[kept]
        new = firsts_of(self.hash, self.check)
        self.first, self.group = np.flatnonzero(new), np.cumsum(new) - 1


def firsts_of(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def unit_windows(unit: int, found: Candidates, shape: Shape) -> pa.Table:
    """Each candidate of a unit once, with its smallest document id, in shards by its hash."""
    h, check, docs = (c[found.first] for c in (found.hash, found.check, found.docs))
    shards = ((h >> np.uint64(33)) * np.uint64(shape.units)) >> np.uint64(31)
    return pieces(
        [(unit, s, b - a, packed(h[a:b], check[a:b], docs[a:b])) for s, a, b in runs(shards)]
    )


def first_documents(rows: pa.Table) -> pa.Table:
    """For every window that a unit sent: whether another unit has it in a smaller document."""
    sent = list(zip(*(rows[c].to_pylist() for c in ("unit", "shard", "n", "body")), strict=True))
    parts = [unpacked(body, n, "uint64", "uint64", "int64") for _, _, n, body in sent]
    h, check, docs = (np.concatenate(c) for c in zip(*parts, strict=True))
    by = np.lexsort((docs, check, h))
    new = firsts_of(h[by], check[by])
    lowest = docs[by][np.flatnonzero(new)][np.cumsum(new) - 1]
    later = np.empty(len(by), bool)
    later[by] = docs[by] > lowest
    ends = np.cumsum([n for _, _, n, _ in sent])
    return pieces([(u, s, n, flags(later[e - n : e])) for (u, s, n, _), e in zip(sent, ends, strict=True)])


def later_starts(found: Candidates, replies: pa.Table, count: int) -> list[np.ndarray | None]:
    """For every text the windows that also start in a smaller document; none: null."""
    order = np.argsort(np.array(replies["shard"], dtype=np.int64), kind="stable")
    counts, bodies = replies["n"].to_pylist(), replies["body"].to_pylist()
    bits = [read_flags(bodies[i], counts[i]) for i in order]
    elsewhere = np.concatenate([*bits, np.zeros(0, bool)])[found.group]
    later = elsewhere | (found.docs > found.docs[found.first][found.group])
    row, start = found.row[later], found.start[later]
    by = np.lexsort((start, row))
    row, start = row[by], start[by].astype(np.int32)
    cuts = np.searchsorted(row, np.arange(count + 1))
    return [start[a:b] if a < b else None for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def derived(docs: DataFrame, shape: Shape, derive: Derive, kinds: StructType) -> DataFrame:
    """Rows with an id and a text, without the text, and what `derive` makes of text and starts.

    A text's starts are those of its windows that an earlier document has. The values are made where
    the starts are found, so no second Python worker is held beside the first.
    """
    units = docs.withColumn("unit", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shape.units)))
    columns = [c for c in docs.columns if c != "text"]
    schema = StructType([docs.schema[c] for c in columns] + list(kinds))

    def unit_of(table: pa.Table) -> int:
        return table["unit"][0].as_py()

    def step(table: pa.Table, number: int) -> pa.Table:
        return table.filter(pa.compute.equal(table["step"], number))

    def candidates(texts: pa.Table, replies: pa.Table) -> Candidates:
        ids, said = texts["doc_id"].to_pylist(), texts["text"].to_pylist()
        return Candidates(ids, said, step(replies, 1), shape)

    def sketch(texts: pa.Table) -> pa.Table:
        return unit_sketch(unit_of(texts), texts["text"].to_pylist(), shape)

    def merge(rows: pa.Table) -> pa.Table:
        return merged_sketch(rows, shape)

    def send(texts: pa.Table, replies: pa.Table) -> pa.Table:
        return unit_windows(unit_of(texts), candidates(texts, replies), shape)

    def finish(texts: pa.Table, replies: pa.Table) -> pa.Table:
        starts = later_starts(candidates(texts, replies), step(replies, 2), len(texts))
        values = derive(texts["text"].to_pylist(), starts)
        kept = [texts[c] for c in columns]
        return pa.Table.from_arrays([*kept, *values], names=schema.names)

    # The units are asked for three times in one plan, so Spark moves the texts once.
    sketches = units.groupBy("unit").applyInArrow(sketch, PIECES)
    estimates = sketches.groupBy("shard").applyInArrow(merge, PIECES).withColumn("step", F.lit(1))
    sent = units.groupBy("unit").cogroup(estimates.groupBy("unit")).applyInArrow(send, PIECES)
    exact = sent.groupBy("shard").applyInArrow(first_documents, PIECES).withColumn("step", F.lit(2))
    replies = estimates.unionByName(exact)
    return units.groupBy("unit").cogroup(replies.groupBy("unit")).applyInArrow(finish, schema)


def kept_words(text: str | None, starts, window: int) -> tuple[list[bytes], int]:
    """The words outside the windows that begin at `starts`, and the number of all words."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if starts is None or not len(starts):
        return words, len(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, np.asarray(starts, np.int64), 1)
    np.add.at(change, np.asarray(starts, np.int64) + window, -1)
    covered = np.cumsum(change)[:-1] > 0
    return [w for w, gone in zip(words, covered, strict=True) if not gone], len(words)


def divided(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Rows that may hold windows, and all others, which keep every word."""
    # So many words have so many characters and the spaces between them.
    some = F.col("doc_id").isNotNull() & (F.length("text") >= 2 * window - 1)
    some = F.coalesce(some, F.lit(False))
    return docs.filter(some), docs.filter(~some)


def digests(docs: DataFrame, window: int = WINDOW, unit: int = UNIT, shard: int = SHARD) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the words kept, for every row."""

    def digest(texts: list[str | None], starts: list) -> list[pa.Array]:
        rows = []
        for text, at in zip(texts, starts, strict=True):
            kept, count = kept_words(text, at, window)
            rows.append((count, count - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        kinds = (pa.int64(), pa.int64(), pa.string())
        return [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]

    some, rest = divided(docs.select("doc_id", "text"), window)
    kinds = (
        StructType().add("n_words", LongType()).add("n_removed", LongType())
        .add("kept_sha256", StringType())
    )
    found = derived(some, shape_of(some, window, unit, shard), digest, kinds)
    names, schema = found.columns, found.schema

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = digest(batch["text"].to_pylist(), [None] * len(batch))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *values], names=names)

    return found.unionByName(rest.mapInArrow(short, schema))


def deduplicated_documents(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All rows and columns of `docs`; texts that lose words keep the others, single-spaced."""

    def cut(texts: list[str], starts: list) -> list[pa.Array]:
        new = [
            text if at is None
            else b" ".join(kept_words(text, at, window)[0]).decode("utf-8", "surrogatepass")
            for text, at in zip(texts, starts, strict=True)
        ]
        return [pa.array(new, pa.string()), pa.array([at is not None for at in starts], pa.bool_())]

    named = [f"c{i}" for i in range(len(docs.columns))]
    others = [(c, n) for c, n in zip(docs.columns, named, strict=True) if c != "text"]
    row = F.struct(*(F.col(f"`{c}`").alias(n) for c, n in others))
    some, rest = divided(docs.select("doc_id", "text", row.alias("row")), window)
    kinds = StructType().add("new_text", StringType()).add("changed", BooleanType())
    found = derived(some, shape_of(some, window, UNIT, SHARD), cut, kinds).unionByName(
        rest.select("doc_id", "row", F.col("text").alias("new_text"), F.lit(False).alias("changed"))
    )
    values = {c: F.col("new_text") for c in docs.columns} | {
        c: F.col(f"row.{n}") for c, n in others
    }
    if "n_chars" in values:
        values["n_chars"] = F.when(
            F.col("changed"), F.length("new_text").cast("long")
        ).otherwise(values["n_chars"])
    return found.select(*(v.alias(c) for c, v in values.items()))
