"""Best-fit packing of tokenised documents into sequences of a fixed size, by linear grouping.

1. Documents become token ids and an end id; longer ones are cut into full pieces, the rest in front.
2. Pieces are counted by length. There are no more lengths than tokens in a sequence, so this count
   has the same size for any corpus, and the plan is made from it alone:
   - large lengths, in falling order, are cut into groups of equal cardinality and rounded up to the
     longest of their group;
   - the best mix of configurations of these few sizes is found by linear programming, new
     configurations coming from a knapsack over the prices of the sizes;
   - whole multiples of the configurations are filled with actual lengths from the groups; where
     those fill less than the rounded sizes did, the lengths go back;
   - what is left, and the small lengths, go best-fit into the remaining space, longest first.
   The plan lists runs of equal sequences: for each length, which ranks go where.
3. Pieces are ranked within their length. Ranks are counted in salted parts and then put together, so
   a length that most pieces have is not one task's work.
4. Rank and length give sequence and offset by a search in the plan.

Defined cases: null text is empty; an empty document is its end id alone; rows with null or repeated
ids are packed each; no rows give no pieces. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm.bpe_trie import byte_symbols
from ledgerloom.llm.common import saved

SIZE = 1024
END_ID = 2
GROUPS = 96
SMALL = 8  # lengths of up to size / SMALL are small
ROUNDS = 400
TOLERANCE = 1  # tokens a substituted configuration may leave empty; others are packed best-fit
PART_ROWS = 100_000
RANK_BITS = 40

# Fixed value: how byte-level vocabularies of this kind cut text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteBpe:
    """Ids of texts by one tokenizer file; texts of plain characters by the faster of two libraries."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        added = [t["content"] for t in file["added_tokens"]]
        # Letters of later Unicode versions and added tokens are left to the file's own library.
        self.other = re.compile("|".join(["[^\x00-ɏ]", *map(re.escape, added)]))
        byte = {s: b for b, s in enumerate(byte_symbols())}
        vocabulary = {t: i for t, i in file["model"]["vocab"].items() if t not in added}
        self.fast = tiktoken.Encoding(
            "file",
            pat_str=PATTERN,
            mergeable_ranks={bytes(byte[c] for c in t): i for t, i in vocabulary.items()},
            special_tokens={},
        )

    def encode(self, text: str) -> np.ndarray:
        if self.other.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, "<u4")


def cut(count: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of `count` ids; only the first may be shorter."""
    first = count % size or size
    if count <= size:
        return [(0, count)]
    return [(0, first), *((start, size) for start in range(first, count, size))]


def tokenised_pieces(
    docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the ids if asked for."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if with_ids:
        schema, names = schema + ", ids array<long>", [*names, "ids"]

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = ByteBpe(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].astype(object), batch["text"], strict=True):
                ids = np.append(bpe.encode(text or ""), np.uint32(end_id)).astype("<u4")
                doc_id = None if pd.isna(doc_id) else doc_id
                for k, (start, length) in enumerate(cut(len(ids), size)):
                    part = ids[start : start + length]
                    row = (doc_id, k, start, length, zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype(np.int64)) if with_ids else row)
            out = pd.DataFrame(rows, columns=names)
            if kind in ("bigint", "int"):
                out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select("doc_id", "text").mapInPandas(pieces, schema)


@dataclass
class Run:
    """`count` sequences that hold the same lengths."""

    count: int
    lengths: tuple[int, ...]


def grouped(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """(length, count) in falling order, cut into groups of equal cardinality (the last is smaller)."""
    total = sum(counts.values())
    room = -(-total // groups) if total else 0
    out: list[list[tuple[int, int]]] = []
    left = 0
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            if not left:
                out.append([])
                left = room
            take = min(n, left)
            out[-1].append((length, take))
            n, left = n - take, left - take
    return out


def best_configuration(sizes: np.ndarray, prices: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """The configuration of the highest price that fits (unbounded knapsack)."""
    best = np.zeros(size + 1)
    choice = np.full(size + 1, -1)
    for room in range(1, size + 1):
        best[room] = best[room - 1]
        fits = np.flatnonzero(sizes <= room)
        if len(fits):
            value = best[room - sizes[fits]] + prices[fits]
            top = int(value.argmax())
            if value[top] > best[room] + 1e-12:
                best[room], choice[room] = value[top], fits[top]
    counts = np.zeros(len(sizes))
    room = size
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(best[size]), counts


def configurations(sizes: list[int], demand: list[int], size: int) -> list[tuple[int, list[int]]]:
    """(multiple, items of every size): whole parts of the best mix that covers the demand."""
    s, d = np.array(sizes), np.array(demand, float)
    base = np.diag(size // s).astype(float)
    for _ in range(ROUNDS):
        amount = np.linalg.solve(base, d)
        prices = np.linalg.solve(base.T, np.ones(len(s)))
        value, column = best_configuration(s, prices, size)
        if value <= 1 + 1e-9:
            break
        along = np.linalg.solve(base, column)
        ratio = np.where(along > 1e-9, amount / np.where(along > 1e-9, along, 1), np.inf)
        base[:, int(ratio.argmin())] = column
    amount = np.linalg.solve(base, d)
    return [
        (int(np.floor(a + 1e-9)), [int(round(x)) for x in base[:, k]])
        for k, a in enumerate(amount)
        if a >= 1
    ]


def take_from(queue: list[list[int]], wanted: int) -> list[tuple[int, int]]:
    """Take `wanted` items from the front of a queue of [length, count]."""
    out = []
    while wanted and queue:
        k = min(wanted, queue[0][1])
        out.append((queue[0][0], k))
        queue[0][1] -= k
        wanted -= k
        if not queue[0][1]:
            queue.pop(0)
    return out


def aligned(slots: list[list[tuple[int, int]]]) -> list[Run]:
    """Runs of sequences that take one item from each slot; all slots hold equally many."""
    slots = [[list(x) for x in slot] for slot in slots]
    out = []
    while slots and slots[0]:
        k = min(slot[0][1] for slot in slots)
        out.append(Run(k, tuple(slot[0][0] for slot in slots)))
        for slot in slots:
            slot[0][1] -= k
            if not slot[0][1]:
                slot.pop(0)
    return out


def plan(counts: dict[int, int], size: int = SIZE, groups: int = GROUPS) -> list[Run]:
    """Runs of sequences that together hold every piece counted."""
    left = dict(counts)
    runs = [Run(n, (size,)) for n in [left.pop(size, 0)] if n]
    large = {length: n for length, n in left.items() if length > size // SMALL}
    parts = grouped(large, groups)
    if parts:
        queues = [[list(x) for x in part] for part in parts]
        sizes = [part[0][0] for part in parts]
        demand = [sum(n for _, n in part) for part in parts]
        loose: dict[int, int] = {}
        for wanted, items in configurations(sizes, demand, size):
            used = [g for g, k in enumerate(items) if k]
            have = [sum(n for _, n in queues[g]) for g in used]
            multiple = min([wanted, *(n // items[g] for n, g in zip(have, used, strict=True))])
            slots = [take_from(queues[g], multiple) for g in used for _ in range(items[g])]
            for run in aligned(slots):
                if size - sum(run.lengths) <= TOLERANCE:
                    runs.append(run)
                else:
                    for length in run.lengths:
                        loose[length] = loose.get(length, 0) + run.count
        for length in large:
            left[length] = loose.get(length, 0)
        for queue in queues:
            for length, n in queue:
                left[length] += n
    return best_fit(runs, left, size)


def best_fit(runs: list[Run], left: dict[int, int], size: int) -> list[Run]:
    """Put the lengths left, longest first, where the least space remains."""
    by_room: list[list[Run]] = [[] for _ in range(size + 1)]
    for run in runs:
        by_room[size - sum(run.lengths)].append(run)
    for length in sorted((x for x, n in left.items() if n), reverse=True):
        n, room = left[length], length
        while n:
            while room <= size and not by_room[room]:
                room += 1
            if room > size:
                fit = size // length
                for count, each in ((n // fit, fit), (1, n % fit)):
                    if count and each:
                        by_room[size - each * length].append(Run(count, (length,) * each))
                break
            run = by_room[room].pop()
            k = min(n, run.count)
            if k < run.count:
                by_room[room].append(Run(run.count - k, run.lengths))
            by_room[room - length].append(Run(k, (*run.lengths, length)))
            n -= k
            room = max(length, room - length) if room - length >= length else room
    return [run for runs_of in by_room for run in runs_of]


def places(runs: list[Run]) -> dict[str, np.ndarray]:
    """Where ranks go: first key (length and rank), first sequence and offset of every stretch."""
    following: dict[int, int] = {}
    rows, sequence = [], 0
    for run in runs:
        offset = 0
        for length in run.lengths:
            rank = following.get(length, 0)
            rows.append(((length << RANK_BITS) + rank, sequence, offset))
            following[length] = rank + run.count
            offset += length
        sequence += run.count
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return {"key": table[:, 0], "sequence": table[:, 1], "offset": table[:, 2]}


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """`pieces` with `rank`, from 0 within each length, counted in salted parts."""
    parts = max(1, -(-total // PART_ROWS))
    salted = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    sizes = salted.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        "length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = salted.withColumn("inside", F.row_number().over(inside) - 1)
    return numbered.join(bases, ["length", "part"]).withColumn(
        "rank", F.col("base") + F.col("inside")
    )


def placed(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """`pieces` (written once) with sequence_id and offset."""
    pieces = saved(pieces)
    counts = {
        r["length"]: r["n"]
        for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    names = pieces.columns
    at = places(plan(counts, size))
    key, sequence, offset = at["key"], at["sequence"], at["offset"]

    @F.pandas_udf("sequence_id long, offset long")
    def place(keys: pd.Series) -> pd.DataFrame:
        keys = keys.to_numpy(np.int64)
        k = np.searchsorted(key, keys, side="right") - 1
        return pd.DataFrame(
            {"sequence_id": sequence[k] + (keys - key[k]), "offset": offset[k]}
        )

    numbered = ranked(pieces, sum(counts.values()))
    keyed = F.col("length") * F.lit(1 << RANK_BITS) + F.col("rank")
    return numbered.select(*names, place(keyed).alias("p")).select(*names, "p.*")


def pack(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return placed(tokenised_pieces(docs, path, size, end_id), size)
