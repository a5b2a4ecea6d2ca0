"""Phrase collocation mining: candidates are counted by double-array tries that all positions walk.

Texts, lower-cased in A-Z, are cut into pieces and words, and written once as chunks of numbered words,
each chunk with the spellings of its own numbers, so no dictionary of the whole corpus is needed.

1. Candidates. A phrase that occurs `min_count` times has no rarer part (Apriori). Level by level,
   tasks count hashes of the phrases of that length whose two shorter parts passed the level before,
   and name one chunk that holds each. Their counts are cut into shards, ranges of hashes that grow in
   number with the corpus; shards are added up, and hashes that reach `min_count` pass. What passed
   becomes a bitmap of `FILTER_BITS` bits, of one size at any input, for the next level. A second bitmap
   marks pairs of hash and named chunk; a last pass spells out the marked phrases of every chunk, so
   each candidate is written about once. Bitmaps hold some more than was put in, so there are some false
   candidates.
2. Counting. Candidates become tries of at most about `trie_phrases` phrases, stored as double arrays:
   state t = base[s] + word follows state s if check[t] = s. A trie is broadcast; in every task all
   positions of a chunk take their next word at once, level by level, and positions without a
   transition drop out. Accepting states are counted by bincount; the tasks' counts are cut into shards,
   and shards are added up.
3. Scores follow from the counts by joins, in exact decimals.

Counts are of spelt words and phrases. Hashes only choose candidates: they have 96 bits where counts
of tasks meet and 64 bits within a task, and a phrase is lost only if another one shares them. With
more candidates there are more tries and as many passes over the chunks; what a task holds and what is
broadcast stays bounded.

Defined cases: null, empty and blank texts have no words; a null language is `und`; rows that repeat
an id, and rows without id, are documents of their own, as ids play no part; equal rows count each; no
rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import saved, shuffle_width
from ledgerloom.llm.hashing import BYTE_BASE, WORD_BASE, Powers, mixed, run_hashes
from ledgerloom.llm.tokens import CHUNK_BYTES, binary, lower_bytes, numbered, places, runs

MIN_COUNT = 100
LONGEST = 5
TOP = 2_000
ABSORBED_PERCENT = 100
UNKNOWN = "und"
FILTER_BITS = 1 << 26
HELD_BYTES = 32 * CHUNK_BYTES
HELD_ENTRIES = 1 << 19
SHARD_WORDS = 1 << 20
TRIE_PHRASES = 250_000
SHARD_PHRASES = 4_096

BREAK = np.isin(np.arange(256), np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))
WORD = ~(BREAK | np.isin(np.arange(256), np.frombuffer(b" \t", np.uint8)))


def word_numbers(texts: list[bytes]) :
    """Spellings, and 1 + the number of every word in order, with 0 between pieces."""
    data = lower_bytes(texts, b"\n")
    firsts, ends = runs(data, WORD)
    spellings, number = numbered(data, WORD, firsts, ends)
    passed = np.cumsum(BREAK[data])
    new_piece = np.zeros(len(firsts), np.int64)
    new_piece[1:] = passed[firsts[1:]] > passed[ends[:-1] - 1]
    out = np.zeros(len(firsts) + int(new_piece.sum()), np.int32)
    out[np.arange(len(firsts)) + np.cumsum(new_piece)] = number + 1
    return spellings, out


def chunks(docs: DataFrame) -> DataFrame:
    """(chunk, lang, n, words, numbers): texts of one language, about `CHUNK_BYTES` in a row; written once."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def row(lang: str) -> pd.DataFrame:
            size.pop(lang)
            spellings, numbers = word_numbers(held.pop(lang))
            words = b"\n".join(spellings.to_pylist())
            n = int((numbers > 0).sum())
            return pd.DataFrame({"lang": [lang], "n": [n], "words": [words], "numbers": [numbers.tobytes()]})

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                held.setdefault(lang, []).append(data)
                size[lang] = size.get(lang, 0) + len(data) + 1
                if size[lang] >= CHUNK_BYTES:
                    yield row(lang)
                elif sum(size.values()) >= HELD_BYTES:
                    yield from map(row, list(held))
        yield from map(row, list(held))

    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    found = rows.mapInPandas(cut, "lang string, n long, words binary, numbers binary")
    return saved(found.withColumn("chunk", F.monotonically_increasing_id()))


class Chunk:
    def __init__(self, chunk: int, lang: str, words: bytes, numbers: bytes):
        self.chunk, self.lang = np.array([chunk], np.uint64), lang.encode()
        self.words = words.split(b"\n")
        self.numbers = np.frombuffer(numbers, np.int32)

    def hashes(self, powers: Powers) -> np.ndarray:
        """Hash of every word number under the chunk's language; 0 for breaks."""
        spelt = [self.lang + b"\n" + w for w in self.words]
        data = np.frombuffer(b"".join(spelt), np.uint8).astype(np.uint64) + np.uint64(1)
        ends = np.cumsum([len(w) for w in spelt])
        firsts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        return np.concatenate([np.zeros(1, np.uint64), run_hashes(data, firsts, ends, powers)])


def chunks_of(batches: Iterator[pd.DataFrame]) -> Iterator[Chunk]:
    for batch in batches:
        for row in zip(batch["chunk"], batch["lang"], batch["words"], batch["numbers"], strict=True):
            if len(row[3]):
                yield Chunk(*row)


def longer(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase and one more word."""
    return mixed(key * np.uint64(3) + word)


def bit_place(key: np.ndarray) -> np.ndarray:
    return (key & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def in_chunk(key: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """Hash of a phrase's hash and a chunk."""
    return mixed(key ^ mixed(chunk + np.uint64(1)))


def marked(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether the bits at these places are set, in words of 64 bits."""
    return (bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0


def levels(chunk: Chunk, own: np.ndarray, passed: list[np.ndarray]):
    """For each length, from 1 on, positions and hashes of the phrases that passed.

    `own` has the hash of the word at every position. One length more than there are bitmaps comes
    out: the phrases whose two shorter parts passed.
    """
    at = np.flatnonzero(chunk.numbers)
    key = own[at]
    for k, bits in enumerate(passed):
        ok = marked(bits, bit_place(key))
        at, key = at[ok], key[ok]
        yield at, key
        # Longer by a word: where the phrase that starts one word later passed, too.
        pair = np.flatnonzero(at[1:] == at[:-1] + 1)
        at = at[pair]
        key = longer(key[pair], own[at + k + 1])
    yield at, key


#: What is known of a phrase hash: a second hash, a count, and the chunk's place after its file's first.
ENTRY = np.dtype([("hash", "<u8"), ("other", "<u4"), ("n", "<u4"), ("chunk", "<u4")])
FILE_SHIFT = np.uint64(33)  # monotonically increasing ids count within a partition below this bit


class HashCounts:
    """Entries for the phrase hashes in the chunks of one task, given out whenever many are held."""

    def __init__(self, length: int, shards: int):
        self.length, self.shards, self.size = length, shards, 0
        self.held: list[np.ndarray] = []
        self.base = 0

    def add(self, chunk: Chunk, at: np.ndarray, key: np.ndarray, other: np.ndarray) -> None:
        """`other` has the second hash of the word at every position."""
        found, first, n = np.unique(key, return_index=True, return_counts=True)
        at = at[first]
        second = other[at]
        for k in range(1, self.length):
            second = longer(second, other[at + k])
        entries = np.zeros(len(found), ENTRY)
        entries["hash"], entries["other"], entries["n"] = found, second >> np.uint64(32), n
        file = chunk.chunk >> FILE_SHIFT << FILE_SHIFT
        entries["chunk"], self.base = chunk.chunk - file, int(file[0])
        self.held.append(entries)
        self.size += len(entries)

    def rows(self) -> pd.DataFrame:
        """(shard, base, entries) of all that is held; shards are ranges of hashes."""
        entries = added(np.concatenate(self.held), ["hash"])
        edges = np.arange(1, self.shards, dtype=np.uint64) * np.uint64((1 << 64) // self.shards)
        cuts = np.concatenate([[0], np.searchsorted(entries["hash"], edges), [len(entries)]])
        self.held, self.size = [], 0
        shard = np.flatnonzero(np.diff(cuts))
        parts = [packed(entries[cuts[s] : cuts[s + 1]]) for s in shard]
        return pd.DataFrame({"shard": shard, "base": self.base, "entries": parts})


def packed(entries: np.ndarray) -> bytes:
    """One field after the other, as small numbers side by side compress well."""
    return b"".join(np.ascontiguousarray(entries[c]).tobytes() for c in ENTRY.names)


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros(len(data) // ENTRY.itemsize, ENTRY)
    at = 0
    for name in ENTRY.names:
        kind = ENTRY[name]
        out[name] = np.frombuffer(data, kind, len(out), at)
        at += len(out) * kind.itemsize
    return out


def added(entries: np.ndarray, by: list[str]) -> np.ndarray:
    """Entries of equal hashes as one, with the sum of their counts, in the order of hashes."""
    entries = entries[np.lexsort([entries[c] for c in reversed(by)])]
    new = np.any([entries[c][1:] != entries[c][:-1] for c in by], axis=0)
    first = np.flatnonzero(np.concatenate([[True], new]))
    out = entries[first]
    out["n"] = np.minimum(np.add.reduceat(entries["n"].astype(np.uint64), first), (1 << 32) - 1)
    return out


def frequent_hashes(corpus: DataFrame, passed: list[np.ndarray], shards: int, min_count: int) -> DataFrame:
    """(hash, chunk) of the phrases of the next length that reach `min_count`; written once."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one, two = Powers(BYTE_BASE), Powers(WORD_BASE)
        counts = HashCounts(len(passed) + 1, shards)
        for chunk in chunks_of(batches):
            *_, (at, key) = levels(chunk, chunk.hashes(one)[chunk.numbers], passed)
            if counts.size and int((chunk.chunk >> FILE_SHIFT << FILE_SHIFT)[0]) != counts.base:
                yield counts.rows()
            if len(at):
                counts.add(chunk, at, key, chunk.hashes(two)[chunk.numbers])
            if counts.size >= HELD_ENTRIES:
                yield counts.rows()
        if counts.size:
            yield counts.rows()

    def frequent(held: list[tuple[int, bytes]]) -> pd.DataFrame:
        entries = np.concatenate([unpacked(e) for _, e in held])
        bases = np.repeat([b for b, _ in held], [len(e) // ENTRY.itemsize for _, e in held])
        order = np.lexsort((entries["other"], entries["hash"]))
        entries, bases = entries[order], bases[order]
        new = (entries["hash"][1:] != entries["hash"][:-1]) | (entries["other"][1:] != entries["other"][:-1])
        first = np.flatnonzero(np.concatenate([[True], new]))
        first = first[np.add.reduceat(entries["n"].astype(np.uint64), first) >= min_count]
        return pd.DataFrame({
            "hash": entries["hash"][first].view(np.int64),
            "chunk": bases[first].astype(np.int64) + entries["chunk"][first].astype(np.int64),
        })

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, bytes]] = []
        now = None
        for batch in batches:
            for shard, base, entries in zip(batch["shard"], batch["base"], batch["entries"], strict=True):
                if shard != now and held:
                    yield frequent(held)
                    held = []
                now = shard
                held.append((base, entries))
        if held:
            yield frequent(held)

    rows = corpus.mapInPandas(count, "shard int, base long, entries binary")
    dealt = rows.repartition(shuffle_width(corpus.sparkSession), "shard").sortWithinPartitions("shard")
    return saved(dealt.mapInPandas(add, "hash long, chunk long"))


def bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the (unsigned) numbers `hash`, in words of 64: of one size at any input."""

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.zeros(FILTER_BITS // 64, np.uint64)
        for batch in batches:
            place = bit_place(batch["hash"].to_numpy(np.int64).view(np.uint64))
            np.bitwise_or.at(out, place >> 6, np.uint64(1) << (place & 63).astype(np.uint64))
        found = np.flatnonzero(out)
        yield pd.DataFrame({"word": found, "bits": out[found].view(np.int64)})

    words = hashes.select("hash").mapInPandas(bits, "word int, bits long")
    rows = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def candidates(corpus: DataFrame, longest: int, min_count: int) -> DataFrame:
    """(lang, phrase): phrases of up to `longest` words that no count rules out; written once."""
    words = corpus.agg(F.sum("n")).first()[0] or 0
    shards = min(1 << 20, 2 << (words // SHARD_WORDS).bit_length())
    passed: list[np.ndarray] = []
    named = None
    for _ in range(longest):
        found = frequent_hashes(corpus, passed, shards, min_count)
        passed.append(bitmap(found))
        named = found if named is None else named.unionByName(found)

    def paired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            key, chunk = (batch[c].to_numpy(np.int64).view(np.uint64) for c in ("hash", "chunk"))
            yield pd.DataFrame({"hash": in_chunk(key, chunk).view(np.int64)})

    wanted = bitmap(named.mapInPandas(paired, "hash long"))
    shared = corpus.sparkSession.sparkContext.broadcast((passed, wanted))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = Powers(BYTE_BASE)
        for chunk in chunks_of(batches):
            phrases = list(marked_phrases(chunk, *shared.value, powers))
            if phrases:
                yield pd.DataFrame({"lang": chunk.lang.decode(), "phrase": [p.decode() for p in phrases]})

    out = saved(corpus.mapInPandas(find, "lang string, phrase string").distinct())
    shared.unpersist()
    return out


def marked_phrases(chunk: Chunk, passed: list[np.ndarray], wanted: np.ndarray, powers: Powers) -> Iterator[bytes]:
    """The phrases that name this chunk, words joined by spaces."""
    own = chunk.hashes(powers)[chunk.numbers]
    for k, (at, key) in enumerate(levels(chunk, own, passed)):
        if k == len(passed):
            return
        at = at[marked(wanted, bit_place(in_chunk(key, chunk.chunk)))]
        numbers = chunk.numbers[at[:, None] + np.arange(k + 1)] - 1
        for phrase in np.unique(numbers, axis=0).tolist():
            yield b" ".join(map(chunk.words.__getitem__, phrase))


def place_children(parent: np.ndarray, code: np.ndarray, nodes: int, codes: int):
    """(base, slot) of every node so that slot[child] = base[parent] + code and no slot is shared.

    Edges are sorted by parent; the root is node 0. Nodes with many children choose first, from random
    bases; those with one child take what is left.
    """
    draw = np.random.default_rng(0)
    size = 4 * len(parent) + 2 * codes + 2
    used = np.zeros(size + 2 * codes + 2, bool)
    base, slot = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    used[codes] = True
    slot[0] = codes  # the root's own place; places below `codes` are never taken
    child = np.arange(1, nodes)
    starts = np.searchsorted(parent, np.arange(nodes + 1))
    count = np.diff(starts)
    for node in np.flatnonzero(count > 1)[np.argsort(-count[count > 1], kind="stable")]:
        own = slice(starts[node], starts[node + 1])
        while True:
            tries = draw.integers(1, size, 32)
            spots = tries[:, None] + code[own][None, :]
            free = ~used[spots].any(axis=1) & (spots[:, 0] > codes)
            if free.any():
                break
        k = int(np.argmax(free))
        base[node] = tries[k]
        used[spots[k]] = True
        slot[child[own]] = spots[k]
    single = np.flatnonzero(count == 1)
    edges = starts[single]
    spare = np.flatnonzero(~used[codes + 1 : size + codes])[: len(single)] + codes + 1
    base[single] = spare - code[edges]
    slot[child[edges]] = spare
    return base, slot


class Trie:
    """Phrases of languages as a double array; words and languages are numbered by place, from 1."""

    def __init__(self, langs: list[str], phrases: list[str]):
        order = sorted(range(len(phrases)), key=lambda i: (langs[i], phrases[i]))
        self.phrases = [(langs[i], phrases[i]) for i in order]
        split = [p.encode().split(b" ") for _, p in self.phrases]
        words = sorted({w for p in split for w in p})
        number = {w: n + 1 for n, w in enumerate(words)}
        self.langs = {lang: len(words) + 1 + n for n, lang in enumerate(sorted(set(langs)))}
        self.words = binary(words)
        depth = 1 + max(map(len, split))
        codes = np.zeros((len(split), depth), np.int64)
        for row, (lang, _), p in zip(codes, self.phrases, split, strict=True):
            row[0] = self.langs[lang]
            row[1 : len(p) + 1] = [number[w] for w in p]
        # Node of every prefix, one level after another.
        node = np.zeros(len(split), np.int64)
        parents, edge_codes, ends = [], [], np.zeros(len(split), np.int64)
        nodes, width = 1, len(words) + len(self.langs) + 1
        for column in codes.T:
            alive = column > 0
            pair, at = np.unique(node[alive] * width + column[alive], return_inverse=True)
            parents.append(pair // width)
            edge_codes.append(pair % width)
            node[alive] = nodes + at
            ends[alive] = node[alive]
            nodes += len(pair)
        parent, code = np.concatenate(parents), np.concatenate(edge_codes)
        base, slot = place_children(parent, code, nodes, width)
        size = int(base.max()) + width + 1
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.base[slot] = base
        self.check[slot[1:]] = slot[parent]
        self.root, self.accept, self.depth = int(slot[0]), slot[ends].astype(np.int32), depth

    def start(self, lang: str) -> int | None:
        """The state of a language."""
        code = self.langs.get(lang)
        return None if code is None else int(self.base[self.root]) + code

    def states(self, chunk: Chunk) -> Iterator[np.ndarray]:
        """The states that positions reach, level by level, all positions at once."""
        start = self.start(chunk.lang.decode())
        if start is None:
            return
        number = np.concatenate([[0], places(binary(chunk.words), self.words) + 1])
        words = np.concatenate([number[chunk.numbers], np.zeros(self.depth, np.int64)])
        at = np.flatnonzero(words)
        state = np.full(len(at), start, np.int64)
        for level in range(self.depth - 1):
            word = words[at + level]
            following = self.base[state] + word
            ok = (self.check[following] == state) & (word > 0)
            at, state = at[ok], following[ok]
            if not len(at):
                return
            yield state


def trie_shards(phrases: DataFrame, trie_phrases: int) -> tuple[DataFrame, int]:
    """The phrases dealt into shards, as rows (shard, lang, phrase), and the number of shards."""
    shards = max(1, -(-phrases.count() // trie_phrases))
    shard = F.pmod(F.xxhash64("lang", "phrase"), F.lit(shards)).cast("int")
    return phrases.withColumn("shard", shard), shards


def phrase_counts(corpus: DataFrame, phrases: DataFrame, trie_phrases: int = TRIE_PHRASES) -> DataFrame:
    """(lang, phrase, f): how often each phrase occurs; written once."""
    dealt, shards = trie_shards(phrases, trie_phrases)
    spark, out = corpus.sparkSession, None
    for k in range(shards):
        rows = dealt.filter(F.col("shard") == k).select("lang", "phrase").toArrow()
        if not rows.num_rows:
            continue
        shared = spark.sparkContext.broadcast(Trie(rows["lang"].to_pylist(), rows["phrase"].to_pylist()))
        part = saved(counted(corpus, shared))
        shared.unpersist()
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "lang string, phrase string, f long")
    return out


def counted(corpus: DataFrame, shared) -> DataFrame:
    """(lang, phrase, f) of the phrases of one broadcast trie."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie: Trie = shared.value
        total = np.zeros(len(trie.base), np.int64)
        held, size = [], 0
        for chunk in chunks_of(batches):
            for state in trie.states(chunk):
                held.append(state)
                size += len(state)
            if size > len(total):
                total += np.bincount(np.concatenate(held), minlength=len(total))
                held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total))
        f = total[trie.accept]
        for shard, at in enumerate(range(0, len(f), SHARD_PHRASES)):
            counts = f[at : at + SHARD_PHRASES]
            if counts.any():
                yield pd.DataFrame({"shard": [shard], "counts": [counts.tobytes()]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        phrases = shared.value.phrases
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, counts in zip(batch["shard"], batch["counts"], strict=True):
                part = np.frombuffer(counts, np.int64)
                sums[shard] = sums[shard] + part if shard in sums else part
        for shard, f in sums.items():
            found = np.flatnonzero(f)
            named = [phrases[shard * SHARD_PHRASES + i] for i in found]
            yield pd.DataFrame(
                {"lang": [x[0] for x in named], "phrase": [x[1] for x in named], "f": f[found]}
            )

    shards = corpus.mapInPandas(count, "shard int, counts binary").repartition(
        shuffle_width(corpus.sparkSession), "shard"
    )
    return shards.mapInPandas(add, "lang string, phrase string, f long")


def part(words: str, first: Column | int, count: Column | int) -> Column:
    """Some of the words, joined."""
    return F.array_join(F.slice(words, F.lit(first) if isinstance(first, int) else first, count), " ")


def exact_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (l * r)); products have up to 38 digits."""
    wide = "decimal(19, 0)"
    above = (F.lit(1000) * a).cast(wide) * n.cast(wide)
    below = left.cast(wide) * right.cast(wide)
    return F.call_function("div", above, below)


def scored(counts: DataFrame, totals: DataFrame, min_count: int) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of all candidates by their lowest-scoring cut."""
    frequent = counts.filter(F.col("f") >= min_count)
    words = F.split("phrase", " ")
    named = frequent.select("lang", "phrase", words.alias("words"), F.col("f").alias("a")).filter(
        F.size("words") > 1
    )
    cuts = named.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select(
        "*", part("words", 1, F.col("k")).alias("first"),
        part("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("rest"),
    )
    first = frequent.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = frequent.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    joined = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(totals, "lang")
    score = exact_score(F.col("a"), F.col("n"), F.col("l"), F.col("r"))
    lowest = joined.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "n", "words")).alias("cut")
    )
    return lowest.select("lang", "phrase", "cut.words", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def unabsorbed(rows: DataFrame, percent: int = ABSORBED_PERCENT) -> DataFrame:
    """Rows without the phrases that lie inside a longer one of at least `percent` of their count."""
    longer = rows.filter(F.size("words") > 2).select("lang", F.size("words").alias("size"), "words", "a")
    lengths = longer.select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length"))
    starts = lengths.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("at"))
    inside = starts.select("lang", part("words", F.col("at"), F.col("length")).alias("phrase"), "a")
    most = inside.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = rows.join(most, ["lang", "phrase"], "left")
    absorbed = F.coalesce(100 * F.col("most") >= percent * F.col("a"), F.lit(False))
    return kept.filter(~absorbed).drop("most")


def mine(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    top: int = TOP,
    trie_phrases: int = TRIE_PHRASES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first phrases."""
    corpus = chunks(docs)
    counts = phrase_counts(corpus, candidates(corpus, longest, min_count), trie_phrases)
    totals = corpus.groupBy("lang").agg(F.sum("n").alias("n"))
    rows = unabsorbed(saved(scored(counts, totals, min_count)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
