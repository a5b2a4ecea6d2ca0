"""BPE encoding by a walk over a trie of distinct words, and decoding.

A text is cut into words as the tokenizer file says. The distinct words of a batch, in sorted order,
are the leaves of a trie in depth-first order. At every prefix the walk keeps one state, the last
token of the prefix's encoding. The next state is the one token that ends at the new symbol, is an
encoding of itself, and stays apart from the last token of what precedes it. Prefixes shared by words
are encoded once; a word's tokens are read back along the states. Words met before are kept in a
cache of bounded size.

Defined cases: null text is empty and has no tokens; the strings of added tokens are those tokens
wherever they occur; text of any length is encoded whole; repeated rows are encoded each; no rows
give no rows. Other columns stay.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

END = "</w>"
MAX_CACHED = 500_000
MAX_PAIRS = 1_000_000
CHUNK = 400

# The pattern of words, for characters below U+0250.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBERS = "0-9²³¹¼½¾"
_SPACES = "\t\n\x0b\x0c\r \x85\xa0"
PLAIN_WORD = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
)
NOT_PLAIN = re.compile("[^\x00-ɏ]")


def byte_symbols() -> list[str]:
    """The printable character that stands for every byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(spare)
            spare += 1
    return [symbols[b] for b in range(256)]


class TrieEncoder:
    """Encoder and decoder of one tokenizer file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.ids: dict[str, int] = file["model"]["vocab"]
        self.pairs = [tuple(pair) for pair in file["model"]["merges"]]
        self.rank = {pair: i for i, pair in enumerate(self.pairs)}
        #: The lowest merge that makes a token.
        self.made: dict[str, int] = {}
        for i, (a, b) in enumerate(self.pairs):
            self.made.setdefault(a + b, i)
        self.whole: dict[str, bool] = {}
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.added.items()]}
        self.file = Tokenizer.from_file(path)
        self.bytes = str.maketrans({s: chr(b) for b, s in enumerate(byte_symbols())})
        self.symbols = str.maketrans({chr(b): s for b, s in enumerate(byte_symbols())})
        self.special = re.compile("(" + "|".join(map(re.escape, self.added)) + ")")
        self.cache: dict[str, tuple[int, ...]] = {}
        self.apart: dict[tuple[str, str], bool] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """Merge the leftmost pair of the lowest rank until no pair is left."""
        while len(symbols) > 1:
            ranks = [
                self.rank.get(pair, len(self.rank)) for pair in zip(symbols, symbols[1:], strict=False)
            ]
            lowest = min(ranks)
            if lowest == len(self.rank):
                break
            i = ranks.index(lowest)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def split(self, token: str) -> list[str]:
        if token.endswith(END) and token != END:
            token = token.removesuffix(END)
            return [*token[:-1], token[-1] + END]
        return list(token)

    def is_token(self, text: str) -> bool:
        """Whether the text is a token that encodes itself."""
        if text not in self.ids:
            return False
        known = self.whole[text] = self.merged(self.split(text)) == [text]
        return known

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether two tokens, side by side, are the encoding of their text.

        Undoes merges, the latest first: the symbols at the boundary merge if they could do so
        before one of them merged into its own token. Of equal ranks the left merge comes first.
        """
        a, b, limit, apart = left, right, len(self.rank), True
        while True:
            if self.rank.get((a, b), len(self.rank)) < limit:
                apart = False
                break
            of_a, of_b = self.made.get(a, -1), self.made.get(b, -1)
            if of_a < 0 and of_b < 0:
                break
            if of_a > of_b:
                a, limit = self.pairs[of_a][1], of_a
            else:
                b, limit = self.pairs[of_b][0], of_b + 1
        if len(self.apart) >= MAX_PAIRS:
            self.apart.clear()
        self.apart[left, right] = apart
        return apart

    def last_token(self, word: str, end: int, suffix: str, last: list[str]) -> str:
        """The last token of the encoding of word[:end]; `last` has those of all shorter prefixes."""
        whole, apart = self.whole, self.apart
        for start in range(end - 1, -1, -1):
            token = word[start:end] + suffix
            known = whole.get(token)
            if known or (known is None and self.is_token(token)):
                if not start:
                    return token
                known = apart.get((last[start], token))
                if known or (known is None and self.stay_apart(last[start], token)):
                    return token
        raise ValueError(f"no token ends {word[:end]!r}")

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
        """(word, ids) of distinct words in symbols, in the depth-first order of their trie."""
        before, last = "", [""]
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del last[min(shared, len(word) - 1) + 1 :]
            for end in range(len(last), len(word)):
                last.append(self.last_token(word, end, "", last))
            tokens = [self.last_token(word, len(word), END, last)]
            at = len(word) - len(tokens[0].removesuffix(END))
            while at:
                tokens.append(last[at])
                at -= len(last[at])
            before = word
            yield word, tuple(self.ids[t] for t in reversed(tokens))

    def words(self, text: str) -> list[str]:
        """Normalised words. Text with other characters is cut by the library's own Unicode tables."""
        # Some capitals below U+0250 have their lower form above it, so the lowered text decides.
        lowered = text.lower()
        if NOT_PLAIN.search(lowered):
            cut = self.file.pre_tokenizer.pre_tokenize_str(self.file.normalizer.normalize_str(text))
            return [w.translate(self.bytes).encode("latin-1").decode() for w, _ in cut]
        return PLAIN_WORD.findall(lowered)

    def learn(self, words: set[str]) -> None:
        """Put the encodings of new words into the cache."""
        new = words - self.cache.keys()
        if len(self.cache) + len(new) > MAX_CACHED:
            self.cache.clear()
            new = words
        written = {w.encode().decode("latin-1").translate(self.symbols): w for w in new}
        for symbols, ids in self.walk(written):
            self.cache[written[symbols]] = ids

    def encode_all(self, texts: list[str | None]) -> Iterator[list[int]]:
        """Ids of every text; the distinct words of all the texts share one trie."""
        pieces = [self.special.split(t or "") for t in texts]
        split = [
            [p if k % 2 else self.words(p) for k, p in enumerate(parts)] for parts in pieces
        ]
        self.learn(set().union(*(words for parts in split for words in parts[::2])))
        known = self.cache.__getitem__
        for parts in split:
            ids: list[int] = []
            for k, part in enumerate(parts):
                if k % 2:
                    ids.append(self.added[part])
                else:
                    ids.extend(chain.from_iterable(map(known, part)))
            yield ids

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens' strings, as the file names no decoder: joined by one space."""
        return " ".join(map(self.tokens.__getitem__, ids))


def _chunks(series: pd.Series) -> Iterator[list]:
    for at in range(0, len(series), CHUNK):
        yield series.iloc[at : at + CHUNK].tolist()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """All columns of `docs`, and their texts' ids as `ids`."""

    @F.pandas_udf("array<int>")
    def to_ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = TrieEncoder(path)
        for batch in texts:
            yield pd.Series([ids for part in _chunks(batch) for ids in encoder.encode_all(part)])

    return docs.withColumn("ids", to_ids("text"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns of `encoded`, and the text of their `ids` as `decoded`."""

    @F.pandas_udf("string")
    def to_text(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = TrieEncoder(path)
        for batch in ids:
            yield pd.Series([None if x is None else encoder.decode(x) for x in batch])

    return encoded.withColumn("decoded", to_text("ids"))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them, in one pass."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = TrieEncoder(path)
        decimal = {i: str(i) for i in encoder.tokens}.__getitem__
        for batch in texts:
            rows = []
            for part in _chunks(batch):
                for ids in encoder.encode_all(part):
                    said = " ".join(map(decimal, ids)).encode()
                    read = encoder.decode(ids).encode()
                    rows.append(
                        (len(ids), hashlib.sha256(said).hexdigest(), hashlib.sha256(read).hexdigest())
                    )
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", digest("text").alias("d")).select("doc_id", "d.*")
