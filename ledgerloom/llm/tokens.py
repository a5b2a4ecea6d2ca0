"""Words of many texts at once: cut by a table of bytes, and numbered by their exact spelling.

Texts are UTF-8 bytes. Words are maximal runs of bytes of a given kind, so every byte above 127 must
be of one kind. Spellings are compared as bytes, by Arrow's dictionaries, never by a hash alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

#: What lower-casing A-Z makes of every byte.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def lower_bytes(texts: Iterable[bytes], separator: bytes) -> np.ndarray:
    """All texts in one row of bytes, A-Z lower-cased, with a separator after each."""
    return LOWER[np.frombuffer(separator.join([*texts, b""]), np.uint8)]


def runs(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every maximal run of bytes marked in the table `inside`."""
    marked = np.zeros(len(data) + 2, bool)
    marked[1:-1] = inside[data]
    change = np.flatnonzero(marked[1:] != marked[:-1])
    return change[::2], change[1::2]


def numbered(data: np.ndarray, inside: np.ndarray, firsts: np.ndarray, ends: np.ndarray):
    """(spellings, number): the distinct words in order of appearance, and each word's place there."""
    offsets = np.concatenate([[0], np.cumsum(ends - firsts)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(firsts),
        [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside[data]]))],
    )
    found = words.dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False)


def places(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Place of every word in `known`, or -1."""
    at = pc.index_in(words, value_set=known)
    return pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def binary(words: Iterable[bytes]) -> pa.Array:
    return pa.array(list(words), pa.large_binary())


def parts(texts: Iterable[str | None], size: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """The texts as bytes, null as empty, in parts of about `size` bytes; with each part's first row."""
    held: list[bytes] = []
    total = first = 0
    for text in texts:
        held.append((text or "").encode("utf-8", "surrogatepass"))
        total += len(held[-1]) + 1
        if total >= size:
            yield first, held
            first += len(held)
            held, total = [], 0
    if held:
        yield first, held
