"""Words of many texts at once, as arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Texts are worked on in slices of about so many bytes, which bounds a task's memory.
SLICE_BYTES = 4 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all of them."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch | pa.Table, text: str, most: int = SLICE_BYTES) -> Iterator:
    """The rows in runs of about ``most`` bytes of text; a longer text is a run of its own.

    Runs are copies that start at offset 0: some Arrow functions, lower-casing among them, misread
    the strings of a slice.
    """
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(size.astype(np.int64)) // most
    starts = np.flatnonzero(np.diff(run, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(size)], strict=True):
        yield batch.take(pa.array(np.arange(a, b)))


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words, one after another, and where each text's words start (one more at the end).

    Words are what ASCII white space separates; a null text has none.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(texts)
    at = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values[at[0] : at[-1]] if len(lists) else lists.values
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    kept = np.concatenate([[0], np.cumsum(full)])
    return words.filter(pa.array(full)), kept[at - at[0]]


def hashes(words: pa.Array, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word, or of the word with A-Z in lower case."""
    coded = words.dictionary_encode()
    each = pc.ascii_lower(coded.dictionary) if lower else coded.dictionary
    known = np.fromiter((xxhash.xxh64_intdigest(w) for w in each.to_pylist()), np.uint64, len(each))
    return known[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)


def runs(word: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive words, across the borders of texts."""
    if len(word) < n:
        return np.zeros(0, np.uint64)
    last = len(word) - n + 1
    h = word[:last].copy()
    for k in range(1, n):
        h = h * _MULTIPLIER + word[k : last + k]
    return mix(h)


def run_starts(starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of n words within one text begin, and the number of each text."""
    count = np.maximum(np.diff(starts) - n + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    return np.arange(count.sum()) - first[text] + starts[:-1][text], text
