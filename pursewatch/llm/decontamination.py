"""Documents that hold benchmark items: fingerprints of windows find them, shingles confirm them."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from pursewatch.llm import words
from pursewatch.llm.common import stored

#: Fingerprints that differ in so many of 64 bits are candidates. Four blocks of 16 bits: with
#: seven differences some block has one at most, so looking up each block and its 16 neighbours
#: finds every fingerprint within the radius.
RADIUS = 7
BLOCKS = 4
#: Item-sized windows that start so many words before or behind a candidate are compared too.
SHIFT = 2
#: Items from so many words on are looked for by windows of half their words.
LONG = 64
#: Bytes of benchmark text that are indexed and sent to the tasks at a time.
ITEM_BYTES = 4 << 20
#: Words of a document whose bit sums are held at a time.
SEGMENT = 1 << 16
#: Fingerprints that are taken at a time, so that their bit counts stay in a core's cache.
STRIP = 1 << 11
#: Words in a run that bit sums are taken over first.
RUN = 128

LEAKS = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("similarity", T.DoubleType()),
            T.StructField("start", T.LongType()),
        ]
    )
)

#: Letters beyond ASCII that stay single letters in lower case, and their lower cases.
LETTERS = "À-ÖØ-öø-ÿ"

_NOT_IN_WORDS = re.compile(r"[\W_]+")


def normal(word: str) -> str:
    """Lower case, letters and digits only."""
    return _NOT_IN_WORDS.sub("", word.lower())


def _normalised(known: pa.Array) -> pa.Array:
    """``normal`` of each word. Those of plain letters, digits and punctuation all at once: letters
    that are one letter in lower case too, so that Arrow and Python agree on them."""
    plain = pc.match_substring_regex(known, f"^[!-~{LETTERS}]*$")
    lower = pc.replace_substring_regex(pc.utf8_lower(known), f"[^a-z0-9{LETTERS}]+", "")
    odd = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
    if not len(odd):
        return lower
    each = pa.array([normal(w) for w in known.take(pa.array(odd)).to_pylist()], known.type)
    return pc.replace_with_mask(lower, pc.invert(plain), each)


def normal_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and lengths of the normalised words of all texts, and where each text starts."""
    found, starts = words.split(texts)
    coded = found.dictionary_encode()
    code = coded.indices.to_numpy()
    if not len(code):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros_like(starts)
    # words that are the same but for case and punctuation are hashed once
    known = _normalised(coded.dictionary).dictionary_encode()
    code = known.indices.to_numpy()[code]
    length = pc.utf8_length(known.dictionary).to_numpy().astype(np.int64)
    hashed = np.fromiter((words.xxhash.xxh64_intdigest(w) for w in known.dictionary.to_pylist()), np.uint64, len(length))
    full = length[code] > 0
    kept = np.concatenate([[0], np.cumsum(full)])
    code = code[full]
    return hashed[code], length[code], kept[starts]


def _bit_sums(word: np.ndarray, widest: int) -> np.ndarray:
    """For each place how many of the words before it have each of the 64 bits.

    Sums wrap around; differences over up to ``widest`` words are right all the same.
    """
    bits = np.unpackbits(word.view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((len(word) + 1, 64), np.uint16 if widest < 1 << 16 else np.uint64)
    sums[1:] = bits
    # runs of RUN words side by side, then what lies before each run, then the words left over
    whole = len(word) // RUN * RUN
    runs = sums[1 : whole + 1].reshape(-1, RUN, 64)
    for k in range(1, RUN):
        runs[:, k] += runs[:, k - 1]
    runs[1:] += np.cumsum(runs[:-1, -1], axis=0, dtype=sums.dtype)[:, None]
    for k in range(whole, len(word)):
        sums[k + 1] += sums[k]
    return sums


def _fingerprints(sums: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the ``size`` words at every place: the bits that most of them have."""
    count = max(len(sums) - size, 0)
    out = np.empty(count, np.uint64)
    for a in range(0, count, STRIP):
        b = min(a + STRIP, count)
        most = sums[a + size : b + size] - sums[a:b] > size // 2
        out[a:b] = np.packbits(most, axis=1).view(np.uint64).ravel()
    return out


def _shingles(word: np.ndarray, length: np.ndarray, size: int) -> Counter:
    """Weight of each shingle: its letters, as often as it occurs. Fewer words are one shingle."""
    size = min(size, len(word))
    weight = np.convolve(length, np.ones(size, np.int64), "valid") if size else length
    found: Counter = Counter()
    for s, w in zip(words.runs(word, size).tolist() if size else [], weight.tolist(), strict=True):
        found[s] += w
    return found


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: shared weight over the weight of the union."""
    shared = sum(min(w, b[s]) for s, w in a.items() if s in b)
    union = sum(a.values()) + sum(b.values()) - shared
    return shared / union if union else 0.0


@dataclass
class _Class:
    """Items of about one length, by the windows of one size in them."""

    size: int
    fingerprint: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    keys: list[np.ndarray]  # for each block: where the entries of each 16-bit value start
    entries: list[np.ndarray]
    held: list[np.ndarray]  # for each block: which 16-bit values have entries


class ItemIndex:
    """Fingerprints of the windows of benchmark items.

    Lengths are taken in classes. A class whose shortest item has L words uses windows of three
    quarters of L, or of half of L from ``LONG`` words on, where half is still enough words to tell
    texts apart. Documents and items are both read at every word. One changed run that leaves an
    item ``least`` alike leaves more than half of a long item whole on one side of it, so that such
    a copy has a window at distance 0.
    """

    def __init__(self, ids: Sequence[int], texts: Sequence[str], shingle: int, radius: int):
        self.ids, self.radius, self.shingle = list(ids), radius, shingle
        word, length, starts = normal_words(pa.array(list(texts), pa.string()))
        self.words = [word[a:b] for a, b in zip(starts, starts[1:], strict=False)]
        self.sizes = np.diff(starts)
        self.shingles = [
            _shingles(word[a:b], length[a:b], shingle) for a, b in zip(starts, starts[1:], strict=False)
        ]
        self.totals = [sum(s.values()) for s in self.shingles]
        self.known = [np.sort(np.fromiter(s, np.uint64, len(s))) for s in self.shingles]
        self.classes = []
        left = sorted(int(n) for n in set(self.sizes.tolist()) if n)
        while left:
            low = left[0]
            self.classes.append(self._build(low, math.ceil(1.4 * low)))
            left = [n for n in left if n >= math.ceil(1.4 * low) and n > low]

    def _build(self, low: int, high: int) -> _Class:
        size = low // 2 if low >= LONG else low - low // 4
        prints, item, offset = [], [], []
        for k in np.flatnonzero((self.sizes >= low) & (self.sizes < max(high, low + 1))):
            own = _fingerprints(_bit_sums(self.words[k], size), size)
            prints.append(own)
            item.append(np.full(len(own), k))
            offset.append(np.arange(len(own)))
        fingerprint = np.concatenate(prints)
        near = np.array([0, *(1 << b for b in range(16))] if self.radius >= BLOCKS else [0], np.int64)
        if self.radius >= 2 * BLOCKS:
            raise ValueError(f"a radius below {2 * BLOCKS} is covered")
        keys, entries, held = [], [], []
        for b in range(BLOCKS):
            value = ((fingerprint >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            value = (value[:, None] ^ near).ravel()
            order = np.argsort(value, kind="stable")
            keys.append(np.searchsorted(value[order], np.arange(65537)).astype(np.int64))
            entries.append((order // len(near)).astype(np.int64))
            held.append(np.diff(keys[-1]) > 0)
        return _Class(size, fingerprint, np.concatenate(item), np.concatenate(offset), keys, entries, held)

    def _candidates(self, c: _Class, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a window and an entry within the radius."""
        windows, found = [], []
        blocks = prints.view(np.uint16).reshape(-1, BLOCKS)
        for b in range(BLOCKS):
            value = blocks[:, b]
            held = np.flatnonzero(c.held[b][value])
            value = value[held].astype(np.int64)
            begin = c.keys[b][value]
            count = c.keys[b][value + 1] - begin
            window = np.repeat(held, count)
            entry = c.entries[b][np.arange(len(window)) + np.repeat(begin - np.cumsum(count) + count, count)]
            near = np.bitwise_count(prints[window] ^ c.fingerprint[entry]) <= self.radius
            windows.append(window[near])
            found.append(entry[near])
        return np.concatenate(windows), np.concatenate(found)

    def _hopeful(
        self, k: int, begins: list[int], ends: list[int], run: np.ndarray, before: np.ndarray, least: float
    ) -> Iterator[tuple[int, int]]:
        """Of windows beside each other those that can be ``least`` alike item ``k``: what they share
        is no more than the weight of their shingles that the item has at all."""
        n, known = self.shingle, self.known[k]
        if self.sizes[k] < n or min(e - b for b, e in zip(begins, ends, strict=True)) < n:
            yield from zip(begins, ends, strict=True)
            return
        low = begins[0]
        own = run[low : max(ends) - n + 1]
        weight = before[low + n : low + n + len(own)] - before[low : low + len(own)]
        held = known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own
        every, shared = (np.concatenate([[0], np.cumsum(w)]) for w in (weight, weight * held))
        for begin, end in zip(begins, ends, strict=True):
            a, b = begin - low, end - n + 1 - low
            most, total = int(shared[b] - shared[a]), int(every[b] - every[a])
            if most >= least * (self.totals[k] + total - most):
                yield begin, end

    def leaks(self, texts: pa.Array, least: float) -> list[list[dict]]:
        """For each text the items in it with their best similarity and the word it starts at."""
        word, length, starts = normal_words(texts)
        doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        best: list[dict[int, tuple[float, int]]] = [{} for _ in range(len(starts) - 1)]
        widest = max((c.size for c in self.classes), default=0)
        run, before = words.runs(word, self.shingle), np.concatenate([[0], np.cumsum(length)])
        seen = set()
        for a in range(0, len(word), SEGMENT):
            piece = word[a : a + SEGMENT + widest]
            sums = _bit_sums(np.ascontiguousarray(piece), widest)
            places = np.arange(a, min(a + SEGMENT, len(word)))
            until = starts[doc[places] + 1]
            for c in self.classes:
                prints = _fingerprints(sums, c.size)[: len(places)]
                inside = np.flatnonzero(places[: len(prints)] + c.size <= until[: len(prints)])
                at = places[inside]
                window, entry = self._candidates(c, prints[inside])
                # a copy is met by many of its windows, at one place
                met = np.unique(np.stack([at[window] - c.offset[entry], c.item[entry], doc[at[window]]], axis=1), axis=0)
                for place, k, d in met.tolist():
                    low, high = int(starts[d]), int(starts[d + 1])
                    near = {min(max(p, low), high - 1) for p in range(place - SHIFT, place + SHIFT + 1)}
                    near = sorted(p for p in near if (p, k) not in seen)
                    if not near:
                        continue
                    seen.update((p, k) for p in near)
                    ends = [min(p + int(self.sizes[k]), high) for p in near]
                    for begin, end in self._hopeful(k, near, ends, run, before, least):
                        held = _shingles(word[begin:end], length[begin:end], self.shingle)
                        s = similarity(self.shingles[k], held)
                        if s >= least and (-s, begin) < best[d].get(k, (1.0, 0)):
                            best[d][k] = (-s, begin)
        return [
            sorted(
                (
                    {"item_id": self.ids[k], "similarity": -s, "start": begin - int(starts[d])}
                    for k, (s, begin) in found.items()
                ),
                key=lambda leak: (leak["item_id"], leak["start"]),
            )
            for d, found in enumerate(best)
        ]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    shingle: int = 5,
    least: float = 0.8,
    radius: int = RADIUS,
    item_bytes: int = ITEM_BYTES,
    out: str = "leaks",
) -> DataFrame:
    """The rows with a column ``out``: the benchmark items each text holds.

    An item is held if a window as long as the item has weighted similarity ``least`` or more to
    it: Jaccard over shingles of ``shingle`` words, weighted by their letters. Words are lower
    case, letters and digits only. Windows are found by SimHash: all windows, one at every word, within
    ``radius`` bits of an item's window are candidates (multi-index); each candidate's whole
    item-sized window is compared, and those a word or two beside it, and the best is told. A verbatim copy always has a window at distance 0; a copy with
    changes is found if one of its windows has few of them.

    The benchmark is a stated set of queries. It is indexed in blocks of about ``item_bytes`` of
    text; each block is one pass over the rows, without a shuffle. Between two blocks the rows are
    stored, so only one block's index is held by the tasks at a time. Items without words match nothing, repeated items are found
    each, null texts hold nothing, null item ids are carried as null. A column named as ``out`` is
    replaced; other columns are kept as they are.
    """
    items = benchmark.select(
        F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")
    ).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n_blocks = max(1, -(-total // item_bytes))
    rows = docs.drop(out).withColumn(out, F.array().cast(LEAKS))
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in rows.schema if f.name != out]
    ).add(out, LEAKS)
    for k in range(n_blocks):
        own = F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == k
        found = sorted((r.item_id is None, r.item_id or 0, r.text) for r in items.where(own).collect())
        if not found:
            continue
        index = ItemIndex([None if no else i for no, i, _ in found], [t for *_, t in found], shingle, radius)
        sent = docs.sparkSession.sparkContext.broadcast(index)
        rows = rows.mapInArrow(_searcher(sent, text_col, least, out), schema)
        if k < n_blocks - 1:
            rows = stored(rows, "searched")
            sent.unpersist()
    return rows


def _searcher(sent, text_col: str, least: float, out: str):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(out)
            for part in words.slices(batch, text_col):
                found = sent.value.leaks(part.column(text_col), least)
                old = part.column(out).to_pylist()
                both = pa.array(
                    [o + n for o, n in zip(old, found, strict=True)], batch.schema.field(out).type
                )
                yield part.set_column(place, batch.schema.field(out), both)

    return search
