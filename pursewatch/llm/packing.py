"""Packing of tokenised documents into sequences, best fit planned on how many pieces have each length."""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Mapping
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from pursewatch.llm import words
from pursewatch.llm.common import stored

#: Tokens in a sequence at most, and the token that ends each document.
LENGTH = 4096
END = 1
#: Bytes of text that a task tokenises at a time: the more, the fewer words come twice.
SLICE_BYTES = 16 << 20
#: Words that are tokenised in one call.
RUN = 1_000
#: Letters that stay single letters in lower case and in any normal form, and the
#: punctuation that is split off behind them.
LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
TAILS = ".,;:!?"

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, ids binary, task int, nth long"


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, … of runs of some sizes, one run after another."""
    until = np.cumsum(size)
    return np.arange(until[-1] if len(until) else 0) - np.repeat(until - size - begin, size)


class WordTokens:
    """Tokens of texts by their words, for tokenizers that split at white space and drop it.

    Each distinct word of the texts given together is tokenised once; a text of any length costs no
    more than its words. Where the tokenizer marks the end of a word, words of plain letters are
    told apart by that mark and tokenised as running text, and a mark of punctuation behind such a
    word is taken by itself; all other words are tokenised one by one.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        known = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(known.values()) + 1, bool)
        if suffix:
            self.ends[[i for t, i in known.items() if t.endswith(suffix)]] = True
        self.tails = {c: self._ids("ab" + c)[len(self._ids("ab")) :] for c in TAILS}
        self.lowers = self._ids("ÄB") == self._ids("äb")
        self.marks = bool(suffix) and all(self._ids("Äb" + c) == self._ids("Äb") + self._ids(c) for c in TAILS)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _one_by_one(self, known: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and how many each word has."""
        runs = [known[a : a + RUN] for a in range(0, len(known), RUN)]
        ids, size = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for run, got in zip(runs, self.tokenizer.encode_batch(runs, is_pretokenized=True, add_special_tokens=False), strict=True):
            ids.append(np.array(got.ids, np.uint32))
            size.append(np.bincount(np.array(got.word_ids, np.int64), minlength=len(run)))
        return np.concatenate(ids), np.concatenate(size)

    def _plain(self, known: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words that end with their only mark of an end."""
        runs = [known[a : a + RUN] for a in range(0, len(known), RUN)]
        ids, size = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        texts = [" ".join(run) for run in runs]
        for run, got in zip(runs, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            own = np.array(got.ids, np.uint32)
            last = np.flatnonzero(self.ends[own])
            if len(last) == len(run):
                ids.append(own)
                size.append(np.diff(last, prepend=-1))
            else:
                one, n = self._one_by_one(run)
                ids.append(one)
                size.append(n)
        return np.concatenate(ids), np.concatenate(size)

    def _each(self, known: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.marks or not len(known):
            return self._one_by_one(known.to_pylist())
        parts = pc.extract_regex(known, f"^(?P<core>{LETTERS})(?P<tail>[{TAILS}]?)$")
        whole = parts.is_null()
        core = pc.if_else(whole, known, pc.utf8_lower(parts.field("core")) if self.lowers else parts.field("core"))
        core = core.dictionary_encode()
        plain = np.zeros(len(core.dictionary), bool)
        plain[core.indices.to_numpy()[~whole.to_numpy(zero_copy_only=False)]] = True
        flat, size, begin = [], np.zeros(len(plain), np.int64), np.zeros(len(plain), np.int64)
        before = 0
        for mask, told in ((plain, self._plain), (~plain, self._one_by_one)):
            ids, n = told(core.dictionary.filter(pa.array(mask)).to_pylist())
            flat.append(ids)
            size[mask], begin[mask] = n, before + np.cumsum(n) - n
            before += len(ids)
        # the ids of punctuation lie behind all others
        ends = [np.array(self.tails[c], np.uint32) for c in TAILS]
        flat += ends
        behind = before + np.cumsum([0, *map(len, ends)])
        tail = pc.index_in(parts.field("tail"), value_set=pa.array(list(TAILS), known.type))
        tail = tail.fill_null(len(TAILS)).to_numpy()
        code = core.indices.to_numpy()
        runs = np.empty((len(code), 2), np.int64)
        runs[:, 0], runs[:, 1] = begin[code], np.append(behind[:-1], 0)[tail]
        sizes = np.empty_like(runs)
        sizes[:, 0], sizes[:, 1] = size[code], np.append([len(e) for e in ends], 0)[tail]
        return np.concatenate(flat)[_ragged(runs.ravel(), sizes.ravel())], sizes.sum(axis=1)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's ids start (one more at the end)."""
        found, starts = words.split(texts)
        coded = found.dictionary_encode()
        flat, size = self._each(coded.dictionary)
        if not len(found):
            return flat, np.zeros_like(starts)
        code = coded.indices.to_numpy()
        count = size[code]
        until = np.concatenate([[0], np.cumsum(count)])
        return flat[_ragged((np.cumsum(size) - size)[code], count)], until[starts]


def _cutter(path: str, length: int, end: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(length + 1, np.int64)
        for batch in batches:
            for part in words.slices(batch, "text", SLICE_BYTES):
                ids, starts = tokens(part.column("text"))
                rows: dict[str, list] = {c: [] for c in ("row", "piece", "start", "length", "crc", "ids", "nth")}
                for row, (a, b) in enumerate(zip(starts, starts[1:], strict=False)):
                    own = np.append(ids[a:b], np.uint32(end)).astype("<u4")
                    for piece, at in enumerate(range(0, len(own), length)):
                        data = own[at : at + length]
                        raw = data.tobytes()
                        rows["row"].append(row)
                        rows["piece"].append(piece)
                        rows["start"].append(at)
                        rows["length"].append(len(data))
                        rows["crc"].append(zlib.crc32(raw))
                        rows["ids"].append(raw if with_ids else None)
                        rows["nth"].append(seen[len(data)])
                        seen[len(data)] += 1
                n = len(rows["row"])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(rows["row"], pa.int64())),
                        pa.array(rows["piece"], pa.int32()),
                        pa.array(rows["start"], pa.int64()),
                        pa.array(rows["length"], pa.int32()),
                        pa.array(rows["crc"], pa.int64()),
                        pa.array(rows["ids"], pa.binary()),
                        pa.array([task] * n, pa.int32()),
                        pa.array(rows["nth"], pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "task", "nth"],
                )

    return cut


def tokenised(
    docs: DataFrame, path: str, length: int = LENGTH, end: int = END, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """Every document's ids and ``end``, cut into pieces of ``length``; a null text is empty.

    ``ids`` holds little-endian unsigned 32-bit numbers, or null. ``nth`` counts the pieces of one
    length in the ``task`` that cut them, in the order of its rows; the rows are stored, so the
    numbers stay what they are.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(_cutter(path, length, end, with_ids), PIECES), "pieces")


def plan(counts: Mapping[int, int], length: int = LENGTH) -> tuple[np.ndarray, int]:
    """Best fit decreasing of pieces known by length alone, and the number of sequences.

    Lengths are taken from the longest down; each piece goes to the fullest open sequence that it
    fits, which goes on until no piece of the length fits it, or to a new one. Sequences of one
    filling are kept as ranges of numbers, so a step deals any number of pieces: work and rows
    grow with the number of lengths and fillings, not of documents.

    Rows are length, from, until, sequence, offset, each: the pieces of a length ranked ``from`` to
    ``until`` (exclusive) lie ``each`` to a sequence, one after another from ``offset`` on, in
    the sequences from ``sequence`` on.
    """
    open_: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms: list[int] = []
    rows, n_sequences = [], 0

    def put_back(room: int, first: int, count: int) -> None:
        if not room or not count:
            return
        if room not in open_:
            rooms.insert(bisect_left(rooms, room), room)
        open_[room].append((first, count))

    for size in sorted((s for s, c in counts.items() if c), reverse=True):
        if not 0 < size <= length:
            raise ValueError(f"a piece has 1 to {length} tokens")
        left, rank = counts[size], 0
        while left:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                first, count = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, first, count = length, n_sequences, -(-left // (length // size))
                n_sequences += count
            each = room // size
            full = min(count, left // each)
            if full:
                rows.append((size, rank, rank + full * each, first, length - room, each))
                put_back(room - each * size, first, full)
                rank, left, first, count = rank + full * each, left - full * each, first + full, count - full
            if count and left and left < each:
                rows.append((size, rank, rank + left, first, length - room, left))
                put_back(room - left * size, first, 1)
                rank, left, first, count = rank + left, 0, first + 1, count - 1
            put_back(room, first, count)
    return np.array(rows, np.int64).reshape(-1, 6), n_sequences


def _placer(sent, length: int, columns: list[str]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, most = sent.value
        # rows are by length, then by rank: one number for both
        key = steps[:, 0] * most + steps[:, 1]
        order = np.argsort(key)
        steps, key = steps[order], key[order]
        for batch in batches:
            size = batch.column("length").to_numpy().astype(np.int64)
            rank = batch.column("rank").to_numpy()
            own = steps[np.searchsorted(key, size * most + rank, side="right") - 1]
            within = rank - own[:, 1]
            sequence = own[:, 3] + within // own[:, 5]
            offset = own[:, 4] + within % own[:, 5] * size
            out = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*out, pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    return place


def pack(
    docs: DataFrame,
    path: str,
    length: int = LENGTH,
    end: int = END,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Every piece of every document with its sequence and place there.

    Returns doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset. Sequences hold at
    most ``length`` tokens without gaps. Only documents longer than that are cut.

    1. Documents are tokenised and cut, in one pass; each piece is numbered among those of its
       length in its task.
    2. The pieces of each length are counted. These at most ``length`` numbers are all that the
       planner sees; its plan has a row per step, some thousands whatever the corpus holds.
    3. A piece's rank within its length is its number plus the pieces of that length in earlier
       tasks, joined by (task, length), which no length is frequent enough to make large. The
       rank leads to the planned slot.

    Null and empty texts are one end token. Rows that repeat an id are documents of their own, a
    null id stays null, an empty table gives no rows, other columns are ignored.
    """
    pieces = tokenised(docs, path, length, end, id_col, text_col, with_ids)
    held = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("held"))
    held = stored(held, "held")
    counts = {r.length: r.n for r in held.groupBy("length").agg(F.sum("held").alias("n")).collect()}
    steps, _ = plan(counts, length)
    most = max(counts.values(), default=0) + 1
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("task", "length", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(stored(starts, "starts"), ["task", "length"]).withColumn("rank", F.col("nth") + F.col("before"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    ranked = ranked.select(*columns, "rank")
    sent = docs.sparkSession.sparkContext.broadcast((steps, most))
    schema = ranked.select(*columns, *[F.lit(0).cast("long").alias(c) for c in ("sequence_id", "offset")]).schema
    return ranked.mapInArrow(_placer(sent, length, columns), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids (one after another, binary) and doc_ids of the packed sequences.

    A group is one sequence, which has few tokens; so no group is large.
    """
    inside = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    rows = packed.groupBy("sequence_id").agg(inside.alias("inside"))
    return rows.select(
        "sequence_id",
        F.aggregate("inside", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("n_tokens"),
        F.aggregate("inside", F.lit(b""), lambda b, p: F.concat(b, p["ids"])).alias("ids"),
        F.transform("inside", lambda p: p["doc_id"]).alias("doc_ids"),
    )
