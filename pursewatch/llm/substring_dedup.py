"""Removal of word windows that an earlier document holds, found by an index of blocks."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from pursewatch.llm import words

#: Bytes of text in a reference block, the unit that is indexed and factored at a time.
BLOCK_BYTES = 4 << 20
#: Words of an anchor: every window has the anchor with its smallest run of so many words.
ANCHOR = 4

INDEX = "block long, anchor long, content long, first long, last long"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"

_RESULT = [
    pa.field("doc_id", pa.int64()),
    pa.field("n_words", pa.int64()),
    pa.field("n_removed", pa.int64()),
    pa.field("kept_sha256", pa.string()),
]


class _Windows:
    """The windows of a block's documents, and the stretches of windows that share an anchor.

    A stretch is a run of windows whose smallest anchor is the same occurrence: some five to ten
    windows that lie in a common text together, as anchors depend on nothing outside the window.
    """

    def __init__(self, texts: pa.Array, size: int):
        self.words, self.starts = words.split(texts)
        word = words.hashes(self.words)
        self.size = size
        self.at, self.doc = words.run_starts(self.starts, size)
        self.window = words.runs(word, size)[self.at] if len(self.at) else np.zeros(0, np.uint64)
        gram = words.runs(word, min(ANCHOR, size))
        low = gram[self.at] if len(self.at) else np.zeros(0, np.uint64)
        where = self.at.copy()
        for k in range(1, size - min(ANCHOR, size) + 1):
            other = gram[self.at + k]
            less = other < low
            low = np.where(less, other, low)
            where[less] = self.at[less] + k
        new = np.ones(len(self.at), bool)
        new[1:] = (np.diff(where) != 0) | (np.diff(self.doc) != 0)
        self.first = np.flatnonzero(new)
        self.of = np.cumsum(new) - 1
        self.anchor = low[self.first]
        nth = np.arange(len(self.at)) - self.first[self.of] if len(self.at) else np.zeros(0, np.int64)
        told = words.mix(self.window + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.stretch = np.add.reduceat(told, self.first) if len(self.first) else told
        self.stretch_doc = self.doc[self.first]


_NO_ID = np.iinfo(np.int64).max


def _ids(table: pa.Table) -> np.ndarray:
    """The documents' ids; a null id is later than any other."""
    return table.column("doc_id").fill_null(_NO_ID).to_numpy().astype(np.int64)


def _entries(block: int, anchor: np.ndarray, content: np.ndarray, doc: np.ndarray) -> pa.Table:
    """One index entry per anchor and content, with the smallest and the largest id in the block."""
    order = np.lexsort((doc, content, anchor))
    a, c, d = anchor[order], content[order], doc[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(a))[: len(begin)] - 1
    return pa.table(
        {
            "block": pa.array(np.full(len(begin), block, np.int64)),
            "anchor": a[begin].view(np.int64),
            "content": c[begin].view(np.int64),
            "first": d[begin],
            "last": d[end],
        }
    )


class _Lookup:
    """The smallest id for (anchor, content), from the entries that came back to a block."""

    def __init__(self, entries: pa.Table):
        a, c, f = (entries.column(n).to_numpy() for n in ("anchor", "content", "first"))
        # both halves in one number for the search, and compared whole after it
        mixed = words.mix(a.view(np.uint64) * np.uint64(3) + words.mix(c.view(np.uint64)))
        order = np.argsort(mixed, kind="stable")
        self.mixed, self.a, self.c, self.first = mixed[order], a[order], c[order], f[order]

    def __call__(self, anchor: np.ndarray, content: np.ndarray) -> np.ndarray:
        out = np.full(len(anchor), _NO_ID, np.int64)
        if not len(self.mixed):
            return out
        mixed = words.mix(anchor * np.uint64(3) + words.mix(content))
        at = np.searchsorted(self.mixed, mixed)
        at[at == len(self.mixed)] = 0
        same = (self.a[at].view(np.uint64) == anchor) & (self.c[at].view(np.uint64) == content)
        out[same] = self.first[at[same]]
        return out


def _index_stretches(size: int):
    def index(block: tuple, table: pa.Table) -> pa.Table:
        w = _Windows(table.column("text"), size)
        return _entries(block[0].as_py(), w.anchor, w.stretch, _ids(table)[w.stretch_doc])

    return index


def _index_open_windows(size: int):
    """Windows of the stretches that no earlier document holds whole, though one has their anchor."""

    def index(block: tuple, table: pa.Table, entries: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _entries(0, *[np.zeros(0, np.uint64)] * 2, np.zeros(0, np.int64))
        w = _Windows(table.column("text"), size)
        ids = _ids(table)
        open_ = _Lookup(entries)(w.anchor, w.stretch) == ids[w.stretch_doc]
        chosen = open_[w.of] if len(w.of) else np.zeros(0, bool)
        anchor = w.anchor[w.of][chosen] if len(w.of) else w.anchor
        return _entries(block[0].as_py(), anchor, w.window[chosen], ids[w.doc[chosen]])

    return index


def _removed(size: int):
    def remove(block: tuple, table: pa.Table, entries: pa.Table) -> pa.Table:
        w = _Windows(table.column("text"), size)
        ids = _ids(table)
        gone = np.zeros(len(w.words) + 1, np.int64)
        if len(w.at):
            whole = _Lookup(entries.filter(entries.column("whole")))
            single = _Lookup(entries.filter(pc.invert(entries.column("whole"))))
            factor = whole(w.anchor, w.stretch) < ids[w.stretch_doc]
            again = factor[w.of]
            rest = np.flatnonzero(~again)
            again[rest] = single(w.anchor[w.of[rest]], w.window[rest]) < ids[w.doc[rest]]
            np.add.at(gone, w.at[again], 1)
            np.add.at(gone, w.at[again] + size, -1)
        gone = np.cumsum(gone)[:-1] > 0
        kept = w.words.filter(pa.array(~gone))
        before = np.concatenate([[0], np.cumsum(~gone)])[w.starts]
        lists = pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), kept)
        joined = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).to_pylist()
        n_words = np.diff(w.starts)
        if not len(ids):
            return pa.table({f.name: pa.array([], f.type) for f in _RESULT})
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_words": pa.array(n_words.astype(np.int64)),
                "n_removed": pa.array((n_words - np.diff(before)).astype(np.int64)),
                "kept_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in joined], pa.string()),
            }
        )

    return remove


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 13,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every row with what is left of it when windows of ``size`` words seen before are removed.

    A word goes if it lies in a window whose words also start in a document with a smaller id.
    Returns doc_id, n_words, n_removed and kept_sha256, of the kept words joined by one space.

    Documents are dealt into blocks of about ``block_bytes`` by a hash of their id. This is no
    Lempel-Ziv parse, which would take each block against every other: a block is cut into stretches
    of windows around an anchor, and indexed by them: one entry
    per stretch and block, so that a passage in any number of documents is one entry per block.
    An entry of anchor and stretch that another document has is a duplicate span, and goes back to its
    blocks with the smallest id. Stretches that are nobody's whole (at the borders of common
    passages, and first occurrences) are checked window by window in the same way. A third pass
    over the blocks removes what was found. The blocks' text is shuffled once.

    Contents are compared by 128 bits of hash. Null and empty texts, and those under ``size``
    words, lose nothing; a null id counts as later than all others; rows that share an id do not
    count as earlier than each other. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n_blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // block_bytes))
    block = F.pmod(F.xxhash64("doc_id", F.lit(n_blocks)), F.lit(n_blocks)).cast("long")
    blocks = texts.withColumn("block", block)

    anchors = Window.partitionBy("anchor")
    contents = Window.partitionBy("anchor", "content")
    stretches = (
        blocks.groupBy("block")
        .applyInArrow(_index_stretches(size), INDEX)
        .withColumn("low", F.min("first").over(anchors))
        .withColumn("high", F.max("last").over(anchors))
        .where("low < high")
        .select("block", "anchor", "content", "first", "last", F.min("first").over(contents).alias("low"))
    )
    open_ = stretches.where("low = first").select("block", "anchor", "content", F.col("low").alias("first"))
    windows = (
        blocks.groupBy("block")
        .cogroup(open_.groupBy("block"))
        .applyInArrow(_index_open_windows(size), INDEX)
        .withColumn("low", F.min("first").over(contents))
    )
    found = [
        frame.where("low < last").select(
            "block", "anchor", "content", F.col("low").alias("first"), F.lit(whole).alias("whole")
        )
        for frame, whole in ((stretches, True), (windows, False))
    ]
    entries = found[0].unionByName(found[1])
    return blocks.groupBy("block").cogroup(entries.groupBy("block")).applyInArrow(_removed(size), RESULT)
