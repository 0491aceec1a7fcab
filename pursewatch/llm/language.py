"""Language of a text by interpolated Kneser-Ney character models."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from functools import cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pursewatch.llm import words
from pursewatch.llm.common import free_name, key60, stored

#: Characters in the longest n-gram.
ORDER = 4
#: One in so many documents of a language calibrates, the others are counted.
HELD_OUT = 5
#: Documents per language that calibrate at most: enough for one quantile.
SAMPLE = 1_000
#: N-grams of a language and order that reach the driver at most, about: the most frequent ones, and
#: those of all languages and orders together. All others are looked up in a join.
MOST_GRAMS = 200_000
MODEL_GRAMS = 4_000_000
#: Bits in all that mark which n-grams and contexts that join may have, and how many for each of them.
MARK_BITS = 1 << 26
MARK_ROOM = 32
#: Bytes of texts and different n-grams in them, about, that look up together what the models lack.
CHUNK_BYTES = 16 << 20
CHUNK_GRAMS = 1 << 19
#: Bytes of text and characters that a task works on at a time, and n-grams that it holds back.
SLICE_BYTES = 1 << 19
SEGMENT = 1 << 18
PENDING = 1 << 18
#: Share of a language's calibration texts whose cross-entropy is taken to be in order.
ACCEPTED = 0.995

UNDETERMINED = "und"

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def characters(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, each run of non-letters as one 0, and their starts.

    Every text begins and ends with a 0; one without letters has these two alone.
    """
    texts = [(t or "").lower() for t in column.to_pylist()]
    size = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    # a 0 before and after each text
    begin = np.concatenate([[0], np.cumsum(size + 2)])
    out = np.zeros(begin[-1], np.uint32)
    inner = np.ones(len(out), bool)
    inner[begin[:-1]] = inner[begin[1:] - 1] = False
    out[inner] = np.where(_letters()[points], points, 0)
    # of a run of zeros the first stays, at a text's start that before it
    kept = out > 0
    letters = np.concatenate([[0], np.cumsum(kept)])
    kept[1:] |= out[:-1] > 0
    kept[begin[:-1]] = True
    kept[begin[1:][letters[begin[1:]] == letters[begin[:-1]]] - 1] = True
    number = np.concatenate([[0], np.cumsum(kept)])
    return out[kept], number[begin]


def grams(points: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n characters that end at each place (of fewer, at a start: with zeros)."""
    return all_grams(points, n)[-1]


def all_grams(points: np.ndarray, order: int) -> list[np.ndarray]:
    """The hashes of 1 to ``order`` characters that end at each place."""
    own = words.mix(points.astype(np.uint64) + np.uint64(1))
    before = words.mix(np.ones(1, np.uint64))
    found, h, pad = [], own, before
    for n in range(1, order + 1):
        if n > 1:
            # what is before the first place: n - 1 zeros
            h = np.concatenate([pad, h[:-1]]) * _FACTOR + own
            pad = pad * _FACTOR + before
        found.append(words.mix(h + np.uint64(n)))
    return found


@dataclass
class Marks:
    """A Bloom filter of hashes with two bits each: it knows all that it was given, and few others."""

    width: int
    words: np.ndarray

    def may_have(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for h in (keys, keys << np.uint64(self.width)):
            at = h >> np.uint64(64 - self.width)
            out &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0
        return out


@dataclass
class LanguageModel:
    """For each order the n-grams' hashes, sorted, with log2 P and the contexts' back-off weights.

    ``backoff`` and ``floor`` are those of a model that has no other n-grams; ``rest`` and ``base``
    are those among all n-grams, to which what was left out is added.
    """

    keys: list[np.ndarray] = field(default_factory=list)
    logs: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    backoff: list[np.ndarray] = field(default_factory=list)
    rest: list[np.ndarray] = field(default_factory=list)
    floor: float = -20.0
    base: float = -20.0

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def log2(self, by_order: list[np.ndarray], context_by_order: list[np.ndarray]) -> np.ndarray:
        """log2 P(last character | those before) of n-grams, given their hashes in each order."""
        out = np.full(len(by_order[0]), np.nan)
        weight = np.zeros(len(out))
        for n in range(len(by_order) - 1, -1, -1):
            at, known = self._find(self.keys[n], by_order[n])
            use = known & np.isnan(out)
            out[use] = weight[use] + self.logs[n][at[use]]
            if n:
                at, seen = self._find(self.contexts[n], context_by_order[n])
                fall = seen & np.isnan(out)
                weight[fall] += self.backoff[n][at[fall]]
        unseen = np.isnan(out)
        out[unseen] = weight[unseen] + self.floor
        return out

    def _kept(self, by_order: list[np.ndarray], context_by_order: list[np.ndarray]):
        """The longest order in which each n-gram is known, and for each order where it and its context are."""
        known = [self._find(k, g) for k, g in zip(self.keys, by_order, strict=True)]
        seen = [self._find(k, c) for k, c in zip(self.contexts[1:], context_by_order[1:], strict=True)]
        top = np.full(len(by_order[0]), -1)
        for n, (_, here) in enumerate(known):
            top[here] = n
        return top, known, [(None, np.ones(len(top), bool)), *seen]

    def log2_among_all(
        self, by_order: list[np.ndarray], context_by_order: list[np.ndarray], more: dict[int, tuple[np.ndarray, np.ndarray]]
    ) -> np.ndarray:
        """The same among all n-grams, given what the ones that were left out add.

        log2 P of an n-gram is that of its tail, the share that its context leaves to the tail's
        order, and a gain where the n-gram itself is known. So each n-gram or context that was left
        out adds a number of its own to what the kept ones tell. ``more`` has these by slot: 2 n for
        n-grams of n + 1 characters, 2 n + 1 for their contexts; sorted hashes and numbers.
        """
        top, known, seen = self._kept(by_order, context_by_order)
        out = np.full(len(top), self.base)
        for n, (at, here) in enumerate(known):
            out[here] = self.logs[n][at[here]]
        for n in range(len(by_order)):
            for slot, keys, (at, here) in ((2 * n + 1, context_by_order[n], seen[n]), (2 * n, by_order[n], known[n])):
                if n and slot % 2:
                    fall = here & (top < n)
                    out[fall] += self.rest[n][at[fall]]
                if slot in more:
                    want = np.flatnonzero(~here & (top < n))
                    at, here = self._find(more[slot][0], keys[want])
                    out[want[here]] += more[slot][1][at[here]]
        return out

    def lacking(
        self, by_order: list[np.ndarray], context_by_order: list[np.ndarray], marks: dict[int, Marks]
    ) -> Iterator[tuple[int, np.ndarray]]:
        """By slot, the different hashes that ``more`` above may have something for.

        A known n-gram has a known tail and a known context, which has a known tail too: others
        need not be asked for.
        """
        top, known, seen = self._kept(by_order, context_by_order)
        gram_lives = context_lives = seen[0][1]
        for n in range(len(by_order)):
            for slot, keys, (_, sure) in ((2 * n + 1, context_by_order[n], seen[n]), (2 * n, by_order[n], known[n])):
                may = np.zeros(len(top), bool)
                if slot in marks:
                    at = np.flatnonzero(~sure & context_lives & (gram_lives if slot % 2 == 0 else True))
                    may[at] = marks[slot].may_have(keys[at])
                    yield slot, np.unique(keys[may & (top < n)])
                if slot % 2:
                    context_lives = sure | may
                else:
                    gram_lives = sure | may


@dataclass
class Identifier:
    """The languages' models with the calibration of posterior and rejection.

    Where the models have not all n-grams, ``others`` has what the rest add (language, slot, gram,
    gain) and ``marks`` of each language and slot tell which these may be. Alone, the models back
    off for the rest; ``identify`` below looks the rest up.
    """

    languages: list[str]
    models: list[LanguageModel]
    sharpness: float = 1.0
    most: list[float] = field(default_factory=list)
    marks: list[dict[int, Marks]] = field(default_factory=list)
    others: DataFrame | None = None

    def entropies(
        self, column: pa.Array | pa.ChunkedArray, more: list[dict[int, tuple[np.ndarray, np.ndarray]]] | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text under each language, and how many characters count.

        ``more`` has for each language what those n-grams add that its model lacks.
        """
        points, starts = characters(column)
        count = np.maximum(np.diff(starts) - 1, 1)
        bits = np.zeros((len(starts) - 1, len(self.models)))
        if not self.models:
            return bits, np.zeros(len(bits), np.int64)
        order = len(self.models[0].keys)
        doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        first = np.zeros(len(points), bool)
        # the text's first 0 is given, all that follows is predicted
        first[starts[:-1]] = True
        for a in range(0, len(points), SEGMENT):
            b = min(a + SEGMENT, len(points))
            code, own, contexts = _different(points, a, b, order)
            counted = ~first[a:b]
            # how often each text has each n-gram, as its place among those of the segment
            code, of = code[counted], doc[a:b][counted]
            for k, model in enumerate(self.models):
                cost = -(model.log2(own, contexts) if more is None else model.log2_among_all(own, contexts, more[k]))
                bits[:, k] += np.bincount(of, cost[code], minlength=len(bits))
        return bits / count[:, None], np.where(np.diff(starts) > 2, count, 0)

    def lacking(self, grams: np.ndarray) -> dict[str, np.ndarray]:
        """What to look up for n-grams given as by ``_Chunk``."""
        order = len(self.models[0].keys)
        own, contexts = list(grams[:order]), [np.zeros(0, np.uint64), *grams[order:]]
        found = [(k, *x) for k, model in enumerate(self.models) for x in model.lacking(own, contexts, self.marks[k])]
        return {
            "language": np.concatenate([np.full(len(g), k) for k, _, g in found]),
            "slot": np.concatenate([np.full(len(g), slot) for _, slot, g in found]),
            "gram": np.concatenate([g for _, _, g in found]),
        }

    def identify(self, column: pa.Array | pa.ChunkedArray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, posterior probability and whether the cross-entropy is in order."""
        return self.decide(*self.entropies(column))

    def decide(self, bits: np.ndarray, size: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The same from the texts' cross-entropies and how many of their characters count."""
        n = len(bits)
        if not self.models:
            return [UNDETERMINED] * n, np.zeros(n), np.zeros(n, bool)
        best = bits.argmin(axis=1)
        low = bits[np.arange(n), best]
        score = 1 / np.exp2(-self.sharpness * (bits - low[:, None])).sum(axis=1)
        known = size > 0
        inside = known & (low <= np.array(self.most)[best]) if self.most else known
        names = [self.languages[k] if ok else UNDETERMINED for k, ok in zip(best, known, strict=True)]
        return names, np.where(known, score, 0.0), inside


def _different(points: np.ndarray, a: int, b: int, order: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """The different n-grams that end at places a to b: which one each place has, their hashes in
    each order, and those of their contexts."""
    low = max(a - order, 0)
    by_order = all_grams(points[low:b], order)
    code, unique = pd.factorize(by_order[-1][a - low :])
    where = np.zeros(len(unique), np.int64)
    where[code[::-1]] = np.arange(b - a)[::-1]
    where += a - low
    return code, [g[where] for g in by_order], [np.zeros(0, np.uint64), *[g[np.maximum(where - 1, 0)] for g in by_order[:-1]]]


class _Chunk:
    """Texts and their different n-grams: a row of hashes for each order, then for each order of contexts from 2 on."""

    def __init__(self, order: int):
        self.order = order
        self.parts: list[pa.RecordBatch] = []
        self.size = 0
        self.grams = np.zeros((2 * order - 1, 0), np.uint64)
        self.fresh: list[np.ndarray] = []

    def add(self, part: pa.RecordBatch, text: str) -> bool:
        """Whether there is room for more texts."""
        points, _ = characters(part.column(text))
        for a in range(0, len(points), SEGMENT):
            _, own, contexts = _different(points, a, min(a + SEGMENT, len(points)), self.order)
            rows = np.stack([*own, *contexts[1:]])
            self.fresh.append(rows[:, ~LanguageModel._find(self.grams[self.order - 1], own[-1])[1]])
            if sum(x.shape[1] for x in self.fresh) > max(PENDING, self.grams.shape[1]) // 4:
                self.fold()
        self.parts.append(part)
        self.size += part.nbytes
        return self.size < CHUNK_BYTES and self.grams.shape[1] < CHUNK_GRAMS

    def fold(self) -> np.ndarray:
        rows = np.concatenate([self.grams, *self.fresh], axis=1)
        self.grams, self.fresh = rows[:, np.unique(rows[self.order - 1], return_index=True)[1]], []
        return self.grams


def _columns(order: int) -> list[str]:
    """Of an n-gram's shorter tails their hashes, ``t``, and the hashes of the contexts of it and of
    each of them, ``c``: of k and k - 1 characters."""
    return [*[f"t{k}" for k in range(1, order)], *[f"c{k}" for k in range(2, order + 1)]]


def _merged(rows: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Rows of one language, n and gram as one, their counts added."""
    both = {c: np.concatenate([r[c] for r in rows]) for c in rows[0]}
    key = words.mix(both["gram"] + words.mix(both["lang"].astype(np.uint64) * np.uint64(64) + both["n"].astype(np.uint64)))
    code, unique = pd.factorize(key)
    first = np.zeros(len(unique), np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    count = np.bincount(code, both["count"], minlength=len(unique)).astype(np.int64)
    return {**{c: v[first] for c, v in both.items()}, "count": count}


def _counter(order: int):
    """Counts of the n-grams of ``order`` characters, and of the shorter ones that texts begin with.

    All other shorter n-grams are tails of longer ones, and Kneser-Ney counts how many of these they
    end: both follow from the longest, whose rows carry the hashes.
    """
    names: dict[str, int] = {}

    def batch(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        known = pa.array(list(names), pa.string())
        columns = {"lang": known.take(pa.array(rows["lang"])), "n": pa.array(rows["n"], pa.int32())}
        for c in ("gram", *_columns(order)):
            columns[c] = pa.array(rows[c].view(np.int64))
        columns["count"] = pa.array(rows["count"])
        return pa.RecordBatch.from_pydict(columns)

    def of_segment(points, place, lang, a, b) -> Iterator[dict[str, np.ndarray]]:
        low = max(a - order, 0)
        by_order = all_grams(points[low:b], order)
        inside = place[a:b]
        for n in range(2 if order > 1 else 1, order + 1):
            at = np.flatnonzero(inside >= max(n - 1, 1) if n == order else inside == n - 1)
            here = at + a - low
            rows = {"lang": lang[a:b][at], "n": np.full(len(at), n), "gram": by_order[n - 1][here]}
            rows["count"] = np.ones(len(at), np.int64)
            none = np.zeros(len(at), np.uint64)
            for k in range(1, order):
                rows[f"t{k}"] = by_order[k - 1][here] if k < n else none
            for k in range(2, order + 1):
                rows[f"c{k}"] = by_order[k - 2][here - 1] if k <= n else none
            yield _merged([rows])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        size = 0
        for given in batches:
            for part in words.slices(given, "text", SLICE_BYTES):
                points, starts = characters(part.column("text"))
                doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                place = np.arange(len(points)) - starts[doc]
                lang = np.array([names.setdefault(x, len(names)) for x in part.column("lang").to_pylist()], np.int64)[doc]
                for a in range(0, len(points), SEGMENT):
                    held += of_segment(points, place, lang, a, min(a + SEGMENT, len(points)))
                    size += sum(len(r["gram"]) for r in held[-order:])
                if size > PENDING:
                    held = [_merged(held)]
                    size = len(held[0]["gram"])
                    if size > PENDING // 2:
                        yield batch(held[0])
                        held, size = [], 0
        if held:
            yield batch(_merged(held))

    return count


def kneser_ney(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """Interpolated Kneser-Ney probabilities of every n-gram of every order, from ``_counter``'s rows.

    Returns lang, n, gram, context, tail, count, p, below (the tail's probability in the order below),
    rest (the share of the context left to that order), kinds (n-grams of the context), n1, n2 and
    known (characters of the language). Lower orders count in how many longer n-grams they end, one
    at least; the discount of each order is n1 / (n1 + 2 n2) of its counts of one and two, over all
    n-grams. Every order is one grouping of the one above and a join with the one below.
    """
    keys = ["lang", "gram"]
    tables: dict[int, DataFrame] = {}
    for k in range(order, 0, -1):
        lower = _columns(k)
        rows = counted.where(F.col("n") == k).select(*keys, *lower, F.col("count").alias("one") if k == order else F.lit(0).alias("one"))
        if k < order:
            ends = tables[k + 1].select("lang", F.col(f"t{k}").alias("gram"), *lower, F.lit(1).alias("one"))
            rows = rows.unionByName(ends)
        folded = rows.groupBy(*keys).agg(
            *[F.min(c).alias(c) for c in lower], F.greatest(F.sum("one"), F.lit(1)).cast("long").alias("count")
        )
        tables[k] = stored(folded, f"counts-{k}")
    found: list[DataFrame] = []
    for k in range(1, order + 1):
        context = F.col(f"c{k}") if k > 1 else F.lit(0).cast("long")
        own = tables[k].select(
            *keys, context.alias("context"), (F.col(f"t{k - 1}") if k > 1 else F.lit(0).cast("long")).alias("tail"), "count"
        )
        ones = {f"n{i}": F.count(F.when(F.col("count") == i, 1)) for i in (1, 2)}
        kinds = own.groupBy("lang").agg(*[c.alias(n) for n, c in ones.items()])
        share = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        kinds = kinds.withColumn("discount", F.when((F.col("n1") > 0) & (F.col("n2") > 0), share).otherwise(0.5))
        sums = own.groupBy("lang", "context").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("kinds"))
        rows = own.join(sums, ["lang", "context"]).join(kinds, "lang")
        if k == 1:
            known = tables[1].groupBy("lang").agg(F.count(F.lit(1)).alias("known"))
            rows = rows.join(known, "lang").withColumn("below", 1 / (F.col("known") + 2))
        else:
            rows = rows.join(found[-1].select("lang", F.col("gram").alias("tail"), F.col("p").alias("below"), "known"), ["lang", "tail"])
        rest = F.col("discount") * F.col("kinds") / F.col("total")
        p = F.greatest(F.col("count") - F.col("discount"), F.lit(0.0)) / F.col("total") + rest * F.col("below")
        rows = rows.select(
            "lang", F.lit(k).alias("n"), "gram", "context", "tail", "count", p.alias("p"), "below", rest.alias("rest"), "kinds", "n1", "n2", "known"
        )
        found.append(stored(rows, f"model-{k}"))
    return reduce(DataFrame.unionByName, found)


def mark_frequent(grams: DataFrame, order: int) -> DataFrame:
    """The n-grams with ``kept``: whether one is among the most frequent, about ``MOST_GRAMS`` of a
    language and order and ``MODEL_GRAMS`` of all.

    From how many n-grams have each count, so that no group of them is sorted; of those with the
    last count that there is room for, the ones with the smallest hashes stay.
    """
    kinds = grams.groupBy("lang", "n", "count").agg(F.count(F.lit(1)).alias("kinds"))
    kinds = stored(kinds, "kinds").toArrow().to_pandas().sort_values("count", ascending=False)
    most = min(MOST_GRAMS, MODEL_GRAMS // max(1, order * kinds["lang"].nunique()))
    least = []
    for (lang, n), part in kinds.groupby(["lang", "n"]):
        total = part["kinds"].cumsum()
        full = part[total > most]
        if len(full):
            last = full.iloc[0]
            room = most - int(total.loc[last.name]) + int(last["kinds"])
            least.append((lang, int(n), int(last["count"]), int(room * 2**20 // int(last["kinds"]))))
    if not least:
        return grams.withColumn("kept", F.lit(True))
    bounds = grams.sparkSession.createDataFrame(least, "lang string, n int, least long, room long")
    tie = (F.col("count") == F.col("least")) & (F.shiftrightunsigned("gram", 44) < F.col("room"))
    # a row per language and order
    found = grams.join(F.broadcast(bounds), ["lang", "n"], "left")
    kept = F.col("least").isNull() | (F.col("count") > F.col("least")) | tie
    return found.select(*grams.columns, kept.alias("kept"))


def back_off(grams: DataFrame, order: int) -> DataFrame:
    """lang, n, context, weight, rest, known: what a context leaves to the order below, of marked n-grams.

    The weight is ``rest`` where all of its n-grams are kept. Otherwise what those left out had goes there:
    the weight is what the kept ones leave of the context, over what they leave of the order below
    as it is without those left out. So probabilities over all characters still add up to 1.
    """
    found: list[DataFrame] = []
    lower: DataFrame | None = None
    for k in range(1, order + 1):
        rows = grams.where(F.col("n") == k)
        if lower is None:
            rows = rows.withColumn("low", 1 / (F.col("known") + 2))
        else:
            rows = rows.join(lower.select("lang", F.col("gram").alias("tail"), F.col("own").alias("low")), ["lang", "tail"])
        left = (1 - F.sum("p")) / F.greatest(1 - F.sum("low"), F.lit(1e-9))
        whole = F.count(F.lit(1)) == F.first("kinds")
        weights = rows.where("kept").groupBy("lang", "context").agg(
            F.when(whole & (F.sum("low") == F.sum("below")), F.first("rest")).otherwise(left).alias("weight"),
            F.first("rest").alias("rest"),
            F.first("known").alias("known"),
        )
        weights = stored(weights, f"weights-{k}")
        found.append(weights.select("lang", F.lit(k).alias("n"), "context", "weight", "rest", "known"))
        if k < order:
            of_context = weights.select("lang", "context", "weight")
            own = F.when(F.col("kept"), F.col("p")).otherwise(F.coalesce("weight", F.lit(1.0)) * F.col("low"))
            lower = stored(rows.join(of_context, ["lang", "context"], "left").select("lang", "gram", own.alias("own")), f"own-{k}")
    return reduce(DataFrame.unionByName, found)


def _models(grams: DataFrame, order: int) -> tuple[list[str], list[LanguageModel]]:
    """Each language's model of its most frequent n-grams, with their probabilities among all.

    Of n-grams that are marked, or that are marked here.
    """
    marked = grams if "kept" in grams.columns else stored(mark_frequent(grams, order), "marked")
    # a row per language
    ends = marked.where("n = 1").groupBy("lang").agg(F.first("rest").alias("rest"), F.first("known").alias("known"))
    ends = {x.lang: float(np.log2(x.rest / (x.known + 2))) for x in ends.collect()}
    contexts = back_off(marked, order).toArrow().to_pandas()
    table = marked.where("kept").select("lang", "n", "gram", "p").toArrow().to_pandas()
    languages = sorted(ends)
    models = []
    for name in languages:
        model = LanguageModel(floor=ends[name], base=ends[name])
        for n in range(1, order + 1):
            own = table[(table["lang"] == name) & (table["n"] == n)]
            keys = own["gram"].to_numpy().view(np.uint64)
            by_key = np.argsort(keys)
            model.keys.append(keys[by_key])
            model.logs.append(np.log2(np.maximum(own["p"].to_numpy(float), 1e-30))[by_key])
            own = contexts[(contexts["lang"] == name) & (contexts["n"] == n)]
            keys = own["context"].to_numpy().view(np.uint64)
            by_key = np.argsort(keys)
            model.contexts.append(keys[by_key])
            weight = np.maximum(own["weight"].to_numpy(float), 1e-30)
            model.backoff.append(np.log2(weight)[by_key])
            model.rest.append(np.log2(own["rest"].to_numpy(float))[by_key])
            if n == 1 and len(weight):
                model.floor = float(np.log2(weight[0] / (own["known"].iloc[0] + 2)))
        models.append(model)
    return languages, models


def left_out(marked: DataFrame, languages: list[str], order: int) -> DataFrame | None:
    """language, slot, gram, gain: what the n-grams and contexts add that the models do not have.

    Those are the n-grams that are not kept, and the contexts none of whose n-grams is kept. Slots
    are as in ``log2_among_all``, languages by their place. None where the models have all.
    """
    others = marked.where("not kept")
    if others.isEmpty():
        return None
    slot = 2 * (F.col("n") - 1)
    gain = F.log2("p") - F.log2("below") - F.log2("rest")
    grams = others.select("lang", slot.alias("slot"), "gram", gain.alias("gain"))
    contexts = marked.where("n > 1").groupBy("lang", "n", "context").agg(F.max("kept").alias("kept"), F.first("rest").alias("rest"))
    contexts = contexts.where("not kept").select("lang", (slot + 1).alias("slot"), F.col("context").alias("gram"), F.log2("rest").alias("gain"))
    # a row per language
    names = marked.sparkSession.createDataFrame(list(enumerate(languages)), "language int, lang string")
    rows = grams.unionByName(contexts).join(F.broadcast(names), "lang")
    return stored(rows.select("language", "slot", "gram", "gain"), "left-out")


def marks_of(others: DataFrame, languages: int) -> list[dict[int, Marks]]:
    """For each language and slot the marks of what ``others`` has, ``MARK_BITS`` in all at most."""
    sizes = others.groupBy("language", "slot").agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(x.n for x in sizes)
    # a power of two, one word at least
    widths = {(x.language, x.slot): max(6, int(min(MARK_ROOM * x.n, MARK_BITS * x.n // total)).bit_length() - 1) for x in sizes}
    of_slot = others.sparkSession.createDataFrame([(*k, w) for k, w in widths.items()], "language int, slot int, width int")
    places = "explode(array(shiftrightunsigned(gram, 64 - width), shiftrightunsigned(shiftleft(gram, width), 64 - width))) AS place"
    # a row per language and slot
    rows = others.join(F.broadcast(of_slot), ["language", "slot"]).select("language", "slot", F.expr(places))
    rows = rows.groupBy("language", "slot", F.shiftrightunsigned("place", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(place & 63 AS int)))").alias("bits")
    )
    found: list[dict[int, Marks]] = [{} for _ in range(languages)]
    for (language, slot), width in widths.items():
        found[language][slot] = Marks(width, np.zeros(max(1, 1 << width >> 6), np.uint64))
    table = stored(rows, "marks").toArrow().to_pandas()
    for (language, slot), part in table.groupby(["language", "slot"]):
        found[language][slot].words[part["word"].to_numpy()] = part["bits"].to_numpy().view(np.uint64)
    return found


def count_grams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """Stored counts of the n-grams in ``text`` by ``lang``; a task sends each of its own about once."""
    columns = ["lang string", "n int", "gram long", *[f"{c} long" for c in _columns(order)], "count long"]
    rows = texts.mapInArrow(_counter(order), ", ".join(columns))
    folded = rows.groupBy("lang", "n", "gram").agg(
        *[F.min(c).alias(c) for c in _columns(order)], F.sum("count").alias("count")
    )
    return stored(folded, "counts")


def fit_on(docs: DataFrame, learnt: Column, order: int = ORDER, sample: int = SAMPLE) -> Identifier:
    """Models of the languages named in ``lang``, from the rows where ``learnt`` holds.

    Per language one in ``HELD_OUT`` documents, those with the smallest hashes of their ids and
    ``sample`` at most, are held out, one at least where there are two; all others are counted
    whole. Those held out calibrate: one sharpness for the posterior, and per language the
    cross-entropy that ``ACCEPTED`` of its texts stay below; a language that has none to hold out
    takes the one of all languages' texts. Counts, discounts and probabilities are Spark's, over all
    n-grams; only the about ``MOST_GRAMS`` most frequent ones of a language and order, and
    ``MODEL_GRAMS`` of all, reach the driver, and one row of cross-entropies per calibration text.
    All others stay in a stored table, where texts look them up, and reach the driver as marks.
    Rows with a null language, id or text are left out; without any other there is no language.
    """
    rows = docs.where(learnt & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    first = Window.partitionBy("lang").orderBy("key", "doc_id")
    ids = stored(rows.select("doc_id", "lang").dropDuplicates(), "ids")
    share = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    share = share.select("lang", F.greatest(F.lit(1), F.floor(F.col("n") / HELD_OUT)).alias("share"))
    ranked = ids.withColumn("key", key60(F.col("doc_id"))).withColumn("nth", F.row_number().over(first))
    chosen = ranked.where(F.col("nth") <= sample).join(F.broadcast(share), "lang").where("nth <= share")
    # sample ids per language at most, whatever the corpus holds
    chosen = F.broadcast(stored(chosen.select("doc_id", "lang"), "held-out"))
    texts = rows.select("doc_id", "lang", "text")
    counted = texts.join(chosen, ["doc_id", "lang"], "left_anti").select("lang", "text")
    marked = stored(mark_frequent(kneser_ney(count_grams(counted, order), order), order), "marked")
    languages, models = _models(marked, order)
    identifier = Identifier(languages, models)
    if not languages:
        return identifier
    identifier.others = left_out(marked, languages, order)
    if identifier.others is not None:
        identifier.marks = marks_of(identifier.others, len(languages))

    def measure(known: Identifier, part, bits: np.ndarray, size: np.ndarray):
        part = part.select(["lang"]).append_column("bits", pa.array(list(bits), pa.list_(pa.float64())))
        return part.append_column("size", pa.array(size))

    held = texts.join(chosen, ["doc_id", "lang"], "left_semi").select("lang", "text")
    held = _scored(held, identifier, "text", measure, "lang string, bits array<double>, size long")
    held = held.where("size > 0")
    found = held.toArrow().to_pandas().sort_values(["lang", "size"])
    if len(found):
        bits = np.vstack(found["bits"].to_list())
        true = np.array([languages.index(x) for x in found["lang"]])
        own = bits[np.arange(len(bits)), true]

        def likelihood(sharpness: float) -> float:
            odds = np.exp2(-sharpness * (bits - bits.min(axis=1, keepdims=True)))
            return np.log(odds[np.arange(len(bits)), true] / odds.sum(axis=1) + 1e-12).mean()

        identifier.sharpness = max((2.0**k for k in range(0, 8)), key=likelihood)
        identifier.most = [
            float(np.quantile(own[true == k] if (true == k).any() else own, ACCEPTED))
            for k in range(len(languages))
        ]
    return identifier


def _scored(rows: DataFrame, identifier: Identifier, text_col: str, finish: Callable, schema: T.StructType | str) -> DataFrame:
    """What ``finish`` makes of the rows, in parts, and of their texts' cross-entropies and sizes.

    Where the models lack n-grams the rows are stored in chunks. Each chunk asks once for each
    n-gram and context that its texts have, the models lack and the marks let through; these are
    joined with what they add, and the chunk is scored with the answers at hand.
    """
    sent = rows.sparkSession.sparkContext.broadcast(replace(identifier, others=None))

    def score(table, more=None) -> Iterator:
        for part in words.slices(table, text_col, SLICE_BYTES):
            yield finish(sent.value, part, *sent.value.entropies(part.column(text_col), more))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from score(batch)

    if identifier.others is None:
        return rows.mapInArrow(alone, schema)
    order = len(identifier.models[0].keys)
    number, asked = free_name(rows, "chunk"), free_name(rows, "asked")

    def tagged(chunk: _Chunk, nth: int) -> Iterator[pa.RecordBatch]:
        asks = sent.value.lacking(chunk.fold())
        types = {"language": pa.int32(), "slot": pa.int32(), "gram": pa.int64()}
        asks = {c: v.view(np.int64) if c == "gram" else v for c, v in asks.items()}
        asks = pa.StructArray.from_arrays([pa.array(asks[c], t) for c, t in types.items()], list(types))
        for k, part in enumerate(chunk.parts):
            # the first row asks for all
            ends = np.full(part.num_rows + 1, 0 if k else len(asks))
            ends[0] = 0
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), asks)
            ids = np.full(part.num_rows, (TaskContext.get().partitionId() << 32) + nth)
            yield part.append_column(number, pa.array(ids)).append_column(asked, lists)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, nth = _Chunk(order), 0
        for batch in batches:
            for part in words.slices(batch, text_col, SLICE_BYTES):
                if not chunk.add(part, text_col):
                    yield from tagged(chunk, nth)
                    chunk, nth = _Chunk(order), nth + 1
        if chunk.parts:
            yield from tagged(chunk, nth)

    def answered(texts: pa.Table, answers: pa.Table) -> pa.Table:
        found = answers.to_pandas()
        more: list[dict[int, tuple[np.ndarray, np.ndarray]]] = [{} for _ in sent.value.models]
        for (language, slot), part in found.groupby(["language", "slot"]):
            keys = part["gram"].to_numpy().view(np.uint64)
            by_key = np.argsort(keys)
            more[language][slot] = keys[by_key], part["gain"].to_numpy()[by_key]
        return pa.concat_tables(x if isinstance(x, pa.Table) else pa.Table.from_batches([x]) for x in score(texts, more))

    fields = [T.StructField(f.name, f.dataType) for f in rows.schema]
    asks = T.ArrayType(T.StructType([T.StructField("language", T.IntegerType()), T.StructField("slot", T.IntegerType()), T.StructField("gram", T.LongType())]))
    chunks = stored(rows.mapInArrow(ask, T.StructType([*fields, T.StructField(number, T.LongType()), T.StructField(asked, asks)])), "chunks")
    answers = chunks.select(F.col(number).alias("chunk"), F.inline(asked)).join(identifier.others, ["language", "slot", "gram"])
    return chunks.drop(asked).groupBy(number).cogroup(answers.groupBy("chunk")).applyInArrow(answered, schema)


def identify(docs: DataFrame, identifier: Identifier, text_col: str = "text") -> DataFrame:
    """The rows with ``lang_pred``, ``lang_score`` and ``lang_accepted``, from their whole texts.

    The language whose model codes the text in the fewest bits per character wins; the score is
    its calibrated posterior. A text without letters, or null, is ``und`` with score 0. A text
    that costs more than nearly all calibration texts of the winning language is not accepted.
    Nothing is shuffled where the models have all n-grams; otherwise the rows are, once, to the
    n-grams that they ask for. Columns of these names are replaced.
    """
    new = [("lang_pred", T.StringType()), ("lang_score", T.DoubleType()), ("lang_accepted", T.BooleanType())]
    rows = docs.drop(*[n for n, _ in new])
    fields = [T.StructField(f.name, f.dataType) for f in rows.schema]

    def finish(known: Identifier, part, bits: np.ndarray, size: np.ndarray):
        names, score, inside = known.decide(bits, size)
        part = part.select([f.name for f in fields]).append_column("lang_pred", pa.array(names, pa.string()))
        return part.append_column("lang_score", pa.array(score)).append_column("lang_accepted", pa.array(inside))

    return _scored(rows, identifier, text_col, finish, T.StructType(fields + [T.StructField(n, t) for n, t in new]))
