"""Near-duplicate documents: posting lists of MinHash coordinates, confirmed on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pursewatch.llm import words
from pursewatch.llm.common import stored
from pursewatch.llm.components import components

#: Coordinates of a signature, and how many of them two documents must share to be compared.
#: Of two sets with similarity 0.8 each coordinate agrees with probability 0.8; fewer than 22 of
#: 48 agree once in some ten million pairs.
COORDINATES = 48
MATCHES = 22

#: Shingles of so many documents or fewer are compared one by one before two sets are.
RARE = 64

#: Texts are worked on in slices of about so many bytes: workers live on and keep the room once taken.
SLICE_BYTES = 1 << 20

#: Ids of documents in posting lists that are broadcast at most, some 10 MB; more are shuffled.
SENT_IDS = 1_000_000

SIGNED = "doc_id long, n_shingles long, content binary, signature array<long>"
SETS = "doc_id long, content binary, shingles array<long>"


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Of each text the sorted set of its shingles; all its words make one where they are fewer."""
    found, starts = words.split(texts)
    word = words.hashes(found, lower=True)
    run = words.runs(word, size)
    sets = []
    for a, b in zip(starts, starts[1:], strict=False):
        if b - a >= size:
            sets.append(np.unique(run[a : b - size + 1]))
        elif b > a:
            sets.append(words.runs(word[a:b], b - a) + np.uint64(b - a))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = words.mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return numbers[:n] | np.uint64(1), numbers[n:]


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """For each set, which must not be empty, its smallest hash in each coordinate.

    The last six bits hold the coordinate, so that a value is posted under its own coordinate only.
    """
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1].astype(np.int64)
    flat = np.concatenate(sets)
    factor, shift = _constants(coordinates)
    out = np.empty((len(sets), coordinates), np.uint64)
    for k in range(coordinates):
        low = np.minimum.reduceat(flat * factor[k] + shift[k], starts)
        out[:, k] = (low & ~np.uint64(63)) | np.uint64(k)
    return out.view(np.int64)


def _as_lists(values: np.ndarray, lengths: list[int]) -> pa.Array:
    at = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    return pa.ListArray.from_arrays(at, pa.array(values))


def _signer(size: int, coordinates: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text", SLICE_BYTES):
                sets = shingle_sets(part.column("text"), size)
                full = [s for s in sets if len(s)]
                found = signatures(full, coordinates) if full else np.zeros((0, coordinates), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        _contents(sets),
                        _as_lists(found.ravel(), [coordinates if len(s) else 0 for s in sets]),
                    ],
                    ["doc_id", "n_shingles", "content", "signature"],
                )

    return sign


def _contents(sets: list[np.ndarray]) -> pa.Array:
    """What tells a set from all others, null of an empty one."""
    import xxhash

    return pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())


def _setter(size: int):
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text", SLICE_BYTES):
                sets = shingle_sets(part.column("text"), size)
                flat = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), _contents(sets), _as_lists(flat, [len(s) for s in sets])],
                    ["doc_id", "content", "shingles"],
                )

    return gather


def _bounds(sets: DataFrame, members: DataFrame) -> DataFrame:
    """What a document can share at most with others of ``members``: rep, common, rare, n_rare, lost.

    ``n_rare`` is the number of its shingles that 2 to ``RARE`` members have, ``rare`` holds hashes of
    these of 32 bits, as they are sent with every posting, and ``lost`` tells how many fewer those
    are. ``common`` is the number of shingles that more members have. Shingles of its own can be in no
    intersection. A document without any shared shingle is left out, as it has no link here.
    """
    own = sets.join(members, "rep", "left_semi")
    # two shingles of one hash only make the bounds wider
    each = own.select("rep", F.explode("shingles").alias("shingle")).select("rep", F.hash("shingle").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    few = F.col("often") <= RARE
    found = each.join(often, "shingle").groupBy("rep").agg(
        F.count(F.when(~few, 1)).alias("common"),
        F.count(F.when(few, 1)).alias("n_rare"),
        F.collect_set(F.when(few, F.col("shingle"))).alias("rare"),
    )
    return stored(found.withColumn("lost", F.col("n_rare") - F.size("rare")), "bounds")


def _classes(known: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The nodes of the graph, and edges that ids with several contents make.

    A node is a content: content, rep (the smallest id that has it) and node, a number of its own,
    which is ``rep`` unless that id has other contents too. Then it is a hash that is no id.
    """
    classes = known.groupBy("content").agg(F.min("doc_id").alias("rep"))
    several = known.groupBy("doc_id").agg(F.min("content").alias("a"), F.max("content").alias("b"))
    several = stored(several.where("a != b").select("doc_id"), "several")
    if several.isEmpty():
        return stored(classes.withColumn("node", F.col("rep")), "classes"), None
    classes = stored(classes, "reps")
    shared = several.select(F.col("doc_id").alias("rep"))
    plain = classes.join(shared, "rep", "left_anti").select("content", "rep", F.col("rep").alias("node"))
    apart = classes.join(shared, "rep", "left_semi").select("content", "rep")
    for salt in range(64):
        numbered = apart.withColumn("node", F.xxhash64(F.lit(salt), "content"))
        found = stored(plain.unionByName(numbered), "classes")
        if found.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            break
    else:
        raise RuntimeError("no salt keeps the nodes apart")
    own = known.join(several, "doc_id", "left_semi").select("doc_id", "content").distinct()
    own = own.join(found.select("content", "node"), "content")
    first = own.groupBy("doc_id").agg(F.min("node").alias("a"))
    return found, stored(own.join(first, "doc_id").select("a", F.col("node").alias("b")).where("a != b").distinct(), "same-id")


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
    coordinates: int = COORDINATES,
    matches: int = MATCHES,
) -> DataFrame:
    """Every row with its component of documents linked by near-equal shingle sets.

    A-Z is lower-cased; a document's set holds its distinct shingles of ``size`` words, or all its
    words as one shingle where they are fewer. Two documents are linked if the sets' intersection
    is ``percent`` % of their union or more. Returns doc_id, n_shingles, component_id (the smallest
    id reachable, itself included) and kept (doc_id = component_id).

    1. Documents with equal sets are one from here on: the smallest id stands for them.
    2. Each posts its signature's values; lists of one document are of no use. Two documents that
       share ``matches`` values share one among the ``coordinates - matches + 1`` rarest of either
       (prefix), so only these are posted; the frequent ones are skipped and looked up for
       candidates alone. A passage in very many documents thus makes long lists only of documents
       that consist mostly of such passages.
    3. In each list all are compared with one pivot, the member with the most frequent values.
       Candidates that share enough values are confirmed on the full sets; only the sets of such
       candidates are shuffled.
    4. Links make components. Lists that still hold several components compare the members outside
       their largest component with those of other components, unless what the two sets can share
       at most (their rare shingles in common, and the smaller number of others) is too little.
       That bound is exact, so no link between components is lost. A copy with enough words of
       its own to miss the pivot has too little left for any other copy, so a large group of near
       copies does not expand into its pairs.

    Documents without words or text are linked with nothing. Rows with a null id take no part:
    they keep a null component and are kept. Rows that share an id are one document in the graph,
    whose links are those of all its texts.
    An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stored(rows.mapInArrow(_signer(size, coordinates), SIGNED), "signed")

    known = signed.where("doc_id is not null and content is not null")
    classes, same_id = _classes(known)
    if same_id is None:
        reps = known.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
        reps = reps.withColumn("node", F.col("doc_id"))
    else:
        ids = classes.select("content", F.col("rep").alias("doc_id"), "node")
        reps = known.join(ids, ["doc_id", "content"]).dropDuplicates(["node"])
    reps = reps.select(F.col("node").alias("rep"), F.col("n_shingles").alias("n"), "signature")

    posted = reps.select("rep", "n", F.explode("signature").alias("value"))
    often = posted.groupBy("value").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = posted.join(often, "value").groupBy("rep").agg(
        F.first("n").alias("n"),
        F.sort_array(F.collect_list(F.struct("often", "value"))).alias("values"),
        F.sum("often").alias("weight"),
    )
    # values that no other document has are the rarest and come first in the prefix
    room = F.lit(coordinates - matches + 1 - coordinates) + F.size("values")
    lists = shared.where(room > 0).select(
        "rep", "n", "weight", F.explode(F.slice("values", F.lit(1), room)).alias("entry")
    )
    lists = stored(lists.select("rep", "n", "weight", F.col("entry.value").alias("value")), "lists")

    in_lists = lists.select("rep").distinct()
    told = in_lists.join(classes.select("content", F.col("rep").alias("doc_id"), F.col("node").alias("rep")), "rep")
    asked = in_lists.select(F.col("rep").alias("doc_id")) if same_id is None else told.select("doc_id").distinct()
    # so few ids go to every task instead of all texts going through a shuffle
    sent = F.broadcast(asked) if asked.count() <= SENT_IDS else asked
    near = rows.join(sent, "doc_id", "left_semi").mapInArrow(_setter(size), SETS)
    if same_id is None:
        near = near.select(F.col("doc_id").alias("rep"), "shingles")
    else:
        near = near.join(told, ["doc_id", "content"]).select("rep", "shingles").dropDuplicates(["rep"])
    sets = stored(near, "sets")
    signs = reps.join(in_lists, "rep", "left_semi").dropDuplicates(["rep"])
    # values that agree have hashes that do; a pair too many is told by the sets
    signs = stored(signs.select("rep", F.transform("signature", lambda v: F.hash(v)).alias("signature")), "signs")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Of the pairs a < b with sizes na, nb those that are linked."""
        sa = signs.select(F.col("rep").alias("a"), F.col("signature").alias("sa"))
        sb = signs.select(F.col("rep").alias("b"), F.col("signature").alias("sb"))
        agree = F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda same: same)
        likely = F.size(agree) >= matches
        few = stored(pairs.join(sa, "a").join(sb, "b").where(likely).select("a", "b"), "likely")
        ids = few.select(F.col("a").alias("rep")).unionByName(few.select(F.col("b").alias("rep"))).distinct()
        # only the sets of these are shuffled
        near = sets.join(F.broadcast(ids) if ids.count() <= SENT_IDS else ids, "rep", "left_semi")
        ta = near.select(F.col("rep").alias("a"), F.col("shingles").alias("ta"))
        tb = near.select(F.col("rep").alias("b"), F.col("shingles").alias("tb"))
        both = few.join(ta, "a").join(tb, "b")
        both = both.withColumn("common", F.size(F.array_intersect("ta", "tb")))
        union = F.size("ta") + F.size("tb") - F.col("common")
        return both.where(F.col("common") * 100 >= union * percent).select("a", "b")

    def ordered(x: str, y: str) -> list:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    def similar_size(x: str, y: str):
        return F.least(x, y) * 100 >= F.greatest(x, y) * percent

    pivots = lists.groupBy("value").agg(
        F.max(F.struct("weight", F.bitwise_not("rep").alias("inverted"), "n")).alias("best")
    )
    pivots = pivots.select(
        "value", F.bitwise_not("best.inverted").alias("pivot"), F.col("best.n").alias("pivot_n")
    )
    stars = lists.join(pivots, "value").where((F.col("rep") != F.col("pivot")) & similar_size("n", "pivot_n"))
    links = stored(confirmed(stars.select(*ordered("rep", "pivot")).distinct()), "star-links")

    groups = components(links)
    held = lists.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    held = stored(held.withColumn("component", F.coalesce("component", "rep")), "held")
    counted = held.groupBy("value", "component").agg(F.count(F.lit(1)).alias("members"))
    largest = counted.groupBy("value").agg(
        F.max(F.struct("members", "component")).alias("top"), F.count(F.lit(1)).alias("parts")
    )
    largest = largest.where("parts > 1").select("value", F.col("top.component").alias("main"))
    left_over = stored(held.join(largest, "value").drop("weight"), "left-over")
    bounds = _bounds(sets, left_over.select("rep").distinct())
    able = (F.col("common") + F.col("n_rare")) * 100 >= F.col("n") * percent
    left_over = left_over.join(bounds, "rep").where(able).drop("n_rare")
    outside = left_over.where("component != main").select(
        "value", *[F.col(c).alias(f"x_{c}") for c in ("rep", "n", "component", "common", "rare", "lost")]
    )
    # what two sets share is at most their common rare shingles, of which one hash may stand for
    # several, and the smaller rest
    shared_most = F.least("common", "x_common") + F.least("lost", "x_lost") + F.size(F.array_intersect("rare", "x_rare"))
    across = left_over.join(outside, "value").where(
        (F.col("component") != F.col("x_component"))
        & ((F.col("component") == F.col("main")) | (F.col("rep") < F.col("x_rep")))
        & similar_size("n", "x_n")
        & (shared_most * 100 >= (F.col("n") + F.col("x_n") - shared_most) * percent)
    )
    across = across.select(*ordered("rep", "x_rep")).distinct()
    more = stored(confirmed(across), "cross-links")
    if same_id is not None:
        more = more.unionByName(same_id)
    if not more.isEmpty():
        groups = components(links.unionByName(more))

    labels = classes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    if same_id is not None:
        # a node may be no id; the component's name is the smallest one
        least = labels.groupBy("component").agg(F.min("rep").alias("least"))
        labels = labels.join(least, "component").withColumn("component", F.col("least"))
    labels = labels.select("content", "component")
    found = signed.join(labels, "content", "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), F.col("doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
