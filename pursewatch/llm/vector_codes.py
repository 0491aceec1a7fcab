"""Product codes of vectors in whole numbers, nearest entries found by Walsh-Hadamard transforms."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from pursewatch.llm.common import stored

#: A component becomes the whole number floor(SCALE * x).
SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors that a task holds as whole numbers at a time.
ROWS = 8_192


def sequency_order(size: int) -> np.ndarray:
    """Rows of the natural Hadamard matrix of a power of two by their number of sign changes."""
    nth = np.arange(size)
    gray = nth ^ (nth >> 1)
    # the gray code's bits in reverse order
    out = np.zeros(size, np.int64)
    bit = 1
    while bit < size:
        out = (out << 1) | ((gray & bit) > 0)
        bit <<= 1
    return out


def walsh_hadamard(x: np.ndarray) -> np.ndarray:
    """The transform of the last axis, padded with zeros to a power of two, in sequency order.

    In whole numbers, by sums and differences. The sum of squares becomes ``size`` times as large,
    so squared distances of transforms are the distances themselves in that scale.
    """
    size = 1
    while size < x.shape[-1]:
        size *= 2
    out = np.zeros((*x.shape[:-1], size), np.int64)
    out[..., : x.shape[-1]] = x
    half = 1
    while half < size:
        pairs = out.reshape(*x.shape[:-1], size // (2 * half), 2, half)
        a, b = pairs[..., 0, :].copy(), pairs[..., 1, :].copy()
        pairs[..., 0, :], pairs[..., 1, :] = a + b, a - b
        half *= 2
    return out[..., sequency_order(size)]


def largest(width: int) -> int:
    """The largest component whose scaled squared distances, over ``width`` of them, fit 64 bits.

    A difference is up to twice a component, a coefficient up to ``width`` times that, and all
    squares together up to ``size`` times the sum of the squared differences.
    """
    size = 1
    while size < width:
        size *= 2
    return int(((2**63 - 1) // (4 * size * max(width, 1))) ** 0.5) - 1


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each point its nearest entry, the first of equal ones, and the squared distance.

    Point and entry are transformed; squared differences are summed in sequency order, where
    most of a distance tends to come first. After a quarter of the coefficients the best entry so
    far is summed to the end, which bounds the answer; all others go on coefficient by coefficient
    and leave once their sum is above the bound. Sums only grow, so no nearest entry leaves, and
    all of it is whole numbers: ties are ties.
    """
    p, e = walsh_hadamard(points), walsh_hadamard(entries)
    size = p.shape[-1]
    head = max(1, size // 4)
    sums = np.zeros((len(p), len(e)), np.int64)
    for k in range(head):
        sums += (p[:, k, None] - e[None, :, k]) ** 2
    guess = sums.argmin(axis=1)
    row = np.arange(len(p))
    bound = sums[row, guess] + ((p[:, head:] - e[guess][:, head:]) ** 2).sum(axis=1)
    at, entry = np.nonzero(sums <= bound[:, None])
    left = sums[at, entry]
    for k in range(head, size):
        left = left + (p[at, k] - e[entry, k]) ** 2
        stay = left <= bound[at]
        at, entry, left = at[stay], entry[stay], left[stay]
    # pairs are in the order of (point, entry); the guess always stays, so every point has one
    order = np.lexsort((entry, left, at))
    at, entry, left = at[order], entry[order], left[order]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return entry[first], left[first] // size


@dataclass(frozen=True)
class Codebooks:
    """Whole-number entries by part, entry and component; ``length`` is that of the vectors, of
    which the last are zeros where the parts are longer."""

    entries: np.ndarray
    length: int

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    inf = F.lit(float("inf"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def _whole(column: pa.Array, length: int, parts: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Runs of rows as arrays (row, part, component) of whole numbers, shorter vectors padded by 0."""
    width = -(-length // parts)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    limit = largest(width)
    for a in range(0, len(column), ROWS):
        part = column.slice(a, ROWS)
        sizes = pc.list_value_length(part).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        scaled = np.floor(flat * SCALE)
        if len(scaled) and not np.abs(scaled).max() <= limit:
            raise ValueError(f"components above {limit / SCALE:g} do not fit 64-bit distances")
        out = np.zeros((len(part), width * parts), np.int64)
        row = np.repeat(np.arange(len(part)), sizes)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[row, place] = scaled
        yield a, a + len(part), out.reshape(len(part), parts, width)


def _summer(books: Codebooks, parts: int):
    """A task's sum and count per part, entry and component: all that leaves it."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = books.entries.shape[1]
        width = books.entries.shape[2]
        total = np.zeros((parts, n, width), np.int64)
        count = np.zeros((parts, n), np.int64)
        for batch in batches:
            for _, _, x in _whole(batch.column("vector"), books.length, parts):
                for k in range(parts):
                    entry, _ = nearest(x[:, k], books.entries[k])
                    np.add.at(total[k], entry, x[:, k])
                    count[k] += np.bincount(entry, minlength=n)
        part, entry, place = (i.ravel() for i in np.indices(total.shape))
        yield pa.RecordBatch.from_arrays(
            [pa.array(a) for a in (part, entry, place, total.ravel(), count[part, entry])],
            ["part", "entry", "place", "total", "held"],
        )

    return add


SUMS = "part long, entry long, place long, total long, held long"


def train(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> Codebooks | None:
    """Codebooks of the usable vectors' parts; None where there are none.

    The first ``entries`` vectors by id (null last, ties by the vector) give the entries; every
    round assigns all parts and moves each entry to the floor of its parts' mean, an unused one
    stays. Rounds end early once nothing moves. A task sends one sum per part, entry and
    component; the driver holds the codebooks alone.
    """
    rows = vectors.where(usable(F.col(vector_col))).select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    length = rows.agg(F.max(F.size("vector"))).first()[0]
    if length is None:
        return None
    first = rows.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    given = pa.array([r.vector for r in first], pa.list_(pa.float32() if kind == "float" else pa.float64()))
    seeds = np.concatenate([x for _, _, x in _whole(given, length, parts)])
    books = Codebooks(seeds.transpose(1, 0, 2).copy(), length)
    data = rows.select("vector")
    for _ in range(rounds):
        sums = data.mapInArrow(_summer(books, parts), SUMS).groupBy("part", "entry", "place")
        sums = sums.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("held").alias("held"))
        moved = books.entries.copy()
        # a row per component of the codebooks
        for r in sums.where("held > 0").collect():
            moved[r.part, r.entry, r.place] = int(r.total) // r.held
        if (moved == books.entries).all():
            break
        books = Codebooks(moved, length)
    return books


def encode(
    vectors: DataFrame, books: Codebooks, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label"
) -> DataFrame:
    """id, label, code and error of every usable vector.

    A code has two hex digits per part, the index of its nearest entry; the error is the sum of the
    parts' squared distances. Nothing is shuffled. Rows that are repeated are coded each.
    """
    label = F.col(label_col) if label_col else F.lit(None).cast("string")
    rows = vectors.where(usable(F.col(vector_col))).select(
        F.col(id_col).alias("id"), label.alias("label"), F.col(vector_col).alias("vector")
    )
    parts = len(books.entries)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, x in _whole(batch.column("vector"), books.length, parts):
                index = np.empty((len(x), parts), np.uint8)
                error = np.zeros(len(x), np.int64)
                for k in range(parts):
                    index[:, k], own = nearest(x[:, k], books.entries[k])
                    error += own
                text = [r.tobytes().hex() for r in index]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), batch.column("label").slice(a, b - a), pa.array(text, pa.string()), pa.array(error)],
                    ["id", "label", "code", "error"],
                )

    if books.entries.shape[1] > 256:
        raise ValueError("two hex digits tell 256 entries at most")
    schema = rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).schema
    return rows.mapInArrow(code, schema)


def decode(codes: DataFrame, books: Codebooks, code_col: str = "code", out: str = "vector") -> DataFrame:
    """The rows with the vector that each code stands for, in the scale of the input."""
    width = books.entries.shape[2]
    flat = (books.entries / SCALE).reshape(-1, width)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index = [list(bytes.fromhex(c or "")) for c in batch.column(code_col).to_pylist()]
            found = [
                np.concatenate([flat[k * books.entries.shape[1] + i] for k, i in enumerate(own)])[: books.length] if own else None
                for own in index
            ]
            yield batch.append_column(out, pa.array(found, pa.list_(pa.float64())))

    rows = codes.drop(out)
    return rows.mapInArrow(read, rows.withColumn(out, F.lit(None).cast("array<double>")).schema)


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, Codebooks | None]:
    """Codes of all usable vectors with their codebooks.

    Returned are id, label, code, error and label_error, the errors of one label added up, nulls
    together. Left out are null vectors and those with a null, NaN or infinite component.
    Components become floor(4096 x) exactly; those above ``largest`` of a part's width raise.
    Vectors are cut into equal parts, of the longest one's length rounded up; shorter ones count as
    padded with zeros, empty ones as zeros. An empty table gives no rows and no codebooks. Errors
    are folded per label before they meet, so a label may hold any share of the rows. Other
    columns are ignored.
    """
    kept = vectors.where(usable(F.col(vector_col))).select(id_col, label_col, vector_col)
    kept = stored(kept, "vectors")
    books = train(kept, parts, entries, rounds, id_col, vector_col)
    if books is None:
        none = kept.limit(0).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
        return none.select("id", "label", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")]), None
    codes = stored(encode(kept, books, id_col, vector_col, label_col), "codes")
    sums = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    found = codes.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")
    return found.select("id", "label", "code", "error", "label_error"), books
