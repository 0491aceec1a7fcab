"""Document quality from a conditional random field over the lines of a document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pursewatch.llm import words
from pursewatch.llm.common import key60

#: Texts are worked on in slices of about so many bytes: workers live on and keep the room once taken.
SLICE_BYTES = 1 << 20

#: Documents that the model is fitted on at most: the labelled ones with the smallest hashes.
SAMPLE = 4_000
#: Lines of a document that it is fitted on at most: a run of that many, which begins where a hash
#: of the document's id says.
LINES = 1_000

FEATURES = (
    "upper", "digit", "sentence_mark", "other_mark", "symbol", "space", "log_length", "word_length",
    "same_as_last_word", "same_as_word_before_last", "marked_words", "starts_upper", "ends_sentence",
    "repeated_line", "empty",
)
#: The features that also count for the lines next to a line.
NEAR = ("upper", "symbol", "other_mark", "same_as_last_word", "marked_words", "repeated_line")

_KIND = np.zeros(256, np.uint8)  # of a UTF-8 byte
for _bytes, _kind in (
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1),
    (b"0123456789", 2),
    (b".,;:?'\"-", 3),
    (b"!()[]/", 4),
    (b"#$%&*+<=>@\\^_`{|}~", 5),
    (b" \t\r\x0b\x0c", 6),
):
    _KIND[list(_bytes)] = _kind


def _texts(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(total[starts])


def line_features(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of features per line, each line's share of bytes, and where each text's lines start."""
    lists = pc.split_pattern(_texts(column), "\n")
    at = lists.offsets.to_numpy().astype(np.int64)
    lines = pa.concat_arrays([lists.values[at[0] : at[-1]]])
    at = at - at[0]
    n = len(lines)
    ends = np.frombuffer(lines.buffers()[1], np.int64, n + 1 + lines.offset)[lines.offset :]
    data = lines.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    size = np.diff(ends)
    kind = _KIND[raw]
    upper, digit, sentence, other, symbol, space = (_sums(kind == k, ends) for k in range(1, 7))
    # capitals and letters beyond ASCII: the second byte of U+00C0 to U+00DE
    late = np.zeros(len(raw), bool)
    late[1:] = (raw[:-1] == 0xC3) & (raw[1:] < 0x9F)
    upper = upper + _sums(late, ends)

    found, starts = words.split(lines)
    coded = found.dictionary_encode()
    code = coded.indices.to_numpy() if len(found) else np.zeros(0, np.int32)
    marks = np.array([not w[-1].isalnum() and w[-1] not in ".,;:?" for w in coded.dictionary.to_pylist()], bool)
    again, before = np.zeros(len(code), bool), np.zeros(len(code), bool)
    again[1:] = code[1:] == code[:-1]
    before[2:] = code[2:] == code[:-2]
    inner = starts[:-1][np.diff(starts) > 0]
    again[inner] = before[inner] = False
    before[(inner + 1)[inner + 1 < len(code)]] = False
    count = np.diff(starts)
    per_word = np.maximum(count, 1)

    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    same = lines.dictionary_encode().indices.to_numpy()
    order = np.lexsort((np.arange(n), same, doc))
    repeated = np.zeros(n, bool)
    repeated[order[1:]] = (same[order[1:]] == same[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    repeated &= count > 0
    first = np.zeros(n, bool)
    last = np.zeros(n, bool)
    full = size > 0
    first[full] = (kind[ends[:-1][full]] == 1) | (raw[ends[:-1][full]] == 0xC3)
    last[full] = np.isin(raw[ends[1:][full] - 1], list(b".?:"))

    length = np.maximum(size, 1)
    table = np.column_stack(
        [
            *(v / length for v in (upper, digit, sentence, other, symbol, space)),
            np.log1p(size) / 5,
            (size - space) / per_word / 10,
            _sums(again, starts) / per_word,
            _sums(before, starts) / per_word,
            (_sums(marks[code], starts) if len(code) else np.zeros(n)) / per_word,
            first,
            last,
            repeated,
            count == 0,
        ]
    )
    return table, np.maximum(size, 1).astype(float), at


def with_neighbours(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines next to it, and a constant."""
    near = table[:, [FEATURES.index(f) for f in NEAR]]
    prior, following = np.zeros_like(near), np.zeros_like(near)
    prior[1:], following[:-1] = near[:-1], near[1:]
    starts = at[:-1][np.diff(at) > 0]
    prior[starts] = 0
    following[np.append(starts[1:], len(table)) - 1 if len(starts) else []] = 0
    return np.hstack([table, prior, following, np.ones((len(table), 1))])


def _scan(matrix: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Products of 2x2 matrices from each chain's start to each place, scaled; by doubling."""
    step, longest = 1, int(place.max(initial=0))
    out = matrix / matrix.max(axis=(1, 2), keepdims=True)
    while step <= longest:
        inside = np.flatnonzero(place >= step)
        joined = out[inside] @ out[inside - step]
        out = out.copy()
        out[inside] = joined / joined.max(axis=(1, 2), keepdims=True)
        step *= 2
    return out


def marginals(
    scores: np.ndarray, pair: np.ndarray, at: np.ndarray, share: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """For chains of two states: the marginal of each line's state, and the expected moves.

    ``scores`` holds a line's log potentials, ``pair`` those of a move from state to state,
    ``share`` what a line's move counts.
    """
    n = len(scores)
    if not n:
        return np.zeros((0, 2)), np.zeros((2, 2))
    place = np.arange(n) - np.repeat(at[:-1], np.diff(at))
    length = np.repeat(np.diff(at), np.diff(at))
    own = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(pair - pair.max())
    forward = own[:, :, None] * move.T[None]  # to x from
    start = place == 0
    forward[start] = own[start][:, :, None] * np.array([1.0, 0.0])[None, None]
    alpha = _scan(forward, place)[:, :, 0]
    alpha = alpha / alpha.sum(axis=1, keepdims=True)
    backward = np.broadcast_to(np.eye(2), (n, 2, 2)).copy()
    inside = np.flatnonzero(place + 1 < length)
    backward[inside] = move[None] * own[inside + 1][:, None, :]
    beta = _scan(backward[::-1], (length - 1 - place)[::-1])[::-1].sum(axis=2)
    beta = beta / beta.sum(axis=1, keepdims=True)
    state = alpha * beta
    state = state / state.sum(axis=1, keepdims=True)
    both = alpha[inside][:, :, None] * move[None] * (own[inside + 1] * beta[inside + 1])[:, None, :]
    both = both / both.sum(axis=(1, 2), keepdims=True)
    if share is not None:
        both = both * share[inside][:, None, None]
    return state, both.sum(axis=0)


@dataclass
class LineModel:
    """Weights of the line states (bad, good), their moves, and the calibration of documents."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    pair: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def line_marginals(self, table: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Probability that each line is good."""
        x = (with_neighbours(table, at) - self.mean) / self.scale
        good = x @ self.weight
        return marginals(np.column_stack([np.zeros(len(good)), good]), self.pair, at)[0][:, 1]

    def raw(self, table: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Mean marginal of a document's lines, weighted by their lengths."""
        good = self.line_marginals(table, at)
        total = np.concatenate([[0], np.cumsum(good * size)])
        return np.diff(total[at]) / np.diff(np.concatenate([[0], np.cumsum(size)])[at])

    def score(self, column: pa.Array | pa.ChunkedArray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.raw(*line_features(column)) + self.shift)))


def _ascend(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Adam on a concave function's gradient."""
    x, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(x)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return x


def fit(
    table: np.ndarray, size: np.ndarray, at: np.ndarray, quality: list[int], rounds: int = 3, steps: int = 100
) -> LineModel:
    """A model from the line features of documents with labels 0 or 1.

    Lines start with their document's label. After each round, lines of bad documents that the
    model holds good become good, but for the worst line of each, so that a bad document may have
    good lines; then weights are fitted again. A logistic curve maps the documents' mean marginals
    to probabilities. Without documents every score is 0.5.
    """
    d = len(FEATURES) + 2 * len(NEAR) + 1
    if not quality:
        return LineModel(np.zeros(d), np.ones(d), np.zeros(d), np.zeros((2, 2)), 0.0, 0.0)
    label = np.array(quality, float)
    x = with_neighbours(table, at)
    doc = np.repeat(np.arange(len(label)), np.diff(at))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    mean[-1], scale[-1] = 0.0, 1.0
    x = (x - mean) / scale
    state = label[doc]
    theta = np.zeros(d + 4)
    n = len(x)
    # a document counts as much as any other, however many lines it has
    share = 1 / np.diff(at)[doc] / len(label)

    for _ in range(rounds):
        inside = np.flatnonzero(doc[1:] == doc[:-1])
        moves = np.zeros((2, 2))
        np.add.at(moves, (state[inside].astype(int), state[inside + 1].astype(int)), share[inside])

        def gradient(theta: np.ndarray, state=state, moves=moves) -> np.ndarray:
            good = x @ theta[:d]
            scores = np.column_stack([np.zeros(n), good])
            p, expected = marginals(scores, theta[d:].reshape(2, 2), at, share)
            return np.concatenate([x.T @ ((state - p[:, 1]) * share), (moves - expected).ravel()]) - 1e-4 * theta

        theta = _ascend(gradient, theta, steps, 0.1)
        good = x @ theta[:d]
        p = marginals(np.column_stack([np.zeros(n), good]), theta[d:].reshape(2, 2), at)[0][:, 1]
        lowest = np.full(len(label), np.inf)
        np.minimum.at(lowest, doc, p)
        state = np.where(label[doc] == 1, 1.0, ((p > 0.5) & (p > lowest[doc])).astype(float))
    model = LineModel(mean, scale, theta[:d], theta[d:].reshape(2, 2))
    raw = model.raw(table, size, at)

    def curve(ab: np.ndarray) -> np.ndarray:
        miss = label - 1 / (1 + np.exp(-(ab[0] * raw + ab[1])))
        return np.array([(miss * raw).mean(), miss.mean()]) - 1e-4 * ab

    model.slope, model.shift = _ascend(curve, np.array([8.0, -4.0]), 600, 0.1)
    return model


def _run_of_lines(ids: list[int], at: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Which lines of documents of many stay, all of the others', and where each one's then start."""
    count = np.diff(at)
    spare = np.maximum(count - most, 0)
    first = at[:-1] + np.array([words.xxhash.xxh64_intdigest(str(i)) % (int(s) + 1) for i, s in zip(ids, spare, strict=True)], np.int64)
    kept = count - spare
    until = np.concatenate([[0], np.cumsum(kept)])
    return np.arange(until[-1]) - np.repeat(until[:-1] - first, kept), until


def _featurer(most: int):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text", SLICE_BYTES):
                table, size, at = line_features(part.column("text"))
                lines, at = _run_of_lines(part.column("doc_id").to_pylist(), at, most)
                wide = pa.array((at * len(FEATURES)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("label"),
                        pa.ListArray.from_arrays(wide, pa.array(table[lines].ravel())),
                        pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(size[lines])),
                    ],
                    ["doc_id", "label", "features", "size"],
                )

    return features


def fit_on(docs: DataFrame, labels: DataFrame, learnt: Column, most: int = SAMPLE, lines: int = LINES) -> LineModel:
    """A model from the labelled documents where ``learnt`` (an expression of doc_id) holds.

    At most ``most`` labels are used (the bound on the sample, whose line features go to the
    driver), those with the smallest hash of their id; of several labels
    of one id the smallest counts. Labels other than 0 and 1 and null ids are left out. The chosen
    ids and labels, ``most`` at most, are broadcast; features are taken from whole texts, then at
    most ``lines`` lines of a document, a run of them, are learnt from: so what reaches the driver
    has a bound, whatever the texts. Of several texts of one id the first by text counts. Without
    labels, or without their documents, every score is 0.5.
    """
    chosen = (
        labels.where(learnt & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"))
        .orderBy(key60(F.col("doc_id")), "doc_id")
        .limit(most)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    schema = "doc_id long, label int, features array<double>, size array<double>"
    found = rows.mapInArrow(_featurer(lines), schema).toArrow().combine_chunks()
    found = found.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    sizes = found.column("size").combine_chunks()
    at = sizes.offsets.to_numpy().astype(np.int64)
    table = found.column("features").combine_chunks().values.to_numpy().reshape(-1, len(FEATURES))
    return fit(table, sizes.values.to_numpy(), at, found.column("label").to_pylist())


def score_quality(
    docs: DataFrame, model: LineModel, text_col: str = "text", out: str = "quality_score"
) -> DataFrame:
    """The rows with a column ``out``, 0 to 1, over their whole texts.

    Every line is good or bad with the marginal probability that forward and backward passes over
    the document's lines give it; these are averaged by the lines' lengths and calibrated. Nothing
    is shuffled. A null or empty text is one empty line. A column of that name is replaced.
    """
    rows = docs.drop(out)
    schema = T.StructType(
        [*(T.StructField(f.name, f.dataType) for f in rows.schema), T.StructField(out, T.DoubleType())]
    )
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, text_col, SLICE_BYTES):
                found = pa.array(sent.value.score(part.column(text_col)))
                yield part.append_column(out, found)

    return rows.mapInArrow(run, schema)
