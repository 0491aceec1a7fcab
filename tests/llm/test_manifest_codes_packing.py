from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pursewatch.llm import merkle, packing, queries, vector_codes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# ---- Merkle manifest


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, n_chars):
    i, text, lang, source, _ = row
    told = [i, source, lang, n_chars, text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in told))


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def brute_manifest(rows):
    trees = defaultdict(list)
    for r in rows:
        trees[r[2]].append(r)
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    own = {}
    for t in names:
        trees[t].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[4])))
        own[t] = levels([leaf_of(r, r[4]) for r in trees[t]])
    over = levels([own[t][-1][0] for t in names])
    found = []
    for k, t in enumerate(names):
        for p, r in enumerate(trees[t]):
            n = r[4]
            if r[0] is not None and n is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                n += 1
            acc, beside = leaf_of(r, n), ""
            for tree, i in ((own[t], p), (over, k)):
                for level in tree[:-1]:
                    j = i ^ 1
                    other = level[j] if j < len(level) else ""
                    acc = h(other + acc if i & 1 else acc + other)
                    beside += other
                    i >>= 1
            root = over[-1][0]
            found.append((r[0], own[t][0][p], own[t][-1][0], root, h(beside), acc, acc == root))
    return Counter(found)


def manifest_rows(n=300):
    r = random.Random(5)
    langs = ["en"] * 6 + ["de", "é", "z", None, ""]
    rows = [(i * 3 - 20, f"text {i} é" * r.randrange(3), r.choice(langs), r.choice(["a", None]), r.choice([None, i])) for i in range(n)]
    rows += [(None, "no id", "en", "a", 3), (None, None, None, None, None), (7, None, "alone", "x", 9)]
    rows += [rows[0], rows[0], (rows[0][0], "other text", *rows[0][2:])]
    return rows + [(10_000, "x " * 200_000, "en", "a", 400_000)]


def op11(spark, frame, tmp_path):
    frame.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    return queries.op11_merkle_manifest(spark, str(tmp_path))


def test_manifest_matches_brute_force(spark, tmp_path):
    rows = manifest_rows()
    # names that the operator uses inside
    frame = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("tree", "digest", "position", "kept", "block")})
    found = op11(spark, frame.repartition(5), tmp_path).collect()
    assert Counter(tuple(r) for r in found) == brute_manifest(rows)
    tampered = [r for r in found if not r.verified]
    assert 0 < len(tampered) < len(rows) / 4


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", "s", 1)], [(1, "a", None, "s", 1), (2, "a", "en", "s", 1)]])
def test_manifest_of_few_rows(spark, tmp_path, rows):
    found = op11(spark, spark.createDataFrame(rows, DOCS), tmp_path)
    assert Counter(tuple(r) for r in found.collect()) == brute_manifest(rows)


def test_partitions_lower_than_the_tree_and_proofs_of_some_leaves(spark):
    rows = [(i, f"t{i}", "en" if i % 3 else None, "s", i) for i in range(200)]
    manifest = merkle.build(spark.createDataFrame(rows, DOCS), queries.LEAF_FIELDS, "lang", "doc_id", height=2)
    wanted = manifest.trees.leaves.where("id % 7 = 0 or id < 5")
    proved = merkle.prove(manifest, wanted)
    found = proved.withColumn("folded", merkle.fold(F.col("digest"), F.col("proof"))).collect()
    assert sorted(r.id for r in found) == sorted(i for i in range(200) if i % 7 == 0 or i < 5)
    assert {r.folded for r in found} == {manifest.root}
    want = {r[0]: r[4] for r in brute_manifest(rows)}
    assert all(h("".join(s.digest or "" for s in r.proof)) == want[r.id] for r in found)


def test_missing_nodes_are_the_smallest_set():
    """No node is asked for that another one or a leaf tells, and none that is needed is left out."""
    r = random.Random(1)
    for _ in range(200):
        n = r.randrange(1, 60)
        places = sorted(r.sample(range(n), r.randrange(1, n + 1)))
        asked = {(k, int(i)) for k, at in merkle.missing(np.array(places), n) for i in at}
        derived = {(0, p) for p in places}
        needed, size, level, at = set(), n, 0, set(places)
        while size > 1:
            needed |= {(level, p ^ 1) for p in at if p ^ 1 < size}
            at = {p >> 1 for p in at}
            size, level = (size + 1) // 2, level + 1
            derived |= {(level, p) for p in at}
        assert asked == needed - derived


# ---- vector codes


def brute_codes(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return Counter()
    length = max(len(r[1]) for r in kept)
    width = -(-length // parts)
    whole = []
    for r in kept:
        x = [math.floor(float(np.float32(v)) * 4096) for v in r[1]]
        whole.append(x + [0] * (width * parts - len(x)))
    cut = [[x[k * width : (k + 1) * width] for k in range(parts)] for x in whole]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[cut[i][k] for i in first] for k in range(parts)]

    def best(p, book):
        return min((sum((a - b) ** 2 for a, b in zip(p, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            own = defaultdict(list)
            for x in cut:
                own[best(x[k], books[k])[1]].append(x[k])
            for j, of in own.items():
                books[k][j] = [sum(v) // len(of) for v in zip(*of, strict=True)]
    told = [[best(x[k], books[k]) for k in range(parts)] for x in cut]
    error = [sum(d for d, _ in t) for t in told]
    by_label = defaultdict(int)
    for r, e in zip(kept, error, strict=True):
        by_label[r[2]] += e
    digest = h(",".join(str(v) for b in books for e in b for v in e))
    return Counter(
        (r[0], "".join(f"{j:02x}" for _, j in t), e, by_label[r[2]], digest) for r, t, e in zip(kept, told, error, strict=True)
    )


VECTORS = "vec_id long, embedding array<float>, label int"


def op12(spark, frame, tmp_path):
    frame.write.mode("overwrite").parquet(str(tmp_path / "embeddings.parquet"))
    return Counter(tuple(r) for r in queries.op12_vector_codes(spark, str(tmp_path)).collect())


def vector_rows(width=24, n=120):
    r = random.Random(8)
    rows = [(n - i, [round(r.gauss(i % 3, 1), 2) for _ in range(width)], r.choice([1, 2, None])) for i in range(n)]
    rows += [(500 + i, rows[3][1], 3) for i in range(40)]
    rows += [rows[0], rows[0], (None, rows[5][1], 1), (0, [0.0] * width, 1), (-1, [0.0] * width, 1)]
    inf, nan = float("inf"), float("nan")
    odd = [None, [inf] * width, [nan] + [0.0] * (width - 1), [0.0] * (width - 1) + [-inf], [None] * width]
    return rows + [(600 + i, v, 1) for i, v in enumerate(odd)]


def test_codes_match_brute_force(spark, tmp_path):
    rows = vector_rows()
    frame = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(1) for c in ("id", "vector", "code", "error", "of")})
    assert op12(spark, frame.repartition(4), tmp_path) == brute_codes(rows)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, None, 1), (2, [float("nan")] * 8, None)],
        [(2, [0.5] * 8, None), (1, [0.25] * 8, None)],
        [(1, [], 1), (2, [], 1)],
        [(3, [1.0, 2.0, 3.0], 1), (1, [], 1), (2, [-1.0] * 13, 2)],
    ],
    ids=["empty", "none usable", "two", "no components", "unlike lengths"],
)
def test_codes_of_few_vectors(spark, tmp_path, rows):
    assert op12(spark, spark.createDataFrame(rows, VECTORS), tmp_path) == brute_codes(rows)


def test_components_beyond_exact_distances_are_refused(spark):
    frame = spark.createDataFrame([(1, [3e38] * 8, 1)], VECTORS)
    with pytest.raises(Exception, match="do not fit"):
        vector_codes.compress(frame)


def test_transform_keeps_distances_and_order():
    r = np.random.default_rng(4)
    for width in (1, 2, 3, 8, 13, 16):
        x, y = r.integers(-(10**6), 10**6, (2, 50, width))
        a, b = vector_codes.walsh_hadamard(x), vector_codes.walsh_hadamard(y)
        size = a.shape[1]
        assert (((a - b) ** 2).sum(axis=1) == size * ((x - y) ** 2).sum(axis=1)).all()
        rows = vector_codes.walsh_hadamard(np.eye(size, dtype=np.int64)).T
        assert [int((np.diff(row) != 0).sum()) for row in rows] == list(range(size))


def test_nearest_takes_the_first_of_ties_and_the_largest_values():
    r = np.random.default_rng(6)
    for width in (1, 3, 8):
        points, entries = r.integers(-3, 4, (400, width)), r.integers(-3, 4, (16, width))
        entry, distance = vector_codes.nearest(points, entries)
        full = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (entry == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
        most = vector_codes.largest(width)
        ends = np.array([[most] * width, [-most] * width])
        entry, distance = vector_codes.nearest(ends, ends[::-1])
        assert entry.tolist() == [1, 0] and distance.tolist() == [0, 0]
        assert vector_codes.nearest(ends[:1], ends[1:])[1].tolist() == [width * (2 * most) ** 2]


def test_codes_lead_back_to_entries(spark):
    rows = vector_rows(16, 40)
    found, books = vector_codes.compress(spark.createDataFrame(rows, VECTORS))
    back = {r.id: r for r in vector_codes.decode(found, books).collect()}
    given = {i: v for i, v, _ in rows if v is not None}
    for i in (1, 20, 40):
        whole = np.floor(np.array(given[i], np.float32).astype(float) * 4096)
        assert back[i].error == ((whole - np.array(back[i].vector) * 4096) ** 2).sum()


# ---- packing


def test_plan_is_best_fit_decreasing():
    r = random.Random(1)
    for _ in range(150):
        length = r.choice([1, 10, 37, 64])
        counts = {r.randrange(1, length + 1): r.randrange(30) for _ in range(r.randrange(25))}
        rooms = []
        for size in sorted(counts, reverse=True):
            for _ in range(counts[size]):
                fits = [b for b in range(len(rooms)) if rooms[b] >= size]
                if fits:
                    rooms[min(fits, key=lambda b: rooms[b])] -= size
                else:
                    rooms.append(length - size)
        steps, n = packing.plan(counts, length)
        ranks, filled = defaultdict(list), defaultdict(list)
        for size, a, b, sequence, offset, each in steps.tolist():
            ranks[size] += range(a, b)
            for k in range(b - a):
                filled[sequence + k // each].append((offset + k % each * size, size))
        assert {s: sorted(k) for s, k in ranks.items()} == {s: list(range(c)) for s, c in counts.items() if c}
        for inside in filled.values():
            at = 0
            for offset, size in sorted(inside):
                assert offset == at
                at += size
        left = sorted(length - sum(s for _, s in inside) for inside in filled.values())
        assert sorted(filled) == list(range(n)) and left == sorted(rooms)


def test_plan_grows_with_lengths_and_not_with_counts():
    few = {size: 10 + size % 7 for size in range(1, 4097)}
    steps, n = packing.plan({s: c * 10**9 + 1 for s, c in few.items()})
    assert len(steps) < 40_000
    total = sum(s * (c * 10**9 + 1) for s, c in few.items())
    assert n - -(-total // 4096) < n * 0.001


@pytest.fixture(scope="module")
def vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path(queries.VOCABULARY)


ODD = [
    "", None, "  \n\t", "İstanbul ΑΣ ΑΣ. ΟΔΟΣ", "á ́b", "<|endoftext|> a<|startoftext|>b", "don't we'll 'S 12345 x's",
    "日本語 テスト", "a\x1cb\x85c​d e", "x" * 9_000, "🙂🙂 ok", "﻿abc \x00 d", "word " * 30_000, "gleich gleich",
]


def test_tokens_by_words_are_those_of_whole_texts(vocabulary):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary)
    ids, starts = packing.WordTokens(vocabulary)(pa.array(ODD, pa.string()))
    for k, text in enumerate(ODD):
        assert ids[starts[k] : starts[k + 1]].tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_packing_round_trip(spark, vocabulary):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary)
    r = random.Random(3)
    texts = ODD + [" ".join(r.choice(["alpha", "beta", "42", "straße"]) for _ in range(r.randrange(200))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, texts[3]), (3, "other")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.withColumns({c: F.lit(1) for c in ("piece", "length", "task", "nth", "rank", "sequence_id")}).repartition(6)
    packed = packing.pack(frame, vocabulary, length=512)
    found = packed.collect()

    want = Counter()
    for i, text in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k, a in enumerate(range(0, len(ids), 512)):
            raw = ids[a : a + 512].tobytes()
            want[i, k, a, len(raw) // 4, zlib.crc32(raw), raw] += 1
    assert Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32, bytes(p.ids)) for p in found) == want

    inside = defaultdict(list)
    for p in found:
        inside[p.sequence_id].append((p.offset, p.length))
    for own in inside.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 512
    total = sum(p.length for p in found)
    assert len(inside) <= -(-total // 512) + 1

    made = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for p in found:
        ids = bytes(made[p.sequence_id].ids)
        assert ids[4 * p.offset : 4 * (p.offset + p.length)] == bytes(p.ids)
        assert len(ids) == 4 * made[p.sequence_id].n_tokens


def test_packing_of_no_rows_and_of_one_length(spark, vocabulary):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), vocabulary).collect() == []
    same = spark.createDataFrame([(i, "one two three") for i in range(2_000)], "doc_id long, text string")
    found = packing.pack(same.repartition(7), vocabulary, length=10, with_ids=False).collect()
    places = {(p.sequence_id, p.offset) for p in found}
    assert places == {(k, o) for k in range(1_000) for o in (0, 4)}
    assert {p.ids for p in found} == {None}
