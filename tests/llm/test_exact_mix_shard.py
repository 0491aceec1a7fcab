from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from pathlib import Path

from pyspark.sql import functions as F

from pursewatch.llm import common, exact_dedup, mixing, sharding

DOCS = "doc_id long, text string, source string, n_chars long"


def docs(spark, rows, schema=DOCS):
    return spark.createDataFrame([(*r, *[None] * (4 - len(r))) for r in rows], schema)


# ---- exact duplicates


def brute_exact(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), i is None, i or 0, i))
    out = []
    for i, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        keep = min(groups[body])[3]
        out.append((i, keep, len(groups[body]), i == keep, hashlib.sha256(body.encode()).hexdigest()))
    return Counter(out)


CASES = [
    (1, "a b c"), (2, "abc"), (3, "a  b c"), (4, None), (5, ""), (6, " \t\n"), (7, "ab c"),
    (8, "abd"), (9, "é e"), (10, "éé"), (3, "a  b c"), (None, "abd"), (11, "x " * 50_000), (12, "x" * 50_000),
]


def test_exact_groups_match_brute_force(spark):
    found = exact_dedup.exact_dedup(docs(spark, CASES), salts=3)
    assert Counter(tuple(r) for r in found.collect()) == brute_exact(CASES)


def test_exact_compares_contents_of_one_digest(spark):
    """With a digest that clashes all the time, contents still decide."""
    weak = exact_dedup.exact_dedup(docs(spark, CASES), salts=2, digest=lambda c: F.char_length(c).cast("string"))
    got = Counter(tuple(r)[:4] for r in weak.collect())
    assert got == Counter({k[:4]: n for k, n in brute_exact(CASES).items()})


def test_exact_huge_group_and_clashing_columns(spark):
    rows = [(i, "same text") for i in range(900)] + [(1000 + i, f"own {i}") for i in range(100)]
    frame = docs(spark, rows).withColumns({"digest": F.lit(1), "salt": F.lit(2), "best": F.lit(3), "n": F.lit(4)})
    found = exact_dedup.exact_dedup(frame.repartition(7))
    assert Counter(tuple(r) for r in found.collect()) == brute_exact(rows)
    assert exact_dedup.exact_dedup(docs(spark, [])).count() == 0


# ---- sharding


def test_lookup_table_is_even_and_moves_little():
    shards = [f"s{k}" for k in range(7)]
    table = sharding.lookup_table(shards, 1009)
    share = Counter(table)
    assert len(table) == 1009 and max(share.values()) - min(share.values()) <= 1
    fewer = sharding.lookup_table(shards[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != 6)
    assert moved < 0.25 * 1009


def test_place_is_total_and_stable(spark, root):
    rows = [(i, None, "a") for i in range(500)] + [(None, "t", "a"), (7, "t", "b")]
    frame = docs(spark, rows).withColumns({"slot": F.lit("old"), "shard": F.lit("old"), "id": F.lit(0)})
    placed = sharding.place(frame, ["x", "y", "z"], size=101)
    got = placed.collect()
    assert len(got) == 502 and {r.shard for r in got} == {"x", "y", "z"}
    assert len({(r.doc_id, r.slot, r.shard) for r in got}) == 501
    table = sharding.lookup_table(["x", "y", "z"], 101)
    for r in got:
        key = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16)
        assert (r.slot, r.shard) == (key % 101, "xyz"[table[key % 101]])
    sharding.write_shards(placed, f"{root}/shards")
    back = spark.read.parquet(f"{root}/shards")
    assert back.count() == 502 and back.select("shard").distinct().count() == 3
    assert sharding.place(docs(spark, []), ["x"], size=3).count() == 0


# ---- mixing


def brute_targets(size, weights=(5, 2, 1), most=3):
    names = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(size.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > most * size[s]]
        if not above:
            return {**target, **share}
        for s in above:
            target[s] = float(most * size[s])
            left -= target[s]
            open_.discard(s)
    return target


def test_targets_and_exact_cut(spark):
    rows = [(i, " ".join(["w"] * (i % 9)), f"s{i % 4}") for i in range(400)]
    rows += [(1000, "only two", "tiny"), (1001, None, None), (1002, "a b c", None), (1003, "", "void"), (5, "w w", "s1")]
    frame = docs(spark, rows).withColumns({"key": F.lit(1), "size": F.lit(2), "range": F.lit(3), "of": F.lit(4)})
    got = mixing.mix(frame, keep=["source"], rows_per_range=30).collect()
    again = mixing.mix(frame.repartition(9), keep=["source"], rows_per_range=30).collect()
    assert Counter(map(str, got)) == Counter(map(str, again))
    assert len(got) == len(rows)
    size, taken = Counter(), Counter()
    for r in got:
        size[r.kept.source] += r.size
        taken[r.kept.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.epochs * r.size + r.part
    want = brute_targets(size)
    for r in got:
        assert abs(r.target - want[r.kept.source]) < 1e-6 and r.source_size == size[r.kept.source]
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in size)
    # one row at most is cut in a source, and rows are taken in the order of their keys
    cut = Counter(r.kept.source for r in got if 0 < r.part < r.size)
    assert max(cut.values(), default=0) <= 1


def test_mix_without_words_or_rows(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    got = mixing.mix(docs(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_mix_of_rows_alike_at_the_cut(spark):
    """Rows with one id and size are taken in the order of their texts, and reruns agree on that."""
    rows = [(None if s == "b" else 7, f"{s} {i:03d} z", s) for s in "ab" for i in range(40)] + [(8, "x " * 50, "c")]
    frame = docs(spark, rows)
    for seed in (3, 11):
        got = mixing.mix(frame.repartition(seed), keep=["text", "source"], rows_per_range=5).collect()
        assert Counter(r.kept.text for r in got) == Counter(t for _, t, _ in rows)
        for s in "abc":
            own = sorted((r for r in got if r.kept.source == s), key=lambda r: r.kept.text)
            rest = int(own[0].target + 0.5) % own[0].source_size
            assert rest, "the last round is cut"
            assert [r.part for r in own] == [max(0, min(r.size, rest - k * r.size)) for k, r in enumerate(own)]


def test_mix_neither_stores_nor_shuffles_what_it_keeps(spark, monkeypatch):
    rows = [(i, " ".join(hashlib.sha256(f"{i} {j}".encode()).hexdigest() for j in range(140 + i % 7)), f"s{i % 3}") for i in range(400)]
    size, paths = sum(len(t) for _, t, _ in rows), []
    path_of = common.scratch_path
    monkeypatch.setattr(common, "scratch_path", lambda *a: paths.append(path_of(*a)) or paths[-1])
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        found = (files.apply(k) for k in range(files.size()))
        return {f.getPath(): f.length() for f in found if f.getName().startswith("shuffle_")}

    frame = docs(spark, rows).repartition(4)
    stored = common.stored(frame, "texts")
    paths.clear()
    before = shuffled()
    got = mixing.mix(stored, keep=["text"], rows_per_range=30).collect()
    moved = sum(n for path, n in shuffled().items() if path not in before)
    kept = sum(p.stat().st_size for path in paths for p in Path(path).rglob("*.parquet"))
    assert {r.doc_id: r.kept.text for r in got} == {i: t for i, t, _ in rows}
    assert any(0 < r.part < r.size for r in got)
    assert paths and 0 < moved < size / 10 and kept < size / 10
