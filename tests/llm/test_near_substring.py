from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pursewatch.llm import near_dedup, substring_dedup
from pursewatch.llm.components import components

SCHEMA = "doc_id long, text string"


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text, size):
    w = word_list("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}


def brute_near(rows, size, percent=80):
    sets = [shingle_set(t, size) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b in range(a):
            j = rows[b][0]
            if i is None or j is None or not sets[a] or not sets[b]:
                continue
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return Counter(
        (i, len(s), None if i is None else root(i), i is None or root(i) == i)
        for (i, _), s in zip(rows, sets, strict=True)
    )


def near_rows(seed, copies=40, others=40):
    """A base with edited copies, some chains of edits, unrelated texts and odd cases."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [r.choice(vocabulary) for _ in range(40)]
    base = [r.choice(vocabulary) for _ in range(120)]
    rows = []
    for _ in range(copies):
        text = list(base)
        for _ in range(r.randrange(6)):
            text[r.randrange(len(text))] = r.choice(vocabulary)
        rows.append(" ".join(text))
    drift = list(base)
    for _ in range(15):
        drift[r.randrange(len(drift))] = r.choice(vocabulary)
        rows.append("  ".join(drift))
    rows += [" ".join([r.choice(vocabulary) for _ in range(r.randrange(1, 90))] + passage) for _ in range(others)]
    rows += ["", None, " \n", "one", "ONE", "one two", "One two", "É two", "é two", "a b c d e f g", "A b c d e f g"]
    rows += ["long " * 20_000, "long " * 19_000]
    ids = list(range(len(rows)))
    r.shuffle(ids)
    return list(zip(ids, rows, strict=True)) + [(None, "one two"), (ids[0], rows[0])]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_match_brute_force(spark, seed):
    rows = near_rows(seed)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit(1), "value": F.lit(2), "rep": F.lit(3)})
    got = near_dedup.near_dedup(frame, size=4)
    assert Counter(tuple(r) for r in got.collect()) == brute_near(rows, 4)


def test_ids_with_two_texts_keep_the_links_of_both(spark):
    r = random.Random(11)
    vocabulary = [f"w{k}" for k in range(3000)]

    def text():
        return [r.choice(vocabulary) for _ in range(60)]

    rows = []
    for i in range(60):
        a, b = text(), text()
        rows += [(i, " ".join(a)), (i, " ".join(b))]
        rows += [(1000 + i, " ".join([*a[:-1], "changed"])), (2000 + i, " ".join(["changed", *b[1:]]))]
    rows += [(-5, rows[0][1]), (-5, "quite another text of its own here"), (3000, rows[5][1]), (3000, rows[5][1]), (0, None)]
    got = near_dedup.near_dedup(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert Counter(tuple(r) for r in got.where("n_shingles > 0").collect()) == Counter(
        {k: n for k, n in brute_near(rows, 5).items() if k[1]}
    )


def test_hashed_bounds_are_never_too_low(spark, monkeypatch):
    """With 32-bit hashes that clash all the time the bound still lets every link through."""
    monkeypatch.setattr(near_dedup, "RARE", 10_000)
    real = near_dedup.F.hash
    monkeypatch.setattr(near_dedup.F, "hash", lambda c: real(c) % 5)
    rows = near_rows(3, copies=25, others=25)
    got = near_dedup.near_dedup(spark.createDataFrame(rows, SCHEMA), size=4)
    assert Counter(tuple(r) for r in got.collect()) == brute_near(rows, 4)


def test_group_of_near_copies_stays_linear(spark):
    """Hundreds of near copies: links are found through pivots, not all pairs."""
    r = random.Random(5)
    base = [f"w{r.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(r.randrange(3)):
            text[r.randrange(150)] = f"x{r.randrange(500)}"
        rows.append((i, " ".join(text)))
    got = near_dedup.near_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(tuple(r) for r in got) == brute_near(rows, 5)


def test_near_without_rows_or_words(spark):
    assert near_dedup.near_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    got = near_dedup.near_dedup(spark.createDataFrame([(2, None), (1, "")], SCHEMA)).collect()
    assert {tuple(r) for r in got} == {(2, 0, 2, True), (1, 0, 1, True)}


def test_components_of_chains_and_hubs(spark):
    r = random.Random(3)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    edges += [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent)}


# ---- repeated windows


def brute_substring(rows, size):
    last = max((i for i, _ in rows if i is not None), default=0) + 1
    first = {}
    texts = [(last if i is None else i, i, word_list(t)) for i, t in rows]
    for i, _, w in texts:
        for k in range(len(w) - size + 1):
            g = tuple(w[k : k + size])
            first[g] = min(first.get(g, i), i)
    out = Counter()
    for i, shown, w in texts:
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[(shown, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


def passages(seed, n=60):
    r = random.Random(seed)
    few = [f"w{k}" for k in range(30)]
    shared = [[r.choice(few) for _ in range(r.randrange(10, 40))] for _ in range(6)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(r.randrange(5)):
            text += [r.choice(few) for _ in range(r.randrange(12))]
            piece = r.choice(shared)
            a = r.randrange(len(piece))
            text += piece[a:] if r.random() < 0.5 else piece
        rows.append((i, r.choice([" ", "\n", " \t "]).join(text)))
    rows += [(n, None), (n + 1, ""), (n + 2, "ab " * 9_000), (n + 3, "ab " * 100), (n + 4, "é " * 14), (n + 5, "É " * 14)]
    rows += [(None, rows[3][1]), rows[5]]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 3])
@pytest.mark.parametrize("size", [13, 6])
def test_repeated_windows_match_brute_force(spark, seed, size):
    rows = passages(seed)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"block": F.lit(1), "anchor": F.lit(2), "low": F.lit(3)})
    got = substring_dedup.substring_dedup(frame, size=size, block_bytes=2_000)
    assert Counter(tuple(r) for r in got.collect()) == brute_substring(rows, size)


def test_passage_in_every_document(spark):
    r = random.Random(9)
    piece = " ".join(f"p{k}" for k in range(60))
    rows = [(i, f"{' '.join(f'u{r.randrange(10**6)}' for _ in range(20))} {piece} end{i}") for i in range(400)]
    got = substring_dedup.substring_dedup(spark.createDataFrame(rows, SCHEMA), block_bytes=5_000)
    assert Counter(tuple(r) for r in got.collect()) == brute_substring(rows, 13)
    assert substring_dedup.substring_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shingle_sets_agree_with_words():
    import pyarrow as pa

    texts = [t for _, t in near_rows(4)]
    sets = near_dedup.shingle_sets(pa.array(texts), 4)
    by_size = defaultdict(set)
    for found, text in zip(sets, texts, strict=True):
        want = shingle_set(text, 4)
        assert len(found) == len(want)
        by_size[frozenset(want)].add(found.tobytes())
    assert all(len(s) == 1 for s in by_size.values())
