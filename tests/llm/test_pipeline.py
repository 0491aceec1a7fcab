from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pursewatch.llm import queries
from .test_near_substring import brute_near, word_list
from .test_text_models import brute_leaks, quality_rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = [(k, " ".join(f"item{k}x{j}" for j in range(20))) for k in range(5)]


def corpus(seed=1):
    """Good and bad documents, near copies, benchmark passages, odd rows."""
    r = random.Random(seed)
    rows, labels = quality_rows(150, seed)
    vocabulary = [f"w{k}" for k in range(2000)]
    for i in range(150, 260):
        text = [r.choice(vocabulary) for _ in range(r.randrange(30, 90))]
        if i % 10 == 0:
            text[5:5] = ITEMS[i % 5][1].split()
        rows.append((i, " ".join(text).capitalize() + "."))
        if i % 7 == 0:
            rows.append((i + 1000, " ".join([*text[:-1], "Changed."]).capitalize()))
    rows += [(3000, None), (3001, ""), (3002, "word " * 30_000), (None, "no id here at all."), rows[160], rows[160]]
    full = [(i, t, "en", None if k % 11 == 0 else f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(rows)]
    return full, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("mine") for c in ("quality_score", "leaks", "whole", "kept", "size", "rep", "value", "nth")}
    )
    docs.write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where


def bag(df):
    return Counter(tuple(r) for r in df.select("doc_id", "text", "source").collect())


def test_stages_against_brute_force(spark, folder):
    stages = dict(corpus_pipeline.STAGES)
    docs = queries.table(spark, folder, "documents")
    columns = docs.columns

    good = corpus_pipeline.stored(stages["quality classifier"](spark, docs, folder), "test")
    assert good.columns == columns and good.where("leaks != 'mine' or quality_score != 'mine'").count() == 0
    kept_ids = {r.doc_id for r in good.select("doc_id").collect()}
    _, labels = corpus()
    assert sum((i in kept_ids) == bool(q) for i, q, _ in labels) > 0.97 * len(labels)

    near = corpus_pipeline.stored(stages["near duplicates"](spark, good, folder), "test")
    assert near.columns == columns
    before = [(r.doc_id, r.text) for r in good.collect()]
    stays = {i for (i, _, _, keep) in brute_near(before, 5) if keep and i is not None}
    got = near.collect()
    assert Counter(r.doc_id for r in got if r.doc_id is not None) == Counter(stays)
    assert sum(r.doc_id is None for r in got) == sum(i is None for i, _ in before)

    clean = corpus_pipeline.stored(stages["benchmark decontamination"](spark, near, folder), "test")
    assert clean.columns == columns
    leaks = brute_leaks([(r.doc_id, r.text) for r in got], ITEMS)
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r.doc_id) for r in got if r.doc_id not in leaks)

    mixed = corpus_pipeline.stored(stages["source mix"](spark, clean, folder), "test")
    assert mixed.columns == columns
    size, taken = defaultdict(int), defaultdict(int)
    for r in clean.collect():
        size[r.source] += len(word_list(r.text))
    whole = bag(clean)
    for r in mixed.collect():
        taken[r.source] += len(word_list(r.text))
        assert (r.doc_id, r.text, r.source) in whole or r.n_chars == len(r.text)
    assert abs(sum(taken.values()) - sum(size.values())) <= len(size)
    assert all(taken[s] <= 3 * size[s] for s in size)

    placed = stages["sharding"](spark, mixed, folder)
    assert bag(placed) == bag(mixed) and placed.where("shard is null or slot is null").count() == 0


def test_texts_that_share_an_id_are_told_apart(spark):
    stage = dict(corpus_pipeline.STAGES)["near duplicates"]
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    rows = [(1, a), (1, b), (2, a + " end"), (3, b), (3, b), (4, "alone"), (4, None), (4, None), (None, a), (None, a), (5, "alone")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).withColumn("row", F.lit("mine"))
    got = stage(spark, docs, "")
    assert got.columns == docs.columns and got.where("row != 'mine'").count() == 0
    want = [(1, a), (1, b), (4, "alone"), (4, None), (4, None), (None, a), (None, a)]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(want)


def test_run_is_the_stages_in_order_and_repeats(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "near duplicates", "benchmark decontamination", "source mix", "sharding",
    ]
    docs = queries.table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), "test")
    assert bag(corpus_pipeline.run(spark, folder)) == bag(docs)


def test_an_empty_corpus(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        queries.table(spark, folder, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
