from __future__ import annotations

import json
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pursewatch.llm import decontamination, language, licenses, line_quality, tool_calls
from pursewatch.llm.queries import TOOLS, derived_calls, remainder

SCHEMA = "doc_id long, text string"

# ---- benchmark items


def brute_leaks(rows, items, size=5, least=0.8):
    def words(t):
        return [w for w in (re.sub(r"[\W_]+", "", x.lower()) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")) if w]

    def weights(w):
        n = min(size, len(w))
        out = {}
        for k in range(len(w) - n + 1 if n else 0):
            g = tuple(w[k : k + n])
            out[g] = out.get(g, 0) + sum(map(len, g))
        return out

    found = {}
    for i, text in rows:
        w = words(text)
        for k, item in items:
            v = words(item)
            if not v or not w:
                continue
            want, best = weights(v), 0.0
            for a in range(max(1, len(w) - len(v) + 1)):
                have = weights(w[a : a + len(v)])
                shared = sum(min(x, have.get(g, 0)) for g, x in want.items())
                union = sum(want.values()) + sum(have.values()) - shared
                best = max(best, shared / union if union else 0.0)
            if best >= least:
                found.setdefault(i, {})[k] = best
    return found


def test_leaks_match_brute_force(spark):
    r = random.Random(2)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.randrange(15, 60)))) for k in range(25)]
    items += [(30, "Short one, here."), (31, ""), (32, None), (33, "!!!"), (34, items[0][1])]
    rows = []
    for i in range(80):
        text = [r.choice(vocabulary) for _ in range(r.randrange(200))]
        if i % 2:
            piece = items[r.randrange(25)][1].upper().split()
            if i % 4 == 1:
                piece[-1] = "changed"
            a = r.randrange(len(text) + 1)
            text[a:a] = [w + "," for w in piece]
        rows.append((i, "\n ".join(text)))
    rows += [(100, None), (101, ""), (102, "a short ONE here"), (103, items[3][1]), (None, items[4][1]), (104, "w1 " * 3_000)]
    rows += [rows[1], (105, "w1 " * 4_000 + items[7][1])]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("leaks", F.lit("old"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_leaks(rows, [(k, t) for k, t in items if t])
    for size in (1 << 20, 900):
        got = decontamination.find_leaks(frame, bench, item_bytes=size).collect()
        assert len(got) == len(rows)
        for row in got:
            have = {x.item_id: x.similarity for x in row.leaks}
            assert have == pytest.approx(want.get(row.doc_id, {}), abs=0.01), row.doc_id
    empty = decontamination.find_leaks(frame, bench.where("false")).select(F.size("leaks")).distinct().collect()
    assert [r[0] for r in empty] == [0]


def test_every_fingerprint_within_the_radius_is_a_candidate():
    r = random.Random(7)
    index = decontamination.ItemIndex([0], [" ".join(f"w{r.randrange(99)}" for _ in range(40))], 5, decontamination.RADIUS)
    c = index.classes[0]
    for _ in range(300):
        bits = r.sample(range(64), r.randrange(decontamination.RADIUS + 2))
        base = int(r.choice(c.fingerprint))
        for b in bits:
            base ^= 1 << b
        prints = np.array([base], np.uint64)
        near = np.flatnonzero(np.bitwise_count(c.fingerprint ^ prints[0]) <= decontamination.RADIUS)
        assert set(index._candidates(c, prints)[1].tolist()) == set(near.tolist())


def test_long_items_with_a_replaced_inner_run_are_found():
    r = random.Random(11)
    vocabulary = [f"w{k}" for k in range(3_000)]
    for size in (100, 200, 400):
        items = [[r.choice(vocabulary) for _ in range(size)] for _ in range(40)]
        texts = []
        for item in items:
            run = int(0.1 * size) - 4
            a = r.randrange(1, size - run)
            copy = item[:a] + [r.choice(vocabulary) for _ in range(run)] + item[a + run :]
            texts.append(" ".join(r.choices(vocabulary, k=r.randrange(50)) + copy + r.choices(vocabulary, k=20)))
        index = decontamination.ItemIndex(range(40), [" ".join(x) for x in items], 5, decontamination.RADIUS)
        want = brute_leaks(enumerate(texts), [(k, " ".join(x)) for k, x in enumerate(items)])
        assert len(want) == 40
        got = index.leaks(pa.array(texts), 0.8)
        assert [[x["item_id"] for x in leaks] for leaks in got] == [[k] for k in range(40)]


def test_fingerprints_match_a_count_of_bits():
    word = np.random.default_rng(5).integers(0, 2**63, 700, np.uint64)
    bits = np.unpackbits(word.view(np.uint8).reshape(-1, 8), axis=1).astype(int)
    for widest in (40, 1 << 16):
        for n, size in ((700, 1), (700, 40), (128, 7), (5, 5), (5, 6), (0, 1)):
            want = [np.packbits(bits[a : a + size].sum(axis=0) * 2 > size) for a in range(n - size + 1)]
            got = decontamination._fingerprints(decontamination._bit_sums(word[:n], widest), size)
            assert got.tolist() == [int(x.view(np.uint64)[0]) for x in want]


# ---- quality


def quality_rows(n, seed):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = [" ".join(r.choice(["alpha", "beta", "gamma", "delta", "of"]) for _ in range(9)).capitalize() + "." for _ in range(5)]
        bad = ["BUY!! NOW!! " * 5, "home | about | news | more", "spam spam spam spam spam", "%%% x$$$ y### z***"]
        quality = int(r.random() < 0.7)
        text = good if quality else [good[0], *r.choices(bad, k=5)]
        rows.append((i, "\n".join(text)))
        labels.append((i, quality, 0))
    return rows, labels


def test_quality_holds_out(spark):
    rows, labels = quality_rows(400, 1)
    labels += [(3, None, 0), (None, 1, 0), (4, 7, 0), (9999, 1, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = line_quality.fit_on(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), remainder(3) != 1, most=200)
    fresh, truth = quality_rows(200, 2)
    fresh += [(900, None), (901, ""), (902, "\n" * 5_000), (903, "x " * 100_000)]
    frame = spark.createDataFrame(fresh, SCHEMA).withColumn("quality_score", F.lit("old"))
    got = {r.doc_id: r.quality_score for r in line_quality.score_quality(frame, model).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == len(fresh)
    assert np.mean([(got[i] >= 0.5) == bool(q) for i, q, _ in truth]) > 0.97


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a")], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = line_quality.fit_on(docs, labels, F.lit(True))
    assert [r.quality_score for r in line_quality.score_quality(docs, model).collect()] == [0.5]


def test_marginals_match_enumeration():
    from itertools import product

    r = np.random.default_rng(1)
    at = np.array([0, 1, 6, 6, 9])
    scores, pair = r.normal(size=(9, 2)), r.normal(size=(2, 2))
    state, moves = line_quality.marginals(scores, pair, at)
    want, expected = np.zeros((9, 2)), np.zeros((2, 2))
    for a, b in zip(at, at[1:], strict=False):
        total, own, pairs = 0.0, np.zeros((b - a, 2)), np.zeros((2, 2))
        for path in product(range(2), repeat=b - a):
            w = np.exp(sum(scores[a + k, s] for k, s in enumerate(path)) + sum(pair[s, t] for s, t in zip(path, path[1:])))
            total += w
            for k, s in enumerate(path):
                own[k, s] += w
            for s, t in zip(path, path[1:]):
                pairs[s, t] += w
        want[a:b] = own / total
        expected += pairs / total
    assert np.allclose(state, want) and np.allclose(moves, expected)


# ---- language


def test_language_holds_out(spark):
    r = random.Random(3)
    parts = {"xx": ["ka", "lo", "mi", "ru"], "yy": ["sch", "ung", "en", "ö"], "zz": ["ção", "ei", "que", "lo"]}

    def text(lang):
        return " ".join("".join(r.choices(parts[lang], k=r.randrange(1, 4))) for _ in range(r.randrange(5, 40)))

    rows = [(i, text(x), x) for i, x in enumerate(r.choices(list(parts), k=300))]
    rows += [(500, "ka lo", None), (None, "ka", "xx"), (501, None, "xx"), (502, "12 34", "xx")]
    schema = "doc_id long, text string, lang string"
    identifier = language.fit_on(spark.createDataFrame(rows, schema), remainder(4) != 2, sample=60)
    assert identifier.languages == ["xx", "yy", "zz"]
    fresh = [(i, text(x), x) for i, x in enumerate(r.choices(list(parts), k=100))]
    odd = [(900, None, None), (901, "", None), (902, "12 ?!", None), (903, "lokami " * 20_000, "xx"), (904, "漢字 漢字", None)]
    frame = spark.createDataFrame(fresh + odd, schema).withColumn("lang_pred", F.lit(1))
    got = {r.doc_id: r for r in language.identify(frame, identifier).collect()}
    assert np.mean([got[i].lang_pred == x for i, _, x in fresh]) > 0.97
    assert all(0 <= r.lang_score <= 1 for r in got.values())
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "xx"]
    assert got[904].lang_pred in parts and not got[904].lang_accepted


def test_every_language_calibrates_at_every_size(spark):
    r = random.Random(5)
    parts = {"xx": ["ka", "lo", "mi", "ru"], "yy": ["sch", "ung", "en", "ö"], "zz": ["ção", "ei", "que", "lo"]}

    def text(lang):
        return " ".join("".join(r.choices(parts[lang], k=r.randrange(1, 4))) for _ in range(40))

    rows = [(i, text(x), x) for i, x in enumerate(["xx"] * 150 + ["yy"] * 12 + ["zz"])]
    rows += [(3, rows[3][1], "xx"), (4, rows[4][1], "xx")]
    schema = "doc_id long, text string, lang string"
    identifier = language.fit_on(spark.createDataFrame(rows, schema), F.lit(True))
    assert identifier.languages == ["xx", "yy", "zz"]
    assert len(identifier.most) == 3 and np.isfinite(identifier.most).all()
    bits, _ = identifier.entropies(pa.array(["qwfp gjvk bzqx " * 20, rows[0][1]]))
    assert bits[0].min() > max(identifier.most)
    names, _, accepted = identifier.identify(pa.array(["qwfp gjvk bzqx " * 20]))
    assert not accepted[0] and names[0] in parts


def test_all_rows_but_those_held_out_are_counted(spark):
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}", "xx") for i in range(300)]
    identifier = language.fit_on(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), sample=10)
    # each document has a trigram of its own, from its first letter to its end
    assert len(identifier.models[0].keys[2]) >= 290


LANGUAGE = "lang string, text string"


def char_rows(seed=2):
    r = random.Random(seed)
    letters = {"xx": "abcd", "yy": "abéz"}
    texts = [(x, "".join(r.choices(letters[x] + " ", k=r.randrange(1, 60)))) for x in letters for _ in range(25)]
    return texts + [("xx", ""), ("xx", "a"), ("yy", "?!"), ("xx", "AB, ab!"), ("yy", "zé" * 300)]


def textbook(rows, order):
    """Interpolated Kneser-Ney by its recursion: language -> n -> n-gram -> (count, p)."""
    found = {}
    for lang in {x for x, _ in rows}:
        of_n = {n: set() for n in range(1, order + 1)}
        longest = {}
        for x, text in rows:
            if x == lang:
                chars = "0" + "".join(c if c.isalpha() else "0" for c in text.lower()) + "0"
                chars = re.sub("0+", "0", chars)
                chars = chars if len(chars) > 1 else "00"
                for n in range(1, order + 1):
                    for at in range(max(n - 1, 1), len(chars)):
                        gram = chars[at - n + 1 : at + 1]
                        of_n[n].add(gram)
                        if n == order:
                            longest[gram] = longest.get(gram, 0) + 1
        lower, out = {}, {}
        for n in range(1, order + 1):
            count = longest if n == order else {g: max(1, sum(h[1:] == g for h in of_n[n + 1])) for g in of_n[n]}
            ones, twos = (sum(c == k for c in count.values()) for k in (1, 2))
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            now = {}
            for g, c in count.items():
                own = [v for h, v in count.items() if h[:-1] == g[:-1]]
                below = lower[g[1:]] if n > 1 else 1 / (len(of_n[1]) + 2)
                now[g] = max(c - d, 0) / sum(own) + d * len(own) / sum(own) * below
            out[n] = {g: (count[g], p) for g, p in now.items()}
            lower = now
        found[lang] = out
    return found


def gram_hash(gram):
    points = np.array([0 if c == "0" else ord(c) for c in gram], np.uint32)
    return int(language.grams(points, len(gram))[-1:].view(np.int64)[0])


@pytest.mark.parametrize("order", [1, 2, 4])
def test_every_probability_is_the_textbooks(spark, order):
    rows = char_rows()
    counted = language.count_grams(spark.createDataFrame(rows, LANGUAGE).repartition(3), order)
    got = {(x.lang, x.n, x.gram): (x["count"], x.p) for x in language.kneser_ney(counted, order).collect()}
    want = {
        (lang, n, gram_hash(g)): v for lang, of_n in textbook(rows, order).items() for n, grams in of_n.items() for g, v in grams.items()
    }
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-12 for k in want)


def test_segments_and_slices_change_no_count(spark, monkeypatch):
    rows = [("xx", "".join(random.Random(1).choices("abc d", k=5_000))), *char_rows()]
    texts = pa.RecordBatch.from_pydict({"lang": [x for x, _ in rows], "text": [t for _, t in rows]})

    def counts():
        total = {}
        for b in language._counter(4)(iter([texts])):
            for r in b.to_pylist():
                key = tuple(v for c, v in r.items() if c != "count")
                total[key] = total.get(key, 0) + r["count"]
        return total

    whole = counts()
    fitted = language.fit_on(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string"), F.lit(True))
    bits, _ = fitted.entropies(texts.column("text"))
    for name, value in (("SEGMENT", 97), ("SLICE_BYTES", 50), ("PENDING", 100)):
        monkeypatch.setattr(language, name, value)
    assert counts() == whole
    assert np.allclose(fitted.entropies(texts.column("text"))[0], bits)


def test_leaving_ngrams_out_keeps_discounts_and_mass(spark, monkeypatch):
    """With a low bound the counts of ones and twos are the same, and each context still sums to 1."""
    counted = language.count_grams(spark.createDataFrame(char_rows(), LANGUAGE), 3)
    grams = language.kneser_ney(counted, 3)
    whole = {x: m for x, m in zip(*language._models(grams, 3), strict=True)}
    monkeypatch.setattr(language, "MOST_GRAMS", 12)
    kept = language.mark_frequent(grams, 3).where("kept")
    told = {(x.lang, x.n): (x.n1, x.n2) for x in kept.select("lang", "n", "n1", "n2").distinct().collect()}
    assert told == {(x.lang, x.n): (x.n1, x.n2) for x in grams.select("lang", "n", "n1", "n2").distinct().collect()}
    assert kept.count() < grams.count() / 3
    few = {x: m for x, m in zip(*language._models(grams, 3), strict=True)}
    for models in (whole, few):
        for lang, letters in (("xx", "0abcd"), ("yy", "0abéz")):
            for before in ("ab", "0a", "a0", "zz", "q0"):
                total = 0.0
                for last in letters + "\u4e00" * 2:  # two characters that are not known
                    seq = np.array([0 if c == "0" else ord(c) for c in before + last], np.uint32)
                    own = [language.grams(seq, n)[-1:] for n in (1, 2, 3)]
                    contexts = [np.zeros(1, np.uint64)] + [language.grams(seq, n)[-2:-1] for n in (1, 2)]
                    total += 2 ** models[lang].log2(own, contexts)[0]
                assert abs(total - 1) < 1e-6


def test_the_most_frequent_ngrams_stay(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_GRAMS", 50)
    few = [("xx", 1, k << 44, k) for k in range(1, 40)]
    many = [("xx", 2, k << 54, 9) for k in range(40)] + [("xx", 2, (1000 + k) << 50, 3) for k in range(-500, 500)]
    frame = spark.createDataFrame(few + many, "lang string, n int, gram long, count long")
    kept = language.mark_frequent(frame, 2).where("kept").collect()
    assert sum(x.n == 1 for x in kept) == 39
    assert sum(x.n == 2 and x["count"] == 9 for x in kept) == 40
    assert sum(x.n == 2 and x["count"] == 3 for x in kept) <= 20
    monkeypatch.setattr(language, "MODEL_GRAMS", 20)
    assert language.mark_frequent(frame, 2).where("kept and n = 1").count() == 10


@pytest.mark.parametrize("bits", [1 << 20, 64])
def test_ngrams_beyond_the_bounds_are_looked_up(spark, monkeypatch, bits):
    """Low bounds, and marks that let nearly all through, change no text's result."""
    rows = [(i, *r) for i, r in enumerate(char_rows() * 2)] + [(None, "xx", "ab cd"), (7, "yy", "zé"), (8, None, "ab"), (9, "xx", None)]
    schema = "doc_id long, lang string, text string"
    learnt = spark.createDataFrame(rows, schema)
    other = [(None, "q", None), (1, "q", ""), (1, "q", "12"), (2, "q", "漢字"), (3, "q", "az" * 400), *[(4, "q", "abba dab zé")] * 40]
    asked = learnt.union(spark.createDataFrame(other, schema)).select("doc_id", "text", F.lit(1).alias("gram"), F.lit(2).alias("CHUNK"))
    whole = language.fit_on(learnt, F.lit(True))
    assert whole.others is None
    for name, value in (("MARK_BITS", bits), ("CHUNK_BYTES", 200), ("SLICE_BYTES", 100), ("SEGMENT", 97), ("PENDING", 50)):
        monkeypatch.setattr(language, name, value)
    monkeypatch.setattr(language, "MOST_GRAMS", 12)
    few = language.fit_on(learnt, F.lit(True))
    assert few.others.count() > 200 and max(len(k) for m in few.models for k in m.keys) < 20
    assert few.languages == whole.languages and few.sharpness == whole.sharpness
    assert np.allclose(few.most, whole.most, atol=1e-8)
    told = []
    for identifier in (whole, few):
        got = language.identify(asked, identifier)
        assert got.columns == [*asked.columns, "lang_pred", "lang_score", "lang_accepted"]
        told.append(sorted(got.collect(), key=lambda x: (str(x.text), x.doc_id is None, x.doc_id or 0)))
    assert len(told[0]) == len(told[1]) == len(rows) + len(other)
    for a, b in zip(*told, strict=True):
        assert a[:5] == b[:5] and abs(a.lang_score - b.lang_score) < 1e-6
    # a text on the edge of what is accepted may fall on either side
    assert sum(a.lang_accepted != b.lang_accepted for a, b in zip(*told, strict=True)) <= 2


@pytest.mark.parametrize("order", [1, 2, 4])
def test_what_is_looked_up_makes_up_the_textbooks_probability(spark, monkeypatch, order):
    rows = char_rows()
    grams = language.kneser_ney(language.count_grams(spark.createDataFrame(rows, LANGUAGE), order), order)
    monkeypatch.setattr(language, "MOST_GRAMS", 3)
    marked = language.mark_frequent(grams, order).localCheckpoint()
    names, models = language._models(marked, order)
    others = language.left_out(marked, names, order)
    marks = language.marks_of(others, len(names))
    gain = {(x.language, x.slot, x.gram): x.gain for x in others.collect()}
    checked = 0
    for lang, of_n in textbook(rows, order).items():
        k = names.index(lang)
        for gram, (_, p) in of_n[order].items():
            if order == 1:
                gram = "0" + gram
            points = np.array([0 if c == "0" else ord(c) for c in gram], np.uint32)
            by_order = language.all_grams(points, order)
            contexts = [np.zeros(0, np.uint64), *[g[-2:-1] for g in by_order[:-1]]]
            own = [g[-1:] for g in by_order]
            asked = [(slot, x) for slot, h in models[k].lacking(own, contexts, marks[k]) for x in h.view(np.int64)]
            more = {slot: (np.array([x]).view(np.uint64), np.array([gain[k, slot, x]])) for slot, x in asked if (k, slot, x) in gain}
            assert abs(models[k].log2_among_all(own, contexts, more)[0] - np.log2(p)) < 1e-9
            checked += bool(more)
    assert checked > 3


def test_language_without_sample(spark):
    rows = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    identifier = language.fit_on(rows, F.lit(True))
    assert [r.lang_pred for r in language.identify(rows, identifier).collect()] == ["und"]



# ---- licences


def test_licences_in_units(spark):
    mit = dict((len(t), t) for n, t in licenses.TEMPLATES if n == "MIT")
    rows = [
        (1, "Some text.\nreleased under the *MIT* License\nMore text."),
        (2, mit[max(mit)].replace("software", "program", 1)),
        (3, "Intro\n\n" + mit[max(mit)].replace(". ", ".\n") + "\n\nEnd of it"),
        (4, None), (5, ""), (6, "\n\n\n"), (7, "All rights reserved."), (8, "word " * 100_000), (None, "MIT"),
        (9, "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0."),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("licenses", F.lit(1))
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(frame).collect()}
    assert [(x.license, x.dice, x.unit) for x in got[1]] == [("MIT", 1.0, "line")]
    assert got[2][0].license == "MIT" and 0.9 < got[2][0].dice < 1 and got[2][0].unit == "text"
    assert ("MIT", "paragraph") in [(x.license, x.unit) for x in got[3]]
    assert [x.license for x in got[7]] == ["all-rights-reserved"]
    assert [x.license for x in got[9]] == ["Apache-2.0", "CC-BY-NC-4.0"]
    assert all(not got[i] for i in (4, 5, 6, 8, None))


def test_licences_anywhere_in_a_text():
    mit = max((t for n, t in licenses.TEMPLATES if n == "MIT"), key=len)
    bsd = {n: t for n, t in licenses.TEMPLATES if n.startswith("BSD")}
    other = " ".join(f"word{k}" for k in range(120))
    paragraphs = mit.replace("conditions: ", "conditions:\n\n").replace("Software. THE", "Software.\n\nTHE")
    texts = [
        f"{other}\n\n{paragraphs}\n\n{other}",
        f"{other}\n\n" + bsd["BSD-2-Clause"].replace("THIS SOFTWARE IS", "\n\nTHIS SOFTWARE IS") + f"\n\n{other}",
        f"{other} " + bsd["BSD-3-Clause"].replace("THIS SOFTWARE IS", "\n\nTHIS SOFTWARE IS") + f"\n\n{other}",
        "Copyright 2020 Acme Corp. All rights reserved.",
        "We say that this is released\nunder the MIT License. And more than that follows here.",
        f"{other} all rights {other} reserved",
        "all rights reserved " * 3_000 + other,
        "Released under the MIT License.\n" + other,
    ]
    got = licenses.Templates.of(licenses.TEMPLATES).scan(pa.array(texts, pa.large_string()), licenses.LEAST)
    names = [[(x["license"], x["unit"]) for x in found] for found in got]
    assert names[:6] == [
        [("MIT", "passage")], [("BSD-2-Clause", "passage")], [("BSD-3-Clause", "passage")],
        [("all-rights-reserved", "passage")], [("MIT", "passage")], [],
    ]
    assert all(x["dice"] == 1 for found in got for x in found)
    assert names[6] == [("all-rights-reserved", "passage")] * 3_000
    assert names[7] == [("MIT", "line")]


def test_dice_matches_brute_force():
    r = random.Random(4)
    vocabulary = ["a", "b", "c", "d"]
    templates = [(str(k), " ".join(r.choices(vocabulary, k=r.randrange(1, 12)))) for k in range(20)]
    units = [" ".join(r.choices(vocabulary, k=r.randrange(0, 14))) for _ in range(300)]

    def pairs(t):
        w = t.split()
        return {(w[0],)} if len(w) == 1 else set(zip(w, w[1:], strict=False))

    best, which = licenses.Templates.of(templates).match(pa.array(units, pa.large_string()), 0.5)
    for unit, dice in zip(units, best, strict=True):
        a = pairs(unit)
        want = max((2 * len(a & pairs(t)) / (len(a) + len(pairs(t))) for _, t in templates if a), default=0)
        assert dice == pytest.approx(want if want >= 0.5 else 0)


# ---- tool calls

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, after string"
RESULTS = "conv_id long, call_id string, turn long, content string"


def test_calls_linked_ordered_checked(spark):
    calls = [
        (1, "c", 1, "count", '{"words": 3.0}', "b"), (1, "b", 2, "search", '{"limit":5,"query":"abc"}', "a"),
        (1, "a", 3, "search", '{"query":"é\\u0001","limit":0,"more":1}', "gone"), (1, "x", 4, "count", "{", None),
        (1, "y", 5, "none", "{}", None), (1, "p", 6, "count", '{"words":1}', "q"), (1, "q", 7, "count", '{"words":1}', "p"),
        (1, "r", 8, "count", '{"words":1}', "q"), (1, "c", 9, "count", "{}", None), (None, "z", 1, "count", '{"words":1}', None),
        (1, "n", 9, "count", '{"words":NaN}', None), (1, "s", 9, "count", '{"words":1,"t":"\\ud800"}', None),
        (2, "a", 1, None, None, None),
    ]
    results = [(1, "a", 4, "ra"), (1, "b", 5, None), (1, "c", 6, "rc"), (1, "c", 7, "later"), (3, "a", 2, "lost"), (1, None, 3, "?")]
    frame = spark.createDataFrame(calls, CALLS).withColumns({"depth": F.lit(1), "called": F.lit(1), "repeated": F.lit(0)})
    got = tool_calls.link_calls(frame, spark.createDataFrame(results, RESULTS), TOOLS).collect()
    assert len(got) == len(calls) + len(results)
    status = sorted((str(r.conv_id), str(r.call_id), r.kind, r.status) for r in got)
    assert status == sorted([
        ("1", "a", "call", "invalid"), ("1", "a", "result", "ok"), ("1", "b", "call", "ok"), ("1", "b", "result", "ok"),
        ("1", "c", "call", "ok"), ("1", "c", "call", "duplicate"), ("1", "c", "result", "ok"), ("1", "c", "result", "duplicate"),
        ("1", "x", "call", "bad json"), ("1", "y", "call", "unknown tool"), ("1", "p", "call", "cycle"), ("1", "q", "call", "cycle"),
        ("1", "r", "call", "cycle"), ("None", "z", "call", "no result"), ("1", "n", "call", "bad json"), ("1", "s", "call", "bad json"),
        ("2", "a", "call", "unknown tool"), ("3", "a", "result", "no call"), ("1", "None", "result", "no call"),
    ])
    first = {(r.call_id, r.kind): r for r in got if r.conv_id == 1 and r.status != "duplicate"}
    assert [first[c, "call"].depth for c in "abc"] == [0, 1, 2]
    assert first["c", "call"].message == '{"role":"assistant","tool_call":{"after":"b","arguments":{"words":3},"id":"c","name":"count"}}'
    assert first["a", "call"].problems == "$.limit: below minimum; $.more: unknown; $.query: too short"
    assert all(json.loads(r.message) for r in got)


def test_long_chain_takes_few_rounds(spark):
    calls = [(1, str(k), k, "count", '{"words":1}', str(k - 1) if k else None) for k in range(200)]
    got = tool_calls.link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), TOOLS)
    assert all(r.depth == int(r.call_id) and r.status == "no result" for r in got.collect())
    none = spark.createDataFrame([], CALLS)
    assert tool_calls.link_calls(none, spark.createDataFrame([], RESULTS), TOOLS).count() == 0


def brute_links(calls, results, schemas):
    """Every conversation by itself: rows (conv, call, kind, depth, turn, status)."""
    low = lambda x: (x is not None, x if x is not None else "")
    out = []
    for conv in {r[0] for r in calls} | {r[0] for r in results}:
        mine, theirs = ([r for r in rows if r[0] == conv] for rows in (calls, results))
        keyed = [c for c in mine if conv is not None and c[1] is not None]
        first, answer = {}, {}
        for c in sorted(keyed, key=lambda c: (c[2], *map(low, c[3:5]), (c[5] is not None, [low(x) for x in c[5] or []]))):
            first.setdefault(c[1], c)
        for r in sorted((r for r in theirs if conv is not None and r[1] is not None), key=lambda r: (r[2], low(r[3]))):
            answer.setdefault(r[1], r)

        def depth(call, path=()):
            if call in path:
                return None
            below = [depth(b, (*path, call)) for b in set(first[call][5] or []) if b in first]
            return None if None in below else max((d + 1 for d in below), default=0)

        used = set()
        for c in mine:
            head = c in keyed and first[c[1]] is c and c[1] not in used
            used |= {c[1]} if head else set()
            d = depth(c[1]) if head else 0
            try:
                value, bad = json.loads(c[4]), False
            except ValueError:
                value, bad = None, True
            if c in keyed and not head:
                status = "duplicate"
            elif d is None:
                status = "cycle"
            elif c[3] not in schemas:
                status = "unknown tool"
            elif bad:
                status = "bad json"
            elif c[3] == "count" and not (isinstance(value, dict) and type(value.get("words")) is int):
                status = "invalid"
            else:
                status = "ok" if head and c[1] in answer else "no result"
            out.append((conv, c[1], "call", d, c[2], status))
        for r in theirs:
            head = conv is not None and answer.get(r[1]) is r
            linked = head and r[1] in first
            status = "ok" if linked else "no call" if head or conv is None or r[1] is None else "duplicate"
            out.append((conv, r[1], "result", depth(r[1]) if linked else 0, first[r[1]][2] if linked else r[2], status))
    return out


def test_links_match_brute_force(spark):
    """Calls after several others, cycles, repeated ids, lost results, in many conversations."""
    r = random.Random(12)
    calls, results = [], []
    for conv in [*range(40), None]:
        n = r.randrange(1, 14)
        for k in range(n):
            # mostly earlier calls, sometimes a later one, which may make a cycle
            near = [f"c{r.randrange(k) if k and r.random() < 0.93 else r.randrange(n + 2)}" for _ in range(r.choice([0, 1, 1, 1, 2, 3]))]
            name = r.choice(["count", "count", "free", "nobody's"])
            text = r.choice(['{"words":3}', '{"words":3}', '{"words":"x"}', "{", "[]"])
            calls.append((conv, f"c{k}" if r.random() < 0.95 else r.choice(["c0", None]), k, name, text, near or None))
        results += [(conv, r.choice([f"c{r.randrange(n + 1)}", f"c{k}", None]), 100 + k, f"r{k}") for k in range(r.randrange(n + 1))]
    schemas = {"count": TOOLS["count"], "free": {}}
    frame = spark.createDataFrame(calls, CALLS.replace("after string", "after array<string>"))
    got = tool_calls.link_calls(frame.repartition(4), spark.createDataFrame(results, RESULTS), schemas)
    found = [(x.conv_id, x.call_id, x.kind, x.depth, x.turn, x.status) for x in got.collect()]
    assert Counter(found) == Counter(brute_links(calls, results, schemas))
    assert {x[5] for x in found} >= {"ok", "cycle", "duplicate", "no result", "no call", "bad json", "invalid", "unknown tool"}


def test_derived_calls_keep_every_message(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    calls, results = derived_calls(turns)
    got = tool_calls.link_calls(calls, results, TOOLS)
    assert got.count() == calls.count() + results.count()


def test_canonical_json():
    value = {"b": [1.0, 1.5, True, None, -0.0, 1e300], "a": {"é": " \n", "": 10**20}}
    text = tool_calls.canonical(value)
    assert json.loads(text) == value
    assert tool_calls.canonical(json.loads(text)) == text and text.startswith('{"a":{"":100000000000000000000,')


SCHEMA_CASES = [
    ({"type": "string", "pattern": "^a$"}, "zzz", "a"),
    ({"const": {"a": 1.0}}, {"a": 2}, {"a": 1}),
    ({"anyOf": [{"type": "string"}, {"minimum": 3}]}, 2, "x"),
    ({"oneOf": [{"minimum": 3}, {"maximum": 5}]}, 4, 6),
    ({"allOf": [{"minimum": 3}, {"maximum": 5}]}, 6, 4),
    ({"not": {"type": "null"}}, None, 0),
    ({"exclusiveMaximum": 5}, 5, 4.5),
    ({"exclusiveMinimum": 5}, 5, 5.5),
    ({"multipleOf": 0.1}, 0.35, 0.3),
    ({"uniqueItems": True}, [1, 2, 1.0], [1, "1"]),
    ({"minProperties": 1, "maxProperties": 1}, {}, {"a": 1}),
    ({"additionalProperties": {"type": "integer"}, "properties": {"a": {}}}, {"a": "x", "b": "y"}, {"a": "x", "b": 3}),
    ({"items": {"enum": [1, "a"]}}, [1, True], [1.0, "a"]),
    (False, 1, None),
]


@pytest.mark.parametrize(("schema", "bad", "good"), SCHEMA_CASES[:-1])
def test_every_checked_keyword_tells_bad_from_good(schema, bad, good):
    tool_calls.checked_schema(schema)
    assert tool_calls.problems(bad, schema) and not tool_calls.problems(good, schema)


@pytest.mark.parametrize("schema", [{"$ref": "#/x"}, {"properties": {"a": {"format": "date"}}}, {"items": {"contains": {}}}, {"anyOf": [{"if": {}}]}])
def test_keywords_that_are_not_checked_raise(spark, schema):
    calls, results = derived_calls(spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn int, role string, text string"))
    with pytest.raises(ValueError, match="not checked"):
        tool_calls.link_calls(calls, results, {"search": schema})


def test_many_notices_in_one_text_take_linear_time():
    import time

    index = licenses.Templates.of(licenses.TEMPLATES)

    def seconds(lines):
        text = pa.array(["All rights reserved.\n" * lines], pa.large_string())
        start = time.process_time()
        (found,) = index.scan(text, licenses.LEAST)
        assert len(found) == lines and {m["unit"] for m in found} == {"line"}
        return time.process_time() - start

    seconds(10)
    assert seconds(40_000) < 30


def test_lines_that_quality_learns_from_are_bounded(spark):
    rows, labels = quality_rows(40, 3)
    rows = [(i, t) for i, t in rows]
    docs = spark.createDataFrame(rows + rows[:5], SCHEMA)
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    whole = line_quality.fit_on(docs, told, F.lit(True))
    once = line_quality.fit_on(spark.createDataFrame(rows, SCHEMA), told, F.lit(True))
    assert np.allclose(whole.weight, once.weight)
    lines, at = line_quality._run_of_lines([7, 8, 9], np.array([0, 10, 12, 12]), 4)
    assert at.tolist() == [0, 4, 6, 6] and lines[4:].tolist() == [10, 11]
    assert (np.diff(lines[:4]) == 1).all() and 0 <= lines[0] and lines[3] < 10
    few = line_quality.fit_on(docs, told, F.lit(True), lines=2)
    assert np.isfinite(few.weight).all()
