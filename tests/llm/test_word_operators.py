"""Spelling variants, decontamination and periodic runs: compared with plain computations."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_corpus import WORD, corpus
from plain_vocabulary import LOW, plain_matches, plain_runs, plain_variants, sha, terms
from pyspark.sql import functions as F

from keepwell.llm import decontamination, periodic_runs, spelling

RUNS = re.compile(r"[A-Za-zÀ-ÿ]+")


# --- spelling variants ----------------------------------------------------------------
def slipped_words(rows):
    counts = Counter()
    for ident, text in rows:
        for run in RUNS.findall(text or ""):
            word = run.translate(LOW)
            h = zlib.crc32(f"{ident}:{word}".encode())
            if ident is not None and h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 6:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def misspelt(seed=3):
    """Texts over few stems with inserted, deleted and replaced letters, accents and capitals."""
    draw = random.Random(seed)
    stems = ["kitchen", "élevage", "SÉJOURS", "garden", "gardens", "gärdens", "aaaaaaaa", "banana", "ananas"]
    rows = []
    for ident in range(300):
        words = []
        for _ in range(draw.randint(0, 40)):
            word, i = draw.choice(stems), draw.randint(0, 5)
            word = draw.choice([word] * 6 + [word[:i] + word[i + 1 :], word[:i] + "x" + word[i:], word[:i] + "é" + word[i + 1 :]])
            words.append(word)
        rows.append((ident if ident % 50 else None, " ".join(words) + ", " + "b" * 12 + "7"))
    return [*rows, rows[5], (900, None), (901, ""), (902, "Ü" * 30_000 + " " + "garden " * 20_000)]


@pytest.mark.parametrize("block", [spelling.BLOCK, 4])
def test_variants(spark, empty, block):
    rows = misspelt()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    words = spelling.vocabulary(df, slip_every=199)
    expected = slipped_words(rows)
    assert dict(map(tuple, words.collect())) == expected
    found = sorted(map(tuple, spelling.variants(words, block=block).collect()))
    assert found == plain_variants(expected)
    assert any(row[1] for row in found) and any(row[4] > 3 for row in found)
    assert spelling.variant_report(empty).count() == 0


def test_chains_of_forms_reach_their_root(spark):
    """Each word is five times as frequent as the one before; a tie goes to the smaller word."""
    words = [("a" * 6 + "b" * k, 5 ** (k + 1)) for k in range(12)] + [("zzzzza", 50), ("zzzzzb", 50), ("zzzzzc", 5)]
    got = spelling.variants(spark.createDataFrame(words, "word string, n long"))
    assert sorted(map(tuple, got.collect())) == plain_variants(dict(words))
    assert {r.root for r in got.filter("word like 'aaaaaa%'").collect()} == {"a" * 6 + "b" * 11}
    assert got.filter("word = 'zzzzzc'").first().form == "zzzzza"
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame(words, "word string, n long"), dominance=1)


def test_a_hot_bucket_is_cut_into_blocks(spark):
    """A third of the words begin alike; blocks of 16 find the same pairs."""
    draw = random.Random(1)
    words = {"common" + "".join(draw.choices("abc", k=5)) for _ in range(200)}
    words |= {"".join(draw.choices("defgh", k=draw.randint(6, 8))) for _ in range(400)}
    df = spark.createDataFrame([(w, 5) for w in sorted(words)], "word string, n long")
    pairs = sorted(map(tuple, spelling.near_pairs(df, 16).collect()))
    assert pairs == sorted(map(tuple, spelling.near_pairs(df).collect()))
    assert len(pairs) == len(set(pairs)) == sum(row[4] for row in plain_variants(dict.fromkeys(words, 5)))
    biggest = spelling._meetings(spelling._buckets(df), 16).groupBy("bucket", "x", "y").count().agg(F.max("count")).first()[0]
    assert biggest < 100


# --- decontamination ------------------------------------------------------------------
def polluted():
    draw = random.Random(8)
    vocabulary = [f"v{i}" for i in range(60)] + ["Straße", "naïve", "漢字", "\x85odd"]
    say = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(say(n))) for i, n in enumerate([30, 25, 10, 9, 3, 1, 14])]
    items += [(20, None), (21, ""), (22, "?!"), (2, items[0][1]), (None, " ".join(say(12))), (23, items[1][1])]
    texts = []
    for _ in range(60):
        words = say(draw.randint(0, 80))
        for _ in range(draw.randint(0, 3)):
            taken = terms(draw.choice(items)[1])
            at, cut = draw.randint(0, len(words)), draw.randint(0, 4)
            part = taken[cut : cut + draw.randint(5, 30)]
            if part and draw.random() < 0.5:
                part.insert(draw.randrange(len(part)), "extra")  # a proximity match at best
            words[at:at] = part
        texts.append("-- ".join(words).upper() if draw.random() < 0.3 else " ".join(words))
    texts += [None, "", "...", texts[0], "v1 " * 20_000 + items[0][1]]
    return texts, items


@pytest.mark.parametrize(("block_words", "slice_words"), [(1 << 21, 1 << 20), (100, 15)])
def test_decontamination(spark, block_words, slice_words):
    texts, items = polluted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    index = decontamination.build_index(docs, block_words=block_words)
    hits = decontamination.phrase_matches(index, benchmark, slice_words=slice_words)
    found = decontamination.documents_of(index).join(hits, ["block", "ordinal"], "left").collect()
    expected = plain_matches(texts, items)
    assert len(found) == len(texts)
    for row in found:
        n, hit, exact, near = expected[row.doc_id]
        assert row.n_words == n
        covered = [w for span in row.spans or [] for w in range(span.start, span.stop)]
        assert len(covered) == len(set(covered)) and set(covered) == hit, row.doc_id
        assert set(row["items"] or []) == exact and set(row.near_items or []) == near, row.doc_id
    assert any(near - exact for _, _, exact, near in expected)


def test_decontamination_report(spark, docs, empty):
    texts, items = polluted()
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    report = decontamination.contamination_report(spark.createDataFrame(rows, "doc_id long, text string"), benchmark)
    expected = sorted(
        (
            (i, n, len(hit), len(exact), sha(",".join(sorted(map(str, exact)))), bool(hit), len(near))
            for (i, _), (n, hit, exact, near) in zip(rows, plain_matches(texts, items), strict=True)
        ),
        key=repr,
    )
    assert sorted(map(tuple, report.collect()), key=repr) == expected
    assert decontamination.contamination_report(empty, benchmark).count() == 0
    none = decontamination.contamination_report(docs, benchmark.limit(0)).collect()
    assert len(none) == len(corpus()) and not any(r.contaminated or r.n_items for r in none)
    assert {r.items_sha256 for r in none} == {sha("")}


# --- periodic runs --------------------------------------------------------------------
def found_runs(words):
    hashes = np.array([hash(w) & 0xFFFFFFFF for w in words], dtype=np.uint64)
    out = []
    for a, b in zip(*periodic_runs.surviving_segments(hashes, np.array([0, len(words)])), strict=True):
        out += [(start + int(a), length, period) for start, length, period in periodic_runs.lag_scan(hashes[a:b])]
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    draw = random.Random(2)
    for _ in range(1500):
        words, letters = [], draw.choice([1, 2, 2, 3, 5])
        for _ in range(draw.randint(0, 12)):
            piece = [draw.randint(0, letters) for _ in range(draw.randint(1, 9))]
            words += piece * draw.randint(1, 8) if draw.random() < 0.6 else [draw.randint(0, 9) for _ in piece]
        assert found_runs(words) == plain_runs(words), words


def test_long_runs_take_no_quadratic_time():
    assert found_runs([1] * 100_000) == [(0, 100_000, 1)]
    assert found_runs([0, 1, 2] * 30_000 + [7]) == [(0, 90_000, 3)]
    assert found_runs(list(range(4000)) * 5) == [(0, 20_000, 4000)]


def looped_words(ident, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(ident).encode())
    if ident is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_run_report(spark, docs, empty):
    more = [(i, " ".join(f"t{(i * k) % 11}" for k in range(i % 90)), None, None, 0, "", "") for i in range(100, 400)]
    rows = [r for r in corpus() if len(r[1] or "") < 20_000] + more
    df = spark.createDataFrame(rows, docs.schema).repartition(3)
    expected = []
    for row in rows:
        words = looped_words(row[0], row[1])
        runs = plain_runs(words)
        dropped = {w for start, length, period in runs for w in range(start + period, start + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        expected.append(
            (row[0], len(runs), *best, 1000 * best[1] // best[2] if runs else None,
             sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))
        )
    found = periodic_runs.run_report(df).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert sum(row[1] for row in expected) > 50
    assert periodic_runs.run_report(empty).count() == 0


def test_collapsed_text_keeps_the_first_period(spark):
    df = spark.createDataFrame([(1, "go on  on on on on on\n on stop"), (2, None), (3, "a b\tc")], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.collapsed, [tuple(x) for x in r.runs]) for r in periodic_runs.periodic_runs(df).collect()}
    assert got == {1: (9, "go on stop", [(1, 7, 1)]), 2: (0, "", []), 3: (3, "a b c", [])}
