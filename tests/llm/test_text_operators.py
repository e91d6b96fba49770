"""Quality rules, shingle join, suffix dedup, tokens: compared with plain computations."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from llm_corpus import WORD, corpus
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from keepwell.llm import bpe_tree, jaccard_join, quality_rules, suffix_dedup, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def plain_metrics(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside),
            n < 20 or 100 * len(inside) > 30 * n)


def test_quality_metrics(docs, empty):
    found = Counter(tuple(r)[:7] for r in quality_rules.quality_report(docs).collect())
    assert found == Counter((row[0], *plain_metrics(row[1])) for row in corpus())
    assert quality_rules.quality_report(empty).count() == 0


def test_thresholds_follow_the_group(spark):
    """Symbols are normal in one source and outlandish in the other; all else is equal."""
    clean, noisy = " ".join(f"word{i}" for i in range(40)), " ".join(f"word{i} #" for i in range(40))
    rows = [(i, clean, "en", "prose") for i in range(200)] + [(i + 200, noisy, "en", "code") for i in range(200)]
    rows += [(999, noisy, "en", "prose"), (998, noisy, "en", "tiny"), (997, clean, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    dropped = {r.doc_id for r in quality_rules.quality_report(df).filter("not kept").collect()}
    assert 999 in dropped and 997 not in dropped and not dropped & set(range(400))
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - len(dropped)


def plain_components(rows):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for row in rows:
        words = WORD.findall((row[1] or "").translate(fold))
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}
        sets.append(grams)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i, row in enumerate(rows):
        if row[0] is not None:
            members[find(i)].append(row[0])
    return Counter((r[0], len(sets[i]), min(members[find(i)], default=None)) for i, r in enumerate(rows))


def test_jaccard_components(docs, empty):
    assert Counter(map(tuple, jaccard_join.near_duplicates(docs).collect())) == plain_components(corpus())
    assert jaccard_join.near_duplicates(empty).count() == 0


def test_crowded_list_loses_no_link(spark, monkeypatch):
    """Chains of near copies around one base, with lists longer than what is compared at once."""
    monkeypatch.setattr(jaccard_join, "SHORT", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rows = []
    for i in range(120):
        words = [f"b{k}" for k in range(100)]
        for edit in range(i % 9):
            words[(11 * edit + 3 * i) % 100] = f"own{i}x{edit}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, jaccard_join.near_duplicates(df).collect())) == plain_components(rows)


def test_first_of_each_group_stays(docs):
    kept = jaccard_join.first_of_each(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[0] == 1 and 1 not in ids and 2 not in ids and 8 not in ids and 10 not in ids
    assert {3, 4, 5, 6, 7, 9, 11, 12, None} <= set(ids)


def plain_repeats(rows):
    seen, spans = set(), defaultdict(set)
    for key, text in sorted({(r[0] if r[0] is not None else -1, r[1] or "") for r in rows}):
        words = WORD.findall(text)
        for i in range(len(words) - 49):
            window = tuple(words[i : i + 50])
            if window in seen:
                spans[key].update(range(i, i + 50))
            seen.add(window)
    return dict(spans)


def test_repeated_passages(docs, empty):
    found, rows = defaultdict(set), suffix_dedup.repeat_report(docs).collect()
    texts = {r[0]: WORD.findall(r[1] or "") for r in corpus()}
    for r in rows:
        found[r.doc_id].update(range(r.word_start, r.word_start + r.n_words))
        here = texts[r.doc_id][r.word_start : r.word_start + r.n_words]
        there = texts[r.first_doc_id][r.first_word_start : r.first_word_start + r.n_words]
        assert here == there
    assert dict(found) == plain_repeats(corpus())
    assert suffix_dedup.repeat_report(empty).count() == 0


def test_passages_are_cut_out(docs):
    left = suffix_dedup.without_repeats(docs)
    assert left.columns == docs.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    rows = {r[0]: r[1] for r in corpus()}
    for doc, words in plain_repeats(corpus()).items():
        kept = [w for i, w in enumerate(WORD.findall(rows[doc])) if i not in words]
        assert WORD.findall(texts.get(doc) or "") == kept
    assert texts[11] == rows[11] and texts[3] is None and 1 not in texts


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=bpe_tree.read_ranks(RANKS), special_tokens={})


def test_tree_codec_equals_the_library(docs, empty, library):
    expected = Counter()
    for row in corpus():
        ids = library.encode_ordinary(row[1] or "")
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        expected[row[0], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((row[1] or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe_tree.codec_report(docs, RANKS, PATTERN).collect())) == expected
    assert bpe_tree.codec_report(empty, RANKS, PATTERN).count() == 0


def test_joins_at_every_seam(library):
    codec = bpe_tree.TreeCodec(bpe_tree.read_ranks(RANKS), PATTERN, leaf=3)
    for text in ("it's   a\n\n test's 12ab", "  lead", "漢字。かな、x", "a'", "aaaa    b'rest", "....!!a  ", ""):
        assert codec.encode(text).tolist() == library.encode_ordinary(text)
        for cut in range(len(text) + 1):
            a, b = text[:cut], text[cut:]
            assert codec.join(a, codec.encode(a), b, codec.encode(b)).tolist() == library.encode_ordinary(text)


def test_token_counts_equal_the_library(docs, empty):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    expected = Counter()
    for row in corpus():
        n = len(tokenizer.encode(row[1] or "", add_special_tokens=False).ids)
        expected[row[0], len((row[1] or "").encode()), n, n > 1024] += 1
    report = token_counts.count_report(docs, VOCABULARY, PATTERN).collect()
    assert Counter(tuple(r)[:4] for r in report) == expected
    texts = {r[0]: r[1] or "" for r in corpus()}
    count = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
    for r in report:
        text = texts[r.doc_id]
        assert r.over_limit == (r.fit_chars < len(text)) and count(text[: r.fit_chars]) <= 1024
        beyond = range(r.fit_chars + 1, min(len(text), r.fit_chars + 30) + 1)
        assert all(count(text[:i]) > 1024 for i in beyond)
    assert any(r.over_limit for r in report)
    assert token_counts.count_report(empty, VOCABULARY, PATTERN).count() == 0


def test_every_prefix_is_counted():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    counter = token_counts.PrefixCounter(VOCABULARY, PATTERN)
    for text in ("it're   don't  <|endoftext|>x <|endo", "  né漢😀\n\n 12345's", "abc'll  ", "internationalisation"):
        counts = counter.prefix_counts(text)
        expected = [len(tokenizer.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert counts.tolist() == expected
        assert token_counts.fits(counts, 3) == max(i for i, n in enumerate(expected) if n <= 3)


def test_the_longest_prefix_within_any_budget():
    """Found from the table of piece borders, equal to the answer of the table of all prefixes."""
    counter = token_counts.PrefixCounter(VOCABULARY, PATTERN)
    draw = random.Random(6)
    bits = ["a", "the", "  ", "\n\n ", "don't", "12345", "é", "漢字", "😀", " ,.!", "internationalisation", "\t", "<|endoftext|>", "'ll"]
    for i in range(120):
        text = "".join(draw.choice(bits if i % 3 else bits[:-2]) for _ in range(draw.randint(0, 25)))
        table, counts = counter.table(text), counter.prefix_counts(text)
        assert (table[0][-1], table[1][-1]) == (len(text), counts[-1])
        for budget in range(int(counts[-1]) + 2):
            assert counter.longest(text, table, budget) == token_counts.fits(counts, budget), (text, budget)


def test_prefix_table(docs):
    table = {r.doc_id: r.counts for r in token_counts.prefix_table(docs, VOCABULARY, PATTERN).collect()}
    assert len(table[6]) == 4 * (len("one two") + 1) and table[3] == b"\0\0\0\0"


def test_a_stage_writes_extra_columns_untouched(docs):
    assert quality_rules.keep_good(docs).filter(F.col("size") != "clash").count() == 0
