"""Top-k, toxicity, chat formatting, mixing, sharding and the pipeline: compared with plain computations."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
from llm_corpus import WORD, corpus, sentence
from pyspark.sql import functions as F

from keepwell.llm import chat, mixing, sharding, topk, toxicity


def test_top_k_is_exact(spark):
    draw = random.Random(3)
    rows = [(i, [draw.gauss(0, 0.3) for _ in range(8)]) for i in range(400)]
    rows += [(400, rows[7][1]), (401, None), (402, [1.0, None]), (403, [float("nan")] * 8), (404, [math.inf] * 8)]
    rows += [(405, []), (406, [0.5]), (None, rows[3][1]), (500, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    vectors = topk.quantised(df).cache()
    for r in topk.top_k(vectors, vectors.filter("id % 20 = 0"), k=6, block=64, batch=5).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    plain = {r.id: list(r.v) for r in vectors.collect()}
    assert not {401, 402, 403, 404, None} & set(plain)
    for q in (i for i in plain if i % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(plain[q], v)), i) for i, v in plain.items() if i != q)[:6]
        assert sorted(got[q]) == [(n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    assert topk.search_report(df.limit(0)).count() == 0


def test_top_k_of_repeated_query_ids(spark):
    """31 query rows of one id, dealt into batches of 4, each get their own result."""
    draw = random.Random(4)
    rows = [(i, [draw.gauss(0, 1) for _ in range(6)]) for i in range(1, 60) if i % 20] + [
        (20, [draw.gauss(0, 1) for _ in range(6)]) for _ in range(31)
    ]
    vectors = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).cache()
    got = topk.top_k(vectors, vectors.filter("id % 20 = 0"), k=20, block=16, batch=4)
    assert got.count() == 31 * 20 and got.filter("vec_id = 20").count() == 0
    assert {r["count"] for r in got.groupBy("rank").count().collect()} == {31}


def test_top_k_of_odd_vectors(spark):
    """Vectors without components, of different lengths, all alike, or all zero."""
    rows = [(i, []) for i in range(5)] + [(100 + i, [1.0] * (i % 4)) for i in range(40)] + [(200 + i, [0.0, 0.0]) for i in range(30)]
    vectors = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).cache()
    plain = {r.id: list(r.v) for r in vectors.collect()}
    got = defaultdict(list)
    for r in topk.top_k(vectors, vectors.filter("id % 20 = 0"), k=7, block=8, batch=3).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in plain if i % 20 == 0}
    for q, found in got.items():
        scored = sorted((-sum(a * b for a, b in zip(plain[q], v)), i) for i, v in plain.items() if i != q)[:7]
        assert sorted(found) == [(n, i, -s) for n, (s, i) in enumerate(scored, 1)]


def test_the_bound_ends_a_search_early():
    """Where few components carry the score, a small part of the rows is scored; the result is the whole search's."""
    draw = np.random.default_rng(7)
    width = 0.5 ** np.arange(12)
    share = {}
    for name, scale in (("few", width), ("alike", np.ones(12))):
        rows = np.floor(64 * draw.normal(size=(6000, 12)) * scale).astype(np.int32)
        ids = np.arange(6000)
        lists = [
            topk.SortedLists(ids[a : a + 2000], rows[a : a + 2000], np.argsort(rows[a : a + 2000], axis=0, kind="stable"))
            for a in range(0, 6000, 2000)
        ]
        queries, own = rows[:100].astype(np.float64), ids[:100]
        state = [(np.zeros(0), np.zeros(0, np.int64))] * 100
        for block in lists:
            block.search(queries, own, 10, state)
        for q in range(100):
            scores = (rows @ rows[q].astype(np.int64)).astype(np.int64)
            best = [i for i in np.lexsort((ids, -scores)) if i != q][:10]
            assert state[q][1].tolist() == best and state[q][0].tolist() == scores[best].tolist()
        share[name] = sum(block.scored for block in lists) / (100 * 6000)
    assert share["few"] < 0.35 < share["alike"] <= 1


def test_toxicity_learns_from_the_training_part_only(spark):
    draw = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        words = sentence(i % 37, 30).split() + [draw.choice(["vile", "rotten"])] * (i % 3 == 0)
        draw.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    rows += [(1000, None), (1001, ""), (None, "vile")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (5000, 1), (7, None), (None, 1)], "doc_id long, toxic int")
    report = {r.doc_id: r for r in toxicity.toxicity_report(docs, marks).collect()}
    truth, held = dict(labels), [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(report[i].held_out == (i in set(held)) for i in range(600))
    assert sum(report[i].predicted == truth[i] for i in held) >= 0.95 * len(held)
    assert report[1000].score == report[1001].score and 0 <= report[1000].score <= 1
    untaught = toxicity.toxicity_report(docs, marks.limit(0)).collect()
    assert {r.score for r in untaught} == {0.5}


def test_chat_reads_back(spark):
    turns = {
        1: [("system", "be <s>brief</s>"), ("user", "a"), ("user", "b\\<|+|>"), ("assistant", "[INST] <\\|x|> </s>"), ("assistant", "")],
        2: [("assistant", None), ("we|rd|>\nrole", "x"), (None, "<|assistant|>\n")],
        None: [("user", "no id")],
    }
    rows = [(c, i, r, t) for c, ts in turns.items() for i, (r, t) in enumerate(ts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    turns[-1] = [("user", chat.CONTROL_TEXT), ("assistant", chat.CONTROL_TEXT)]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in chat.formatting_report(df).collect():
        own = [(a or "", b or "") for a, b in turns[r.conv_id]]
        loss = "".join(b for a, b in own if a == "assistant")
        told = "".join(f"{a}\n{b}\n" for a, b in own)
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(own), digest(told), len(loss), digest(loss))
    made = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert made[1].formatted.count("<|user|>") == 1  # adjacent turns of one role share a block
    at, masked = 0, ""
    for run in made[1].loss_runs:
        masked += made[1].formatted[at : at + run.n_chars] if run.loss else ""
        at += run.n_chars
    assert at == len(made[1].formatted) and masked == "[\\INST] <\\\\|\\x|\\> <\\/s>"
    assert chat.formatting_report(df.limit(0)).count() == 1
    # the digest of the loss is that of what the mask covers: without a mask nothing is left
    plan = chat.formatting_report(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "loss_runs" in plan
    unmasked = F.transform("loss_runs", lambda r: F.struct(r["n_chars"].alias("n_chars"), F.lit(False).alias("loss")))
    texts = chat.format_conversations(df).select(chat.masked_texts(F.col("formatted"), unmasked).alias("t"))
    assert {tuple(r.t) for r in texts.collect()} == {()}


def test_adjacent_turns_are_merged_into_blocks(spark):
    turns = [("u", "1"), ("u", None), ("a", "2"), ("u", "3"), ("u", "4"), ("u", "5")]
    df = spark.createDataFrame([(turns,), ([],)], "t array<struct<role:string,text:string>>")
    merged = [[(b.role, b.texts) for b in r[0]] for r in df.select(chat.merge_turns(F.col("t"))).collect()]
    assert merged == [[("u", ["1", None]), ("a", ["2"]), ("u", ["3", "4", "5"])], []]


def test_a_long_conversation(spark):
    rows = [(1, i, "assistant" if i % 4 > 1 else "user", f"<|{i}|> [x] é") for i in range(4000)]
    r = chat.formatting_report(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).filter("conv_id = 1").first()
    loss = "".join(t for _, _, role, t in rows if role == "assistant")
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (4000, len(loss), hashlib.sha256(loss.encode()).hexdigest())


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, total, full = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in full]
        rest = total - sum(full.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**share, **full}
        full |= {s: 3 * sizes[s] for s in over}


def test_mixture_meets_its_targets(spark, docs, empty):
    draw = random.Random(1)
    rows = [(i, "w " * draw.randint(0, 40), f"s{min(i % 40, 6)}") for i in range(3000)] + [(9000, "w " * 900, None), (9001, None, "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for frame in (df.repartition(7), docs):
        found = frame.select("doc_id", "source", "text").collect()
        sizes, taken = Counter(), Counter()
        for r in found:
            sizes[r.source] += len(WORD.findall(r.text or ""))
        target = plain_targets(sizes)
        by_target = {r.doc_id: r for r in mixing.mixture_report(frame).collect()}
        source = {r.doc_id: r.source for r in found}
        report = mixing.mixture_report(frame).collect()
        assert len(report) == len(found)
        for r in report:
            assert r.taken <= 3 * r.size and math.isclose(r.target, target[source[r.doc_id]], rel_tol=1e-9, abs_tol=1e-9)
            assert by_target[r.doc_id].taken == r.taken  # reruns agree
            taken[source[r.doc_id]] += r.taken
        assert all(abs(taken[s] - target[s]) <= 2 for s in sizes)
    assert mixing.mixture_report(empty).count() == 0 and mixing.mixed_documents(docs).columns == docs.columns


def test_shards_are_even_and_numbered(spark, docs, empty):
    draw = random.Random(2)
    rows = [(i, sentence(0, 9) if i % 3 == 0 else "x" * draw.randint(0, 60)) for i in range(6000)] + [(7, "dup")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    report = sharding.shard_report(df).collect()
    assert len(report) == len(rows)
    size, slots = Counter(), defaultdict(list)
    for r in report:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(size) == 24 and max(size.values()) - min(size.values()) <= 0.03 * sum(size.values()) / 24 + 2 * 80
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    small = sharding.shard_report(docs.select("doc_id", "text")).collect()
    assert Counter((r.doc_id, r.text_crc32) for r in small) == Counter((r[0], zlib.crc32((r[1] or "").encode())) for r in corpus())
    assert sharding.shard_report(empty).count() == 0


def test_pipeline_runs_over_all_stages(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5
    ids = {r.doc_id for r in out}
    assert ids <= {0, 9, 11, 12, 14, 16, None} and 11 in ids | {0, 9, 12}
    assert all(r.n_tokens * 4 == len(r.ids) for r in out)
