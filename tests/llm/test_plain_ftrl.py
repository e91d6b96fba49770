"""The trained weights, number by number, against a scalar FTRL-proximal over dictionaries."""

import math
import random

import numpy as np
import pyarrow as pa
from llm_corpus import sentence
from pyspark.sql import functions as F

from keepwell.llm import toxicity


def weight(z, n):
    if abs(z) <= toxicity.L1:
        return 0.0
    return -(z - math.copysign(toxicity.L1, z)) / ((toxicity.BETA + math.sqrt(n)) / toxicity.ALPHA + toxicity.L2)


def learn(z, n, slots, label):
    """One document: predict, then move each of its coordinates at its own rate."""
    weights = {s: weight(z.get(s, 0.0), n.get(s, 0.0)) for s in slots}
    p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(weights.values())))))
    g = p - label
    for s in slots:
        old = n.get(s, 0.0)
        sigma = (math.sqrt(old + g * g) - math.sqrt(old)) / toxicity.ALPHA
        z[s] = z.get(s, 0.0) + g - sigma * weights[s]
        n[s] = old + g * g


def slots_of(text):
    (words,) = toxicity._texts(pa.array([text], pa.string()))
    return sorted({*toxicity._features(words).tolist(), toxicity.INTERCEPT})


def test_steps_of_one_shard():
    draw = random.Random(1)
    z, n = np.zeros(1 << toxicity.BITS), np.zeros(1 << toxicity.BITS)
    plain_z, plain_n = {}, {}
    for i in range(300):
        slots, label = slots_of(sentence(i % 9, draw.randint(1, 12))), float(i % 9 < 3)
        toxicity._train(z, n, np.array(slots), label)
        learn(plain_z, plain_n, slots, label)
    assert np.allclose([z[s] for s in plain_z], list(plain_z.values()), rtol=1e-9, atol=1e-12)
    assert np.allclose([n[s] for s in plain_n], list(plain_n.values()), rtol=1e-9, atol=1e-12)
    assert set(np.flatnonzero(n)) == set(plain_n)
    assert np.allclose(toxicity._weights(z, n)[list(plain_z)], [weight(plain_z[s], plain_n[s]) for s in plain_z], rtol=1e-9)


def test_rounds_over_all_shards(spark):
    """Shards start from the average of the round before and meet their pieces' documents in the drawn order."""
    draw = random.Random(2)
    rows = [(i, sentence(i % 11, draw.randint(2, 20)) + (" vile" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(240)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, mark) for i, _, mark in rows], "doc_id long, toxic int")
    drawn = F.xxhash64(F.lit(7), "doc_id")
    taught = labels.filter(~toxicity.held_out(F.col("doc_id"))).select(
        "doc_id", "toxic", drawn.alias("d"), F.pmod(drawn, F.lit(toxicity.SHARDS)).alias("shard"),
        F.pmod(F.shiftright(drawn, 8), F.lit(toxicity.PIECES)).alias("piece"),
    ).collect()
    texts = {i: text for i, text, _ in rows}
    shards = {}
    for r in sorted(taught, key=lambda r: (r.d, r.toxic)):
        shards.setdefault(r.shard, {}).setdefault(r.piece, []).append((slots_of(texts[r.doc_id]), float(r.toxic)))
    z, n = {}, {}
    for round_ in range(2):
        states = []
        for pieces in shards.values():
            own_z, own_n = dict(z), dict(n)
            for piece, documents in sorted(pieces.items()):
                for i in np.random.RandomState([round_, piece]).permutation(len(documents)):
                    learn(own_z, own_n, *documents[i])
            states.append((own_z, own_n))
        z, n = ({s: sum(float(np.float32(state[k].get(s, 0.0))) for state in states) / len(states)
                 for s in {s for state in states for s in state[k]}} for k in (0, 1))
    found = toxicity.train(docs, labels, rounds=2)
    expected = {s: weight(z[s], n[s]) for s in z}
    # the order of a shard's pieces is that of its files; it moves weights a little, their signs and zeros not
    assert np.corrcoef([found[s] for s in expected], list(expected.values()))[0, 1] > 0.99
    assert all((found[s] > 0) == (w > 0) for s, w in expected.items() if abs(w) > 0.2)
    assert set(np.flatnonzero(found)) <= set(expected)
