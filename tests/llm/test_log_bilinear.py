"""Counts and base scores against plain ones; the model is normalised, learns, and is learned from all texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import log_bilinear as L
from shelfwise.llm.common import table

SF = "/root/testdata/sf0.01"


def tokens(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", text), None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) of rows (doc_id, text)."""
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, kinds = sum(counts.values()), len(counts)
    return [(i, held(i), len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), n, sum(math.log10((counts[t] + 1) / (n + kinds + 1)) for t in tokens(text))) for i, text in rows]


def same(df, rows):
    key = lambda r: tuple(str(v) for v in r[:4])
    got = sorted((tuple(r) for r in df.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score").collect()), key=key)
    want = sorted(brute(rows), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)


def test_counts_and_learning(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    scored = L.language_model_scores(table(spark, SF, "documents")).cache()
    same(scored, rows)
    sums = {r["held_out"]: r for r in scored.groupBy("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.max("score").alias("m")).collect()}
    assert sums[True]["s"] > sums[True]["b"] and sums[False]["s"] > sums[False]["b"]
    assert sums[True]["m"] < 0


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(1)
    shape = L.Shape(outputs=20, width=4, context=2)
    model = L.LogBilinear.fresh(shape, rng.integers(1, 50, 21).astype(float))
    model = model.with_flat(rng.normal(0, 1, len(model.flat())))
    contexts = rng.integers(0, 22, (5, 2))
    for c in contexts:
        p = 10 ** model.log10_probabilities(np.arange(21), np.repeat(c[None], 21, axis=0), block=2)
        q = model.inputs[c[0]] * model.places[0] + model.inputs[c[1]] * model.places[1]
        logits = model.outputs @ q + model.bias
        assert np.allclose(p, np.exp(logits) / np.exp(logits).sum(), rtol=1e-4) and abs(p.sum() - 1) < 1e-5


def test_contexts_stay_in_their_text():
    model = L.LogBilinear.fresh(L.Shape(outputs=5, context=2), np.ones(6))
    got = model.contexts(np.array([1, 2, 0, 0, 3, 0]), np.array([False, False, True, True, False, True]))
    assert got.tolist() == [[6, 6], [1, 6], [2, 1], [6, 6], [6, 6], [3, 6]]
    assert model.contexts(np.array([0]), np.array([True])).tolist() == [[6, 6]]


def test_steps_follow_the_noise_contrastive_gradient():
    """The change of all parameters against numerical slopes of the objective with the same noise words."""
    shape = L.Shape(outputs=6, width=3, context=2, noise=4, rate=1.0)
    rng = np.random.default_rng(5)
    model = L.LogBilinear.fresh(shape, rng.integers(1, 9, 7).astype(float))
    model = model.with_flat(rng.normal(0, 0.5, len(model.flat())))
    ids, contexts = rng.integers(0, 7, 5), rng.integers(0, 8, (5, 2))
    learner = L.Learner(model, 0)
    noise = np.minimum(np.searchsorted(learner.steps, np.random.default_rng([shape.seed, 0]).random(4) * learner.steps[-1]), 6)
    odds = np.log(4 * model.noise)

    def objective(flat):
        m = model.with_flat(flat)
        inputs, places, outputs, bias = (x.astype(float) for x in (m.inputs, m.places, m.outputs, m.bias))
        q = sum(inputs[contexts[:, i]] * places[i] for i in range(2))
        true = (q * outputs[ids]).sum(axis=1) + bias[ids] - odds[ids]
        false = q @ outputs[noise].T + bias[noise] - odds[noise]
        return -np.log1p(np.exp(-true)).sum() - np.log1p(np.exp(false)).sum()

    flat = model.flat()
    slopes = np.array([(objective(flat + d) - objective(flat - d)) / 0.02 for d in np.eye(len(flat)) * 0.01])
    learner._step(ids, contexts)
    moved = learner.model.flat() - flat
    scaled = slopes / math.sqrt(5)
    assert np.allclose(moved, scaled / np.sqrt(0.1 + scaled**2), atol=5e-3)


def test_all_texts_teach(spark, monkeypatch):
    """A pattern that only the texts of one chunk show is known in the average; small chunks give the same counts."""
    monkeypatch.setattr("shelfwise.llm.encoded.CHUNK", 4000)
    rows = [(i, f"red blue green {'left right ' * 40}") for i in range(60)] + [(100 + i, "up down " * 40) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, value string").repartition(4)
    scored = L.language_model_scores(docs).cache()
    same(scored, rows)
    gain = scored.groupBy((F.col("doc_id") >= 100).alias("late")).agg((F.sum("score") - F.sum("base_score")).alias("gain")).collect()
    assert all(r["gain"] > 0 for r in gain)


def test_odd_rows(spark, make, odd_rows):
    same(L.language_model_scores(make(odd_rows)), [(r[0], r[1]) for r in odd_rows])
    out = L.language_model_scores(make([(None, "a"), (None, None)])).collect()
    assert [r["held_out"] for r in out] == [False, False] and all(r["score"] <= 0 for r in out)


@pytest.mark.parametrize("rows", [[], "held"])
def test_nothing_to_learn_from(spark, make, rows):
    only = [(i, "a b") for i in range(40) if held(i)] if rows else []
    found = L.language_model_scores(make(only)).collect()
    assert len(found) == len(only)
    assert all((r["train_tokens"], r["n_known"], r["base_score"], r["score"]) == (0, 0, 0.0, 0.0) for r in found)
