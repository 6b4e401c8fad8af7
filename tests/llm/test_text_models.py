"""Toxicity and token counts."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import models

from samples import MESSY, documents
from lodestat.llm import toxicity, unigram

FILE = public_tokenizers.path("piece_bpe_32k.model")


@given(st.lists(st.integers(-9, 9), max_size=14))
@settings(max_examples=300, deadline=None)
def test_segments_are_all_maximal_runs(values):
    found = toxicity.segments(np.array(values, float))
    want, work = [], [(0, len(values))]
    while work:  # the best run, then those left and right of it
        a, b = work.pop()
        runs = [(sum(values[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
        best = max(runs, default=(0,))
        if best[0] > 0:
            want.append((best[3], best[4], float(best[0])))
            work += [(a, best[3]), (best[4], b)]
    assert sorted(v for *_, v in found) == sorted(v for *_, v in want)


def _training(n=400, seed=5):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 200))]
        bad = i % 4 == 0
        if bad:
            for w in rng.choices(["zotfool", "zotpig", "zotscum"], k=4):
                words.insert(rng.randint(0, len(words)), w)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    copies = [(n + j, rows[1][1]) for j in range(60)]
    return rows + copies, labels + [(i, 1) for i, _ in copies[:0]]


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = _training()
    docs = documents(spark, rows)
    return docs, labels, toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_toxic_texts_are_found_on_held_out_rows(spark, model):
    docs, labels, fitted = model
    rows = {r.doc_id: r for r in toxicity.score_texts(docs, fitted).collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 50 and sum(rows[i].predicted == y for i, y in held) >= 0.97 * len(held)
    assert all(rows[i].passages for i, y in held if y)
    kept = toxicity.drop_toxic(docs, fitted)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if not r.predicted}


def test_log_odds_scale_and_constant_equal_their_formulas(spark, model):
    docs, labels, fitted = model
    counts = spark.createDataFrame([(b"a", 5, 1), (b"b", 0, 9)], "term binary, y1 long, y0 long")
    for r in toxicity._log_odds(counts, 20.0, 80.0).collect():
        a = toxicity.PRIOR_FLOOR + toxicity.PRIOR_MASS * (r.y1 + r.y0) / 100
        one, two = (r.y1 + a) / (20 + toxicity.PRIOR_MASS - r.y1 - a), (r.y0 + a) / (80 + toxicity.PRIOR_MASS - r.y0 - a)
        assert r.d == pytest.approx(math.log(one / two)) and r.z == pytest.approx(r.d / math.sqrt(1 / (r.y1 + a) + 1 / (r.y0 + a)))
    weights, rates = [2.0, 3.0], [0.01, 0.002]
    scale = toxicity._scale(weights, rates)
    assert sum(p * math.exp(scale * w) for w, p in zip(weights, rates)) + (1 - sum(rates)) * math.exp(-scale * toxicity.DRIFT) == pytest.approx(1)
    sample = toxicity._labelled(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id", "text", "toxic", 10 ** 6)
    found, mass, memory = 0, 0.0, toxicity._Weights(fitted)
    for r in sample.filter("y = 0").collect():
        n, s = toxicity.best_run(fitted, bytes(r.body), memory)
        found, mass = found + (s > 0), mass + n * math.exp(-s)
    assert fitted.log_k == pytest.approx(math.log((found + 0.5) / (mass + 1)))


@pytest.mark.parametrize("n", [0, 1, 2, 5, 30, 5000])
def test_texts_without_a_passage_score_alike_at_any_length(model, n):
    fitted = model[2]
    x, runs = toxicity.significance(fitted, b"calm " * n, toxicity._Weights(fitted))
    assert x == toxicity.NO_RUN and not runs and fitted.probability(x) < toxicity.THRESHOLD
    y, runs = toxicity.significance(fitted, b"calm " * n + b"zotpig zotscum zotfool " + b"calm " * n, toxicity._Weights(fitted))
    assert runs and y >= 0 and fitted.probability(y) >= toxicity.THRESHOLD


def test_held_out_labels_change_nothing(spark, model):
    docs, labels, fitted = model
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    again = toxicity.learn(docs, spark.createDataFrame(turned, "doc_id long, toxic int"))
    assert again.weights == fitted.weights and again.slope == pytest.approx(fitted.slope)


def test_toxicity_of_messy_rows(messy, nothing, spark, model):
    rows = toxicity.score_texts(messy, model[2]).collect()
    assert len(rows) == len(MESSY) and all(0 <= r.score <= 1 and r.predicted == 0 for r in rows)
    assert toxicity.score_texts(nothing, model[2]).collect() == []
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 1)], "doc_id long, toxic int")
    for labels in (none, odd):
        assert toxicity.learn(messy, labels).weights == {}
    assert len(toxicity.score_texts(messy, toxicity.learn(nothing, none)).collect()) == len(MESSY)


def _reference():
    pieces = unigram.read_pieces(FILE)
    low = min(s for _, s in pieces)
    return models.Unigram([("<unk>", low), *pieces, *((f"<0x{i:02X}>", low) for i in range(256))], 0, True)


def test_counts_equal_the_tokenizer(small, messy, nothing):
    tokenizer = _reference()
    for docs in (small, messy):
        want = sorted((r.doc_id or -1, len(tokenizer.tokenize("▁" + r.text.replace(" ", "▁"))) if r.text else 0) for r in docs.collect())
        assert sorted((r.doc_id or -1, r.n_tokens) for r in unigram.count_tokens(docs, FILE).collect()) == want
    assert unigram.count_tokens(nothing, FILE).collect() == []


@given(st.text(alphabet="abt▁ é漢\n", max_size=30))
@settings(max_examples=300, deadline=None)
def test_counts_follow_the_tie_rules(text):
    pieces = [("▁", -1.0), ("a", -1.0), ("b", -2.0), ("ab", -3.0), ("aa", -2.0), ("▁a", -2.0), ("ba", -3.0), ("bab", -4.0), ("▁▁", -2.0), ("é", -3.0)]
    tokenizer = models.Unigram([("<unk>", -4.0), *pieces, *((f"<0x{i:02X}>", -4.0) for i in range(256))], 0, True)
    want = len(tokenizer.tokenize("▁" + text.replace(" ", "▁"))) if text else 0
    assert int(unigram.UnigramCounter(pieces).count(text).real) == want
