"""Packing, the pipeline and the registered queries."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from samples import LONG, MESSY, SF, documents
from lodestat.llm import common, packing
from lodestat.llm.queries import QUERIES
from lodestat.llm.tokens import WordIds

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def _ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def _check(tokenizer, rows, pieces):
    by, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        by[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    assert set(by) == set(texts)
    for i, (text, *more) in texts.items():
        ids, last = _ids(tokenizer, text), 0
        for p in sorted(by[i], key=lambda p: p.start)[::1 + len(more)]:
            assert p.start == last and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[last:last + p.length].tobytes())
            last += p.length
        assert last == len(ids)
    padding = total = 0
    for s in sequences.values():
        s.sort(key=lambda p: p.offset)
        n = sum(p.length for p in s)
        assert [p.offset for p in s] == np.cumsum([0, *(p.length for p in s)])[:-1].tolist() and n <= 4096
        padding += 4096 - n if n & (n - 1) else 0
        total += n
    assert sorted(sequences) == list(range(len(sequences)))
    return padding / total


def test_pieces_of_documents(tokenizer, small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    assert _check(tokenizer, rows, packing.pack(small, FILE).collect()) < 0.02


def test_pieces_of_messy_rows(tokenizer, messy, nothing):
    _check(tokenizer, MESSY, packing.pack(messy, FILE).collect())
    assert packing.pack(nothing, FILE).collect() == []


@given(st.dictionaries(st.integers(16, 256), st.integers(1, 400), max_size=40))
@settings(max_examples=40, deadline=None)
def test_plans_use_each_piece_once_and_fill_windows(histogram):
    made = packing.plan(histogram)
    used, filled = defaultdict(list), defaultdict(int)
    for b, low, behind, first, _ in made.ranges:
        used[b].append((low, behind))
        for s in range(first, first + behind - low):
            filled[s] += b
    for b, spans in used.items():
        spans.sort()
        assert spans[0][0] == 0 and all(x[1] == y[0] for x, y in zip(spans, spans[1:])) and spans[-1][1] <= histogram[b]
    assert set(filled) == set(range(made.sequences)) and set(filled.values()) <= {256}


@given(st.lists(st.lists(st.floats(0, 5), min_size=4, max_size=4), min_size=1, max_size=6), st.lists(st.floats(-5, 5), min_size=4, max_size=4))
@settings(max_examples=100, deadline=None)
def test_least_squares_meet_the_optimality_conditions(columns, goal):
    matrix, goal = np.array(columns).T, np.array(goal)
    x = packing.nonnegative_least_squares(matrix, goal)
    slope = matrix.T @ (goal - matrix @ x)
    assert (x >= 0).all() and slope.max() <= 1e-3 and abs(slope @ x) <= 1e-3 * (1 + abs(goal).max() ** 2)


def test_ids_of_odd_texts(tokenizer):
    words = WordIds(FILE)
    texts = ["", "  ", "a b c", "x<|endoftext|>y <|endoftext|> z", "it's 2024's!!", "é é ́a", "\x1c\x1d a", "Σίσυφος ΣΑΣ", "漢字 " * 50, "<|", "y" * 3000]
    for _ in range(2):
        got = words.encode([t.encode() for t in texts])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [_ids(tokenizer, t)[:-1].tolist() for t in texts]


def test_pipeline_stages(spark, tokenizer):
    import corpus_pipeline as cp

    toxic = [(1000 + i, f"word{i} other{i} zotfool thing{i} stuff{i} zotpig more{i}") for i in range(60)]
    clean = [(2000 + i, " ".join(f"c{i}x{j % 40}y{j}" for j in range(120))) for i in range(60)]
    copies = [(3000, clean[0][1]), (1, clean[1][1]), (3001, clean[2][1] + " tail"), (3002, None)]
    rows = toxic + clean + copies
    docs = documents(spark, rows).select("doc_id", "text", "lang", "body")
    stages = dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    labels = spark.createDataFrame([(i, 0, 1) for i, _ in toxic] + [(i, 1, 0) for i, _ in clean], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, " ".join(clean[5][1].split()[:30]))], "item_id long, text string")
    tables = {"labels": labels, "benchmark": benchmark}
    before, cp.read = cp.read, lambda s, d, name: tables[name]
    try:
        want = {i for i, _ in clean + copies}
        left = stages["toxicity"](spark, docs, SF)
        assert {r.doc_id for r in left.collect()} == want
        left = stages["exact_dedup"](spark, left, SF)
        want -= {2000, 1}
        assert {r.doc_id for r in left.collect()} == want
        left = stages["near_dedup"](spark, left, SF)
        want -= {3001}
        assert {r.doc_id for r in left.collect()} == want
        left = stages["decontamination"](spark, left, SF)
        want -= {2005}
        assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == want
        _check(tokenizer, [(i, t) for i, t in rows if i in want], stages["packing"](spark, left, SF).collect())
    finally:
        cp.read = before


@pytest.mark.parametrize("rows", [MESSY, []])
def test_run_equals_its_stages_one_by_one(spark, monkeypatch, rows):
    """What a stage removes behind itself is not wanted later; empty tables give no pieces."""
    import corpus_pipeline as cp
    from lodestat.session import settle_table

    tables = {"documents": documents(spark, rows), "labels": spark.createDataFrame([(1, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int"),
              "benchmark": spark.createDataFrame([(1, LONG[:3000]), (2, None)], "item_id long, text string")}
    monkeypatch.setattr(cp, "read", lambda s, d, name: tables[name])
    want = tables["documents"]
    for _, stage in cp.STAGES:
        want = settle_table(stage(spark, want, SF))
    got = cp.run(spark, SF)
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert bool(got.count()) == bool(rows)


def test_each_operator_has_one_query():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and "pipeline" in names and set(QUERIES) <= set(names)
    assert set(entry.oracle_sql()) <= set(names)


def test_words_with_signs_reduce_to_others(tokenizer, monkeypatch):
    words = WordIds(FILE)
    words.encode(["wort été *** ). !".encode()])
    asked = []
    encode = words._encode
    monkeypatch.setattr(words, "_encode", lambda new: asked.extend(new) or encode(new))
    text = "wort*** été). wort! été***"
    assert words.encode([text.encode()])[0] == _ids(tokenizer, text)[:-1].tobytes() and asked == []


@pytest.mark.parametrize("text", ["Aİ| sİ.", "É!! é\u0301.. e\u0301, ª. ǀ!", "'s. x's, y'T.", "a<|. <|endoftext|>. b<|endoftext|>!", "½. 1, 本. ×. ſ!", "= a. =\u0338, "])
def test_signs_behind_odd_letters(tokenizer, text):
    assert WordIds(FILE).encode([text.encode()])[0] == _ids(tokenizer, text)[:-1].tobytes()


def test_packing_takes_small_batches_and_gives_arrow_memory_back(spark, small, monkeypatch):
    given = []
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: type("Pool", (), {"release_unused": lambda self: given.append(1)})())
    assert list(common.giving_back(iter)([1, 2])) == [1, 2] and given == [1]
    monkeypatch.undo()
    packing.pack(small, FILE)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == packing._BATCH < common.BATCH_BYTES
