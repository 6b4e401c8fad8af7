"""Byte-level BPE, the filter audit and importance resampling, against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from samples import LONG, MESSY, documents
from lodestat.llm import bytepairs, filter_audit, resampling

FILE, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = bytepairs.read_ranks(FILE)
WANTED = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODER = bytepairs.BytePairs(RANKS, PATTERN)


@pytest.fixture
def short_leaves(monkeypatch):
    """Leaves so short that every text and most matches are joined from parts."""
    monkeypatch.setattr(bytepairs, "TEXT_LEAF", 5)
    monkeypatch.setattr(bytepairs, "MATCH_LEAF", 1)
    return bytepairs.BytePairs(RANKS, PATTERN)


def test_joined_parts_encode_as_the_library_does(short_leaves):
    rng = random.Random(3)
    alphabet = ["'", "s", "t", "re", "ll", " ", " ", "\n", "\t", "the", "ing", "1", "é", "漢", ",", ".", "\x1c", "\x85", "　", "<|endoftext|>"]
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
        ids = short_leaves.encode(text)
        assert ids == WANTED.encode_ordinary(text), text
        assert short_leaves.decode(ids) == text.encode()


@given(st.text(max_size=60))
@settings(max_examples=400, deadline=None)
def test_any_text_encodes_as_the_library_does(text):
    assert CODER.encode(text) == WANTED.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, "=-" * 3000, " " * 3000 + "x", "漢字" * 1500, "na" * 999 + "n", "\n" * 2000, LONG])
def test_long_runs_and_long_texts(text):
    assert CODER.encode(text) == WANTED.encode_ordinary(text)


def test_merging_with_a_heap_equals_merging_without_one():
    rng = random.Random(4)
    for _ in range(500):
        body = "".join(rng.choice("aeinst =-") for _ in range(rng.randint(1, 60))).encode()
        assert CODER._merge_long(body) == CODER._merge_short(body)


def test_small_memories_change_nothing(monkeypatch):
    monkeypatch.setattr(bytepairs, "REMEMBERED_BYTES", 500)
    monkeypatch.setattr(bytepairs, "REMEMBERED_PARTS", 3)
    assert bytepairs.BytePairs(RANKS, PATTERN).digest(LONG) == CODER.digest(LONG)


def _pairs(i, text):
    ids = WANTED.encode_ordinary(text or "")
    return (i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_round_trip_of_messy_rows(spark, messy, nothing, rows):
    assert rows(bytepairs.round_trip(messy, FILE, PATTERN)) == sorted((_pairs(i, t) for i, t in MESSY), key=repr)
    assert rows(bytepairs.round_trip(nothing, FILE, PATTERN)) == []
    encoded = bytepairs.encode_texts(messy, FILE, PATTERN)
    assert rows(bytepairs.decode_ids(encoded, FILE)) == sorted(((i, bytearray((t or "").encode())) for i, t in MESSY), key=repr)


def test_round_trip_of_real_documents(small, rows):
    assert rows(bytepairs.round_trip(small, FILE, PATTERN)) == sorted((_pairs(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()), key=repr)


def _audited(table, labels):
    """Brute force over ``(doc_id, text, part)`` rows and ``(doc_id, quality, toxic)`` labels."""
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    first = {}
    for i, t, _ in table:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    failing, out = [], []
    for i, t, p in table:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        failing.append((p or "", {f for f in fails if fails[f]}, i in good and i is not None, i in toxic and i is not None))
    for part in {p or "" for *_, p in table}:
        docs, steps = [x for x in failing if x[0] == part], []
        for order in map("".join, itertools.permutations("ABCDE")):
            left = docs
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                early = [x for x in docs if f in x[1] and x[1] & set(order[:k])]
                alone = [x for x in docs if x[1] == {f}]
                steps.append((part, order, k + 1, len(left), len(gone), len(early), len(alone), sum(x[2] for x in gone), sum(x[3] for x in gone), f))
        total = Counter()
        for s in steps:
            total[s[9]] += s[4]
        out += [(*s[:9], total[s[9]]) for s in steps]
    return sorted(out, key=repr)


def _corpus(rng, n=120):
    common = " ".join(f"w{i}" for i in range(230))
    texts = [common, common + " A#", "w " * 300, "Big WORDS " * 120, "", None, common.upper(), common + " tail", "x | y"]
    table = [(rng.choice([i, i, i, 7, None]), rng.choice(texts) if rng.random() < 0.8 else common, rng.choice(["en", "fr", None, ""])) for i in range(n)]
    return table, [(rng.randrange(n), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(n)] + [(None, 1, 1)]


def test_audit_equals_brute_force(spark, rows):
    table, labels = _corpus(random.Random(8))
    docs = spark.createDataFrame([(i, t, p, "x", 1) for i, t, p in table], "doc_id long, text string, lang string, part string, n long").repartition(5)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert rows(filter_audit.audit(docs, known)) == _audited(table, labels)


def test_audit_of_empty_tables(spark, nothing, messy, rows):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert rows(filter_audit.audit(nothing, labels)) == []
    assert rows(filter_audit.audit(messy, labels)) == _audited([(i, t, "en") for i, t in MESSY], [])


def test_audit_flushes_parts_beyond_its_bound(spark, rows, monkeypatch):
    monkeypatch.setattr(filter_audit, "HELD_PARTS", 1)
    table, labels = _corpus(random.Random(9), 40)
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string")
    packing = filter_audit.Packing("ABCDE")
    run = filter_audit._sum_outcomes(packing)
    cells = filter_audit.cells(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).toArrow().to_batches()
    totals = Counter()
    for batch in run(cells):
        for p, value in zip(batch.column("part").to_pylist(), batch.column("total").to_pylist()):
            totals[p] += int.from_bytes(value, "little")
    want = _audited(table, labels)
    for part, total in totals.items():
        columns = packing.unpack(packing.packed(total))
        assert sorted(columns["kept"].tolist()) == sorted(r[3] for r in want if r[0] == part)


def test_fields_hold_more_rows_than_any_table_and_do_not_overflow():
    packing = filter_audit.Packing("AB")
    words, most = packing.words(), 2 ** 63 - 1
    columns = packing.unpack(packing.packed(most * words[3][3]))
    assert packing.orders == ["AB", "BA"]
    assert columns["removed"].tolist() == [most, 0, most, 0] and columns["redundant"].tolist() == [0, most, 0, most]
    assert columns["good_lost"].tolist() == columns["toxic_lost"].tolist() == [most, 0, most, 0]


def test_facts_of_a_text_cut_into_pieces(monkeypatch):
    whole = filter_audit.facts_of(LONG.encode())
    monkeypatch.setattr(filter_audit, "PIECE", 100)
    assert filter_audit.facts_of(LONG.encode()) == whole
    assert whole.words == len(LONG.split()) and whole.distinct == len(set(LONG.split()))


def _drawn(table, target, longest=1, buckets=10_000, percent=10):
    """Brute force of ``(doc_id, n_words, n_features, weight, score, rank)``."""
    def words(t):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    def buckets_of(t):
        w = words(t)
        return [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(w) - k + 1)]

    s, t = Counter(b for _, x in table for b in buckets_of(x)), Counter(b for x in target for b in buckets_of(x))
    total_s, total_t, out = sum(s.values()), sum(t.values()), []
    for i, x in table:
        found = buckets_of(x)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in found)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(words(x)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2]))
    rank = {}
    for place, r in enumerate(fit[:percent * len(fit) // 100], 1):
        rank.setdefault(r, []).append(place)
    return sorted(((*r, (rank.get(r) or [None]).pop(0) if rank.get(r) else None) for r in out), key=repr)


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_equals_brute_force(spark, small, rows, longest, monkeypatch):
    monkeypatch.setattr(resampling, "PIECE", 300)
    table = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()] + MESSY
    target = [t for _, t in table[:15]] + [None, ""]
    docs = documents(spark, table).repartition(6)
    found = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), longest=longest, percent=30)
    got, want = rows(found), _drawn(table, target, longest, percent=30)
    key = lambda r: (repr(r[:5]), r[5] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sorted(r[5] for r in got if r[5]) == list(range(1, sum(r[1] >= 20 for r in got) * 30 // 100 + 1))


def test_resampling_of_empty_tables(spark, messy, nothing, rows):
    target = spark.createDataFrame([], "text string")
    assert rows(resampling.resample(nothing, target)) == []
    assert rows(resampling.resample(messy, target)) == _drawn(MESSY, [])
    assert set(r.doc_id for r in resampling.draw(messy, target, percent=100).collect()) == {8, 9, 10}
    assert resampling.draw(messy, target, percent=100).columns == messy.columns
