"""Sharding and exact duplicates."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

from samples import MESSY, documents
from lodestat.llm import chunks, sharding


def _shards(df, n):
    rows = sharding.shard_by_bytes(df, n).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows


def test_shards_of_messy_rows(messy, nothing):
    rows = _shards(messy, 3)
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in MESSY)
    for r in rows:
        text = dict(MESSY)[r.doc_id]
        assert r["size"] == 16 + len((text or "").encode())
        assert r.text_crc32 == (None if text is None else zlib.crc32(text.encode()))
    assert _shards(nothing, 3) == []


def test_shards_have_near_equal_bytes_and_cut_only_hot_groups(spark):
    rng = random.Random(1)
    rows = [(i, "hot text" * 20) for i in range(1000)] + [(1000 + i, f"{rng.random()}" * rng.randint(1, 20)) for i in range(2000)]
    found = _shards(documents(spark, rows), 8)
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r["size"]
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and all(abs(s - mean) <= 0.05 * mean for s in sizes.values())
    where = defaultdict(set)
    for r in found:
        where[r.text_crc32].add(r.shard)
    assert sum(len(s) > 1 for s in where.values()) == 1


def test_one_shard_and_more_shards_than_rows(spark):
    few = documents(spark, [(1, "a"), (2, "b")])
    assert {r.shard for r in _shards(few, 1)} == {0}
    assert len(_shards(few, 40)) == 2


def _expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return groups


def test_exact_duplicates_of_messy_rows(messy, nothing):
    groups = _expected(MESSY)
    rows = chunks.exact_duplicates(messy).collect()
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(rows) == len(MESSY) and chunks.exact_duplicates(nothing).collect() == []
    for r in rows:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = [r for r in rows if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_colliding_fingerprints_are_told_apart(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(3000)) for _ in range(30)]
    rows = [(i, texts[i % 30]) for i in range(45)]
    found = chunks.exact_duplicates(documents(spark, rows), fp_bits=2).collect()
    assert sum(r.kept for r in found) == 30
    assert all(r.keep_id == (r.doc_id + 30 if r.doc_id < 15 else r.doc_id) for r in found)


def test_chunks_depend_on_content_alone():
    rng = random.Random(3)
    body = bytes(rng.randrange(256) for _ in range(60_000))
    ends = chunks.cuts(body)
    assert ends[-1] == len(body) and all(b - a <= chunks.MAX_CHUNK for a, b in zip([0, *ends], ends))
    moved = {e + 7 for e in ends} & set(chunks.cuts(b"1234567" + body))
    assert len(moved) > len(ends) // 2
    assert chunks.cuts(b"") == [] and chunks.cuts(b"a" * 100_000)[-1] == 100_000


def test_dropping_keeps_one_row_and_all_columns(messy):
    left = chunks.drop_exact_duplicates(messy)
    assert left.columns == messy.columns
    assert Counter(r.text or "" for r in left.collect()) == Counter(_expected(MESSY).keys())
