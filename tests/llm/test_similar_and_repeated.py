"""Near duplicates, repeated substrings and benchmark passages against brute force."""

import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from samples import MESSY, documents
from lodestat.llm import anchors, components, decontaminate, neardup, passages, substrings
from lodestat.session import scratch_tables, settle_table, use_checkpoint_dir


def _sets(rows, size):
    out = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        out[i] = frozenset(tuple(w[j:j + size]) for j in range(max(1, len(w) - size + 1))) if w else frozenset()
    return out


def _components(rows, size, percent):
    sets, by = _sets(rows, size), defaultdict(set)
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, s in sets.items():
        for g in s:
            by[g].add(i)
    for i, s in sets.items():
        for j, common in Counter(j for g in s for j in by[g] if j < i).items():
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def _near(rng, n=120):
    """Chains and clouds of copies around a few texts, short texts among them."""
    words = [f"w{i}" for i in range(300)]
    rows = []
    for base in range(n // 20):
        text = [rng.choice(words) for _ in range(rng.choice([3, 8, 40, 150]))]
        for c in range(20):
            copy = list(text)
            for _ in range(rng.randint(0, max(1, len(text) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if c % 5 == 0:
                text = copy  # a chain
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    return rows + [(5000, None), (5001, ""), (5002, " \t"), (5003, "one"), (5004, "ONE"), (5005, "one two"), (5006, "one\ntwo")]


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, size, percent):
    rows = _near(random.Random(size))
    want = _components(rows, size, percent)
    found = neardup.near_duplicates(documents(spark, rows).repartition(5), size=size, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want and len(found) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_of_messy_rows(messy, nothing):
    rows = neardup.near_duplicates(messy).collect()
    assert len(rows) == len(MESSY) and neardup.near_duplicates(nothing).collect() == []
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add((r.component_id, r.n_shingles > 0))
    assert by[2] == {(1, True)} and by[9] == {(8, True)} and by[10] == {(10, True)} and by[12] == {(6, True)}
    assert by[3] == {(3, False)} and by[4] == {(4, False)} and by[5] == {(5, False)} and by[None] == {(None, True)}
    left = neardup.drop_near_duplicates(messy)
    assert left.columns == messy.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 3, 4, 5, 6, 8, 10, 11]


def test_links_across_components_are_found_without_pivots(spark, monkeypatch):
    monkeypatch.setattr(neardup, "ROUNDS", 0)
    rows = _near(random.Random(9), 80)
    want = _components(rows, 3, 85)
    found = neardup.near_duplicates(documents(spark, rows), size=3, percent=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want


def test_estimates_are_close():
    rng = np.random.Generator(np.random.PCG64(1))
    common, a, b = (rng.integers(0, 1 << 64, n, dtype=np.uint64) for n in (1700, 150, 150))
    x, y = (neardup.sketch(np.unique(np.concatenate((common, z)))) for z in (a, b))
    assert abs((x == y).mean() - 0.85) < 0.1
    assert (neardup.sketch(np.unique(a)) == neardup.sketch(np.unique(b))).mean() < 0.05


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    found = {r.node: r.comp for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 150), 100)}


def _covered(bodies, length):
    seen = Counter(b[i:i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        mark = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                mark[i:i + length] = True
        out.append(mark)
    return out


def _check_repeats(spark, rows, length):
    found = {r.doc_id: r for r in substrings.remove_repeats(documents(spark, rows).repartition(4), length=length).collect()}
    assert len(found) == len(rows)
    for (i, t), mark in zip(rows, _covered([(t or "").encode() for _, t in rows], length)):
        body, r = np.frombuffer((t or "").encode(), np.uint8), found[i]
        spans = int(mark[:1].sum()) + int((mark[1:] & ~mark[:-1]).sum())
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(body), mark.sum(), spans), i
        assert r.kept_sha256 == hashlib.sha256(body[~mark].tobytes()).hexdigest()


def _repeating(rng):
    passages = ["".join(rng.choice("abcdefghij ") for _ in range(rng.randint(60, 400))) for _ in range(6)]
    rows = []
    for i in range(40):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts.append("".join(rng.choice("klmnopqrst ") for _ in range(rng.randint(0, 90))))
            passage = rng.choice(passages)
            cut = rng.randint(0, 30)
            parts.append(passage[cut:len(passage) - rng.randint(0, 30)])
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("length", [64, 100])
def test_repeats_equal_brute_force(spark, length):
    rows = _repeating(random.Random(length))
    rows += [(100, "ab" * 300), (101, "a" * 500), (102, "é" * 200), (103, rows[0][1]), (104, rows[0][1]), (105, None), (106, "")]
    _check_repeats(spark, rows, length)


def test_repeats_over_segments_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(anchors, "SEGMENT", 300)
    _check_repeats(spark, _repeating(random.Random(12)), 64)


def test_repeats_of_messy_rows(messy, nothing):
    rows = substrings.remove_repeats(messy).collect()
    assert len(rows) == len(MESSY) and substrings.remove_repeats(nothing).collect() == []
    assert all(r.n_removed == r.n_bytes for r in rows if r.doc_id in (8, 9))
    assert all(r.n_removed == 0 for r in rows if r.doc_id not in (8, 9, 10))


def _words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def _contamination(rows, items):
    windows = defaultdict(set)
    for item, t in items:
        w = _words(t)
        for s in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[s:s + 13])].add(str(item))
    out = []
    for i, t in rows:
        w, hit, found = _words(t), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s:s + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return Counter(out)


def _items(spark, items):
    return spark.createDataFrame([(i, t, "c", "c") for i, t in items], "item_id long, text string, wid string, term string")


def test_contamination_equals_brute_force(spark, messy, nothing):
    rng = random.Random(6)
    words = [f"t{i}" for i in range(25)] + ["ünï", "9"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 12, 13, 14, 40])))) for i in range(30)] + [(30, None), (3, "x Y-z"), (31, "the same text here")]
    rows = []
    for i in range(60):
        w = [rng.choice(words) for _ in range(rng.randint(0, 300))]
        for _ in range(i % 3):
            w[len(w) // 2:len(w) // 2] = (rng.choice(items)[1] or "").upper().split()
        rows.append((i, "  ".join(w)))
    for docs, table in ((documents(spark, rows), rows), (messy, MESSY)):
        found = decontaminate.contamination(docs, _items(spark, items)).drop("k_a", "k_h").collect()
        assert Counter(map(tuple, found)) == _contamination(table, items)
    assert decontaminate.contamination(nothing, _items(spark, items)).collect() == []
    assert all(r.n_hit == 0 for r in decontaminate.contamination(messy, _items(spark, [])).collect())
    left = decontaminate.drop_contaminated(messy, _items(spark, items))
    assert left.columns == messy.columns
    bad = {k[0] for k in _contamination(MESSY, items) if k[-1]}
    assert bad and not bad & {r.doc_id for r in left.collect()} and left.count() == sum(i not in bad for i, _ in MESSY)


def test_proximity_finds_shifted_terms(spark):
    item = " ".join(f"q{i}" for i in range(13))
    docs = documents(spark, [(1, item), (2, item.replace("q5", "q5 extra")), (3, "q1 q2 q3")])
    found = decontaminate.proximity_matches(docs, _items(spark, [(1, item)]), slack=2).collect()
    assert {r.doc_id for r in found} == {1, 2}


def test_components_of_ids_that_reach_far_up(spark):
    """Ids from partition 5,000 on, whose sum leaves 64 bits."""
    base = 5000 << 33
    edges = spark.range(base, base + 240_000, 1, 6).selectExpr("id AS a", "id - pmod(id, 3) AS b")
    found = components.components(edges)
    assert found.count() == 240_000 and found.filter("comp <> node - pmod(node, 3)").isEmpty()


def _sharing(rows, n):
    """Ids of the rows that hold ``n`` words in a row which another row holds too."""
    at = defaultdict(set)
    for place, (_, text) in enumerate(rows):
        w = (text or "").encode().split()
        for i in range(len(w) - n + 1):
            at[b" ".join(w[i:i + n])].add(place)
    return sorted({p for s in at.values() if len(s) > 1 for p in s})


@pytest.mark.parametrize("words", [6, 50])
def test_shared_passages_equal_brute_force(spark, small, words):
    rng = random.Random(words)
    passage = [f"p{i}" for i in range(words + 5)]
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()] + MESSY
    for i in range(60):
        own = [f"q{rng.randrange(3000)}" for _ in range(rng.randint(0, 200))]
        at, cut = rng.randint(0, len(own)), rng.choice([words - 1, words, words + 5, 0])
        rows.append((10_000 + i, " \n".join(own[:at] + passage[:cut] + own[at:])))
    found = substrings.remove_repeats(documents(spark, rows).repartition(5), words=words).collect()
    got = Counter((r.doc_id, r.n_bytes) for r in found if r.shares_passage)
    want = Counter((rows[p][0], len((rows[p][1] or "").encode())) for p in _sharing(rows, words))
    assert got == want and len(found) == len(rows)


def test_texts_are_hashed_in_small_groups(monkeypatch):
    sizes, ranks = [], anchors.Ranks
    monkeypatch.setattr(anchors, "Ranks", lambda data: sizes.append(len(data)) or ranks(data))
    bodies = [bytes([97 + i % 26]) * 999 for i in range(300)]
    assert sum(len(r[0]) for r in anchors.runs(bodies, 40)) >= 300
    assert max(sizes) < anchors.GROUP + 999 and sum(sizes) == 300 * 999


@pytest.mark.parametrize("group", [70, 200])
def test_word_hashes_tell_words_apart(monkeypatch, group):
    monkeypatch.setattr(passages, "_GROUP", group)
    r = random.Random(group)
    bodies = [bytes(r.choices(b"ab\xff\x00 \t\x0b" if i % 3 else b"aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaab" * 3 + b" ", k=r.choice([0, 1, 30, 69, 70, 71, 500]))) for i in range(200)]
    made, words, hashes = passages.word_hashes(bodies), {}, {}
    for found, body in zip(made, bodies, strict=True):
        for w, h in zip(body.split(), found.tolist(), strict=True):
            assert words.setdefault(w, h) == h and hashes.setdefault(h, w) == w
    assert any(len(w) > 2 * passages._LONG for w in words)


def test_only_wanted_tables_of_near_duplicates_stay(spark):
    use_checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    tables = lambda: {p for p in os.listdir(folder) if p.startswith("table-")}
    text = " ".join(map(str, range(60)))
    rows, before = documents(spark, [(1, text), (2, text + " a"), (3, "b c d e f g"), (4, None)]), tables()
    left = neardup.drop_near_duplicates(rows)
    assert len(tables() - before) == 1 and sorted(r.doc_id for r in left.collect()) == [1, 3, 4]


def test_an_inner_scope_leaves_an_equal_outer_one_open(spark):
    with scratch_tables(spark):
        with scratch_tables(spark):
            pass
        path = settle_table(spark.range(3)).inputFiles()[0].removeprefix("file:")
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_rounds_of_components_end_at_stars(spark):
    frame = lambda links: spark.createDataFrame(links, "u long, v long")
    assert components._stars(frame([(2, 1), (3, 1), (5, 4)])) and components._stars(frame([]))
    assert not components._stars(frame([(3, 2), (2, 1)])) and not components._stars(frame([(3, 2), (3, 1)]))
