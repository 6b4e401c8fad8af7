"""URL filter and chat formatting."""

import hashlib
import random

from pyspark.sql import types as T

from lodestat.llm import chat, urls
from lodestat.llm.queries import RULES

PAGES = [(1, "http://a.NET/x"), (2, "https://x.example.net/en/1"), (3, "https://example.net/EN/1"), (4, "http://m.example.com/de/5?q=1#t"),
         (5, "http://example.com/fr/5"), (6, "http://sub.org/fr/"), (7, "http://suborg/fr/"), (8, None), (9, "no scheme"), (10, ""),
         (11, "x://host?path"), (12, "y://net"), (13, "http://user@Net:80/a"), (1, "http://a.NET/x"), (None, "http://b.net/" + "a/" * 5000),
         (14, "http://a.net#f"), (15, "HTTP://É.Org/fr/é"), (16, "://net/a"), (17, "a://b://net/a")]


def _split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def _rule(host, path):
    fits = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=len, default=None)


def _pages(spark, rows):
    kinds = T.StructType([T.StructField("page_id", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("url", "html", "host", "suffix", "x"))])
    return spark.createDataFrame([(*r, "h", "c", "c", "c") for r in rows], kinds)


def test_rules_and_parts_of_urls(spark, rows):
    found = urls.judge(_pages(spark, PAGES), RULES).collect()
    assert len(found) == len(PAGES)
    want = {(i, *_split(u), _rule(*_split(u))) for i, u in PAGES}
    assert {(r.page_id, r.host, r.path, r.rule) for r in found} == want
    assert all(r.verdict == RULES[r.rule] if r.rule else r.verdict in ("allow", "block") for r in found)
    assert urls.judge(_pages(spark, []), RULES).collect() == []


def test_without_labels_urls_are_allowed(spark):
    found = urls.judge(_pages(spark, [(1, "http://a.io/"), (2, None)]), RULES).collect()
    assert {r.verdict for r in found} == {"allow"}


def test_trees_learn_lexical_rules(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        bad = i % 2
        tail = "".join(rng.choice("0123456789") for _ in range(20)) if bad else "".join(rng.choice("abcdef") for _ in range(8))
        rows.append((f"http://h{rng.randint(0, 50)}.io/{tail}", f"h{i}.io", "/" + tail, bad))
    df = spark.createDataFrame(rows, "url string, host string, path string, blocked int")
    model = urls.train(df.filter("int(substring(host, 2, instr(host, '.') - 2)) < 400"))
    held = model.add_verdict(df.filter("int(substring(host, 2, instr(host, '.') - 2)) >= 400")).collect()
    assert sum((r.learned == "block") == bool(r.blocked) for r in held) >= 0.98 * len(held)


CHATS = [(1, 0, "user", "hi"), (1, 1, "assistant", r"\### x </turn> #\\"), (1, 1, "assistant", r"\### x </turn> #\\"), (2, None, None, None),
         (2, 5, "assistant", ""), (None, 0, "assistant", "é漢" * 3000), (3, 0, "we\nird: #<\\", "\\"), (4, 2, "assistant", "b"), (4, 1, "user", "a")]


def _chats(spark, rows):
    kinds = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                          *(T.StructField(c, T.StringType()) for c in ("role", "text", "part", "body", "loss"))])
    return spark.createDataFrame([(*r, "c", "c", "c") for r in rows], kinds)


def _want(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1, (r or "").encode(), (x or "").encode()) for i, t, r, x in rows if i == c))
        loss = b"".join(x for _, r, x in turns if r == b"assistant")
        out[c] = (len(turns), hashlib.sha256(b"".join(r + b"\n" + x + b"\n" for _, r, x in turns)).hexdigest(),
                  len(loss.decode()), hashlib.sha256(loss).hexdigest())
    return out


def test_round_trip_of_chats(spark):
    for size in (chat.PART_BYTES, 64):
        before, chat.PART_BYTES = chat.PART_BYTES, size
        try:
            found = chat.read_back(chat.format_chats(_chats(spark, CHATS))).collect()
        finally:
            chat.PART_BYTES = before
        assert {r.conv_id: tuple(r)[1:5] for r in found} == _want(CHATS) and len(found) == 5
    assert chat.read_back(chat.format_chats(_chats(spark, []))).collect() == []


def test_format_has_marks_only_at_turns(spark):
    text = b"".join(r.formatted for r in chat.format_chats(_chats(spark, CHATS)).collect())
    assert text.count(b"### ") == len(CHATS) and text.count(b"</turn>") == len(CHATS)
    assert [len(list(chat.parse(r.formatted))) == r.n_turns for r in chat.format_chats(_chats(spark, CHATS)).collect()]
