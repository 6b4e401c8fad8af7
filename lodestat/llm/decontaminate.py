"""Benchmark passages in documents, through a positional inverted index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodestat.operators.sizing import broadcast_checked
from lodestat.session import settle_table

WINDOW = 13
#: Terms of a window whose posting lists are intersected, from the rarest on.
PIVOTS = 3
_SIGNS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KEY = ["k_a", "k_h"]


def words_of(text: Column) -> Column:
    """Words of digits, lower-cased letters and all signs beyond ASCII; a null text has none."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(low, _SIGNS), "")


def _identity(words: Column) -> Column:
    """Equal for equal word sequences only, since no word holds a space."""
    return F.unhex(F.sha2(F.array_join(words, " "), 256))


def windows_of(benchmark: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``(wid, item_id, terms)``: every window of every item; a short item is one window, one without words has none."""
    items = benchmark.select(F.col(key).alias("item_id"), words_of(F.col(text)).alias("w")).filter("size(w) > 0")
    first = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1))))
    return (items.withColumn("s", first).select("item_id", F.slice("w", F.col("s"), F.lit(window)).alias("terms"))
            .withColumn("wid", _identity(F.col("terms"))).dropDuplicates(["wid", "item_id"]))


def _tokens(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A document's words under a key of 128 bits, from its id (null is an id like any other) and its text."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("k_id"), F.xxhash64(F.col(key), body).alias("k_a"), F.xxhash64(body).alias("k_h"),
                       words_of(F.col(text)).alias("words"))


class PositionalIndex:
    """Posting lists ``(term, k_a, k_h, pos)`` of the terms that decide where a window may start.

    ``plan`` has, for each window whose terms all occur, its rarest terms with their
    places in it. Common terms of a window need no list. A document is known by
    hashes of its id and text.
    """

    def __init__(self, docs: DataFrame, windows: DataFrame, key: str = "doc_id", text: str = "text", pivots: int = PIVOTS):
        self.tokens = _tokens(docs, key, text)
        terms = (windows.dropDuplicates(["wid"]).select("wid", F.size("terms").cast("int").alias("n"), F.posexplode("terms").alias("place", "term")))
        vocabulary = broadcast_checked(terms.select("term").distinct())
        counts = (self.tokens.select(F.explode("words").alias("term")).join(vocabulary, "term").groupBy("term").agg(F.count("*").alias("freq")))
        ranked = (terms.join(broadcast_checked(counts), "term")
                  .groupBy("wid", "n").agg(F.array_sort(F.collect_list(F.struct("freq", "place", "term"))).alias("by"))
                  .filter(F.size("by") == F.col("n")))
        self.plan = settle_table(ranked.select("wid", "n", F.slice("by", 1, pivots).alias("by")))
        listed = broadcast_checked(self.plan.select(F.explode("by.term").alias("term")).distinct())
        self.postings = settle_table(self.tokens.select(*_KEY, F.posexplode("words").alias("pos", "term")).join(listed, "term"))
        self.pivots = pivots

    def candidates(self, slack: int = 0) -> DataFrame:
        """``(k_a, k_h, start, wid, n)`` where the lists of a window's rarest terms meet after adjusting for their places.

        ``slack`` lets each further term stand so many words off its place.
        """
        plan = self.plan.select("wid", "n", *[F.element_at("by", i + 1)[c].alias(f"{c}{i}") if i == 0 else
                                              F.try_element_at("by", F.lit(i + 1))[c].alias(f"{c}{i}")
                                              for i in range(self.pivots) for c in ("term", "place")])
        found = (self.postings.join(broadcast_checked(plan.withColumnRenamed("term0", "term")), "term")
                 .withColumn("start", F.col("pos") - F.col("place0")).filter("start >= 0").drop("term", "pos", "place0"))
        for i in range(1, self.pivots):
            open_ = found.filter(f"term{i} is null")
            spots = F.col("start") + F.col(f"place{i}")
            wanted = found.filter(f"term{i} is not null").withColumnRenamed(f"term{i}", "term")
            wanted = wanted.withColumn("pos", F.explode(F.sequence(spots - slack, spots + slack)) if slack else spots)
            met = wanted.join(self.postings.select("term", *_KEY, "pos"), ["term", *_KEY, "pos"], "left_semi").drop("term", "pos", f"place{i}")
            found = met.unionByName(open_.drop(f"term{i}", f"place{i}"))
        return found.distinct()


def phrase_matches(index: PositionalIndex) -> DataFrame:
    """``(k_a, k_h, found)``: for each document with any, the windows ``(start, n, wid)`` that its words spell exactly."""
    places = index.candidates().groupBy(*_KEY).agg(F.collect_set(F.struct("start", "n", "wid")).alias("c"))
    # The words stay below the join, so each text is split once, whatever the number of its candidates.
    both = index.tokens.join(broadcast_checked(places), _KEY)
    spelled = F.filter("c", lambda c: _identity(F.slice("words", c["start"] + 1, c["n"])) == c["wid"])
    return both.select(*_KEY, spelled.alias("found")).filter("size(found) > 0").dropDuplicates(_KEY)


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slack: int = 2, window: int = WINDOW) -> DataFrame:
    """``doc_id, item_id, start``: where an item's rarest terms stand within ``slack`` words of their places.

    A superset of the exact phrases; for review, not for removal.
    """
    windows = settle_table(windows_of(benchmark, window=window))
    index = PositionalIndex(docs, windows)
    near = index.candidates(slack).join(windows.select("wid", "item_id"), "wid")
    return near.join(index.tokens.select("k_id", *_KEY), _KEY).select(F.col("k_id").alias("doc_id"), "item_id", "start").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, k_a, k_h, n_words, n_hit, n_items, items_sha256, contaminated``.

    A word is hit if it lies in an occurrence of a benchmark window, and a document is
    contaminated if at least a twentieth of its words, and at least one, are hit. Null
    and empty texts have no words and no hits; their item digest is that of no text.
    Repeated rows get equal results. Without items nothing is hit. Other columns are
    not read; an empty table gives no rows.
    """
    windows = settle_table(windows_of(benchmark, item, window=window))
    index = PositionalIndex(docs, windows, key, text)
    found = settle_table(phrase_matches(index))
    spans = F.flatten(F.transform("found", lambda c: F.sequence(c["start"], c["start"] + c["n"] - 1)))
    hits = found.select(*_KEY, F.size(F.array_distinct(spans)).cast("long").alias("n_hit"))
    items = (found.select(*_KEY, F.explode("found.wid").alias("wid")).distinct()
             .join(broadcast_checked(windows.select("wid", "item_id")), "wid")
             .groupBy(*_KEY).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids")))
    judged = hits.join(items, _KEY).select(*_KEY, "n_hit", F.size("ids").cast("long").alias("n_items"), F.array_join("ids", ",").alias("ids"))
    counted = _tokens(docs, key, text).select("k_id", *_KEY, F.size("words").cast("long").alias("n_words"))
    out = counted.join(broadcast_checked(judged), _KEY, "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return out.select(F.col("k_id").alias("doc_id"), "k_a", "k_h", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
                      F.sha2(F.coalesce("ids", F.lit("")).cast("binary"), 256).alias("items_sha256"),
                      ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without contaminated rows; all columns of the others stay."""
    bad = contamination(docs, benchmark, key, text).filter("contaminated").select("k_a", "k_h").distinct().alias("bad")
    body = F.coalesce(F.col(f"kept_docs.`{text}`"), F.lit(""))
    same = (F.xxhash64(F.col(f"kept_docs.`{key}`"), body) == F.col("bad.k_a")) & (F.xxhash64(body) == F.col("bad.k_h"))
    return docs.alias("kept_docs").join(broadcast_checked(bad).alias("bad"), same, "left_anti")
