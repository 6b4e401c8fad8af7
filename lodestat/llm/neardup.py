"""Near duplicates by HyperMinHash bands and verification on full shingle sets."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from lodestat.llm.common import WordHashes, in_batches, mixed, row_key, slabs, with_decision
from lodestat.llm.components import components
from lodestat.operators.sizing import broadcast_checked
from lodestat.session import scratch_tables, settle_outside, settle_table

BUCKET_BITS, MANTISSA = 8, 10
BUCKETS = 1 << BUCKET_BITS
BAND_ROWS = 6
BANDS = BUCKETS // BAND_ROWS
#: Standard errors that an estimate may fall below the threshold, and the set size from which it is trusted.
ERRORS, TRUSTED = 5.0, BUCKETS
ROUNDS = 2
_REST = 64 - BUCKET_BITS
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xA0761D6478BD642F)]
_NUMBERS = np.arange(BUCKETS, dtype=np.uint64)
_STARTS = _NUMBERS << np.uint64(_REST)
#: For each bucket, the order in which an empty one borrows from the others.
_BORROW = np.argsort(np.random.Generator(np.random.PCG64(11)).random((BUCKETS, BUCKETS)), axis=1)


def shingles(body: bytes, size: int, hashes: dict) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``size``-word shingles; of the whole sequence if it is shorter."""
    words = body.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(size, len(words))
    total = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        total = total * _K[1] + h[i:len(h) - k + 1 + i] * _K[0]
    total = mixed(total)
    total.sort()
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


def sketch(values: np.ndarray) -> np.ndarray:
    """One 16-bit register per bucket of the hash space: leading zeros of the bucket's least value and the bits after its first one."""
    first = np.searchsorted(values, _STARTS)
    found = values[np.minimum(first, len(values) - 1)]
    full = (first < len(values)) & (found >> np.uint64(_REST) == _NUMBERS)
    least = (found & np.uint64((1 << _REST) - 1)).astype(np.float64) + 1
    part, power = np.frexp(least)
    zeros = np.clip(_REST + 1 - power, 0, 63)
    code = (zeros.astype(np.int64) << MANTISSA) | np.minimum((part * 2 - 1) * (1 << MANTISSA), (1 << MANTISSA) - 1).astype(np.int64)
    code = code.astype(np.uint16)
    empty = np.flatnonzero(~full)
    if len(empty):
        order = _BORROW[empty]
        code[empty] = code[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
    return code


def accidental(n: float) -> float:
    """Chance that registers of two unrelated sets of ``n`` shingles agree."""
    per = max(n / BUCKETS, 1.0)
    edges = (1 - 2.0 ** -np.arange(0, 40)) ** per  # chance that the least value has fewer than so many leading zeros, from the other end
    share = np.abs(np.diff(np.append(edges, 1.0)))
    return float((share ** 2).sum() / (1 << MANTISSA))


def _sketched(size: int):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            n, ids, codes = [], [], []
            for _, bodies in slabs(batch.column("body")):
                for body in bodies:
                    s = shingles(body, size, hashes)
                    n.append(len(s))
                    ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    codes.append(sketch(s).tobytes() if len(s) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("k_id"), batch.column("k_sha"), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(codes, pa.binary())],
                names=["k_id", "k_sha", "n", "set_id", "code"])
    return run


def _bands(batches):
    for batch in batches:
        codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint16).reshape(-1, BUCKETS)
        parts = codes[:, :BANDS * BAND_ROWS].reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
        for i in range(BAND_ROWS):
            key = mixed(key * _K[0] + parts[:, :, i] + np.uint64(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column("node").to_numpy(), BANDS)), pa.array(np.repeat(batch.column("n").to_numpy(), BANDS)),
             pa.array(key.reshape(-1).view(np.int64))], names=["node", "n", "key"])


def _promising(threshold: float):
    """Keep the pairs whose corrected estimate doesn't rule the threshold out."""
    margin = ERRORS * math.sqrt(threshold * (1 - threshold) / BUCKETS)

    def run(batches):
        for batch in batches:
            a = np.frombuffer(b"".join(batch.column("code_a").to_pylist()), np.uint16).reshape(-1, BUCKETS)
            b = np.frombuffer(b"".join(batch.column("code_b").to_pylist()), np.uint16).reshape(-1, BUCKETS)
            least = np.minimum(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy())
            by_chance = np.array([accidental(float(x)) for x in least])
            estimate = ((a == b).mean(axis=1) - by_chance) / (1 - by_chance)
            keep = pa.array((estimate >= threshold - margin) | (least < TRUSTED))
            yield batch.select(["a", "b", "n_a", "n_b"]).filter(keep)
    return run


def _sets(size: int):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for first, bodies in slabs(batch.column("body")):
                found = [shingles(b, size, hashes).view(np.int64) for b in bodies]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(first, len(bodies)), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])
    return run


class _Search:
    """Rounds of candidate pairs among classes of equal shingle sets, and their verified links."""

    def __init__(self, keyed: DataFrame, classes: DataFrame, size: int, percent: int):
        self.keyed, self.classes, self.size, self.percent = keyed, classes, size, percent
        pairs = classes.select("node", "n", "code").transform(in_batches, _bands, "node bigint, n bigint, key bigint")
        common = pairs.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
        self.shared = settle_table(pairs.join(common, "key"))
        self.tested = self.links = self.known = None

    def promising(self, pairs: DataFrame) -> DataFrame:
        """The pairs that their registers don't rule out, with the sizes of both sets."""
        code = lambda s: self.classes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("code").alias(f"code_{s}"))
        return settle_table(pairs.join(code("a"), "a").join(code("b"), "b")
                            .transform(in_batches, _promising(self.percent / 100), "a bigint, b bigint, n_a bigint, n_b bigint"))

    def verified(self, near: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` that link: ``100 * intersection >= percent * union`` on the full sets."""
        side = lambda s: sets.select(F.col("node").alias(s), F.col("shingles").alias(f"set_{s}"))
        both = near.join(side("a"), "a").join(side("b"), "b")
        common = F.size(F.array_intersect("set_a", "set_b"))
        return both.filter(100 * common >= self.percent * (F.col("n_a") + F.col("n_b") - common)).select("a", "b")

    def sets_of(self, nodes: DataFrame) -> DataFrame:
        """``(node, shingles)``: the full sets of classes, from the text of one member each."""
        rows = self.classes.join(nodes, "node", "left_semi").select("node", F.col("rep.k_id").alias("w_id"), F.col("rep.k_sha").alias("w_sha"))
        texts = self.keyed.join(broadcast_checked(rows), F.col("k_id").eqNullSafe(F.col("w_id")) & (F.col("k_sha") == F.col("w_sha")))
        return settle_table(texts.select("node", "body").transform(in_batches, _sets(self.size), "node bigint, shingles array<bigint>").dropDuplicates(["node"]))

    def across(self, members: DataFrame, sets: DataFrame) -> DataFrame:
        """All pairs ``(a, b, n_a, n_b)`` of different components that can still link, among ``members (node, n, comp)``.

        Of two sets that link, the rarest shingles of both, as many as the threshold leaves
        unmatched and one more, share one. So sets meet on their rarest shingles only,
        however many of them share a band. Where two sets first meet, what stands before
        is in one of them alone, so the place of the meeting bounds their intersection.
        """
        shingle = sets.select("node", F.explode("shingles").alias("s"))
        seen = shingle.groupBy("s").agg(F.count("*").alias("c"))
        need = F.col("n") - F.ceil(F.col("n") * self.percent / 100) + 1
        rarest = (shingle.join(seen, "s").join(members, "node")
                  .withColumn("at", F.row_number().over(Window.partitionBy("node").orderBy("c", "s"))).filter(F.col("at") <= need)
                  .filter("c > 1").select("node", "n", "comp", "s", "at"))
        rarest = settle_table(rarest)
        x, y = rarest.alias("x"), rarest.alias("y")
        return (x.join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.comp") < F.col("y.comp"))
                       & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * self.percent)
                       & ((100 + self.percent) * (F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at")) + 1)
                          >= self.percent * (F.col("x.n") + F.col("y.n"))))
                .select(F.least(F.struct("x.node", "x.n"), F.struct("y.node", "y.n")).alias("one"),
                        F.greatest(F.struct("x.node", "x.n"), F.struct("y.node", "y.n")).alias("two"))
                .select(F.col("one.node").alias("a"), F.col("two.node").alias("b"), F.col("one.n").alias("n_a"), F.col("two.n").alias("n_b")).distinct())

    def labels(self) -> DataFrame:
        """``(node, comp)`` of all nodes that share a band."""
        nodes = self.shared.select("node").distinct()
        if self.links is not None:
            # Earlier components stand for the links that made them, so that few rounds are left.
            tied = self.links if self.known is None else self.links.unionByName(self.known.select(F.col("node").alias("a"), F.col("comp").alias("b")))
            self.known, self.links = settle_table(components(tied)), None
        if self.known is None:
            return nodes.withColumn("comp", F.col("node"))
        return nodes.join(self.known, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    def untested(self, pairs: DataFrame) -> DataFrame:
        return pairs if self.tested is None else pairs.join(self.tested, ["a", "b"], "left_anti")

    def take(self, pairs: DataFrame, sets: DataFrame | None = None) -> bool:
        """Verify stored pairs that were not tested before; false if there are none. Without given sets, registers come first."""
        if pairs.isEmpty():
            return False
        with scratch_tables(pairs.sparkSession):
            near = pairs
            if sets is None:
                near = self.promising(pairs)
                sets = self.sets_of(near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct())
            links = settle_outside(self.verified(near, sets))
        pairs = pairs.select("a", "b")
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        self.links = links if self.links is None else self.links.unionByName(links)
        return True

    def run(self) -> DataFrame:
        """``(node, comp)`` after all links are found.

        First each band's pivot is tested against the band's other members, so a large
        group becomes one component by as many tests as it has members. What is left are
        members of different components that share a band; ``across`` finds all their links.
        """
        for i in range(ROUNDS):
            tied = self.labels()
            with scratch_tables(tied.sparkSession):
                labelled = settle_table(self.shared.join(tied, "node"))
                pivots = (labelled.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"),
                                                      F.min_by(F.struct("node", "comp", "n"), F.xxhash64("node", F.lit(i))).alias("p"))
                          .filter("low <> high").select("key", F.col("p.node").alias("p_node"), F.col("p.comp").alias("p_comp"), F.col("p.n").alias("p_n")))
                pairs = labelled.join(pivots, "key").filter(
                    (F.col("comp") != F.col("p_comp")) & (F.least("n", "p_n") * 100 >= F.greatest("n", "p_n") * self.percent)).select(
                    F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b")).distinct()
                pairs = settle_outside(self.untested(pairs))
            if not self.take(pairs):
                return self.labels()
        tied = self.labels()
        with scratch_tables(tied.sparkSession):
            labelled = settle_table(self.shared.join(tied, "node"))
            mixed_ = labelled.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("key")
            members = settle_outside(labelled.join(mixed_, "key", "left_semi").select("node", "n", "comp").distinct())
        sets = self.sets_of(members.select("node"))
        self.take(settle_table(self.untested(self.across(members, sets))), sets)
        return self.labels()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, k_sha, n_shingles, component_id, kept, component``.

    A text's words are separated by ASCII white space, A-Z lower-cased; its set holds
    the distinct ``size``-word shingles, or the whole sequence if it has fewer words.
    Texts link if a hundred times their common shingles reach ``percent`` times all of
    theirs. Null, empty and blank texts have no shingles and link with nothing, not even
    each other. ``component_id`` is the smallest id reachable over links (null ids
    count only if there is no other), and a row is kept if it has that id. Repeated rows
    get equal results; an empty table gives no rows; other columns are not read.
    ``component`` numbers the components and is null without shingles.

    A pair at the threshold misses all bands with a chance of about 2e-9 at 85 per cent and
    3e-6 at 80; every link is confirmed on full sets.
    """
    keyed = row_key(docs, key, text)
    schema = T.StructType([keyed.schema["k_id"], keyed.schema["k_sha"], T.StructField("n", T.LongType()),
                           T.StructField("set_id", T.BinaryType()), T.StructField("code", T.BinaryType())])
    rows = settle_table(keyed.transform(in_batches, _sketched(size), schema))
    classes = settle_table(rows.filter("n > 0").groupBy("n", "set_id").agg(
        F.min("k_id").alias("min_id"), F.min(F.struct("k_id", "k_sha")).alias("rep"), F.first("code").alias("code"))
        .withColumn("node", F.monotonically_increasing_id()))
    with scratch_tables(docs.sparkSession):
        labels = settle_outside(_Search(keyed, classes, size, percent).run())
    tied = classes.select("node", "n", "set_id", "min_id").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lowest = tied.groupBy("comp").agg(F.min("min_id").alias("component_id"))
    named = tied.join(lowest, "comp").select("set_id", "n", "component_id", F.col("comp").alias("component"))
    out = rows.select("k_id", "k_sha", "n", "set_id").join(named, ["set_id", "n"], "left")
    component = F.when(F.col("n") == 0, F.col("k_id")).otherwise(F.col("component_id"))
    return out.select(F.col("k_id").alias("doc_id"), "k_sha", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("k_id").eqNullSafe(component).alias("kept"), "component")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id, then text digest.

    All columns stay. Texts without shingles stay all. A null id is smaller than any
    other; fully repeated rows stay or go together.
    """
    with scratch_tables(docs.sparkSession):
        found = settle_outside(near_duplicates(docs, key, text, size, percent).filter("component is not null")
                               .select("component", F.col("doc_id").alias("k_id"), "k_sha"))
    first = found.groupBy("component").agg(F.min(F.struct("k_id", "k_sha")).alias("one"))
    gone = found.join(first, "component").filter(~(F.col("k_id").eqNullSafe(F.col("one.k_id")) & (F.col("k_sha") == F.col("one.k_sha"))))
    return with_decision(docs, gone, "left_anti", key, text)
