"""What each filter removes in every order of a set of filters, from packed counters."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from lodestat.llm.common import in_batches, utf8

#: Bits of a field: a field counts documents of a part, and a table has fewer than 2 ** 63 rows.
WIDTH = 64
#: Parts that one task adds up side by side, and the shares of a part that are added up before its total.
HELD_PARTS, SHARES = 200, 64
PIECE = 1 << 20
COPY = "E"
_CAPITALS, _SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
_INNER = bytes(range(0x80, 0xC0))


@dataclass
class TextFacts:
    """Counts of one text: words, distinct words, code points, capitals A-Z and signs ``#$%&*|``."""

    words: int
    distinct: int
    points: int
    capitals: int
    signs: int


def facts_of(body: bytes) -> TextFacts:
    """Words are runs without ASCII white space; a long text is cut at white space and read piece by piece."""
    words, seen, size = 0, set(), len(body)
    for part in pieces(body):
        found = part.split()
        words += len(found)
        seen.update(found)
    return TextFacts(words, len(seen), len(body.translate(None, _INNER)),
                     size - len(body.translate(None, _CAPITALS)), size - len(body.translate(None, _SIGNS)))


def pieces(body: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``PIECE`` bytes that end at white space."""
    at = 0
    while len(body) - at > PIECE:
        end = min((x for x in (body.find(s, at + PIECE) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if x >= 0), default=len(body))
        yield body[at:end]
        at = end
    yield body[at:]


#: Failure conditions on a text alone; ``COPY`` fails a text equal to one of a smaller id.
FILTERS: dict[str, Callable[[TextFacts], bool]] = {
    "A": lambda t: t.words < 200,
    "B": lambda t: 100 * t.distinct < 50 * t.words,
    "C": lambda t: 100 * t.capitals > 3 * t.points,
    "D": lambda t: t.signs > 0,
}


@dataclass
class Packing:
    """Where the outcomes of every step of every order lie in one wide integer.

    A document's integer has, for each step, fields of ``WIDTH`` bits with a one if the
    step removes it, if it fails the step's filter but went before, and if it fails no
    other filter. Three such sections follow each other: all documents, good and
    toxic ones. Each ends with a field that counts the documents themselves.
    """

    letters: str
    orders: list[str] = field(init=False)
    section: int = field(init=False)

    def __post_init__(self):
        self.orders = ["".join(p) for p in itertools.permutations(self.letters)]
        self.section = 3 * len(self.letters) * len(self.orders) + 1

    def outcome(self, mask: int) -> int:
        """The packed integer, of one section, of a document that fails the filters of ``mask``."""
        bits, k = 0, 0
        alone = mask.bit_count() == 1
        for order in self.orders:
            gone = False
            for letter in order:
                if mask >> self.letters.index(letter) & 1:
                    bits |= 1 << WIDTH * (k + gone)
                    if alone:
                        bits |= 1 << WIDTH * (k + 2)
                    gone = True
                k += 3
        return bits | 1 << WIDTH * k

    def words(self) -> list[list[int]]:
        """By mask, then by 1 for good plus 2 for toxic: the integer of a document over all three sections."""
        wide, out = WIDTH * self.section, []
        for mask in range(1 << len(self.letters)):
            one = self.outcome(mask)
            out.append([one * (1 + (good << wide) + (toxic << 2 * wide)) for toxic in (0, 1) for good in (0, 1)])
        return out

    def packed(self, total: int) -> bytes:
        return total.to_bytes(3 * self.section * WIDTH // 8, "little")

    def unpack(self, total: bytes) -> dict[str, np.ndarray]:
        """The columns of a part's rows, in the order of ``orders`` and steps."""
        fields = np.frombuffer(total, "<u8").reshape(3, self.section)
        k = len(self.letters)
        steps = fields[:, :-1].astype(np.int64).reshape(3, len(self.orders), k, 3)
        removed = steps[0, :, :, 0]
        place = np.array([[self.letters.index(c) for c in order] for order in self.orders])
        shapley = np.zeros(k, np.int64)
        np.add.at(shapley, place.ravel(), removed.ravel())
        return {"kept": (int(fields[0, -1]) - np.cumsum(removed, axis=1)).ravel(), "removed": removed.ravel(),
                "redundant": steps[0, :, :, 1].ravel(), "unique_fails": steps[0, :, :, 2].ravel(),
                "good_lost": steps[1, :, :, 0].ravel(), "toxic_lost": steps[2, :, :, 0].ravel(), "shapley": shapley[place].ravel()}


def _masks(filters: dict[str, Callable[[TextFacts], bool]]):
    def run(batches):
        for batch in batches:
            marks, digests = [], []
            for value in batch.column("body"):
                body = value.as_py()
                facts = facts_of(body)
                marks.append(sum(1 << i for i, fails in enumerate(filters.values()) if fails(facts)))
                digests.append(hashlib.sha256(body).digest())
            yield pa.RecordBatch.from_arrays([batch.column("k_id"), batch.column("part"), pa.array(digests, pa.binary()), pa.array(marks, pa.int32())],
                                             names=["k_id", "part", "sha", "mask"])
    return run


def cells(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang",
          filters: dict[str, Callable[[TextFacts], bool]] = FILTERS) -> DataFrame:
    """``part, mask, kind, n, later``: rows of one text, part and kind, and how many of them have an equal text at a smaller id.

    Equal rows, and copies that share part and labels, are added up before they move, so a
    text that a third of all rows hold is a few rows by the time it is grouped. A null id
    is in no order with others and has no labels.
    """
    slim = docs.select(F.col(key).alias("k_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), utf8(text).alias("body"))
    schema = T.StructType([slim.schema["k_id"], T.StructField("part", T.StringType()), T.StructField("sha", T.BinaryType()), T.StructField("mask", T.IntegerType())])
    marked = slim.transform(in_batches, _masks(filters), schema).groupBy("k_id", "part", "sha", "mask").agg(F.count(F.lit(1)).alias("n"))
    said = lambda c: F.max((F.col(c) == 1).cast("int"))
    known = (labels.select(F.col(key).alias("k_id"), F.col("quality").alias("quality"), F.col("toxic").alias("toxic")).filter("k_id is not null")
             .groupBy("k_id").agg((F.coalesce(said("quality"), F.lit(0)) + 2 * F.coalesce(said("toxic"), F.lit(0))).alias("kind"))
             .withColumn("spread", F.lit(0)))
    # Rows without an id are dealt by their texts instead; no label meets them.
    spread = F.when(F.col("k_id").isNull(), 1 + F.pmod(F.xxhash64("sha"), F.lit(1 << 20)).cast("int")).otherwise(0)
    joined = marked.withColumn("spread", spread).join(known, ["k_id", "spread"], "left")
    alike = (joined.groupBy("sha", "part", "mask", F.coalesce("kind", F.lit(0)).alias("kind"))
             .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("k_id").isNotNull(), F.col("n")).otherwise(0)).alias("with_id"),
                  F.min("k_id").alias("first"), F.min_by("n", "k_id").alias("at_first")))
    # A text's rows here are at most its parts times the kinds of labels.
    least = F.min("first").over(Window.partitionBy("sha"))
    return alike.withColumn("least", least).select(
        "part", "mask", "kind", "n", (F.col("with_id") - F.when(F.col("first") == F.col("least"), F.col("at_first")).otherwise(0)).alias("later"))


def _sum_outcomes(packing: Packing):
    def run(batches):
        words, copy = packing.words(), 1 << len(packing.letters) - 1
        held: dict[str, int] = {}

        def flushed():
            rows = [(p, packing.packed(v)) for p, v in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], names=["part", "total"])

        for batch in batches:
            # Equal masks of a batch are one product, which is the sum of as many equal integers.
            table = pa.Table.from_batches([batch]).group_by(["part", "mask", "kind"]).aggregate([("n", "sum"), ("later", "sum")])
            for p, mask, kind, n, later in zip(*(table.column(c).to_pylist() for c in ("part", "mask", "kind", "n_sum", "later_sum"))):
                if p not in held and len(held) == HELD_PARTS:
                    yield flushed()
                held[p] = held.get(p, 0) + (n - later) * words[mask][kind] + later * words[mask | copy][kind]
        yield flushed()
    return run


def _totals(batches) -> Iterator[tuple[str, int]]:
    """The sum of each part of a sorted partition, one at a time."""
    at, total = None, 0
    for batch in batches:
        for p, value in zip(batch.column("part").to_pylist(), batch.column("total")):
            if at is not None and p != at:
                yield at, total
                total = 0
            at, total = p, total + int.from_bytes(value.as_py(), "little")
    if at is not None:
        yield at, total


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang",
          filters: dict[str, Callable[[TextFacts], bool]] = FILTERS) -> DataFrame:
    """One row for each part, order of filters and step, with long document counts.

    ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley``. The filters are those of ``filters`` and ``COPY``. Every
    combination of failures has a wide integer that holds all outcomes; tasks add these
    up by part, and the sums are added in two steps, sorted by part, so a task holds one
    at a time. Null texts are empty, null parts are ``''``; a document counts as good
    (``quality`` 1) or toxic if any label row of its id says so. Repeated rows count each;
    an empty table gives no rows; other columns are not read.
    """
    if COPY in filters or len(filters) > 5:
        raise ValueError(f"at most five filters besides {COPY}")
    packing = Packing("".join(filters) + COPY)
    found = cells(docs, labels, key, text, part, filters)
    sums = found.transform(in_batches, _sum_outcomes(packing), "part string, total binary")

    def add_up(batches):
        for p, total in _totals(batches):
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.string()), pa.array([packing.packed(total)], pa.binary())], names=["part", "total"])

    def finish(batches):
        orders = np.repeat(packing.orders, len(packing.letters))
        steps = np.tile(np.arange(1, len(packing.letters) + 1), len(packing.orders))
        for p, total in _totals(batches):
            columns = packing.unpack(packing.packed(total))
            yield pa.RecordBatch.from_arrays([pa.array([p] * len(orders), pa.string()), pa.array(orders, pa.string()), pa.array(steps, pa.int32()),
                                              *(pa.array(v, pa.int64()) for v in columns.values())], names=["part", "filter_order", "step", *columns])

    shares = (sums.withColumn("share", F.spark_partition_id() % SHARES).repartition("part", "share").drop("share")
              .sortWithinPartitions("part").transform(in_batches, add_up, "part string, total binary"))
    counts = ", ".join(f"{c} bigint" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
    return (shares.repartition("part").sortWithinPartitions("part")
            .transform(in_batches, finish, f"part string, filter_order string, step int, {counts}"))
