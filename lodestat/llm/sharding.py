"""Shards of near-equal bytes by histogram sort."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodestat.llm.common import utf8
from lodestat.session import settle_table

ROW_BYTES = 16
STEP = 12
TOLERANCE = 0.02
ROWS_PER_CELL = 250_000
_KEY_BITS = 128
_HALF = 1 << 63


def _digit(level: int) -> Column:
    """The ``level``-th group of STEP bits of the key ``(h, r)``; groups do not cross from one part to the other."""
    per = -(-64 // STEP)
    part, depth = ("h", level) if level < per else ("r", level - per)
    shift, width = max(64 - STEP * (depth + 1), 0), min(STEP, 64 - STEP * depth)
    raised = F.col(part).bitwiseXOR(F.lit(-_HALF))
    return F.shiftrightunsigned(raised, shift).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def _widths() -> list[int]:
    part = [min(STEP, 64 - at) for at in range(0, 64, STEP)]
    return part + part


def _at_or_after(bound: int) -> Column:
    """True for keys at or behind a boundary, given as a 128-bit number."""
    if bound >= 1 << _KEY_BITS:
        return F.lit(False)
    h, r = F.lit((bound >> 64) - _HALF), F.lit((bound & (2 * _HALF - 1)) - _HALF)
    return (F.col("h") > h) | ((F.col("h") == h) & (F.col("r") >= r))


class _Splitter:
    """A boundary under search: the interval that holds it, and the exact bytes before that interval."""

    def __init__(self, goal: float):
        self.goal, self.below, self.low, self.bits, self.done = goal, 0, 0, _KEY_BITS, False

    def span(self) -> tuple[int, int]:
        return self.low, self.low + (1 << self.bits)

    def advance(self, counts: dict[int, int], rows: dict[int, int], width: int, tolerance: float) -> None:
        """Move into the candidate interval that holds the goal, or stop at its nearer edge."""
        digit = 0
        for digit in sorted(counts):
            if self.below + counts[digit] >= self.goal:
                break
            self.below += counts[digit]
        before, over = self.goal - self.below, self.below + counts.get(digit, 0) - self.goal
        self.bits -= width
        self.low += digit << self.bits
        if min(before, over) <= tolerance or rows.get(digit, 0) < 2 or not self.bits:
            self.low += (1 << self.bits) if over < before else 0
            self.done = True


def find_splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[int]:
    """Key boundaries between ``shards`` ranges of near-equal bytes.

    ``keys`` has ``h, r, size``. Each round counts the exact bytes below 4,096
    candidate boundaries inside every open interval, in one partial aggregate; the
    driver gets at most ``4096 * (shards - 1)`` sums, whatever the input. A boundary
    stops at the edge of an interval once that is within ``tolerance`` of a shard's
    size or the interval holds one row, so equal texts are cut only where whole groups would miss it.
    """
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    share = total / shards
    marks = [_Splitter(share * (i + 1)) for i in range(shards - 1)]
    for level, width in enumerate(_widths()):
        open_ = [m for m in marks if not m.done]
        if not open_ or not total:
            break
        spans = sorted({m.span() for m in open_})
        which = F.lit(None).cast("int")
        for i, (low, high) in enumerate(spans):
            which = F.when(_at_or_after(low) & ~_at_or_after(high), F.lit(i)).otherwise(which)
        sums: dict[int, dict[int, int]] = {i: {} for i in range(len(spans))}
        rows: dict[int, dict[int, int]] = {i: {} for i in range(len(spans))}
        for r in (keys.withColumn("which", which).filter("which is not null")
                  .groupBy("which", _digit(level).alias("digit")).agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect()):
            sums[r["which"]][r["digit"]], rows[r["which"]][r["digit"]] = r["size"], r["rows"]
        for m in open_:
            at = spans.index(m.span())
            m.advance(sums[at], rows[at], width, tolerance * share)
    return sorted(m.low for m in marks)


def shard_by_bytes(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text",
                   tolerance: float = TOLERANCE) -> DataFrame:
    """Put every row into one of ``shards`` shards of near-equal bytes, in one exchange.

    Returns ``doc_id, size, text_crc32, shard, slot``. Rows are ordered by a hash of
    their text and then by a hash of the row, so equal texts lie together; boundaries
    come from ``find_splitters``. A row counts 16 bytes plus its text; a null text has
    no bytes and a null checksum. Slots are gapless from 0 in each shard. Repeated
    rows are all kept. An empty table gives no rows. Other columns are not read.
    Sizes can differ by about a row where single texts exceed the tolerance.
    """
    slim = settle_table(docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(F.col(text).cast("binary")).alias("text_crc32"),
        F.xxhash64(utf8(text)).alias("h"),
    ).withColumn("n", F.monotonically_increasing_id()).withColumn("r", F.xxhash64("doc_id", "n")))
    bounds = find_splitters(slim, shards, tolerance)
    shard = reduce(lambda a, b: a + b, [_at_or_after(b).cast("int") for b in bounds], F.lit(0))
    # A shard is numbered in cells of bounded size; a cell's rows follow those of the cells before it.
    rows = slim.count()
    cells = max(1, -(-rows // (shards * ROWS_PER_CELL)))
    placed = slim.withColumn("shard", shard).withColumn("cell", F.pmod(F.xxhash64("n", F.lit(1)), F.lit(cells)).cast("int"))
    sizes = placed.groupBy("shard", "cell").agg(F.count("*").alias("rows"))
    before = sizes.withColumn("before", F.sum("rows").over(
        Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))).drop("rows")
    in_cell = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("h", "doc_id", "n"))
    return (placed.withColumn("at", in_cell).join(before, ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("at") - 1 + F.coalesce("before", F.lit(0))).cast("long").alias("slot")))
