"""CSV with line breaks inside quotes, read in parallel.

Spark reads a multi-line CSV file in one task, since a line break may lie inside a
quoted field. Here the file is read as lines, block by block. A block's quotes are
counted first; the parity of all quotes before a block says whether it begins inside
one. Then each block puts its own lines together to records, and only the pieces that
cross a border between blocks are joined, a row or two per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Kinds of pieces: a whole record, the end of one, the start of one, and neither.
WHOLE, END, START, INSIDE = range(4)


def _lines(spark: SparkSession, path: str, recursive: bool) -> DataFrame:
    return (spark.read.option("lineSep", "\n").option("recursiveFileLookup", recursive).text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")))


def _quotes(line: Column, escape: str) -> Column:
    """Quotes of a line that open or close a field; doubled ones cancel out."""
    bare = line if escape == '"' else F.regexp_replace(line, r"\\.", "")
    return F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))


def _pieces(shared: Broadcast):
    """Records of each block in order; ``shared`` holds the blocks that begin inside a quoted field."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, open_, first, seq = None, [], False, False, 0
        for batch in batches:
            rows: list[tuple] = []
            lines, files = batch.column("value").to_pylist(), batch.column("file").to_pylist()
            for line, file, block, turns in zip(lines, files, batch.column("block").to_pylist(), batch.column("odd").to_pylist()):
                if (file, block) != place:
                    if held:
                        rows.append((*place, seq, INSIDE if first else START, "\n".join(held)))
                    place, held, seq = (file, block), [], 0
                    open_ = first = place in shared.value
                held.append(line)
                open_ ^= turns
                if not open_:
                    rows.append((*place, seq, END if first else WHOLE, "\n".join(held)))
                    held, first, seq = [], False, seq + 1
            yield _batch(rows)
        if held:
            yield _batch([(*place, seq, INSIDE if first else START, "\n".join(held))])
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["file", "block", "seq", "kind", "record"])


def records(spark: SparkSession, path: str, escape: str = '"', recursive: bool = False) -> DataFrame:
    """(file, block, seq, record): every record of every file with the place where it starts; blank lines are no records.

    A quote stands only around a field, or inside one behind ``escape``. A record that
    the file ends in the middle of is one, too.
    """
    lines = _lines(spark, path, recursive)
    odd = (_quotes(F.col("value"), escape) % 2).cast("boolean")
    counted = lines.groupBy("file", "block").agg(F.bit_xor(odd.cast("int")).alias("odd"))
    before = F.sum("odd").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    # The blocks that begin inside a field: a row for each at most, and few files have many.
    inside = [(r["file"], r["block"]) for r in counted.select("file", "block", (F.coalesce(before, F.lit(0)) % 2).alias("inside")).where("inside = 1").collect()]
    shared = spark.sparkContext.broadcast(frozenset(inside))
    # Lines keep the order of the file, since nothing moves them before they are put together.
    pieces = lines.withColumn("odd", odd).mapInArrow(_pieces(shared), "file string, block bigint, seq bigint, kind int, record string")
    crossing = pieces.where(f"kind <> {WHOLE}")
    chain = F.sum((F.col("kind") == START).cast("int")).over(Window.partitionBy("file").orderBy("block", "seq"))
    joined = (crossing.withColumn("chain", chain).groupBy("file", "chain")
              .agg(F.array_sort(F.collect_list(F.struct("block", "seq", "record"))).alias("parts"))
              .select("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["seq"].alias("seq"),
                      F.array_join(F.col("parts")["record"], "\n").alias("record")))
    whole = pieces.where(f"kind = {WHOLE}").select("file", "block", "seq", "record")
    return (whole.unionByName(joined).withColumn("record", F.regexp_replace("record", r"\r$", "")).where("record <> ''"))


def read_quoted_csv(spark: SparkSession, path: str, escape: str = '"', recursive: bool = False) -> DataFrame:
    """A header CSV as text columns, with its raw record in ``_record``."""
    header = spark.read.csv(path, header=True, multiLine=True, quote='"', escape=escape, recursiveFileLookup=recursive).schema
    rows = records(spark, path, escape, recursive).where("NOT (block = 0 AND seq = 0)")
    fields = F.from_csv("record", _ddl(header),
                        {"quote": '"', "escape": escape, "mode": "PERMISSIVE", "multiLine": "true"})
    return rows.select(fields.alias("f"), F.col("record").alias("_record")).select("f.*", "_record")


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)
