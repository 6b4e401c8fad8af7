"""Repeated byte strings across documents, by distributed prefix doubling."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lodestat.llm.anchors import blocks, runs
from lodestat.llm.common import in_batches, slabs, utf8
from lodestat.llm.passages import WORDS, sharing_texts
from lodestat.operators.sizing import broadcast_checked
from lodestat.session import settle_table

LENGTH = 400
_RUN = "k binary, start bigint, n int, back int, fp bigint, whole bigint"
_BLOCK = "k binary, fp bigint, block int, high int, start bigint, n int, core bigint, whole bigint, rep boolean, w array<bigint>"


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Texts under 128 bits of their SHA-256: rows of equal texts are equal in every respect here."""
    sha = F.sha2(utf8(text), 256)
    return docs.select(F.col(key).alias("doc_id"), F.unhex(F.substring(sha, 1, 32)).alias("k"), utf8(text).alias("body"), sha.alias("sha"))


def _run_rows(length: int):
    def rows(batches):
        for batch in batches:
            for first, bodies in slabs(batch.column("body")):
                for row, start, n, back, fp, whole in runs(bodies, length):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("k").take(pa.array(row + first)), pa.array(start), pa.array(n.astype(np.int32)),
                         pa.array(back.astype(np.int32)), pa.array(fp), pa.array(whole)], names=["k", "start", "n", "back", "fp", "whole"])
    return rows


def _block_rows(length: int):
    names = ["k", "fp", "block", "high", "start", "n", "core", "whole", "rep", "w"]
    kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]

    def rows(batches):
        for batch in batches:
            made = [[] for _ in names]
            for k, body, wanted in zip(batch.column("k"), batch.column("body"), batch.column("runs")):
                k, wanted = k.as_py(), wanted.as_py()
                for run, *rest, w in blocks(body.as_py(), [(r["start"], r["n"], r["back"]) for r in wanted], length):
                    for held, value in zip(made, (k, wanted[run]["fp"], *rest, wanted[run]["rep"], w)):
                        held.append(value)
                if len(made[0]) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(m, t) for m, t in zip(made, kinds)], names=names)
                    made = [[] for _ in names]
            if made[0]:
                yield pa.RecordBatch.from_arrays([pa.array(m, t) for m, t in zip(made, kinds)], names=names)
    return rows


def _merged(length: int):
    """Byte spans of each text's covered windows, merged where they touch."""
    span = pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64())]))

    def rows(batches):
        for batch in batches:
            out = []
            for found in batch.column("found"):
                spans: list[dict] = []
                for w in sorted(found.as_py(), key=lambda w: w["start"]):
                    end = w["start"] + w["n"] - 1 + length
                    if spans and w["start"] <= spans[-1]["behind"]:
                        spans[-1]["behind"] = max(spans[-1]["behind"], end)
                    else:
                        spans.append({"first": w["start"], "behind": end})
                out.append(spans)
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(out, span)], names=["k", "spans"])
    return rows


def _rerank(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` whose rank ``by`` more than one has; the unique ones drop out.

    Counts are pre-aggregated and written before the join, whose sides then come straight
    from their exchanges, so that AQE can split a rank that many rows share.
    """
    common = settle_table(rows.groupBy(*by).agg(F.count("*").alias("_c")).filter("_c > 1").select(*by))
    return rows.join(common, by, "left_semi")


def _mixed(kinds: DataFrame, by: list[str]) -> DataFrame:
    """``kinds`` of a rank ``by`` that has several, with the same care for common ranks."""
    several = settle_table(kinds.groupBy(*by).agg(F.count("*").alias("_c")).filter("_c > 1").select(*by))
    return kinds.join(several, by, "left_semi")


def _first_rows(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``k, body, runs``: one row of each wanted text; which one is settled on ids, so copies of a text don't move."""
    names = broadcast_checked(wanted.select("k"))
    chosen = keyed.select("k", "doc_id").join(names, "k", "left_semi").groupBy("k").agg(F.min("doc_id").alias("one"))
    tied = broadcast_checked(chosen.join(wanted, "k"))
    own = (F.col("t.k") == F.col("c.k")) & F.col("doc_id").eqNullSafe(F.col("one"))
    return (keyed.select("k", "doc_id", "body").alias("t").join(tied.alias("c"), own).select("t.k", "body", "runs").dropDuplicates(["k"]))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``(k, spans)``: the bytes of each text, under its key, that strings of ``length`` bytes occurring elsewhere cover.

    Ranks grow as in prefix doubling: anchors of half the length first, then whole runs
    of windows at an anchor, then blocks of 16 windows, then the windows themselves. At
    each step Spark ranks the surviving places anew, and those with a rank of their own
    drop out, as do those that are settled; one run or block stands for all its equals
    from then on. So most bytes of the input never become a row.
    """
    keyed = _keyed(docs, key, text)
    all_runs = settle_table(keyed.select("k", "body").transform(in_batches, _run_rows(length), _RUN))
    live = settle_table(_rerank(all_runs, ["fp"]))
    kinds = live.groupBy("fp", "whole").agg(F.count("*").alias("c"), F.min(F.struct("k", "start", "n", "back")).alias("one"))
    kinds = settle_table(kinds)
    settled = live.join(kinds.filter("c > 1").select("fp", "whole"), ["fp", "whole"], "left_semi").select("k", "start", "n").distinct()
    # An anchor with one kind of run is settled; otherwise each kind sends one run on.
    onward = _mixed(kinds, ["fp"]).select("one.*", "fp", (F.col("c") > 1).alias("rep"))
    wanted = settle_table(onward.groupBy("k").agg(F.collect_list(F.struct("start", "n", "back", "fp", "rep")).alias("runs")))
    cut = settle_table(_first_rows(keyed, wanted).transform(in_batches, _block_rows(length), _BLOCK))

    same = _rerank(cut.select("k", "fp", "block", "core", "high", "n", "whole", "start", "rep"), ["fp", "block", "core"])
    parts = settle_table(same.groupBy("fp", "block", "core", "high", "n", "whole").agg(
        F.count("*").alias("c"), F.min(F.struct("k", "start")).alias("one"), F.max("rep").alias("rep")))
    by_part = ["fp", "block", "core", "high", "n", "whole"]
    equal = cut.filter("not rep").join(parts.filter("c > 1").select(*by_part), by_part, "left_semi").select("k", "start", "n")
    last = _mixed(parts, ["fp", "block", "core"]).select("one.*", "fp", "block")
    single = (cut.join(last, ["k", "start", "fp", "block"], "left_semi")
              .select("k", "start", "high", "fp", F.posexplode("w").alias("i", "w"))
              .select("k", (F.col("start") + F.col("i")).alias("start"), F.lit(1).alias("n"), "fp", (F.col("high") - F.col("i")).alias("back"), "w"))
    ones = _rerank(single, ["fp", "back", "w"]).select("k", "start", "n")
    found = settled.unionByName(equal).unionByName(ones)
    grouped = found.groupBy("k").agg(F.collect_list(F.struct("start", "n")).alias("found"))
    span = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("behind", T.LongType())]))
    return grouped.transform(in_batches, _merged(length), T.StructType([T.StructField("k", T.BinaryType()), T.StructField("spans", span)]))


def _without(batches):
    for batch in batches:
        removed, digests = [], []
        for body, spans in zip(batch.column("body"), batch.column("spans").to_pylist()):
            body, kept, last, n = body.as_py(), hashlib.sha256(), 0, 0
            for s in spans:
                kept.update(body[last:s["first"]])
                n += s["behind"] - s["first"]
                last = s["behind"]
            kept.update(body[last:])
            removed.append(n)
            digests.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "k", "n_bytes", "n_spans")), pa.array(removed, pa.int64()), pa.array(digests)],
            names=["doc_id", "k", "n_bytes", "n_spans", "n_removed", "kept_sha256"])


def sharing_rows(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``k`` of the texts that share a passage of ``words`` words: with another text, or as one that several rows hold."""
    return settle_table(sharing_texts(_keyed(docs, key, text).select("k", "body"), words))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, shares_passage``.

    Every byte goes that lies in a string of ``length`` bytes which starts anywhere else
    too, in this or another row; the input alone decides, and spans that overlap or
    touch are one. Strings don't cross rows. Null counts as empty; texts under ``length``
    bytes keep all. Of repeated long texts no byte stays. ``shares_passage`` says whether a
    passage of ``words`` words stands in another row too, however few bytes it has; nothing
    is removed for that. An empty table gives no rows; other columns are not read.
    """
    sharing = sharing_rows(docs, key, text, words)
    spans = settle_table(repeated_spans(docs, key, text, length))
    rows = _keyed(docs, key, text).withColumn("n_bytes", F.octet_length("body").cast("long"))
    tied = rows.join(broadcast_checked(spans), "k", "left").withColumn("n_spans", F.coalesce(F.size("spans"), F.lit(0)).cast("long"))
    # Only texts with spans go through Python; a missing list has size -1 or null.
    clean = tied.filter("spans is null").select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"),
                                                F.lit(0).cast("long").alias("n_spans"), F.col("sha").alias("kept_sha256"), "k")
    schema = T.StructType([rows.schema["doc_id"], T.StructField("k", T.BinaryType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_spans", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    cut = tied.filter("spans is not null").select("doc_id", "k", "n_bytes", "n_spans", "body", "spans").transform(in_batches, _without, schema)
    out = clean.unionByName(cut).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "k")
    return (out.join(broadcast_checked(sharing.withColumn("shares", F.lit(True))), "k", "left")
            .withColumn("shares_passage", F.coalesce("shares", F.lit(False))).drop("k", "shares"))
