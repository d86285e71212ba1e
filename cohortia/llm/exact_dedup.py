"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every sender (a run of one scan partition) sorts the distinct fingerprints
   of its texts and sends each owner its share, as Rice-coded gaps.
2. An owner decodes all shares of its residue class, finds the fingerprints
   that more than one sender holds, and answers each sender with a bitmap over
   what it sent.
3. A sender marks the rows whose bit is set, or whose fingerprint it holds
   twice itself.  Only these suspects' texts are read again and shuffled; equal
   SHA-256 digests are confirmed byte by byte.

A digest's texts are folded to smallest and largest before the shuffle, so a
text that fills a third of the table sends one row per task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortia.llm.scratch import store

SENDER_ROWS = 1_000_000


def rice_encode(values: np.ndarray) -> bytes:
    """Sorted distinct uint64 values as Rice-coded gaps: count, k, quotients, remainders."""
    n = len(values)
    if not n:
        return b""
    gaps = np.diff(values, prepend=np.uint64(0))
    k = max(0, int(np.log2(max(1.0, float(values[-1]) / n * 0.69))))
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(quotient.sum()) + n, np.uint8)      # q zeros, then a one
    unary[np.cumsum(quotient + 1) - 1] = 1
    shifts = np.arange(k - 1, -1, -1, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    head = np.array([n, k, len(unary)], "<u4").tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(rest).tobytes()


def rice_decode(payload: bytes) -> np.ndarray:
    if not payload:
        return np.zeros(0, np.uint64)
    n, k, size = (int(x) for x in np.frombuffer(payload[:12], "<u4"))
    raw = np.frombuffer(payload, np.uint8, offset=12)
    unary = np.unpackbits(raw[:(size + 7) // 8])[:size]
    quotient = np.diff(np.flatnonzero(unary), prepend=-1) - 1
    rest = np.unpackbits(raw[(size + 7) // 8:])[:n * k].reshape(n, k).astype(np.uint64)
    value = quotient.astype(np.uint64) << np.uint64(k)
    if k:
        value += rest @ (np.uint64(1) << np.arange(k - 1, -1, -1, dtype=np.uint64))
    return np.cumsum(value, dtype=np.uint64)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                fingerprint_bits: int = 48, owners: int | None = None) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as empty.  Of equal texts
    the largest id stays (a null id never wins over another).  Rows that repeat an id
    and a text are all in the group's size and all get the id's verdict.  Other
    columns are not read; an empty table gives an empty result.  A false
    positive of the fingerprint costs one more text in the verification.
    """
    spark = docs.sparkSession
    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(text_col, F.lit("")).alias("text"))
    slim = docs.select("id", F.xxhash64("text").alias("fp"),
                       F.unhex(F.sha2("text", 256)).alias("sha"))
    schema = T.StructType([
        T.StructField("sender", T.LongType()), T.StructField("id", T.LongType()),
        T.StructField("fp", T.LongType()), T.StructField("sha", T.BinaryType()),
        T.StructField("owner", T.IntegerType()), T.StructField("payload", T.BinaryType())])
    names = [f.name for f in schema.fields]
    shift = np.uint64(64 - fingerprint_bits)

    def shares(fp):
        """Sorted distinct fingerprints by owner: (owner, quotients)."""
        u = np.unique(fp)
        own = u % np.uint64(owners)
        order = np.argsort(own, kind="stable")
        u, own = u[order], own[order]
        cut = np.searchsorted(own, np.arange(owners + 1, dtype=np.uint64))
        return u, [(o, u[a:b] // np.uint64(owners)) for o, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a]

    def send(batches):
        part, run, held, n = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            sender = (part << 32) + run
            _, parts = shares(np.concatenate(held))
            k = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([sender] * k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                 pa.nulls(k, pa.binary()), pa.array([o for o, _ in parts], pa.int32()),
                 pa.array([rice_encode(v) for _, v in parts], pa.binary())], names)

        for b in batches:
            fp = b.column(1).to_numpy(zero_copy_only=False).view(np.uint64) >> shift
            k, sender = len(fp), (part << 32) + run
            yield pa.RecordBatch.from_arrays(
                [pa.array([sender] * k, pa.int64()), b.column(0), pa.array(fp.view(np.int64)),
                 b.column(2).cast(pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names)
            held.append(fp)
            n += k
            if n >= SENDER_ROWS:
                yield from flush()
                run, held, n = run + 1, [], 0
        if n:
            yield from flush()

    sent = store(slim.mapInArrow(send, schema), "fingerprints")
    messages = sent.where(F.col("owner").isNotNull()).select("sender", "owner", "payload")
    rows = sent.where(F.col("owner").isNull()).select("sender", "id", "fp", "sha")

    def answer(pdf):
        values = [rice_decode(p) for p in pdf["payload"]]
        u, n = np.unique(np.concatenate(values), return_counts=True)
        twice = u[n > 1]
        pdf["payload"] = [np.packbits(np.isin(v, twice, assume_unique=True)).tobytes() for v in values]
        return pdf[["sender", "owner", "payload"]]

    replies = messages.groupBy("owner").applyInPandas(answer, "sender long, owner int, payload binary")

    def mark(pdf, reply):
        fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        u, parts = shares(fp)
        bits = dict(zip(reply["owner"], reply["payload"]))
        flags = [np.unpackbits(np.frombuffer(bits[o], np.uint8))[:len(v)] for o, v in parts]
        bad = u[np.concatenate(flags).astype(bool)] if flags else u
        v, n = np.unique(fp, return_counts=True)
        pdf["suspect"] = np.isin(fp, np.concatenate([bad, v[n > 1]]))
        return pdf[["id", "sha", "suspect"]]

    marked = store(rows.groupBy("sender").cogroup(replies.groupBy("sender"))
                   .applyInPandas(mark, "id long, sha binary, suspect boolean"), "suspects")
    suspects = store(marked.where("suspect").select(F.col("id").alias("sid")).distinct(), "suspect-ids")
    texts = docs.join(suspects, F.col("id").eqNullSafe(F.col("sid")), "left_semi")
    groups = (texts.groupBy(F.unhex(F.sha2("text", 256)).alias("gsha"))
              .agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("size"),
                   F.min("text").alias("low"), F.max("text").alias("high"))
              .withColumn("keep", F.when(F.col("low") == F.col("high"), F.col("keep")).otherwise(
                  F.raise_error(F.lit("two texts have one SHA-256 digest")).cast("long"))))
    groups = store(groups.select("gsha", "keep", "size"), "groups")
    found = marked.join(groups, F.col("sha") == F.col("gsha"), "left")
    keep = F.coalesce("keep", "id")
    return found.select(
        F.col("id").alias(id_col), keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
