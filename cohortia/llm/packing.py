"""Packing documents into fixed-length training sequences.

Bounded-space online packing: every partition holds ``open_windows`` windows.
A document's whole windows are emitted as they are; its tail goes to the window
with the smallest gap that holds it.  When none does and no further window may
be opened, the fullest one is closed: its gap is filled with the head of the
tail, or padded when the gap is under ``min_cut`` tokens.  Windows still open
at the end of a partition are merged over all partitions: their pieces are laid
end to end by a prefix sum and cut at multiples of the window.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortia.llm.scratch import store
from cohortia.llm.tokens import encoder, in_steps
from cohortia.llm.workers import light

MERGED = 1 << 62       # sequence ids of merged leftovers begin here


class _Packer:
    """Placement of one partition's tails; ``out`` gets (sequence, offset, doc, start, length)."""

    def __init__(self, window: int, open_windows: int, min_cut: int, first: int):
        self.window, self.most, self.min_cut, self.next = window, open_windows, min_cut, first
        self.gaps: list[tuple[int, int]] = []       # (gap, sequence), by gap

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, doc: int, start: int, length: int, out: list) -> None:
        while length:
            at = bisect_left(self.gaps, (length, -1))
            if at < len(self.gaps):                 # best fit
                gap, seq = self.gaps.pop(at)
            elif len(self.gaps) < self.most:
                gap, seq = self.window, self.new()
            else:                                   # none fits: close the fullest
                gap, seq = self.gaps.pop(0)
                if gap < self.min_cut:
                    continue
            n = min(gap, length)
            out.append((seq, self.window - gap, doc, start, n))
            start, length = start + n, length - n
            if gap > n:
                insort(self.gaps, (gap - n, seq))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = 4096,
                   open_windows: int = 64, min_cut: int = 16,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: ``id_col``, start, length, doc_tokens, sequence_id,
    offset, ids (little-endian uint32).

    A document is its ids plus ``end_id``; null text counts as empty, so every
    row has at least one piece.  Repeated rows and repeated or null ids are
    packed row by row.  Other columns are not read.  An empty table gives no
    pieces.  Only the pieces of windows left open by a partition (at most
    ``open_windows`` of them) take part in the merge; the rest is written once.
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, id_type), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("part", T.IntegerType()),
        T.StructField("position", T.LongType())])

    def pack(batches):
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        packer = _Packer(window, open_windows, min_cut, part << 32)
        end, held = np.array([end_id], "<u4").tobytes(), {}
        names = [f.name for f in schema.fields]

        def batch(keys, rows, open_):
            """rows: (key index, start, length, doc_tokens, sequence, offset, ids)."""
            c = list(zip(*rows, strict=True)) if rows else [()] * 7
            position = np.concatenate([[0], np.cumsum(c[2])])[:-1] if rows else []
            return pa.RecordBatch.from_arrays(
                [keys.take(pa.array(c[0], pa.int64())),
                 *(pa.array(x, pa.int64()) for x in c[1:6]), pa.array(c[6], pa.binary()),
                 pa.array([part if open_ else None] * len(rows), pa.int32()),
                 pa.array(position if open_ else [None] * len(rows), pa.int64())], names)

        for b in batches:
            keys, texts = b.column(0), b.column(1).to_pylist()
            for lo, hi in in_steps(texts, 2048):        # distinct words are encoded once a step
                done = []
                for i, ids in enumerate(enc.encode(texts[lo:hi]), lo):
                    ids += end
                    n, out = len(ids) // 4, []
                    whole = n // window * window
                    for s in range(0, whole, window):
                        done.append((i, s, window, n, packer.new(), 0, ids[4 * s:4 * (s + window)]))
                    packer.place(i, whole, n - whole, out)
                    for seq, off, doc, s, k in out:
                        held.setdefault(seq, []).append((keys[doc], s, k, n, seq, off, ids[4 * s:4 * (s + k)]))
                open_ = {seq for _, seq in packer.gaps}
                closed = [r for seq in [s for s in held if s not in open_] for r in held.pop(seq)]
                own = pa.array([r[0].as_py() for r in closed], keys.type)
                yield batch(keys, done, False)
                yield batch(own, [(j, *r[1:]) for j, r in enumerate(closed)], False)
        rest = [r for seq in held for r in held[seq]]
        if rest:
            own = pa.array([r[0].as_py() for r in rest], rest[0][0].type)
            yield batch(own, [(j, *r[1:]) for j, r in enumerate(rest)], True)

    rows = store(docs.select(id_col, text_col).mapInArrow(light(pack, encoders=False), schema), "packed")
    columns = [id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    # one row per partition: the running total over partitions is a short single-task window
    sums = rows.where(F.col("part").isNotNull()).groupBy("part").agg(F.sum("length").alias("sum"))
    before = sums.select("part", F.coalesce(F.sum("sum").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    left = (rows.where(F.col("part").isNotNull()).join(before, "part")
            .withColumn("at", F.col("before") + F.col("position")))
    last = F.col("at") + F.col("length") - 1
    cut = left.withColumn("k", F.explode(F.sequence(F.floor(F.col("at") / window), F.floor(last / window))))
    s = F.greatest(F.col("at"), F.col("k") * window)
    n = F.least(F.col("at") + F.col("length"), (F.col("k") + 1) * window) - s
    skip = s - F.col("at")
    merged = cut.select(
        id_col, (F.col("start") + skip).alias("start"), n.alias("length"), "doc_tokens",
        (F.col("k") + F.lit(MERGED)).alias("sequence_id"), (s - F.col("k") * window).alias("offset"),
        F.substring("ids", (skip * 4 + 1).cast("int"), (n * 4).cast("int")).alias("ids"))
    return rows.where(F.col("part").isNull()).select(*columns).unionByName(merged)
