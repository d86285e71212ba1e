"""Token counts per document from flat, unindexed token files.

A flat file is nothing but big-endian 16-bit token ids; documents end with a
separator id that the vocabulary doesn't use, and no index tells where.  Each
file is cut into blocks; a vectorised search finds the separators of a block,
and every block reports its finished lengths, the tokens before its first
separator and the tokens after its last one.  A prefix scan over the blocks of
a file numbers the documents and stitches those that cross block boundaries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortia.llm.scratch import new_path
from cohortia.llm.tokens import encoder, in_steps

#: free in the vocabularies; its two bytes are the UTF-8 form of one character,
#: so Spark's text writer can end each document with it
SEPARATOR, SEPARATOR_TEXT = 0xC280, "\u0080"


def write_flat_tokens(docs: DataFrame, tokenizer: str, path: str, text_col: str = "text",
                      file_docs: int = 4096) -> str:
    """Write all documents' ids (null text: no ids) to flat files below ``path``.

    A file holds at most ``file_docs`` documents, which bounds what one task reads.
    """
    def tokenize(batches):
        enc = encoder(tokenizer)
        for b in batches:
            texts = b.column(0).to_pylist()
            for lo, hi in in_steps(texts):
                ids = [np.frombuffer(x, "<u4") for x in enc.encode(texts[lo:hi])]
                if any(len(x) and x.max() >= SEPARATOR for x in ids):
                    raise ValueError("the vocabulary does not fit the flat format")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.astype(">u2").tobytes() for x in ids], pa.binary())], ["value"])

    (docs.select(text_col).mapInArrow(tokenize, "value binary")
     .select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", SEPARATOR_TEXT).option("maxRecordsPerFile", file_docs)
     .option("compression", "none").text(path))
    return path


def scan_blocks(content: bytes, separator: int, block_tokens: int):
    """Per block: (block, separators, tokens, head, tail, inner lengths)."""
    ids = np.frombuffer(content, ">u2")
    for k, at in enumerate(range(0, len(ids), block_tokens)):
        block = ids[at:at + block_tokens]
        cut = np.flatnonzero(block == separator)
        if len(cut):
            yield k, len(cut), len(block), int(cut[0]), len(block) - 1 - int(cut[-1]), (np.diff(cut) - 1).tolist()
        else:
            yield k, 0, len(block), len(block), len(block), []


def count_tokens(spark: SparkSession, path: str, separator: int = SEPARATOR,
                 block_tokens: int = 1 << 18) -> DataFrame:
    """One row per document of the flat files: file, doc_no, start, n_tokens.

    ``doc_no`` counts from 0 in its file, ``start`` is the index of the document's
    first token there, and ``n_tokens`` leaves the separator out.  Tokens after the last
    separator of a file belong to an unfinished document, which is reported too;
    an empty file has none.  No files: no rows.
    """
    schema = T.StructType([
        T.StructField("file", T.StringType()), T.StructField("block", T.LongType()),
        T.StructField("n_sep", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("head", T.LongType()), T.StructField("tail", T.LongType()),
        T.StructField("inner", T.ArrayType(T.LongType()))])

    def scan(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = [(name, *r) for r in scan_blocks(content.as_buffer(), separator, block_tokens)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(
                            zip(*rows, strict=True),
                            [pa.string(), *[pa.int64()] * 5, pa.list_(pa.int64())], strict=True)],
                        [f.name for f in schema.fields])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    blocks = files.where(F.col("length") > 0).select(name.alias("file"), "content").mapInArrow(scan, schema)

    # Prefix scan over a file's blocks: documents and tokens before the block, and the
    # tokens since the last separator before it.
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scanned = (blocks
               .withColumn("docs_before", F.coalesce(F.sum("n_sep").over(w), F.lit(0)))
               .withColumn("at", F.coalesce(F.sum("n").over(w), F.lit(0)))
               .withColumn("open", F.max(F.when(F.col("n_sep") > 0, F.col("at") + F.col("n") - F.col("tail"))).over(w))
               .withColumn("open", F.coalesce("open", F.lit(0)))
               .withColumn("last", F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull()))
    # Lengths of the documents that end in this block, then of one left unfinished at the end.
    crossing = F.array(F.col("at") + F.col("head") - F.col("open"))
    ended = F.when(F.col("n_sep") > 0, F.concat(crossing, "inner")).otherwise(F.array().cast("array<bigint>"))
    rest = F.when(F.col("n_sep") > 0, F.col("tail")).otherwise(F.col("at") + F.col("n") - F.col("open"))
    lengths = F.when(F.col("last") & (rest > 0), F.concat(ended, F.array(rest))).otherwise(ended)
    each = scanned.select("file", "docs_before", "open", F.posexplode(lengths).alias("i", "n_tokens"))
    inside = Window.partitionBy("file", "docs_before").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    return each.select(
        "file", (F.col("docs_before") + F.col("i")).alias("doc_no"),
        (F.col("open") + F.coalesce(F.sum(F.col("n_tokens") + 1).over(inside), F.lit(0))).alias("start"),
        "n_tokens")


def document_token_counts(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """Tokenise ``docs`` to flat files in the shared folder, then count by scanning them."""
    path = new_path(docs.sparkSession, "flat-tokens")
    return count_tokens(docs.sparkSession, write_flat_tokens(docs, tokenizer, path, text_col))
