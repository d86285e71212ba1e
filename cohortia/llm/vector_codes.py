"""Product codes of vectors from exact integer arithmetic.

Components become integers; a vector is cut into parts and every part is named by
the nearest entry of its codebook.  The codebooks are fitted by passes over the
stored integers: each task assigns its rows and returns one sum per codebook cell,
and the cells (``entries`` * components of them, whatever the number of rows) meet
in one aggregation.

Distances are exact.  A squared distance is |a|^2 - 2ab + |c|^2; the products ab
are float64 matrix products of limbs, signed pieces of the integers so short that
no sum of products reaches 2^53, and the pieces are put together in int64.  The
nearest entry is the first of the smallest, so ties go to the lower index.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortia.llm.scratch import store

STEP = 4096         # rows whose distances to all entries are held at once


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 pieces with x = sum(piece[i] * 2**(bits * i)) and |piece| <= 2**(bits - 1)."""
    half, out = 1 << (bits - 1), []
    while True:
        low = ((x + half) & ((1 << bits) - 1)) - half
        out.append(low.astype(np.float64))
        x = (x - low) >> bits
        if not x.any():
            return out


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x @ y.T of int64 matrices whose true products fit int64."""
    bits = (55 - x.shape[1].bit_length()) // 2          # (2**(bits-1))**2 * columns <= 2**53
    out = np.zeros((len(x), len(y)), np.int64)
    right = limbs(y, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            out += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first nearest entry, squared distance) of every row."""
    index, distance = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    own = (book * book).sum(1)
    for lo in range(0, len(x), STEP):
        a = x[lo:lo + STEP]
        d = own - 2 * exact_products(a, book)
        at = d.argmin(1)
        index[lo:lo + STEP] = at
        distance[lo:lo + STEP] = d[np.arange(len(a)), at] + (a * a).sum(1)
    return index, distance


def largest_component(dims: int) -> int:
    """Bound of the integers that keeps a whole vector's squared distance below 2**62."""
    return (1 << (62 - dims.bit_length()) // 2) >> 1


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column, with zeros up to ``dims``."""
    length = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy().astype(np.int64)
    if (length == dims).all():
        return flat.reshape(len(column), dims)
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < length[:, None]] = flat
    return out


def _first_books(ints: DataFrame, entries: int, dims: int) -> np.ndarray:
    """Vectors of the ``entries`` smallest ids; at most entries * dims numbers reach the driver."""
    ids = ints.select(F.col("id").alias("seed")).distinct().orderBy(F.col("seed").asc_nulls_last()).limit(entries)
    rows = (ints.join(F.broadcast(ids), F.col("id").eqNullSafe(F.col("seed")))
            .groupBy("id").agg(F.min("v").alias("v")).orderBy(F.col("id").asc_nulls_last()).collect())
    out = np.zeros((len(rows), dims), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r.v)] = r.v
    return out


def _cell_sums(ints: DataFrame, books: list[np.ndarray], dims: int) -> DataFrame:
    """(cell, value): per part and entry the number of parts assigned to it, then their sum by component."""
    parts, entries, width = len(books), *books[0].shape

    def sums(batches):
        total = np.zeros((parts, entries, width + 1), np.int64)
        for b in batches:
            x = _matrix(b.column(0), dims)
            for p, book in enumerate(books):
                own = x[:, p * width:(p + 1) * width]
                at = nearest(own, book)[0]
                total[p, :, 0] += np.bincount(at, minlength=entries)
                for j in range(width):          # float64 sums of one batch: exact
                    total[p, :, j + 1] += np.bincount(at, own[:, j], entries).astype(np.int64)
        cell = np.flatnonzero(total.reshape(-1))
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.reshape(-1)[cell])], ["cell", "value"])

    return ints.select("v").mapInArrow(sums, "cell long, value long").groupBy("cell").agg(F.sum("value").alias("value"))


def compress_vectors(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: float = 1024.0,
                     id_col: str = "vec_id", vec_col: str = "embedding",
                     label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, code, error) of every vector kept, and the codebooks (one array of entries per part).

    A component x is floor(``scale`` * x).  Codebooks begin as the parts of the ``entries``
    smallest ids and are replaced ``rounds`` times by the floors of their parts' means; an
    entry without parts stays.  ``code`` has one index per part, two hex digits each;
    ``error`` is the squared distance to the entries, over all parts.

    Dropped: null vectors and those that hold null, NaN or an infinity.  Repeated rows are
    coded row by row.  Of rows that share an id the smallest vector begins the codebook; a
    null id comes after all others.  Fewer ids than ``entries`` give smaller codebooks.  Vectors
    shorter than the longest, or than a multiple of ``parts``, count as filled up with zeros.
    Integers are held within ``largest_component`` (2**26 at 64 components), so that every
    distance is exact in int64.  A table without a vector gives no rows and empty codebooks.
    Other columns aren't read.  The driver holds the codebooks only.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index of a code has two hex digits")
    spark = vectors.sparkSession
    v = F.col("v")
    real = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.col(vec_col).cast("array<double>").alias("v")).where(v.isNotNull() & real)
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    schema = T.StructType([T.StructField("id", kept.schema["id"].dataType), T.StructField("label", kept.schema["label"].dataType),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if longest is None:
        return spark.createDataFrame([], schema), [np.zeros((0, 0), np.int64)] * parts
    width = -(-longest // parts)
    dims, most = width * parts, float(largest_component(width * parts))
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(most)), F.lit(-most))).cast("int"))
    ints = store(kept.withColumn("v", whole), "integers")
    seeds = _first_books(ints, entries, dims)
    books = [np.ascontiguousarray(seeds[:, p * width:(p + 1) * width]) for p in range(parts)]
    for _ in range(rounds):
        total = np.zeros(parts * len(seeds) * (width + 1), np.int64)
        for cell, value in _cell_sums(ints, books, dims).collect():
            total[cell] = value
        total = total.reshape(parts, len(seeds), width + 1)
        books = [np.where(t[:, :1] > 0, t[:, 1:] // np.maximum(t[:, :1], 1), b) for t, b in zip(total, books, strict=True)]

    def code(batches):
        for b in batches:
            x = _matrix(b.column(2), dims)
            found = [nearest(x[:, p * width:(p + 1) * width], book) for p, book in enumerate(books)]
            text = np.stack([i for i, _ in found], 1).astype(np.uint8).tobytes().hex()
            codes = [text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(codes, pa.string()),
                                              pa.array(sum(d for _, d in found))], ["id", "label", "code", "error"])

    return ints.mapInArrow(code, schema), books


def label_errors(codes: DataFrame) -> DataFrame:
    """(label, label_error): errors summed over equal labels, nulls together (null beyond 2**63)."""
    return codes.groupBy("label").agg(F.try_sum("error").alias("label_error"))
