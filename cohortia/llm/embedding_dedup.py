"""Embedding near-duplicates by spherical-cap filters from a random product code.

The vector is turned by a random rotation and cut into ``parts`` blocks; each block
has a code of ``words`` random unit vectors, and a filter is one code word per
block.  The score of a filter is the sum of its words' inner products, so the
filters that a unit vector exceeds a threshold on are list-decoded: blocks are
combined one by one, dropping what can't reach the threshold any more.  A
vector's threshold is the score of its ``lists``-th best filter, which keeps its
list at one length, wherever it lies.  Several independent rotations
(``codes``) raise the recall; two vectors meet in every filter that both exceed.

Buckets are joined
by filter, a large one in blocks; inside a task similarities are double
precision matrix products, a pair counts only in its smallest common filter, and
the links leave as per-vector counts and a spanning forest, never as pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.llm.components import connected_components
from cohortia.llm.scratch import store
from cohortia.llm.words import smallest_roots

BLOCK_VECTORS = 2048


class ProductCode:
    """Random rotation and code words; filters are numbers in mixed radix ``words``."""

    def __init__(self, dim: int, parts: int, words: int, seed: int):
        rng = np.random.default_rng(seed)
        self.parts, self.words, self.size = parts, words, words ** parts
        self.turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        cut = np.linspace(0, dim, parts + 1).astype(int)
        self.cut = list(zip(cut[:-1], cut[1:], strict=True))
        code = [rng.normal(size=(words, b - a)) for a, b in self.cut]
        self.code = [c / np.linalg.norm(c, axis=1, keepdims=True) for c in code]

    def exceeding(self, scores: list[np.ndarray], best: np.ndarray, goal: np.ndarray):
        """All (row, filter, score) with a score of at least the row's goal."""
        rest = np.concatenate([np.cumsum(best[:, ::-1], 1)[:, ::-1][:, 1:], np.zeros((len(best), 1))], 1)
        row, score, code = np.arange(len(best)), np.zeros(len(best)), np.zeros(len(best), np.int64)
        for p, s in enumerate(scores):
            new = score[:, None] + s[row]
            keep, word = np.nonzero(new + rest[row, p][:, None] >= goal[row][:, None])
            row, score, code = row[keep], new[keep, word], code[keep] * self.words + word
        return row, code, score

    def decode(self, x: np.ndarray, lists: int) -> np.ndarray:
        """(rows, lists) filters of each vector: those that exceed its own threshold."""
        y = x @ self.turn
        scores = [y[:, a:b] @ c.T for (a, b), c in zip(self.cut, self.code, strict=True)]
        best = np.stack([s.max(1) for s in scores], 1)
        least = sum(s.min(1) for s in scores)
        lists = min(lists, self.size)
        out, todo, low = np.zeros((len(x), lists), np.int64), np.arange(len(x)), 0.1
        while len(todo):
            top = best[todo].sum(1)
            goal = np.maximum(top - low * (top - least[todo]), least[todo] - 1e-9)
            row, code, score = self.exceeding([s[todo] for s in scores], best[todo], goal)
            order = np.lexsort((code, -score, row))
            row, code = row[order], code[order]
            n = np.bincount(row, minlength=len(todo))
            begin = np.cumsum(n) - n
            done = n >= lists
            out[todo[done]] = code[begin[done][:, None] + np.arange(lists)]
            todo, low = todo[~done], min(1.0, low * 1.6)
        return out


def unit_vectors(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision and which rows have one."""
    x = np.zeros((len(column), dim))
    good = np.zeros(len(column), bool)
    for i, v in enumerate(column.to_pylist()):
        if v is not None and len(v) == dim and all(c is not None for c in v):
            x[i] = v
            good[i] = np.isfinite(x[i]).all()
    x[~good] = 0
    good &= (x != 0).any(1)
    return unit_rows(x), good


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that very large and very small ones keep their digits."""
    scale = np.abs(x).max(1, keepdims=True, initial=0)
    x = x / np.where(scale > 0, scale, 1)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def near_vectors(vectors: DataFrame, cosine: float = 0.9, parts: int = 3, words: int = 32,
                 lists: int = 8, codes: int = 2, seed: int = 11, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Vectors that are null, zero, of another length than most, or hold null or non-finite
    components link with nothing and are kept.  Other columns aren't read.  Equal vectors link;
    rows that repeat an id are vectors of their own that share an id and its
    verdict.  ``dim`` is that of the most frequent length; an empty table gives no rows.
    """
    dims = (vectors.where(F.col(vector_col).isNotNull()).groupBy(F.size(vector_col).alias("d"))
            .agg(F.count(F.lit(1)).alias("n")).where("d > 0").agg(F.max(F.struct("n", "d"))["d"]).first()[0])
    dim = dims or 1
    code = [ProductCode(dim, min(parts, dim), words, seed + c) for c in range(codes)]
    slim = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))

    def decode(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                x, good = unit_vectors(part.column(1), dim)
                good &= part.column(0).is_valid().to_numpy(zero_copy_only=False)
                ids = pa.compute.filter(part.column(0), pa.array(good))
                found = [c.decode(x[good], lists) + k * c.size for k, c in enumerate(code)]
                filters = np.sort(np.concatenate(found, 1), 1)
                raw = [np.asarray(v, "<f8").tobytes() for v in pa.compute.filter(part.column(1), pa.array(good)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(raw, pa.binary()), pa.array(filters.tolist(), pa.list_(pa.int64()))],
                    ["id", "x", "filters"])

    coded = store(slim.mapInArrow(decode, "id long, x binary, filters array<long>"), "filters")
    placed = coded.select("id", "x", "filters", F.explode("filters").alias("filter"))
    sizes = placed.groupBy("filter").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = store(sizes.select(F.col("filter").alias("f"),
                               F.ceil(F.col("size") / BLOCK_VECTORS).cast("int").alias("blocks")), "buckets")
    placed = (placed.join(sizes, F.col("filter") == F.col("f")).drop("f")
              .withColumn("block", F.pmod(F.xxhash64("id", "x"), "blocks").cast("int"))
              .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("lo", F.least("block", "with")).withColumn("hi", F.greatest("block", "with")))

    def compare(batches):
        """Rows sorted by bucket -> per run of buckets: links found and a hub for each vector."""
        def links_of(filt, cross, block, ids, x, lists):
            x = unit_rows(x)
            begin = np.flatnonzero(np.diff(filt, prepend=filt[0] ^ 1) | np.diff(cross, prepend=cross[0] ^ 1))
            size = np.diff(np.append(begin, len(filt)))
            small = np.repeat(size <= 128, size)
            end = np.repeat(begin + size, size)
            row = np.flatnonzero(small)
            later = end[row] - row - 1
            upto = np.cumsum(later)
            found = []
            for part in np.split(row, np.searchsorted(upto, np.arange(100_000, upto[-1], 100_000)) if len(row) else []):
                n = end[part] - part - 1
                i = np.repeat(part, n)
                j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
                near = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
                found.append((i[near], j[near]))
            for at, n in zip(begin[size > 128], size[size > 128], strict=True):
                for top in range(at, at + n, 512):
                    i, j = np.nonzero(x[top:min(top + 512, at + n)] @ x[at:at + n].T >= cosine)
                    i, j = i + top, j + at
                    found.append((i[i < j], j[i < j]))
            links, a, b = np.zeros(len(ids), np.int64), [], []
            for i, j in found:
                ok = ((cross[i] >> 32) == (cross[i] & 0xFFFFFFFF)) | (block[i] != block[j])   # of two blocks: pairs across
                i, j = i[ok], j[ok]
                for p, q in zip(np.array_split(i, len(i) // 8192 + 1), np.array_split(j, len(j) // 8192 + 1), strict=True):
                    # a pair counts in its smallest common filter
                    below = np.where(lists[p] < filt[p][:, None], lists[p], -1)
                    new = ~(below[:, :, None] == lists[q][:, None, :]).any((1, 2))
                    links += np.bincount(p[new], minlength=len(ids)) + np.bincount(q[new], minlength=len(ids))
                    a.append(p[new])
                    b.append(q[new])
            if not links.any():
                return
            root = smallest_roots(len(ids), np.concatenate(a), np.concatenate(b))
            on = links > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[on]), pa.array(links[on]), pa.array(ids[root[on]])], ["id", "links", "hub"])

        held = None
        for b in batches:
            if not b.num_rows:
                continue
            filt, lo, hi, block, ids = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(5))
            x = np.frombuffer(b"".join(b.column(5).to_pylist()), "<f8").reshape(-1, dim)
            lists = b.column(6).flatten().to_numpy().reshape(len(ids), -1)
            new = [filt, (lo << 32) + hi, block, ids, x, lists]
            held = new if held is None else [np.concatenate([o, n]) for o, n in zip(held, new, strict=True)]
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
            cut = int(last.argmax())                    # rows are sorted: the last bucket may go on
            if cut:
                yield from links_of(*[h[:cut] for h in held])
                held = [h[cut:] for h in held]
        if held is not None and len(held[0]):
            yield from links_of(*held)

    dealt = (placed.select("filter", "lo", "hi", "block", "id", "x", "filters")
             .repartition("filter", "lo", "hi").sortWithinPartitions("filter", "lo", "hi"))
    found = store(dealt.mapInArrow(compare, "id long, links long, hub long"), "links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    labels = connected_components(found.select(F.col("id").alias("a"), F.col("hub").alias("b")))
    result = store(counts.join(labels, F.col("id") == F.col("node"), "left")
                   .select(F.col("id").alias("i"), "links", "component"), "linked")
    out = slim.select("id").join(result, F.col("id") == F.col("i"), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
