"""MinHash near-deduplication: one-permutation hashing with optimal densification.

1. A document's set is its distinct 5-word shingles, hashed to 64 bits.  One
   permutation splits the hash range into bins; a bin's minimum is the sketch's
   entry, and an empty bin borrows from the bin that a fixed random sequence
   reaches first (optimal densification).
2. Bands of the sketch are bucket keys.  Copies inside a task are folded to one
   representative, which also stands for its bucket there, so a bucket that
   holds a third of all rows sends one row per task.  A bucket's candidates are
   a star around its smallest document: edges grow with rows, not with pairs.
3. Components of the star edges hold every pair that shares a bucket.  Their
   documents' full sets are gathered by component, a large component cut into
   blocks that are compared block pair by block pair, and intersections are
   counted through the postings of the shingles.  Confirmed links leave a task
   as a forest, so its edges too grow with rows only.
4. Components of the confirmed links are the result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.llm.components import connected_components
from cohortia.llm.scratch import store
from cohortia.llm.words import mix64, shingle_sets, smallest_roots
from cohortia.llm.workers import light

BINS, BANDS, BAND_ROWS = 256, 36, 7      # 1 - (1 - 0.85**7)**36 = 1 - 9e-7
BLOCK_DOCS = 512
EMPTY = np.uint64(2 ** 64 - 1)


def sketches(values: np.ndarray, owner: np.ndarray, n_docs: int, bins: int = BINS) -> np.ndarray:
    """(n_docs, bins) one-permutation sketches of sorted sets; every set has a value."""
    width = np.uint64((1 << 64) // bins)
    at = np.minimum(values // width, np.uint64(bins - 1)).astype(np.int64) + owner * bins
    first = np.flatnonzero(np.diff(at, prepend=-1))          # sets are sorted, so bins are too
    out = np.full(n_docs * bins, EMPTY, np.uint64)
    out[at[first]] = mix64(values[first])
    out = out.reshape(n_docs, bins)
    full = out != EMPTY
    doc, bin_ = np.nonzero(~full)
    step = 0
    while len(doc):
        step += 1
        draw = mix64(bin_.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(step)) % np.uint64(bins)
        hit = full[doc, draw.astype(np.int64)]
        out[doc[hit], bin_[hit]] = out[doc[hit], draw[hit].astype(np.int64)]
        doc, bin_ = doc[~hit], bin_[~hit]
    return out


def band_keys(sketch: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    keys = np.empty((len(sketch), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sketch), b + 1, np.uint64)
        for r in range(b * rows, (b + 1) * rows):
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + sketch[:, r])
        keys[:, b] = h
    return keys.view(np.int64)


def confirmed_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int):
    """Pairs (i in left, j in right, i != j) with 100·|i∩j| >= percent·|i∪j|."""
    size = np.array([len(s) for s in sets])
    flat = np.concatenate([sets[j] for j in right]) if len(right) else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(right)), size[right])
    order = np.argsort(flat, kind="stable")
    flat, doc = flat[order], doc[order]
    begin_all = np.flatnonzero(np.diff(flat, prepend=flat[:1] + np.uint64(1))) if len(flat) else np.zeros(0, np.int64)
    keys, ends = flat[begin_all], np.append(begin_all[1:], len(flat))
    if not len(keys):
        return
    for i in left:
        at = np.searchsorted(keys, sets[i])
        at[at == len(keys)] = 0
        at = at[keys[at] == sets[i]]
        n = ends[at] - begin_all[at]
        take = np.repeat(begin_all[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        common = np.bincount(doc[take], minlength=len(right))
        j = np.flatnonzero(100 * common >= percent * (size[i] + size[right] - common))
        j = j[right[j] != i]
        yield i, right[j]


def minhash_dedup(docs: DataFrame, percent: int = 85, shingle: int = 5, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    Words are runs without ASCII white space, A-Z lower-cased.  A text with fewer words
    than a shingle has one shingle, all of them; one without words, or null, has none
    and links with nothing.  Documents with 100·intersection >= percent·union are
    linked; a component's smallest id stays.  Rows that repeat an id get one verdict
    between them; a null id links with nothing and is kept.  Other columns aren't read.
    """
    id_and_text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, n long, rep long, other long, key long"
    names = ["id", "n", "rep", "other", "key"]

    def sketch(batches):
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi, sets in shingle_sets(texts, shingle):
                first: dict[bytes, int] = {}
                own = ids[lo:hi]
                for i in sorted((i for i in range(len(own)) if own[i] is not None), key=own.__getitem__):
                    first.setdefault(sets[i].tobytes(), i)
                rep = [None if i is None or not len(s) else own[first[s.tobytes()]] for i, s in zip(own, sets)]
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(rep, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names)
                reps = np.array(sorted(i for s, i in first.items() if s), np.int64)
                if not len(reps):
                    continue
                values = np.concatenate([sets[i] for i in reps])
                owner = np.repeat(np.arange(len(reps)), [len(sets[i]) for i in reps])
                rep_ids = np.array([own[i] for i in reps], np.int64)
                keys = band_keys(sketches(values, owner, len(reps))).ravel()
                who = np.repeat(rep_ids, BANDS)
                order = np.lexsort((who, keys))
                keys, who = keys[order], who[order]
                begin = np.flatnonzero(np.diff(keys, prepend=keys[0] ^ 1))
                hub = np.repeat(who[begin], np.diff(np.append(begin, len(keys))))
                star = np.unique(np.stack([hub, who], 1)[hub != who], axis=0)
                k, m = len(star), len(begin)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(k + m, pa.int64()), pa.nulls(k + m, pa.int64()),
                     pa.array(np.concatenate([star[:, 0], who[begin]])),
                     pa.array([*star[:, 1].tolist(), *[None] * m], pa.int64()),
                     pa.array([*[None] * k, *keys[begin].tolist()], pa.int64())], names)

    rows = store(id_and_text.mapInArrow(light(sketch), schema), "sketches")
    documents = rows.where(F.col("key").isNull() & F.col("other").isNull()).select("id", "n", "rep")
    near = rows.where(F.col("other").isNotNull()).select(F.col("rep").alias("a"), F.col("other").alias("b"))
    buckets = rows.where(F.col("key").isNotNull()).select("key", F.col("rep").alias("b"))
    hubs = store(buckets.groupBy("key").agg(F.min("b").alias("a"), F.max("b").alias("z")).where("a <> z"), "hubs")
    star = buckets.join(hubs, "key").where("a <> b").select("a", "b")
    candidates = store(connected_components(near.unionByName(star)), "candidates")

    # Blocks of a component: one for most, more for a large one.
    sizes = candidates.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK_DOCS).cast("int")
    sizes = store(sizes.select(F.col("component").alias("c"), blocks.alias("blocks")), "blocks")
    dealt = candidates.join(sizes, F.col("component") == F.col("c")).withColumn(
        "block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = store(dealt.select(F.col("node"), "component", "blocks", "block"), "dealt")
    # the same plan at every size: texts meet their places by a shuffle
    sets = id_and_text.join(dealt.hint("merge"), F.col("id") == F.col("node")).select("node", "component", "blocks", "block", "text")

    def shingles(batches):
        for b in batches:
            for lo, hi, found in shingle_sets(b.column(4).to_pylist(), shingle):
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], pa.array([s.tobytes() for s in found], pa.binary())],
                    ["node", "component", "blocks", "block", "set"])

    sets = sets.mapInArrow(light(shingles), "node long, component long, blocks int, block int, set binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    sets = sets.withColumn("with", other).withColumn("lo", F.least("block", "with")) \
        .withColumn("hi", F.greatest("block", "with"))

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        node, block = pdf["node"].to_numpy(), pdf["block"].to_numpy()
        # equal sets are one: their smallest document stands for them
        first: dict[bytes, int] = {}
        same = np.array([first.setdefault(s, i) for i, s in enumerate(pdf["set"])])
        a, b = [np.flatnonzero(same != np.arange(len(node)))], [same[same != np.arange(len(node))]]
        solo = np.flatnonzero(same == np.arange(len(node)))
        sets = [np.frombuffer(s, "<u8") for s in pdf["set"]]
        lo, hi = pdf["lo"].iloc[0], pdf["hi"].iloc[0]
        # a set found in both blocks stands in one of them, so all that stand are compared
        left = solo if lo == hi else solo[block[solo] == lo]
        right = solo if lo == hi or len(solo) < len(node) else solo[block[solo] == hi]
        for i, j in confirmed_links(sets, left, right, percent):
            a.append(np.full(len(j), i))
            b.append(j)
        root = smallest_roots(len(node), np.concatenate(a), np.concatenate(b))
        at = np.flatnonzero(root != np.arange(len(node)))
        return pd.DataFrame({"a": node[root[at]], "b": node[at]})

    links = sets.groupBy("component", "lo", "hi").applyInPandas(verify, "a long, b long")
    found = store(connected_components(store(links, "links")), "components")
    out = documents.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
    component = F.coalesce("component", "rep", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def one_of_each_group(docs: DataFrame, percent: int = 85, shingle: int = 5, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that ``minhash_dedup`` doesn't keep."""
    gone = store(minhash_dedup(docs, percent, shingle, id_col, text_col).where(~F.col("kept"))
                 .select(F.col(id_col).alias("__gone")).distinct(), "gone")
    return docs.join(gone, F.col(id_col).cast("long") == F.col("__gone"), "left_anti")
