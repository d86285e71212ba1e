"""Quality classifier: perplexity under an n-gram model of trusted text.

The model is an interpolated modified Kneser-Ney model over byte n-grams (A-Z
lower-cased, runs of white space as one blank), trained on documents that
``labels`` marks as good.  An n-gram is an integer of ``order`` bytes, so contexts
and shorter n-grams are shifts and masks, and counts, continuation counts,
discounts and back-off weights are plain aggregations and joins.

Scoring joins sharded counts: the corpus' distinct n-grams are joined to the
counts of every order once; each run of documents sends every shard its n-grams
with postings (document, count), a shard looks up its n-grams and returns one
partial sum per document, and the sums of a run meet again.  Nothing of the
model or the corpus is broadcast or collected.  A document whose perplexity is
above its language's quantile over trusted documents (times ``slack``) is rejected.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortia.llm.scratch import store
from cohortia.llm.tokens import in_steps
from cohortia.llm.words import to_bytes
from cohortia.llm.workers import light, release

RUN_CHARS, RUN_DOCS = 4_000_000, 8192
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def grams(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, document indexes) of all bytes of all texts: a text begins after a
    blank context and ends with a blank; one without words has none.

    At most ``RUN_DOCS`` texts; the arrays hold few bytes per character, as a run is long."""
    raw = [to_bytes(t) for t in texts]
    pad = b" " * (order - 1)
    joined = np.frombuffer(b"".join([x for r in raw for x in (pad, r, b" ")] + [pad]), np.uint8).copy()
    size = [len(r) + order for r in raw]
    raw.clear()
    doc = np.repeat(np.arange(len(size) + 1, dtype=np.uint16), [*size, order - 1])
    blank = _BLANK[joined]
    joined[blank] = 32
    # a blank after a blank is dropped, but for the context that begins a text
    begin = np.cumsum([0, *size])
    lead = np.zeros(len(joined), bool)
    for j in range(order - 1):
        lead[begin[:-1] + j] = True
    lead[begin[-1]:] = True
    keep = ~blank | ~np.append(False, blank[:-1]) | lead
    joined, doc, own = joined[keep], doc[keep], ~lead[keep]
    del blank, lead, keep
    value = np.zeros(len(joined), np.uint32 if order <= 4 else np.uint64)
    for j in range(order):                              # the gram that ends at each byte
        value[order - 1:] |= joined[order - 1 - j:len(joined) - j].astype(value.dtype) << value.dtype.type(8 * j)
    return value[own], doc[own]


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(t): the ids that ``labels`` marks as good."""
    return (labels.where((F.col("quality") == 1) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("t")).distinct())


def trusted_sample(docs: DataFrame, labels: DataFrame, max_docs: int, id_col: str = "doc_id",
                   lang_col: str = "lang") -> DataFrame:
    """At most ``max_docs`` documents labelled good, by the order of a hash of their ids.

    Half the sample is dealt to the languages (null is one) alike, as far as they have so many, the
    rest by what they have left, so that a rare language has its share at any size.
    """
    good = store(docs.select(F.col(id_col).cast("long").alias("t"), F.col(lang_col).alias("lang"))
                 .join(trusted_ids(labels, id_col).hint("merge"), "t").groupBy("t").agg(F.min("lang").alias("lang")), "good")
    counts = good.groupBy(F.col("lang").alias("l")).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    alike = F.least("n", F.floor(F.lit(max_docs // 2) / F.count(F.lit(1)).over(everything)))
    counts = counts.withColumn("total", F.sum("n").over(everything)).withColumn("alike", alike.cast("long"))
    rest = (max_docs - F.sum("alike").over(everything)) / F.greatest(F.sum(F.col("n") - F.col("alike")).over(everything), F.lit(1))
    quota = F.when(F.col("total") <= max_docs, F.col("n")).otherwise(
        F.col("alike") + F.floor((F.col("n") - F.col("alike")) * rest))
    # few more than the quota by a bound on the hash, so that no task ranks all documents of a language
    quotas = store(counts.withColumn("quota", quota.cast("long")).select(
        "l", "quota", ((F.col("quota") + 8 * F.sqrt("quota") + 40) / F.col("n")).alias("share")), "quotas")
    u = F.shiftrightunsigned(F.xxhash64("t"), 11) * 2.0 ** -53
    some = good.join(F.broadcast(quotas), F.col("lang").eqNullSafe(F.col("l"))).where(u < F.col("share"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(u, "t"))
    ids = store(some.withColumn("rank", rank).where(F.col("rank") <= F.col("quota")).select("t"), "sample")
    return docs.join(F.broadcast(ids), F.col(id_col).cast("long") == F.col("t"), "left_semi")


def kneser_ney(counts: DataFrame, order: int) -> dict[int, tuple[DataFrame, DataFrame]]:
    """(gram, c) of the highest order -> per order: (gram, mass) and (context, weight).

    ``mass`` is the discounted share of a seen n-gram, ``weight`` what its context leaves
    to the next lower order, whose counts are numbers of distinct left neighbours.
    """
    out = {}
    for k in range(order, 0, -1):
        if k < order:
            counts = store(counts.groupBy(F.col("gram").bitwiseAND((1 << 8 * k) - 1).alias("gram"))
                           .agg(F.count(F.lit(1)).alias("c")), f"counts{k}")
        t = counts.agg(*[F.count(F.when(F.col("c") == i, 1)).alias(f"t{i}") for i in (1, 2, 3, 4)]).first()
        y = t.t1 / (t.t1 + 2 * t.t2) if t.t1 else 0.5
        d = [min(float(i), max(0.0, i - (i + 1) * y * b / a)) if a and b else 0.5
             for i, a, b in ((1, t.t1, t.t2), (2, t.t2, t.t3), (3, t.t3, t.t4))]
        cut = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        rows = counts.withColumn("context", F.shiftright("gram", 8)).withColumn("cut", cut)
        contexts = store(rows.groupBy("context").agg(F.sum("c").alias("total"),
                                                     (F.sum("cut") / F.sum("c")).alias("weight")), f"contexts{k}")
        seen = rows.join(contexts, "context").select("gram", ((F.col("c") - F.col("cut")) / F.col("total")).alias("mass"))
        out[k] = store(seen, f"mass{k}"), contexts.select("context", "weight")
    return out


def gram_scores(wanted: DataFrame, model: dict, order: int, alphabet: int = 256) -> DataFrame:
    """(gram, logp): log10 of the interpolated probability of each wanted n-gram's last byte."""
    p = F.lit(1.0 / alphabet)
    out = wanted
    for k in range(1, order + 1):
        mass, contexts = model[k]
        out = (out.join(mass.select(F.col("gram").alias("g"), F.col("mass").alias(f"m{k}")),
                        F.col("gram").bitwiseAND((1 << 8 * k) - 1) == F.col("g"), "left").drop("g")
               .join(contexts.select(F.col("context").alias("x"), F.col("weight").alias(f"w{k}")),
                     F.shiftright(F.col("gram").bitwiseAND((1 << 8 * k) - 1), 8) == F.col("x"), "left").drop("x"))
        p = F.coalesce(f"m{k}", F.lit(0.0)) + F.coalesce(f"w{k}", F.lit(1.0)) * p
    return out.select("gram", F.log10(p).alias("logp"))


def _distinct_grams(order: int):
    def run(batches):
        for b in batches:
            texts = b.column(0).to_pylist()
            for lo, hi in in_steps(texts, RUN_DOCS, RUN_CHARS):
                u, n = np.unique(grams(texts[lo:hi], order)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(u.astype(np.int64)), pa.array(n)], ["gram", "c"])
    return light(run)


def perplexities(docs: DataFrame, model: dict, order: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, logp) per row: number of n-grams and sum of their log10 probabilities."""
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    corpus = (docs.select(text_col).mapInArrow(_distinct_grams(order), "gram long, c long")
              .select("gram").distinct())
    scores = gram_scores(store(corpus, "grams"), model, order).withColumn(
        "shard", F.pmod("gram", F.lit(shards)).cast("int"))
    columns = ["run", "shard", "data", "ids", "n"]

    def send(batches):
        part, run = TaskContext.get().partitionId(), -1
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in in_steps(texts, RUN_DOCS, RUN_CHARS):
                run += 1
                gram, doc = grams(texts[lo:hi], order)
                n = np.bincount(doc, minlength=hi - lo)
                key = gram.astype(np.uint64) << np.uint64(13)
                key |= doc
                del gram, doc
                key.sort()
                first = np.flatnonzero(np.diff(key, prepend=~key[:1]))
                count = np.diff(np.append(first, len(key))).astype(np.uint32)
                key = key[first]
                shard = ((key >> np.uint64(13)) % np.uint64(shards)).astype(np.uint32)
                order_ = np.argsort(shard, kind="stable")
                cut = np.searchsorted(shard[order_], np.arange(shards + 1))
                key, count = key[order_], count[order_]
                del first, shard, order_
                gram, doc = key >> np.uint64(13), (key & np.uint64(8191)).astype("<u2")
                data = []
                for a, z in zip(cut[:-1], cut[1:], strict=True):
                    first = np.flatnonzero(np.diff(gram[a:z], prepend=np.uint64(2 ** 64 - 1)))
                    u = gram[a:z][first].astype("<u8")
                    per = np.diff(np.append(first, z - a)).astype("<u4")
                    gap = np.diff(doc[a:z], prepend=np.uint16(0)).astype("<u2")     # wraps where a gram begins
                    small = np.minimum(count[a:z], 255).astype(np.uint8)
                    big = count[a:z][small == 255].astype("<u4")
                    head = np.array([len(u), z - a, len(big)], "<u4").tobytes()
                    body = np.diff(u, prepend=np.uint64(0)).tobytes() + per.tobytes() + gap.tobytes()
                    data.append(zlib.compress(head + body + small.tobytes() + big.tobytes(), 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 32) + run] * shards, pa.int64()), pa.array(range(shards), pa.int32()),
                     pa.array(data, pa.binary()), pa.array([ids[lo:hi], *[None] * (shards - 1)], pa.list_(pa.int64())),
                     pa.array([n, *[None] * (shards - 1)], pa.list_(pa.int64()))], columns)

    sent = docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(
        light(send), "run long, shard int, data binary, ids array<long>, n array<long>")

    def look_up(messages: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        at = np.argsort(known["gram"].to_numpy())
        names, logp = known["gram"].to_numpy()[at].view(np.uint64), known["logp"].to_numpy()[at]
        sums = []
        for raw in messages["data"]:
            raw = zlib.decompress(raw)
            k, m, big = np.frombuffer(raw[:12], "<u4").tolist()
            u = np.cumsum(np.frombuffer(raw, "<u8", k, 12), dtype=np.uint64)
            per = np.frombuffer(raw, "<u4", k, 12 + 8 * k)
            doc = np.cumsum(np.frombuffer(raw, "<u2", m, 12 + 12 * k), dtype=np.uint16)
            count = np.frombuffer(raw, np.uint8, m, 12 + 12 * k + 2 * m).astype(np.float64)
            count[count == 255] = np.frombuffer(raw, "<u4", big, 12 + 12 * k + 3 * m)
            each = np.repeat(logp[np.searchsorted(names, u)], per) if k else np.zeros(0)
            sums.append(np.bincount(doc, weights=each * count).astype("<f8").tobytes())
        del at, names, logp
        release()                                       # a group is a shard, so this is seldom
        return messages.assign(data=sums)[["run", "shard", "data", "ids", "n"]]

    partial = sent.groupBy("shard").cogroup(scores.select("shard", "gram", "logp").groupBy("shard")).applyInPandas(
        look_up, "run long, shard int, data binary, ids array<long>, n array<long>")

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard")
        own = pdf[pdf["shard"] == 0].iloc[0]
        total = np.zeros(len(own["n"]))
        for raw in pdf["data"]:
            s = np.frombuffer(raw, "<f8")
            total[:len(s)] += s
        return pd.DataFrame({"id": pd.array(list(own["ids"]), dtype="Int64"), "n": own["n"], "logp": total})

    return partial.groupBy("run").applyInPandas(add_up, "id long, n long, logp double")


def classify_quality(docs: DataFrame, labels: DataFrame, order: int = 4, max_train_docs: int = 20_000,
                     quantile: float = 0.995, slack: float = 1.1, prior: int = 60, id_col: str = "doc_id",
                     text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, lang, n_grams, perplexity, threshold, kept.

    ``max_train_docs`` bounds the sample of labelled documents the model is fitted on; means
    and thresholds come from all documents labelled good, by language.  Perplexity is per byte, with ``prior`` bytes
    at the language's mean added, so that a few words aren't judged by chance.  Kept
    without a judgement: texts without words (null ones too), and languages (null is one)
    without a trusted document.  Rows that repeat an id share the mean of their
    sums.  Other columns aren't read; empty tables give no rows, or keep all.
    """
    if not 1 <= order <= 6:
        raise ValueError("an n-gram and a document number share 64 bits: order is 1 to 6")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    labels = labels.select(F.col(id_col).alias("id"), "quality")
    trusted = store(trusted_sample(own, labels, max_train_docs, "id"), "trusted")
    counts = store(trusted.select("text").mapInArrow(_distinct_grams(order), "gram long, c long")
                   .groupBy("gram").agg(F.sum("c").alias("c")), "counts")
    model = kneser_ney(counts, order)
    sums = store(perplexities(own, model, order, "id", "text"), "sums")
    sums = sums.groupBy("id").agg(F.avg("n").alias("n"), F.avg("logp").alias("logp"))
    meta = own.select("id", "lang")
    scored = store(meta.join(sums.withColumnRenamed("id", "sid"), F.col("id").eqNullSafe(F.col("sid"))).drop("sid"), "scored")
    good = trusted_ids(labels, "id").hint("merge")
    good = store(scored.where("n > 0").join(good, F.col("id") == F.col("t"), "left_semi"), "good-scores")
    mean = store(good.groupBy(F.col("lang").alias("l")).agg((F.sum("logp") / F.sum("n")).alias("mean")), "means")
    bits = -(F.col("logp") + prior * F.col("mean")) / (F.col("n") + prior)
    with_mean = good.join(mean, F.col("lang").eqNullSafe(F.col("l")))
    limit = store(with_mean.withColumn("bits", bits).groupBy("l", "mean").agg(
        F.percentile_approx("bits", quantile, 10000).alias("limit")), "limits")
    out = scored.join(limit, F.col("lang").eqNullSafe(F.col("l")), "left")
    perplexity = F.pow(F.lit(10.0), F.when(F.col("mean").isNull(), -F.col("logp") / F.col("n")).otherwise(bits))
    perplexity = F.when(F.col("n") > 0, perplexity)
    threshold = F.pow(F.lit(10.0), "limit") * slack
    return out.select(
        F.col("id").alias(id_col), F.col("lang").alias(lang_col), F.col("n").cast("long").alias("n_grams"),
        perplexity.alias("perplexity"), threshold.alias("threshold"),
        F.coalesce(perplexity <= threshold, F.lit(True)).alias("kept"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """``docs`` without the documents that ``classify_quality`` rejects."""
    bad = store(classify_quality(docs, labels, id_col=id_col, **kw).where(~F.col("kept"))
                .select(F.col(id_col).alias("__bad")).distinct(), "rejected")
    return docs.join(bad, F.col(id_col).cast("long") == F.col("__bad"), "left_anti")
