"""Mixing sources to target weights with a multivariate-hypergeometric tree.

DataFrame functions only.  Each source gets a target in words: its weight's
share of all words, at most ``cap`` times what it has, the excess shared among the
rest (water filling over the sources, closed form).  A source's documents are
put in a random order per pass; whole passes are taken, and of the next one the
documents in its order up to the first that doesn't fit.  What is missing then, less
than that document, is filled from the longest documents that fit downwards; at last
comes a document that goes over the target by less than is missing without it.
The order's words are cut into blocks.  A binary tree divides the exact block
counts of all sources among the output shards, each node drawing from the
multivariate hypergeometric distribution, so a shard's composition is that of
a uniform shuffle of all blocks.  Each shard then takes the next disjoint range
of every source's blocks and shuffles its own rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortia.llm.scratch import store

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 512
SHARD_WORDS = 1 << 25       # words of the mix that a shard is meant to hold, some 200 MB of text


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights by code-point order of ``source``, null last, repeating."""
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(rank - 1, F.lit(len(weights))) + 1)
    return sources.withColumn("weight", pick.cast("long"))


def targets(sources: DataFrame, cap: int) -> DataFrame:
    """(source, source_size, weight) -> with ``target``.

    Ordered by cap·size/weight, a source is capped as long as the level that the
    others would reach is above its own; the first that isn't sets the level.
    """
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = (F.sum("source_size").over(everything)
            - F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0)))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    x = sources.withColumn("level", left / weight)
    x = x.withColumn("fits", F.col("level") * F.col("weight") <= F.col("source_size") * cap)
    level = F.min(F.when(F.col("fits"), F.struct(F.col("source_size") / F.col("weight"),
                                                 F.col("source").isNull(), "source", "level"))).over(everything)
    return (x.withColumn("water", level["level"])
            .withColumn("target", F.least(F.col("water") * F.col("weight"),
                                          (F.col("source_size") * cap).cast("double")))
            .drop("level", "fits", "water"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Marked items among ``drawn`` of ``total``, of which ``marked`` are marked, from a
    uniform ``u``: inverse distribution function, summed outwards from the mode to
    where the terms vanish in double precision (40 standard deviations)."""
    def draw(a):
        n, k, d = a["n"], a["k"], a["d"]
        mode = F.floor((d + 1).cast("double") * (k + 1) / (n + 2)).cast("long")
        p = k / F.greatest(n, F.lit(1))
        sd = F.sqrt(d * p * (1 - p) * (n - d) / F.greatest(n - 1, F.lit(1)))
        reach = F.ceil(sd * 40 + 40).cast("long")
        lo = F.greatest(F.lit(0), d + k - n, mode - reach)
        hi = F.least(d, k, mode + reach)
        return F.struct(n.alias("n"), k.alias("k"), d.alias("d"), a["u"].alias("u"),
                        F.least(F.greatest(mode, lo), hi).alias("m"), lo.alias("lo"), hi.alias("hi"))

    def rise(a, x, w):      # term of x+1 from that of x
        return w * (a["k"] - x) * (a["d"] - x) / ((x + 1).cast("double") * (a["n"] - a["k"] - a["d"] + x + 1))

    def fall(a, x, w):      # term of x-1 from that of x
        return w * x * (a["n"] - a["k"] - a["d"] + x) / ((a["k"] - x + 1).cast("double") * (a["d"] - x + 1))

    def steps(count):
        return F.when(count > 0, F.sequence(F.lit(1).cast("long"), count)).otherwise(
            F.array().cast("array<bigint>"))

    def pick(a):
        up, down = steps(a["hi"] - a["m"]), steps(a["m"] - a["lo"])

        def fold(goal):
            start = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"),
                             F.when(goal <= 1.0, a["m"]).alias("at"))

            def go(seq, init, term, sign):
                def one(s, j):
                    x = a["m"] + sign * (j - 1)
                    return _let(term(a, x, s["w"]), lambda w: F.struct(
                        w.alias("w"), (s["sum"] + w).alias("sum"),
                        F.coalesce(s["at"], F.when(s["sum"] + w >= goal, x + sign)).alias("at")))
                return F.aggregate(seq, init, one)

            return _let(go(up, start, rise, 1), lambda s: go(
                down, F.struct(F.lit(1.0).alias("w"), s["sum"].alias("sum"), s["at"].alias("at")), fall, -1))

        # the first fold gives the sum of all terms, the second finds u's place in it
        return _let(fold(F.lit(float("inf")))["sum"], lambda s: F.coalesce(fold(s * a["u"])["at"], a["m"]))

    long = lambda c: c.cast("long")
    first = F.struct(long(total).alias("n"), long(marked).alias("k"), long(drawn).alias("d"), u.alias("u"))
    return _let(_let(first, draw), pick)


def splitting_tree(blocks: DataFrame, depth: int, seed: int) -> DataFrame:
    """(source, n_blocks) -> (source, shard, low, high): block ranges of 2**depth shards."""
    root = blocks.agg(F.array_sort(F.collect_list(F.struct("source", F.col("n_blocks").alias("k")))).alias("ks"))
    nodes = root.select(F.lit(0).cast("long").alias("node"), "ks")
    for level in range(depth):
        if level == 10:
            nodes = nodes.repartition("node")           # a thousand nodes: the rest of the tree is many tasks' work

        def fold(s, x):
            u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(level), F.col("node"), x["source"]), 11) * 2.0 ** -53
            return _let(hypergeometric(s["n"], x["k"], s["d"], u), lambda got: F.struct(
                (s["n"] - x["k"]).alias("n"), (s["d"] - got).alias("d"), F.concat(s["out"], F.array(got)).alias("out")))

        total = F.aggregate("ks", F.lit(0).cast("long"), lambda s, x: s + x["k"])
        start = _let(total, lambda n: F.struct(
            n.alias("n"), F.floor((n + 1) / 2).cast("long").alias("d"), F.array().cast("array<bigint>").alias("out")))
        nodes = nodes.withColumn("left", F.aggregate("ks", start, fold)["out"])
        child = [F.struct((F.col("node") * 2 + side).alias("node"), F.zip_with(
            "ks", "left", (lambda x, got: F.struct(x["source"].alias("source"), (x["k"] - got).alias("k"))) if side else
            (lambda x, got: F.struct(x["source"].alias("source"), got.alias("k")))).alias("ks")) for side in (0, 1)]
        nodes = nodes.select(F.explode(F.array(*child)).alias("c")).select("c.*")
    each = nodes.select(F.col("node").alias("shard"), F.explode("ks").alias("x")).select("shard", "x.*")
    high = F.sum("k").over(Window.partitionBy("source").orderBy("shard"))
    return each.select("source", "shard", (high - F.col("k")).alias("low"), high.alias("high")).where("high > low")


def shard_depth_of(words: float, shard_words: int = SHARD_WORDS) -> int:
    """Depth of the tree: its 2**depth shards, 16 at least, hold at most ``shard_words`` of the mix on average."""
    return max(4, math.ceil(math.log2(max(1.0, words / shard_words))))


def range_starts(sums: DataFrame, keys: list[str], length: int, head: int) -> DataFrame:
    """(keys, bucket, sum) -> with ``before``, the sum of the smaller buckets of the same keys.

    Buckets are strings of ``length``: a head and hex digits.  Three digits a level, so
    that no window holds more than 4,096 rows for each head, however many buckets there are.
    """
    def start(*part):
        rows = Window.partitionBy(*part).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("sum").over(rows), F.lit(0))

    if length <= head + 3:
        return sums.withColumn("before", start(*keys))
    sums = sums.withColumn("upper", F.substring("bucket", 1, length - 3))
    above = range_starts(sums.groupBy(*keys, F.col("upper").alias("bucket")).agg(F.sum("sum").alias("sum")),
                         keys, length - 3, head)
    above = above.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("bucket").alias("__upper"),
                         F.col("before").alias("__before"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], F.col("upper") == F.col("__upper"))
    inner = sums.withColumn("before", start(*keys, "upper"))
    return (inner.join(above, same).withColumn("before", F.col("before") + F.col("__before"))
            .select(*keys, "bucket", "sum", "before"))


def fill_by_size(left: DataFrame, gaps: DataFrame) -> DataFrame | None:
    """How many documents of each size go into the gaps: (s, w, take, base), None if there are none.

    ``left``: (source, words) of what isn't taken; ``gaps``: (s, have, gap).  From the
    longest size that fits downwards, as many of each as fit; ``base`` is the words taken
    before it.  A round takes sizes whole up to one that doesn't fit whole and of that one
    what fits; less than half of the gap is missing afterwards, so there are at most as
    many rounds as the longest document's length has binary digits.  Only counts by size
    are looked at, and only sizes below the gap, which the longest document bounds.
    """
    sizes = store(left.join(gaps, F.col("source").eqNullSafe(F.col("s"))).where("words <= gap")
                  .groupBy("source", F.col("words").alias("w")).agg(F.count(F.lit(1)).alias("n")), "left-sizes")
    gaps = gaps.withColumn("below", F.col("gap") + 1)
    whole = F.col("w") * F.col("n")
    down = Window.partitionBy("source").orderBy(F.col("w").desc()).rowsBetween(Window.unboundedPreceding, -1)
    takes = []
    while True:
        found = (sizes.join(gaps, F.col("source").eqNullSafe(F.col("s"))).where("w <= gap and w < below")
                 .withColumn("before", F.coalesce(F.sum(whole).over(down), F.lit(0)))
                 .where(F.col("before") < F.col("gap"))
                 .withColumn("take", F.least("n", F.floor((F.col("gap") - F.col("before")) / F.col("w"))).cast("long")))
        found = store(found, "found")
        if found.isEmpty():
            return reduce(DataFrame.unionByName, takes) if takes else None
        takes.append(found.where("take > 0").select("s", "w", "take", (F.col("have") + F.col("before")).alias("base")))
        got = F.sum(F.col("w") * F.col("take"))
        gaps = (found.groupBy("s", "have", "gap").agg(got.alias("got"), F.min(F.when(F.col("take") < F.col("n"), F.col("w")))
                                                      .alias("below"))
                .select("s", (F.col("have") + F.col("got")).alias("have"), (F.col("gap") - F.col("got")).alias("gap"),
                        "below").where("gap > 0 and below is not null"))


def mix_sources(docs: DataFrame, weigh=cyclic_weights, cap: int = 3, seed: int = 7, shard_words: int = SHARD_WORDS,
                block_words: int = 8192, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """One row per distinct (id, source, text): ``id``, ``source``, ``text_hash``, ``copies``,
    size, source_size, target, ``draws`` (array of (epoch, shard), one per time it is taken).

    ``weigh`` adds ``weight`` to (source, source_size).  Null texts and empty texts have
    size 0; a null source is a source of its own; rows that repeat an id, a source and a
    text share one draw, which counts all of them (``copies``).  An empty table gives no
    rows.  The number of shards follows the words of the mix
    (``shard_words``).  Documents aren't cut: what a source misses of its target is less than any
    document that it leaves out of the last pass, or half of that where one goes over it.
    """
    text = F.coalesce(text_col, F.lit(""))
    slim = store(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(text).alias("size"),
        F.xxhash64(text).alias("text_hash"))
        .groupBy("id", "source", "text_hash", "size").agg(F.count(F.lit(1)).alias("copies")), "sizes")
    words = F.col("size") * F.col("copies")
    sources = store(targets(weigh(slim.groupBy("source").agg(F.sum(words).alias("source_size"))), cap), "targets")
    depth = shard_depth_of(float(sources.agg(F.sum("target")).first()[0] or 0), shard_words)
    renamed = sources.withColumnRenamed("source", "s")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rows = (slim.join(renamed, F.col("source").eqNullSafe(F.col("s"))).drop("s")
            .withColumn("passes", passes)
            .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.least("passes", F.lit(cap - 1)))))
            .withColumn("words", words)
            .withColumn("o", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"),
                                               F.coalesce(F.col("id").cast("string"), F.lit("-")),
                                               F.col("size").cast("string")).cast("binary"))))
    # Running words: totals of hash ranges first, then inside each range.
    n = slim.count()
    digits = max(0, math.ceil(math.log(max(1, n / BUCKET_ROWS), 16)))
    wide = len(str(cap))
    rows = rows.withColumn("bucket", F.concat(F.lpad(F.col("epoch").cast("string"), wide, "0"),
                                              F.substring("o", 1, digits)))
    before = store(range_starts(rows.groupBy("source", "bucket").agg(F.sum("words").alias("sum")), ["source"],
                                wide + digits, wide).select(F.col("source").alias("s"), F.col("bucket").alias("b"),
                                                            "before"), "ranges")
    inside = Window.partitionBy("source", "bucket").orderBy("o", "text_hash", "id")
    running = F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = (rows.withColumn("inside", running)
            .join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).drop("s", "b")
            .withColumn("upto", F.col("before") + F.col("inside")).drop("before", "inside")
            .withColumn("taken", (F.col("epoch") < F.col("passes")) | (F.col("upto") <= F.col("target"))))
    rows = store(rows, "order")

    def same_row():
        return (F.col("source").eqNullSafe(F.col("s")) & (F.col("text_hash") == F.col("fhash"))
                & F.col("id").eqNullSafe(F.col("fid")) & (F.col("epoch") == F.col("fepoch")))

    gaps = rows.groupBy("source", "target").agg(F.coalesce(F.sum(F.when(F.col("taken"), F.col("words"))),
                                                           F.lit(0)).alias("have"))
    gaps = store(gaps.select(F.col("source").alias("s"), "have", (F.col("target") - F.col("have")).alias("gap"))
                 .where("gap > 0"), "gaps")
    left = rows.where(~F.col("taken") & (F.col("words") > 0))
    takes = fill_by_size(left, gaps)
    if takes is not None:
        ranks = (left.join(takes, F.col("source").eqNullSafe(F.col("s")) & (F.col("words") == F.col("w"))).drop("s", "w"))
        starts = range_starts(ranks.groupBy("source", "words", "bucket").agg(F.count(F.lit(1)).alias("sum")),
                              ["source", "words"], wide + digits, wide)
        starts = starts.select(F.col("source").alias("s"), F.col("words").alias("w"), F.col("bucket").alias("b"), "before")
        same_size = Window.partitionBy("source", "words", "bucket").orderBy("o", "text_hash", "id")
        filled = (ranks.withColumn("rank", F.row_number().over(same_size))
                  .join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("words") == F.col("w"))
                        & (F.col("bucket") == F.col("b")))
                  .withColumn("rank", F.col("rank") + F.col("before")).where("rank <= take")
                  .select("s", F.col("epoch").alias("fepoch"), F.col("text_hash").alias("fhash"), F.col("id").alias("fid"),
                          (F.col("base") + F.col("rank") * F.col("words")).alias("fupto")))
        rows = (rows.join(store(filled, "fills"), same_row(), "left")
                .withColumn("taken", F.col("taken") | F.col("fepoch").isNotNull())
                .withColumn("upto", F.coalesce("fupto", "upto")).drop("s", "fid", "fhash", "fepoch", "fupto"))
        rows = store(rows, "filled")
    # Nothing fits any more: the smallest one that goes over the target, if that is nearer.
    gaps = store(rows.groupBy("source", "target").agg(F.sum(F.when(F.col("taken"), F.col("words"))).alias("have"))
                 .select(F.col("source").alias("s"),
                         (F.col("target") - F.coalesce("have", F.lit(0))).alias("gap")), "gaps")
    miss = F.abs(F.col("words") - F.col("gap"))
    fill = (rows.where(~F.col("taken")).join(gaps, F.col("source").eqNullSafe(F.col("s")))
            .where(miss < F.col("gap"))
            .groupBy("source").agg(F.min(F.struct(miss, "o", "text_hash", "id", "epoch")).alias("x")))
    fill = store(fill.select(F.col("source").alias("s"), F.col("x.id").alias("fid"),
                             F.col("x.text_hash").alias("fhash"), F.col("x.epoch").alias("fepoch")), "fill")
    rows = (rows.join(fill, same_row(), "left")
            .withColumn("taken", F.col("taken") | F.col("fepoch").isNotNull())
            .drop("s", "fid", "fhash", "fepoch"))
    # a document over the target goes to the source's last block
    block = F.floor(F.least((F.col("upto") - F.col("words")).cast("double"),
                            F.greatest(F.col("target") - 1, F.lit(0.0))) / block_words).cast("long")
    rows = rows.withColumn("block", block)
    blocks = rows.where("taken").groupBy("source").agg((F.max("block") + 1).alias("n_blocks"))
    ranges = splitting_tree(blocks, depth, seed)
    places = store(ranges.select(F.col("source").alias("s"), "shard",
                                 F.explode(F.sequence(F.col("low"), F.col("high") - 1)).alias("b")), "blocks")
    placed = rows.join(places, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left")
    draw = F.when(F.col("taken"), F.struct("epoch", F.coalesce("shard", F.lit(0).cast("long")).alias("shard")))
    return (placed.groupBy("id", "source", "text_hash", "copies", "size", "source_size", "target")
            .agg(F.array_sort(F.collect_list(draw)).alias("draws")))


def mixed_documents(docs: DataFrame, seed: int = 7, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """The mix itself: ``docs``' own columns, a row for every time it is taken, dealt to the
    shards and shuffled inside each.  Rows that are not drawn are left out."""
    mix = store(mix_sources(docs, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col, **kw)
                .where(F.size("draws") > 0)
                .select(F.col("id").alias("__id"), F.col("source").alias("__source"),
                        F.col("text_hash").alias("__hash"), F.col("draws").alias("__draws")), "mix")
    shards = (mix.agg(F.max(F.array_max(F.col("__draws.shard")))).first()[0] or 0) + 1
    out = docs.join(mix, F.col(id_col).eqNullSafe(F.col("__id"))
                    & F.col(source_col).eqNullSafe(F.col("__source"))
                    & (F.xxhash64(F.coalesce(text_col, F.lit(""))) == F.col("__hash")))
    out = out.withColumn("__draw", F.explode("__draws"))
    order = F.xxhash64(F.lit(seed), F.col("__hash"), F.col("__id"), F.col("__draw.epoch"))
    return (out.repartition(shards, F.col("__draw.shard"))
            .sortWithinPartitions(F.col("__draw.shard"), order).select(*docs.columns))
