"""Near-duplicate lines by a deletion-neighbourhood join, keeping the earliest.

DataFrame functions only.  A line is its words in lower case; two lines match
when at most one word is inserted, deleted or replaced between them.  Lines
under ``min_words`` words match equal lines only.

* Equal lines are folded first, so a line that fills the corpus is one class.
* With one edit, the words before or the words after the middle are untouched:
  classes that share neither half with any other can have no match.  The rest
  emit their deletion neighbourhood as hashed keys: the line without its p-th
  word, once with p and the length (equal keys: one word replaced) and once
  without (equal to a whole line: one word inserted or deleted).  Only places in
  the half that is not shared are emitted.
* Lines that miss the same place of the same length all match, so each is
  compared with the earliest one only (a star).  Lines that miss any place match
  the key's whole line, but not each other: they are compared with that line,
  and it with the earliest of them.  So no match is lost.  Each kind's find is
  verified on the words themselves, then the earliest that passes is taken.

A line is dropped when any earlier line (by document id, then line number)
matches it, whether that one stays or not.  Keys are XORs of the hashes of
(place, word), so a line of n words costs n hashes, not n².
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortia.llm.scratch import store

OTHER_SPACE = "\t\x0b\x0c\r"
REPLACED, REMOVED, WHOLE = 0, 1, 2      # kinds of keys


def _lines(text: Column) -> Column:
    """Lines in lower case with plain blanks; the costly calls run only where they change something."""
    low = F.lower(text)
    odd = F.contains(low, F.lit("\t")) | F.contains(low, F.lit("\r")) | \
        F.contains(low, F.lit("\x0b")) | F.contains(low, F.lit("\x0c"))
    return F.split(F.when(odd, F.translate(low, OTHER_SPACE, " " * 4)).otherwise(low), "\n")


def _norm(line: Column) -> Column:
    """Words of a line of ``_lines``, one blank between them."""
    line = F.trim(line)
    return F.when(F.contains(line, F.lit("  ")), F.regexp_replace(line, " +", " ")).otherwise(line)


def _n_words(norm: Column) -> Column:
    return F.when(norm == "", 0).otherwise(F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit(""))) + 1)


def _head_size(c: Column) -> Column:
    """Words before the middle when the longer line has ``c`` words."""
    return F.floor((c - 1) / 2).cast("int")


def within_one_edit(x: Column, y: Column) -> Column:
    """Whether two arrays of words differ by one word at most."""
    def same(a, i, b, j, n):
        return F.slice(a, i, n) == F.slice(b, j, n)

    n, m = F.size(x), F.size(y)
    longer, shorter = F.when(n >= m, x).otherwise(y), F.when(n >= m, y).otherwise(x)
    size, less = F.greatest(n, m), F.least(n, m)
    # the first place where they differ, 0 if the shorter one is a prefix
    diff = F.coalesce(F.array_position(F.zip_with(F.slice(longer, 1, less), shorter, lambda a, b: a != b), True),
                      F.lit(0)).cast("int")
    replaced = same(longer, diff + 1, shorter, diff + 1, F.greatest(less - diff, F.lit(0)))
    removed = same(longer, diff + 1, shorter, diff, F.greatest(less - diff + 1, F.lit(0)))
    return F.when(size - less > 1, False).when(diff == 0, True).when(size == less, replaced).otherwise(removed)


def repeated_lines(docs: DataFrame, min_words: int = 8, id_col: str = "doc_id", text_col: str = "text",
                   equal_words: int | None = None) -> DataFrame:
    """One row per line that an earlier one matches: id, text_hash, line, keep_id,
    keep_line, edits (0: equal words).

    Lines from ``min_words`` words on match within one edit, equal ones from ``equal_words``
    on (``min_words`` if None; 1: every line with words).
    Null and empty texts and lines have no words and are never dropped.  Rows
    that repeat an id and a text share their lines' places, so they don't drop each
    other; rows with one id and different texts are ordered by the texts' hashes; a
    null id comes first.  Other columns aren't read.
    """
    text = F.coalesce(text_col, F.lit(""))
    lines = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"),
                        F.posexplode(_lines(text)).alias("pos", "line"))
    lines = lines.select("id", "th", "pos", _norm(F.col("line")).alias("x")).withColumn("n", _n_words(F.col("x")))
    long = F.col("n") >= min_words
    lines = lines.where(long if equal_words is None else long | (F.col("n") >= max(1, equal_words)))

    def half(c, side, part):
        return F.when(long, F.xxhash64(F.lit(side), c, part))

    n, more = F.col("n"), F.col("n") + 1
    h, hm = _head_size(n), _head_size(more)
    occurrences = store(lines.select(
        F.struct("id", "th", "pos").alias("at"), F.xxhash64("x").alias("k"),
        F.xxhash64(F.lit("2"), "x").alias("k2"), "n",
        half(n, "head", _first_words("x", h)).alias("a"),
        half(n, "tail", _last_words("x", n - 1 - h)).alias("b"),
        half(more, "head", _first_words("x", hm)).alias("c"),
        half(more, "tail", _last_words("x", n - hm)).alias("d")), "lines")
    classes = store(occurrences.groupBy("k", "k2").agg(
        F.min("at").alias("first"), F.max("n").alias("n"),
        *[F.max(x).alias(x) for x in "abcd"]), "classes")

    # Halves that two classes share; short lines have none.
    halves = classes.where(long).select("k", F.explode(F.array(*[
        F.struct(F.col(x).alias("half"), F.lit(1 << i).alias("which")) for i, x in enumerate("abcd")])).alias("h")) \
        .select("k", "h.half", "h.which")
    shared = store(halves.groupBy("half").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
                   .where("lo <> hi").select("half"), "halves")
    open_ = (halves.join(shared, "half").groupBy("k")
             .agg(F.bit_or("which").alias("open")))
    open_ = store(classes.join(open_, "k").select("k", "k2", "first", "n", "open"), "open")

    # Their words, read again at the first occurrence.
    places = store(open_.groupBy(F.col("first.id").alias("pid"), F.col("first.th").alias("pth"))
                   .agg(F.collect_list(F.struct(F.col("first.pos").alias("pos"), "k", "k2", "n", "open", "first"))
                        .alias("places")), "places")
    found = (docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("th"))
             .join(places, F.col("id").eqNullSafe(F.col("pid")) & (F.col("th") == F.col("pth")))
             .select(_lines(F.col("text")).alias("lines"), F.explode("places").alias("p"))
             .select(F.split(_norm(F.col("lines")[F.col("p.pos")]), " ").alias("words"), "p.*")
             .dropDuplicates(["k", "k2"]))
    found = store(found, "words")

    each = found.select("k", "first", "n", "open", F.posexplode("words").alias("i", "w"))
    line = Window.partitionBy("k", "first")
    upto = line.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = (each.withColumn("own", F.xxhash64("i", "w")).withColumn("left", F.xxhash64(F.col("i") - 1, "w"))
            .withColumn("all", F.bit_xor("own").over(line)).withColumn("all_left", F.bit_xor("left").over(line))
            .withColumn("to", F.bit_xor("own").over(upto)).withColumn("to_left", F.bit_xor("left").over(upto)))
    without = F.col("all").bitwiseXOR(F.col("own"))                     # later words keep their places
    removed = (F.col("to").bitwiseXOR(F.col("own"))                     # later words move up
               .bitwiseXOR(F.col("all_left").bitwiseXOR(F.col("to_left"))))
    head, has = _head_size(F.col("n")), lambda bit: F.col("open").bitwiseAND(bit) != 0
    here = (has(1) & (F.col("i") >= head)) | (has(2) & (F.col("i") <= head))

    def key(kind, *parts):
        return F.struct(F.xxhash64(*parts).alias("key"), F.lit(kind).alias("kind"))

    keys = F.array_compact(F.array(
        F.when(here, key(REPLACED, F.lit("replaced"), "n", "i", without)),
        F.when(here, key(REMOVED, F.lit("removed"), F.col("n") - 1, removed)),
        F.when((has(4) | has(8)) & (F.col("i") == 0), key(WHOLE, F.lit("removed"), "n", F.col("all")))))
    variants = store(each.select("k", "first", F.explode(keys).alias("v")).select("k", "first", "v.key", "v.kind"),
                     "variants")
    member, kind = F.struct("first", "k"), F.col("kind")
    # lines that miss any place only have the whole line in common
    hubs = (variants.groupBy("key").agg(
        *[F.min(F.when(kind == x, member)).alias(c) for x, c in ((REPLACED, "replaced"), (REMOVED, "removed"), (WHOLE, "line"))],
        F.min("k").alias("lo"), F.max("k").alias("hi"))
        .where("lo <> hi and (replaced is not null or line is not null)").drop("lo", "hi"))
    met = variants.join(store(hubs, "hubs"), "key")
    hub = F.when(kind == REPLACED, F.col("replaced")).when(kind == REMOVED, F.col("line")).otherwise(F.col("removed"))
    near = (met.withColumn("hub", hub).where(F.col("hub.first") < F.col("first"))
            .groupBy("k", "first", "kind").agg(F.min("hub").alias("hub")))
    words = found.select(F.col("k").alias("wk"), F.col("first").alias("wf"), "words")
    near = near.join(words, (F.col("k") == F.col("wk")) & (F.col("first") == F.col("wf"))).drop("wk", "wf") \
        .withColumnRenamed("words", "own_words")
    near = near.join(words, (F.col("hub.k") == F.col("wk")) & (F.col("hub.first") == F.col("wf")))
    near = store(near.where(within_one_edit(F.col("own_words"), F.col("words")))
                 .groupBy(F.col("k").alias("nk"), F.col("first").alias("nf")).agg(F.min("hub.first").alias("near")), "near")
    verdicts = classes.select("k", "k2", "first").join(
        near, (F.col("k") == F.col("nk")) & (F.col("first") == F.col("nf")), "left")
    verdicts = store(verdicts.select(F.col("k").alias("vk"), F.col("k2").alias("vk2"), "first", "near"), "verdicts")
    out = occurrences.select("at", "k", "k2").join(
        verdicts, (F.col("k") == F.col("vk")) & (F.col("k2") == F.col("vk2")))
    out = out.where((F.col("at") != F.col("first")) | F.col("near").isNotNull())
    equal = F.col("at") != F.col("first")
    keep = F.when(equal, F.col("first")).otherwise(F.col("near"))
    return out.select(F.col("at.id").alias(id_col), F.col("at.th").alias("text_hash"), F.col("at.pos").alias("line"),
                      keep["id"].alias("keep_id"), keep["pos"].alias("keep_line"),
                      F.when(equal, 0).otherwise(1).alias("edits")).distinct()


def _first_words(norm: str, n: Column) -> Column:
    return F.call_function("substring_index", F.col(norm), F.lit(" "), n)


def _last_words(norm: str, n: Column) -> Column:
    return F.call_function("substring_index", F.col(norm), F.lit(" "), -n)


def drop_repeated_lines(docs: DataFrame, min_words: int = 8, id_col: str = "doc_id",
                        text_col: str = "text", equal_words: int | None = 1) -> DataFrame:
    """``docs`` with the lines of ``repeated_lines`` taken out of their texts, equal ones of every length.

    Documents that lose every line with words are left out: all they say is in
    earlier ones.  Documents that lose none pass unchanged, null and empty ones too.
    """
    drops = (repeated_lines(docs, min_words, id_col, text_col, equal_words)
             .groupBy(F.col(id_col).alias("__id"), F.col("text_hash").alias("__th"))
             .agg(F.collect_set("line").alias("__drop")))
    drops = store(drops, "drops")
    out = docs.join(drops, F.col(id_col).eqNullSafe(F.col("__id"))
                    & (F.xxhash64(F.coalesce(text_col, F.lit(""))) == F.col("__th")), "left")
    kept = F.array_join(F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains(F.col("__drop"), i)), "\n")
    out = out.withColumn("__text", F.when(F.col("__drop").isNull(), F.col(text_col)).otherwise(kept))
    out = out.where(F.col("__drop").isNull() | F.col("__text").rlike(r"[^\x20\x09-\x0D]"))
    return out.select(*[F.col("__text").alias(c) if c == text_col else F.col(c) for c in docs.columns])
