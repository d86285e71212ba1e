"""Spelling variants: words one edit apart, led to their most frequent neighbour.

An edit of one code point leaves the rest of a word alone.  So a word is sent, once
for every window of two code points, to the bucket of all words that agree with it
outside that window: words of its own length, and words one shorter, which lack a
code point there.  As 90 letters are possible, at most 90**2 + 90 distinct words share
a bucket, whatever the size of the table.

A task has its buckets sorted and lays them out as dense tiles: blocks of words as
matrices of code points padded with zeros, once from the front and once from the
back.  Block pairs are compared all at once; where common prefix plus common suffix
reach the longer length minus one, one edit parts the two words.  Small buckets share
a tile, large ones are cut into block pairs.  A pair counts only in the bucket whose
window holds its first difference, so it is found exactly once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.llm.scratch import store

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK, TILE_BYTES, ROWS = 128, 2_000_000, 100_000


def word_counts(docs: DataFrame, min_length: int = 5, min_count: int = 3, slip_every: int | None = 97,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of Latin letters of whole texts, A-Z lower-cased, and how often they occur.

    With ``slip_every``, a run whose crc32 of ``<id>:<run>`` it divides loses one code point, the
    one at that value modulo the length.  Null texts have no runs, a null id counts as empty.
    Runs under ``min_length`` can't give a word and are passed over while matching.
    """
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(
        F.coalesce(F.col(text_col), F.lit("")), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))).alias("run"))
    words = runs.select("id", F.translate("run", UPPER, LOWER).alias("word"))
    if slip_every:
        words = words.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")))
        at = (F.col("h") % F.length("word")).cast("int")
        slipped = F.concat(F.col("word").substr(F.lit(1), at), F.col("word").substr(at + 2, F.length("word")))
        words = words.select(F.when(F.col("h") % slip_every == 0, slipped).otherwise(F.col("word")).alias("word"))
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def _buckets(words: DataFrame) -> DataFrame:
    """(longer, window, key, word, n): a row for every window of the word and of words one longer."""
    def rows(longer: Column):
        step = F.greatest(F.lit(2), F.ceil(longer / 32)).cast("int")        # at most 32 windows for very long words

        def row(j: Column):
            after = longer - F.least((j + 1) * step, longer)
            rest = F.col("word").substr(F.length("word") - after + 1, after)
            return F.struct(longer.alias("longer"), j.alias("window"),
                            F.xxhash64(longer, j, F.col("word").substr(F.lit(1), j * step), rest).alias("key"))
        return F.transform(F.sequence(F.lit(0), F.ceil(longer / step).cast("int") - 1), row)

    n = F.length("word")
    return words.withColumn("b", F.explode(F.concat(rows(n), rows(n + 1)))).select("b.*", "word", "n")


def _codes(words: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Padded matrices of the code points, from the front and from the back."""
    front = np.zeros((len(words), width + 1), words[0].dtype)
    back = np.zeros_like(front)
    for i, w in enumerate(words):
        front[i, :len(w)] = w
        back[i, :len(w)] = w[::-1]
    return front, back


def _tile(a, b, window, longer: int) -> np.ndarray:
    """Index pairs (row of a, row of b) one edit apart whose first difference is in their bucket's window."""
    (front, back, length, key), (front2, back2, length2, key2) = a, b
    prefix = (front[:, None] != front2).argmax(2)       # distinct words: a difference comes before shared padding
    suffix = (back[:, None] != back2).argmax(2)
    step = max(2, -(-longer // 32))
    good = (key[:, None] == key2) & (prefix + suffix >= longer - 1) & (prefix // step == window[:, None])
    good &= np.maximum(length[:, None], length2) == longer
    return np.argwhere(good)


def _cuts(first: np.ndarray, n: int, block: int) -> list[int]:
    """Block limits of at most ``block`` rows, between buckets where one ends in reach."""
    out = [0]
    while out[-1] < n:
        at = first[np.searchsorted(first, out[-1] + block, "right") - 1]
        out.append(int(at) if at > out[-1] and out[-1] + block < n else min(out[-1] + block, n))
    return out


def near_in_buckets(longer: np.ndarray, window: np.ndarray, key: np.ndarray, words: list[str]) -> np.ndarray:
    """Pairs (i, j), i < j, of rows one edit apart; rows are sorted by (longer, key) and whole buckets."""
    found = [np.zeros((0, 2), np.int64)]
    length = np.array([len(w) for w in words])
    change = np.flatnonzero((np.diff(longer) != 0) | (np.diff(key) != 0)) + 1
    begin = np.concatenate([[0], change]).astype(np.int64)
    size = np.diff(np.append(begin, len(words)))
    own = np.add.reduceat(length == longer, begin)
    use = np.flatnonzero(np.repeat((size > 1) & (own > 0), size))       # the rest has nothing to compare
    for n in np.unique(longer[use]):
        rows = use[longer[use] == n]
        first = np.concatenate([[0], np.flatnonzero(np.diff(key[rows])) + 1])
        block = max(1, min(BLOCK, int((TILE_BYTES / (n + 1)) ** 0.5)))
        limits = _cuts(first, len(rows), block)
        spans = list(zip(limits[:-1], limits[1:], strict=True))
        made: dict[int, tuple] = {}

        def part(k, rows=rows, spans=spans, made=made, n=n):
            if k not in made:
                at = rows[slice(*spans[k])]
                code = [np.frombuffer(words[i].encode("utf-32-le"), "<u4") for i in at]
                if max((int(c.max()) for c in code if len(c)), default=0) < 256:
                    code = [c.astype(np.uint8) for c in code]
                made[k] = (*_codes(code, int(n)), length[at], key[at])
            return made[k]

        for k in range(len(spans)):
            last = k
            while last + 1 < len(spans) and key[rows[spans[last + 1][0]]] == key[rows[spans[k][1] - 1]]:
                last += 1
            for other in range(k, last + 1):
                hit = _tile(part(k), part(other), window[rows[slice(*spans[k])]], int(n))
                if other == k:
                    hit = hit[hit[:, 0] < hit[:, 1]]
                found.append(np.stack([rows[spans[k][0] + hit[:, 0]], rows[spans[other][0] + hit[:, 1]]], 1))
            made.pop(k, None)
    return np.concatenate(found)


def _compare(batches):
    """Pairs of a task's sorted buckets, each in both directions."""
    def pairs(t):
        words, n = t.column("word").to_pylist(), t.column("n").to_numpy()
        ij = near_in_buckets(t.column("longer").to_numpy(), t.column("window").to_numpy(), t.column("key").to_numpy(), words)
        left, right = np.concatenate([ij, ij[:, ::-1]]).T
        text = t.column("word").combine_chunks()
        return pa.RecordBatch.from_arrays([text.take(pa.array(left)), text.take(pa.array(right)), pa.array(n[right])],
                                          ["word", "other", "other_n"])

    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t])
        key, longer = t.column("key").to_numpy(), t.column("longer").to_numpy()
        same = np.flatnonzero((key != key[-1]) | (longer != longer[-1])) if len(t) else []
        cut = int(same[-1]) + 1 if len(same) else 0         # the last bucket may go on in the next batch
        if cut < ROWS // 10 and len(t) < ROWS:
            held = t
            continue
        if cut:
            yield pairs(t.slice(0, cut))
        held = t.slice(cut)
    if held is not None and len(held):
        yield pairs(held)


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, other_n): all pairs of distinct words one edit apart, in both directions."""
    # comparing costs more than its few bytes tell, so the partitions are not to be coalesced by size
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _buckets(words).repartition(n, "key").sortWithinPartitions("longer", "key")
    return dealt.select("longer", "window", "key", "word", "n").mapInArrow(
        _compare, "word string, other string, other_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: steps double in every round, and as every form occurs
    at least twice as often as its word, a chain is no longer than the logarithm of the largest n."""
    at = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("w"), F.col("root").alias("next"))
        new = store(at.join(on, F.col("root") == F.col("w"), "left")
                    .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not new.where("moved").limit(1).count():
            return new.select("word", "root")
        at = new.select("word", "root")


def spelling_groups(words: DataFrame, factor: int = 2, word_col: str = "word", n_col: str = "n") -> DataFrame:
    """(word, n) -> word, form, root, n, n_near, form_n, one row per distinct word.

    Near are words that one inserted, deleted or replaced code point parts.  The form is the
    near word of largest n, the smallest by code points among equals, if that n reaches
    ``factor`` times the word's own (null if none does); the root is the last form that
    follows, the word itself if it has none.  Null words are left out, counts of repeated
    words are added up, other columns aren't read.  An empty table gives no rows.  Words may
    be of any length: block sizes shrink with it.  A bucket holds at most 90**2 + 90 words of up
    to 64 Latin letters; of longer words, those that agree outside a 32nd of their length.
    """
    if factor < 2:
        raise ValueError("forms would not lead anywhere")
    own = store(words.where(F.col(word_col).isNotNull()).groupBy(F.col(word_col).alias("word"))
                .agg(F.sum(n_col).alias("n")), "words")
    near = near_words(own).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("other_n"), F.col("other"))).alias("best"))
    best = near.select(F.col("word").alias("w"), "n_near", F.col("best.other").alias("other"), (-F.col("best.col1")).alias("other_n"))
    led = F.col("other_n") >= factor * F.col("n")
    out = store(own.join(best, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(led, F.col("other")).alias("form"), F.when(led, F.col("other_n")).alias("form_n")), "forms")
    roots = _roots(out.where(F.col("form").isNotNull())).select(F.col("word").alias("w"), "root")
    return out.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
