"""Small tests of the training-data operators: brute force, round trips and awkward rows."""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortia.llm import (embedding_dedup, exact_dedup, line_dedup, lm_scoring, minhash, mixing, packing, quality,
                          token_counts, url_filters)
from cohortia.llm.attention import AttentionModel
from cohortia.llm.components import connected_components
from cohortia.llm.queries import ORACLES, QUERIES, URL_RULES, tokenizer
from cohortia.llm.scratch import store
from cohortia.llm.tokens import WordEncoder
from cohortia.llm.words import word_hashes

TINY = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, component long"
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, LONG, "en", "a", 0, 1, 2), (2, LONG, "en", "a", 0, 1, 2), (2, LONG, "en", "a", 0, 1, 2),
            (3, None, None, None, None, None, None), (4, "", "fr", "b", 0, 0, 0), (None, LONG, "en", "b", 0, 0, 0),
            (6, "word " * 30_000, "en", "b", 0, 0, 0), (7, "two words", "xx", "c", 0, 0, 0),
            (8, LONG.replace("zeta", "other"), "en", "c", 0, 0, 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{TINY}/documents.parquet")


def test_encoder_gives_the_tokenizers_ids(docs):
    texts = [r.text for r in docs.select("text").limit(60).collect()]
    texts += ["", "  a~b ~~ x~", "naïve café's don't ☃ 中文 ΑΣ İx\tq\r\nz\x1cy", "~", "a <|endoftext|> b<|startoftext|>c <|EndOfText|>"]
    for special in (True, False):
        from tokenizers import Tokenizer
        plain = Tokenizer.from_file(tokenizer())
        plain.encode_special_tokens = not special
        want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert WordEncoder(tokenizer(), special).encode(texts) == want
        assert [WordEncoder(tokenizer(), special).encode([t])[0] for t in texts[60:]] == want[60:]
    assert 49407 in np.frombuffer(WordEncoder(tokenizer()).encode(["a <|endoftext|> b"])[0], "<u4")


def test_encoder_of_single_texts_in_any_script():
    alone = ["Привет, мир!", "中文", "☃", "👩\u200d👧 ok", "ΑΣ, ς.", "İ! I\u0307 J\u030c", "\u0301x e\u0301,", "~☃ 中~", "\xa0\u3000\x85", "\x00 \x1c!", None]
    enc = WordEncoder(tokenizer())
    for t in alone:
        assert WordEncoder(tokenizer()).encode([t]) == [enc._plain(t or "")]
    rng = np.random.default_rng(9)
    parts = ["ab", "É", " ", "~", "<|endoftext|>", "☃", "中", "кот", "\u0301", "\n", "'ll", "12", "½", "ß", "İ", "ﬁ", "Ａ", "!", ",", "Å", "\x1c"]
    for _ in range(400):
        t = "".join(rng.choice(parts, rng.integers(1, 12)))
        assert enc.encode([t]) == [enc._plain(t)], t


def test_encoder_caches_keep_what_is_in_use():
    enc = WordEncoder(tokenizer())
    enc.chunks.bound = enc.pieces.bound = 5
    for i in range(40):
        t = f"same words, word{i} Ünï{i} новое{i}"
        assert enc.encode([t, t]) == [enc._plain(t)] * 2
        assert len(enc.chunks.new) + len(enc.chunks.old) < 40


def test_encoder_merges_words_of_letters_as_arrays():
    rng = np.random.default_rng(4)
    letters = np.array([*"abcdefghijklmnopqrstuvwxyzetaoinsrhETAÀÖØÞßàöøþÿéü"])
    words = ["".join(rng.choice(letters, n)) for n in [*range(1, 70), *rng.integers(1, 24, 1500)]]
    words += ["a" * n for n in range(1, 70)] + ["é" * n for n in range(1, 40)] + ["the", "The", "THE", "information", "straße"]
    odd = ["×", "a÷b", "naïve×", "µm", "ªº", "don't", "x1", "кот", "Ünï中"]
    enc, filled = WordEncoder(tokenizer()), set()
    fill = enc._fill
    enc._fill = lambda chunks: (filled.update(chunks), fill(chunks))
    text = " ".join([*words, *odd])
    for t in (text, text + " J\u030c"):         # with a combining mark, letters keep their case
        assert enc.encode([t, None, t + " end"]) == [enc._plain(t), b"", enc._plain(t + " end")]
    assert enc.encode(words) == [enc._plain(w) for w in words]
    assert set(odd) <= filled and all(len(w.encode()) > 64 for w in filled.intersection(words))


def test_packing_round_trip(spark, docs, odd):
    for frame in (docs, odd):
        rows = packing.pack_documents(frame, tokenizer()).collect()
        enc = WordEncoder(tokenizer())
        want = sorted(zlib.crc32(enc._plain(r.text or "") + b"\2\0\0\0") for r in frame.collect())
        if frame is docs:       # ids are unique: pieces join to the whole document
            parts = {}
            for r in rows:
                parts.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
            assert sorted(zlib.crc32(b"".join(b for _, b in sorted(p))) for p in parts.values()) == want
        places = {}
        for r in rows:
            assert len(r.ids) == 4 * r.length
            places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for p in places.values():
            at = 0
            for offset, length in sorted(p):
                assert offset == at
                at += length
            assert at <= 4096
    assert packing.pack_documents(docs.limit(0), tokenizer()).count() == 0


def test_rice_code_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        v = np.unique(rng.integers(0, 1 << 48, n, dtype=np.uint64))
        assert (exact_dedup.rice_decode(exact_dedup.rice_encode(v)) == v).all()


def test_exact_dedup(spark, docs, odd):
    got = {(r.doc_id, r.text_sha256): (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(odd).collect()}
    by_id = {k[0]: v for k, v in got.items()}
    assert by_id[1] == (2, 4, False) and by_id[2] == (2, 4, True) and by_id[None] == (2, 4, False)
    assert by_id[3] == (4, 2, False) and by_id[4] == (4, 2, True)
    assert exact_dedup.exact_dedup(odd).count() == odd.count()
    assert exact_dedup.exact_dedup(odd.limit(0)).count() == 0


def _near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    p = s = 0
    least = min(len(a), len(b))
    while p < least and a[p] == b[p]:
        p += 1
    while s < least - p and a[-1 - s] == b[-1 - s]:
        s += 1
    return max(len(a), len(b)) - p - s <= 1


def test_line_dedup_equals_brute_force(docs, odd):
    rows = sorted((r.doc_id, i, x.lower().split()) for r in docs.collect() for i, x in enumerate(r.text.split("\n"))
                  if len(x.split()) >= 8)
    want = {}
    for j, (d, i, w) in enumerate(rows):
        if any(w == v for _, _, v in rows[:j]):
            want[d, i] = 0
        elif any(_near(w, v) for _, _, v in rows[:j]):
            want[d, i] = 1
    assert {(r.doc_id, r.line): r.edits for r in line_dedup.repeated_lines(docs).collect()} == want
    # the null id comes first, so every other copy loses the line; rows without words pass
    assert {r.doc_id for r in line_dedup.drop_repeated_lines(odd).collect()} == {None, 3, 4, 6, 7}
    assert line_dedup.drop_repeated_lines(odd.limit(0)).columns == odd.columns


def test_line_dedup_false_candidate_hides_no_match(spark):
    words = "a b c d e f g h i j k l".split()
    for texts in ([words[:1] + words[2:], words, words[:4] + words[5:]],
                  ["a b c d e f g h".split(), "b a c d e f g k".split(), "b a c d e f g h".split()]):
        rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
        got = {(r.doc_id, r.keep_id, r.edits)
               for r in line_dedup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        want = {(j, i, 1) for j, w in enumerate(texts) for i in [next((i for i in range(j) if _near(w, texts[i])), None)]
                if i is not None}
        assert got == want and max(want)[0] == 2
    rng = np.random.default_rng(3)              # many false candidates: words from a small set, moved about
    texts = []
    for _ in range(40):
        line = rng.choice(list("abc"), 9).tolist()
        for _ in range(6):
            i, j = rng.integers(0, 9, 2)
            texts.append(line[:i] + line[i + 1:] if i % 2 else line[:j] + ["d"] + line[j:])
    texts = [w for w in texts if len(w) >= 8]
    want = {}
    for j, w in enumerate(texts):
        same, near = (next((i for i in range(j) if f(texts[i])), None) for f in (lambda v: v == w, lambda v: _near(w, v)))
        if near is not None:
            want[j] = (near, 1) if same is None else (same, 0)
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    got = line_dedup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: (r.keep_id, r.edits) for r in got} == want


def test_line_dedup_folds_short_equal_lines(spark, docs):
    rows = sorted((r.doc_id, i, x.lower().split()) for r in docs.collect() for i, x in enumerate(r.text.split("\n")) if x.split())
    first, want, short = {}, set(), 0
    for d, i, w in rows:
        if first.setdefault(" ".join(w), (d, i)) != (d, i):
            want.add((d, i, *first[" ".join(w)]))
            short += len(w) < 8
    got = QUERIES["op3_line_dedup"](spark, TINY).where("edits = 0").collect()
    assert {(r.doc_id, r.line, r.keep_id, r.keep_line) for r in got} == want and len(got) == len(want) and short
    texts = [(1, LONG + "\nthe end\n\n"), (2, "The  End\n\nthe end of"), (3, "the end")]
    out = line_dedup.drop_repeated_lines(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in out} == {1: texts[0][1], 2: "\nthe end of"}


def test_minhash_equals_brute_force(docs, odd):
    sets = {}
    for r in docs.collect():
        w = r.text.encode().lower().split()
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for j, a in enumerate(ids):
        for b in ids[:j]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.minhash_dedup(docs).collect()}
    assert got == {i: (len(sets[i]), find(i), find(i) == i) for i in ids}
    odd_got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.minhash_dedup(odd).collect()}
    assert odd_got[2] == (6, 1, False) and odd_got[3] == (0, 3, True) and odd_got[7] == (1, 7, True)
    assert odd_got[None][1:] == (None, True) and odd_got[6][0] == 1
    assert minhash.minhash_dedup(odd.limit(0)).count() == 0


def test_word_hashes_split_like_bytes():
    texts = ["a b", None, "", "É  x\ty\x0bz\x1cq", "A a"]
    h, n = word_hashes(texts)
    assert n.tolist() == [2, 0, 0, 4, 2] and h[-1] == h[-2] == h[0]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)}


def test_token_counts_round_trip(docs, odd):
    enc = WordEncoder(tokenizer())
    for frame in (docs, odd):
        got = sorted(r.n_tokens for r in token_counts.document_token_counts(frame, tokenizer()).collect())
        assert got == sorted(len(enc._plain(r.text or "")) // 4 for r in frame.collect())
    ids = np.array([1, 2, 9, 9, 3, 4, 5, 6, 9, 7], ">u2").tobytes()
    assert list(token_counts.scan_blocks(ids, 9, 4)) == [(0, 2, 4, 2, 0, [0]), (1, 0, 4, 4, 4, []), (2, 1, 2, 0, 1, [])]


def test_quality_keeps_clean_and_rejects_noise(spark, odd):
    sf = "/root/testdata/sf0.01"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.classify_quality(d, labels).join(labels, "doc_id").join(d.select("doc_id", "text"), "doc_id").collect()
    good = [r for r in got if r.quality == 1]
    noise = [r for r in got if r.quality == 0 and ("!!" in r.text or "&&&" in r.text or " | " in r.text)]
    assert sum(r.kept for r in good) >= 0.98 * len(good) and sum(r.kept for r in noise) <= 0.05 * len(noise)
    none = labels.limit(0)
    assert quality.classify_quality(odd, none).where("kept").count() == odd.count()


def test_quality_thresholds_cover_all_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rare = spark.createDataFrame([(10 ** 9 + i, f"zq xw {i} vvk jjq " * 9, "rare") for i in range(5)],
                                 "doc_id long, text string, lang string")
    d = d.select("doc_id", "text", "lang").unionByName(rare)
    labels = labels.select("doc_id", "quality").unionByName(rare.select("doc_id", F.lit(1).cast("int").alias("quality")))
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    lang = {r.doc_id: r.lang for r in d.collect() if r.doc_id in good}
    sample = [r.doc_id for r in quality.trusted_sample(d, labels, 60).collect()]
    assert len(sample) == len(set(sample)) <= 60 and {lang[i] for i in sample} == set(lang.values())
    got = quality.classify_quality(d, labels, max_train_docs=60, quantile=0.9, slack=1.0).collect()
    by = {}
    for r in got:
        if r.doc_id in good and r.n_grams:
            by.setdefault(r.lang, []).append((r.perplexity, r.threshold))
    for rows in by.values():        # the quantile holds over all good documents, most of them outside the fit
        assert sum(p <= t * (1 + 1e-9) for p, t in rows) == -(-9 * len(rows) // 10)


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 16))
    x[20:] = x[:20] + 0.05 * rng.normal(size=(20, 16))
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)] + [
        (90, None, 0), (91, [0.0] * 16, 0), (92, [float("nan")] + [1.0] * 15, 0), (93, [None] + [1.0] * 15, 0), (94, [], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(frame).collect()}
    assert got == {i: (1, i % 20, i < 20) for i in range(40)} | {i: (0, i, True) for i in range(90, 95)}
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0


def test_url_aliases(spark):
    page = '<link rel="canonical" href="{}">'
    rows = [(1, "http://a.org/x#f", page.format("/y")), (2, "http://a.org/y", ""), (3, "http://z.org/", page.format("http://b.net/fr/1")),
            (4, "http://q.org/1", '<meta http-equiv="refresh" content="0; url=http://z.org/">'), (5, None, None), (6, "no scheme", ""),
            (7, "http://www.example.com/en/", page.format("http://z.org/"))]
    got = {r.page_id: (r.rule, r.verdict) for r in url_filters.filter_urls(
        spark.createDataFrame(rows, "page_id long, url string, html string"), URL_RULES).collect()}
    assert got == {1: (None, "allow"), 2: (None, "allow"), 3: (None, "block"), 4: (None, "block"), 5: (None, "allow"),
                   6: (None, "allow"), 7: ("www.example.com/en/", "allow")}


def test_mixing(spark, docs, odd):
    rows = mixing.mix_sources(docs).collect()
    by = {}
    for r in rows:
        taken = r.size * r.copies * len(r.draws)
        assert taken <= 3 * r.size * r.copies
        s = by.setdefault(r.source, [0, r.target, r.source_size, 0])
        s[0] += taken
        s[3] = max(s[3], r.size)
    assert all(abs(t - goal) <= max(0.05 * goal, biggest) for t, goal, _, biggest in by.values())
    assert abs(sum(goal for _, goal, _, _ in by.values()) - sum(r.size * r.copies for r in rows)) < 1e-6
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_sources(docs).collect()))
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mix_sources(odd.limit(0)).count() == 0


def test_mixing_fills_behind_a_long_document(spark):
    def weigh(sources):
        return sources.withColumn("weight", F.when(F.col("source") == "a", 1).otherwise(3).cast("long"))

    for base, long in ((0, 3000), (7000, 1500)):
        rows = [(base, "a", "w " * long)] + [(base + i, "a", "w " * 4) for i in range(1, (5000 - long) // 4 + 1)] \
            + [(base + 5000 + i, "b", "w " * 50) for i in range(60)]
        got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string"), weigh).collect()
        taken = {x: sum(r.size * len(r.draws) for r in got if r.source == x) for x in "ab"}
        assert taken == {"a": 2000, "b": 6000} and {r.target for r in got} == {2000.0, 6000.0}


def _plain_targets(sizes, weights, cap):
    """Water filling in fractions: those above ``cap`` times their size are held there, the rest share again."""
    held = set()
    while True:
        left = sum(sizes.values()) - sum(cap * sizes[s] for s in held)
        open_ = [s for s in sizes if s not in held]
        level = Fraction(left, sum(weights[s] for s in open_)) if open_ else Fraction(0)
        above = {s for s in open_ if level * weights[s] > cap * sizes[s]}
        if not above:
            return {s: Fraction(cap * sizes[s]) if s in held else level * weights[s] for s in sizes}
        held |= above


@pytest.mark.parametrize("sizes", [[5], [0, 7], [1, 1, 1, 1], [1000, 1, 1, 1, 50], [3, 300, 30_000, 0, 9, 27, 2], [0, 0]])
def test_mixing_targets_equal_plain_water_filling(spark, sizes):
    names = ["A", "Z", "a", "aa", "\u00e9", "\u4e2d", None][:len(sizes)]
    weights = {n: i % 3 + 1 for i, n in enumerate(names)}
    frame = spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, source_size long").repartition(3)
    got = {r.source: r.target for r in mixing.targets(mixing.cyclic_weights(frame), 3).collect()}
    want = _plain_targets(dict(zip(names, sizes, strict=True)), weights, 3)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(float(want[k]), rel=1e-12) for k in want)


def test_mixing_shards_follow_the_words(spark, docs):
    assert [mixing.shard_depth_of(w) for w in (0, 1 << 29, (1 << 29) + 1, 1 << 40)] == [4, 4, 5, 15]
    shards = {}
    taken = []
    for size in (1 << 25, 500):
        rows = mixing.mix_sources(docs, shard_words=size, block_words=64).collect()
        taken.append({(r.id, r.source, r.text_hash): len(r.draws) for r in rows})
        words = {}
        for r in rows:
            for x in r.draws:
                words[x.shard] = words.get(x.shard, 0) + r.size * r.copies
        shards[size] = words
    assert taken[0] == taken[1]                                     # shards don't change what the mix takes
    assert len(shards[1 << 25]) <= 16 < len(shards[500])
    longest = max(r.size * r.copies for r in mixing.mix_sources(docs).collect())
    assert max(shards[500].values()) <= 2 * 500 + 64 + longest


def test_mixing_leaves_out_nothing_that_fits(docs):
    by = {}
    for r in mixing.mix_sources(docs).collect():
        by.setdefault((r.source, r.target, r.source_size), []).append((r.size * r.copies, len(r.draws)))
    for (_, target, size), rows in by.items():
        missing, passes = target - sum(w * n for w, n in rows), target // size
        left = [w for w, n in rows if w and n == passes and passes < 3]
        assert not left or abs(missing) < min(left) and not (missing < 0 and -missing > min(left) / 2 + 1e-6)


def _plain_fill(sizes, gap):
    """Longest first: every document that fits into what is still missing."""
    got = Counter()
    for w in sorted(sizes, reverse=True):
        if w <= gap:
            got[w] += 1
            gap -= w
    return got


@pytest.mark.parametrize("gap", [0.5, 1.0, 16.0, 1000.5, 5000.0, 600_000.0])
def test_mixing_fill_equals_plain_fill_in_few_rounds(spark, gap, monkeypatch):
    rounds = []
    monkeypatch.setattr(mixing, "store", lambda df, name, *a: rounds.append(name) or store(df, name, *a))
    rng = np.random.default_rng(int(gap))
    sizes = {None: [1 << i for i in range(16)], "a": list(range(1, 1001)) * 2, "b": rng.integers(1, 400, 3000).tolist(), "c": []}
    left = spark.createDataFrame([(s, w) for s, ws in sizes.items() for w in ws], "source string, words long")
    gaps = spark.createDataFrame([(s, 7, gap) for s in sizes], "s string, have long, gap double")
    takes = mixing.fill_by_size(left, gaps)
    rows = takes.collect() if takes is not None else []
    for s, ws in sizes.items():
        got = {r.w: r.take for r in rows if r.s == s}
        assert got == _plain_fill(ws, gap)
        for r in (r for r in rows if r.s == s):
            assert r.base == 7 + sum(w * n for w, n in got.items() if w > r.w)
    assert rounds.count("found") <= max(1, int(gap).bit_length()) + 1


def test_mixing_range_starts_over_many_levels(spark):
    rows = [(s, f"1{i * 7919 % 16 ** 5:05x}", i % 11) for s in ("a", None) for i in range(3000)]
    got = mixing.range_starts(spark.createDataFrame(rows, "source string, bucket string, sum long"), ["source"], 6, 1).collect()
    want = sorted((b, n) for s, b, n in rows if s)
    starts = dict(zip((b for b, _ in want), itertools.accumulate([0] + [n for _, n in want]), strict=False))
    assert len(got) == 6000 and all(r.before == starts[r.bucket] for r in got)


def test_hypergeometric_moments(spark):
    u = F.shiftrightunsigned(F.xxhash64("id"), 11) * 2.0 ** -53
    h = spark.range(4000).select(mixing.hypergeometric(F.lit(1000), F.lit(300), F.lit(200), u).alias("h"))
    mean, sd = h.agg(F.avg("h"), F.stddev("h")).first()
    assert abs(mean - 60) < 0.5 and abs(sd - 5.8) < 0.4


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    from tests.harness import compare, duck
    assert compare(QUERIES[name](spark, TINY).toPandas(), duck(TINY).sql(ORACLES[name]).df()) is None


def test_lm_scores_add_up(spark, docs):
    rows = {r.doc_id: r for r in QUERIES["op7_lm_scoring"](spark, TINY).collect()}
    texts = {r.doc_id: (r.text or "").encode().lower().split() for r in docs.collect()}
    train = [d for d in texts if zlib.crc32(str(d).encode()) % 10]
    count, n = {}, 0
    for d in train:
        for w in [*texts[d], None]:
            count[w] = count.get(w, 0) + 1
            n += 1
    for d, r in rows.items():
        tokens = [*texts[d], None]
        want = sum(np.log10((count.get(w, 0) + 0.1) / (n + 0.1 * (len(count) + 1))) for w in tokens)
        assert r.n_tokens == len(tokens) and r.train_tokens == n and r.held_out == (d not in train)
        assert r.n_known == sum(w in count for w in tokens) and abs(r.base_score - want) < 1e-6 * max(1, abs(want))
        assert r.score < 0 and r.attention_score < 0


def test_lm_scores_awkward_rows(spark, odd):
    def scores(frame):
        got = lm_scoring.score_documents(frame, tokenizer(), max_fit_docs=4, epochs=1).collect()
        return sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.score) for r in got), key=str)
    got = scores(odd)
    assert [(d, n) for d, n, *_ in got] == [(1, 11), (2, 11), (2, 11), (3, 1), (4, 1), (6, 30_001), (7, 3), (8, 11), (None, 11)]
    assert all(np.isfinite(r[-1]) and r[-1] < 0 for r in got)
    assert scores(odd.limit(0)) == []
    held = odd.where(lm_scoring.held_out("doc_id"))
    assert all(r[2] == 0 and r[3] == 0 and np.isfinite(r[-1]) for r in scores(held))


def test_lm_learns_from_every_training_document(spark):
    """Other texts in either half of the training documents change what the attention model says."""
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10][:12]
    probe = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)

    def attention(changed):
        rows = [(i, "blue green " * 20 if i in changed else "the red house stands on a hill " * 8) for i in ids]
        frame = spark.createDataFrame([*rows, (probe, "the red house stands on a hill")], "doc_id long, text string").coalesce(1)
        got = lm_scoring.score_documents(frame, tokenizer(), max_fit_docs=1, epochs=1).where("held_out").collect()
        return got[0].attention_score
    whole = attention(())
    assert whole > attention(ids[:6]) and whole > attention(ids[6:])


def test_lm_runs_are_small_in_memory():
    import tracemalloc

    from cohortia.llm.words import _POWERS, words_at
    _POWERS.clear()
    tracemalloc.start()
    words_at(["lorem ipsum dolor " * (lm_scoring.RUN_CHARS // 72)] * 4)
    assert tracemalloc.get_traced_memory()[1] < 120e6       # 183 MB at 4 million characters
    tracemalloc.stop()


class _Caught(Exception):
    pass


class _Frame:
    """Gives out the first function that an operator maps over batches."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        raise _Caught(run)


def test_tasks_of_the_pipeline_keep_no_caches(spark):
    import pyarrow as pa

    from cohortia.llm import tokens, words
    with pytest.raises(_Caught) as sketch:
        minhash.minhash_dedup(_Frame())
    texts = pa.array([LONG, None, "a b"])
    ids = pa.array([1, 2, 3], pa.int64())
    for run, columns in ((sketch.value.args[0], [ids, texts]), (quality._distinct_grams(4), [texts])):
        tokens.encoder(tokenizer())
        word_hashes([LONG])
        assert tokens._OPEN and words._POWERS
        assert list(run([pa.RecordBatch.from_arrays(columns, ["id", "text"][-len(columns):])]))
        assert not tokens._OPEN and not words._POWERS


def test_tasks_give_free_memory_back():
    import re

    import pyarrow as pa

    from cohortia.llm.workers import light

    def own_mb():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"Pss_Anon: +(\d+)", f.read())[1]) / 1024
    pins = []

    def run(batches):
        for b in batches:
            held = [bytes(700) for _ in range(300_000)]         # 210 MB; what stays lies behind
            pins.append(bytes(700))
            del held
            yield b
    batch, before = pa.RecordBatch.from_pydict({"x": [1]}), own_mb()
    assert list(light(run)([batch])) == [batch]
    assert own_mb() < before + 60


def test_lm_mean_of_weights_and_sums_of_blocks():
    import pandas as pd
    w = [{"a": np.full((2, 3), x, np.float32), "b": np.arange(4, dtype=np.float32) * x} for x in (1, 4)]
    mean = lm_scoring.mean_weights(pd.DataFrame({"of": 0, "task": [1, 0], "n": [2, 1], "data": [lm_scoring.flat_weights(x) for x in w]}))
    got = {k: np.zeros_like(x) for k, x in w[0].items()}
    lm_scoring.set_weights(got, mean["data"].iloc[0])
    assert mean["n"].tolist() == [3] and (got["a"] == 2).all() and got["b"].tolist() == [0, 2, 4, 6]
    blocks = lm_scoring.sum_blocks(pd.DataFrame({"block": 0, "task": 0, "data": [lm_scoring.packed([1, 2], "<i8")] * 3}))
    assert lm_scoring.unpacked(blocks["data"].iloc[0], "<i8").tolist() == [3, 6]


def test_attention_gradient_by_differences():
    rng = np.random.default_rng(4)
    n = np.array([1, 60, 29])
    ids = rng.integers(0, 20, n.sum())
    ids[np.cumsum(n) - 1] = 20
    words = np.where(rng.random(len(ids)) < 0.6, ids % 3, -1)
    model = AttentionModel(20, np.bincount(ids, minlength=21), np.arange(20) % 5, 3)
    model.w = {k: x.astype(float) / (8 if k == "e" else 1) for k, x in model.w.items()}
    place, scored = model.windows(n)
    gradient = model._gradient(place, scored, *model._inputs(ids, n, words))

    def loss():
        logs, word_logs = model.score(ids, n, words)
        return -(logs.sum() + word_logs[words >= 0].sum()) / len(ids)
    for k, g in gradient.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, ends = model.w[k][at], []
        for step in (1e-3, -1e-3):
            model.w[k][at] = old + step
            ends.append(loss())
        model.w[k][at] = old
        assert abs((ends[0] - ends[1]) / 2e-3 - g[at]) < 1e-3 * abs(g[at]) + 1e-9, k


def test_attention_gradient_in_parts(monkeypatch):
    """Windows taken a few at a time give the same gradient, in less memory than whole batches."""
    import tracemalloc

    from cohortia.llm import attention
    rng = np.random.default_rng(6)
    n = rng.integers(1, 70, 200)
    ids = rng.integers(0, 2000, n.sum())
    ids[np.cumsum(n) - 1] = 2000
    words = np.where(rng.random(len(ids)) < 0.6, ids % 49, -1)
    model = AttentionModel(2000, np.bincount(ids, minlength=2001), np.arange(2000) % 64, 49)
    place, scored = model.windows(n)
    assert 256 < len(place) < 500
    inputs = model._inputs(ids, n, words)
    got = {}
    for part in (7, 500):
        monkeypatch.setattr(attention, "PART", part)
        got[part] = model._gradient(place, scored, *inputs)
    for k, g in got[7].items():
        assert np.abs(g).max() > 0 and np.abs(g - got[500][k]).max() < 1e-5 * np.abs(g).max(), k
    monkeypatch.undo()
    tracemalloc.start()
    model._gradient(place[:256], scored[:256], *inputs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8e6        # 5.8 MB; 12.5 MB with all 256 windows at once


def test_attention_keeps_numbers_at_extreme_logits():
    """Logits far beyond what exp can carry give finite gradients and scores."""
    n = np.array([1, 40])
    ids = np.append(20, np.append(np.arange(39) % 20, 20))
    model = AttentionModel(20, np.bincount(ids, minlength=21), np.arange(20) % 5, 3)
    for size in (1e3, -1e3):
        for k in ("q", "c", "wc"):
            model.w[k][:] = size
        place, scored = model.windows(n)
        gradient = model._gradient(place, scored, *model._inputs(ids, n, ids % 3))
        assert all(np.isfinite(g).all() for g in gradient.values())
        assert all(np.isfinite(x).all() for x in model.score(ids, n, ids % 3))


def test_attention_scores_each_id_once_and_causally():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 20, 90)
    n = np.array([1, 60, 29])
    ids[np.cumsum(n) - 1] = 20
    model = AttentionModel(20, np.bincount(ids, minlength=21), np.arange(20) % 5, 3).fit(ids, n, ids % 3, 1)
    logs, words = model.score(ids, n, ids % 3)
    place, scored = model.windows(n)
    w, before = model.w, np.append(model.begin, ids[:-1])
    before[np.cumsum(n) - n] = model.begin
    seen = []
    for p, k in zip(place, scored, strict=True):        # every window by itself, position by position
        at = np.flatnonzero(p >= 0)
        x = w["e"][model.row[before[p[at]]]] + w["p"][at]
        for i in range(len(at) - k, len(at)):
            s = np.exp((x[:i + 1] @ w["k"]) @ (x[i] @ w["q"]) / np.sqrt(x.shape[1]))
            h = x[i] + (s / s.sum()) @ (x[:i + 1] @ w["v"]) @ w["o"]
            z, zw, j = h @ w["c"] + w["b"], h @ w["wc"] + w["wb"], p[at[i]]
            seen.append(j)
            assert abs(logs[j] - (z[model.cls[ids[j]]] - np.log(np.exp(z).sum()))) < 1e-4
            assert abs(words[j] - (zw[ids[j] % 3] - np.log(np.exp(zw).sum()))) < 1e-4
    assert sorted(seen) == list(range(90))


def _plain_kneser_ney(texts, order):
    """Interpolated modified Kneser-Ney over bytes: {gram: probability} by direct counting."""
    top = {}
    for t in texts:
        b = b" " * (order - 1) + b" ".join(t.lower().encode().split()) + b" "
        if t.split():
            for i in range(order - 1, len(b)):
                g = b[i - order + 1:i + 1]
                top[g] = top.get(g, 0) + 1
    counts = {order: top}
    for k in range(order - 1, 0, -1):
        counts[k] = {}
        for g in counts[k + 1]:
            counts[k][g[1:]] = counts[k].get(g[1:], 0) + 1
    cut = {}
    for k, c in counts.items():
        t = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
        y = t[0] / (t[0] + 2 * t[1]) if t[0] else 0.5
        cut[k] = [min(float(i + 1), max(0.0, i + 1 - (i + 2) * y * t[i + 1] / t[i])) if t[i] and t[i + 1] else 0.5 for i in range(3)]

    def p(gram, k=order):
        if not k:
            return 1 / 256
        low = p(gram, k - 1)
        g, x = gram[len(gram) - k:], gram[len(gram) - k:-1]
        same = [(h, c) for h, c in counts[k].items() if h[:-1] == x]
        total = sum(c for _, c in same)
        if not total:
            return low
        d = lambda c: cut[k][min(c, 3) - 1]
        c = counts[k].get(g, 0)
        return (c - d(c) if c else 0) / total + sum(d(c) for _, c in same) / total * low
    return p


def test_perplexities_equal_plain_kneser_ney(spark):
    texts = ["the cat sat on the mat", "The cat  ate the rat\n", "a mat sat", "that hat, that cat", "été à la mer"]
    other = [*texts, "the bat zzz", "", None, "  a\tcat"]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(5)], "doc_id long, quality int, id int")
    frame = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(other)], "doc_id long, text string, lang string")
    for order in (2, 4):
        p = _plain_kneser_ney(texts, order)
        want = {}
        for i, t in enumerate(other):
            b = b" ".join((t or "").lower().encode().split()) + b" " if (t or "").split() else b""
            b = b" " * (order - 1) + b
            logs = [np.log10(p(b[j - order + 1:j + 1])) for j in range(order - 1, len(b))]
            want[i] = (len(logs), 10 ** (-sum(logs) / len(logs)) if logs else None)
        got = quality.classify_quality(frame, labels, order=order, prior=0).collect()
        for r in got:
            n, perplexity = want[r.doc_id]
            assert r.n_grams == n and (r.perplexity is None if perplexity is None else abs(r.perplexity / perplexity - 1) < 1e-9), (r, want)
    for order in (0, 7):
        with pytest.raises(ValueError):
            quality.classify_quality(frame, labels, order=order)


def test_neighbour_counts_equal_counts_by_place():
    from cohortia.llm.attention import PLACES, add_neighbours, neighbour_slots
    rng = np.random.default_rng(8)
    size, width = 9, 4
    for texts in ([[]], [[3]], [[3, 3]], [[0, 8, 8, 8], [1]], [rng.integers(0, size, 500), rng.integers(0, 2, 90), []]):
        texts = [np.asarray(t, np.int64) for t in texts]
        slot = neighbour_slots(np.bincount(np.concatenate(texts), minlength=size), width)
        got, want = (np.zeros((len(PLACES), size, width), np.int32) for _ in range(2))
        for t in texts:
            add_neighbours(got, t, slot)
            for j, d in enumerate(PLACES):
                for i in range(len(t)):
                    if 0 <= i + d < len(t):
                        want[j, t[i], slot[t[i + d]]] += 1
        assert (got == want).all()


def test_attention_gradient_makes_no_keys_and_values():
    """Query and key, and value and output, are multiplied first: batches take less memory and the weights' gradients stay."""
    import tracemalloc
    rng = np.random.default_rng(6)
    n = rng.integers(1, 70, 200)
    ids = rng.integers(0, 2000, n.sum())
    ids[np.cumsum(n) - 1] = 2000
    words = np.where(rng.random(len(ids)) < 0.6, ids % 49, -1)
    model = AttentionModel(2000, np.bincount(ids, minlength=2001), np.arange(2000) % 64, 49)
    place, scored = model.windows(n)
    inputs = model._inputs(ids, n, words)

    def peak(run):
        tracemalloc.start()
        out = run()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most, out
    most, gradient = peak(lambda: model._gradient(place[:256], scored[:256], *inputs))
    assert most < 5.3e6                                 # 4.9 MB; 5.8 MB with keys and values
    assert peak(lambda: model.score(ids, n, words))[0] < 3.4e6      # 2.4 MB; 4.4 MB with them
    # the loss hangs on q @ k.T and v @ o only, which ties their gradients to each other
    w, g = model.w, gradient
    for a, b in ((w["q"].T @ g["q"], g["k"].T @ w["k"]), (w["v"].T @ g["v"], g["o"] @ w["o"].T)):
        assert np.abs(a - b).max() < 1e-4 * np.abs(a).max()


def test_adam_steps_by_the_formula():
    from cohortia.llm.attention import Adam
    rng = np.random.default_rng(2)
    w = {"a": rng.normal(size=(3, 4)).astype(np.float32), "b": np.ones(5, np.float32)}
    want, m1, m2 = ({k: f(x).astype(float) for k, x in w.items()} for f in (np.copy, np.zeros_like, np.zeros_like))
    adam = Adam(w)
    for step in range(1, 31):
        g = {k: (rng.normal(size=x.shape) * (step % 4)).astype(np.float32) for k, x in reversed(w.items())}
        adam(g, 0.01)
        for k, d in g.items():
            m1[k], m2[k] = 0.9 * m1[k] + 0.1 * d, 0.98 * m2[k] + 0.02 * d.astype(float) ** 2
            want[k] -= 0.01 * min(1, step / 20) * m1[k] / (1 - 0.9 ** step) / (np.sqrt(m2[k] / (1 - 0.98 ** step)) + 1e-8)
            assert np.abs(w[k] - want[k]).max() < 1e-5
    assert w["a"].base is w["b"].base is adam.flat


def test_words_of_letters_and_marks_are_never_strings():
    """``encode_words`` gives the ids of ``encode``, which sees only marks and words that can't be merged as arrays."""
    e = WordEncoder(tokenizer())
    odd = ["don't", "3.14", "x-y", "中文", "☃", "éx", "<|endoftext|>", "a<|endoftext|>", "İx,", "x" * 65, "\xa0", "~", "\x00", "\x1c,"]
    plain = ["word", "Word", "straße", "ÀÉ", "x" * 64, "word,", "dogs'", "what?!", "ß$$$", "a~", "b.***"]
    for words in ([], [""], plain, odd, plain + odd, ["word,"] * 3, ["?!", "", "a"], ["\x1c"]):
        want = e.encode(words)
        ids, n = e.encode_words([w.encode() for w in words])
        assert ids.tolist() == np.frombuffer(b"".join(want), "<u4").tolist() and n.tolist() == [len(x) // 4 for x in want]
    seen, e.encode = [], lambda texts, inner=e.encode: seen.extend(texts) or inner(texts)
    e.encode_words([w.encode() for w in plain + ["x-y"]])
    assert sorted(seen) == sorted([",", "'", "?!", "$$$", "~", ".***", "x-y"])


def test_words_of_a_shard_are_numbered_together():
    texts = [b"", b"a bc \xff\xfe", b"", b"bc", b"a b a"]
    number, many = lm_scoring.same_words(texts)
    words = b" ".join(texts).split()
    assert many == len(set(words)) == len(set(number.tolist())) == len(set(zip(words, number.tolist(), strict=True)))
    assert [x.tolist() if hasattr(x, "tolist") else x for x in lm_scoring.same_words([b"", b""])] == [[], 0]
