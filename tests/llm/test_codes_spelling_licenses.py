"""Vector codes, spelling variants and license scans against plain versions, with awkward rows."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortia.llm import licenses, spelling, vector_codes
from cohortia.llm.queries import QUERIES

TINY = "/root/testdata/sf0.001"


def test_products_are_exact_up_to_the_bound():
    rng = np.random.default_rng(5)
    for dims in (1, 3, 16, 200):
        for most in (900, 2 ** 20, vector_codes.largest_component(dims)):
            x, y = rng.integers(-most, most + 1, (2, 30, dims))
            x[0], y[0] = most, -most
            want = [[sum(int(a) * int(b) for a, b in zip(p, q, strict=True)) for q in y] for p in x]
            assert vector_codes.exact_products(x, y).tolist() == want
            index, distance = vector_codes.nearest(x, y)
            plain = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q, strict=True)) for q in y] for p in x]
            assert distance.tolist() == [min(r) for r in plain] and index.tolist() == [r.index(min(r)) for r in plain]
    assert vector_codes.nearest(np.zeros((2, 3), int), np.ones((4, 3), int))[0].tolist() == [0, 0]


def test_limbs_keep_their_bound():
    x = np.array([[0, 1, -1, 2 ** 40 + 3, -2 ** 40 - 3, 2 ** 9, -2 ** 9]])
    pieces = vector_codes.limbs(x, 10)
    assert all((np.abs(p) <= 2 ** 9).all() for p in pieces)
    assert (sum(p.astype(np.int64) << 10 * i for i, p in enumerate(pieces)) == x).all()


def _plain_codes(rows, parts, entries, rounds, scale):
    """Lloyd's rounds in Python integers: rows of (id, vector)."""
    x = [[int(np.floor(scale * v)) for v in r] for _, r in rows]
    w = len(x[0]) // parts
    cut = [[v[p * w:(p + 1) * w] for v in x] for p in range(parts)]
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])[:entries]
    books = [[c[i] for i in order] for c in cut]

    def assign(vectors, book):
        d = [[sum((a - b) ** 2 for a, b in zip(v, e, strict=True)) for e in book] for v in vectors]
        return [r.index(min(r)) for r in d], [min(r) for r in d]

    for _ in range(rounds):
        for c, book in zip(cut, books, strict=True):
            at, _ = assign(c, book)
            for e in range(len(book)):
                own = [v for v, i in zip(c, at, strict=True) if i == e]
                if own:
                    book[e] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    done = [assign(c, book) for c, book in zip(cut, books, strict=True)]
    codes = ["".join(f"{done[p][0][i]:02x}" for p in range(parts)) for i in range(len(rows))]
    return codes, [sum(done[p][1][i] for p in range(parts)) for i in range(len(rows))], books


def test_codes_equal_plain_rounds(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(v) for v in rng.normal(size=8) * (30_000 if i == 3 else 1)]) for i in rng.permutation(90)]
    frame = spark.createDataFrame([(i, v, i % 3) for i, v in rows], "vec_id long, embedding array<double>, label int").repartition(4)
    got, books = vector_codes.compress_vectors(frame, entries=12, rounds=3)
    codes, errors, want = _plain_codes(rows, 4, 12, 3, 1024)
    assert {r.id: (r.code, r.error) for r in got.collect()} == {i: (c, e) for (i, _), c, e in zip(rows, codes, errors, strict=True)}
    assert [b.tolist() for b in books] == want
    sums = {r.label: r.label_error for r in vector_codes.label_errors(got).collect()}
    assert sums == {k: sum(e for (i, _), e in zip(rows, errors, strict=True) if i % 3 == k) for k in range(3)}


def test_codes_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    schema = "vec_id long, embedding array<float>, label string, id int, v string, code int, error int"
    rows = [(1, [1.0] * 8, "a"), (1, [1.0] * 8, "a"), (None, [2.0] * 8, None), (2, [0.5] * 3, None), (3, [], "b"),
            (4, None, "b"), (5, [nan] * 8, "b"), (6, [inf] * 8, "b"), (7, [None] * 8, "b"), (8, [1e30, -1e30] * 4, "c")]
    frame = spark.createDataFrame([(*r, 0, "x", 0, 0) for r in rows], schema)
    got, books = vector_codes.compress_vectors(frame, entries=3)
    by = {}
    for r in got.collect():
        by.setdefault(r.id, []).append((r.label, r.code, r.error))
    assert sorted(by, key=str) == [1, 2, 3, 8, None] and len(by[1]) == 2 and len(set(by[1])) == 1
    most = vector_codes.largest_component(8)        # rows by id, the repeat at the end as it begins no codebook
    plain = [(1, [1024] * 8), (2, [512] * 3 + [0] * 5), (3, [0] * 8), (8, [most, -most] * 4), (9, [2048] * 8), (10, [1024] * 8)]
    codes, errors, want = _plain_codes(plain, 4, 3, 4, 1)
    assert [b.tolist() for b in books] == want
    assert [by[i][0][1:] for i in (1, 2, 3, 8, None)] == list(zip(codes, errors, strict=True))[:5]
    errors = vector_codes.label_errors(got)
    assert {r.label for r in errors.collect()} == {"a", "b", "c", None}
    got, books = vector_codes.compress_vectors(frame.limit(0))
    assert got.count() == 0 and sum(b.size for b in books) == 0 and vector_codes.label_errors(got).count() == 0
    got, books = vector_codes.compress_vectors(frame.where("vec_id = 3"))
    assert got.select("code", "error").collect() == [("00000000", 0)]


def _plain_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _plain_groups(count):
    out = {}
    for w, n in count.items():
        near = [v for v in count if _plain_near(w, v)]
        best = min(near, key=lambda v: (-count[v], [ord(c) for c in v]), default=None)
        form = best if best is not None and count[best] >= 2 * n else None
        out[w] = [form, n, len(near), count[form] if form else None]

    def root(w):
        return w if out[w][0] is None else root(out[w][0])
    return {w: (v[0], root(w), *v[1:]) for w, v in out.items()}


def _groups(frame, **kw):
    got = spelling.spelling_groups(frame, **kw).collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


def test_groups_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    count = {}
    for _ in range(700):        # few letters, so that repeats in a row and many neighbours occur
        w = "".join(rng.choice(list("abé"), rng.integers(1, 8)))
        count[w] = int(2 ** rng.integers(0, 9))
    for n in (63, 64, 65, 130):     # around and beyond 32 windows of two
        w = "".join(rng.choice(list("xyzÿ"), n))
        for v in (w, w[1:], w[:n // 2] + "q" + w[n // 2:], w[:-1] + "q", w[:40] + "q" + w[41:]):
            count[v] = int(rng.integers(1, 60))
    frame = spark.createDataFrame(list(count.items()), "word string, n long").repartition(3)
    assert _groups(frame) == _plain_groups(count)


def test_hot_bucket_and_block_borders():
    letters = [chr(c) for c in range(ord("a"), ord("a") + 26)]
    words = sorted(["abc" + x + y for x in letters for y in letters] + ["abc" + x for x in letters])      # one bucket of 702
    rows = np.zeros(len(words), np.int64)
    got = spelling.near_in_buckets(rows + 5, rows + 1, rows, words)         # the window of the last two places
    want = {(a, b) for i, a in enumerate(words) for b in words[i + 1:] if _plain_near(a, b) and max(len(a), len(b)) == 5
            and next(p for p in range(5) if a[p:p + 1] != b[p:p + 1]) // 2 == 1}
    pairs = [tuple(sorted((words[i], words[j]))) for i, j in got]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_groups_of_awkward_rows(spark):
    rows = [("grand", 10, 0, "z"), ("grand", 5, 0, "z"), ("grund", 3, 0, "z"), (None, 4, 0, "z"), ("", 9, 0, "z"), ("a", 1, 0, "z")]
    rows += [(w * 3000, n, 0, "z") for w, n in (("x", 2),)] + [("x" * 2999, 8, 0, "z")]
    frame = spark.createDataFrame(rows, "word string, n long, key long, other string")
    got = _groups(frame)
    assert got["grund"] == ("grand", "grand", 3, 1, 15) and got["grand"][2:4] == (15, 1)
    assert got["a"] == ("", "", 1, 1, 9) and got["x" * 3000][0] == "x" * 2999 and None not in got
    assert spelling.spelling_groups(frame.limit(0)).count() == 0


def test_word_counts_of_texts(spark):
    import zlib
    long = "Straße, " * 40_000
    docs = [(1, "Hello hello HELLO wörld-wide élan é×÷ abcd hello"), (2, None), (3, ""), (None, "hello Hello"), (4, long), (4, long)]
    docs += [(i, "chapter Chapter") for i in range(100, 400)]
    count = {}
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                count[run] = count.get(run, 0) + 1
    frame = spark.createDataFrame([(i, t, "w", 0) for i, t in docs], "doc_id long, text string, word string, n int")
    got = {r.word: r.n for r in spelling.word_counts(frame).collect()}
    assert got == {w: n for w, n in count.items() if n >= 3} and len(got) > 3
    assert spelling.word_counts(frame.limit(0)).count() == 0


def _descend(tokens):
    """Recursive descent over a sound expression: (labels, strictness)."""
    def unit():
        if tokens[0] == "(":
            tokens.pop(0)
            out = either()
            tokens.pop(0)
        else:
            out = ({tokens[0]}, licenses.strictness(tokens.pop(0)))
        while tokens and tokens[0] == "with":
            tokens.pop(0)
            right = unit_only()
            out = ({f"{a}-with-{b}" for a in out[0] for b in right}, out[1] * licenses.EASED)
        return out

    def unit_only():
        if tokens[0] == "(":
            tokens.pop(0)
            out = either()[0]
            tokens.pop(0)
            return out
        return {tokens.pop(0)}

    def both():
        out = unit()
        while tokens and tokens[0] == "and":
            tokens.pop(0)
            right = unit()
            out = (out[0] | right[0], max(out[1], right[1]))
        return out

    def either():
        out = both()
        while tokens and tokens[0] == "or":
            tokens.pop(0)
            right = both()
            out = (out[0] | right[0], min(out[1], right[1]))
        return out
    return either()


def test_expressions_equal_recursive_descent():
    rng = np.random.default_rng(8)
    ids = ["mit", "gpl-3.0-or-later", "apache-2.0", "mpl-2.0", "cc-by-nc-4.0", "weird-1.0", "gpl-2.0+"]

    def make(depth):
        if depth == 0 or rng.random() < 0.3:
            return [str(rng.choice(ids))] + (["with", "classpath-exception-2.0"] if rng.random() < 0.2 else [])
        inner = [*make(depth - 1), str(rng.choice(["and", "or"])), *make(depth - 1)]
        return ["(", *inner, ")"] if rng.random() < 0.5 else inner

    for _ in range(300):
        tokens = make(4)
        labels, strict = _descend(list(tokens))
        assert licenses.evaluate(" ".join(tokens).replace("( ", "(").upper()) == (sorted(labels), strict, True)


def test_unsound_expressions():
    assert licenses.evaluate("MIT some more prose") == (["mit"], 0.25, True)
    assert licenses.evaluate("(MIT OR GPL-2.0") == (["gpl-2.0", "mit"], 0.75, False)
    assert licenses.evaluate("MIT AND") == (["mit"], 0.25, False) and licenses.evaluate("") == ([], 0.0, False)
    assert licenses.evaluate("OR MIT") == ([], 0.0, False) and licenses.evaluate("MIT) OR x")[0] == ["mit"]
    assert licenses.evaluate("MIT.") == (["mit"], 0.25, True)


def _plain_places(text, phrases):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    out = []
    for phrase, label in phrases.items():
        p = phrase.split()
        out += [(label, i) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    return len(words), sorted(out, key=lambda x: (x[1], x[0]))


TEXTS = [None, "", "CC BY", "cc-by cc_by CC  by\tcc\nby xcc by cc byx", "All Rights Reserved. all rights reserved",
         "GNU General Public License, version 3. general public license version 2", "é cc by\x00cc by 中文 CC BY-NC 4.0",
         "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0 WITH LLVM-exception */ x\ncc by",
         "spdx license identifier mit", "License-Expression: BSD-3-Clause and", "cc by " * 60_000, "word " * 200_000, "ÀB cc by"]


def test_places_equal_a_plain_search(spark):
    frame = spark.createDataFrame([(i, t, "l", 0.5, 3) for i, t in enumerate(TEXTS)] + [(None, "cc by", "l", 0.5, 3)] * 2,
                                  "doc_id long, text string, labels string, score double, n_words int").repartition(3)
    rows = {r.doc_id: r for r in licenses.scan_licenses(frame).collect()}
    assert licenses.scan_licenses(frame).count() == frame.count()
    for i, text in enumerate(TEXTS):
        for own, phrases in ((True, licenses.BASE_PHRASES), (False, licenses.PHRASES)):
            n, want = _plain_places(text, phrases)
            assert rows[i].n_words == n
            assert sorted((p.label, p.start) for p in rows[i].places if p.base is own) == sorted(want)
    assert rows[7].labels == ["apache-2.0-with-llvm-exception", "cc-by", "gpl-2.0-only", "mit"]
    assert rows[7].expressions[0].sound and rows[7].expressions[0].strictness == 0.25 and rows[7].score == 0.25
    assert not rows[9].expressions[0].sound and rows[9].labels == ["bsd-3-clause"] and rows[8].expressions == []
    assert rows[4].score == 1.0 and rows[0].score == rows[11].score == 0.0 and rows[None].labels == ["cc-by"]
    assert licenses.scan_licenses(frame.limit(0)).count() == 0


@pytest.mark.parametrize("sf", [TINY])
def test_license_query_is_a_digest_of_the_places(spark, sf):
    got = {r.doc_id: r for r in QUERIES["op13_licenses"](spark, sf).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text")).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        n, places = _plain_places(text, licenses.BASE_PHRASES)
        r, at = got[i], [s for _, s in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(at), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({x for x, _ in places}))
        assert {x for x, _ in places} <= set(r.labels.split(",")) and 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")
