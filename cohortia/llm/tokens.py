"""Subword ids inside tasks, each distinct word of a batch encoded once.

For tokenizers that drop white space (``word_bpe_49k``): text between blanks is
encoded on its own and the pieces are concatenated, which gives the ids of the
whole text, special tokens in it included.  Arrow splits a batch, reduces it to its
distinct words and lays out the ids of all its words.  Words of Latin-1 letters alone are
merged as arrays, all of a length together.  Pieces of other Latin-1 words
go to the merges one by one; other scripts are encoded together, parted by a one-token
mark, because a call per word costs more than the merge itself.  Both are cached; a cache that reaches its bound becomes the
older generation, from which words in use move to the new one, so memory does not grow with the vocabulary.
"""

from __future__ import annotations

import gc
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

MARK = "~"
CHUNK_CACHE, PIECE_CACHE, JOIN = 150_000, 150_000, 4096
CUT = b"\xff" * 4          # no id: parts the chunks of a batch
# fixed value: the pre-tokenizer pattern of the vocabulary file, and the line end that parts chunks
PATTERN = regex.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
TAIL = r"([\pL\pN])([,.;:!?]+)(\s)"      # marks that are a piece of their own
LONGEST = 64               # bytes of a word that is merged as an array
_IS_MARK = np.array([b < 128 and chr(b).isprintable() and not chr(b).isalnum() and b != 32 for b in range(256)])
NO_MERGE = np.int32(2 ** 31 - 1)
_OPEN: dict[tuple[str, bool], WordEncoder] = {}


class _Cache:
    """Two generations of at most ``bound`` entries, and what one batch adds."""

    def __init__(self, bound: int, first: dict[str, bytes]):
        self.bound, self.first, self.new, self.old = bound, first, dict(first), {}

    def missing(self, words) -> set[str]:
        """Words without an entry; the others are in the new generation afterwards."""
        if len(self.new) > self.bound:
            self.new, self.old = dict(self.first), self.new
        out = set(words).difference(self.new)
        kept = out.intersection(self.old)
        self.new.update(zip(kept, map(self.old.__getitem__, kept), strict=True))
        return out - kept


class _Merges:
    """Byte-pair merges of many words of Latin-1 letters at once."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str, letters: dict[int, str]):
        """``letters``: how the vocabulary spells a byte."""
        fold = np.arange(256)
        fold[65:91] += 32
        fold[0x80:0x9F] += 32           # the second byte of an upper-case letter
        self.letter = np.zeros(256, bool)
        self.letter[[*range(65, 91), *range(97, 123), 0xC3, *(b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7))]] = True
        self.inner, self.last = np.zeros(256, np.int32), np.zeros(256, np.int32)
        for b in np.flatnonzero(self.letter).tolist():
            self.inner[b], self.last[b] = vocab[letters[int(fold[b])]], vocab[letters[int(fold[b])] + suffix]
        self.size = max(vocab.values()) + 1
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        self.whole = np.array([vocab[a + b] for a, b in merges], np.int32)
        # open addressing: the slot of a pair, or the next free one
        self.bits = max(8, int(16 * len(key)).bit_length())
        self.keys, self.ranks = np.full(1 << self.bits, -1), np.full(1 << self.bits, NO_MERGE)
        left, at = np.arange(len(key)), self._slot(key)
        while len(left):
            free = self.keys[at] < 0
            slot, first = np.unique(at[free], return_index=True)
            some = np.flatnonzero(free)[first]
            self.keys[slot], self.ranks[slot] = key[left[some]], left[some]
            left, at = np.delete(left, some), np.delete(at, some)
            taken = self.keys[at] >= 0
            at[taken] = (at[taken] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key):
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, a, b):
        """Ranks of the merges of the ids ``a`` and ``b``, ``NO_MERGE`` where there is none."""
        key = (a.astype(np.int64) * self.size + b).ravel()
        at = self._slot(key)
        have, out = self.keys[at], self.ranks[at]
        other = np.flatnonzero((have != key) & (have >= 0))
        while len(other):
            at[other] = (at[other] + 1) & ((1 << self.bits) - 1)
            have = self.keys[at[other]]
            out[other] = np.where(have == key[other], self.ranks[at[other]], NO_MERGE)
            other = other[(have != key[other]) & (have >= 0)]
        return out.reshape(a.shape)

    def plain(self, raw, edge, end=None):
        """Which of the words between the ``edge`` places of ``raw`` can be merged here; ``end``: of each, if before its edge."""
        n = np.diff(edge) if end is None else end - edge[:-1]
        out = (n > 0) & (n <= LONGEST)
        odd = np.flatnonzero(~self.letter[raw[:edge[-1]]])
        word = np.searchsorted(edge, odd, "right") - 1
        out[word if end is None else word[odd < end[word]]] = False
        return out

    def __call__(self, raw, begin, n):
        """(ids of the words one after another, number of each, the words in that order).

        Of all words of a length in symbols, longest first, each takes its merge of lowest
        rank, the leftmost of equal ones, and is one symbol shorter; those without one are done."""
        ids, counts, words = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        by_length = np.argsort(n, kind="stable")
        edge = np.searchsorted(n[by_length], np.arange(LONGEST + 2))
        length = int(n.max(initial=0))
        sym, rank, who = np.zeros((0, length), np.int32), np.zeros((0, max(length - 1, 0)), np.int32), words[0]

        def done(sym, who):
            ids.append(sym.ravel())
            counts.append(np.full(len(who), sym.shape[1]))
            words.append(who)

        for m in range(length, 0, -1):
            more = by_length[edge[m]:edge[m + 1]]
            if len(more):
                letters = raw[begin[more][:, None] + np.arange(m)]
                block = self.inner[letters]
                block[:, -1] = self.last[letters[:, -1]]
                sym, who = np.concatenate([sym, block]), np.concatenate([who, more])
                rank = np.concatenate([rank, self.rank(block[:, :-1], block[:, 1:])])
            if m == 1:
                done(sym, who)
                break
            at = rank.argmin(1)
            best = rank[np.arange(len(at)), at]
            go = best != NO_MERGE
            done(sym[~go], who[~go])
            sym, rank, who, at, row = sym[go], rank[go], who[go], at[go], np.arange(int(go.sum()))
            sym[row, at] = self.whole[best[go]]
            keep = np.ones(sym.shape, bool)
            keep[row, at + 1] = False
            sym = sym[keep].reshape(len(row), m - 1)
            keep = np.ones(rank.shape, bool)
            keep[row, at] = False
            rank = rank[keep].reshape(len(row), m - 2)
            r, a = row[at > 0], at[at > 0]
            rank[r, a - 1] = self.rank(sym[r, a - 1], sym[r, a])
            r, a = row[at < m - 2], at[at < m - 2]
            rank[r, a] = self.rank(sym[r, a], sym[r, a + 1])
        return np.concatenate(ids), np.concatenate(counts), np.concatenate(words)


class WordEncoder:
    """``encode(texts)``: little-endian uint32 ids of each text, as bytes.

    With ``special`` (the tokenizer's default) the name of a special token in a text gives
    its id, without it the ids of its letters.  Texts may be in any script.
    """

    def __init__(self, path: str, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not special
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()] if special else []
        self.mark = self.tok.encode(MARK, add_special_tokens=False).ids
        if len(self.mark) != 1 or any(len(s.split()) != 1 for s in self.special):
            raise ValueError(f"{path}: {MARK!r} is not one token, or a special token holds white space")
        # texts whose ids hang on case or on what follows a letter: combining marks (the dotted I becomes one) and special tokens
        self.cased = "|".join([r"\pM|İ", *(f"(?i:{regex.escape(x)})" for x in self.special)])
        # no special token can stand in letters with marks after them
        self.marks_apart = not any(regex.fullmatch(r"\pL*[^\pL\pN]+", x) for x in self.special)
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(256)}     # bytes as the merges spell them
        self.merges = self._array_merges(path)
        self.chunks = _Cache(CHUNK_CACHE, {"": b""})
        self.pieces = _Cache(PIECE_CACHE, {"\n": CUT})
        gc.set_threshold(200_000, 20, 100)      # the caches hold no cycles; walking them often costs more than encoding

    def _array_merges(self, path: str) -> _Merges | None:
        """None for a model that does more than merge, or that can't spell every letter."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        if (model["type"] != "BPE" or any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "ignore_merges"))
                or any(x.isalpha() for x in self.special)):
            return None
        letters = {b: self.letters[b][-1] for b in range(192)} | {0xC3: self.letters[0xC0][0]}
        suffix, vocab = model.get("end_of_word_suffix") or "", model["vocab"]
        if any(x + end not in vocab for x in letters.values() for end in ("", suffix)):
            return None
        return _Merges(vocab, [x.split(" ") if isinstance(x, str) else x for x in model["merges"]], suffix, letters)

    def _plain(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of words without blanks, special tokens or the mark; the mark's own id parts them."""
        out = []
        for at in range(0, len(words), JOIN):
            part = words[at:at + JOIN]
            ids = np.array(self.tok.encode(f" {MARK} ".join(part), add_special_tokens=False).ids, "<u4")
            cut = np.flatnonzero(ids == self.mark[0])
            raw, ends = ids.tobytes(), [*(4 * cut).tolist(), 4 * len(ids)]
            begins = [0, *(4 * cut + 4).tolist()]
            out += [raw[b:e] for b, e in zip(begins, ends, strict=True)]
        return out

    def _merge(self, pieces: list[str]) -> list[bytes]:
        """Ids of lower-case Latin-1 pieces."""
        merge, ids, ends = self.tok.model.tokenize, [], []
        for p in pieces:
            ids += [t.id for t in merge(p if p.isascii() and p.isprintable() else p.translate(self.letters))]
            ends.append(4 * len(ids))
        raw = np.array(ids, "<u4").tobytes()
        return [raw[a:z] for a, z in zip([0, *ends], ends, strict=False)]

    def _fill(self, chunks: set[str]) -> None:
        """Pieces of Latin-1 chunks are shared between chunks; others are encoded whole."""
        known, joined = self.chunks.new, "\n".join(chunks)
        odd = [x for x in self.special if x in joined]
        hard = [c for c in chunks if any(x in c for x in odd)] if odd else []
        if not joined.isascii():
            wide = [c for c in chunks if not c.isascii() and max(c) > "\xff"]
            hard += [c for c in wide if MARK in c]
            easy = list(set(wide).difference(hard))
            known.update(zip(easy, self._together(easy), strict=True))
            chunks = chunks.difference(wide)
        known.update((c, self._plain(c)) for c in hard)
        rest = list(chunks.difference(hard))
        if rest:
            flat = PATTERN.findall("\n".join(rest).lower())
            need = list(self.pieces.missing(flat))
            self.pieces.new.update(zip(need, self._merge(need), strict=True))
            known.update(zip(rest, b"".join(map(self.pieces.new.__getitem__, flat)).split(CUT), strict=True))

    def _words(self, words: pa.LargeStringArray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """Ids of distinct words, and the place of each word's in them."""
        at, plain = np.empty(len(words), np.int64), np.zeros(len(words), bool)
        flat = counts = order = np.zeros(0, np.int64)
        if self.merges is not None and len(words):
            edge = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
            raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)
            plain = self.merges.plain(raw, edge)
            of = np.flatnonzero(plain)
            flat, counts, order = self.merges(raw, edge[of], np.diff(edge)[of])
            order = of[order]
        rest = words.filter(pa.array(~plain)).to_numpy(zero_copy_only=False).tolist()     # far faster than to_pylist
        miss = self.chunks.missing(rest)
        if miss:
            self._fill(miss)
        at[order], at[~plain] = np.arange(len(order)), len(order) + np.arange(len(rest))
        merged = pa.Array.from_buffers(pa.large_binary(), len(order), [
            None, pa.py_buffer(np.append(0, np.cumsum(4 * counts)).astype(np.int64)), pa.py_buffer(flat.astype("<u4"))])
        return pa.concat_arrays([merged, pa.array(list(map(self.chunks.new.__getitem__, rest)), pa.large_binary())]), at

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not texts:
            return []
        column = pa.array([t or "" for t in texts], pa.large_string())
        if not pc.any(pc.match_substring_regex(column, self.cased)).as_py():
            # fewer distinct words: marks at a word's end apart, and one case
            column = pc.ascii_lower(pc.replace_substring_regex(column, TAIL, r"\1 \2\3"))
        parts = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        coded = parts.flatten().dictionary_encode()
        ids, at = self._words(coded.dictionary)
        ids = ids.take(pa.array(at[coded.indices.to_numpy()]))
        ends = np.frombuffer(ids.buffers()[1], np.int64)[parts.offsets.to_numpy()].tolist()
        raw = ids.buffers()[2].to_pybytes() if ends[-1] else b""
        return [raw[a:z] for a, z in zip(ends[:-1], ends[1:], strict=True)]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each) of UTF-8 words without blanks.  Words of letters that can be
        merged as arrays are never made strings; marks at their end are pieces of their own."""
        edge = np.append(0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words))))
        flat = counts = order = marked = which = np.zeros(0, np.int64)
        plain, marks = np.zeros(len(words), bool), {}
        if self.merges is not None and len(words):
            raw = np.frombuffer(b"".join(words), np.uint8)
            end = edge[1:]
            if self.marks_apart:
                last = np.append(0, np.maximum.accumulate(np.where(_IS_MARK[raw], 0, np.arange(1, len(raw) + 1))))
                end = np.maximum(last[end], edge[:-1])
            plain = self.merges.plain(raw, edge, end)
            of, n = np.flatnonzero(plain), end - edge[:-1]
            flat, counts, order = self.merges(raw, edge[of], n[of])
            order = of[order]
            marked = np.flatnonzero(plain & (end < edge[1:]))
            which = np.array([marks.setdefault(words[i][k:], len(marks)) for i, k in zip(marked.tolist(), n[marked].tolist(), strict=True)], np.int64)
        rest = np.flatnonzero(~plain)
        coded = self.encode([*(x.decode() for x in marks), *(words[i].decode("utf-8", "replace") for i in rest.tolist())])
        own, more = np.array([len(x) // 4 for x in coded], np.int64), np.frombuffer(b"".join(coded), "<u4")
        each, after = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        each[order], each[rest], after[marked] = counts, own[len(marks):], own[which]
        begin = np.cumsum(each + after) - each - after
        ids = np.empty(int(each.sum() + after.sum()), np.int64)

        def put(at, n, values):
            ids[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(len(values))] = values

        put(begin[order], counts, flat)
        put(begin[rest], own[len(marks):], more[own[:len(marks)].sum():])
        first = (np.cumsum(own) - own)[which]
        n = own[which]
        put(begin[marked] + each[marked], n, more[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())])
        return ids, each + after


def encoder(path: str, special: bool = True) -> WordEncoder:
    """The worker process's encoder for a vocabulary file."""
    if (path, special) not in _OPEN:
        _OPEN[path, special] = WordEncoder(path, special)
    return _OPEN[path, special]


def close_encoders() -> None:
    """Empty the worker's caches, for a task whose worker goes on with other work."""
    _OPEN.clear()


def any_open() -> bool:
    return bool(_OPEN)


def in_steps(texts: list, step: int = 512, chars: int = 4_000_000):
    """Cut a batch into (begin, end) runs of bounded count and length."""
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and (i - begin >= step or size + len(t or "") > chars):
            yield begin, i
            begin, size = i, 0
        size += len(t or "")
    if begin < len(texts):
        yield begin, len(texts)
