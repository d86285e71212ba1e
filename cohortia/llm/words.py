"""Words and shingles of many texts at once, as numpy arrays.

Words are runs of bytes other than ASCII white space (0x20, 0x09-0x0D) in the
UTF-8 text with A-Z lower-cased.  A word's hash is a polynomial over its bytes,
found from running sums over the whole batch, so no Python runs per word.
"""

from __future__ import annotations

import numpy as np

from cohortia.llm.tokens import in_steps

ODD = 0xD6E8FEB86659FD93
_POWERS: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next batch."""
    have = _POWERS.get(str(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POWERS[str(base)] = have
    return have[:n]


def drop_powers() -> None:
    _POWERS.clear()


def to_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def words_at(texts: list[str | None]):
    """(hashes, words of each text, all bytes, begin, end) of all words in order."""
    raw = [to_bytes(t) for t in texts]
    whole = b" ".join([*raw, b""]) if raw else b" "
    joined = np.frombuffer(whole, np.uint8)
    space = (joined == 32) | ((joined >= 9) & (joined <= 13))
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1)))
    begin, end = edge[0::2], edge[1::2]
    values = mix64(np.arange(256, dtype=np.uint64) + np.uint64(1))[joined]
    total = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(values * _powers(ODD, len(joined)), out=total[1:])
    inverse = _powers(pow(ODD, -1, 1 << 64), len(joined))
    h = (total[end] - total[begin]) * inverse[begin]
    h = mix64(h + mix64((end - begin).astype(np.uint64)))
    edges = np.cumsum([0, *(len(r) + 1 for r in raw)])
    return h, np.diff(np.searchsorted(begin, edges)), whole, begin, end


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All words' hashes in order, and the number of words of each text."""
    return words_at(texts)[:2]


def shingle_sets(texts: list[str | None], k: int):
    """(begin, end, sets) runs of ``texts``; a set is the sorted distinct hashes of its
    k-word shingles: of all its words if it has fewer, empty if it has none."""
    for lo, hi in in_steps(texts, 2048, 2_000_000):
        h, n = word_hashes(texts[lo:hi])
        rolled = np.zeros(len(h), np.uint64)
        for j in range(k):
            rolled[:len(h) - j] = rolled[:len(h) - j] * np.uint64(ODD) + h[j:]
        rolled = mix64(rolled)
        sets, at = [], 0
        for c in n.tolist():
            if c >= k:
                s = np.sort(rolled[at:at + c - k + 1])
                sets.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            elif c:
                x = np.array([c], np.uint64)
                for v in h[at:at + c]:
                    x = mix64(x * np.uint64(3) ^ v)
                sets.append(x)
            else:
                sets.append(np.zeros(0, np.uint64))
            at += c
        yield lo, hi, sets


def smallest_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component under the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
