"""Word-shingle sets as sorted 64-bit hashes, computed with numpy over a batch of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
_U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
FACTORS = [_U(f) for f in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
#: Texts are hashed in runs of about this many bytes.
RUN_BYTES = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class _Powers:
    """Powers of BASE and of its inverse modulo 2**64, as many as were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
                p = np.full(n, _U(base), dtype=np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up[:n], self.down[:n]


POWERS = _Powers()


def _run(texts: list[bytes], words: int) -> list[np.ndarray]:
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    low = raw + np.where((raw >= 65) & (raw <= 90), np.uint8(32), np.uint8(0))
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]  # the last byte is a blank, so each word ends
    up, down = POWERS.get(len(raw))
    value = low.astype(np.uint64) + _U(1)
    value[blank] = 0
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(value * up, dtype=np.uint64)])
    word = mix64((sums[ends] - sums[starts]) * down[starts] + _U(words))
    lengths = np.array([len(t) + 1 for t in texts])
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    of = np.searchsorted(offsets, starts, side="right") - 1
    n_words = np.bincount(of, minlength=len(texts))
    k = len(word) - words + 1
    if k > 0:
        acc = np.zeros(k, dtype=np.uint64)
        for i in range(words):
            acc += word[i : i + k] * FACTORS[i % len(FACTORS)] + _U(i)
        inside = of[:k] == of[words - 1 :]
        sh, at = mix64(acc[inside]), of[:k][inside]
    else:
        sh, at = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    cut = np.searchsorted(at, np.arange(len(texts) + 1))
    first = np.concatenate([[0], np.cumsum(n_words)])
    out = []
    for i, n in enumerate(n_words):
        if n >= words:
            out.append(np.unique(sh[cut[i] : cut[i + 1]]))
        elif n:
            own = word[first[i] : first[i + 1]]
            whole = (own * np.array(FACTORS[:n], dtype=np.uint64)).sum(dtype=np.uint64) + _U(1000 + n)
            out.append(mix64(np.array([whole], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def shingle_sets(texts, words: int = WORDS) -> Iterator[np.ndarray]:
    """For each text (null: empty) the sorted distinct hashes of its shingles of ``words`` words (at most five),
    lower-cased in A-Z; a text with fewer words has its whole sequence as one, a text without words none."""
    run, size = [], 0
    for t in texts:
        b = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        run.append(b)
        size += len(b)
        if size >= RUN_BYTES:
            yield from _run(run, words)
            run, size = [], 0
    if run:
        yield from _run(run, words)
