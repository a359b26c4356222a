"""Word hashes of Arrow text columns in NumPy.

A word is a maximal run of 0-9, a-z (after lower-casing A-Z) and characters from U+0080 up.
In UTF-8 all bytes of the latter are >= 0x80, so words are runs of bytes of one class.  The
hash of a word is a polynomial in its bytes modulo 2^64, taken from prefix sums and then
mixed, so that whole batches are hashed without a loop over words.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
SEGMENT = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE, WORD, PUNCT = 0, 1, 2
CLASS = np.full(256, PUNCT, np.uint8)
CLASS[:33] = SPACE
CLASS[48:58] = CLASS[65:91] = CLASS[97:123] = WORD
CLASS[128:] = WORD

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    if len(_powers.get(name, ())) < n:
        p = np.full(n, base, _U)
        p[0] = 1
        _powers[name] = np.cumprod(p, dtype=_U)
    return _powers[name]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def tokens(offsets: np.ndarray, data: np.ndarray, punctuation: bool = False, classes: np.ndarray = CLASS):
    """(hash, text index, first byte, last byte + 1) of every word of the texts, in order.

    ``offsets`` and ``data`` are those of ``common.utf8_parts``.  With ``punctuation`` runs of
    other non-blank ASCII are tokens too; ``classes`` changes the class of bytes.  Work is done
    in segments of about 1 MB that end where a token ends, so a very long text needs no more
    memory than its words' hashes.
    """
    cls = classes[data]
    n = len(data)
    begins = np.zeros(n + 1, bool)
    if n:
        begins[0] = True
        begins[1:n] = cls[1:] != cls[:-1]
        begins[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(begins[:n])
    ends = np.append(starts[1:], n)
    keep = cls[starts] >= WORD if punctuation else cls[starts] == WORD
    starts, ends = starts[keep], ends[keep]
    hashes = np.empty(len(starts), _U)
    at = 0
    while at < len(starts):
        stop = max(int(np.searchsorted(ends, starts[at] + SEGMENT, "right")), at + 1)
        lo, hi = starts[at], ends[stop - 1]
        size = max(hi - lo + 1, SEGMENT + 1)
        sums = np.zeros(hi - lo + 1, _U)
        np.cumsum((LOWER[data[lo:hi]].astype(_U) + _U(1)) * _power("up", BASE, size)[:hi - lo], out=sums[1:])
        a, b = starts[at:stop] - lo, ends[at:stop] - lo
        hashes[at:stop] = (sums[b] - sums[a]) * _power("down", pow(BASE, -1, 1 << 64), size)[a]
        at = stop
    doc = np.searchsorted(offsets, starts, "right") - 1
    return mix(hashes + (ends - starts).astype(_U)), doc, starts, ends


def grams(hashes: np.ndarray, doc: np.ndarray, n: int):
    """(hash, text index) of every run of ``n`` words inside one text."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    out = np.zeros(m, _U)
    for i in range(n):
        out = out * _U(0xD6E8FEB86659FD93) + hashes[i:i + m]
    same = doc[:m] == doc[n - 1:]
    return mix(out[same]), doc[:m][same]
