"""Long repeats by winnowing: what two equal windows have in common, found at a fraction of the positions.

A window is `window` consecutive tokens of one document. Of the `gram`-token pieces in a window
the one with the least hash (leftmost among equals) is its anchor; equal windows have equal
anchors at equal places. Consecutive windows with the same anchor make a run, described by

    h       hash of the anchor's tokens
    s       hash of all tokens that the run's windows cover, and of the anchor's place in them
    start   first window's start in the document
    lead    anchor's start less the first window's start
    n       number of windows
    reps    how many such runs follow one another (texts with a period have many)

Runs with equal (h, s) are equal window for window; windows of runs with different h differ.
So only runs with equal h and different s need their tokens compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Tokens of one vectorised step; arrays of this size stay in the processor's cache.
STEP = 1 << 17
#: Positions in a step fit into so many bits below the anchor's hash.
PLACE = np.uint64((1 << 24) - 1)
LONGEST = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all others (the finisher of splitmix64)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


BYTE_TOKENS = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, grown as needed."""
    global _POW, _INV
    if len(_POW) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        size = max(n, 2 * len(_POW))
        _POW = np.concatenate([[_U(1)], np.cumprod(np.full(size - 1, _BASE, dtype=np.uint64))])
        _INV = np.concatenate([[_U(1)], np.cumprod(np.full(size - 1, inverse, dtype=np.uint64))])
    return _POW, _INV


_POW = _INV = np.ones(1, dtype=np.uint64)


def span_hashes(tokens: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of tokens[start:end] for each pair, the same wherever the tokens are."""
    power, inverse = _powers(len(tokens) + 1)
    total = np.zeros(len(tokens) + 1, dtype=np.uint64)
    np.cumsum(tokens * power[: len(tokens)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def grams(tokens: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the `gram` tokens from each place on; gram is a power of two."""
    out, width = tokens, 1
    while width < gram:
        factor = _U(pow(_BASE, width, 1 << 64))
        out = out[:-width] * factor + out[width:] if len(out) > width else out[:0]
        width *= 2
    return mix(out)


def least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of `width` consecutive keys from each place on."""
    out, have = keys, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def runs(tokens: np.ndarray, lengths: np.ndarray, window: int, gram: int):
    """Runs of the pieces that tokens holds one after another: arrays (piece, start, lead, n, h, s, reps)."""
    none = np.zeros(0, dtype=np.int64)
    nothing = (none, none, none, none, none.view(np.uint64), none.view(np.uint64), none)
    if len(tokens) < window:
        return nothing
    ends = np.cumsum(lengths)
    begins = ends - lengths
    hashes = grams(tokens, gram)
    keys = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
    best = least(keys, window - gram + 1)
    valid = np.ones(len(best), dtype=bool)
    for lo, hi in zip(np.maximum(ends - window + 1, begins).tolist(), ends.tolist()):
        valid[lo:hi] = False
    at = np.flatnonzero(valid)
    if not len(at):
        return nothing
    anchor = (best[at] & PLACE).astype(np.int64)
    new = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(at) != 1)) + 1
    first = np.concatenate([[0], new])
    n = np.diff(np.concatenate([first, [len(at)]]))
    start, anchor = at[first], anchor[first]
    lead = anchor - start
    cover = span_hashes(tokens, start, start + n - 1 + window)
    s = mix(cover + lead.astype(np.uint64) * _U(_BASE))
    piece, h = np.searchsorted(ends, start, side="right"), hashes[anchor]
    goes_on = (s[1:] == s[:-1]) & (h[1:] == h[:-1]) & (n[1:] == n[:-1]) & (piece[1:] == piece[:-1])
    first = np.concatenate([[0], np.flatnonzero(~goes_on) + 1])
    reps = np.diff(np.concatenate([first, [len(h)]]))
    piece, start, lead, n, h, s = (x[first] for x in (piece, start, lead, n, h, s))
    return piece, start - begins[piece], lead, n, h, s, reps


def pieces(documents: Iterator[tuple[int, np.ndarray]], window: int, of=None) -> Iterator[tuple[np.ndarray, np.ndarray, list, list]]:
    """Groups of whole documents, or overlapping pieces of long ones: (tokens, lengths, document, offset).
    of: makes tokens of a group's data, so that a long document's are never all there at once."""
    held, lengths, who, offset, size = [], [], [], [], 0
    made = lambda: (np.concatenate(held) if of is None else of(np.concatenate(held)), np.array(lengths), who, offset)
    for name, data in documents:
        if len(data) < window:
            continue
        for lo in range(0, len(data) - window + 1, LONGEST):
            part = data[lo : lo + LONGEST + window - 1]
            held.append(part)
            lengths.append(len(part))
            who.append(name)
            offset.append(lo)
            size += len(part)
            if size >= STEP:
                yield made()
                held, lengths, who, offset, size = [], [], [], [], 0
    if held:
        yield made()


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_tokens(data: np.ndarray) -> np.ndarray:
    """A hash for each word [^\\x20\\x09-\\x0D]+ of a text's UTF-8 bytes."""
    out = []
    lo = 0
    while lo < len(data):
        hi = min(len(data), lo + (1 << 20))
        while hi < len(data) and not _SPACE[data[hi - 1]]:  # a word is never cut
            hi += 1
        part = data[lo:hi]
        inside = ~_SPACE[part]
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        out.append(span_hashes(BYTE_TOKENS[part], edge[::2], edge[1::2]))
        lo = hi
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)
