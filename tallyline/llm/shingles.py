"""Words and word shingles of many texts at once, as 64-bit hashes.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased. A word's hash is a
polynomial over random values of its UTF-8 bytes, taken from prefix sums of the whole
batch; a shingle's is a mix of its words' hashes. All are functions of the text alone,
the same in every process.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
_MASK = (1 << 64) - 1
_R = 0x9E3779B97F4A7C13  # 3 modulo 8, so that powers stay apart in the high bits
_R_INVERSE = pow(_R, -1, 1 << 64)
_CHUNK = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have = 1
    with np.errstate(over="ignore"):
        while have < n:
            more = min(have, n - have)
            out[have : have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
            have += more
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_rng = np.random.default_rng(7)
_VALUE = _rng.integers(1, 1 << 63, 256, np.uint64)
_VALUE[65:91] = _VALUE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_TIMES = _rng.integers(1, 1 << 63, WIDTH, np.uint64) | np.uint64(1)
_SHORT = _rng.integers(1, 1 << 63, WIDTH, np.uint64)
_POWERS = [_powers(_R, 1), _powers(_R_INVERSE, 1)]


def words(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, and where each text's begin in them (one more entry for the end)."""
    joined = b" ".join(raws) + b" "
    codes = np.frombuffer(joined, np.uint8)
    n = len(codes)
    if len(_POWERS[0]) < n + 1:
        _POWERS[:] = [_powers(_R, n + n // 4 + 1), _powers(_R_INVERSE, n + n // 4 + 1)]
    space = _SPACE[codes]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUE[codes] * _POWERS[0][:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * _POWERS[1][starts] + (ends - starts).astype(np.uint64))
    sizes = np.fromiter(map(len, raws), np.int64, len(raws)) + 1
    begins = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
    return hashes, begins


def shingle_sets(raws: list[bytes]) -> list[np.ndarray]:
    """The distinct shingles of each text, ascending. Fewer words than ``WIDTH`` are one shingle, none are none."""
    hashes, begins = words(raws)
    out = []
    with np.errstate(over="ignore"):
        n = len(hashes) - WIDTH + 1
        rolled = np.zeros(max(n, 0), np.uint64)
        for k in range(WIDTH):
            if n > 0:
                rolled += hashes[k : k + n] * _TIMES[k]
        rolled = mix(rolled)
        for a, b in zip(begins.tolist(), begins[1:].tolist(), strict=False):
            if b - a >= WIDTH:
                got = np.sort(rolled[a : b - WIDTH + 1])
                if len(got) > 1:
                    fresh = np.empty(len(got), bool)
                    fresh[0] = True
                    np.not_equal(got[1:], got[:-1], out=fresh[1:])
                    got = got[fresh]
                out.append(got)
            elif b > a:
                out.append(mix(np.atleast_1d((hashes[a:b] * _TIMES[: b - a]).sum(dtype=np.uint64) + _SHORT[b - a])))
            else:
                out.append(np.zeros(0, np.uint64))
    return out
