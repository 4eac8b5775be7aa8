"""Counts over one text, shared by the quality operators."""

from __future__ import annotations

import math
import zlib

import numpy as np

SPACES = " \t\n\r\v\f"
#: Fixed set of characters counted as symbols.
SYMBOLS = "#*$%&|<>"
REPEAT = 3


def repeat_mask(hashes: np.ndarray, width: int = REPEAT) -> np.ndarray:
    """Which words stand in a window of ``width`` words that the text has twice or more."""
    n = len(hashes) - width + 1
    mask = np.zeros(len(hashes), bool)
    if n < 2:
        return mask
    with np.errstate(over="ignore"):
        window = np.zeros(n, np.uint64)
        for k in range(width):
            window = window * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
            window ^= window >> np.uint64(29)
    order = np.argsort(window)
    same = window[order[1:]] == window[order[:-1]]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    for k in range(width):
        mask[k : k + n] |= twice
    return mask


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)


def line_counts(text: str) -> tuple[int, int]:
    """Lines with a word, and those among them equal to an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines), len(lines) - len(set(lines))


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    repeated = int(repeat_mask(word_hashes(words)).sum()) if len(words) > REPEAT else 0
    return len(words), chars, symbols, line_counts(text)[1], repeated


#: Names of ``features``, in order.
FEATURES = (
    "log_words", "log_chars", "word_length", "long_words", "upper", "upper_words", "digits", "symbols", "pipes", "bangs", "punctuation",
    "non_ascii", "lines", "line_words", "dup_lines", "repeated", "distinct", "top_word", "stops", "ended_lines", "compression", "entropy", "short_words", "one_word_lines",
)
_KIND = np.zeros(256, np.uint8)
for _kind, _bytes in ((1, b"abcdefghijklmnopqrstuvwxyz"), (2, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (3, b"0123456789"), (4, SYMBOLS.encode()), (5, b"!\"'()+,-./:;=?@[\\]^_`{}~"), (6, SPACES.encode()), (7, bytes(range(128, 256)))):
    _KIND[list(_bytes)] = _kind


def features(text: str) -> list[float]:
    """Statistics of a text of any length, all finite; an empty text has zeros."""
    raw = text.encode()
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    codes = np.frombuffer(raw, np.uint8)
    by_byte = np.bincount(codes, minlength=256)
    kinds = np.bincount(_KIND, weights=by_byte, minlength=8)
    chars = max(1.0, len(raw) - kinds[6])
    letters = max(1.0, kinds[1] + kinds[2] + kinds[7])
    sizes = np.fromiter(map(len, words), np.int64, n)
    hashes = word_hashes(words)
    _, counts = np.unique(hashes, return_counts=True)
    p = by_byte[by_byte > 0] / len(raw)
    lines, dup = line_counts(text)
    lines = max(1, lines)
    upper_words = sum(w.isupper() for w in words)
    ended = text.count(".\n") + text.count("?\n") + text.count("!\n") + text.rstrip().endswith((".", "?", "!"))
    single = sum(len(line.split(None, 2)) == 1 for line in text.split("\n"))
    return [
        math.log1p(n), math.log1p(len(raw)), chars / n, float((sizes > 12).mean()), kinds[2] / letters, upper_words / n, kinds[3] / chars, kinds[4] / chars,
        by_byte[124] / n, by_byte[33] / n, kinds[5] / chars, kinds[7] / chars, math.log1p(lines), math.log1p(n / lines), dup / lines, float(repeat_mask(hashes).mean()),
        len(counts) / n, counts.max() / n, float(counts[counts > max(2, n // 100)].sum() / n), ended / lines, len(zlib.compress(raw, 1)) / len(raw), float(-(p * np.log2(p)).sum()),
        float((sizes <= 3).mean()), single / lines,
    ]
