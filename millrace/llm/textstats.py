"""Statistics of many texts at once, on UTF-8 bytes."""

from __future__ import annotations

import numpy as np

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
_NOT_COUNTED = SPACE + bytes(range(0x80, 0xC0))  # white space and continuation bytes
_PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def word_chars(text: bytes) -> int:
    """Code points inside words."""
    return len(text.translate(None, _NOT_COUNTED))


def symbols(text: bytes) -> int:
    return len(text) - len(text.translate(None, SYMBOLS))


def lines(text: bytes) -> list[bytes]:
    """Lines that hold a word."""
    return [x for x in text.split(b"\n") if x.strip()]


def repeated_words(words: list[list[bytes]], size: int = 5) -> np.ndarray:
    """Per text: words inside windows of ``size`` words that the text holds twice or more."""
    counts = np.fromiter(map(len, words), np.int64, len(words))
    total = int(counts.sum())
    out = np.zeros(len(words), np.int64)
    if total < size:
        return out
    hashes = np.concatenate([np.fromiter(map(hash, w), np.int64, len(w)) for w in words]).view(np.uint64)
    text = np.repeat(np.arange(len(words)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(total)  # words from here to the end of the text
    at = np.flatnonzero(left >= size)
    with np.errstate(over="ignore"):
        key = text[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for i in range(size):
            key = (key ^ hashes[at + i]) * _PRIMES[i % len(_PRIMES)]
            key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(total, bool)
    for i in range(size):
        covered[at[twice] + i] = True
    np.add.at(out, text[covered], 1)
    return out
