"""Words and character n-grams of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Texts are handled in runs of about so many bytes; one longer text is a run of its own.
RUN_BYTES = 1_000_000
#: ... and of so many texts at most, as some arrays have a row for each.
RUN_TEXTS = 512
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)

#: Letters keep their byte (A-Z lower-cased), bytes of characters beyond ASCII too; all else is a blank.
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
#: Shapes: small and large letters and digits are one class each, marks stay, white space is a blank.
_SHAPES = np.arange(256).astype(np.uint8)
_SHAPES[97:123] = _SHAPES[128:] = ord("a")
_SHAPES[65:91] = ord("A")
_SHAPES[48:58] = ord("0")
_SHAPES[9:14] = 32


def runs(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of texts with about ``RUN_BYTES`` bytes and at most ``RUN_TEXTS`` texts."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= RUN_BYTES or i + 1 - start >= RUN_TEXTS:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _blanked(texts: list[bytes], table: np.ndarray = _LETTERS) -> tuple[np.ndarray, np.ndarray]:
    """The mapped bytes of all texts with a blank after each, and the text number of each byte."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    letters = table[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    return letters, np.repeat(np.arange(len(texts), dtype=np.int32), sizes)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, byte length) of every word; words are runs of letters."""
    return _spans(*_blanked(texts))


def shape_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for the shapes of words between white space, runs of one class counting once."""
    letters, owner = _blanked(texts, _SHAPES)
    keep = np.ones(len(letters), bool)
    keep[1:] = letters[1:] != letters[:-1]
    return _spans(letters[keep], owner[keep])


def _spans(letters: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.zeros(len(letters) + 2, bool)
    inside[1:-1] = letters != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    return owner[starts], _word_values(letters, starts, ends), ends - starts


def _word_values(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a difference of polynomial prefix sums, moved to place 0."""
    n = len(letters)
    powers = np.empty(n + 1, np.uint64)
    powers[0] = 1
    powers[1:] = _BASE
    np.cumprod(powers, out=powers)
    back = np.empty(n + 1, np.uint64)
    back[0] = 1
    back[1:] = _INVERSE
    np.cumprod(back, out=back)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(letters * powers[:-1], out=prefix[1:])
    value = (prefix[ends] - prefix[starts]) * back[starts]
    value ^= value >> np.uint64(31)
    value *= _MIX
    value ^= value >> np.uint64(29)
    return value


def word_hash(word: str) -> int:
    """The hash of one word, as ``word_hashes`` gives it."""
    return int(word_hashes([word.lower().encode()])[1][0])


def ngram_counts(texts: list[bytes], width: int) -> np.ndarray:
    """Counts of hashed byte 1- to 3-grams, one row of ``width`` cells for each text.

    Blanks are collapsed, and count as the edge of a word inside an n-gram; an n-gram has at
    least one letter and never spans two texts.
    """
    letters, owner = _blanked(texts)
    keep = letters != 32
    keep[1:] |= letters[:-1] != 32
    letters, owner = letters[keep].astype(np.uint32), owner[keep].astype(np.int64)
    counts = np.zeros(len(texts) * width, np.int64)
    gram = letters
    for n in (1, 2, 3):
        if n > 1:
            gram = gram[:-1] * np.uint32(257) + letters[n - 1:]
        inside = owner[n - 1:] == owner[:len(gram)]
        if n == 1:
            inside = letters != 32
        slot = (gram * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(8)
        at = owner[:len(gram)] * width + slot % np.uint32(width)
        counts += np.bincount(at[inside], minlength=len(counts))
    return counts.reshape(len(texts), width)
