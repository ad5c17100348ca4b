"""Words of many texts as 64-bit hashes, by array arithmetic on their bytes.

A word is a run of letters and digits of any script; Unicode punctuation, signs and
spaces end it, and each character of a script written without blanks is a word of its
own. ``lowered`` sets those apart with ASCII blanks, so that in its bytes a word is a
run of ASCII letters and digits and of bytes beyond ASCII. The hash of a word is a
polynomial of its bytes, taken from running sums over the block.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

MULTIPLIER = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
BLOCK = 1 << 16


# Neither ASCII nor a letter, digit or mark; then Thai and Lao, Myanmar, Khmer, kana, Han.
_BREAK = r"[^\x00-\x7F\p{L}\p{N}\p{M}]"
_ALONE = r"([\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}])"


def lowered(text: Column) -> Column:
    """The bytes that words are read from; full stops and marks of other scripts become ASCII ones."""
    lower = F.translate(F.lower(F.coalesce(text, F.lit(""))), "\u3002\uff0e\uff01\uff1f", "..!?")
    return F.regexp_replace(F.regexp_replace(lower, _BREAK, " "), _ALONE, " $1 ").cast("binary")


def _word_bytes() -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        table[low:high] = True
    return table


IN_WORD = _word_bytes()


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


POWERS = powers(MULTIPLIER, BLOCK + 1)
INVERSES = powers(INVERSE, BLOCK + 1)


def _block_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word of at most BLOCK bytes."""
    inside = IN_WORD[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * POWERS[: len(data)], out=sums[1:])
    mixed = (sums[ends] - sums[starts]) * INVERSES[starts]
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29)), starts, ends


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of all words of a lower-cased UTF-8 text of any length.

    Blocks end between words; a single run longer than a block is cut into words of a
    block's length, the same way wherever it stands.
    """
    whole = np.frombuffer(data, np.uint8)
    found, at = [], 0
    while at < len(whole):
        end = min(len(whole), at + BLOCK)
        if end < len(whole):
            gaps = np.flatnonzero(~IN_WORD[whole[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
        hashes, starts, ends = _block_words(whole[at:end])
        found.append((hashes, starts + at, ends + at))
        at = end
    if not found:
        empty = np.empty(0, np.int64)
        return np.empty(0, np.uint64), empty, empty
    return tuple(np.concatenate(parts) for parts in zip(*found))
