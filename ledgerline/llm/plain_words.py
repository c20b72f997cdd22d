"""Words of letters, digits and non-ASCII characters as one normalised buffer.

A-Z is lower-cased, words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  In the
buffer each word is followed by one space, the last word of a text by a line
feed, so a run of words is a slice and no slice of words crosses texts.
"""

from __future__ import annotations

import numpy as np

from .arrays import lower_ascii

IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


def normalised(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The buffer, start and end of each word in it, and the ``n + 1`` word
    numbers at which texts begin.  ``bounds`` are the byte offsets of texts."""
    low = lower_ascii(data)
    inside = IN_WORD[low]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    first[cuts] |= inside[cuts]
    number = np.cumsum(first)
    begins = np.concatenate(([0], number))[bounds]
    of = number[inside] - 1
    size = np.bincount(of, minlength=int(number[-1]) if len(number) else 0)
    starts = np.concatenate(([0], np.cumsum(size + 1)[:-1])) if len(size) else np.empty(0, np.int64)
    buffer = np.full(int(size.sum()) + len(size), 32, np.uint8)
    buffer[np.arange(len(of)) + of] = low[inside]
    ends = starts + size
    buffer[ends[begins[1:][begins[1:] > begins[:-1]] - 1]] = 10
    return buffer, starts, ends, begins
