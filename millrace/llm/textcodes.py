"""Words of a batch of texts as numbers, found with array operations instead of a loop.

A text is cut into chunks, each a run of ASCII white space followed by a run of other bytes; only
the last may be white space alone. The chunks of a text give it back when put together. Equal
chunks get equal codes, so what is worked out for a word is worked out once per batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from millrace.llm.support import text_buffer

#: Space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True


@dataclass
class Chunks:
    """``codes[first[d]:first[d + 1]]`` are the chunks of text d, as positions in ``words``."""

    body: np.ndarray
    at: np.ndarray
    first: np.ndarray
    codes: np.ndarray
    words: list[bytes]


def chunks(texts: pa.Array) -> Chunks:
    body, at = text_buffer(texts)
    space = IS_SPACE[body]
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    starts_of_texts = at[:-1][at[1:] > at[:-1]]
    begins[starts_of_texts] = True
    starts = np.flatnonzero(begins)
    bounds = np.append(starts, len(body)).astype(np.int32)
    whole = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(body))])
    coded = whole.dictionary_encode()
    return Chunks(body, at, np.searchsorted(starts, at), coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist())


@dataclass
class Words:
    """Words (no white space) of each text: ``codes[first[d]:first[d + 1]]`` into ``words``."""

    first: np.ndarray
    codes: np.ndarray
    words: list[bytes]


def words(parts: Chunks) -> Words:
    """The words of the chunks; equal words after different white space get the same code."""
    known: dict[bytes, int] = {}
    of_chunk = np.empty(len(parts.words), np.int64)
    for i, chunk in enumerate(parts.words):
        word = chunk.lstrip(SPACES)
        of_chunk[i] = known.setdefault(word, len(known)) if word else -1
    codes = of_chunk[parts.codes] if len(parts.codes) else np.empty(0, np.int64)
    kept = codes >= 0
    before = np.concatenate(([0], np.cumsum(kept)))
    return Words(before[parts.first], codes[kept], list(known))
