"""Words of many texts as numbers, cut by sets of ASCII bytes and found with array operations."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from millrace.llm.support import text_buffer


@dataclass
class CodedWords:
    """``codes[first[d]:first[d + 1]]`` are the words of text d, as positions in ``words``."""

    first: np.ndarray
    codes: np.ndarray
    #: Whether a break, or the start of a text, stands before each word.
    begins: np.ndarray
    words: pa.BinaryArray


def byte_set(members: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(members)] = True
    return found


def coded_words(texts: pa.Array, gaps: bytes, breaks: bytes = b"") -> CodedWords:
    """Words between ``gaps`` and ``breaks``, with A-Z in lower case; equal words get equal codes."""
    body, at = text_buffer(texts)
    body = body + ((body >= ord("A")) & (body <= ord("Z"))).view(np.uint8) * np.uint8(32)
    stops = byte_set(breaks)[body]
    inside = ~(stops | byte_set(gaps)[body])
    text_starts = at[:-1][at[1:] > at[:-1]]
    edges = np.empty(len(body) + 1, bool)
    edges[:-1], edges[-1] = inside, False
    edges[1:-1] &= ~inside[:-1]
    edges[text_starts] = inside[text_starts]
    starts = np.flatnonzero(edges[:-1])
    edges[1:], edges[0] = inside, False
    edges[1:-1] &= ~inside[1:]
    ends_of_texts = at[1:][at[1:] > at[:-1]]
    edges[ends_of_texts] = inside[ends_of_texts - 1]
    lengths = np.flatnonzero(edges) - starts
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    # A text's first byte counts as a break, and may be the word's own.
    stops[text_starts] = True
    seen = np.searchsorted(np.flatnonzero(stops), starts, side="right")
    fresh = np.ones(len(starts), bool)
    fresh[1:] = seen[1:] != seen[:-1]
    coded = binary_slices(body[inside], offsets).dictionary_encode()
    return CodedWords(np.searchsorted(starts, at), coded.indices.to_numpy(zero_copy_only=False), fresh, coded.dictionary)


def binary_slices(body: np.ndarray, offsets: np.ndarray) -> pa.BinaryArray:
    """The pieces of ``body`` between ``offsets``."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(body))])
