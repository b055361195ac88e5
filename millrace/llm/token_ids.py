"""Token ids of whole texts by a public tokenizer file, with each distinct word encoded once.

A text is cut before each run of ASCII white space (see ``textcodes``). The tokenizers used here
never join what such a cut separates, unless other white space stands right before it; those rare
texts are encoded whole.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex

from millrace.llm.textcodes import SPACES, Chunks, chunks

MOST_CACHED = 160_000
MARKS = ".,;:!?"
# Fixed value: how byte-level tokenizers split a text.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_encoders: dict[str, Encoder] = {}
_cache: dict[tuple[str, bool], WordCache] = {}


class WordCache:
    """Ids of words as bytes, in two generations: when the younger is full, the older goes, and what is in use moves up."""

    def __init__(self, most: int = MOST_CACHED):
        self.most = most
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, words: list[bytes], encode_words: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
        if len(self.young) + len(words) > self.most:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        missing = []
        for word in words:
            if word not in young:
                held = old.get(word)
                if held is None:
                    missing.append(word)
                else:
                    young[word] = held
        missing = list(dict.fromkeys(missing))
        for start in range(0, len(missing), 4096):
            batch = missing[start : start + 4096]
            young.update(zip(batch, encode_words(batch)))
        return [young[w] for w in words]


class Encoder:
    """A tokenizer file whose normaliser and splitting are asked once per word and whose merges once per piece.

    The library's own normaliser and model are used. Its splitting is the file's pattern, applied here
    with the ``regex`` module; a byte-level file writes each byte of a piece as one printable character.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as file:
            splitting = json.load(file)["pre_tokenizer"]
        steps = splitting.get("pretokenizers", [splitting])
        patterns = [x["pattern"]["Regex"] for x in steps if x["type"] == "Split" and x["invert"] and x["behavior"] == "Removed"]
        patterns += [BYTE_LEVEL_PATTERN for x in steps if x["type"] == "ByteLevel" and x["use_regex"] and not x["add_prefix_space"]]
        #: Files split in another way are left to the library as a whole.
        self.pattern = regex.compile(patterns[0]) if len(patterns) == 1 and steps[-1]["type"] == "ByteLevel" else None
        self.normaliser, self.model = self.whole.normalizer, self.whole.model
        self.most = MOST_CACHED
        self.pieces: dict[str, bytes] = {}
        self.character = byte_characters()
        #: ASCII is normalised and written character by character.
        self.plain = {c: chr(c) if self.normaliser is None else self.normaliser.normalize_str(chr(c)) for c in range(128)}
        self.written = dict(enumerate(self.character[:128]))
        self.lowered = all(v == chr(c).lower() for c, v in self.plain.items())
        #: Whether a run of ASCII letters is one piece, a mark behind it another, and a space before it part of it.
        split = (lambda x: None) if self.pattern is None else self.pattern.findall
        self.runs = split("word") == ["word"] and all(split("word" + m) == ["word", m] for m in MARKS)
        self.spaced = split(" word") == [" word"]

    def _piece(self, piece: str) -> bytes:
        rest = piece[1:]
        if piece.isascii() and rest.isprintable() and " " not in rest and (piece[0] == " " or piece[0].isprintable()):
            written = self.written[32] + rest if piece[0] == " " else piece
        else:
            written = piece.translate(self.written) if piece.isascii() else "".join([self.character[b] for b in piece.encode()])
        found = self.pieces[piece] = as_bytes([t.id for t in self.model.tokenize(written)])
        return found

    def __call__(self, words: list[bytes]) -> list[bytes]:
        texts = [w.decode() for w in words]
        if len(self.pieces) > self.most:
            self.pieces.clear()
        out: list[bytes | None] = []
        known, normalise = self.pieces, self.normaliser
        runs, spaced, lowered = self.runs, self.spaced, self.lowered
        split = None if self.pattern is None else self.pattern.findall
        for text in texts:
            # Beyond these letters, what counts as a letter hangs on a library's Unicode version.
            if split is None or not text.isascii() and max(text) > "\u024f":
                out.append(None)
                continue
            ascii = text.isascii()
            if normalise is not None:
                text = text.lower() if ascii and lowered else text.translate(self.plain) if ascii else normalise.normalize_str(text)
            pieces = None
            if runs and ascii:
                run = text[1:] if spaced and text[:1] == " " else text
                if run.isalpha():
                    out.append(known.get(text) or self._piece(text))
                    continue
                if run[-1:] in MARKS and run[:-1].isalpha():
                    pieces = text[:-1], text[-1]
            out.append(b"".join([known.get(x) or self._piece(x) for x in pieces or split(text)]))
        others = [i for i, x in enumerate(out) if x is None]
        if others:
            for i, found in zip(others, self.whole.encode_batch_fast([texts[i] for i in others], add_special_tokens=False)):
                out[i] = as_bytes(found.ids)
        return out


def as_bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def byte_characters() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others are numbered from 256."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[s:s + n]`` for each start and length, one after another."""
    at = np.concatenate(([0], np.cumsum(lengths)))
    return values[np.repeat(starts - at[:-1], lengths) + np.arange(at[-1])]


def encode(texts: pa.Array, path: str, spaces_matter: bool, end_id: int | None = 0, most_cached: int = MOST_CACHED) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another and their offsets; ``end_id`` closes each text.

    ``spaces_matter``: white space before a word is part of its tokens. ``most_cached``: words kept
    per generation, and pieces of words, between calls.
    """
    known = _cache.setdefault((path, spaces_matter), WordCache())
    known.most = encoder(path).most = most_cached
    return encode_by_word(texts, encoder(path), known, spaces_matter, end_id)


def odd_words(parts: Chunks) -> np.ndarray:
    """Distinct words that end in white space beyond ASCII, after which a cut may matter."""
    return np.array([not w.isascii() and w.decode()[-1].isspace() for w in parts.words], bool)


def encode_by_word(
    texts: pa.Array, encode_words: Callable[[list[bytes]], list[bytes]], known: WordCache, spaces_matter: bool, end_id: int | None
) -> tuple[np.ndarray, np.ndarray]:
    """The same for any encoder of pieces of text; ``known`` keeps what words gave."""
    parts = chunks(texts)
    keys = parts.words if spaces_matter else [w.lstrip(SPACES) for w in parts.words]
    of_word = known.ids(keys, encode_words)
    lengths = np.array([len(x) // 4 for x in of_word], np.int64)
    flat = np.frombuffer(b"".join(of_word), np.uint32)
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    ids = gather(flat, starts[parts.codes], lengths[parts.codes]) if len(parts.codes) else np.empty(0, np.uint32)
    before = np.concatenate(([0], np.cumsum(lengths[parts.codes]))) if len(parts.codes) else np.zeros(1, np.int64)
    bounds = before[parts.first]
    pieces = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    if spaces_matter:
        odd = odd_words(parts)
        if odd.any():
            last = np.zeros(len(parts.codes), bool)
            last[parts.first[1:][parts.first[1:] > parts.first[:-1]] - 1] = True
            for d in np.unique(np.searchsorted(parts.first, np.flatnonzero(odd[parts.codes] & ~last), side="right") - 1).tolist():
                pieces[d] = np.frombuffer(encode_words([parts.body[parts.at[d] : parts.at[d + 1]].tobytes()])[0], np.uint32)
    if end_id is not None:
        tail = np.array([end_id], np.uint32)
        pieces = [x for p in pieces for x in (p, tail)]
        sizes = np.array([len(p) for p in pieces]).reshape(-1, 2).sum(1) if pieces else np.empty(0, np.int64)
    else:
        sizes = np.array([len(p) for p in pieces], np.int64)
    return np.concatenate(pieces) if pieces else np.empty(0, np.uint32), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
