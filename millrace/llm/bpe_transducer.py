"""Byte-level BPE as a finite-state transducer, and decoding with an incremental UTF-8 machine.

Merging by rank gives every prefix of a text a unique last token, and two tokens may stand side by
side only if merging their joint bytes gives back those two. So the tokens of a text can be found
from left to right: a state holds what the next bytes can still touch, that is the longest suffix
that some token starts with, the last token at each position a later token may start from, and the
token before. A step appends one byte and emits the tokens that all possible continuations share;
how far they differ is bounded by the longest token. States and steps are made when first met
(lazy determinisation) and then only looked up.

Each match of the splitting pattern is encoded by itself. Decoding maps ids to bytes and lets
through whole UTF-8 characters only, so text can be streamed; what is cut off waits for more.

Defined results: a null or empty text has no ids and decodes to no bytes. Bytes that are no UTF-8
come back as they are. Rows are encoded one by one. All other columns are kept, but for those with
the name of a result, which it replaces.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from millrace.llm.support import extended, kept_columns, ship, small_batches
from millrace.llm.token_ids import WordCache, as_bytes, encode_by_word, gather

MOST_STATES = 600_000
MOST_WORDS = 300_000
MOST_PAIRS = 400_000
_loaded: dict[tuple[str, str], Codec] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(text: bytes, ranks: dict[bytes, int], below: int = 1 << 60) -> list[bytes]:
    """Plain BPE: join the adjacent pair of least rank, the leftmost first, while a rank is less than ``below``."""
    parts = [text[i : i + 1] for i in range(len(text))]
    while len(parts) > 1:
        best = min(((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
        if best[0] >= below:
            break
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return parts


class Transducer:
    """Byte by byte in, ranks out; see the module's text."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: text for text, rank in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.depth, self.ends = [0], [None]
        for text, rank in sorted(ranks.items()):
            node = 0
            for byte in text:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.depth.append(self.depth[node] + 1)
                    self.ends.append(None)
                node = self.children[node][byte]
            self.ends[node] = rank
        self.fail = [0] * len(self.children)
        queue = list(self.children[0].values())
        for node in queue:
            for byte, child in self.children[node].items():
                self.fail[child] = self._step(self.fail[node], byte)
                queue.append(child)
        self.size = {rank: len(text) for text, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.beside: dict[int, bool] = {}
        self.suffixes: list[tuple[tuple[tuple[int, int], ...], tuple[int, ...]] | None] = [None] * len(self.children)
        self._reset()

    def _reset(self) -> None:
        # A state: trie node, the token before, and the last token at each later position (-1: not needed).
        self.states: list[tuple[int, int, tuple[int, ...]]] = [(0, -1, ())]
        self.number = {self.states[0]: 0}
        #: By 256 * state + byte: the next state, times 256, and what is emitted.
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.finals: list[tuple[int, ...] | None] = [()]
        if len(self.beside) > MOST_PAIRS:
            self.beside.clear()

    def _step(self, node: int, byte: int) -> int:
        while byte not in self.children[node]:
            if not node:
                return 0
            node = self.fail[node]
        return self.children[node][byte]

    def _halves(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one; None for a single byte."""
        if rank not in self.halves:
            text = self.token[rank]
            parts = merged(text, self.ranks, rank)
            self.halves[rank] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.halves[rank]

    def _fits(self, a: int, b: int) -> bool:
        """Whether the two tokens stay apart when their joint bytes are merged.

        The merges next to the border are undone, the last one first: the two parts there must not
        be able to merge before the merge that took one of them away.
        """
        left, right, before = a, b, 1 << 60
        while True:
            joint = self.ranks.get(self.token[left] + self.token[right])
            # Of two merges of one rank the one further left comes first.
            if joint is not None and joint < before:
                return False
            of_left, of_right = self._halves(left), self._halves(right)
            if of_left is None and of_right is None:
                return True
            if of_right is None or of_left is not None and left > right:
                left, before = of_left[1], left
            else:
                right, before = of_right[0], right + 1

    def _around(self, node: int) -> tuple[tuple[tuple[int, int], ...], tuple[int, ...]]:
        """Tokens that are suffixes of a trie node's bytes, and lengths of its suffixes that go on in the trie."""
        tokens, live, link = [], [0], node
        while link:
            if self.ends[link] is not None:
                tokens.append((self.ends[link], self.depth[link]))
            if self.children[link]:
                live.append(self.depth[link])
            link = self.fail[link]
        self.suffixes[node] = tuple(tokens), tuple(live)
        return self.suffixes[node]

    def _make(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        node, before, rest = self.states[state]
        last = [before, *rest]
        end = len(last)
        at = self._step(node, byte)
        tokens, live = self.suffixes[at] or self._around(at)
        beside = self.beside
        for rank, size in tokens:
            previous = last[end - size]
            if previous < 0:
                if size == end and before < 0:
                    break
                continue
            pair = previous << 32 | rank
            fits = beside.get(pair)
            if fits is None:
                fits = beside[pair] = self._fits(previous, rank)
            if fits:
                break
        else:
            raise ValueError("the ranks are not closed under merging")
        last.append(rank)
        # Walk back from all positions a later token may start from until the walks have met.
        size, needed, anchor = self.size, bytearray(end + 1), end
        for n in live:
            needed[end - n] = 1
        apart = len(live) - 1
        while apart:
            if needed[anchor]:
                back = anchor - size[last[anchor]]
                if needed[back]:
                    apart -= 1
                else:
                    needed[back] = 1
            anchor -= 1
        while not needed[anchor]:
            anchor -= 1
        emitted, back = [], anchor
        while back:
            emitted.append(last[back])
            back -= size[last[back]]
        while at and not self.children[at]:
            at = self.fail[at]
        kept = () if anchor == end else tuple([t if n else -1 for t, n in zip(last[anchor + 1 :], needed[anchor + 1 :])])
        after = (at, last[anchor], kept)
        number = self.number.get(after)
        if number is None:
            number = self.number[after] = len(self.states)
            self.states.append(after)
            self.finals.append(None)
        made = self.steps[state << 8 | byte] = number << 8, tuple(emitted[::-1])
        return made

    def _final(self, state: int) -> tuple[int, ...]:
        _, _, rest = self.states[state]
        out, back = [], len(rest)
        while back:
            out.append(rest[back - 1])
            back -= self.size[rest[back - 1]]
        self.finals[state] = tuple(out[::-1])
        return self.finals[state]

    def encode(self, text: bytes) -> list[int]:
        if len(self.states) > MOST_STATES:
            self._reset()
        out: list[int] = []
        state, known = 0, self.steps.get
        for byte in text:
            step = known(state | byte) or self._make(state >> 8, byte)
            state, emitted = step
            if emitted:
                out += emitted
        final = self.finals[state >> 8]
        return out + list(self._final(state >> 8) if final is None else final)


def utf8_pending(text: bytes) -> int:
    """How many bytes at the end begin a character that is not complete; 0 to 3."""
    for back in range(1, min(3, len(text)) + 1):
        byte = text[-back]
        if byte & 0xC0 != 0x80:
            size = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2 if byte >= 0xC0 else 1
            return back if size > back else 0
    return 0


class StreamDecoder:
    """Ids in, whole UTF-8 characters out as bytes; the state is the start of an unfinished one."""

    def __init__(self, token: dict[int, bytes]):
        self.token = token
        self.steps: dict[bytes, dict[int, tuple[bytes, bytes]]] = {b"": {}}
        #: Bytes of all tokens one after another, and the tokens that lead from no pending bytes to none.
        texts = [token.get(i, b"") for i in range(max(token, default=-1) + 1)]
        self.body = np.frombuffer(b"".join(texts), np.uint8)
        self.length = np.array([len(t) for t in texts], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.whole = np.array([i in token and not utf8_pending(t) for i, t in enumerate(texts)], bool)

    def feed(self, ids: Iterable[int], pending: bytes = b"") -> tuple[bytes, bytes]:
        """(bytes of whole characters, what waits for more)."""
        out, table = [], self.steps.setdefault(pending, {})
        for rank in ids:
            step = table.get(rank)
            if step is None:
                text = pending + self.token[rank]
                keep = utf8_pending(text)
                step = table[rank] = (text[: len(text) - keep], text[len(text) - keep :])
            out.append(step[0])
            if step[1] != pending:
                pending = step[1]
                table = self.steps.setdefault(pending, {})
        return b"".join(out), pending

    def text(self, ids: np.ndarray) -> bytes:
        """All bytes of ``ids``. While no bytes wait, runs of whole tokens are one lookup in the table of bytes."""
        loose = np.flatnonzero(~self.whole[ids])
        out, done, pending = [], 0, b""
        while done < len(ids):
            if not pending:
                nth = np.searchsorted(loose, done)
                until = int(loose[nth]) if nth < len(loose) else len(ids)
                run = ids[done:until]
                out.append(gather(self.body, self.start[run], self.length[run]).tobytes())
                done = until
            if done < len(ids):
                made, pending = self.feed([int(ids[done])], pending)
                out.append(made)
                done += 1
        return b"".join([*out, pending])


class Codec:
    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.transducer = Transducer(self.ranks)
        self.decoder = StreamDecoder(self.transducer.token)
        self.pattern = regex.compile(pattern)
        self.known = WordCache(MOST_WORDS)
        self.pieces: dict[str, list[int]] = {}

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return self.transducer.encode(piece) if whole is None else [whole]

    def encode_text(self, text: bytes) -> bytes:
        out, known, parts = [], self.pieces, self.pattern.findall(text.decode())
        if len(parts) == 1:  # as a word, it is kept already
            return as_bytes(known.get(parts[0]) or self.encode_piece(parts[0].encode()))
        for piece in parts:
            ids = known.get(piece)
            if ids is None:
                if len(known) > MOST_WORDS:
                    known.clear()
                ids = known[piece] = self.encode_piece(piece.encode())
            out += ids
        return as_bytes(out)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return encode_by_word(texts, lambda batch: [self.encode_text(t) for t in batch], self.known, True, None)

    def decode(self, ids: Iterable[int]) -> bytes:
        return self.decoder.text(np.asarray(ids, np.int64))


def codec(path: str, pattern: str) -> Codec:
    """One per worker process and vocabulary."""
    if (path, pattern) not in _loaded:
        # Millions of tuples without cycles: looking for cycles more rarely saves a fifth of the time.
        gc.set_threshold(200_000, 50, 50)
        _loaded[path, pattern] = Codec(path, pattern)
    return _loaded[path, pattern]


def _encode_rows(batches: Iterator[pa.RecordBatch], path: str, pattern: str, text_col: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in small_batches(whole, text_col):
            ids, at = codec(path, pattern).encode(batch.column(text_col))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], lists], names=[*keep, "ids"])


def _decode_rows(batches: Iterator[pa.RecordBatch], path: str, pattern: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        decoded = [None if ids is None else codec(path, pattern).decode(ids) for ids in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(decoded, pa.binary())], names=[*keep, "decoded"])


def _round_trip(batches: Iterator[pa.RecordBatch], path: str, pattern: str, text_col: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    names = {rank: str(rank) for rank in codec(path, pattern).transducer.token}
    for whole in batches:
        for batch in small_batches(whole, text_col):
            ids, at = codec(path, pattern).encode(batch.column(text_col))
            counts, of_ids, of_bytes = np.diff(at), [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                own = ids[a:b].tolist()
                of_ids.append(hashlib.sha256(",".join([names[i] for i in own]).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(codec(path, pattern).decode(ids[a:b])).hexdigest())
            columns = [*[batch.column(c) for c in keep], pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_bytes)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256"])


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of every row with ``ids``, the ranks of its text."""
    ship(df.sparkSession)
    keep = kept_columns(df, keep, ["ids"])
    needed = df.select(*[f"`{c}`" for c in dict.fromkeys([*keep, text_col])])
    return needed.mapInArrow(partial(_encode_rows, path=path, pattern=pattern, text_col=text_col, keep=keep), extended(needed.select(*[f"`{c}`" for c in keep]).schema, "ids array<int>"))


def decode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Every row of ``df`` with ``decoded``, the bytes of its ``ids``, in their place; null for null."""
    ship(df.sparkSession)
    keep = kept_columns(df, None, ["ids", "decoded"])
    return df.mapInArrow(partial(_decode_rows, path=path, pattern=pattern, keep=keep), extended(df.select(*[f"`{c}`" for c in keep]).schema, "decoded binary"))


def round_trip(df: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Encode and decode in one pass: number of ids, SHA-256 of the ids and of the decoded bytes."""
    ship(df.sparkSession)
    keep = kept_columns(df, keep, ["n_tokens", "ids_sha256", "decoded_sha256"])
    needed = df.select(*[f"`{c}`" for c in dict.fromkeys([*keep, text_col])])
    schema = extended(needed.select(*[f"`{c}`" for c in keep]).schema, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return needed.mapInArrow(partial(_round_trip, path=path, pattern=pattern, text_col=text_col, keep=keep), schema)
