"""A class bigram language model over all documents, and their log probabilities under it.

P(word | word before) = P(class | class before) P(word | class). Texts are coded once into blocks.
Words are counted over all training documents. Those that make up at least one token in
``MOST_FREQUENT``, so at most that many, are put into classes by exchange (``word_classes``); they
are all that is broadcast. Every other word then goes to the class that suits the words it stood
beside, summed over the whole corpus by a shuffle on the word. Counts and classes travel back to the
blocks by a join; class bigrams are counted over all training tokens with their final classes.
The texts themselves, as word numbers, are a file per block in the shared folder and never shuffled.

Every word's count is discounted by a constant, Kneser and Ney's n1 / (n1 + 2 n2) of the words seen
once and twice; what is taken off, over all words, is the count of one unknown word with a class of
its own. Class transitions are smoothed by the classes' shares. So the probabilities of all known
words and the unknown one sum to 1 after every word.

Defined results: a null or empty text is the end of a text alone. A null id counts as the text
``null``; repeated rows count and score each. Without training documents every word is the unknown one,
and every score 0. An empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from millrace.llm.coded_words import binary_slices, coded_words
from millrace.llm.shared_files import make_folder, new_file, open_file
from millrace.llm.support import extended, ship, small_batches, text_buffer
from millrace.llm.vbyte_files import pack_values, unpack_values
from millrace.llm.word_classes import ENTRY, exchange, nearest, rows_by_word
from millrace.storage import materialize, scratch_path

GAPS = b" \t\n\x0b\x0c\r"
FOLDS = 10
CLASSES = 64
MOST_FREQUENT = 10_000
#: Longer words are never among the frequent ones.
LONGEST = 1000
BLOCK_BYTES = 10 << 20
#: Weight of the classes' shares in every transition, in tokens.
SHARE_WEIGHT = 10.0
#: A block's counts of parts of tokens become whole numbers of this part, so that their sums do not hang
#: on the order of blocks; a long holds 3.5e13 tokens of them.
PARTS = 1 << 18
BASE = 0.1
RESULTS = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _encode(batches: Iterator[pa.RecordBatch], block_bytes: int, folder: str) -> Iterator[pa.RecordBatch]:
    part, made = TaskContext.get().partitionId(), 0
    pressed = zstandard.ZstdCompressor()
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> pa.RecordBatch:
        nonlocal made
        table = pa.Table.from_batches(held).combine_chunks()
        found = coded_words(table.column("_text").combine_chunks(), GAPS)
        control, data = pack_values(found.codes.astype(np.uint32))
        first = found.first.astype("<i8").tobytes()
        out = table.select(["_id", "_held"]).replace_schema_metadata({b"first": first, b"control": control, b"data": data})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, out.schema) as writer:
            writer.write_table(out)
        body, offsets = text_buffer(found.words)
        number = (part << 32) + made
        # A second try of the task writes files of its own; its rows name them.
        path = f"{folder}/{number}-{uuid.uuid4().hex}"
        with new_file(path) as file:
            file.write(pressed.compress(sink.getvalue()))
        cells = [pa.array([path]), *[pa.array([pressed.compress(c)], pa.binary()) for c in (body, offsets.astype("<i4"))]]
        made += 1
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([number]), *cells], names=["block", "path", "body", "offsets"])

    for batch in batches:
        for piece in small_batches(batch, "_text", block_bytes):
            held.append(piece)
            size += piece.column("_text").nbytes
            if size >= block_bytes:
                yield flush()
                size = 0
    if sum(b.num_rows for b in held):
        yield flush()


@dataclass
class Texts:
    """A block's documents: their ids, which are held out, and the words' codes with an end (-1) behind each text."""

    ids: pa.Array
    held: np.ndarray
    codes: np.ndarray
    #: The text of each token.
    text: np.ndarray

    @classmethod
    def read(cls, path: str) -> Texts:
        with open_file(path) as file:
            table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(file.read())).read_all()
        meta = table.schema.metadata
        first = np.frombuffer(meta[b"first"], "<i8")
        codes = unpack_values(meta[b"control"], meta[b"data"], int(first[-1])).astype(np.int64)
        n = len(first) - 1
        with_ends = np.full(len(codes) + n, -1, np.int64)
        text = np.repeat(np.arange(n), np.diff(first) + 1)
        with_ends[np.arange(len(codes)) + np.repeat(np.arange(n), np.diff(first))] = codes
        return cls(table.column("_id").combine_chunks(), table.column("_held").to_numpy().astype(bool), with_ends, text)

    @property
    def training(self) -> np.ndarray:
        """Which tokens are of training documents."""
        return ~self.held[self.text]


def before(values: np.ndarray, end: int) -> np.ndarray:
    """The value of the token before each; an end stands before the first."""
    return np.concatenate(([end], values[:-1])) if len(values) else values


def _words(row: dict) -> pa.BinaryArray:
    opened = zstandard.ZstdDecompressor()
    return binary_slices(np.frombuffer(opened.decompress(row["body"]), np.uint8), np.frombuffer(opened.decompress(row["offsets"]), "<i4"))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of training tokens; the null word is the end of a text."""
    for batch in batches:
        for row in batch.to_pylist():
            texts, words = Texts.read(row["path"]), _words(row)
            n = np.bincount(texts.codes[texts.training] + 1, minlength=len(words) + 1)
            some = np.flatnonzero(n[1:])
            yield pa.RecordBatch.from_arrays([words.take(pa.array(some)).cast(pa.string()), pa.array(n[1:][some], pa.int64())], names=["word", "n"])
            if n[0]:
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.array(n[:1], pa.int64())], names=["word", "n"])


def _items(words: pa.BinaryArray, frequent: pa.Array) -> np.ndarray:
    """Number of each word among the frequent ones, or the number behind them."""
    at = pc.index_in(words.cast(pa.string()), value_set=frequent)
    return at.fill_null(len(frequent)).to_numpy(zero_copy_only=False).astype(np.int64)


def _pairs(batches: Iterator[pa.RecordBatch], frequent: pa.Array) -> Iterator[pa.RecordBatch]:
    """Counts of neighbours in training documents: frequent words, all others as one, and ends."""
    size = len(frequent) + 2
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []

    def flush() -> Iterator[pa.RecordBatch]:
        key, row = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(row, np.concatenate(counts)).astype(np.int64)
        for a in range(0, len(key), 1 << 16):
            part = key[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part // size, pa.int32()), pa.array(part % size, pa.int32()), pa.array(n[a : a + (1 << 16)])], names=["first", "second", "n"])
        keys.clear()
        counts.clear()

    for batch in batches:
        for row in batch.to_pylist():
            texts = Texts.read(row["path"])
            item = np.append(_items(_words(row), frequent), size - 1)[texts.codes]
            key, n = np.unique((before(item, size - 1) * size + item)[texts.training], return_counts=True)
            keys.append(key)
            counts.append(n)
            if sum(map(len, keys)) > 2_000_000:
                yield from flush()
    if keys:
        yield from flush()


def _beside(batches: Iterator[pa.RecordBatch], frequent: pa.Array, of_item: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """(word, vector) of each other word of a block's training texts: classes before it and behind it."""
    for batch in batches:
        for row in batch.to_pylist():
            texts, words = Texts.read(row["path"]), _words(row)
            items = _items(words, frequent)
            item = np.append(items, len(frequent) + 1)[texts.codes]
            klass = of_item[item]
            behind = np.append(klass[1:], 0)  # an end is the last token and no word
            mine = np.flatnonzero(texts.training & (item == len(frequent)))
            codes = texts.codes[mine]
            key = np.concatenate([codes * 2 * width + before(klass, of_item[-1])[mine], codes * 2 * width + width + behind[mine]])
            key, n = np.unique(key, return_counts=True)
            cells = np.empty(len(key), ENTRY)
            cells["key"], cells["n"] = key % (2 * width), n
            word, first = np.unique(key // (2 * width), return_index=True)
            vectors = binary_slices(cells.view(np.uint8), np.append(first, len(key)) * ENTRY.itemsize)
            for a in range(0, len(word), 1 << 16):
                part = word[a : a + (1 << 16)]
                yield pa.RecordBatch.from_arrays([words.take(pa.array(part)).cast(pa.string()), vectors.slice(a, len(part))], names=["word", "vector"])


def _assign(batches: Iterator[pa.RecordBatch], counts: np.ndarray, classes: int) -> Iterator[pa.RecordBatch]:
    width = len(counts)
    for words, sums in rows_by_word(batches, 2 * width):
        left, right = sums[:, :width], sums[:, width:]
        klass = nearest(left, right, counts, classes)
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(left.sum(1).astype(np.int64)), pa.array(klass.astype(np.int32))], names=["word", "c", "klass"])


def _entries(batches: Iterator[pa.RecordBatch], frequent: pa.Array) -> Iterator[pa.RecordBatch]:
    """(word, block, code) of each word that is not among the frequent ones."""
    for batch in batches:
        for row in batch.to_pylist():
            words = _words(row)
            code = np.flatnonzero(_items(words, frequent) == len(frequent))
            for a in range(0, len(code), 1 << 16):
                part = code[a : a + (1 << 16)]
                yield pa.RecordBatch.from_arrays([words.take(pa.array(part)).cast(pa.string()), pa.array(np.full(len(part), row["block"])), pa.array(part, pa.int32())], names=["word", "block", "code"])


def _heads(batches: Iterator[pa.RecordBatch], frequent: pa.Array, counts: np.ndarray, of_item: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Where a block's texts are, with counts and classes of its frequent words, as code -1."""
    known = np.append(counts, 0)
    for batch in batches:
        for row in batch.to_pylist():
            item = _items(_words(row), frequent)
            c, klass = known[item], np.where(item < len(frequent), of_item[item], -1)
            head = pickle.dumps((row["path"], c.astype("<i8"), klass.astype("<i2")))
            cells = [pa.array([row["block"]]), pa.array([-1], pa.int32()), pa.nulls(1, pa.int64()), pa.array([head], pa.binary())]
            yield pa.RecordBatch.from_arrays(cells, names=["block", "code", "value", "head"])


def _regroup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the count and class of every word, from rows sorted by block and code."""
    held: tuple | None = None

    def done() -> pa.RecordBatch:
        number, path, c, klass = held
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([path]), *[pa.array([x.tobytes()], pa.binary()) for x in (c, klass)]], names=["block", "path", "counts", "classes"])

    for batch in batches:
        code = batch.column("code").to_numpy()
        value = batch.column("value").fill_null(0).to_numpy(zero_copy_only=False)
        heads = np.flatnonzero(code == -1)
        for a, b in zip([0, *heads.tolist()], [*heads.tolist(), batch.num_rows]):
            if b > a and code[a] == -1:
                if held is not None:
                    yield done()
                held = (batch.column("block")[a].as_py(), *pickle.loads(batch.column("head")[a].as_py()))
                a += 1
            if b > a:
                held[2][code[a:b]] = value[a:b] >> 8
                held[3][code[a:b]] = value[a:b] & 0xFF
    if held is not None:
        yield done()


def _token_values(row: dict, ends: int, classes: int) -> tuple[Texts, np.ndarray, np.ndarray]:
    """(texts, count, class) of all tokens; unknown words have the last class."""
    texts = Texts.read(row["path"])
    c = np.append(np.frombuffer(row["counts"], "<i8"), ends)[texts.codes]
    klass = np.append(np.frombuffer(row["classes"], "<i2").astype(np.int64), classes if ends else -1)[texts.codes]
    return texts, c, np.where(klass < 0, classes + 1, klass)


def _transitions(batches: Iterator[pa.RecordBatch], ends: int, classes: int, discount: float) -> Iterator[pa.RecordBatch]:
    """Class bigrams of training tokens in parts: of each token its class has 1 - discount / c, the unknown class the rest."""
    size = classes + 2
    totals = np.zeros(size * size, np.int64)
    for batch in batches:
        for row in batch.to_pylist():
            texts, c, klass = _token_values(row, ends, classes)
            unknown = discount / np.maximum(c, 1)
            # The token before a training text's first is the end of a training text, whatever stands before it here.
            starts = np.flatnonzero(np.diff(texts.text, prepend=-1))
            last, share = before(klass, classes), before(unknown, 0.0)
            last[starts] = classes
            share[starts] = discount / max(ends, 1)
            use = texts.training
            for row_of, row_share in ((last, 1 - share), (np.full_like(last, size - 1), share)):
                for column, column_share in ((klass, 1 - unknown), (np.full_like(klass, size - 1), unknown)):
                    weight = np.bincount(row_of[use] * size + column[use], row_share[use] * column_share[use], size * size)
                    totals += np.rint(weight * PARTS).astype(np.int64)
    some = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(some // size, pa.int32()), pa.array(some % size, pa.int32()), pa.array(totals[some])], names=["before", "klass", "n"])


@dataclass
class Model:
    """What scoring needs besides the blocks; its size hangs on the number of classes alone."""

    classes: int
    tokens: int
    types: int
    ends: int
    discount: float
    #: log10 P(class | class before), and discounted counts per class.
    transition: np.ndarray
    mass: np.ndarray

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + BASE) / (self.tokens + BASE * (self.types + 1)))

    def emission(self, c: np.ndarray, klass: np.ndarray) -> np.ndarray:
        """log10 P(word | class); ends and the unknown word are alone in theirs."""
        alone = klass >= self.classes
        return np.where(alone, 0.0, np.log10(np.maximum(c - self.discount, 1e-300) / np.where(alone, 1.0, self.mass[np.minimum(klass, self.classes - 1)])))


def transitions(counts: np.ndarray) -> np.ndarray:
    """log10 P(class | class before) from counts; the unknown class can always come."""
    columns = counts.sum(0)
    if not columns.sum():
        columns[-1] = 1.0
    share = columns / columns.sum()
    smooth = (counts + SHARE_WEIGHT * share) / (counts.sum(1, keepdims=True) + SHARE_WEIGHT)
    with np.errstate(divide="ignore"):
        return np.log10(smooth)


def _score(batches: Iterator[pa.RecordBatch], model: Model, id_name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            texts, c, klass = _token_values(row, model.ends, model.classes)
            last = before(klass, model.classes)
            last[np.flatnonzero(np.diff(texts.text, prepend=-1))] = model.classes if model.ends else model.classes + 1
            n = len(texts.ids)
            log = model.transition[last, klass] + model.emission(c, klass)
            values = [np.bincount(texts.text, w, n) for w in (model.base(c), log)]
            known = np.bincount(texts.text, c > 0, n).astype(np.int64)
            columns = [texts.ids, pa.array(texts.held), pa.array(np.bincount(texts.text, minlength=n)), pa.array(known), pa.array(np.full(n, model.tokens, np.int64)), *map(pa.array, values)]
            yield pa.RecordBatch.from_arrays(columns, names=[id_name, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def fit(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, classes: int = CLASSES, most_frequent: int = MOST_FREQUENT, block_bytes: int = BLOCK_BYTES
) -> tuple[DataFrame, Model]:
    """Stored blocks of all documents with counts and classes of their words, and the model.

    Documents whose id has a crc32 divisible by ``folds`` are held out of training.
    """
    if not 1 <= classes <= 120:
        raise ValueError("classes must be 1 to 120")
    spark = df.sparkSession
    ship(spark)
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null"))
    docs = df.select(F.col(f"`{id_col}`").alias("_id"), (F.crc32(F.encode(name, "utf-8")) % folds == 0).alias("_held"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    folder = scratch_path(spark, "lm_texts")
    make_folder(folder)
    blocks = materialize(docs.mapInArrow(partial(_encode, block_bytes=block_bytes, folder=folder), "block long, path string, body binary, offsets binary"), "lm_blocks")

    counted = blocks.mapInArrow(_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = materialize(counted, "lm_vocabulary")
    once, twice = (F.count(F.when(F.col("n") == k, 1)) for k in (1, 2))
    tokens, types, ends, n1, n2 = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("n"))), F.lit(0)), once, twice).first()
    discount = min(max(n1 / (n1 + 2 * n2), 0.05), 0.95) if n1 else 0.5
    # At most most_frequent rows, as each has that share of the tokens.
    found = vocabulary.filter((F.col("n") * most_frequent >= tokens) & (F.octet_length("word") <= LONGEST)).collect()
    found.sort(key=lambda r: (-r["n"], r["word"]))
    frequent = pa.array([r["word"] for r in found], pa.string())
    frequent_counts = np.array([r["n"] for r in found], np.int64)

    # Items: frequent words, all other words, ends. The last two keep classes of their own.
    items = len(frequent)
    pairs = materialize(blocks.mapInArrow(partial(_pairs, frequent=frequent), "first int, second int, n long").groupBy("first", "second").agg(F.sum("n").alias("n")), "lm_pairs")
    of_item, counts = exchange(pairs, items, classes)

    rare = blocks.mapInArrow(partial(_beside, frequent=frequent, of_item=of_item, width=classes + 2), "word string, vector binary")
    placed = rare.repartition("word").sortWithinPartitions("word")
    assigned = materialize(placed.mapInArrow(partial(_assign, counts=counts, classes=classes), "word string, c long, klass int"), "lm_classes")
    entries = blocks.mapInArrow(partial(_entries, frequent=frequent), "word string, block long, code int")
    # Count and class travel as one number; words of no training text have none.
    value = F.shiftleft("c", 8) + F.col("klass")
    looked_up = entries.join(assigned.select("word", value.alias("value")), "word").select("block", "code", "value", F.lit(None).cast("binary").alias("head"))
    heads = blocks.mapInArrow(partial(_heads, frequent=frequent, counts=frequent_counts, of_item=of_item), looked_up.schema)
    rows = heads.union(looked_up).repartition("block").sortWithinPartitions("block", "code")
    known = materialize(rows.mapInArrow(_regroup, "block long, path string, counts binary, classes binary"), "lm_known")

    table = np.zeros((classes + 2, classes + 2))
    summed = known.mapInArrow(partial(_transitions, ends=ends, classes=classes, discount=discount), "before int, klass int, n long").groupBy("before", "klass")
    for r in summed.agg(F.sum("n").alias("n")).collect():  # classes squared
        table[r["before"], r["klass"]] = r["n"] / PARTS
    mass = np.zeros(classes)
    for r in assigned.groupBy("klass").agg(F.sum("c").alias("c"), F.count("*").alias("m")).collect():  # a row per class
        mass[r["klass"]] = r["c"] - discount * r["m"]
    np.add.at(mass, of_item[:items], frequent_counts - discount)
    return known, Model(classes, tokens, types, ends, discount, transitions(table), mass)


def score(df: DataFrame, id_col: str = "doc_id", **parameters) -> DataFrame:
    """Per document: its id and ``RESULTS``, by a model with the ``parameters`` of :func:`fit`."""
    known, model = fit(df, id_col, **parameters)
    schema = extended(StructType([StructField(id_col, df.schema[id_col].dataType)]), RESULTS)
    return known.mapInArrow(partial(_score, model=model, id_name=id_col), schema)
