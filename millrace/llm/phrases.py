"""Phrases of two and three words that stand together more often than their parts, per language.

Texts are coded once into blocks: words as numbers, with a mark where a piece begins. Counting goes
level by level. Level k has candidates of k words whose parts all reached the minimum on the level
below (words: all), and that occur often enough, by sums that stop at the minimum. They stand sorted
in double-array tries of at most ``Sizes.shard_keys`` phrases, a file each, that tasks load one after
another, so a task holds few of them however many there are. Each task walks the states of all its
phrases through a trie at once, adds their numbers up by accepting state, and Spark sums the
shards' counts. In the same pass, neighbours that were both accepted become candidates of the level above.
Accepted phrases are known by number, so a candidate travels as two numbers in a list of many, which Spark
takes apart and sums behind the shuffle; only those that reach the minimum get their words back.

A candidate's score is the least, over its cuts into two parts, of ``10^6 a^2 / (l r)``, floored, in
exact decimals. Phrases that a longer candidate covers in at least half their occurrences are left
out. The best ones of each language come back with their rank.

Defined results: a null text is empty, a null language ``und``. Repeated rows count each. A language
without candidates gives no rows, and neither does an empty table. Other columns are not looked at.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.coded_words import binary_slices, coded_words
from millrace.llm.double_array import DoubleArray, build
from millrace.llm.shared_files import make_folder, new_file, open_file
from millrace.llm.support import ship, small_batches, text_buffer
from millrace.llm.token_ids import gather
from millrace.operators.ranking import top_per_key
from millrace.storage import materialize, scratch_path

GAPS, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
WORDS = 3
LEAST = 10
COVERED_PERCENT = 50
TOP = 2000
SCALE = 1_000_000

@dataclass(frozen=True)
class Sizes:
    """What a task holds at a time; results do not hang on it."""

    block_bytes: int = 3 << 20  # of text per block
    shard_keys: int = 100_000  # per trie
    shard_bytes: int = 8 << 20  # of keys per trie
    held_bytes: int = 48 << 20  # of tries
    held_counts: int = 1 << 20  # counts not yet passed on
    sent_counts: int = 1 << 17  # counts in a batch of lists


BLOCK = "lang string, body binary, offsets binary, codes binary, begins binary"
SMALL_IDS = 1 << 31
CELLS = 512  # lists that a batch of counts is dealt into, so their number grows with the batches alone


def _encode(batches: Iterator[pa.RecordBatch], sizes: Sizes) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        languages = table.column("lang").combine_chunks().dictionary_encode()
        of_row = languages.indices.to_numpy(zero_copy_only=False)
        for i, lang in enumerate(languages.dictionary.to_pylist()):
            texts = table.column("text").take(pa.array(np.flatnonzero(of_row == i))).combine_chunks()
            found = coded_words(texts, GAPS, BREAKS)
            if not len(found.codes):
                continue
            body, offsets = text_buffer(found.words)
            cells = [lang, body.tobytes(), offsets.astype("<i4").tobytes(), found.codes.astype("<i4").tobytes(), np.packbits(found.begins).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary() if k else pa.string()) for k, c in enumerate(cells)], names=["lang", "body", "offsets", "codes", "begins"])
        held.clear()

    for batch in batches:
        for part in small_batches(batch, "text", sizes.block_bytes):
            held.append(part)
            size += part.column("text").nbytes
            if size >= sizes.block_bytes:
                yield from flush()
                size = 0
    if held:
        yield from flush()


def encode_blocks(df: DataFrame, text_col: str = "text", lang_col: str = "lang", sizes: Sizes = Sizes()) -> DataFrame:
    """All words of all texts in coded blocks of one language each, stored."""
    ship(df.sparkSession)
    texts = df.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return materialize(texts.mapInArrow(partial(_encode, sizes=sizes), BLOCK), "phrase_blocks")


@dataclass
class Shard:
    """One trie of phrases: its file, its first and last key, and how many phrases the tries before it hold."""

    path: str
    first: bytes
    last: bytes
    start: int
    size: int


def _build(batches: Iterator[pa.RecordBatch], folder: str, sizes: Sizes) -> Iterator[pa.RecordBatch]:
    part, made = TaskContext.get().partitionId(), 0
    held: list[pa.Array] = []
    count = size = 0

    def flush() -> pa.RecordBatch:
        nonlocal made
        keys = pa.concat_arrays(held)
        number = (part << 32) + made
        with new_file(f"{folder}/{number}") as out:
            out.write(build(keys.cast(pa.binary())).to_bytes())
        made += 1
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), number)), pa.array(np.arange(len(keys), dtype=np.int32)), keys], names=["shard", "number", "key"])

    for batch in batches:
        step = min(16384, sizes.shard_keys)
        for start in range(0, batch.num_rows, step):
            held.append(batch.column("key").slice(start, step))
            count += len(held[-1])
            size += int(pc.sum(pc.binary_length(held[-1])).as_py() or 0)
            if count >= sizes.shard_keys or size >= sizes.shard_bytes:
                yield flush()
                count = size = 0
    if count:
        yield flush()


def build_tries(keys: DataFrame, label: str, sizes: Sizes = Sizes()) -> tuple[DataFrame, list[Shard]]:
    """Tries over distinct ``key`` (language, line feed, phrase): (id, key), ids from 0, and one entry per trie."""
    spark = keys.sparkSession
    folder = scratch_path(spark, label)
    make_folder(folder)
    placed = keys.select("key").repartitionByRange("key").sortWithinPartitions("key")
    built = materialize(placed.mapInArrow(partial(_build, folder=folder, sizes=sizes), "shard long, number int, key string"), f"{label}-keys")
    spans = built.groupBy("shard").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.count("key").alias("size")).collect()
    shards, starts, start = [], [], 0
    for r in sorted(spans, key=lambda r: r["first"].encode()):
        shards.append(Shard(f"{folder}/{r['shard']}", r["first"].encode(), r["last"].encode(), start, r["size"]))
        starts.append((r["shard"], start))
        start += r["size"]
    # One row per trie.
    of_shard = F.broadcast(spark.createDataFrame(starts, "shard long, start long"))
    return built.join(of_shard, "shard").select((F.col("start") + F.col("number")).alias("id"), "key"), shards


class Tries:
    """The tries of one level, loaded when needed; the least recently used go beyond ``held_bytes``."""

    def __init__(self, shards: list[Shard], held_bytes: int):
        self.shards, self.held_bytes = shards, held_bytes
        self.loaded: OrderedDict[int, DoubleArray] = OrderedDict()

    def of(self, lang: str) -> Iterator[tuple[int, DoubleArray, int]]:
        """(first id, trie, state after the language) of those that may hold phrases of ``lang``."""
        prefix = f"{lang}\n".encode()
        for shard in self.shards:
            # No byte of UTF-8 is above 0xF4.
            if shard.last >= prefix and shard.first <= prefix + b"\xff":
                trie = self.load(shard)
                state = trie.after(prefix)
                if state >= 0:
                    yield shard.start, trie, state

    def load(self, shard: Shard) -> DoubleArray:
        trie = self.loaded.pop(shard.start, None)
        if trie is None:
            with open_file(shard.path) as stream:
                trie = DoubleArray.from_bytes(stream.read())
        self.loaded[shard.start] = trie
        while len(self.loaded) > 1 and sum(12 * len(t.base) for t in self.loaded.values()) > self.held_bytes:
            self.loaded.popitem(last=False)
        return trie


@dataclass
class Block:
    """Coded words of one language; ``joined[i]``: word i + 1 follows word i in one piece."""

    lang: str
    body: np.ndarray
    at: np.ndarray
    codes: np.ndarray
    joined: np.ndarray

    @classmethod
    def read(cls, row: dict) -> Block:
        codes = np.frombuffer(row["codes"], "<i4").astype(np.int64)
        begins = np.unpackbits(np.frombuffer(row["begins"], np.uint8), count=len(codes)).astype(bool)
        return cls(row["lang"], np.frombuffer(row["body"], np.uint8), np.frombuffer(row["offsets"], "<i4"), codes, np.append(~begins[1:], False))

    def grams(self, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct word numbers, a row each; how often; row of each start) of phrases of ``size`` words."""
        key, columns = self.codes[starts], [self.codes[starts]]
        for k in range(1, size):
            # Ranks of the shorter phrases keep the numbers small.
            ranks = np.unique(key, return_inverse=True)[1] if k > 1 else key
            columns.append(self.codes[starts + k])
            key = ranks * (len(self.at) - 1) + columns[-1]
        _, first, row, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        return np.column_stack([c[first] for c in columns]) if len(first) else np.empty((0, size), np.int64), times, row

    def keys(self, grams: np.ndarray) -> pa.Array:
        """Language, line feed, and the words with spaces between."""
        words = binary_slices(self.body, self.at)
        parts = [words.take(pa.array(grams[:, k])) for k in range(grams.shape[1])]
        phrase = parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, b" ")
        return pc.binary_join_element_wise(pa.scalar(f"{self.lang}\n".encode()), phrase, b"").cast(pa.string())

    def accepted(self, grams: np.ndarray, tries: Tries) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first id, rows of ``grams`` whose states accept, numbers of their keys) for each trie."""
        lengths = np.diff(self.at)
        space = np.frombuffer(b" ", np.uint8)
        for start, trie, root in tries.of(self.lang):
            # Every distinct word walks once as a first word; phrases go on from there together.
            after_first = trie.walk(np.full(len(lengths), root, np.int32), self.body, self.at[:-1], lengths)
            states = after_first[grams[:, 0]]
            rows = np.flatnonzero(states >= 0)
            states = states[rows]
            for k in range(1, grams.shape[1]):
                one = np.ones(len(rows), np.int64)
                states = trie.walk(states, space, one * 0, one)
                word = grams[rows, k]
                states = trie.walk(states, self.body, self.at[word], lengths[word])
                rows, states = rows[states >= 0], states[states >= 0]
            value = trie.value[states]
            yield start, rows[value >= 0], value[value >= 0]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their counts by key; the language's words in all stand under an empty phrase."""
    for batch in batches:
        for row in batch.to_pylist():
            block = Block.read(row)
            words, times, _ = block.grams(np.arange(len(block.codes)), 1)
            yield pa.RecordBatch.from_arrays([pa.array([f"{block.lang}\n"]), pa.array([len(block.codes)], pa.int64())], names=["key", "n"])
            for at in range(0, len(words), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([block.keys(words[part]), pa.array(times[part], pa.int64())], names=["key", "n"])


def count_words(blocks: DataFrame, least: int = LEAST) -> DataFrame:
    """Stored rows (key, n) of words with ``least`` occurrences, and of each language's words in all."""
    summed = blocks.mapInArrow(_words, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return materialize(summed.filter((F.col("n") >= least) | F.col("key").endswith("\n")), "phrase_level_0")


def _dealt(left: np.ndarray, right: np.ndarray, n: np.ndarray, cells: int, kind: pa.DataType, sent: int) -> Iterator[pa.RecordBatch]:
    """Rows (cell, left, right, n) as one list per cell, so that equal pairs meet in the same cell."""
    mixed = (left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (right.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    cell = ((mixed >> np.uint64(32)) % np.uint64(cells)).astype(np.int64)
    for at in range(0, len(cell), sent):
        part = slice(at, at + sent)
        order = np.argsort(cell[part], kind="stable")
        numbers, first = np.unique(cell[part][order], return_index=True)
        offsets = pa.array(np.append(first, len(order)), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v[part][order], k)) for v, k in ((left, kind), (right, kind), (n, pa.int64()))]
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), *lists], names=["cell", "left", "right", "n"])


def _level(batches: Iterator[pa.RecordBatch], size: int, most: int, shards: list[Shard], cells: int, kind: pa.DataType, sizes: Sizes) -> Iterator[pa.RecordBatch]:
    """Counts of phrases of ``size`` words by id (``right`` is -1), and of pairs of such neighbours, which make one of a word more."""
    tries = Tries(shards, sizes.held_bytes)
    total = sum(s.size for s in shards)
    totals: dict[int, list[np.ndarray]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for start, parts in totals.items():
            sums = np.bincount(np.concatenate(parts[::2]), np.concatenate(parts[1::2])).astype(np.int64)
            number = np.flatnonzero(sums)
            yield from _dealt(start + number, np.full(len(number), -1), sums[number], cells, kind, sizes.sent_counts)
        totals.clear()

    for batch in batches:
        for i in range(batch.num_rows):
            (row,) = batch.slice(i, 1).to_pylist()
            block = Block.read(row)
            fits = np.ones(len(block.codes), bool)
            for k in range(1, size):
                fits &= np.append(block.joined[k - 1 :], np.zeros(k - 1, bool))
            starts = np.flatnonzero(fits)
            grams, times, of_start = block.grams(starts, size)
            ids = np.full(len(grams), -1)
            for start, at, number in block.accepted(grams, tries):
                ids[at] = start + number
                totals.setdefault(start, []).extend([number.astype(np.int64), times[at]])
                held += len(number)
            if held > sizes.held_counts:
                yield from flush()
                held = 0
            if size == most:
                continue
            here = np.full(len(block.codes) + 1, -1)
            here[starts] = ids[of_start]
            del grams, of_start
            both = np.flatnonzero((here[:-1] >= 0) & (here[1:] >= 0) & block.joined)
            # Ranks of the left ones keep the numbers small.
            lefts, rank = np.unique(here[both], return_inverse=True)
            pairs, times = np.unique(rank * total + here[both + 1], return_counts=True)
            if len(pairs):
                yield from _dealt(lefts[pairs // total], pairs % total, times, cells, kind, sizes.sent_counts)
    yield from flush()


def count_level(blocks: DataFrame, size: int, shards: list[Shard], most: int = WORDS, least: int = LEAST, sizes: Sizes = Sizes()) -> DataFrame:
    """Stored rows (left, right, n) with n >= ``least``: phrases of ``size`` words by id, ``right`` -1, and pairs of neighbours."""
    small = sum(s.size for s in shards) < SMALL_IDS
    name, kind = ("int", pa.int32()) if small else ("long", pa.int64())
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Never fewer cells than tasks.
    work = partial(_level, size=size, most=most, shards=shards, cells=max(CELLS, parts), kind=kind, sizes=sizes)
    lists = blocks.mapInArrow(work, f"cell int, left array<{name}>, right array<{name}>, n array<long>").repartition(parts, "cell")
    rows = lists.select("cell", F.explode(F.arrays_zip("left", "right", "n")).alias("r")).select("cell", "r.left", "r.right", "r.n")
    summed = rows.groupBy("cell", "left", "right").agg(F.sum("n").alias("n"))
    return materialize(summed.filter(F.col("n") >= least).select(F.col("left").cast("long"), F.col("right").cast("long"), "n"), f"phrase_level_{size}")


def longer_keys(found: DataFrame, numbered: DataFrame) -> DataFrame:
    """``key`` of phrases that are a numbered one followed by the last word of another that overlaps it in all but its first."""
    pairs = found.filter("right >= 0").join(numbered.select(F.col("id").alias("left"), "key"), "left")
    last = F.substring_index(F.substring_index("key", "\n", -1), " ", -1)
    return pairs.join(numbered.select(F.col("id").alias("right"), last.alias("last")), "right").select(F.concat("key", F.lit(" "), "last").alias("key"))


def frequent_phrases(df: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = WORDS, least: int = LEAST, sizes: Sizes = Sizes()) -> tuple[DataFrame, DataFrame]:
    """(lang, n) with all word occurrences, and (lang, phrase, words, f) of phrases with f >= ``least``."""
    blocks = encode_blocks(df, text_col, lang_col, sizes)
    words = count_words(blocks, least)
    whole = words.filter(F.col("key").endswith("\n")).select(_language(), F.col("n"))
    candidates = words.filter(~F.col("key").endswith("\n"))
    levels = []
    for size in range(1, most + 1):
        numbered, shards = build_tries(candidates, f"phrase_tries_{size}", sizes)
        found = count_level(blocks, size, shards, most, least, sizes)
        counted = found.filter("right < 0").select(F.col("left").alias("id"), "n").join(numbered, "id")
        levels.append(counted.select(_language(), F.substring_index("key", "\n", -1).alias("phrase"), F.lit(size).alias("words"), F.col("n").alias("f")))
        candidates = longer_keys(found, numbered)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return whole, materialize(out, "phrases")


def _language():
    """All of a key before its last line feed: no phrase holds one."""
    phrase = F.length(F.substring_index("key", "\n", -1))
    return F.substring(F.col("key"), F.lit(1), F.length("key") - phrase - F.lit(1)).alias("lang")


def _ratio(a: str, left: str, right: str):
    wide = "DECIMAL(38, 0)"
    return F.expr(f"(CAST({a} AS {wide}) * {a} * {SCALE}) div (CAST({left} AS {wide}) * {right})")


def collocations(spark: SparkSession, whole: DataFrame, phrases: DataFrame, top: int = TOP, covered_percent: int = COVERED_PERCENT) -> DataFrame:
    """The best phrases of two and three words of each language: lang, rank, phrase, a, l, r, n, score."""
    word = phrases.filter("words = 1").select("lang", F.col("phrase").alias("part"), "f")
    pair = phrases.filter("words = 2").select("lang", F.col("phrase").alias("part"), "f")
    parts = F.split("phrase", " ")

    def with_count(df: DataFrame, of: DataFrame, part, name: str) -> DataFrame:
        return df.withColumn("part", part).join(of.withColumnRenamed("f", name), ["lang", "part"]).drop("part")

    def joined(first: int, last: int):
        return F.array_join(F.slice(parts, first, last - first + 1), " ")

    twos = phrases.filter("words = 2").select("lang", "phrase", F.col("f").alias("a"))
    threes = phrases.filter("words = 3").select("lang", "phrase", F.col("f").alias("a"))
    covering = threes.select("lang", F.explode(F.array(joined(1, 2), joined(2, 3))).alias("phrase"), F.col("a").alias("longer"))
    covering = covering.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    free = twos.join(covering, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * covered_percent))
    twos = with_count(with_count(free.drop("longer"), word, parts[0], "l"), word, parts[1], "r")
    for part, of, name in ((parts[0], word, "l1"), (joined(2, 3), pair, "r1"), (joined(1, 2), pair, "l2"), (parts[2], word, "r2")):
        threes = with_count(threes, of, part, name)
    threes = threes.withColumn("s1", _ratio("a", "l1", "r1")).withColumn("s2", _ratio("a", "l2", "r2"))
    early = F.col("s1") <= F.col("s2")
    threes = threes.select("lang", "phrase", "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    scored = twos.withColumn("score", _ratio("a", "l", "r")).select(threes.columns).unionByName(threes)
    best = top_per_key(scored, ["lang"], [F.desc("score"), F.desc("a"), F.col("phrase")], top, "rank")
    # One row per language.
    return best.join(whole, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
