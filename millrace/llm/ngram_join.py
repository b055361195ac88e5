"""N-gram Jaccard join: all texts whose sets of five-word n-grams are at least 0.8 alike.

Exact copies (equal words after lower-casing) are one text from the start. Each text gets MinHash
values in bands; the number of bands and of rows per band follow from the recall wanted at the
threshold. Texts that meet in a band are candidates, and every candidate pair is verified on the
full n-gram sets.

Where many texts meet, pairs are counted, never listed. A connected part of the candidate graph
is one unit of work: its sets travel once. A part too large for one task is cut into blocks, and
each pair of blocks is a unit; beyond ``MOST_BLOCKS`` blocks the texts go to their bands instead,
and a pair counts in the first band it shares. A unit gives each text its number of links and one
edge towards the others, so classes (connected components of links) need no list of pairs.

Defined results: a text with fewer than five words is one n-gram of all its words; a null, empty
or blank text has no n-grams, no links and a class of its own document alone. ``class_id`` is the
least id in the class (null if it has none). Rows equal in id and text get equal results. An empty
table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.support import doc_key, set_aside, ship, small_batches
from millrace.llm.textcodes import chunks, words
from millrace.operators.ranking import top_per_key
from millrace.storage import materialize

N_WORDS = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.9995
MOST_HASHES = 100
SEED = 20240229
UNIT_GRAMS = 4_000_000
UNIT_COST = 2_000_000_000
MOST_BLOCKS = 8


def choose_bands(threshold: float = THRESHOLD, recall: float = TARGET_RECALL, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band for which ``recall`` is met at the threshold."""
    best = None
    for rows in range(1, most_hashes + 1):
        chance = threshold**rows
        bands = 1 if chance >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-chance))
        if bands * rows <= most_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("more hashes are needed for this recall")
    return best


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of ``n`` word hashes."""
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - n + 1 + k]
    return _mixed(out)


def grams(texts: pa.Array, n: int = N_WORDS) -> tuple[np.ndarray, np.ndarray, list[bytes | None]]:
    """N-gram hashes of all texts one after another, their offsets, and an identity per text (None: no words)."""
    found = words(chunks(texts))
    of_word = np.array([xxhash.xxh3_64_intdigest(w.decode(errors="replace").lower().encode()) for w in found.words], np.uint64)
    hashes = of_word[found.codes] if len(found.codes) else np.empty(0, np.uint64)
    counts = np.diff(found.first)
    at = np.concatenate(([0], np.cumsum(np.where(counts >= n, counts - n + 1, np.minimum(counts, 1)))))
    out = np.empty(at[-1], np.uint64)
    if len(hashes) >= n:
        windows = _rolled(hashes, n)
        starts = np.repeat(found.first[:-1] - at[:-1], np.diff(at)) + np.arange(at[-1])
        out = windows[np.minimum(starts, len(windows) - 1)]
    for d in np.flatnonzero((counts > 0) & (counts < n)).tolist():
        out[at[d]] = _rolled(hashes[found.first[d] : found.first[d + 1]], int(counts[d]))[0]
    identity = [hashlib.md5(hashes[a:b].tobytes(), usedforsecurity=False).digest() if b > a else None for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist())]
    return out, at, identity


def signatures(hashes: np.ndarray, at: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes [texts, bands] of texts that all have n-grams."""
    rng = np.random.default_rng(SEED)
    factors = rng.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
    out = np.zeros((len(at) - 1, bands), np.uint64)
    for band in range(bands):
        for k in range(band * rows, band * rows + rows):
            least = np.minimum.reduceat(hashes * factors[k] + shifts[k], at[:-1])
            out[:, band] = _mixed(out[:, band] * np.uint64(31) + least)
    return out.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch], n: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in small_batches(whole, "_text"):
            hashes, at, identity = grams(batch.column("_text"), n)
            full = np.flatnonzero(np.diff(at))
            signed = np.zeros((batch.num_rows, bands), np.int64)
            if len(full):
                signed[full] = signatures(hashes, at[np.append(full, len(at) - 1)], bands, rows)
            lists = pa.ListArray.from_arrays(np.arange(0, signed.size + 1, bands, dtype=np.int32), pa.array(signed.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["_id", "_k1", "_k2"]).columns, pa.array(identity, pa.binary()), pa.array(np.diff(at), pa.int64()), lists],
                names=["_id", "_k1", "_k2", "_t", "_n", "_bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """The n-gram set of each text, sorted."""
    for whole in batches:
        for batch in small_batches(whole, "_text"):
            hashes, at, identity = grams(batch.column("_text"), n)
            sets = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(at[:-1], at[1:])]
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(identity, pa.binary()), lists], names=["_t", "_set"])


def count_links(sets: list[np.ndarray], bands: np.ndarray, side: np.ndarray, across: bool, first_band: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each text within one unit, and a text each is joined to (itself if to none before).

    ``across``: only pairs of different ``side`` count. ``first_band`` at least 0: only pairs whose first
    common band it is. Candidates are verified on the sets; no list of pairs is made.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate(([0], np.cumsum(sizes)))
    code = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(code.max() + 1, np.uint8)
    links, root = np.zeros(m, np.int64), list(range(m))

    def top(v: int) -> int:
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for a in range(m - 1):
        equal = bands[a + 1 :] == bands[a]
        if first_band >= 0:
            candidate = equal[:, first_band] & ~equal[:, :first_band].any(1)
        else:
            candidate = equal.any(1)
        if across:
            candidate &= side[a + 1 :] != side[a]
        low, high = np.minimum(sizes[a + 1 :], sizes[a]), np.maximum(sizes[a + 1 :], sizes[a])
        candidate &= low >= threshold * high - 1e-9
        others = np.flatnonzero(candidate) + a + 1
        if not len(others):
            continue
        own = code[starts[a] : starts[a + 1]]
        mark[own] = 1
        if 3 * sizes[others].sum() > starts[m] - starts[a + 1]:
            common = np.add.reduceat(mark[code[starts[a + 1] :]], starts[a + 1 : m] - starts[a + 1], dtype=np.int64)[others - a - 1]
        else:
            common = np.array([np.count_nonzero(mark[code[starts[b] : starts[b + 1]]]) for b in others.tolist()])
        mark[own] = 0
        linked = others[common / (sizes[others] + sizes[a] - common) >= threshold]
        links[a] += len(linked)
        links[linked] += 1
        for b in linked.tolist():
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return links, np.array([top(v) for v in range(m)])


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Units stand one after another, sorted; each is gathered and worked through."""
    unit, held = None, []

    def done() -> pa.RecordBatch | None:
        side, across = np.array([h[1] for h in held]), bool(held) and unit[2] != unit[3]
        # A unit of two blocks of which one is empty has nothing to count: pairs within a block have a unit of their own.
        if len(held) < 2 or across and (side == side[0]).all():
            return None
        sets = [h[2] for h in held]
        links, root = count_links(sets, np.stack([h[3] for h in held]), side, across, unit[1], threshold)
        some = np.flatnonzero(links)
        names = [h[0] for h in held]
        return pa.RecordBatch.from_arrays(
            [pa.array([names[i] for i in some], pa.binary()), pa.array([names[root[i]] for i in some], pa.binary()), pa.array(links[some], pa.int64())], names=["_t", "_root", "_links"]
        )

    for batch in batches:
        lists, bands = batch.column("_set"), batch.column("_bands")
        keys = list(zip(*[batch.column(c).to_pylist() for c in ("_unit", "_band", "_x", "_y")]))
        names, sides = batch.column("_t").to_pylist(), batch.column("_block").to_pylist()
        for i, key in enumerate(keys):
            if key != unit:
                if (out := done()) is not None and out.num_rows:
                    yield out
                unit, held = key, []
            held.append((names[i], sides[i], lists[i].values.to_numpy(), bands[i].values.to_numpy()))
    if (out := done()) is not None and out.num_rows:
        yield out


def _units(members: DataFrame, group: str, unit_grams: int, unit_cost: int) -> DataFrame:
    """Members (``group``, ``_t``, ``_n``) with the number of blocks their group needs."""
    sums = members.groupBy(group).agg(F.count(F.lit(1)).alias("_m"), F.sum("_n").alias("_total"))
    cost = F.sqrt(F.col("_m").cast("double") * F.col("_total") / unit_cost)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_total") / unit_grams), F.ceil(cost)).cast("int")
    return sums.select(F.col(group).alias("_g"), blocks.alias("_blocks"))


def _spread(members: DataFrame) -> DataFrame:
    """Each member in every pair of blocks that its block belongs to: ``_x`` <= ``_y``."""
    placed = members.withColumn("_block", F.pmod(F.xxhash64("_t", F.lit(3)), F.col("_blocks").cast("long")).cast("int"))
    other = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return other.withColumns({"_x": F.least("_block", "_other"), "_y": F.greatest("_block", "_other")}).drop("_other", "_blocks")


def _classified(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N_WORDS, threshold: float = THRESHOLD, recall: float = TARGET_RECALL,
    unit_grams: int = UNIT_GRAMS, unit_cost: int = UNIT_COST, most_blocks: int = MOST_BLOCKS,
) -> DataFrame:
    """A row per row of ``df``: ``_id``, key of id and text, class, links, copies, whether it stands for its class."""
    ship(df.sparkSession)
    bands, rows = choose_bands(threshold, recall)
    kind = df.schema[id_col].dataType.simpleString()
    k1, k2 = doc_key(id_col, text_col)
    docs = df.select(F.col(id_col).alias("_id"), k1.alias("_k1"), k2.alias("_k2"), F.coalesce(text_col, F.lit("")).alias("_text"))
    signed = materialize(docs.mapInArrow(partial(_sign, n=n, bands=bands, rows=rows), f"_id {kind}, _k1 long, _k2 long, _t binary, _n long, _bands array<long>"), "signatures")
    some = signed.filter("_t is not null")
    # Copies have equal signatures, so any row's will do.
    texts = materialize(some.groupBy("_t").agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_copies"), F.first("_n").alias("_n"), F.first("_bands").alias("_bands")), "texts")

    met = texts.select("_t", "_n", F.posexplode("_bands").alias("_band", "_hash"))
    shared = materialize(met.groupBy("_band", "_hash").agg(F.count(F.lit(1)).alias("_m"), F.min("_t").alias("_first")).filter("_m > 1"), "buckets")
    entries = materialize(met.select("_t", "_n", F.struct("_band", "_hash").alias("_bucket")), "entries")
    known = shared.select(F.struct("_band", "_hash").alias("_b"), "_first")
    in_buckets = materialize(entries.join(known, F.col("_bucket") == F.col("_b")).drop("_b"), "bucket_members")
    parts = materialize(components(in_buckets.select(F.col("_t").alias("a"), F.col("_first").alias("b"))), "parts")
    sized = texts.select("_t", "_n").join(parts.withColumnRenamed("vertex", "_v"), F.col("_t") == F.col("_v"))
    in_parts = materialize(
        sized.select("_t", "_n", F.col("root")).unionByName(texts.select("_t", "_n").join(parts.select(F.col("root").alias("_t")).distinct(), "_t").withColumn("root", F.col("_t"))), "part_members"
    )
    blocks_of_part = materialize(_units(in_parts, "root", unit_grams, unit_cost), "part_blocks")
    placed = in_parts.join(blocks_of_part, F.col("root") == F.col("_g"))
    whole = placed.filter(F.col("_blocks") <= most_blocks).select("_t", F.col("root").alias("_unit"), F.lit(-1).alias("_band"), "_blocks")
    too_large = materialize(placed.filter(F.col("_blocks") > most_blocks).select(F.col("_t").alias("_v")), "large_part_members")
    of_large = materialize(in_buckets.join(too_large, F.col("_t") == F.col("_v"), "left_semi"), "large_part_buckets")
    blocks_of_bucket = materialize(_units(of_large, "_bucket", unit_grams, unit_cost), "bucket_blocks")
    by_band = of_large.join(blocks_of_bucket, F.col("_bucket") == F.col("_g"))
    hashed = by_band.select("_t", F.encode(F.col("_bucket._hash").cast("string"), "utf-8").alias("_unit"), F.col("_bucket._band").alias("_band"), "_blocks")
    work = materialize(_spread(whole.unionByName(hashed)), "units")

    wanted = materialize(work.select(F.col("_t").alias("_w")).distinct().join(texts, F.col("_w") == F.col("_t")).select("_w", "_least", "_bands"), "wanted")
    # One row of each wanted text: the one with its least id; rows without an id are found by their text.
    owners = signed.join(wanted, (F.col("_t") == F.col("_w")) & F.col("_least").eqNullSafe(F.col("_id")), "left_semi").select(F.col("_id").alias("_owner"), "_t").distinct()
    ids = materialize(owners.select("_owner").distinct(), "owners")
    source = docs.join(ids, F.col("_id").eqNullSafe(F.col("_owner")), "left_semi").select("_text")
    sets = source.mapInArrow(partial(_sets, n=n), "_t binary, _set array<long>").filter("_t is not null")
    full = materialize(wanted.select("_w", "_bands").join(sets.groupBy("_t").agg(F.first("_set").alias("_set")), F.col("_w") == F.col("_t")).select("_w", "_bands", "_set"), "sets")
    gathered = work.join(full, F.col("_t") == F.col("_w")).drop("_w")
    units = ["_unit", "_band", "_x", "_y"]
    ready = gathered.repartition(*units).sortWithinPartitions(*units, "_t").select(*units, "_block", "_t", "_bands", "_set")
    verified = materialize(ready.mapInArrow(partial(_verify, threshold=threshold), "_t binary, _root binary, _links long"), "links")

    links = verified.groupBy("_t").agg(F.sum("_links").alias("_links"))
    classes = materialize(components(verified.select(F.col("_t").alias("a"), F.col("_root").alias("b"))), "classes")
    rooted = texts.join(classes, F.col("_t") == F.col("vertex"), "left").select("_t", "_least", "_copies", F.coalesce("root", "_t").alias("_root"))
    rooted = materialize(rooted, "rooted")
    # The text of the least id stands for its class; ids that are null come last, equal ids go by text.
    first = F.min(F.struct(F.col("_least").isNull().alias("_none"), "_least", "_t"))
    least = materialize(rooted.groupBy(F.col("_root").alias("_r")).agg(first.alias("_first")), "class_ids")
    named = rooted.join(least, F.col("_root") == F.col("_r")).join(links.withColumnRenamed("_t", "_l"), F.col("_t") == F.col("_l"), "left")
    stands = F.col("_t") == F.col("_first._t")
    result = materialize(
        named.select(F.col("_t").alias("_w"), F.col("_first._least").alias("_class"), "_copies", F.coalesce("_links", F.lit(0)).alias("_links"), stands.alias("_stands")), "text_results"
    )
    out = signed.select("_id", "_k1", "_k2", "_t").join(result, F.col("_t") == F.col("_w"), "left")
    alone = F.col("_w").isNull()
    return out.select(
        "_id", "_k1", "_k2", F.when(alone, F.col("_id")).otherwise(F.col("_class")).alias("class_id"),
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_copies", F.lit(1)).cast("long").alias("n_copies"),
        (alone | (F.col("_stands") & F.col("_class").eqNullSafe(F.col("_id")))).alias("_stays"), "_t",
    )


def similar_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``class_id``, ``n_links`` (other texts linked), ``n_copies`` (rows of its text)."""
    return _classified(df, id_col, text_col, **options).select(F.col("_id").alias(id_col), "class_id", "n_links", "n_copies")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """``df`` with one document of each class, that with the least id (then text).

    Rows that have an id and are equal in id and text are one document, and all stay; of rows without an
    id each is a document, so one stays if none in the class has an id. Blank texts are classes of their own.
    """
    rest = set_aside(df, "_k1", "_k2", "_g1", "_g2", "_nth")
    found = materialize(_classified(rest, id_col, text_col, **options), "classified")
    key = F.struct("_k1", "_k2")
    # Texts with equal words can differ as strings; one string of them stands for the class.
    stay = found.filter("_stays and _t is not null").select("_t", key.alias("_key"))
    several = stay.groupBy("_t").agg(F.min("_key").alias("_one"), F.max("_key").alias("_last")).filter("_one != _last")
    several = materialize(several.select(F.col("_t").alias("_w"), "_one"), "several_strings")
    later = stay.join(several, F.col("_t") == F.col("_w")).filter("_key != _one").select("_key._k1", "_key._k2")
    gone = found.filter("not _stays").select("_k1", "_k2").unionByName(later)
    gone = materialize(gone.select(F.col("_k1").alias("_g1"), F.col("_k2").alias("_g2")).distinct(), "duplicates")
    k1, k2 = doc_key(id_col, text_col)

    def left(rows: DataFrame) -> DataFrame:
        return rows.withColumns({"_k1": k1, "_k2": k2}).join(gone, (F.col("_k1") == F.col("_g1")) & (F.col("_k2") == F.col("_g2")), "left_anti")

    nameless = F.col(f"`{id_col}`").isNull() & F.coalesce(F.col(f"`{text_col}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    others = [F.col(f"`{c}`") for c in rest.columns if c != text_col]
    once = top_per_key(left(rest.filter(nameless)), ["_k1", "_k2"], [F.to_json(F.struct(*others))], 1, "_nth").drop("_nth")
    return left(rest.filter(~nameless)).unionByName(once).drop("_k1", "_k2")
