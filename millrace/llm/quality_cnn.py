"""Quality classifier: a small convolutional network over bytes, in numpy.

A text's UTF-8 bytes are embedded, and learned filters are applied to overlapping chunks of
``WIDTH`` bytes that start every ``STRIDE`` bytes and cover the whole text. Responses are
max-pooled over sections of ``SECTION`` chunks. The mean and the maximum over all sections of a
text go through one hidden layer to one probability. Scoring reads each text in blocks of
sections, so memory does not follow the length of a text.

The network is fitted on the driver from a bounded sample of labelled rows: at most
``train_rows`` per class, in the order of a hash of the id, and at most ``train_bytes`` of text in
all. Rows are weighted back to the shares of the classes, so scores are probabilities.

Defined results: a null or empty text is scored like a text of padding only. Rows are scored one by
one, so repeated rows get equal scores. A document counts once for each label it was given, however
often it was; of texts with one id, that with the least hash is learned from. Null labels are no labels. If a class has no labelled row, or there are no labels, the score
is the share of label 1 (0.5 without labels). All other columns are kept, but for those with the name
of a result, which it replaces.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.support import extended, kept_columns, map_arrow, ship, text_buffer
from millrace.storage import materialize

WIDTH, STRIDE, SECTION = 16, 4, 128
EMBED, FILTERS, HIDDEN = 6, 24, 16
BLOCK_SECTIONS = 64
PAD = 256
THRESHOLD = 0.3
TRAIN_ROWS = 1500
TRAIN_BYTES = 24 << 20
FOLDS = 5


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose label is never learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0


def _blocks(body: np.ndarray) -> Iterator[np.ndarray]:
    """The padded text in blocks of whole sections; a block repeats the bytes its chunks share with the next."""
    n = max(1, -(-max(len(body) - WIDTH, 0) // STRIDE) + 1)
    sections = -(-n // SECTION)
    for start in range(0, sections, BLOCK_SECTIONS):
        held = min(BLOCK_SECTIONS, sections - start) * SECTION
        block = np.full((held - 1) * STRIDE + WIDTH, PAD, np.int64)
        own = body[start * SECTION * STRIDE :][: len(block)]
        block[: len(own)] = own
        yield block


def _pooled(net: dict, block: np.ndarray, where: bool = False):
    """Max-pooled filter responses of each section; with the bytes of the winning chunks if asked for."""
    embedded = net["embed"][block].reshape(-1)
    x = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * EMBED)[:: STRIDE * EMBED]
    response = (x @ net["filters"] + net["bias"]).reshape(-1, SECTION, FILTERS)
    if not where:
        return np.maximum(response.max(1), 0)
    best = response.argmax(1)
    at = (best + np.arange(len(best))[:, None] * SECTION) * STRIDE
    return np.take_along_axis(response, best[:, None, :], 1)[:, 0], block[at[..., None] + np.arange(WIDTH)]


def _features(net: dict, body: np.ndarray) -> np.ndarray:
    """Mean and maximum of the section responses of one text, block by block."""
    total, most, n = np.zeros(FILTERS, np.float64), np.zeros(FILTERS, np.float32), 0
    for block in _blocks(body):
        pooled = _pooled(net, block)
        total += pooled.sum(0)
        most = np.maximum(most, pooled.max(0))
        n += len(pooled)
    return np.concatenate([total / n, most])


def _head(net: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(x @ net["w1"] + net["b1"], 0)
    return hidden, 1 / (1 + np.exp(-np.clip(hidden @ net["w2"] + net["b2"], -30, 30)))


def score_texts(net: dict, texts: pa.Array) -> np.ndarray:
    """Probability of label 1 for each text."""
    if "share" in net:
        return np.full(len(texts), net["share"])
    body, at = text_buffer(texts)
    if not len(texts):
        return np.empty(0)
    x = np.stack([_features(net, body[a:b]) for a, b in zip(at[:-1], at[1:])])
    return _head(net, x)[1]


def fit(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, epochs: int = 8, rate: float = 0.01, seed: int = 7, group: int = 24) -> dict:
    """Fit the network by Adam on whole texts; equal input gives an equal network."""
    rng = np.random.default_rng(seed)
    net = {
        "embed": rng.normal(0, 0.5, (257, EMBED)).astype(np.float32),
        "filters": rng.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "w1": rng.normal(0, 1 / np.sqrt(2 * FILTERS), (2 * FILTERS, HIDDEN)),
        "b1": np.zeros(HIDDEN),
        "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        "b2": np.zeros(()),
    }
    first = {k: np.zeros_like(v) for k, v in net.items()}
    second = {k: np.zeros_like(v) for k, v in net.items()}
    steps, total = 0, epochs * -(-len(texts) // group)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for start in range(0, len(order), group):
            picked = order[start : start + group]
            grads = _gradients(net, [np.frombuffer(texts[i], np.uint8) for i in picked], labels[picked], weights[picked])
            steps += 1
            step = rate * 0.5 * (1 + np.cos(np.pi * steps / total))
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net[k] = (net[k] - step * (first[k] / (1 - 0.9**steps)) / (np.sqrt(second[k] / (1 - 0.999**steps)) + 1e-8)).astype(net[k].dtype)
    return net


def _gradients(net: dict, bodies: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> dict:
    parts = []
    for body in bodies:
        found = [_pooled(net, block, where=True) for block in _blocks(body)]
        parts.append((np.concatenate([v for v, _ in found]), np.concatenate([w for _, w in found])))
    x = np.stack([np.concatenate([np.maximum(v, 0).mean(0), np.maximum(v, 0).max(0)]) for v, _ in parts])
    hidden, p = _head(net, x)
    d_logit = weights * (p - labels) / weights.sum()
    grads = {"w2": hidden.T @ d_logit, "b2": d_logit.sum()}
    d_hidden = np.outer(d_logit, net["w2"]) * (hidden > 0)
    grads |= {"w1": x.T @ d_hidden, "b1": d_hidden.sum(0)}
    d_x = d_hidden @ net["w1"].T
    grads |= {"embed": np.zeros_like(net["embed"]), "filters": np.zeros_like(net["filters"]), "bias": np.zeros_like(net["bias"])}
    by_filter = net["filters"].T.reshape(FILTERS, WIDTH, EMBED)
    for (value, window), d in zip(parts, d_x):
        d_value = np.repeat(d[None, :FILTERS] / len(value), len(value), 0)
        d_value[np.maximum(value, 0).argmax(0), np.arange(FILTERS)] += d[FILTERS:]
        d_value *= value > 0
        x_in = net["embed"][window].reshape(len(value), FILTERS, WIDTH * EMBED)
        grads["filters"] += np.einsum("sf,sfi->if", d_value, x_in).astype(np.float32)
        grads["bias"] += d_value.sum(0).astype(np.float32)
        d_in = d_value[:, :, None, None] * by_filter[None]
        flat = window.reshape(-1)
        for e in range(EMBED):
            grads["embed"][:, e] += np.bincount(flat, d_in[..., e].reshape(-1), 257).astype(np.float32)
    return grads


def sample_labels(labels: DataFrame, id_col: str, label_col: str, rows: int) -> tuple[list[tuple], dict[int, int]]:
    """Up to ``rows`` labelled ids of each class in hash order, held-out ids left out, and class sizes."""
    given = F.col(f"`{label_col}`")
    usable = labels.filter(given.isin(0, 1) & F.col(f"`{id_col}`").isNotNull() & ~held_out(f"`{id_col}`"))
    usable = usable.select(F.col(f"`{id_col}`").alias("i"), given.cast("int").alias("k")).distinct()
    picked, sizes = [], {0: 0, 1: 0}
    for row in usable.groupBy("k").count().collect():
        sizes[row["k"]] = row["count"]
        own = usable.filter(F.col("k") == row["k"]).select("i")
        order = F.xxhash64("i"), F.col("i")
        picked += [(r["i"], row["k"]) for r in own.orderBy(*order).limit(rows).collect()]
    return picked, sizes


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    train_rows: int = TRAIN_ROWS, train_bytes: int = TRAIN_BYTES, **options: object,
) -> dict:
    """The fitted network, from at most ``train_rows`` labelled rows per class and ``train_bytes`` of text."""
    spark = docs.sparkSession
    picked, sizes = sample_labels(labels, id_col, label_col, train_rows)
    if not all(sizes.values()):
        known = sum(sizes.values())
        return {"share": sizes[1] / known if known else 0.5}
    wanted = spark.createDataFrame(picked, f"_id {dict(labels.dtypes)[id_col]}, _label int")
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("_text"))
    # Copies of an id meet map-side: a row per id and label is left, so at most 2 * train_rows.
    one = F.min(F.struct(F.xxhash64("_text").alias("h"), "_text")).alias("t")
    found = texts.join(F.broadcast(wanted), "_id").groupBy("_id", "_label").agg(one)
    rows = materialize(found.select("_id", "_label", F.col("t._text").alias("_text")), "training")
    order, left, taken = sorted(rows.select(F.xxhash64("_id").alias("h"), "_id", "_label", F.octet_length("_text").alias("n")).collect()), train_bytes, set()
    for r in order:
        if r["n"] <= left:
            left -= r["n"]
            taken.add((r["_id"], r["_label"]))
    table = spark.createDataFrame(sorted(taken), wanted.schema)
    data = sorted((r["_id"], r["_label"], bytes(r["_text"])) for r in rows.join(F.broadcast(table), ["_id", "_label"], "left_semi").collect())
    y = np.array([r[1] for r in data], float)
    if len(set(y.tolist())) < 2:
        return {"share": sizes[1] / sum(sizes.values())}
    share = sizes[1] / sum(sizes.values())
    weights = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return fit([r[2] for r in data], y, weights, **options)


def _score(batches: Iterator[pa.RecordBatch], net: bytes, text_col: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    model = pickle.loads(net)
    for batch in batches:
        columns = [batch.column(c) for c in keep] + [pa.array(score_texts(model, batch.column(text_col)), pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score"])


def score(df: DataFrame, net: dict, text_col: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns of every row (all when not given) with ``score`` and ``predicted``."""
    keep = kept_columns(df, keep, ("score", "predicted"))
    ship(df.sparkSession)
    needed = df.select(*[f"`{c}`" for c in dict.fromkeys([*keep, text_col])])
    scored = map_arrow(needed, partial(_score, net=pickle.dumps(net), text_col=text_col, keep=keep), extended(df.select(*[f"`{c}`" for c in keep]).schema, "score double"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
