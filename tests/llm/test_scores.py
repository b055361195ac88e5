"""Quality network and divergence rules."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF
from millrace.llm import divergence_rules, quality_cnn

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts_by_hand(text):
    words = WORD.findall(text or "")
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = {j + k for j in range(len(words) - 2) if seen[tuple(words[j : j + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


ODD = [None, "", " \n ", "a", "a b c a b c", "x\n\nx\nx \n", "# é$日|  *", "a b\x0bc\x0cd\re\x1cf\xa0g", "z " * 3000]


def test_counts_match_plain_python(spark):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r[k] for k in divergence_rules.FEATURES) for r in divergence_rules.measured(df, keep=["doc_id"]).collect()}
    assert got == {i: counts_by_hand(t) for i, t in enumerate(texts)}


def test_distance_is_jensen_shannon():
    p, q = np.array([3, 1, 0]), np.array([1.0, 1, 2])
    a, b = p / p.sum(), q / q.sum()
    m = (a + b) / 2
    js = sum(x * np.log2(x / y) for x, y in zip(a, m) if x) / 2 + sum(x * np.log2(x / y) for x, y in zip(b, m) if x) / 2
    assert divergence_rules.distance(np.array([p]), q)[0] == pytest.approx(np.sqrt(js))
    assert divergence_rules.distance(np.array([[0, 0, 0]]), q)[0] == 1
    assert divergence_rules.distance(np.array([[1, 1, 2]]), q)[0] == pytest.approx(0)


def test_rules_reject_junk_and_keep_prose(spark):
    rng = np.random.default_rng(1)
    words = "the of and to in a is that house tree river moving quickly under bright lights for it was on".split()
    prose = [(i, " ".join(rng.choice(words, 200)) + ".", "en") for i in range(40)]
    junk = [(100, " ".join(w + "&&&%%" for w in rng.choice(words, 200)), "en"), (101, " | ".join(f"zq{i}x" for i in range(200)), "en"), (102, None, None), (103, "few words", "xx"), (104, "the same words again " * 60, "en")]
    df = spark.createDataFrame([(*r, 1) for r in prose + junk], "doc_id long, text string, lang string, kept int")
    judged = {r.doc_id: r for r in divergence_rules.judge(df).collect()}
    assert all(judged[i].kept for i in range(40))
    assert not any(judged[i].kept for i in range(100, 105))
    assert [judged[i].base_failed for i in range(100, 105)] == [False, False, True, True, True]
    assert divergence_rules.judge(df.limit(0)).count() == 0
    alone = divergence_rules.judge(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert all(r.kept == (not r.base_failed) and r.word_distance is None for r in alone)


def test_network_learns_and_scores_whole_texts():
    rng = np.random.default_rng(3)
    good = [" ".join(rng.choice(["river", "stone", "light", "cloud", "window"], rng.integers(5, 300))).encode() for _ in range(150)]
    bad = [(" ".join(rng.choice(["ri#ver$", "st%one&"], rng.integers(5, 300)))).encode() for _ in range(150)]
    y = np.array([1.0] * 150 + [0.0] * 150)
    net = quality_cnn.fit(good[:100] + bad[:100], np.r_[y[:100], y[150:250]], np.ones(200), epochs=4)
    again = quality_cnn.fit(good[:100] + bad[:100], np.r_[y[:100], y[150:250]], np.ones(200), epochs=4)
    assert all((net[k] == again[k]).all() for k in net)
    scores = quality_cnn.score_texts(net, pa.array([t.decode() for t in good[100:] + bad[100:]]))
    assert (scores[:50] > 0.5).mean() > 0.95 and (scores[50:] < 0.5).mean() > 0.95
    # The end of a very long text counts as its start does, and blocks do not change a score.
    long = b" ".join(good * 5)
    ends = quality_cnn.score_texts(net, pa.array([long.decode(), (long + b" " + b" ".join(bad * 5)).decode(), None, ""]))
    assert ends[0] > ends[1] and ends[2] == ends[3]
    features = quality_cnn._features(net, np.frombuffer(long, np.uint8))
    old, quality_cnn.BLOCK_SECTIONS = quality_cnn.BLOCK_SECTIONS, 7
    assert np.allclose(features, quality_cnn._features(net, np.frombuffer(long, np.uint8)))
    quality_cnn.BLOCK_SECTIONS = old


def test_gradients_are_derivatives():
    rng = np.random.default_rng(0)
    bodies = [np.frombuffer(rng.integers(97, 123, n, dtype=np.uint8).tobytes(), np.uint8) for n in (3, 700, 9000)]
    y, w = np.array([1.0, 0, 1]), np.array([1.0, 2, 0.5])
    net = quality_cnn.fit([b.tobytes() for b in bodies], y, w, epochs=1)
    net = {k: v.astype(np.float64) for k, v in net.items()}

    def loss(changed):
        p = quality_cnn._head(changed, np.stack([quality_cnn._features(changed, b) for b in bodies]))[1]
        return -(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / w.sum()

    grads = quality_cnn._gradients(net, bodies, y, w)
    for k in ("w1", "w2", "filters", "bias"):
        at = np.unravel_index(np.abs(grads[k]).argmax(), grads[k].shape)
        up, down = {**net, k: net[k].copy()}, {**net, k: net[k].copy()}
        up[k][at] += 1e-4
        down[k][at] -= 1e-4
        assert (loss(up) - loss(down)) / 2e-4 == pytest.approx(grads[k][at], rel=2e-2, abs=1e-5)


def test_training_is_bounded_and_leaves_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    picked, sizes = quality_cnn.sample_labels(labels, "doc_id", "quality", 5)
    assert len(picked) <= 10 and sum(sizes.values()) == labels.filter(~quality_cnn.held_out()).count()
    held = {r.doc_id for r in labels.filter(quality_cnn.held_out()).collect()}
    assert not held & {p[0] for p in picked}
    net = quality_cnn.train(docs, labels, train_rows=20, train_bytes=100_000, epochs=1)
    df = docs.withColumn("score", F.lit("x")).unionByName(spark.createDataFrame([(None, None, None, None, None, "y"), (7, "", "en", "s", 0, "z")], "doc_id long, text string, lang string, source string, n_chars long, score string"))
    scored = quality_cnn.score(df, net)
    assert sorted(scored.columns) == sorted([*docs.columns, "score", "predicted"])
    rows = scored.collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert quality_cnn.score(df.limit(0), net).count() == 0
    assert quality_cnn.train(docs, labels.filter("quality = 1"))["share"] == 1
    assert quality_cnn.train(docs, labels.limit(0))["share"] == 0.5


def test_repeated_ids_stay_bounded(spark):
    """A thousand copies of one id, and of its label, weigh as one, and extra columns do no harm."""
    docs = spark.createDataFrame([(1, "x" * 1990 + str(i % 7), i, "p") for i in range(1000)] + [(i, f"text number {i}", i, "p") for i in range(2, 60)], "doc_id long, text string, _id int, `a.b` string")
    labels = spark.createDataFrame([(1, 1, 5)] * 1500 + [(i, i % 2, 5) for i in range(2, 60)], "doc_id long, quality int, _label int")
    usable = labels.filter(~quality_cnn.held_out()).select("doc_id", "quality").distinct().groupBy("quality").count().collect()
    picked, sizes = quality_cnn.sample_labels(labels, "doc_id", "quality", 20)
    assert sizes == {r["quality"]: r["count"] for r in usable} and len(picked) == len(set(picked)) <= 40
    seen = []
    original, quality_cnn.fit = quality_cnn.fit, lambda texts, *a, **k: seen.append(texts) or {"share": 0.25}
    try:
        net = quality_cnn.train(docs, labels, train_rows=20, train_bytes=5000)
    finally:
        quality_cnn.fit = original
    assert sum(map(len, seen[0])) <= 5000 and len(seen[0]) <= 40 and sum(t.startswith(b"xxx") for t in seen[0]) <= 1
    assert quality_cnn.score(docs, net).columns == ["doc_id", "text", "_id", "a.b", "score", "predicted"]
    assert quality_cnn.score(docs, net).filter("score = 0.25").count() == 1058


def test_score_is_that_of_a_plain_network():
    """The same numbers from loops over every chunk, section and unit."""
    rng = np.random.default_rng(5)
    net = quality_cnn.fit([b"good words here", b"zzzz qqqq" * 9], np.array([1.0, 0.0]), np.ones(2), epochs=1)
    for size in (0, 3, 16, 17, 700, 40_000):
        text = bytes(rng.integers(32, 127, size).astype(np.uint8))
        n = -(-max(size - quality_cnn.WIDTH, 0) // quality_cnn.STRIDE) + 1
        n = -(-n // quality_cnn.SECTION) * quality_cnn.SECTION
        sections = []
        for i in range(n):
            chunk = [text[j] if j < size else quality_cnn.PAD for j in range(i * quality_cnn.STRIDE, i * quality_cnn.STRIDE + quality_cnn.WIDTH)]
            value = np.concatenate([net["embed"][b] for b in chunk]) @ net["filters"] + net["bias"]
            if i % quality_cnn.SECTION == 0:
                sections.append(np.zeros_like(value))
            sections[-1] = np.maximum(sections[-1], value)
        x = np.concatenate([np.mean(sections, 0), np.max(sections, 0)])
        hidden = np.maximum(x @ net["w1"] + net["b1"], 0)
        expect = 1 / (1 + np.exp(-(hidden @ net["w2"] + net["b2"])))
        assert quality_cnn.score_texts(net, pa.array([text.decode()]))[0] == pytest.approx(expect, rel=1e-4)
