"""Class model: exchange against all moves, counts and scores against brute force, held-out gain."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import class_model
from millrace.llm.class_model import _token_values, fit, score
from millrace.llm.query_scoring import op12_class_model
from millrace.llm.word_classes import ENTRY, exchange, likelihood, moved, nearest, rows_by_word
from millrace.session import Tables


def table_of(bigrams, of_item, size):
    out = np.zeros((size, size))
    for (a, b), n in bigrams.items():
        out[of_item[a], of_item[b]] += n
    return out


@pytest.mark.parametrize("seed", range(6))
def test_a_move_is_the_best_of_all(seed):
    rng = random.Random(seed)
    words, classes = 9, 4
    of_item = [rng.randrange(classes) for _ in range(words)] + [classes]
    bigrams = Counter((rng.randrange(words + 1), rng.randrange(words + 1)) for _ in range(80))
    counts = table_of(bigrams, of_item, classes + 1)
    for word in range(words):
        left, right = np.zeros(classes + 1), np.zeros(classes + 1)
        for (a, b), n in bigrams.items():
            if b == word:
                left[of_item[a]] += n
            if a == word:
                right[of_item[b]] += n
        after, best = moved(counts, left, right, bigrams[word, word], of_item[word], classes)
        choices = [likelihood(table_of(bigrams, of_item[:word] + [k] + of_item[word + 1 :], classes + 1)) for k in range(classes)]
        assert choices[best] == pytest.approx(max(choices))
        of_item[word] = best
        counts = table_of(bigrams, of_item, classes + 1)
        assert np.allclose(after, counts)


def test_exchange_finds_planted_classes(spark):
    rng = random.Random(3)
    kinds = [list(range(k, 30, 3)) for k in range(3)]  # words of kind k are followed by kind k + 1
    text = [rng.choice(kinds[i % 3]) for i in range(6000)]
    bigrams = Counter(zip(text, text[1:]))
    pairs = spark.createDataFrame([(a, b, n) for (a, b), n in bigrams.items()], "first int, second int, n long")
    first_round = likelihood(exchange(pairs, 30, 3, rounds=1)[1])
    of_item, counts = exchange(pairs, 30, 3, rounds=8)
    assert likelihood(counts) >= first_round and of_item[30:].tolist() == [4, 3]
    assert np.array_equal(counts, table_of(bigrams, of_item, 5))
    assert [len({of_item[w] for w in kind}) for kind in kinds] == [1, 1, 1] and len(set(of_item[:30])) == 3
    # A word seen with the same neighbours as kind 1 goes to its class.
    left, right = np.zeros((1, 5)), np.zeros((1, 5))
    left[0, of_item[0]], right[0, of_item[2]] = 2, 2
    assert nearest(left, right, counts, 3).tolist() == [of_item[1]]


def test_vectors_add_up_over_batches():
    rng = random.Random(1)
    rows, sums = [], defaultdict(lambda: np.zeros(6))
    for word in sorted(f"w{i % 40}" for i in range(300)):
        keys = sorted(rng.sample(range(6), rng.randint(1, 4)))
        cells = np.array([(k, rng.randint(1, 9)) for k in keys], ENTRY)
        rows.append((word, cells.tobytes()))
        np.add.at(sums[word], cells["key"], cells["n"])
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[a : a + 7]]), pa.array([r[1] for r in rows[a : a + 7]], pa.binary())], names=["word", "vector"]) for a in range(0, 300, 7)]
    got = {w: v for words, vectors in rows_by_word(iter(batches), 6) for w, v in zip(words, vectors)}
    assert got.keys() == sums.keys() and all(np.array_equal(got[w], sums[w]) for w in sums)


def some_docs(seed, n=120):
    rng = random.Random(seed)
    words = [f"{c}{i}" for c in "abc" for i in range(12)] + ["The", "É", "x\x00y", "日本"]
    rows = [(i, "".join(rng.choice(words) + rng.choice([" ", "\n", "\t ", "  ", "\x0b"]) for _ in range(rng.randint(0, 40)))) for i in range(n)]
    return rows + [(500, None), (501, ""), (None, "a1 b1 never"), (7, rows[7][1]), (7, rows[7][1]), (502, "once only " + "b2 c3 " * 3000)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1.5) for r in rows], "doc_id long, text string, word string, score double").repartition(parts)


def tokens_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[^ \t-\r]+", text or "")]


@pytest.mark.parametrize("sizes", [dict(), dict(classes=5, most_frequent=12, block_bytes=400)])
def test_scores_match_brute_force(spark, sizes):
    rows = some_docs(2)
    df = frame(spark, rows)
    known, model = fit(df, **sizes)
    held = lambda i: zlib.crc32(("null" if i is None else str(i)).encode()) % 10 == 0
    counts = Counter(t for i, x in rows if not held(i) for t in [*tokens_of(x), None])
    total, kinds = sum(counts.values()), len(counts)
    once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
    discount = min(max(once / (once + 2 * twice), 0.05), 0.95)
    assert (model.tokens, model.types, model.discount) == (total, kinds, pytest.approx(discount))
    # Each word has one class, wherever it stands.
    classes, blocks = {}, []
    for block in known.collect():
        texts, c, klass = _token_values(block.asDict(), model.ends, model.classes)
        assert model.ends == counts[None]
        starts = [*np.flatnonzero(np.diff(texts.text, prepend=-1)).tolist(), len(c)]
        blocks += [(texts.ids[d].as_py(), c[a:b].tolist(), klass[a:b].tolist()) for d, (a, b) in enumerate(zip(starts, starts[1:]))]
    by_key = defaultdict(list)
    for i, x in rows:
        by_key[i, tuple(counts[t] for t in [*tokens_of(x), None])].append(tokens_of(x))
    for i, c, klass in blocks:
        for t, k in zip([*by_key[i, tuple(c)][0], None], klass):
            assert classes.setdefault(t, k) == k
    unknown, end = model.classes + 1, model.classes
    assert all((classes[t] == unknown) == (counts[t] == 0) for t in classes) and classes[None] == end
    table = np.zeros((model.classes + 2,) * 2)
    mass = np.zeros(model.classes + 2)
    for t, c in counts.items():
        mass[classes[t]] += c - discount
    for i, x in rows:
        if not held(i):
            words = [*tokens_of(x), None]
            for a, b in zip([None, *words], words):
                p, q = discount / counts[a], discount / counts[b]
                table[classes[a], classes[b]] += (1 - p) * (1 - q)
                table[unknown, classes[b]] += p * (1 - q)
                table[classes[a], unknown] += (1 - p) * q
                table[unknown, unknown] += p * q
    share = table.sum(0) / table.sum()
    smooth = (table + 10 * share) / (table.sum(1, keepdims=True) + 10)
    assert np.allclose(smooth.sum(1), 1) and np.allclose(10**model.transition, smooth, rtol=1e-3, atol=1e-5)
    expect = []
    for i, x in rows:
        words, base, logs = [*tokens_of(x), None], 0.0, 0.0
        for a, b in zip([None, *words], words):
            base += math.log10((counts[b] + 0.1) / (total + 0.1 * (kinds + 1)))
            emission = 1 if classes[b] >= end else (counts[b] - discount) / mass[classes[b]]
            logs += math.log10(smooth[classes[a], classes[b]] * emission)
        expect.append((-1 if i is None else i, held(i), len(words), sum(counts[t] > 0 for t in words), total, base, logs))
    got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in score(df, **sizes).collect())
    for g, e in zip(got, sorted(expect), strict=True):
        assert g[:5] == e[:5] and g[5:] == pytest.approx(e[5:], rel=1e-4)


def test_without_training_documents(spark):
    rows = [(i, "a b") for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0][:5]
    got = score(frame(spark, rows)).collect()
    assert [tuple(r)[1:] for r in got] == [(True, 3, 0, 0, 0.0, 0.0)] * 5
    assert score(frame(spark, rows).limit(0)).count() == 0


def test_query_beats_single_words_on_held_out_text(spark):
    found = op12_class_model(Tables(spark, "/root/testdata/sf0.01")).toPandas()
    assert found["doc_id"].is_unique and len(found) == 1000
    held = found[found["held_out"]]
    assert held["score"].sum() > held["base_score"].sum() and (found["score"] < 0).all()
    assert set(found[~found["held_out"]].eval("n_tokens - n_known")) == {0}
    assert class_model.MOST_FREQUENT == 10_000
