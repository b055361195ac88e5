"""Phrases: tries against dictionaries, counts and scores against brute force and SQL, hot rows, many shards."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import phrases, query_phrases
from millrace.llm.coded_words import coded_words
from millrace.llm.double_array import DoubleArray, build
from millrace.session import Tables


def brute(rows, least, top, covered=50):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    counts, whole = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            whole[lang] += len(words)
            counts[lang].update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    out = []
    for lang, found in counts.items():
        chosen = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in chosen.items():
            if any(len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:]) and 100 * f >= covered * a for q, f in chosen.items()):
                continue
            score, k = min((10**6 * a * a // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, whole[lang], -score))
    return sorted(out)


def mined(spark, rows, least, top=2000, parts=3):
    df = spark.createDataFrame(rows, "lang string, text string, n long, `a.b` string, key string").repartition(parts)
    whole, found = phrases.frequent_phrases(df, least=least)
    return sorted(tuple(r) for r in phrases.collocations(spark, whole, found, top).collect())


@pytest.mark.parametrize("n, signs", [(0, b"a"), (1, b"a"), (60, b"ab"), (4000, bytes(range(256))), (20_000, b"etaoins ")])
def test_trie_finds_its_keys_alone(n, signs):
    rng = random.Random(n)
    keys = sorted({bytes(rng.choices(signs, k=rng.randint(1, 12))) for _ in range(n)})
    trie = DoubleArray.from_bytes(build(pa.array(keys, pa.binary())).to_bytes())
    probes = keys + [k + b"x" for k in keys[:300]] + [k[:-1] for k in keys[:300] if len(k) > 1] + [b"\xff", b"\x00", b"q" * 40]
    body, lengths = np.frombuffer(b"".join(probes), np.uint8), np.array([len(p) for p in probes])
    states = trie.walk(np.zeros(len(probes), np.int32), body, np.cumsum(lengths) - lengths, lengths)
    numbers = {k: i for i, k in enumerate(keys)}
    assert np.where(states >= 0, trie.value[states], -1).tolist() == [numbers.get(p, -1) for p in probes]
    with pytest.raises(ValueError):
        DoubleArray.from_bytes(trie.to_bytes()[:-4])


def test_words_and_pieces():
    texts = ["One two.Three", "", None, " .,a", "b", "x\ty\nÉté Z", ". q"]
    found = coded_words(pa.array(texts), b" \t", b".,\n")
    words = [w.decode() for w in found.words.take(pa.array(found.codes)).to_pylist()]
    assert words == ["one", "two", "three", "a", "b", "x", "y", "Été", "z", "q"]
    assert found.begins.tolist() == [True, False, True, True, True, True, False, True, False, True]
    assert found.first.tolist() == [0, 3, 3, 3, 4, 5, 9, 10]


def some_rows(seed, n=250):
    rng = random.Random(seed)
    words = ["a", "B", "the", "New", "york", "city", "é", "日本", "x-y", "\x00", "a"]
    marks = [" ", " ", "  ", "\t", " ", ". ", ",", "\n", "\r\n", "\x0b"]
    rows = [(rng.choice(["en", "fr", None, "", "und", "e\nn"]), "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 60)))) for _ in range(n)]
    rows += [("en", None), ("en", ""), ("zz", "only once")] + [("fr", "New york city hall, new york city")] * 200
    rows += [("en", "long words " + "y" * 3000 + " again " * 5000)]
    return [(lang, text, 1, "x", "k") for lang, text in rows]


@pytest.mark.parametrize("least", [2, 10])
def test_same_as_brute_force(spark, least):
    rows = some_rows(least)
    assert mined(spark, rows, least) == brute([r[:2] for r in rows], least, 2000)


def test_many_small_tries_and_blocks(spark):
    rows = some_rows(5)
    df = spark.createDataFrame(rows, "lang string, text string, n long, `a.b` string, key string").repartition(3)
    small = phrases.Sizes(block_bytes=500, shard_keys=5, held_bytes=1, held_counts=3)
    whole, found = phrases.frequent_phrases(df, least=3, sizes=small)
    got = sorted(tuple(r) for r in phrases.collocations(spark, whole, found, 7).collect())
    assert got == brute([r[:2] for r in rows], 3, 7)
    keys = spark.range(100).select(F.concat(F.lit("en\n"), F.col("id").cast("string")).alias("key"))
    built, shards = phrases.build_tries(keys, "few", phrases.Sizes(shard_keys=5))
    assert len(shards) >= 20 and built.groupBy("key").count().filter("count = 1").count() == 100


def test_candidates_travel_as_numbers_in_few_lists(spark):
    rng = random.Random(3)
    texts = [("en", " ".join(f"word{rng.randrange(300)}" for _ in range(4000))) for _ in range(10)]
    blocks = phrases.encode_blocks(spark.createDataFrame(texts, "lang string, text string").coalesce(1))
    words = phrases.count_words(blocks, 10).filter(~F.col("key").endswith("\n"))
    numbered, shards = phrases.build_tries(words, "lists")
    ids = {r["key"]: r["id"] for r in numbered.collect()}
    assert sorted(ids.values()) == list(range(300))
    want = Counter((ids["en\n" + a], ids["en\n" + b]) for _, t in texts for a, b in zip(t.split(), t.split()[1:]))
    for cells in (1, 64):
        sent = list(phrases._level(blocks.toArrow().to_batches(), 1, 3, shards, cells, pa.int32(), phrases.Sizes()))
        got, home = Counter(), {}
        for row in pa.Table.from_batches(sent).to_pylist():
            for left, right, n in zip(row["left"], row["right"], row["n"]):
                got[left, right] += n
                assert home.setdefault((left, right), row["cell"]) == row["cell"]
        assert {k: n for k, n in got.items() if k[1] >= 0} == want
        # A list per cell for the pairs and one for the words' own counts, however many pairs there are.
        assert sum(b.num_rows for b in sent) <= 2 * cells and sum(b.nbytes for b in sent) < 17 * len(got) + 100 * cells


def test_empty_table(spark):
    df = spark.createDataFrame([], "lang string, text string")
    whole, found = phrases.frequent_phrases(df)
    assert whole.count() == 0 and phrases.collocations(spark, whole, found).count() == 0


def test_large_counts_stay_exact(spark):
    big = 3_000_000_019
    whole = spark.createDataFrame([("en", 10**12)], "lang string, n long")
    rows = [("en", "x", 1, big + 7), ("en", "y", 1, big + 3), ("en", "x y", 2, big)]
    found = spark.createDataFrame(rows, "lang string, phrase string, words int, f long")
    (row,) = phrases.collocations(spark, whole, found).collect()
    assert row["score"] == 10**6 * big * big // ((big + 7) * (big + 3)) and row["n"] == 10**12


def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.01"
    got = sorted(tuple(r) for r in query_phrases.op13_phrases(Tables(spark, folder)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    result = con.execute(query_phrases.SQL)
    assert [d[0] for d in result.description] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert got == sorted(result.fetchall()) and len(got) > 500
