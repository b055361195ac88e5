"""Line dedup against a table of all runs seen so far."""

import random

import pytest

from millrace.llm.line_runs import delete_repeated_runs, runs_of

SCHEMA = "doc_id long, text string"


def by_hand(docs, min_words):
    """Text of each document without lines of runs that began earlier; docs in order."""
    seen, gone = set(), {}
    for d, text in docs:
        lines = [x for x in (text or "").split("\n") if x.split()]
        for s in range(len(lines)):
            total = 0
            for e in range(s, len(lines)):
                total += len(lines[e].split())
                run = tuple(lines[s : e + 1])
                if total >= min_words and run in seen:
                    gone.setdefault(d, set()).update(range(s, e + 1))
                if total >= min_words:
                    seen.add(run)
    out = {}
    for d, text in docs:
        if text is None:
            out[d] = None
            continue
        left, seq = [], 0
        for line in text.split("\n"):
            if line.split():
                if seq not in gone.get(d, ()):
                    left.append(line)
                seq += 1
            else:
                left.append(line)
        out[d] = "\n".join(left)
    return out


def some_documents(seed):
    rng = random.Random(seed)
    lines = [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 5))) for _ in range(9)] + ["", "  "]
    blocks = [[rng.choice(lines) for _ in range(rng.randint(3, 20))] for _ in range(5)]
    docs = []
    for d in range(30):
        parts = [rng.choice(blocks) if rng.random() < 0.6 else [f"own {rng.random()}"] for _ in range(rng.randint(0, 5))]
        docs.append((d, "\n".join(x for p in parts for x in p)))
    return [*docs, (30, None), (31, ""), (32, docs[3][1])]


@pytest.mark.parametrize("seed, min_words", [(1, 1), (2, 7), (3, 33)])
def test_lines_match_brute_force(spark, seed, min_words):
    docs = some_documents(seed)
    want = by_hand(docs, min_words)
    assert sum(want[d] != t for d, t in docs) > 5
    left = delete_repeated_runs(spark.createDataFrame(docs, SCHEMA).repartition(5), min_words=min_words)
    assert {r.doc_id: r.text for r in left.collect()} == want


def test_lines_edge_cases(spark):
    line = " ".join(f"w{i}" for i in range(60))
    rows = [(None, line, 1, "x"), (2, line, 5, "y"), (2, line, 5, "y"), (3, f"a\n{line}\nb", None, None), (4, f"{line}\n{line}", 0, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_deleted_lines int, _k1 string")
    left = delete_repeated_runs(df)
    assert left.columns == ["doc_id", "text", "n_deleted_lines"]
    got = sorted((tuple(r) for r in left.collect()), key=str)
    assert got == sorted([(None, "", 1), (2, line, 0), (2, line, 0), (3, "a\nb", 1), (4, "", 2)], key=str)
    assert delete_repeated_runs(df.limit(0)).count() == 0


def test_runs_cover_whole_matches():
    import numpy as np

    assert runs_of(np.array([0, 1, 2, 5]), np.array([3, 1, 3, 9]), 4) == [(0, 2), (1, 2), (3, 1)]
