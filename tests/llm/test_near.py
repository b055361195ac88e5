"""N-gram join against all pairs of n-gram sets."""

import random

import pytest

from millrace.llm.ngram_join import choose_bands, keep_one, similar_texts


def by_hand(docs, threshold=0.8):
    texts = {}
    for d, x in docs:
        texts.setdefault(tuple((x or "").lower().split()), []).append(d)
    items = [(w, frozenset(w[i : i + 5] for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([w])) for w in texts if w]
    root, links = list(range(len(items))), [0] * len(items)

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, (_, a) in enumerate(items):
        for j in range(i):
            b = items[j][1]
            if len(a & b) / len(a | b) >= threshold:
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    members = {}
    for i, (w, _) in enumerate(items):
        members.setdefault(top(i), []).extend(texts[w])
    out = {d: (min(members[top(i)]), links[i], len(texts[w])) for i, (w, _) in enumerate(items) for d in texts[w]}
    return out | {d: (d, 0, 1) for d in texts.get((), [])}


def some_documents():
    rng = random.Random(5)
    docs = []
    for _ in range(25):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(4, 150))]
        for _ in range(rng.randint(1, 9)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                own[rng.randrange(len(own))] = f"x{rng.random()}"
            docs.append((len(docs), " ".join(own)))
    return [*docs, (900, None), (901, ""), (902, " \n "), (903, "a b"), (904, "A  b"), (905, "a b c")]


@pytest.mark.parametrize("options", [{}, {"unit_cost": 4000, "unit_grams": 800}, {"unit_cost": 4000, "most_blocks": 1}])
def test_links_and_classes_match_all_pairs(spark, options):
    docs = some_documents()
    want = by_hand(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in similar_texts(df, **options).collect()}
    assert got == want
    assert sum(v[1] for v in want.values()) > 50


def test_one_of_each_class_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(7, text, "a"), (None, text, "b"), (3, text + " more", "c"), (3, "other words stand here alone", "d"), (5, None, None), (6, "", "e"), (8, text, "f"), (3, text + " more", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    kept = sorted((tuple(r) for r in keep_one(df).collect()), key=str)
    assert kept == sorted([(3, text + " more", "c"), (3, text + " more", "c"), (3, "other words stand here alone", "d"), (5, None, None), (6, "", "e")], key=str)
    assert similar_texts(df.limit(0)).count() == 0


def test_bands_reach_the_recall():
    bands, rows = choose_bands(0.8, 0.9995, 100)
    assert (bands, rows) == (20, 5)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9995
    with pytest.raises(ValueError):
        choose_bands(0.1, 0.9999, 10)


def test_links_count_once_where_blocks_are_empty(spark):
    rng = random.Random(9)
    docs = []
    for _ in range(30):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(60)]
        docs += [(len(docs) + k, " ".join([*base, f"end{k}"])) for k in range(rng.choice([2, 3]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in similar_texts(df, unit_grams=30).collect()}
    assert got == by_hand(docs)


def test_one_row_stays_of_copies_without_id(spark):
    text, lone = " ".join(f"w{i}" for i in range(40)), "six other words stand right here"
    rows = [(None, text, "a")] * 5 + [(None, text.upper(), "b"), (None, text + " more", "c"), (None, None, "d"), (None, None, "d"), (4, lone, "e"), (4, lone.upper(), "e"), (None, lone, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = [(r.doc_id, r.text and r.text.lower()) for r in keep_one(df).collect()]
    assert sorted(kept, key=str) in (
        sorted([(None, text), (None, None), (None, None), (4, lone)], key=str),
        sorted([(None, text + " more"), (None, None), (None, None), (4, lone)], key=str),
    )
