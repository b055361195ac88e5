"""Cover-tree search against all products, quotations against hand-made threads, transducer against the library."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import tiktoken
from pyspark.sql import functions as F

from millrace.llm import bpe_transducer
from millrace.llm.cover_tree import Best, build_tree, dual_search, products, top_products
from millrace.llm.quote_threads import read_message, reply_order


def test_search_matches_all_products(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(0, 1, (12, 3))
    rows = [(i, [float(x) for x in base[i % 12] + rng.normal(0, 0.02, 3)]) for i in range(900)]
    rows += [(900 + i, [1.0, 2.0, 3.0]) for i in range(300)]
    rows += [(None, [1.0, 2.0, 3.0]), (5000, None), (5050, [1.0, None, 2.0]), (5100, [1.0, float("nan"), 2.0]), (5150, [1.0, 2.0]), (5151, [2.0, 2.0]), (5200, []), (5250, [1.0, float("inf"), 1.0]), (5300, [1e30, 1.0, 0.0, 2.0]), (5301, [1e30, 1.0, 0.0, 2.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string").repartition(5)
    got = sorted(tuple(r) for r in top_products(df, F.col("_vec") % 50 == 0, block_rows=120, query_rows=10, pivots=6).collect())
    usable = [(i, np.floor(np.array(v) * 256)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for i, v in usable:
        if i % 50 == 0:
            best = sorted((-min(sum(int(a) * int(b) for a, b in zip(v, w)), 2**63 - 1), j) for j, w in usable if j != i and len(w) == len(v))[:5]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert got == sorted(want)
    assert top_products(df.limit(0), F.col("_vec") % 50 == 0).count() == 0


def check_tree(tree, points, base=1.3, leaf=8):
    """Every point once; covering by radius and by scale; children of one node further apart than their scale."""
    assert sorted(map(tuple, tree.points.tolist())) == sorted(map(tuple, points.tolist()))
    for n in range(len(tree.radius)):
        inside = tree.points[tree.begin[n] : tree.end[n]]
        far = np.sqrt(((inside - tree.centre[n]) ** 2).sum(1))
        assert far.max() <= min(tree.radius[n], tree.scale[n]) + 1e-9
        assert np.sqrt((inside**2).sum(1)).max() <= tree.norm[n] + 1e-9
        children = np.arange(tree.first[n], tree.last[n])
        if not len(children):
            assert len(inside) <= leaf or tree.radius[n] == 0
            continue
        assert len(children) > 1 and (tree.centre[children] == tree.centre[n]).all(1).any()
        assert (tree.scale[children] < tree.scale[n]).all() and (tree.scale[children] == tree.scale[children[0]]).all()
        gaps = np.sqrt(((tree.centre[children][:, None] - tree.centre[children][None]) ** 2).sum(2))
        assert gaps[~np.eye(len(children), dtype=bool)].min() > tree.scale[children[0]]


def test_tree_of_the_embeddings_is_a_cover_tree():
    rows = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    points = np.floor(np.array(rows["embedding"].to_pylist(), float) * 256)
    tree = build_tree(rows["vec_id"].to_numpy(), points)
    assert tree.depth() > 3
    check_tree(tree, points)


def test_tree_covers_and_prunes():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 300, (40, 64))
    points = np.floor(np.concatenate([c + rng.normal(0, 5, (60, 64)) for c in centres] + [centres[:1]] * 30))
    tree = build_tree(np.arange(len(points)), points)
    check_tree(tree, points)
    at = np.arange(0, len(points), 20)
    queries = build_tree(at, points[at])
    best = Best(queries, 5)
    assert dual_search(queries, tree, best) >= 10
    assert best.scored < 0.5 * len(at) * len(points)  # more than half of all products are pruned
    scores = products(queries.points, points)
    for i, rows in enumerate(best.rows):
        own = int(queries.ids[i])
        assert rows == sorted((-int(s), j) for j, s in enumerate(scores[i]) if j != own)[:5]


def test_floors_carry_over_and_huge_vectors_are_compared():
    rng = np.random.default_rng(5)
    points = np.floor(rng.normal(0, 200, (400, 8)))
    queries, tree = build_tree(np.arange(0, 400, 50), points[::50]), build_tree(np.arange(400), points)
    first, again = Best(queries, 5), Best(queries, 5)
    dual_search(queries, tree, first)
    again = Best(queries, 5, first.floor)
    dual_search(queries, tree, again)
    assert again.rows == first.rows and again.scored <= first.scored
    huge = np.array([[1e200, 0.0], [1e200, 1.0], [-1e200, 2.0]] * 5)
    tree = build_tree(np.arange(15), huge)
    best = Best(tree, 5)
    dual_search(tree, tree, best)
    own = tree.ids.tolist().index(2)
    assert best.rows[own] == [(-(2**63 - 1), i) for i in (5, 8, 11, 14)] + [(2**63, 0)]


def test_cells_are_dealt_until_they_are_blocks(spark):
    """Half of the rows are one vector; a query id stands for two vectors, and rows are given twice."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 4)]) for i in range(1, 600)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(1, 600)]
    rows += [(50, [2.0, -1.0, 0.0, 1.0]), rows[99], rows[6]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in top_products(df, F.col("_vec") % 50 == 0, block_rows=150, query_rows=5, pivots=4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    usable = [(i, [int(np.floor(x * 256)) for x in v]) for i, v in rows]
    want = {}
    for q in {i for i, _ in rows if i % 50 == 0}:
        own = {tuple(v) for i, v in usable if i == q}
        best = sorted((-sum(a * b for a, b in zip(v, w)), j) for v in own for j, w in usable if j != q)[:5]
        want[q] = [(n + 1, s, j) for n, (s, j) in enumerate(best)]
    assert {q: sorted(v) for q, v in got.items()} == want


def test_threads_by_hand(spark):
    rows = [
        (1, 0, "user", "Hello there\nHow are you?\n\nSecond para here"),
        (1, 1, "assistant", "On Monday X wrote:\n> hello there\n> how are   you?\n\nI am fine."),
        (1, 2, "user", "> > Hello there\n> I am fine.\nGood!"),
        (2, 0, "user", "> Second para here\nNice para."),
        (2, 1, "assistant", None), (2, 1, "b", "dup row"), (2, 2, "user", "> never said\nok"),
        (None, 0, "x", "> Good!\nlost"), (3, None, "x", "Good!"), (4, 0, "u", ""), (4, 1, "u", "> later words\n"), (4, 2, "u", "later words"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(3)
    got = sorted(((r.conv_id, r.turn, r.role, r.reply_to_conv, r.reply_to_turn, r.thread_conv, r.thread_turn, r.depth, r.position, r.own_text) for r in reply_order(df).collect()), key=str)
    want = [
        (1, 0, "user", None, None, 1, 0, 0, 1, rows[0][3]), (1, 1, "assistant", 1, 0, 1, 0, 1, 2, "I am fine."), (1, 2, "user", 1, 1, 1, 0, 2, 4, "Good!"),
        (2, 0, "user", 1, 0, 1, 0, 1, 3, "Nice para."), (2, 1, "assistant", None, None, 2, 1, 0, 1, None), (2, 1, "b", None, None, 2, 1, 0, 2, "dup row"),
        (2, 2, "user", None, None, 2, 2, 0, 3, "ok"), (None, 0, "x", None, None, None, 0, 0, 1, "lost"), (3, None, "x", None, None, 3, None, 0, 1, "Good!"),
        (4, 0, "u", None, None, 4, 0, 0, 1, ""), (4, 1, "u", None, None, 4, 1, 0, 2, ""), (4, 2, "u", None, None, 4, 2, 0, 3, "later words"),
    ]
    assert got == sorted(want, key=str)
    assert reply_order(df.limit(0)).count() == 0


def test_long_threads_keep_their_depth(spark):
    rows = [(1, 0, "u", "line 0")] + [(1, i, "u", f"> line {i - 1}\nline {i}") for i in range(1, 40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = {r.turn: (r.depth, r.thread_turn, r.position) for r in reply_order(df).collect()}
    assert got == {i: (i, 0, i + 1) for i in range(40)}


def test_messages_without_marks_are_left_alone():
    assert read_message("a > b\n\n\n\nc")[:2] == ("a > b\n\n\n\nc", [])


def test_transducer_matches_the_library():
    codec = bpe_transducer.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rng = random.Random(3)
    texts = ["", "  ", "a \n b", "x  ", "It's we'll  don't\t\tTAB\r\nx", "é ́x", "<|endoftext|> a", "\x1c\x1d a\x85 b\xa0\n c", "日本語 テスト　全角", None, "a" * 1000, "the" * 500, "ab" * 700, "0" * 333]
    texts += ["".join(rng.choice("abcdeft hein .,!é日😀\n'0129") for _ in range(rng.randint(1, 80))) for _ in range(400)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 0x2FF), rng.randint(0x370, 0x1FFF), rng.randint(0x3000, 0x9FFF), rng.randint(0x1F300, 0x1F6FF)])) for _ in range(60)) for _ in range(200)]
    ids, at = codec.encode(pa.array(texts))
    for i, text in enumerate(texts):
        own = ids[at[i] : at[i + 1]].tolist()
        assert own == library.encode_ordinary(text or ""), repr(text)
        assert codec.decode(own) == (text or "").encode()


def test_transducer_steps_agree_with_merging():
    """Any ranks closed under merging: random small vocabularies."""
    rng = random.Random(8)
    for _ in range(30):
        parts = [bytes([b]) for b in b"abc"]
        while len(parts) < 14:
            joint = rng.choice(parts) + rng.choice(parts)
            if joint not in parts:
                ranks = {t: i for i, t in enumerate(parts)}
                if bpe_transducer.merged(joint, {**ranks, joint: len(parts)}) == [joint]:
                    parts.append(joint)
        ranks = {t: i for i, t in enumerate(parts)}
        machine = bpe_transducer.Transducer(ranks)
        for _ in range(60):
            text = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 40)))
            assert [machine.token[r] for r in machine.encode(text)] == bpe_transducer.merged(text, ranks)


def test_decoder_lets_whole_characters_through():
    text = "aé日😀z".encode()
    decoder = bpe_transducer.StreamDecoder({b: bytes([b]) for b in range(256)})
    pending, out = b"", []
    for byte in text:
        step, pending = decoder.feed([byte], pending)
        out.append(step.decode())
    assert "".join(out).encode() == text and pending == b""
    assert decoder.feed([0xFF, 0x41, 0xE6]) == (b"\xffA", b"\xe6")


def test_encoding_keeps_other_columns(spark):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    df = spark.createDataFrame([(1, "a b", "x"), (None, None, None), (2, "", "y"), (2, "", "y")], "doc_id long, text string, ids string")
    back = bpe_transducer.decode(bpe_transducer.encode(df, path, pattern), path, pattern)
    assert sorted(back.columns) == ["decoded", "doc_id", "text"]
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())
    trip = bpe_transducer.round_trip(df, path, pattern)
    assert sorted(r.n_tokens for r in trip.collect()) == [0, 0, 0, 2]
    assert bpe_transducer.round_trip(df.limit(0), path, pattern).count() == 0
