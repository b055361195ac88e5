import numpy as np
import pyarrow as pa

from millrace.ml import product_search
from millrace.ml.block_als import write_file


def by_norm(vectors):
    return vectors[np.argsort(-np.linalg.norm(vectors, axis=1), kind="stable")]


def asked(vectors, share=0, floors=None):
    lists = [{"_share": share, "_ids": list(range(len(vectors))), "_vectors": vectors.ravel().tolist(), "_floors": floors or [float("-inf")] * len(vectors)}]
    return iter([pa.RecordBatch.from_pylist(lists, pa.schema([("_share", pa.int32()), ("_ids", pa.list_(pa.int32())), ("_vectors", pa.list_(pa.float64())), ("_floors", pa.list_(pa.float64()))]))])


def stored(folder, data, block):
    """Blocks 1, 2, ... as files; the norms they reach."""
    for n, at in enumerate(range(0, len(data), block), 1):
        ids = np.arange(at, min(at + block, len(data)))
        write_file(f"{folder}/{n}", ids.tobytes() + data[ids].tobytes())
    return [float(np.linalg.norm(data[at : at + block], axis=1).max()) for at in range(0, len(data), block)]


def found(batches):
    return sorted((r["id"], r["other"], r["score"]) for b in batches for r in b.to_pylist())


def test_files_give_what_all_products_give(tmp_path):
    rng = np.random.default_rng(3)
    data = rng.standard_normal((300, 4))
    # Apart by less than single precision tells, and exact ties.
    data[50:60] = data[40] * (1 + 1e-10 * np.arange(10))[:, None]
    data[70:80] = data[41]
    data, queries = by_norm(data), rng.standard_normal((20, 4))
    reach = stored(tmp_path, data, 32)
    got = found(product_search.searcher(str(tmp_path), reach, 1, 5)(asked(queries)))
    scores = np.zeros((20, 300))
    for f in range(4):
        scores += queries[:, f : f + 1] * data[:, f]
    expected = [(q, int(o), scores[q, o]) for q in range(20) for o in np.lexsort((np.arange(300), -scores[q]))[:5]]
    assert got == sorted(expected)
    halves = [found(product_search.searcher(str(tmp_path), reach, 2, 5)(asked(queries, share))) for share in (0, 1)]
    assert set(expected) <= {*halves[0], *halves[1]}


def test_blocks_out_of_reach_are_not_read(tmp_path):
    data = by_norm(np.array([[8.0, 0.0], [7.0, 0.0], [1.0, 0.0], [0.5, 0.0]]))
    reach = stored(tmp_path, data, 2)
    (tmp_path / "2").unlink()
    assert [r[:2] for r in found(product_search.searcher(str(tmp_path), reach, 1, 1)(asked(np.array([[1.0, 0.0], [2.0, 0.0]]))))] == [(0, 0), (1, 0)]
    assert found(product_search.searcher(str(tmp_path), reach, 1, 1)(asked(np.array([[1.0, 0.0]]), floors=[9.0]))) == []
