import numpy as np
import pytest

from tamizal.llm.embedding_dedup import _codes, near_vectors, rotation

SCHEMA = "vec_id bigint, embedding array<float>, label int, links string"


def crowd(rng, dimension, n, labels):
    rows = []
    for i in range(n):
        base = np.random.default_rng(i % 9).normal(size=dimension)
        v = base + rng.normal(size=dimension) * rng.choice([0.0, 0.1, 0.25, 0.3, 3.0])
        rows.append((i, [float(np.float32(x)) for x in v * rng.choice([0.5, 1.0, 40.0])], int(rng.integers(labels)), "x"))
    return rows


def brute(rows, threshold):
    ids = [r[0] for r in rows]
    units = [np.array(r[1]) / np.linalg.norm(r[1]) if r[2] is not None and _usable(r[1]) else None for r in rows]
    links, of = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]):
                if units[a] @ units[b] >= threshold:
                    links[a] += 1
                    links[b] += 1
                    x, y = sorted((root(a), root(b)))
                    of[y] = x
    return {ids[i]: (links[i], ids[root(i)]) for i in range(len(rows))}


def _usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


@pytest.mark.parametrize("dimension,block_rows", [(64, 65_536), (64, 90), (3, 150)])
def test_same_as_brute_force(spark, dimension, block_rows):
    rows = crowd(np.random.default_rng(dimension), dimension, 420, 3)
    rows += [(1000 + i, rows[i % 4][1], rows[i % 4][2], None) for i in range(30)]
    rows += [(2000, None, 1, ""), (2001, [], 1, ""), (2002, [0.0] * dimension, 1, ""), (2003, [float("nan")] * dimension, 1, "")]
    rows += [(2004, [None] * dimension, 1, ""), (2005, rows[0][1], None, ""), (2006, [float("inf")] * dimension, 1, ""), (2007, [1.0, 2.0], 1, "")]
    got = near_vectors(spark.createDataFrame(rows, SCHEMA), block_rows=block_rows).collect()
    want = brute(rows, 0.93)
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert sum(n for n, _ in want.values()) > 500


def chains_and_stars():
    """Vectors whose components hold only through links of several tiles: chains in a plane, and stars, in mixed order."""
    vectors = []
    for axis in (0, 2):
        for start, count in ((0.0, 7), (3.0, 5)):
            for k in range(count):
                v = np.zeros(8)
                v[axis], v[axis + 1] = np.cos(start + 0.3 * k), np.sin(start + 0.3 * k)
                vectors.append(v)
    vectors.append(np.eye(8)[4])
    vectors += [np.cos(0.35) * np.eye(8)[4] + np.sin(0.35) * np.eye(8)[k] * sign for k in (5, 6, 7) for sign in (-1, 1)]
    order = np.random.default_rng(2).permutation(len(vectors))
    return [(int(i), [float(x) for x in vectors[i]], 1, "") for i in order]


@pytest.mark.parametrize("tile,block_rows", [(1, 65_536), (2, 65_536), (3, 65_536), (1, 9), (2, 9), (3, 13)])
def test_components_across_tiles(spark, tile, block_rows):
    rows = chains_and_stars()
    got = near_vectors(spark.createDataFrame(rows, SCHEMA.replace("float", "double")), block_rows=block_rows, tile=tile).collect()
    want = brute(rows, 0.93)
    assert len({c for _, c in want.values()}) == 5
    # the smallest id of a component names it, as brute force joins to the first row
    least = {c: min(i for i, (_, d) in want.items() if d == c) for _, c in want.values()}
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (n, least[c]) for i, (n, c) in want.items()}


def test_components_across_tiles_of_a_block():
    from tamizal.llm.embedding_dedup import _Block

    rng = np.random.default_rng(1)
    turns = np.arange(12) * 0.3  # a chain: every vector is linked with the next one only
    for tile in (1, 2, 3, 4096):
        for _ in range(20):
            order = rng.permutation(12)
            vectors = np.column_stack([np.cos(turns[order]), np.sin(turns[order])])
            block = _Block(order, np.ones(12, np.int64), vectors, 0)
            turned = block.unit @ rotation(2).T
            rows = {"vec_id": order, "copies": np.ones(12, np.int64), "vector": vectors, "block": np.zeros(12, np.int64)}
            rows |= {"code": np.packbits(turned > 0, axis=1), "factor": np.abs(turned).sum(axis=1) / np.sqrt(2)}
            links, to = block.compare(rows, 0.93, 6.0, tile)
            reached = {0}
            for _ in range(12):  # over the rows of codes and queries, as they are given to Spark
                reached |= {int(y) for x in range(12) for y in (x, block.root[x], block.root[to[x]]) if reached & {x, block.root[x], block.root[to[x]]}}
            assert len(reached) == 12 and links.sum() == 22


def test_estimates_are_unbiased_and_within_their_bound():
    import pyarrow as pa

    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(400, 64))
    batch = pa.RecordBatch.from_arrays([pa.array(vectors.tolist(), pa.list_(pa.float32()))], names=["embedding"])
    coded = next(_codes(iter([batch])))
    bits = np.unpackbits(np.frombuffer(b"".join(coded.column("code").to_pylist()), np.uint8).reshape(400, -1), axis=1)
    factor = coded.column("factor").to_numpy()
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    estimates = (units @ rotation(64).T) @ (bits.astype(float) * 2 - 1).T / 8 / factor
    error = (estimates - units @ units.T)[~np.eye(400, dtype=bool)]
    assert abs(error.mean()) < 2e-3 and np.abs(error).max() < 6 * (0.75 / np.sqrt(63))


def test_no_rows(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
