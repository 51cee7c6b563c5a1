"""Vector codes: Orchard's search against all distances, whole results against plain Python."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tamizal.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string"


@pytest.mark.parametrize("kind", [np.int64, object])
def test_search_equals_all_distances(kind):
    rng = np.random.default_rng(5)
    for count, width, spread in [(256, 16, 900), (256, 2, 3), (7, 1, 2), (1, 4, 9), (40, 0, 1)]:
        entries = rng.integers(-spread, spread + 1, (count, width))
        entries[count // 2 :] = entries[: count - count // 2]  # equal entries: the lower index wins
        parts = np.concatenate([rng.integers(-spread, spread + 1, (300, width)), entries[:50]])
        code, distance = vc.Codebook(entries.astype(kind)).nearest(parts.astype(kind))
        every = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert code.tolist() == every.argmin(axis=1).tolist()
        assert [int(d) for d in distance] == every.min(axis=1).tolist()


def test_search_looks_at_few_entries_of_a_clustered_codebook():
    rng = np.random.default_rng(6)
    centres = rng.integers(-9000, 9000, (16, 4))
    entries = (centres[:, None] + rng.integers(-20, 20, (16, 16, 4))).reshape(256, 4)
    book, looked = vc.Codebook(entries), []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray):
                looked.append(len(at))
            return super().__getitem__(at)

    book.entries = entries.view(Counted)
    book.nearest(entries[rng.integers(0, 256, 200)] + rng.integers(-3, 4, (200, 4)))
    assert sum(looked) < 200 * 256 / 3


def plain(rows, entries=256, rounds=4, scale=1024):
    kept = [(i, [math.floor(scale * Fraction(float(x))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1])
    cuts = [(p * size // 4, (p + 1) * size // 4) for p in range(4)]
    books = [[v[a:b] for i, v, _ in kept if i is not None][:entries] for a, b in cuts]

    def near(book, x):
        return min((sum((p - q) ** 2 for p, q in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for book, (a, b) in zip(books, cuts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(near(book, v[a:b])[1], []).append(v[a:b])
            for n, members in groups.items():
                book[n] = [sum(c) // len(members) for c in zip(*members)]
    coded = []
    for i, v, label in kept:
        found = [near(book, v[a:b]) for book, (a, b) in zip(books, cuts)]
        coded.append((i, "".join(f"{n:02x}" for _, n in found), min(sum(d for d, _ in found), 2**63 - 1), label))
    text = ",".join(str(x) for book in books for e in book for x in e)
    labels = {}
    for _, _, e, label in coded:
        labels[label] = labels.get(label, 0) + e
    return sorted(((i, c, e, min(labels[label], 2**63 - 1)) for i, c, e, label in coded), key=str), hashlib.sha256(text.encode()).hexdigest()


def coded(spark, rows, **more):
    frame = spark.createDataFrame([(i, v, label, "taken") for i, v, label in rows], SCHEMA).repartition(3)
    found, books = vc.vector_codes(frame, **more)
    out = vc.with_label_error(found).select("vec_id", "code", "error", "label_error").collect()
    return sorted((tuple(r) for r in out), key=str), vc.codebooks_hash(books)


def vectors(n, size=8, spread=1.0, seed=1):
    rng = random.Random(seed)
    rows = [(i * 3, [float(np.float32(rng.gauss(0, spread))) for _ in range(size)], rng.choice([1, 1, 2, None])) for i in range(n)]
    rows += [(1000, None, 1), (1001, [None] + [0.5] * (size - 1), 1), (1002, [math.nan] * size, 2), (1003, [math.inf] * size, None)]
    return rows + [(rows[4][0] + 1, rows[4][1], 2), (5000, rows[5][1], 1), (None, rows[6][1], None), rows[7]]


def test_equal_to_plain_python(spark):
    rows = vectors(330)
    assert coded(spark, rows) == plain(rows)
    assert coded(spark, rows, entries=20, rounds=2) == plain(rows, 20, 2)


def test_large_components_are_exact(spark):
    rows = vectors(40)
    large = [(7001, [3.0e38, -3.0e38] * 4, 1), (7002, [1.0e9] * 8, 2), (7003, [-2.5e20, 1e-30] * 4, None)]
    rows += [(i, [float(np.float32(x)) for x in v], label) for i, v, label in large]
    assert coded(spark, rows, entries=6) == plain(rows, 6)


def test_odd_tables(spark):
    assert coded(spark, []) == ([], hashlib.sha256(b"").hexdigest())
    assert coded(spark, [(1, None, 1), (2, [math.nan], 1)])[0] == []
    few = [(1, [0.1, 0.2, 0.3], 1), (2, [0.5, 0.1, 0.9], 1)]  # three components for four parts
    assert coded(spark, few) == plain(few)
    mixed = [(1, [1.0] * 4, 1), (2, [2.0] * 8, 1), (3, [], 1)]
    assert [r[:3] for r in coded(spark, mixed)[0]] == [(1, "00000000", 0), (2, "00000000", 0), (3, "00000000", 0)]
    with pytest.raises(ValueError):
        coded(spark, few, entries=300)
