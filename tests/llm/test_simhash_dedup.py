import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tamizal.llm.simhash_dedup import _plan, near_groups, simhash_groups, simhash_stage

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    parts = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, radius):
    """Smallest id reachable, by all pairs."""
    ids = sorted(prints)
    of = {i: i for i in ids}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for a, b in combinations(ids, 2):
        if bin(prints[a] ^ prints[b]).count("1") <= radius:
            x, y = sorted((root(a), root(b)))
            of[y] = x
    return {i: root(i) for i in ids}


def test_same_as_brute_force(docs):
    rows = simhash_groups(docs).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    prints = {i: fingerprint(t[0]) for i, t in texts.items() if i is not None}
    want = classes(prints, 4)
    for r in rows:
        if r.doc_id is not None:
            assert r["print"] & (1 << 64) - 1 == prints[r.doc_id] and r.component_id == want[r.doc_id]
        else:
            assert r.component_id == 6
    assert len(rows) == docs.count()


@pytest.mark.parametrize("radius", [0, 4])
def test_groups_of_crowded_fingerprints(spark, radius):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    prints = {}
    for i in range(260):
        p = int(centres[i % 12])
        for b in rng.choice(64 if i % 2 else 12, rng.integers(0, 8), replace=False):
            p ^= 1 << int(b)
        prints.setdefault(p, i)
    rows = [(i, p - (1 << 64) if p >> 63 else p) for p, i in prints.items()]
    got = near_groups(spark.createDataFrame(rows, "doc_id bigint, print bigint"), radius).collect()
    want = classes({i: p for p, i in prints.items()}, radius)
    assert {r["print"] & (1 << 64) - 1: r.component_id for r in got} == {p: want[i] for p, i in prints.items()}


def test_every_plan_leaves_a_close_segment():
    for parts in (2, 3, 4, 5):
        plan = _plan(parts, 4)
        assert sum(width for _, width, _ in plan) == 64
        reach = [max(bin(m).count("1") for m in masks) if len(masks) else -1 for *_, masks in plan]
        assert sum(r + 1 for r in reach) > 4


def test_stage_keeps_one_of_each(spark, docs, empty):
    clash = docs.withColumn("component_id", F.lit("x")).withColumn("kept_id", F.lit(1)).withColumn("kept_key", F.lit(2))
    kept = simhash_stage(spark, clash, "")
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == clash.columns and len(ids) == len(set(ids))
    groups = {r.component_id for r in simhash_groups(docs).collect()}
    assert set(ids) == groups
    assert simhash_stage(spark, empty, "").count() == 0
