"""Prefix trie: shards and segments of any size against sets of tuples in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tamizal.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int"


def shared():
    return F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4


def said(row):
    role, text = row[2] or "", row[3] or ""
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def plain(rows):
    convs = {}
    for r in rows:
        if r[0] is not None:
            convs.setdefault(r[0], []).append(r)
    own = {}
    for c, turns in convs.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, said(r)))
        own[c] = [(r[2] or "", r[3] or "") for r in turns]
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(c / 20) * 20
        rebuilt[c] = own.get(c - base, [])[:h] + own[c][h:]
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {k: 0 for k in nodes}
    leaves, saved = dict(children), dict(children)
    for k in nodes:
        if k:
            children[k[:-1]] += 1
    for k, members in nodes.items():
        more = (len(members) - 1) * len(k[-1][1].split()) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += more
            leaves[k[:d]] += children[k] == 0
    out = []
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(k))
        parent = min(nodes[k[:-1]]) if k else None
        out.append((min(members), len(k), parent, len(members), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def trie(spark, rows, **sizes):
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(4)
    turns, conversations = pt.rebuilt_turns(pt.ordered_turns(frame), shared())
    return sorted(map(tuple, pt.prefix_trie(turns, conversations, **sizes).collect()))


def conversations(seed, n=90, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in [*range(n), 400, 401, 419, 2**40, -7, -20]:
        for t in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([t, t, None]) if c % 7 == 0 else t, rng.choice(["user", "assistant", None]) if t % 5 else "user", rng.choice(["a", "a b", "c  d e", "", None])))
    copies = [(c + 1000, t, r, x) for c, t, r, x in rows if c in (3, 5)]
    return rows + copies + rows[:3] + [(None, 0, "user", "lost")]


@pytest.mark.parametrize(("seed", "shard", "segment"), [(1, 2048, 256), (2, 7, 2), (3, 1, 1), (4, 16, 3)])
def test_equal_to_plain_python(spark, seed, shard, segment):
    rows = conversations(seed)
    assert trie(spark, rows, shard=shard, segment=segment) == plain(rows)


def test_long_copies_across_segments(spark):
    """One conversation holds most rows, and has copies that part late: blocks stay small."""
    rng = random.Random(9)
    line = [("user" if t % 2 else "assistant", f"t{rng.randint(0, 5)} x") for t in range(700)]
    rows = [(c, t, r, x) for c, cut in ((20, 700), (40, 640), (60, 256), (80, 512)) for t, (r, x) in enumerate(line[:cut])]
    rows += [(100, t, r, x if t < 600 else "other words") for t, (r, x) in enumerate(line)]
    assert trie(spark, rows, shard=2, segment=256) == plain(rows)


def test_no_rows(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "user", "x")]) == []


def test_only_turnless(spark):
    # each of these has fewer own turns than it would take from a conversation that is not there
    rows = [(c, 0, "user", "hello") for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4]
    assert trie(spark, rows) == plain(rows) and len(plain(rows)) == 1


def test_a_very_long_text(spark):
    rows = [(c, 0, "user", "word " * 400_000) for c in (1, 2, 3)] + [(c, 1, "user", str(c)) for c in (1, 2, 3)]
    assert trie(spark, rows) == plain(rows)
