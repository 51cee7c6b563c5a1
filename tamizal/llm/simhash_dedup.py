"""SimHash near-dedup by multi-index hashing.

Equal fingerprints become one first, so a group of copies costs one entry. A fingerprint is then cut
into segments: if two differ in at most ``radius`` bits, the pigeonhole leaves a segment in which they
differ in few. Each fingerprint enumerates the small Hamming ball of every segment, fetches the table
entries with that segment, and the complete distance is verified inside the join.

Crowds of almost equal fingerprints are joined beforehand without pairs: fingerprints that differ in at
most two bits have a common neighbour at one bit, at most 65 fingerprints have the same neighbour, and
each such neighbour links them as a star. Only links between different groups remain to be looked up.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamizal.llm.common import bounded_batches, components, free_name, spread, table, written
from tamizal.llm.rolling import chunks

SHINGLE = 4
SEED = 42
RADIUS = 4
BITS = 64

# Byte lanes of a 64-bit number: lane j of entry b is bit j of b.
_LANES = sum(((np.arange(256, dtype=np.uint64) >> np.uint64(j)) & np.uint64(1)) << np.uint64(8 * j) for j in range(8))
_LANE_LIMIT = 255


def _shingle_hashes(chunk, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of a chunk, and where each text's shingles begin."""
    upper = (chunk.data >= 0x41) & (chunk.data <= 0x5A)
    chunk.data = chunk.data + (upper * np.uint8(0x20)).astype(np.uint8)
    text, bounds = chunk.joined()
    words = np.diff(chunk.firsts)
    sizes = chunk.ends - chunk.starts
    owner = np.repeat(np.arange(len(words)), words)
    # in the joined text a word begins after the earlier words and blanks of its text
    before = np.cumsum(sizes + 1) - (sizes + 1)
    starts = before - (before[chunk.firsts[:-1][owner]] if len(before) else 0) + bounds[:-1][owner]
    ends = starts + sizes
    count = np.where(words > 0, np.maximum(words - shingle + 1, 1), 0)
    offsets = np.concatenate([[0], np.cumsum(count)])
    own = np.repeat(np.arange(len(words)), count)
    first = chunk.firsts[:-1][own] + np.arange(offsets[-1]) - offsets[:-1][own]
    last = np.minimum(first + shingle, chunk.firsts[1:][own]) - 1
    raw, digest = text.tobytes(), xxhash.xxh64_intdigest
    hashes = [digest(raw[s:e], SEED) for s, e in zip(starts[first].tolist(), ends[last].tolist())]
    return np.array(hashes, np.uint64), offsets


def _majority(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text, the bits set in over half of its hashes; zero for a text without any."""
    out = np.zeros(len(offsets) - 1, np.uint64)
    counts = np.diff(offsets)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    pieces = -(-counts[full] // _LANE_LIMIT)
    piece_of = np.concatenate([[0], np.cumsum(pieces)])
    inner = np.arange(piece_of[-1]) - np.repeat(piece_of[:-1], pieces)
    begins = np.repeat(offsets[:-1][full], pieces) + inner * _LANE_LIMIT
    octets = hashes.view(np.uint8).reshape(-1, 8)
    for k in range(8):
        lanes = np.add.reduceat(_LANES[octets[:, k]], begins).view(np.uint8).reshape(-1, 8)
        votes = np.add.reduceat(lanes.astype(np.int64), piece_of[:-1], axis=0)
        bits = (2 * votes > counts[full][:, None]).astype(np.uint64)
        out[full] |= (bits << np.arange(8, dtype=np.uint64)).sum(axis=1, dtype=np.uint64) << np.uint64(8 * k)
    return out


def _fingerprints(shingle: int):
    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                prints = _majority(*_shingle_hashes(chunk, shingle))
                rows = slice(chunk.rows.start, chunk.rows.stop)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[rows], batch.column("row_key")[rows], pa.array(prints.view(np.int64))],
                    names=["doc_id", "row_key", "print"],
                )

    return fingerprints


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``row_key`` (hash of the text) and ``print`` (the 64 bits as a bigint) of every row."""
    bounded_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    own = docs.select("doc_id", F.xxhash64(text).alias("row_key"), text.alias("text"))
    return own.mapInArrow(_fingerprints(shingle), "doc_id bigint, row_key bigint, print bigint")


def _segments(parts: int) -> list[tuple[int, int]]:
    """(shift, width) of ``parts`` segments of nearly equal width."""
    edges = [round(i * BITS / parts) for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _plan(parts: int, radius: int) -> list[tuple[int, int, list[int]]]:
    """For each segment: shift, width, and the masks of its Hamming ball.

    The first ``radius % parts + 1`` segments take ``radius // parts`` bits, the others one less: if all
    of them failed, the two fingerprints would differ in more than ``radius`` bits.
    """
    plan = []
    for place, (shift, width) in enumerate(_segments(parts)):
        reach = radius // parts - (place > radius % parts)
        masks = [sum(1 << b for b in chosen) for k in range(reach + 1) for chosen in combinations(range(width), k)]
        plan.append((shift, width, masks))
    return plan


def _cheapest_plan(prints: int, radius: int) -> list[tuple[int, int, list[int]]]:
    """The number of segments with the fewest probes and expected matches for so many fingerprints.

    Every choice finds the same links; more fingerprints want wider segments.
    """

    def cost(parts: int) -> float:
        return sum(len(masks) * (1 + prints / 2.0**width) for _, width, masks in _plan(parts, radius))

    return _plan(min(range(2, max(radius, 1) + 2), key=cost), radius)


def _segment(value: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << width) - 1))


def _probes(prints: DataFrame, plan, ball: bool) -> DataFrame:
    """One row for each segment and, with ``ball``, each neighbour of it: ``part``, ``segment``."""
    def probes(part: int, shift: int, width: int, masks: list[int]) -> Column:
        own = _segment(F.col("print"), shift, width)
        reach = F.array(*[F.lit(m).cast("bigint") for m in (masks if ball else [0])])
        return F.transform(reach, lambda m: F.struct(F.lit(part).alias("part"), own.bitwiseXOR(m).alias("segment")))

    entries = [probes(part, *segment) for part, segment in enumerate(plan) if segment[2]]
    return prints.select("*", F.inline(F.concat(*entries)))


def near_groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``print``, ``component_id`` for distinct fingerprints ``print`` with their smallest ``doc_id``.

    Fingerprints are linked at ``radius`` or fewer differing bits; ``component_id`` is the smallest
    ``doc_id`` that links lead to.
    """
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("bigint") for b in range(BITS)])
    neighbours = spread(prints, "print", BITS + 1).select("doc_id", F.explode(F.transform(flips, lambda f: F.col("print").bitwiseXOR(f))).alias("near"))
    # distinct fingerprints within one bit of one value: 65 at most
    stars = neighbours.groupBy("near").agg(F.collect_set("doc_id").alias("members")).where(F.size("members") > 1)
    close = components(
        stars.select(F.explode("members").alias("a"), F.array_min("members").alias("b")).where(F.lit(radius >= 2)).distinct()
    )
    grouped = written(
        prints.join(close.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
            "doc_id", "print", F.coalesce("component_id", "doc_id").alias("close")
        ),
        "close-groups",
    )
    plan = _cheapest_plan(grouped.count(), radius)
    probes = sum(len(masks) for _, _, masks in plan)
    asked = _probes(spread(grouped.select("print", "close"), "print", probes), plan, True)
    stored = _probes(grouped.select("print", "close"), plan, False).select(
        "part", "segment", F.col("print").alias("other"), F.col("close").alias("other_close")
    )
    verified = asked.join(
        stored,
        (asked.part == stored.part)
        & (asked.segment == stored.segment)
        & (F.col("close") < F.col("other_close"))
        & (F.bit_count(F.col("print").bitwiseXOR(F.col("other"))) <= radius),
    )
    joined = components(verified.select(F.col("close").alias("a"), F.col("other_close").alias("b")))
    return grouped.join(joined.withColumnRenamed("node", "close"), "close", "left").select(
        "print", F.coalesce("component_id", "close").alias("component_id")
    )


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``row_key``, ``print`` and ``component_id`` for every row of ``docs``.

    Null, empty and blank texts have fingerprint zero and are linked like any other; a text with fewer
    words than a shingle is one shingle. Equal rows are in one group. Rows without a ``doc_id`` take
    part under the ids of those that have one, and have a null component if nobody in it has.
    """
    prints = written(fingerprints(docs, shingle), "fingerprints")
    distinct = written(prints.groupBy("print").agg(F.min("doc_id").alias("doc_id")), "distinct-fingerprints")
    groups = written(near_groups(distinct.where("doc_id IS NOT NULL"), radius), "simhash-groups")
    return prints.join(groups, "print", "left")


def one_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of ``docs`` that stay: of each group the one with the smallest ``doc_id``, unchanged.

    Rows without a component stay; equal rows with one ``doc_id`` become one.
    """
    key, text_key = free_name(docs, "kept_id"), free_name(docs, "kept_key")
    first = groups.where("component_id IS NOT NULL AND doc_id IS NOT NULL").groupBy("component_id").agg(F.min(F.struct("doc_id", "row_key")).alias("k"))
    kept = first.select(F.col("k.doc_id").alias(key), F.col("k.row_key").alias(text_key)).unionByName(
        groups.where("component_id IS NULL").select(F.col("doc_id").alias(key), F.col("row_key").alias(text_key))
    )
    keyed = docs.withColumn(text_key, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (keyed[text_key] == kept[text_key])
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", text_key]).select(*docs.columns)


def op7_simhash_dedup(spark, sf_dir):
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, with its own columns unchanged."""
    return one_of_each(docs, written(simhash_groups(docs), "simhash-rows"))
