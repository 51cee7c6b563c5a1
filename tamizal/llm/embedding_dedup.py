"""Near-duplicate vectors by randomised-rotation binary codes.

Every unit vector is turned by one random rotation per dimension and kept as the signs of its
coordinates, with a correction factor: the inner product of the turned vector and its code. The inner
product of a turned vector with a code, over the factor, is an unbiased estimate of the cosine, and its
spread at a given cosine is known. A pair whose estimate lies more than ``EPSILON`` spreads below the
threshold is settled; all others are computed exactly in double precision.

Equal vectors are one row first. Vectors of a label are compared block by block: the unit of work is a pair of
blocks, of which a task holds one and streams the codes of the other. It gives one row for each vector with
links (how many, and a vector of the same component), never the pairs; the pairs' rows are added up and
joined in Spark, so a label of any size is as many tasks as it has pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamizal.llm.common import bounded_batches, components, table, written

THRESHOLD = 0.93
EPSILON = 6.0
BLOCK_ROWS = 16_384
MOST_TASKS = 20_000
TILE = 4096
SEED = 20240527


def rotation(dimension: int) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is made."""
    turned, upper = np.linalg.qr(np.random.default_rng(SEED + dimension).normal(size=(dimension, dimension)))
    return turned * np.sign(np.diag(upper))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signs of the turned unit vectors as bits, and the correction factor."""
    for batch in batches:
        sizes = np.diff(batch.column("embedding").offsets.to_numpy())
        for size in np.unique(sizes):
            own = batch.filter(pa.array(sizes == size))
            turned = _unit(_matrix(own.column("embedding"))) @ rotation(int(size)).T
            factor = np.abs(turned).sum(axis=1) / np.sqrt(size)
            bits = np.packbits(turned > 0, axis=1)
            codes = pa.array([row.tobytes() for row in bits], pa.binary())
            yield pa.RecordBatch.from_arrays([*own.columns, codes, pa.array(factor)], names=[*own.schema.names, "code", "factor"])


class _Block:
    """The vectors of one block, and what was found about them."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, number: int):
        self.ids, self.copies, self.number = ids, copies, number
        self.unit = _unit(vectors)
        self.turned = (self.unit @ rotation(vectors.shape[1]).T).astype(np.float32)
        self.links = np.zeros(len(ids), np.int64)
        self.root = np.arange(len(ids))
        self.linked = np.zeros(len(ids), bool)

    def _join(self, query: np.ndarray, code: np.ndarray, codes: int) -> None:
        """All queries that are linked to one code are in one component."""
        while True:
            least = np.full(codes, len(self.ids))
            np.minimum.at(least, code, self.root[query])
            lower = self.root.copy()
            np.minimum.at(lower, self.root[query], least[code])
            while not np.array_equal(lower, lower[lower]):
                lower = lower[lower]
            joined = lower[self.root]
            if np.array_equal(joined, self.root):
                return
            self.root = joined

    def compare(self, rows: dict[str, np.ndarray], threshold: float, epsilon: float, tile: int) -> tuple[np.ndarray, np.ndarray]:
        """Links of each code row, and the place of a query it is linked to (-1: none)."""
        size = self.unit.shape[1]
        signs = np.unpackbits(rows["code"], axis=1, count=size).astype(np.float32) * 2 - 1
        scale = (1 / (rows["factor"] * np.sqrt(size))).astype(np.float32)
        rest = np.maximum(1 - rows["factor"] ** 2, 0) / rows["factor"] ** 2
        spread = np.sqrt(rest * (1 - threshold**2)) * min(1.0, epsilon / np.sqrt(max(size - 1, 1)))
        least = (threshold - spread - 1e-4).astype(np.float32)
        unit = _unit(rows["vector"])
        links, to = np.zeros(len(unit), np.int64), np.full(len(unit), -1)
        same_block = rows["block"][0] == self.number
        for low in range(0, len(self.ids), tile):
            estimates = (self.turned[low : low + tile] @ signs.T) * scale
            query, code = np.nonzero(estimates >= least)
            query += low
            other = self.ids[query] != rows["vec_id"][code]
            query, code = query[other], code[other]
            exact = np.empty(len(query))
            for part in range(0, len(query), 1 << 16):  # the exact cosines, a bounded number at once
                cut = slice(part, part + (1 << 16))
                exact[cut] = np.einsum("ij,ij->i", self.unit[query[cut]], unit[code[cut]])
            close = exact >= threshold
            query, code = query[close], code[close]
            if not len(query):
                continue
            np.add.at(links, code, self.copies[query])
            if not same_block:  # within a block every pair comes twice, once for each end
                np.add.at(self.links, query, rows["copies"][code])
            self.linked[query] = True
            # queries of earlier tiles are joined with those of this one before they are forgotten
            earlier = np.unique(code[to[code] >= 0])
            self._join(np.concatenate([query, to[earlier]]), np.concatenate([code, earlier]), len(unit))
            to[code] = query
        return links, to


def _compare(threshold: float, epsilon: float, tile: int):
    """Rows come sorted by label, dimension and pair of blocks; the vectors of the first come before the codes of the second."""

    def found(ids: np.ndarray, links: np.ndarray, to: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(to)], names=["vec_id", "links", "to"])

    def finished(block: _Block) -> pa.RecordBatch:
        own = np.flatnonzero(block.linked)
        return found(block.ids[own], block.links[own], block.ids[block.root[own]])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, key, waiting = None, None, []
        for batch in batches:
            names = ("label", "size", "block", "pair")
            keys = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names], axis=1)
            side = batch.column("side").to_numpy(zero_copy_only=False)
            marks = np.column_stack([keys, side])
            edges = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), len(marks)]
            for low, high in zip(edges, edges[1:]):
                if low == high:
                    continue
                part, now = batch.slice(low, high - low), tuple(keys[low].tolist())
                if now != key:
                    if block is not None:
                        yield finished(block)
                    block, key, waiting = None, now, []
                rows = {n: part.column(n).to_numpy(zero_copy_only=False) for n in ("vec_id", "copies")}
                rows["vector"] = _matrix(part.column("embedding"))
                if side[low] == 0:
                    waiting.append(rows)
                    continue
                if block is None:
                    held = {n: np.concatenate([w[n] for w in waiting]) for n in ("vec_id", "copies", "vector")}
                    block, waiting = _Block(held["vec_id"], held["copies"], held["vector"], now[2]), []
                rows["factor"] = part.column("factor").to_numpy(zero_copy_only=False)
                rows["block"] = keys[low:high, 3]
                rows["code"] = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(high - low, -1)
                links, to = block.compare(rows, threshold, epsilon, tile)
                hit = np.flatnonzero(to >= 0)
                if len(hit):
                    yield found(rows["vec_id"][hit], links[hit], block.ids[block.root[to[hit]]])
        if block is not None:
            yield finished(block)

    return compare


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, epsilon: float = EPSILON, block_rows: int = BLOCK_ROWS, tile: int = TILE
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors``.

    ``vectors`` needs ``vec_id``, ``embedding`` and an integer ``label``. Rows are linked at a cosine of at
    least ``threshold`` if their labels are equal and their dimensions too. A null label, and a vector
    that is null, empty, zero or holds null, NaN or infinity, links with nothing: no links, a component
    of its own. Every row with an equal vector is a link; rows without a ``vec_id`` only count as
    links. An empty table gives an empty table.
    """
    bounded_batches(vectors.sparkSession)
    own = vectors.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), "embedding")
    infinite = float("inf")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    valid = own.where(usable)
    distinct = (
        valid.groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("size", F.size("embedding").cast("bigint"))
    )
    coded = written(
        distinct.where("vec_id IS NOT NULL").mapInArrow(
            _codes, distinct.withColumn("code", F.lit(None).cast("binary")).withColumn("factor", F.lit(None).cast("double")).schema
        ),
        "vector-codes",
    )
    blocks = written(
        coded.groupBy("label", "size").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("bigint").alias("blocks")), "vector-blocks"
    )
    placed = coded.join(blocks, ["label", "size"]).withColumn("own_block", F.pmod(F.xxhash64("vec_id"), "blocks"))
    # every block is held against itself and those after it, whose codes come to it
    held = placed.withColumns({"block": F.col("own_block"), "side": F.lit(0)})
    held = held.withColumn("pair", F.explode(F.sequence(F.col("own_block"), F.col("blocks") - 1)))
    streamed = placed.withColumns({"pair": F.col("own_block"), "side": F.lit(1)})
    streamed = streamed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), "own_block")))
    columns = ["label", "size", "block", "pair", "side", "vec_id", "copies", "embedding", "code", "factor"]
    pairs = blocks.agg(F.coalesce(F.sum(F.col("blocks").cast("double") * (F.col("blocks") + 1) / 2), F.lit(1.0))).first()[0]
    ordered = (
        held.select(columns)
        .unionByName(streamed.select(columns))
        .repartition(int(min(max(pairs, 1), MOST_TASKS)), "label", "size", "block", "pair")
        .sortWithinPartitions("label", "size", "block", "pair", "side")
    )
    found = written(ordered.mapInArrow(_compare(threshold, epsilon, tile), "vec_id bigint, links bigint, to bigint"), "vector-links")
    linked = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("vec_id").alias("a"), F.col("to").alias("b")))
    known = written(
        distinct.select("label", "embedding", F.col("vec_id").alias("first"), "copies")
        .join(linked.withColumnRenamed("vec_id", "first"), "first", "left")
        .join(joined.withColumnRenamed("node", "first"), "first", "left")
        .select("label", "embedding", "first", "copies", "links", "component_id"),
        "vector-groups",
    )
    first = F.coalesce("component_id", "first")
    grouped = valid.join(known, ["label", "embedding"]).select(
        "vec_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("bigint").alias("n_links"),
        first.alias("component_id"),
    )
    alone = own.where(~usable).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return grouped.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op5_embedding_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP5_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e,
           label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
    FROM embeddings
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE a.usable AND b.usable AND list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
    SELECT vec_id, vec_id AS other FROM v
    UNION
    SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = c.vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id) c
"""
