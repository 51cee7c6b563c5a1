"""Vector compression: product codes, with the nearest codebook entry found by Orchard's search.

A vector is cut into parts, a codebook of each part is refined by a fixed number of rounds, and a vector
becomes the index of the nearest entry in each part. For every entry of a codebook the other entries are
listed by their distance to it. A part starts at some entry and walks that entry's list: an entry that is
nearer than the best so far is jumped to and its own list is walked from its beginning, entries already
looked at are passed over, and the walk (by runs of a few entries) ends where the list is beyond twice the current distance, since
no entry from there on can be as near (triangle inequality). The walks of a batch go in step.

All numbers are integers, so sums do not depend on the order of rows and ties are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamizal.llm.common import bounded_batches, table, written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Components below this give squared distances and sums that fit 64 bits; larger ones are Python's integers.
NARROW = 1 << 20
_LIMB = 48
_RUN = 16  # entries of a list that are looked at together


def _cuts(size: int, parts: int) -> list[tuple[int, int]]:
    return [(p * size // parts, (p + 1) * size // parts) for p in range(parts)]


def _whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as integers of 64 bits, or as Python's where those could overflow."""
    scaled = vectors.astype(np.float64)
    if not scaled.size or np.abs(scaled).max() < NARROW / scale:
        return np.floor(scaled * scale).astype(np.int64)
    exact = np.empty(scaled.shape, object)
    for place, x in np.ndenumerate(scaled):
        top, bottom = float(x).as_integer_ratio()
        exact[place] = scale * top // bottom
    return exact


@dataclass
class Codebook:
    """Entries of one part (n x width) with, for each entry, all others by distance."""

    entries: np.ndarray

    def __post_init__(self) -> None:
        spread = self.entries[:, None, :] - self.entries[None, :, :]
        apart = (spread * spread).sum(axis=2)
        self.lists = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.lists, axis=1)
        sums = self.entries.sum(axis=1)
        self.by_sum = np.argsort(sums, kind="stable")
        self.sums = sums[self.by_sum]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each part (the lowest of equals) and its squared distance."""
        entries = self.entries
        n, count = len(parts), len(entries)
        if entries.dtype == object or parts.dtype == object:
            near_parts, near_entries = parts.astype(object), entries.astype(object)
        else:  # whole numbers below 2**53 in between: exact
            near_parts, near_entries = parts.astype(np.float64), entries.astype(np.float64)

        def ranked(place: np.ndarray, entry: np.ndarray) -> np.ndarray:
            """Squared distances with the index behind them, so that the least is the nearest, the lowest of equals."""
            apart = near_parts[place] - near_entries[entry]
            found = (apart * apart).sum(axis=1) if apart.dtype == object else np.einsum("ij,ij->i", apart, apart).astype(np.int64)
            return found * count + entry

        # a walk starts at the entry whose components sum up to about the same
        best = self.by_sum[np.minimum(np.searchsorted(self.sums, parts.sum(axis=1)), count - 1)].copy()
        rank = ranked(np.arange(n), best)
        distance = rank // count
        visited = np.zeros((n, count), bool)
        visited[np.arange(n), best] = True
        step = np.zeros(n, np.int64)
        walking, ahead = np.arange(n), np.arange(_RUN)
        while len(walking):
            # a run of the list is looked at before a jump
            at, place = best[walking][:, None], step[walking][:, None] + ahead
            inside = place < count
            place = np.minimum(place, count - 1)
            near = inside & (self.apart[at, place] <= 4 * distance[walking][:, None]).astype(bool)
            goes_on = near[:, 0]
            walking, at, place, near = walking[goes_on], at[goes_on], place[goes_on], near[goes_on]
            candidate = self.lists[at, place]
            row, column = np.nonzero(near & ~visited[walking[:, None], candidate])
            looked, tried = walking[row], candidate[row, column]
            visited[looked, tried] = True
            before = rank[walking]
            np.minimum.at(rank, looked, ranked(looked, tried))
            step[walking] += _RUN
            moved = walking[(rank[walking] < before).astype(bool)]
            distance[moved], best[moved], step[moved] = rank[moved] // count, (rank[moved] % count).astype(np.int64), 0
            walking = walking[step[walking] < count]
        return best, distance


Codebooks = dict[int, list[Codebook]]  # by the dimension of the vectors


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    column = batch.column("embedding")
    sizes = np.asarray(pc.list_value_length(column))
    for size in np.unique(sizes):
        own = batch.filter(pa.array(sizes == size))
        flat = own.column("embedding").flatten().to_numpy(zero_copy_only=False)
        yield int(size), own, flat.reshape(len(own), int(size))


def _limbs(value: int, count: int) -> list[int]:
    """``value`` in pieces of 48 bits, so that sums of many of them fit 64 bits; the last keeps the sign."""
    pieces = []
    for _ in range(count - 1):
        pieces.append(value & ((1 << _LIMB) - 1))
        value >>= _LIMB
    return [*pieces, value]


def _partial_sums(codebooks: Codebooks, scale: int, limbs: int):
    """What a task's vectors add to each entry: one row per entry used, whatever the number of vectors."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for size, _, vectors in _by_size(batch):
                whole = _whole(vectors, scale)
                for part, (low, high) in enumerate(_cuts(size, len(codebooks[size]))):
                    book = codebooks[size][part]
                    code, _ = book.nearest(whole[:, low:high])
                    if (size, part) not in sums:
                        sums[size, part] = np.zeros(len(book.entries), np.int64), np.zeros((len(book.entries), high - low), object)
                    counts, total = sums[size, part]
                    np.add.at(counts, code, 1)
                    added = np.zeros(total.shape, whole.dtype)
                    np.add.at(added, code, whole[:, low:high])
                    total += added
        rows = [
            (size, part, entry, int(counts[entry]), [limb for x in total[entry] for limb in _limbs(int(x), limbs)])
            for (size, part), (counts, total) in sums.items()
            for entry in np.flatnonzero(counts).tolist()
        ]
        columns = list(zip(*rows)) if rows else [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["size", "part", "entry", "n", "total"])

    return add


def _encode(codebooks: Codebooks, scale: int):
    most = (1 << 63) - 1

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, own, vectors in _by_size(batch):
                whole = _whole(vectors, scale)
                codes, error = [], np.zeros(len(own), object)
                for part, (low, high) in enumerate(_cuts(size, len(codebooks[size]))):
                    code, apart = codebooks[size][part].nearest(whole[:, low:high])
                    codes.append(code)
                    error += apart
                text = ["".join(f"{c:02x}" for c in row) for row in np.stack(codes, axis=1).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [own.column("vec_id"), own.column("label"), pa.array(text), pa.array([min(int(e), most) for e in error], pa.int64())],
                    names=["vec_id", "label", "code", "error"],
                )

    return encode


def _first_entries(kept: DataFrame, size: int, entries: int, parts: int, scale: int) -> list[Codebook]:
    first = kept.where((F.size("embedding") == size) & F.col("vec_id").isNotNull()).orderBy("vec_id", "embedding").select("embedding").limit(entries)
    rows = first.collect() or kept.where(F.size("embedding") == size).orderBy("embedding").select("embedding").limit(entries).collect()
    whole = _whole(np.array([r[0] for r in rows], np.float64).reshape(len(rows), size), scale)
    return [Codebook(whole[:, low:high]) for low, high in _cuts(size, parts)]


def _refined(kept: DataFrame, codebooks: Codebooks, scale: int, limbs: int) -> Codebooks:
    """Every entry becomes the floor of its parts' mean; an unused one stays. The rows read are one per entry."""
    schema = "size bigint, part bigint, entry bigint, n bigint, total array<bigint>"
    partial = kept.select("embedding").mapInArrow(_partial_sums(codebooks, scale, limbs), schema)
    # totals of the same place are added for as many places as the longest part has
    width = max((high - low) * limbs for size, books in codebooks.items() for low, high in _cuts(size, len(books)))
    totals = partial.groupBy("size", "part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(width)]).alias("total")
    )
    fresh = {size: [book.entries.copy() for book in books] for size, books in codebooks.items()}
    for size, part, entry, n, total in totals.collect():
        entries = fresh[size][part]
        for place in range(entries.shape[1]):
            pieces = total[place * limbs : (place + 1) * limbs]
            entries[entry, place] = sum(piece << (_LIMB * i) for i, piece in enumerate(pieces)) // n
    return {size: [Codebook(entries) for entries in books] for size, books in fresh.items()}


def vector_codes(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, Codebooks]:
    """``vec_id``, ``label``, ``code`` and ``error`` of every usable row, and the codebooks.

    Rows whose ``embedding`` is null or holds null, NaN or infinity are dropped. ``code`` is two hex digits per
    part, ``error`` the squared distance to the coded vector, at most the largest 64-bit integer. The codebooks
    start from the vectors of the smallest ``vec_id`` (equal ones by their components; rows without an id start
    one only where no row has an id); with fewer rows than ``entries`` they are shorter. Vectors of several
    dimensions have codebooks of their own, and a dimension that ``parts`` does not divide is cut as evenly as
    can be. Components of any size are exact. Repeated rows count as often as they stand there. An empty table
    gives no rows and no codebooks. A codebook has ``entries`` rows, so what the driver reads and what tasks are
    sent does not grow with the table.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    bounded_batches(vectors.sparkSession)
    infinite = float("inf")
    usable = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)), F.lit(False))
    kept = vectors.where(usable).select("vec_id", "label", "embedding")
    # all widths at once: how large components are decides only how they are carried
    largest = F.coalesce(F.array_max(F.transform("embedding", lambda x: F.abs(x))).cast("double"), F.lit(0.0))
    sizes = {r[0]: r[1] for r in kept.groupBy(F.size("embedding")).agg(F.max(largest)).collect()}
    bits = max([int(m).bit_length() for m in sizes.values()], default=0) + scale.bit_length() + 1
    limbs = 1 if bits <= NARROW.bit_length() else bits // _LIMB + 1
    codebooks = {size: _first_entries(kept, size, entries, parts, scale) for size in sizes}
    if any(m >= NARROW / scale for m in sizes.values()):
        codebooks = {s: [Codebook(b.entries.astype(object)) for b in books] for s, books in codebooks.items()}
    if not codebooks:
        return kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")), {}
    for _ in range(rounds):
        codebooks = _refined(kept, codebooks, scale, limbs)
    types = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    coded = kept.mapInArrow(_encode(codebooks, scale), f"vec_id {types['vec_id']}, label {types['label']}, code string, error bigint")
    return coded, codebooks


def codebooks_hash(codebooks: Codebooks) -> str:
    """SHA-256 of all components in decimal, by dimension, part, entry and place."""
    numbers = [str(int(x)) for size in sorted(codebooks) for book in codebooks[size] for x in book.entries.ravel()]
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors summed over rows of the same label (null is one), at most the largest bigint."""
    coded = written(coded, "vector-codes")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    per_label = coded.groupBy(F.col("label").alias("of")).agg(
        F.least(F.sum(F.col("error").cast("decimal(19,0)")).cast("decimal(38,0)"), most).cast("bigint").alias("label_error")
    )
    return coded.join(per_label, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def op11_vector_codes(spark, sf_dir):
    coded, codebooks = vector_codes(table(spark, sf_dir, "embeddings"))
    return with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_hash(codebooks)).alias("codebooks_sha256")
    )


def _op11_sql() -> str:
    steps = []
    for n in range(ROUNDS + 1):
        steps.append(f"""near{n} AS MATERIALIZED (
    SELECT vec_id, label, part, min({{'d': d, 'entry': entry}}) AS m
    FROM (SELECT vec_id, label, p.part, entry, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
          FROM p JOIN book{n} b ON p.part = b.part) GROUP BY ALL
)""")
        if n < ROUNDS:
            steps.append(f"""book{n + 1} AS MATERIALIZED (
    SELECT part, entry, coalesce(list(mean ORDER BY place) FILTER (WHERE mean IS NOT NULL), any_value(c)) AS c
    FROM book{n} LEFT JOIN (
        SELECT part, entry, place, ((s - ((s % k) + k) % k) // k)::BIGINT AS mean
        FROM (SELECT part, m.entry AS entry, place, sum(v)::BIGINT AS s, count(*) AS k
              FROM (SELECT part, m, unnest(x) AS v, generate_subscripts(x, 1) AS place FROM near{n} JOIN p USING (vec_id, part)) GROUP BY ALL)
    ) USING (part, entry) GROUP BY part, entry
)""")
    return f"""
WITH e AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
    SELECT vec_id, label, part, v[(part * len(v) // 4 + 1):((part + 1) * len(v) // 4)] AS x FROM e, (SELECT unnest([0, 1, 2, 3]) AS part)
), book0 AS MATERIALIZED (
    SELECT part, entry, x AS c FROM (SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM p) WHERE entry < 256
), {", ".join(steps)}, hash AS (
    SELECT sha256(string_agg(list_aggregate(c, 'string_agg', ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{ROUNDS}
), coded AS (
    SELECT vec_id, any_value(label) AS label, string_agg(lower(printf('%02x', m.entry)), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error
    FROM near{ROUNDS} GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, hash
"""


OP11_SQL = _op11_sql()
