"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

A window is summed up by the smallest hash among its 16-word pieces: equal windows have equal smallest
pieces. Neighbouring windows with one smallest piece form a run, about one run per 18 words, and a run
is what travels. Two hashes name a run: its smallest piece and all of its words.

1. Runs are counted by both hashes. A run whose words also stand in a smaller document is covered
   whole, however many copies there are.
2. Where one piece belongs to runs of different words (the ends of a shared passage, an edited copy),
   the runs of the smallest document of each wording are taken apart, and their windows counted by two
   64-bit hashes.
3. Covered windows of a text are merged into maximal intervals, and their words removed.

Every window belongs to exactly one run, so nothing is sampled: the pieces only choose how windows are
grouped for counting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamizal.llm.common import bounded_batches, table, written
from tamizal.llm.rolling import chunks, run_sums, texts_of, word_runs, word_runs_again, word_sums

WINDOW = 50
PIECE = 16


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours, by doubling."""
    done, least = 1, values
    while 2 * done <= width:
        least = np.minimum(least[: len(least) - done], least[done:])
        done *= 2
    if done < width:
        rest = width - done
        least = np.minimum(least[: len(least) - rest], least[rest:])
    return least


def _runs(chunk, window: int) -> tuple[np.ndarray, ...]:
    """Runs of the windows of a chunk: text, smallest piece, hash of the words, first and last window."""
    piece = min(PIECE, window)
    lengths = np.diff(chunk.firsts)
    windows = np.maximum(lengths - window + 1, 0)
    if not windows.any():
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    hashes = chunk.hashes()
    sums = word_sums(hashes)
    begin = np.arange(len(hashes) - piece + 1)
    least = _least(word_runs(sums, begin, begin + piece), window - piece + 1)
    text = np.repeat(np.arange(len(lengths)), windows)
    offset = np.concatenate([[0], np.cumsum(windows)])
    place = np.arange(offset[-1]) - offset[text]
    at = chunk.firsts[text] + place
    named = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (named[1:] != named[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    words = word_runs_again(run_sums(hashes), at[first], at[last] + window)
    return text[first], named[first].view(np.int64), words.view(np.int64), place[first], place[last]


def _scan(window: int):
    kind = pa.struct([("piece", pa.int64()), ("words", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                text, piece, words, a, b = _runs(chunk, window)
                offsets = np.searchsorted(text, np.arange(len(chunk.rows) + 1)).astype(np.int32)
                entries = pa.StructArray.from_arrays(
                    [pa.array(piece), pa.array(words), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))],
                    fields=list(kind),
                )
                rows = slice(chunk.rows.start, chunk.rows.stop)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[rows],
                        batch.column("row_key")[rows],
                        pa.ListArray.from_arrays(pa.array(offsets), entries),
                    ],
                    names=["doc_id", "row_key", "runs"],
                )

    return scan


def _windows(window: int):
    """Both hashes of each window of the runs ``wanted`` of a text."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("wanted")
            first = wanted.flatten().field(0).to_numpy(zero_copy_only=False).astype(np.int64)
            last = wanted.flatten().field(1).to_numpy(zero_copy_only=False).astype(np.int64)
            offsets = wanted.offsets.to_numpy() - wanted.offsets[0].as_py()
            ids = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "row_key")]
            for chunk in chunks(batch.column("text")):
                low, high = offsets[chunk.rows.start], offsets[chunk.rows.stop]
                row = np.repeat(np.arange(len(chunk.rows)), np.diff(offsets[chunk.rows.start : chunk.rows.stop + 1]))
                count = last[low:high] - first[low:high] + 1
                row = np.repeat(row, count)
                place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[low:high], count)
                hashes = chunk.hashes()
                at = chunk.firsts[row] + place
                own = row + chunk.rows.start
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[0][own]),
                        pa.array(ids[1][own]),
                        pa.array(place.astype(np.int32)),
                        pa.array(word_runs(word_sums(hashes), at, at + window).view(np.int64)),
                        pa.array(word_runs_again(run_sums(hashes), at, at + window).view(np.int64)),
                    ],
                    names=["doc_id", "row_key", "place", "one", "two"],
                )

    return windows


def _clean(window: int):
    """Texts without the words under their covered windows."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered = batch.column("covered")
            flat = covered.flatten()
            first = flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64)
            last = flat.field(1).to_numpy(zero_copy_only=False).astype(np.int64)
            offsets = covered.offsets.to_numpy() - covered.offsets[0].as_py()
            for chunk in chunks(batch.column("text")):
                low, high = offsets[chunk.rows.start], offsets[chunk.rows.stop]
                row = np.repeat(np.arange(len(chunk.rows)), np.diff(offsets[chunk.rows.start : chunk.rows.stop + 1]))
                change = np.zeros(len(chunk.starts) + 1, np.int64)
                np.add.at(change, chunk.firsts[row] + first[low:high], 1)
                np.add.at(change, chunk.firsts[row] + last[low:high] + window, -1)
                keep = np.cumsum(change[:-1]) == 0
                left = np.concatenate([[0], np.cumsum(keep)])[chunk.firsts]
                total = np.diff(chunk.firsts)
                rows = slice(chunk.rows.start, chunk.rows.stop)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[rows],
                        pa.array(total),
                        pa.array(total - np.diff(left)),
                        texts_of(*chunk.joined(keep)),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_text"],
                )

    return clean


def covered_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per text with some: ``doc_id``, ``row_key``, and ``covered``, ranges of windows (first, last).

    A window is covered if its words also begin a window of a document with a smaller ``doc_id``.
    """
    scan = written(
        docs.mapInArrow(
            _scan(window), "doc_id bigint, row_key bigint, runs array<struct<piece:bigint,words:bigint,a:int,b:int>>"
        ),
        "window-runs",
    )
    runs = scan.where("doc_id IS NOT NULL").select("doc_id", "row_key", F.inline("runs"))
    # one row for each wording of a run, however many copies, with its smallest and largest document
    wordings = written(
        runs.groupBy("piece", "words").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("largest")),
        "run-wordings",
    )
    mixed = (
        wordings.groupBy("piece")
        .agg(F.count(F.lit(1)).alias("n"), F.min("least").alias("lo"), F.max("least").alias("hi"))
        .where("n > 1 AND lo < hi")
        .select("piece", F.lit(True).alias("mixed"))
    )
    # written, so that joins on a hot wording have files on both sides and can be split
    concerned = written(
        wordings.join(mixed, "piece", "left")
        .select("piece", "words", "least", "largest", F.coalesce("mixed", F.lit(False)).alias("mixed"))
        .where("mixed OR least < largest"),
        "wordings-concerned",
    )
    marked = written(
        runs.join(concerned, ["piece", "words"])
        .where("doc_id > least OR (mixed AND doc_id = least)")
        .select("doc_id", "row_key", "a", "b", (F.col("doc_id") > F.col("least")).alias("whole")),
        "marked-runs",
    )
    whole = marked.where("whole").select("doc_id", "row_key", "a", "b")
    apart = written(
        marked.where("NOT whole")
        .groupBy("doc_id", "row_key")
        .agg(F.collect_list(F.struct("a", "b")).alias("wanted"), F.count(F.lit(1)).alias("n_wanted")),
        "runs-apart",
    )
    # a filter of known size on the few texts concerned, before all texts are moved
    docs.sparkSession.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    windows = written(
        docs.join(apart.where("n_wanted > 0").select("doc_id", "row_key", "wanted"), ["doc_id", "row_key"]).mapInArrow(
            _windows(window), "doc_id bigint, row_key bigint, place int, one bigint, two bigint"
        ),
        "windows-apart",
    )
    known = written(
        windows.groupBy("one", "two")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("largest"))
        .where("least < largest"),
        "known-windows",
    )
    single = (
        windows.join(known, ["one", "two"])
        .where("doc_id > least")
        .select("doc_id", "row_key", F.col("place").alias("a"), F.col("place").alias("b"))
    )
    ranges = whole.unionByName(single)
    return ranges.groupBy("doc_id", "row_key").agg(F.collect_set(F.struct("a", "b")).alias("covered"))


def remove_repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Texts without the words of windows that stand in a document with a smaller ``doc_id``.

    ``docs`` needs ``doc_id`` and ``text``; other columns do not matter. Gives ``doc_id``, ``n_words``,
    ``n_removed`` and ``kept_text`` (kept words joined by one blank), one row for each row. A null, empty
    or blank text has no words. Rows with one ``doc_id`` do not cover each other; rows without a
    ``doc_id`` neither cover others nor lose anything. Removal is judged on the texts as they came.
    """
    bounded_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    own = docs.select("doc_id", F.xxhash64(text).alias("row_key"), text.alias("text"))
    covered = written(covered_windows(own, window), "covered-windows")
    joined = own.join(covered, ["doc_id", "row_key"], "left")
    none = F.from_json(F.lit("[]"), "array<struct<a:int,b:int>>")
    return joined.select("doc_id", "text", F.coalesce("covered", none).alias("covered")).mapInArrow(
        _clean(window), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"
    )


def op1_substring_dedup(spark, sf_dir):
    cleaned = remove_repeated_windows(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
    SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS g
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)
), least AS (
    SELECT g, min(doc_id) AS first_doc FROM windows GROUP BY g
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
    FROM windows JOIN least USING (g) WHERE doc_id > first_doc
), placed AS (
    SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
    FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
