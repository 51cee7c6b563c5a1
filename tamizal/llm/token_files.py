"""Documents as token ids in files of Simple-8b words, in ascending order of ``doc_id``.

Documents are dealt by ranges of ``doc_id``; each task writes its files to the shared folder under names
of its own and reports them in a manifest, so a task that is run again leaves files that nobody lists.
Words met before are looked up in a bounded memo; all ids come from the tokenizers library.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamizal.llm import simple8b
from tamizal.llm.common import bounded_batches, table, written
from tamizal.session import scratch_path

END_ID = 2
FILE_IDS = 1 << 25
MANIFEST = "part int, place int, file string, n_docs bigint, n_tokens bigint"

# A blank with white space on both sides is the one place where text may not be cut before a blank.
_UNSAFE = re.compile(r"\s \s|\s \Z")
_UNIT = re.compile(r"\s*\S+|\s+")
# A run of signs after a letter is a pre-token of its own: what is before it is looked up without it.
_TAILED = r"(?s)^(?P<head>.*[A-Za-zÀ-ÖØ-öø-ÿ])(?P<tail>[!-/:-@\[-`{-~]+)$"
_JOINED = 800

_encoders: dict[str, UnitEncoder] = {}


class _Pool:
    """Ids of units, one after another; a unit is a slot: where its ids begin and how many they are."""

    def __init__(self):
        self.ids, self.starts, self.sizes = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.slots = self.used = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Slots for pieces of ``ids``; gives the first of them."""
        first, slots, used = self.slots, self.slots + len(sizes), self.used + len(ids)
        if used > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(2 * used - self.used, np.uint32)])
        if slots > len(self.sizes):
            more = np.zeros(2 * slots - first, np.int64)
            self.starts, self.sizes = np.concatenate([self.starts[:first], more]), np.concatenate([self.sizes[:first], more])
        self.ids[self.used : used] = ids
        self.sizes[first:slots] = sizes
        self.starts[first:slots] = self.used + np.cumsum(sizes) - sizes
        self.slots, self.used = slots, used
        return first

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``slots`` in order, and how many each has."""
        sizes = self.sizes[slots]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        where = np.repeat(self.starts[slots] - (ends - sizes), sizes)
        where += np.arange(total)
        return self.ids[where], sizes


class UnitEncoder:
    """Ids of texts, from the ids of units that the tokenizer never joins across.

    The byte-level pattern always begins a new pre-token at a blank that follows or precedes other
    text, so a text's ids are those of its pieces between such blanks. With ``added_tokens``, an added token
    that stands in a text has its own id, as in the library by default; otherwise those of its letters.

    Texts are cut and their distinct units found by Arrow; only units not met before reach the tokenizer, many
    at once. What is known is forgotten between batches when it is more than ``limit`` units.
    """

    def __init__(self, path: str, added_tokens: bool = False, limit: int = 1_000_000):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # for units; texts that hold an added token are encoded whole
        self.whole = Tokenizer.from_file(path)
        added = [token.content for token in self.whole.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) if added and added_tokens else "(?!)").search
        self.blank = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that begin with a blank
        self.blank[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith("Ġ")]] = True
        self.limit = limit
        self._forget()

    def _forget(self) -> None:
        self.pool, self.after_blank, self.bare = _Pool(), {}, {}
        self.bare[""] = self._keep(np.zeros(0, np.uint32))

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _keep(self, ids: np.ndarray) -> int:
        return self.pool.add(ids, np.array([len(ids)]))

    def _bare_slots(self, units: list[str]) -> list[int]:
        """Slots of units as they stand."""
        known = self.bare
        for unit in set(units).difference(known):
            known[unit] = self._keep(self._ids(unit))
        return [known[unit] for unit in units]

    def _slots_after_blank(self, units: list[str]) -> np.ndarray:
        """Slots of units with a blank before each. Joined by blanks, each begins at an id that begins with one."""
        known = self.after_blank
        new = list(set(units).difference(known))
        joinable = [u for u in new if u and not u[0].isspace()]
        for unit in new:
            if not unit or unit[0].isspace():
                known[unit] = self._keep(self._ids(" " + unit))
        for low in range(0, len(joinable), _JOINED):
            held = joinable[low : low + _JOINED]
            ids = self._ids(" " + " ".join(held))
            first = np.flatnonzero(self.blank[ids])
            if len(first) == len(held):
                slot = self.pool.add(ids, np.diff(first, append=len(ids)))
                known.update(zip(held, range(slot, slot + len(held))))
            else:
                for unit in held:
                    known[unit] = self._keep(self._ids(" " + unit))
        return np.fromiter(map(known.__getitem__, units), np.int64, len(units))

    def _simple(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Slots of texts that may be cut before every blank, and how many of them each text has."""
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        edges = cut.offsets.to_numpy()
        coded = cut.values.dictionary_encode()
        parts = pc.extract_regex(coded.dictionary, _TAILED)
        heads = pc.coalesce(parts.field("head"), coded.dictionary) if len(parts) else coded.dictionary
        tailed = parts.is_valid()
        heads = pc.if_else(tailed, heads, coded.dictionary)
        tails = pc.if_else(tailed, parts.field("tail"), pa.scalar("", parts.field("tail").type)).dictionary_encode()
        words = coded.indices.to_numpy()
        head = self._slots_after_blank(heads.to_pylist())
        tail = np.array(self._bare_slots(tails.dictionary.to_pylist()), np.int64)[tails.indices.to_numpy()]
        slots = np.stack([head[words], tail[words]], axis=1)
        starts = edges[:-1]
        slots[starts, 0] = self._bare_slots([text.split(" ", 1)[0] for text in texts])
        slots[starts, 1] = self.bare[""]
        return slots.ravel(), 2 * np.diff(edges)

    def encode_flat(self, texts: list[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, ``end`` after each one's (if given), and how many each has."""
        if len(self.after_blank) + len(self.bare) > self.limit:
            self._forget()
        last = [] if end is None else [self._keep(np.array([end], np.uint32))]
        simple, pieces = [], {}
        for i, text in enumerate(texts):
            if self.added(text):
                pieces[i] = [self._keep(np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32))]
            elif _UNSAFE.search(text):
                pieces[i] = self._bare_slots(_UNIT.findall(text))
            else:
                simple.append(i)
        counts = np.zeros(len(texts), np.int64)
        slots, sizes = self._simple([texts[i] for i in simple]) if simple else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        counts[simple] = sizes
        for i, own in pieces.items():
            counts[i] = len(own)
        counts += len(last)
        edges = np.concatenate([[0], np.cumsum(counts)])
        every = np.empty(int(edges[-1]), np.int64)
        if len(slots):  # slots of simple texts go where their texts stand
            shift = np.repeat(edges[:-1][simple] - (np.cumsum(sizes) - sizes), sizes)
            every[np.arange(len(slots)) + shift] = slots
        for i, own in pieces.items():
            every[edges[i] : edges[i] + len(own)] = own
        if last:
            every[edges[1:] - 1] = last[0]
        ids, of_slot = self.pool.gather(every)
        return ids, np.add.reduceat(np.append(of_slot, 0), edges[:-1]) * (counts > 0) if len(texts) else counts

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        ids, counts = self.encode_flat(texts)
        return [part.astype("<u4").tobytes() for part in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


def encoder(path: str) -> UnitEncoder:
    if path not in _encoders:
        _encoders[path] = UnitEncoder(path, added_tokens=True)
    return _encoders[path]


def _groups(texts: list[str], most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _write_files(folder: str, tokenizer: str, end_id: int, file_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pa.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        coder, part = encoder(tokenizer), TaskContext.get().partitionId()
        writer, name, place = None, "", 0

        def done() -> pa.RecordBatch:
            writer.close()
            row = [part], [place], [name], [writer.docs], [writer.ids]
            kinds = pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds)], names=["part", "place", "file", "n_docs", "n_tokens"]
            )

        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_numpy(), batch.column("text").to_pylist()
            for low, high in _groups(texts):
                if writer is None:
                    name = f"{part:06d}-{place:06d}-{uuid.uuid4().hex}.s8b"
                    writer = simple8b.Writer(files.open_output_stream(f"{root}/{name}"))
                ids, counts = coder.encode_flat(texts[low:high], end_id)
                writer.add(doc_ids[low:high], counts, ids)
                if writer.ids >= file_ids:
                    yield done()
                    writer, place = None, place + 1
        if writer is not None:
            yield done()

    return write


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, file_ids: int = FILE_IDS
) -> DataFrame:
    """Write files under ``folder`` (any address that all executors reach); gives their manifest.

    ``docs`` needs ``doc_id`` and ``text``. A null or empty text is ``end_id`` alone. Rows with one
    ``doc_id`` follow each other by their texts; rows without one come first, under the smallest
    bigint. An empty table has no files. Manifest: ``part``, ``place`` (both give the order of the
    files), ``file``, ``n_docs``, ``n_tokens``.
    """
    bounded_batches(docs.sparkSession)
    own = docs.select(
        F.coalesce("doc_id", F.lit(-(1 << 63)).cast("bigint")).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    ordered = own.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(_write_files(folder, tokenizer, end_id, file_ids), MANIFEST)
    return written(rows, "token-manifest")


def _read_files(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                rows, size = [], 0
                with files.open_input_file(f"{root}/{name}") as source:
                    for doc_id, start, ids in simple8b.read(source):
                        rows.append((doc_id, base + start, ids.astype("<u4").tobytes()))
                        size += len(ids)
                        if size >= 1 << 20:
                            yield _id_rows(rows)
                            rows, size = [], 0
                if rows:
                    yield _id_rows(rows)

    return read


def _id_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    doc_ids, starts, ids = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())],
        names=["doc_id", "start", "ids"],
    )


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before) and ``ids`` (little-endian uint32) from the files."""
    earlier = Window.orderBy("part", "place").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("file", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("base"))
    listed = written(placed, "token-bases")
    return (
        listed.repartition(max(1, listed.count()))
        .mapInArrow(_read_files(folder), "doc_id bigint, start bigint, ids binary")
        .withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")))
    )


def op4_token_files(spark, sf_dir):
    folder = scratch_path(spark, "token-files")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}"
    docs = table(spark, sf_dir, "documents")
    manifest = write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    ids = read_token_files(manifest, folder)
    return ids.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
