"""Prefix trie of conversations by vertical bitmaps.

Conversations are dealt by their ids, in order, to shards of bounded size, and long ones are cut into
segments, so that a task holds one bounded block of turns whatever a conversation or a prefix weighs.
A block is indexed vertically: (position, turn) leads to the bitset of its conversations. A depth-first
walk starts from the bitset of a common prefix and intersects it with the postings of the next position:
each non-empty intersection is a child, its popcount the members, what is left in no child ends there.

The blocks' nodes meet by the hash of their prefix. What a subtree sums up is a sum over its members:
a conversation is the smallest member of its nodes from some depth on, so it repeats the turns before
that depth and only those. A second walk adds these up by popcount and from the leaves to the top.

Texts never move: a turn is the MD5 of its role and text, and the number of its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamizal.llm.common import table, word_count, written
from tamizal.operators.ranking import add_row_number

SHARD = 2048  # conversations of a shard
SEGMENT = 256  # turns of one conversation in a block
SHARED_GROUP = 20
ROOT = hashlib.md5(b"root").digest()

_NODE = "shard bigint, key binary, parent_key binary, depth bigint, n_convs bigint, first bigint, words bigint, ends array<bigint>"
_SUMS = "key binary, repeated bigint, leaves bigint"


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``turn`` (MD5 of role and text) and ``words`` of every turn.

    A conversation stands in the order of ``turn``, null first; equal turns by the MD5 (a defined order), so
    repeated rows are turns one after another. Null role or text is empty. Rows without ``conv_id`` belong
    to no conversation. Other columns are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint"), F.col("turn").alias("at"), said.alias("said"), word_count(text).alias("words")
    )
    numbered = add_row_number(written(rows, "trie-said"), ["conv_id"], [("at", "asc")], ["said"], "pos")
    return numbered.select("conv_id", "pos", F.unhex("said").alias("turn"), "words")


def rebuilt_turns(turns: DataFrame, shared: Column, group: int = SHARED_GROUP) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and every ``conv_id`` with its ``length`` (zero too).

    The first ``shared`` (an expression over ``conv_id``) turns come from conversation ``conv_id - conv_id % group``
    (all if it has fewer, none if it is absent), then the own turns follow after the first ``shared``.
    """
    turns = written(turns, "trie-turns")
    base = F.col("conv_id") - F.col("conv_id") % group
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).withColumns({"shared": shared.cast("bigint"), "base": base})
    # one row per conversation, whatever its length
    bases = lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    conversations = written(
        lengths.join(bases, "base", "left").withColumn("taken", F.least("shared", F.coalesce("base_own", F.lit(0)))), "trie-lengths"
    )
    most = turns.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), "pos", "turn", "words")
    taken = conversations.where("taken > 0").select("conv_id", "base", "taken")
    heads = taken.join(most.where(F.col("pos") <= (taken.agg(F.max("taken")).scalar())), "base").where("pos <= taken")
    own = turns.where(F.col("pos") > shared).join(conversations.select("conv_id", "shared", "taken"), "conv_id")
    tails = own.withColumn("pos", F.col("pos") - F.col("shared") + F.col("taken"))
    columns = ["conv_id", "pos", "turn", "words"]
    rebuilt = heads.select(columns).unionByName(tails.select(columns))
    length = F.greatest(F.col("own") - F.col("shared"), F.lit(0)) + F.col("taken")
    return rebuilt, conversations.select("conv_id", length.alias("length"))


def _blocks(turns: DataFrame, conversations: DataFrame, shard: int, segment: int) -> DataFrame:
    """One row per conversation and segment: its turns, the keys of the prefixes it starts and ends at."""
    numbered = add_row_number(conversations, [], [("conv_id", "asc")], [], "number")
    placed = numbered.withColumn("shard", F.floor((F.col("number") - 1) / shard).cast("bigint")).select("conv_id", "shard", "length")
    placed = written(placed, "trie-shards")
    part = F.floor((F.col("pos") - 1) / segment).cast("bigint")
    # at most ``segment`` turns to a row
    cut = (
        turns.groupBy("conv_id", part.alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "turn", "words"))).alias("t"))
        .select("conv_id", "part", F.col("t.turn").alias("turns"), F.col("t.words").alias("words"))
    )
    # the prefix before a segment by the sums of its segments' hashes, so that no turn waits for the one before
    text = F.concat_ws("", F.transform("turns", F.hex), F.col("part").cast("string"))
    marks = [F.conv(F.substring(F.md5(F.concat(F.lit(salt), text)), 1, 15), 16, 10).cast("decimal(20,0)") for salt in "ab"]
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    upto = before.rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumns({"a": marks[0], "b": marks[1]})

    def key(window) -> Column:
        return F.unhex(F.md5(F.concat_ws(",", *[F.sum(c).over(window).cast("string") for c in "ab"])))

    cut = cut.withColumns({"start": F.coalesce(key(before), F.lit(ROOT)), "end": key(upto)}).drop("a", "b")
    cut = cut.withColumn("start", F.when(F.col("part") == 0, F.lit(ROOT)).otherwise(F.col("start")))
    rows = placed.join(cut, "conv_id", "left").withColumns(
        {"part": F.coalesce("part", F.lit(0)), "start": F.coalesce("start", F.lit(ROOT)), "turns": F.coalesce("turns", F.array()),
         "words": F.coalesce("words", F.array().cast("array<bigint>"))}
    )
    stays = F.col("length") <= (F.col("part") + 1) * segment  # the conversation ends in this block
    return rows.select("shard", "part", "conv_id", "start", "end", "turns", "words", stays.alias("stays"))


class _Walk:
    """Depth-first walk over one block, from each prefix that its conversations start with."""

    def __init__(self, block: pa.Table, segment: int):
        block = block.sort_by("conv_id")
        self.segment = segment
        self.ids = block["conv_id"].to_pylist()
        self.turns = block["turns"].to_pylist()
        self.words = block["words"].to_pylist()
        self.end = block["end"].to_pylist()
        self.stays = block["stays"].to_pylist()
        self.first_depth = block["part"][0].as_py() * segment
        self.postings: dict[tuple[int, bytes], int] = {}
        self.starts: dict[bytes, int] = {}
        self.ending: dict[int, int] = {}  # conversations by their number of turns in the block
        for place, (start, turns) in enumerate(zip(block["start"].to_pylist(), self.turns)):
            bit = 1 << place
            self.starts[start] = self.starts.get(start, 0) | bit
            self.ending[len(turns)] = self.ending.get(len(turns), 0) | bit
            for position, turn in enumerate(turns):
                self.postings[position, turn] = self.postings.get((position, turn), 0) | bit

    def nodes(self) -> Iterator[tuple[bytes, bytes | None, int, int, int, int]]:
        """(key, parent's key, depth in the block, bitset, place of the smallest member, words), parents first."""
        for start, members in self.starts.items():
            open_nodes = [(start, None, 0, members)]
            while open_nodes:
                key, parent, depth, members = open_nodes.pop()
                low = (members & -members).bit_length() - 1
                yield key, parent, depth, members, low, self.words[low][depth - 1] if depth else 0
                rest = members & ~self.ending.get(depth, 0)
                while rest:
                    place = (rest & -rest).bit_length() - 1
                    turn = self.turns[place][depth]
                    child = rest & self.postings[depth, turn]
                    rest ^= child
                    # the last depth of a segment is where the next one starts
                    full = depth + 1 == self.segment
                    next_key = self.end[place] if full else hashlib.md5(key + turn).digest()
                    open_nodes.append((next_key, key, depth + 1, child))


def _places(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def _nodes(segment: int):
    def walk(block: pa.Table) -> pa.Table:
        walked = _Walk(block, segment)
        stays = sum(1 << i for i, s in enumerate(walked.stays) if s)
        columns: list[list] = [[] for _ in range(8)]
        shard = block["shard"][0].as_py()
        for key, parent, depth, members, low, words in walked.nodes():
            if depth == 0 and walked.first_depth:  # a node of the segment before
                continue
            ends = members & walked.ending.get(depth, 0) & stays
            row = (shard, key, parent, walked.first_depth + depth, members.bit_count(), walked.ids[low], words, [walked.ids[i] for i in _places(ends)])
            for column, value in zip(columns, row):
                column.append(value)
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        names = ["shard", "key", "parent_key", "depth", "n_convs", "first", "words", "ends"]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return walk


def _sums(segment: int):
    """Repeated words and leaves below each node, from what each conversation repeats and owns."""

    def walk(block: pa.Table) -> pa.Table:
        block = block.sort_by("conv_id")
        walked = _Walk(block, segment)
        own_from = block["own_from"].to_pylist()  # the depth from which a conversation is the smallest member
        leaf, later = block["leaf"].to_pylist(), block["later"].to_pylist()
        found = list(walked.nodes())
        repeated: dict[tuple[bytes, int], int] = {}
        leaves: dict[tuple[bytes, int], int] = {}
        for key, parent, depth, members, low, words in reversed(found):
            at, above = (key, depth), (parent, depth - 1)
            count, tips = repeated.get(at, 0), leaves.get(at, 0)
            for place in _places(members & walked.ending.get(depth, 0)):  # what leaves the block here
                count += later[place]
                tips += leaf[place]
            if depth:
                owner = own_from[low] is not None and own_from[low] <= walked.first_depth + depth
                count += words * (members.bit_count() - owner)
            repeated[at], leaves[at] = count, tips
            if parent is not None:
                repeated[above] = repeated.get(above, 0) + count
                leaves[above] = leaves.get(above, 0) + tips
        out = [(n[0], n[2]) for n in found if n[2] or not walked.first_depth]
        arrays = [pa.array([k for k, _ in out], pa.binary()), pa.array([repeated[n] for n in out], pa.int64()), pa.array([leaves[n] for n in out], pa.int64())]
        return pa.Table.from_arrays(arrays, names=["key", "repeated", "leaves"])

    return walk


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a list come one after another: it is hashed as it passes and never held."""
    key, digest = None, None
    for batch in batches:
        keys, hashes = [], []
        for now, ids in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if now != key:
                if key is not None:
                    keys.append(key)
                    hashes.append(digest.hexdigest())
                key, digest = now, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(",".join(map(str, ids)).encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(hashes, pa.string())], names=["key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())], names=["key", "ends_sha256"])


def prefix_trie(turns: DataFrame, conversations: DataFrame, shard: int = SHARD, segment: int = SEGMENT) -> DataFrame:
    """A row per distinct prefix of the conversations, the empty one included.

    ``turns`` has ``conv_id``, ``pos`` (1, 2, ..), ``turn`` (binary, equal for equal turns) and ``words``;
    ``conversations`` every ``conv_id`` once with its ``length``. Returns ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256`` of the members that end there, in the order of their ids. ``conv_id`` and ``depth`` are
    unique together. Conversations without turns end at the root; without conversations there are no rows.

    A node's list of ends is hashed by one task, in pieces of a shard that pass through it: SHA-256 of one
    string has no other order. Everything else of a hot prefix is added up from one row per shard.
    """
    blocks = written(_blocks(turns, conversations, shard, segment), "trie-blocks")
    local = written(blocks.groupBy("shard", "part").applyInArrow(_nodes(segment), f"{_NODE}"), "trie-local")
    nodes = written(
        local.groupBy("key").agg(
            F.any_value("parent_key").alias("parent_key"), F.any_value("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
            F.min("first").alias("conv_id"), F.any_value("words").alias("words"), F.min("shard").alias("shard"),
        ),
        "trie-nodes",
    )
    children = written(nodes.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    nodes = nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    owners = written(
        nodes.groupBy("conv_id").agg(F.min("depth").alias("own_from"), F.max((F.col("n_children") == 0).cast("bigint")).alias("leaf")), "trie-owners"
    )
    # turns before the owned depths are repeats; those of later segments are handed to the segment before
    start = F.col("part") * segment
    repeats = F.aggregate(
        F.when(F.col("own_from").isNull(), F.col("words")).otherwise(F.slice("words", F.lit(1), F.greatest(F.col("own_from") - 1 - start, F.lit(0)).cast("int"))),
        F.lit(0).cast("bigint"), lambda a, w: a + w,
    )
    later = Window.partitionBy("conv_id").orderBy("part").rowsBetween(1, Window.unboundedFollowing)
    owned = blocks.join(owners, "conv_id", "left").withColumn("leaf", F.coalesce("leaf", F.lit(0))).withColumn("mine", repeats)
    owned = owned.withColumn("later", F.coalesce(F.sum("mine").over(later), F.lit(0))).drop("mine")
    sums = owned.groupBy("shard", "part").applyInArrow(_sums(segment), _SUMS)
    sums = sums.groupBy("key").agg(F.sum("repeated").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    pieces = local.where(F.size("ends") > 0).select("key", "first", "ends")
    # ``first`` of a piece is not above its ends, and shards follow each other in the order of ids
    hashes = pieces.repartition("key").sortWithinPartitions("key", F.col("ends")[0]).drop("first").mapInArrow(_end_hashes, "key binary, ends_sha256 string")
    # a parent of very many nodes comes once for each shard, and its children meet it there
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    asked = nodes.join(owners.select("conv_id", "own_from"), "conv_id").where("depth = own_from").select("shard", "parent_key").distinct()
    parents = written(asked.join(parents, "parent_key"), "trie-parents")
    own_above = owners.select("conv_id", "own_from")
    whole = written(nodes.join(sums, "key").join(hashes, "key", "left").join(own_above, "conv_id"), "trie-sums")
    # below its first owned node a conversation's parents are its own
    inner = whole.where("depth > own_from").withColumn("parent_conv_id", F.col("conv_id"))
    outer = whole.where("depth = own_from").join(parents, ["shard", "parent_key"], "left").withColumnRenamed("above", "parent_conv_id")
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    ]
    return inner.select(columns).unionByName(outer.select(columns))


def op13_prefix_trie(spark, sf_dir):
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    turns, conversations = rebuilt_turns(ordered_turns(table(spark, sf_dir, "conversations")), shared)
    return prefix_trie(turns, conversations)


OP13_SQL = """
WITH own AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) AS pos, said, n
    FROM (SELECT conv_id, turn, md5(length(r) || ':' || r || t) AS said,
                 len(list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS n
          FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL))
), conv AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
        lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM own)
), parts AS (
    SELECT c.conv_id, 0 AS side, o.pos, o.said, o.n FROM conv c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h
    UNION ALL
    SELECT c.conv_id, 1, o.pos, o.said, o.n FROM conv c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h
), turns AS (
    SELECT conv_id, row_number() OVER w AS depth, n, string_agg(said, '') OVER w AS key
    FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY side, pos ROWS UNBOUNDED PRECEDING)
), path AS (
    SELECT conv_id, depth, n, key, coalesce(lag(key) OVER (PARTITION BY conv_id ORDER BY depth), '') AS parent FROM turns
    UNION ALL SELECT conv_id, 0, 0, '', NULL FROM conv
), lengths AS (SELECT conv_id, max(depth) AS length FROM path GROUP BY 1
), node AS (
    SELECT key, any_value(parent) AS parent, any_value(depth) AS depth, any_value(n) AS n, min(p.conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(sha256(string_agg(CASE WHEN depth = length THEN p.conv_id::VARCHAR END, ',' ORDER BY p.conv_id)), sha256('')) AS ends_sha256
    FROM path p JOIN lengths USING (conv_id) GROUP BY key
), kids AS (SELECT parent AS key, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY 1
), below AS (  -- every node with each prefix of it: the prefixes of its smallest member
    SELECT p.key AS top, sum((v.n_convs - 1) * v.n) AS saved_tokens, count(*) FILTER (WHERE k.key IS NULL) AS n_leaves
    FROM node v LEFT JOIN kids k USING (key) JOIN path p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY 1
)
SELECT v.conv_id, v.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, v.n_convs, coalesce(k.n_children, 0) AS n_children, b.n_leaves,
       b.saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM node v JOIN below b ON b.top = v.key LEFT JOIN kids k ON k.key = v.key LEFT JOIN node u ON u.key = v.parent
"""
