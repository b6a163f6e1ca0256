"""The prefix trie of conversations, built level by level.

A node is a distinct sequence of first turns.  Its name is its depth and the least conv_id below it, as a
conversation has one node a depth.  Level d groups the conversations that still share a node of depth d - 1
by (that node, next turn); the least conv_id of a group names the child.  A conversation that is alone in its
node leaves: what follows is a chain of its own, of which every row is known at once.  So levels go on only as
deep as two conversations agree.  Then levels are joined from the deepest up, and leaves and savings add up.

Turns are compared by the SHA-256 of role and text and sorted by depth, so that a level reads its own turns
only; texts don't move.  Groups and sums have partial aggregates before their shuffle, whatever share of the
conversations one node holds.  Conversations meet their group by a plain join, of which Spark splits a large
key; long conversations are numbered in cells of 1024 turns, and long chains and lists of ids go out in blocks.
The levels are tables of the shared folder; the driver holds one row of counts.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sampling import numbered
from .frames import schema, stored, written

#: Turn numbers of a cell, nodes of a piece of a chain, and ids of a piece of a list.
CELL, CHAIN, LIST_BITS = 1024, 4096, 12
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
_NOTHING = hashlib.sha256().hexdigest()


def ordered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, key, bytes): each turn's place from 1, its identity, and the UTF-8 bytes of its text.

    Turns go by turn, nulls first, ties by key; a null role or text is empty.  Rows without conv_id belong to no
    conversation and are left out; repeated rows are turns of their own; other columns don't matter."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), F.col("turn").cast("long").alias("turn"), key.alias("key"), F.octet_length(text).cast("long").alias("bytes"))
    cell = F.coalesce(F.floor(F.col("turn") / CELL), F.lit(-(1 << 62)))
    return numbered(rows, "conv_id", cell, [F.asc_nulls_first("turn"), F.asc("key")], "pos").select("conv_id", "pos", "key", "bytes")


def lengths(turns: DataFrame) -> DataFrame:
    """(conv_id, length) of turns with pos."""
    return turns.groupBy("conv_id").agg(F.max("pos").alias("length"))


def with_shared_heads(turns: DataFrame, head: Column, most: int, every: int = 5) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of conversations whose first `head` turns (an expression of conv_id, at most `most`) are
    replaced by those of conversation conv_id - conv_id % every, as far as that has any.  Conversations that are
    left without turns keep their row of length 0."""
    own = lengths(turns)
    base = F.col("conv_id") - F.col("conv_id") % every
    whole = own.select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    convs = own.select("conv_id", "length", base.alias("base"), head.cast("long").alias("head")).join(whole, "base", "left")
    got = F.least("head", F.coalesce("base_length", F.lit(0)))
    convs = convs.select("conv_id", "base", "head", got.alias("got"), (got + F.greatest(F.col("length") - F.col("head"), F.lit(0))).alias("length"))
    first = turns.where((F.col("pos") <= most) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "base")
    taken = convs.join(first, "base").where("pos <= head").select("conv_id", "pos", "key", "bytes")
    kept = turns.join(convs.select("conv_id", "head", "got"), "conv_id").where("pos > head").select("conv_id", (F.col("pos") - F.col("head") + F.col("got")).alias("pos"), "key", "bytes")
    return taken.unionAll(kept), convs.select("conv_id", "length")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node: conv_id (least member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves and saved_tokens (over the subtree: bytes of a node's last text times the members but one), and
    ends_sha256 of the ids of conversations that end at the node.

    turns as ordered() gives them, convs (conv_id, length) with one row a conversation, also one without turns.
    No conversations make no node; one alone makes the root and its chain."""
    spark = turns.sparkSession
    convs = written(convs.select("conv_id", "length"), "convs")
    total = convs.agg(F.min("conv_id").alias("least"), F.count("*").alias("many")).first()
    if not total["many"]:
        return spark.createDataFrame([], schema(None, **dict.fromkeys(_NODE, "long"), ends_sha256="string"))
    turns = written(turns.repartitionByRange("pos", "conv_id").sortWithinPartitions("pos", "conv_id"), "turns")
    top = convs.select("conv_id", "length", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"), F.lit(total["least"]).cast("long").alias("node"), F.lit(total["many"]).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("bytes"))
    levels = [stored(top, "level")]
    while True:
        depth = len(levels)
        live = levels[-1][0].where((F.col("length") >= depth) & _shared()).select("conv_id", "length", F.col("node").alias("parent"))
        if live.isEmpty():
            break
        levels.append(stored(_level(live, turns.where(F.col("pos") == depth), depth), "level"))
    every = spark.read.schema(top.schema).parquet(*(path for _, path in levels))
    shared = _rolled_up([level for level, _ in levels])
    ends = _ends(every.where(_shared() & (F.col("length") == F.col("depth"))).select(F.col("node").alias("conv_id"), "depth", F.col("conv_id").alias("one")))
    shared = shared.join(ends, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NOTHING)))
    return shared.unionByName(_chains(every.where(~_shared())))


def _shared() -> Column:
    """Whether the row's node is worked on by levels: the root, and what several conversations share."""
    return (F.col("n_convs") > 1) | (F.col("depth") == 0)


def _level(live: DataFrame, turns: DataFrame, depth: int) -> DataFrame:
    """The rows of live with their node of this depth."""
    here = turns.join(live, "conv_id").select("conv_id", "length", "parent", "key", "bytes")
    groups = here.groupBy("parent", "key").agg(F.min("conv_id").alias("node"), F.count("*").alias("n_convs"))
    return here.join(groups, ["parent", "key"]).select("conv_id", "length", F.lit(depth).cast("long").alias("depth"), "parent", "node", "n_convs", "bytes")


def _rolled_up(levels: list[DataFrame]) -> DataFrame:
    """Nodes that _shared() holds for, from the deepest level up."""
    paths, below = [], None
    for level in reversed(levels):
        saved = (F.col("n_convs") - 1) * F.col("bytes")
        nodes = level.where((F.col("conv_id") == F.col("node")) & _shared())
        if below is None:
            counts = F.lit(0).cast("long"), F.lit(1).cast("long"), saved
        else:
            nodes = nodes.join(below.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("many"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("more")), "node", "left")
            counts = F.coalesce("many", F.lit(0)), F.coalesce("leaves", F.lit(1)), saved + F.coalesce("more", F.lit(0))
        nodes, path = stored(nodes.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", *(c.alias(n) for c, n in zip(counts, _NODE[4:], strict=True))), "nodes")
        paths.append(path)
        alone = level.where(~_shared()).select("parent", F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
        below = nodes.select(F.col("parent_conv_id").alias("parent"), "n_leaves", "saved_tokens").unionAll(alone)
    return nodes.sparkSession.read.schema(nodes.schema).parquet(*paths)


def _chains(heads: DataFrame) -> DataFrame:
    """The nodes of conversations from where each is alone to its end."""
    pieces = heads.select("conv_id", "length", "depth", "parent", F.explode(F.sequence("depth", "length", F.lit(CHAIN).cast("long"))).alias("low")).repartition("conv_id", "low")
    rows = pieces.withColumn("at", F.explode(F.sequence("low", F.least(F.col("low") + CHAIN - 1, F.col("length")))))
    last = F.col("at") == F.col("length")
    one = F.lit(1).cast("long")
    return rows.select("conv_id", F.col("at").alias("depth"), F.when(F.col("at") == F.col("depth"), F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"), one.alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(_NOTHING).alias("ends_sha256"))


def _ends(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of rows with one id each: ids in order, joined by commas.  A list goes out in
    pieces of an id range, which the hash takes one after another."""
    piece = F.shiftright("one", LIST_BITS)
    lists = rows.groupBy("conv_id", "depth", piece.alias("piece")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("one")), lambda x: x.cast("string")), ",").alias("ids"))

    def digest(batches):
        now, sha = None, None
        for batch in batches:
            done = []
            for conv, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids")), strict=True):
                if (conv, depth) != now:
                    if now:
                        done.append((*now, sha.hexdigest()))
                    now, sha = (conv, depth), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield _digests(done)
        if now:
            yield _digests([(*now, sha.hexdigest())])

    return lists.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "piece").mapInArrow(digest, schema(None, conv_id="long", depth="long", ends_sha256="string"))


def _digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["conv_id", "depth", "ends_sha256"])
