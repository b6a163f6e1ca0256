"""Fine-tuning rows of token ids: chats in a template, labels for answers only, examples packed into a trainer's context.

Tokens are made once for each distinct chat, in the table's partitions.  For packing, rows are dealt by a hash over
tasks, and a task fills rows from CELL examples at a time, so that it holds no more than these however many it has.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Label of tokens that no loss counts.
IGNORE = -100
#: Examples that are packed together, and copies of a chat that are made at a time.
CELL = 4096


@dataclass(frozen=True)
class Template:
    """A turn is opening, with the turn's role for {role}, content, closing.  Contents and closings of the answering
    role carry labels; each part is tokenised by itself, so no token lies over the edge of an answer."""

    opening: str = "<|im_start|>{role}\n"
    closing: str = "<|im_end|>\n"
    answers: str = "assistant"


def tokenised(df: DataFrame, key: str, vocabulary: str, template: Template = Template(), most: int = 1024) -> DataFrame:
    """key, copy, ids and labels (arrays of int) for each row of df, which has messages: arrays of (role, content) in order.

    vocabulary is a tokenizers file that all workers can read.  Chats of more than `most` tokens are cut at the end;
    those without any token of an answer within these go, as do null chats.  Null roles and contents are empty.  Rows
    that repeat key and messages are tokenised once and numbered by copy."""
    turn = df.schema["messages"].dataType.elementType
    places = [turn.fieldNames().index(c) for c in ("role", "content")]
    kept = df.where(F.col("messages").isNotNull()).groupBy(key, "messages").agg(F.count("*").alias("__n"))

    def run(batches):
        from tokenizers import Tokenizer

        coder = Tokenizer.from_file(vocabulary)
        coder.no_truncation()
        coder.no_padding()
        for batch in batches:
            chats = batch.column("messages")
            ends = np.cumsum(pc.list_value_length(chats).to_numpy(zero_copy_only=False), dtype=np.int64)
            roles, contents = (pc.fill_null(pc.struct_field(chats.flatten(), [at]), "").to_pylist() for at in places)
            parts = [p for r, c in zip(roles, contents, strict=True) for p in (template.opening.replace("{role}", r), c + template.closing)]
            once = {p: i for i, p in enumerate(dict.fromkeys(parts))}  # openings and system turns are the same in most chats
            known = [e.ids for e in coder.encode_batch_fast(list(once), add_special_tokens=False)]
            many = np.fromiter(map(len, known), np.int64, len(known))
            tokens = np.fromiter(chain.from_iterable(known), np.int32, int(many.sum()))
            use = np.fromiter((once[p] for p in parts), np.int64, len(parts))
            first, sizes = (np.cumsum(many) - many)[use], many[use]
            # of each part what is left below `most` tokens of its chat
            ends = np.concatenate([[0], 2 * ends])
            before = np.concatenate([[0], np.cumsum(sizes)])
            sizes = np.clip(most - (before[:-1] - np.repeat(before[ends[:-1]], np.diff(ends))), 0, sizes)
            before = np.concatenate([[0], np.cumsum(sizes)])
            ids = tokens[np.repeat(first - before[:-1], sizes) + np.arange(before[-1])]
            marks = np.zeros(len(parts), bool)
            marks[1::2] = np.fromiter((r == template.answers for r in roles), bool, len(roles))
            labels = np.where(np.repeat(marks, sizes), ids, np.int32(IGNORE))
            trained = np.concatenate([[0], np.cumsum(np.where(marks, sizes, 0))])[ends]
            cols = [batch.column(key), batch.column("__n"), *(listed(before[ends], x) for x in (ids, labels))]
            yield pa.RecordBatch.from_arrays(cols, names=[key, "__n", "ids", "labels"]).filter(pa.array(np.diff(trained) > 0))

    made = kept.mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, __n bigint, ids array<int>, labels array<int>")
    blocks = made.withColumn("__block", F.explode(F.sequence(F.lit(0), F.expr(f"(__n - 1) div {CELL}"))))
    first = F.col("__block") * CELL
    copies = blocks.withColumn("copy", F.explode(F.sequence(first, F.least(first + CELL, F.col("__n")) - 1)))
    return copies.select(key, "copy", "ids", "labels")


def listed(ends: np.ndarray, values: np.ndarray | pa.Array) -> pa.ListArray:
    """Values as lists that begin at 0 and end at ends[1:]."""
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values) if isinstance(values, np.ndarray) else values)


def bins(sizes: list[int], room: int) -> list[list[int]]:
    """Places of sizes, none above room, in bins: from the largest down, each into the fullest bin that takes it, of
    equals the oldest."""
    out: list[list[int]] = []
    left: list[tuple[int, int]] = []  # free room and number of each bin that has some, in order
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_left(left, (sizes[i], -1))
        if at < len(left):
            free, b = left.pop(at)
            out[b].append(i)
        else:
            free, b = room, len(out)
            out.append([i])
        if free > sizes[i]:
            insort(left, (free - sizes[i], b))
    return out


def packed(rows: DataFrame, key: str, room: int = 1024, tasks: int | None = None) -> DataFrame:
    """Rows of tokenised() put together: pack, keys (as strings), lengths, ids and labels, `room` tokens at most.

    No example is split; lengths tell a trainer where each ends, so that none attends to another.  The result doesn't
    depend on the partitions of rows, but on `tasks` (spark.sql.shuffle.partitions if not given).  An example of more
    than `room` tokens is an error."""
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def fill(task: int, cell: int, batch: pa.Table):
        key_, ids, labels = (batch.column(c).combine_chunks() for c in ("__key", "ids", "labels"))
        sizes = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
        if sizes.max() > room:
            raise ValueError(f"an example has {sizes.max()} tokens, {room} is the most")
        found = bins(sizes.tolist(), room)
        order = np.fromiter(chain.from_iterable(found), np.int64, len(sizes))
        many = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))])
        ends = np.concatenate([[0], np.cumsum(sizes[order])])[many]
        cols = [
            pa.array((task << 40) + (cell << 13) + np.arange(len(found)), pa.int64()),
            listed(many, key_.take(order)),
            listed(many, sizes[order].astype(np.int32)),
            *(listed(ends, x.take(order).flatten()) for x in (ids, labels)),
        ]
        return pa.RecordBatch.from_arrays(cols, names=["pack", "keys", "lengths", "ids", "labels"])

    def run(batches):
        task, cell, held, many = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            held.append(batch)
            many += batch.num_rows
            while many >= CELL:
                whole = pa.Table.from_batches(held)
                yield fill(task, cell, whole.slice(0, CELL))
                held, many, cell = whole.slice(CELL).to_batches(), many - CELL, cell + 1
        if many:
            yield fill(task, cell, pa.Table.from_batches(held))

    order = F.xxhash64(F.col(key), "copy", "ids", "labels")
    dealt = rows.select(F.col(key).cast("string").alias("__key"), "copy", "ids", "labels", order.alias("__order")).repartition(tasks, "__order")
    dealt = dealt.sortWithinPartitions("__order", "__key", "copy").select("__key", "ids", "labels")
    return dealt.mapInArrow(run, "pack bigint, keys array<string>, lengths array<int>, ids array<int>, labels array<int>")
