"""Near-duplicate detection with min-max hashing (Ji et al. 2013).

Every permutation gives two signature values, the least and the greatest hash of a document's
shingle set, so a signature of 2k values costs k hash passes; agreement of either value is an
unbiased estimate of the Jaccard similarity.  Values are banded; documents that share a band are
candidates.  Candidates are confirmed on their full shingle sets.

Work stays in proportion to the input also for large groups of copies: documents of equal sets
collapse to one, and every band key gives a star of edges and not all pairs.  A small group that these
edges make is compared in one task.  A large one is dealt into blocks:

1. Every block is compared with a few leaders of its group, which joins the bulk of any group of copies.
2. Documents outside the bulk and those of their group whose rarest shingles they share make smaller
   groups: two sets that link have one of their (1 - similarity) rarest shingles in common, whatever the
   order of rarity, so no link is lost.  Documents that share boilerplate alone part here.
3. What is then still in one group but not in its bulk is compared with all of that group, block by block.

Tasks return spanning forests of their links.
"""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .frames import NO_ID, ids, lean_group, map_texts, removed, schema, slices, stored, table, texts
from .graph import components

ROWS = 6
#: Shingles and documents of a block.
BLOCK, BLOCK_ROWS = 40_000, 128
#: Leaders that the blocks of a large group are compared with, on average.
LEADERS = 16
#: Tasks, at most, that the rows of one group spread over in joins with one row a group.
SALTS = 16
#: Counters of shingles, by their hash, that order them by rarity; their number doesn't depend on the corpus.
COUNTERS = 1 << 18
#: Nodes from here on stand for classes without an id of their own; real ids are smaller.
_SURROGATE = 3 << 61
_LONG, _BIN = pa.int64(), pa.binary()


def bands_for(similarity: float, miss: float = 1e-8, rows: int = ROWS) -> int:
    """Bands of `rows` values that lose a pair of just this similarity with probability `miss`, about: the
    least and the greatest of one permutation are drawn without replacement, which adds a little for small sets."""
    return 2 * math.ceil(math.log(miss) / math.log(1 - similarity**rows) / 2)


def shingle_sets(raw: list[bytes], n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct n-word shingles of each text (A-Z lowered), as 64-bit hashes; fewer words make one shingle."""
    w = tx.Words(raw, lower=True)
    h = w.hashes()
    g = tx.windows(h, n)
    sets = []
    for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True):
        if b - a >= n:
            sets.append(np.unique(g[a : b - n + 1]))
        elif b > a:
            sets.append(tx.windows(np.concatenate((np.full(n - (b - a), b - a, np.uint64), h[a:b])), n))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets, w.counts


def signatures(sets: list[np.ndarray], bands: int, rows: int = ROWS) -> np.ndarray:
    """Band keys, one row for each (non-empty) set."""
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1])).astype(np.int64)
    every = np.concatenate(sets)
    k = -(-bands * rows // 2)
    factors = tx.mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    values = np.empty((len(sets), 2 * k), np.uint64)
    for p in range(k):
        v = every * factors[p]
        values[:, 2 * p] = np.minimum.reduceat(v, starts)
        values[:, 2 * p + 1] = np.maximum.reduceat(v, starts)
    keys = np.empty((len(sets), bands), np.uint64)
    for b in range(bands):
        keys[:, b] = tx.windows(np.concatenate([np.array([b], np.uint64)]), 1)[0]
        for r in range(rows):
            keys[:, b] = tx.mix(keys[:, b] * np.uint64(3) + values[:, b * rows + r])
    return keys


def linked(sets: list[np.ndarray], side: np.ndarray, percent: int, both: bool) -> list[tuple[int, int]]:
    """Spanning forest of the links between sets of different sides (of any, if `both` is False)."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    owner, every = np.repeat(np.arange(n), size), np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    owner_of, value = owner[order], every[order]
    cut = np.concatenate(([0], np.flatnonzero(value[1:] != value[:-1]) + 1, [len(value)]))
    group = np.empty(len(every), np.int64)
    group[order] = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
    first = np.concatenate(([0], np.cumsum(size)))
    label = np.arange(n)
    forest = []
    for u in range(n):
        if both and side[u]:
            continue
        mine = group[first[u] : first[u + 1]]
        lens = cut[mine + 1] - cut[mine]
        at = np.repeat(cut[mine] - np.concatenate(([0], np.cumsum(lens)[:-1])), lens) + np.arange(lens.sum())
        shared = np.bincount(owner_of[at], minlength=n)
        hit = (100 * shared >= percent * (size[u] + size - shared)) & (label != label[u])
        hit &= side == 1 if both else np.arange(n) > u
        hits = np.flatnonzero(hit)
        for other, k in zip(*np.unique(label[hits], return_index=True), strict=True):
            forest.append((u, int(hits[k])))
            label[label == other] = label[u]
    return forest


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of docs.

    A null or empty text, or one without words, has no shingles and no links.  A null doc_id counts as
    larger than any other: such rows get the least id that their text reaches, or null; of a group of null
    ids alone, the rows of one set are kept.  Rows that repeat a doc_id share a component if their texts
    link; each carries its own n_shingles.  Ids are below 3 * 2**61.  Other columns of docs don't matter.
    """
    return _flags(docs, n, percent).drop("__hash", "__stands")


def _sketches(docs: DataFrame, n: int, bands: int) -> DataFrame:
    """(doc_id, __hash, n_shingles, key, bands): the key stands for the set; null without shingles."""

    def sketch(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                sets, _ = shingle_sets(texts(batch.column("text")), n)
                full = [i for i, s in enumerate(sets) if len(s)]
                keys = signatures([sets[i] for i in full], bands) if full else []
                key, band = [None] * len(sets), [None] * len(sets)
                for i, row in zip(full, keys, strict=True):
                    key[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    band[i] = row.astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("__hash"), pa.array([len(s) for s in sets], _LONG), pa.array(key, _BIN), pa.array(band, pa.list_(_LONG))], names=["doc_id", "__hash", "n_shingles", "key", "bands"])

    return map_texts(docs, sketch, schema(None, doc_id="long", __hash="long", n_shingles="long", key="binary", bands="array<long>"))


def _classes(made: DataFrame) -> DataFrame:
    """One row for each set: key, node, least id (NO_ID if there is none) and text hash of the document that stands for it, bands, size.

    The node is the least id; classes without one, and all but one of those that share one, as rows can repeat an id, get a hash."""
    least = F.min(F.struct(F.coalesce("doc_id", F.lit(int(NO_ID))).alias("least"), F.col("__hash")))
    each = made.where("key is not null").groupBy("key").agg(least.alias("s"), F.first("bands").alias("bands"), F.max("n_shingles").alias("size"))
    each = each.select("key", F.xxhash64("key").alias("__k"), "s.least", F.col("s.__hash").alias("text_hash"), "bands", "size")
    several = each.groupBy("least").agg(F.min("__k").alias("__own"), F.count("*").alias("__many")).where("__many > 1").select("least", "__own")
    each = each.join(several, "least", "left")
    hashed = F.lit(_SURROGATE) + F.pmod("__k", F.lit(1 << 60))
    node = F.when((F.col("least") == int(NO_ID)) | (F.col("__own").isNotNull() & (F.col("__own") != F.col("__k"))), hashed).otherwise(F.col("least"))
    return each.select("key", node.alias("node"), "least", "text_hash", "bands", "size")


def _stars(rows: DataFrame, by: str, node: str) -> DataFrame:
    """Edges (u, v) from each row to the least node of its group; groups of one make none."""
    star = rows.groupBy(by).agg(F.min(node).alias("v"), F.count("*").alias("__many")).where("__many > 1").drop("__many")
    return rows.join(star, by).where(F.col(node) != F.col("v")).select(F.col(node).alias("u"), "v").distinct()


def _compare(dealt: DataFrame, by: list[str], n: int, percent: int, both: bool) -> DataFrame:
    """Links (u, v) within groups; with `both` those between documents of side 0 and side 1."""

    def confirm(group):
        sets, _ = shingle_sets(texts(group.column("text")), n)
        side, who = np.array(group.column("side").to_pylist()), ids(group.column("node"))
        return table({"u": _LONG, "v": _LONG}, [(int(who[x]), int(who[y])) for x, y in linked(sets, side, percent, both)])

    return dealt.select(*by, "node", "side", "text").groupBy(*by).applyInArrow(lean_group(confirm, False), schema(None, u="long", v="long"))


def _each(count: Column) -> Column:
    """0 .. count - 1, a row each."""
    return F.explode(F.sequence(F.lit(0), count.cast("int") - 1))


def _block(node: str, blocks: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64(node, F.lit(salt)), blocks).cast("int")


def _blocks(size: Column, rows: Column) -> Column:
    return F.greatest(F.ceil(size / BLOCK), F.ceil(rows / BLOCK_ROWS)).cast("int")


def _rarest(members: DataFrame, n: int, percent: int) -> DataFrame:
    """(node, token): the rarest shingles of each member of a group; two sets of a group that link share a token.

    Of s shingles those are s - ceil(percent / 100 * s) + 1.  Rarity is by counters of hashed shingles
    over all members, ties by hash: one order for all, which is all that the rule needs."""
    spark = members.sparkSession

    def count(batches):
        for batch in batches:
            found = [s for s in shingle_sets(texts(batch.column("text")), n)[0] if len(s)]
            slot, many = np.unique(np.concatenate(found) % np.uint64(COUNTERS), return_counts=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(np.array(slot, np.int64)), pa.array(np.array(many, np.int64))], names=["slot", "many"])

    got = map_texts(members.select("text"), count, schema(None, slot="long", many="long")).groupBy("slot").agg(F.sum("many").alias("many")).toArrow()
    counts = np.zeros(COUNTERS, np.int64)
    counts[got.column("slot").to_numpy()] = got.column("many").to_numpy()
    sent = spark.sparkContext.broadcast(counts)  # COUNTERS numbers

    def rare(batches):
        many = sent.value
        for whole in batches:
            for batch in slices(whole, "text"):
                node, token = [], []
                group = tx.mix(ids(batch.column("v")).astype(np.uint64))
                for who, v, s in zip(ids(batch.column("node")).tolist(), group, shingle_sets(texts(batch.column("text")), n)[0], strict=True):
                    few = len(s) - math.ceil(Fraction(percent * len(s), 100)) + 1
                    first = s[np.lexsort((s, many[(s % np.uint64(COUNTERS)).astype(np.int64)]))[:few]]
                    token.append(tx.mix(first + v).view(np.int64))
                    node.append(np.full(len(first), who))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(node)), pa.array(np.concatenate(token))], names=["node", "token"])

    return map_texts(members.select("v", "node", "text"), rare, schema(None, node="long", token="long"))


def _by_group(rows: DataFrame, groups: DataFrame, by: str) -> DataFrame:
    """Inner join of rows with node to one row a group, which is copied SALTS times, so that the rows of one group
    spread over as many tasks.  Groups of one component are left out before, so copies are few."""
    salted = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("__salt", _block("node", F.lit(SALTS), 5)).join(salted, [by, "__salt"]).drop("__salt")


def _remainder(big: DataFrame, found: DataFrame, n: int, percent: int) -> DataFrame | None:
    """Links that the leaders of large groups missed, or None if there is nothing left to compare.

    big has v, node, size, text; found has the components so far."""
    labelled = big.select("v", "node", "size").join(found.select(F.col("u").alias("node"), F.col("v").alias("c")), "node", "left").withColumn("c", F.coalesce("c", "node"))
    open_ = _split(labelled, "v")
    if open_.isEmpty():
        return None
    open_, path = stored(open_.select("v").distinct(), "open")
    members = _by_group(big, open_, "v")
    closer = components(_stars(_rarest(members, n, percent), "token", "node"))
    near = _by_group(labelled, open_, "v").join(closer.select(F.col("u").alias("node"), F.col("v").alias("w")), "node", "left")
    near = near.select("node", "size", "c", F.coalesce("w", "node").alias("w"))
    near, _ = stored(near, "near")
    rest, _ = stored(_split(near, "w"), "rest")
    removed(big.sparkSession, path)
    if rest.isEmpty():
        return None
    least = rest.groupBy("w").agg(_blocks(F.sum("size"), F.count("*")).alias("few"))
    every = near.groupBy("w").agg(_blocks(F.sum("size"), F.count("*")).alias("many")).join(least, "w")
    text = big.select("node", "text")
    one = _by_group(rest.select("w", "node"), every, "w").join(text, "node").select("w", "node", "text", _block("node", F.col("few"), 1).alias("i"), _each(F.col("many")).alias("j"), F.lit(0).alias("side"))
    two = _by_group(near.select("w", "node"), every, "w").join(text, "node").select("w", "node", "text", _each(F.col("few")).alias("i"), _block("node", F.col("many"), 2).alias("j"), F.lit(1).alias("side"))
    return _compare(one.unionByName(two), ["w", "i", "j"], n, percent, True)


def _split(rows: DataFrame, by: str) -> DataFrame:
    """Rows outside the largest component c of their group; groups with one component are left out first."""
    top = rows.groupBy(by, "c").agg(F.count("*").alias("__n")).groupBy(by).agg(F.max(F.struct("__n", "c")).alias("__top"), F.count("*").alias("__parts"))
    top = top.where("__parts > 1").drop("__parts")
    return _by_group(rows, top, by).where("c <> __top.c").drop("__top")


def _links(keyed: DataFrame, n: int, percent: int) -> DataFrame:
    """Components (u, v) of the links between documents that share a group v."""
    small = keyed.where("blocks = 1").withColumn("side", F.lit(0))
    links = _compare(small, ["v"], n, percent, False)
    big = keyed.where("blocks > 1")
    if big.isEmpty():
        return components(links)
    block = _block("node", F.col("blocks"), 1)
    lead = (F.pmod(F.xxhash64("node", F.lit(7)), F.col("rows")) < LEADERS) & (F.col("size") * F.col("rows") <= 4 * F.col("total"))
    every = big.select("v", "node", "text", block.alias("i"), F.lit(0).alias("side"))
    leaders = big.where(lead).select("v", "node", "text", _each(F.col("blocks")).alias("i"), F.lit(1).alias("side"))
    links = links.union(_compare(every.unionByName(leaders), ["v", "i"], n, percent, True))
    found = components(links)
    more = _remainder(big, found, n, percent)
    return found if more is None else components(found.union(more))


def _flags(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """near_duplicates() with a hash of each row's text and whether the row stands for its component."""
    spark, own = docs.sparkSession, F.coalesce("doc_id", F.lit(int(NO_ID)))
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text"), F.xxhash64("text").alias("__hash"))
    made, _ = stored(_sketches(docs, n, bands_for(percent / 100)), "minmax")
    classes, _ = stored(_classes(made), "classes")  # one document stands for all of equal sets
    cluster = components(_stars(classes.select("node", F.explode("bands").alias("band")), "band", "node"))
    cluster = cluster.union(cluster.select(F.col("v").alias("u"), "v").distinct()).withColumnRenamed("u", "node")
    member = cluster.join(classes.select("node", "least", "text_hash", "size"), "node")
    totals = member.groupBy("v").agg(F.sum("size").alias("total"), F.count("*").alias("rows"))
    member = member.join(totals, "v").withColumn("blocks", _blocks(F.col("total"), F.col("rows"))).withColumnsRenamed({"least": "__own", "text_hash": "__hash"})
    keyed = docs.select(own.alias("__own"), "__hash", "text").join(member, ["__own", "__hash"]).dropDuplicates(["__own", "__hash"])
    keyed, path = stored(keyed.select("v", "node", "size", "total", "rows", "blocks", "text"), "members")
    found = _links(keyed, n, percent)
    removed(spark, path)
    label = F.coalesce("v", "node")
    classes = classes.select("key", "node", "least", "text_hash").join(found.withColumnRenamed("u", "node"), "node", "left").withColumn("label", label).drop("v")
    # a label is the least id of its component but for classes whose id another class has as well
    hidden, _ = stored(classes.where((F.col("node") >= _SURROGATE) & (F.col("least") < int(NO_ID))).groupBy("label").agg(F.min(F.struct("least", "node")).alias("hidden")), "hidden")
    component, stands = F.when(F.col("label") < _SURROGATE, F.col("label")), F.col("node") == F.col("label")
    if not hidden.isEmpty():
        classes = classes.join(hidden, "label", "left")
        behind = F.coalesce(F.col("hidden.least") < F.col("label"), F.lit(False))
        component = F.when(behind, F.col("hidden.least")).otherwise(component)
        stands = F.col("node") == F.when(behind, F.col("hidden.node")).otherwise(F.col("label"))
    classes = classes.select("key", component.alias("component"), stands.alias("stands"), "least", "text_hash")
    out = made.select("doc_id", "__hash", "n_shingles", "key").join(classes, "key", "left").withColumn("component", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component")))
    first = F.col("stands") & (own == F.col("least")) & (F.col("__hash") == F.col("text_hash"))
    kept = F.when(F.col("component").isNull(), F.coalesce("stands", F.lit(True))).otherwise(F.coalesce(F.col("doc_id") == F.col("component"), F.lit(False)))
    return out.select("doc_id", "__hash", "n_shingles", F.col("component").alias("component_id"), kept.alias("kept"), F.coalesce(first, F.lit(True)).alias("__stands"))


def keep_first(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of docs for each group of near_duplicates(), that of the least doc_id, nulls last; of rows
    alike in doc_id and text one.  Rows without words stay.  Columns of any name pass through."""
    flags = _flags(docs, n, percent).where("__stands").select(F.coalesce("doc_id", F.lit(int(NO_ID))).alias("__own"), F.col("__hash").alias("__text")).distinct()
    rows = docs.withColumns({"__own": F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))), "__text": F.xxhash64("text")})
    return rows.join(flags, ["__own", "__text"], "left_semi").dropDuplicates(["__own", "__text"]).drop("__own", "__text")
