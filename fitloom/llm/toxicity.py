"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

P(grade > k) = sigmoid(w.x - t_k): one weight vector for all thresholds t_0 < t_1 < ...; the expected
severity is the sum of these probabilities.  Features are hashed words and word starts, lower-cased,
ASCII punctuation taken as blanks; a feature's value is 1 + log count.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .frames import map_texts, removed, schema, slices, stored, texts, with_columns

#: Bytes of a word start.
START = 5
#: Labelled rows that training takes at most: those of least hash of the id.  Their features are counted on the
#: executors; only features with a weight reach the driver.
SAMPLE = 20_000
#: Features in fewer of these rows, or with a chi-squared statistic against toxicity below CHI times the
#: logarithm of the number of features tested, have no weight.
LEAST, CHI = 3, 2.5
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if 32 <= c < 48 or 58 <= c < 65 or 91 <= c < 97 or 123 <= c < 127 else c for c in range(256))


def features(raw: list[bytes], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts one after another: text number, feature, value, count; each feature once a text.
    With `known` (sorted), only those features, by their place in it."""
    w = tx.Words([t.translate(_FOLD) for t in raw])
    own, whole = w.owner(), w.hashes()
    w.end = np.minimum(w.end, w.start + START)
    f, row = np.concatenate((whole, tx.mix(w.hashes() + np.uint64(77)))), np.concatenate((own, own))
    if known is not None:
        at = np.searchsorted(known, f)
        hit = known[np.minimum(at, len(known) - 1)] == f if len(known) else np.zeros(len(f), bool)
        f, row = at[hit], row[hit]
    order = np.lexsort((f, row))
    f, row = f[order], row[order]
    head = np.flatnonzero(np.concatenate(([True], (f[1:] != f[:-1]) | (row[1:] != row[:-1])))[: len(f)])
    count = np.diff(np.concatenate((head, [len(f)])))
    return row[head], f[head], 1 + np.log(count), count


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Ordinal:
    """Features (sorted hashes) with their weights, and ascending thresholds."""

    names: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def telling(has: np.ndarray, pos: np.ndarray, rows: int, toxic: int, tested: int) -> np.ndarray:
    """Which features get a weight: has and pos are the rows, and the toxic rows, that each is in."""
    share = toxic / rows if rows else 0.0
    chi = (pos - has * share) ** 2 / np.maximum(1e-9, has * share * (1 - share) * (1 - has / (rows + 1)))
    return (has >= LEAST) & (chi >= CHI * np.log(max(2, tested)))


def marking(pos: np.ndarray, has: np.ndarray, rows: int, toxic: int) -> np.ndarray:
    """Which features are at least 20 times as frequent in toxic texts as in others."""
    return (pos >= LEAST) & (pos / max(1, toxic) > 20 * (has - pos + 0.5) / max(1, rows - toxic))


def fit(row: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, steps: int = 400, rate: float = 0.05, tested: int | None = None) -> Ordinal:
    """Maximum likelihood by Adam; thresholds are a first one and positive gaps.  tested is the number of
    features that there were, if only some are given."""
    n, k = len(grade), max(1, int(grade.max(initial=0)))
    names, feature = np.unique(feature, return_inverse=True)
    has, pos = np.bincount(feature, minlength=len(names)), np.bincount(feature[grade[row] > 0], minlength=len(names))
    good = telling(has, pos, n, int((grade > 0).sum()), tested or len(names))
    use = good[feature]
    row, feature, value = row[use], (np.cumsum(good) - 1)[feature[use]], value[use]
    names = names[good]
    p = np.zeros(len(names) + k)
    base = np.array([np.clip((grade > j).mean(), 1e-4, 1 - 1e-4) for j in range(k)])
    t = np.maximum.accumulate(np.log(1 / base - 1) + np.arange(k) * 1e-3)
    p[len(names) :] = [t[0], *np.log(np.maximum(np.diff(t), 1e-3))]
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, raw = p[: len(names)], p[len(names) :]
        gaps = np.exp(raw[1:])
        t = raw[0] + np.concatenate(([0.0], np.cumsum(gaps)))
        s = np.bincount(row, w[feature] * value, n)
        edge = np.concatenate(([-np.inf], t, [np.inf]))
        lo, hi = _sigmoid(s - edge[grade]), _sigmoid(s - edge[grade + 1])
        inv = 1 / np.maximum(lo - hi, 1e-9)
        a, b = lo * (1 - lo) * inv, hi * (1 - hi) * inv  # of log-likelihood by the lower and upper bound's argument
        ds = (b - a) / n
        dt = np.zeros(k)
        np.add.at(dt, np.maximum(grade - 1, 0), np.where(grade > 0, a, 0) / n)
        np.add.at(dt, np.minimum(grade, k - 1), np.where(grade < k, -b, 0) / n)
        tail = np.cumsum(dt[::-1])[::-1]
        g = np.concatenate((np.bincount(feature, ds[row] * value, len(names)) , [tail[0]], tail[1:] * gaps))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        by = rate / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        p -= by * m / (1 - 0.9**step)
    return Ordinal(names, p[: len(names)], p[len(names)] + np.concatenate(([0.0], np.cumsum(np.exp(p[len(names) + 1 :])))))


def severity(row: np.ndarray, feature: np.ndarray, value: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Grades 0, 1, 2 from 0/1 labels: toxic texts are cut at the median of their markers' summed values."""
    names, feature = np.unique(feature, return_inverse=True)
    has, pos = np.bincount(feature, minlength=len(names)), np.bincount(feature[toxic[row] == 1], minlength=len(names))
    marker = marking(pos, has, len(toxic), int(toxic.sum()))
    mass = np.bincount(row, value * marker[feature], len(toxic))
    middle = np.median(mass[toxic == 1]) if toxic.any() else 0
    return np.where(toxic == 0, 0, np.where(mass > middle, 2, 1))


#: Least hashes of a sketch, and how many of them make a band: rows that agree in a band are compared on full sets.
LOOKS, BAND = 32, 4
#: Labelled rows of this similarity of 3-word runs to an earlier one, or more, are left out of training.
ALIKE = 0.8


def runs(raw: list[bytes]) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct 3-word runs; of fewer words, of all of them as one."""
    w = tx.Words(raw, lower=True)
    h = w.hashes()
    return [np.unique(tx.windows(h[a:b], min(3, b - a))) if b > a else np.zeros(0, np.uint64) for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """For each set its least hash under each of LOOKS hash functions; zeros for an empty one."""
    out = np.zeros((len(sets), LOOKS), np.uint64)
    for i, g in enumerate(sets):
        if len(g):
            out[i] = [tx.mix(g + np.uint64(k + 1)).min() for k in range(LOOKS)]
    return out


def suspects(sketches: np.ndarray) -> list[tuple[int, int]]:
    """For each text that agrees in a band with an earlier one (text, the earlier one that agrees in most values).
    Of a band's texts the first and the last so far are looked at; a pair of similarity 0.8 shares a band of the
    eight with a probability of 0.985."""
    first, last, out = {}, {}, []
    for i, row in enumerate(sketches):
        bands = [(k, row[k : k + BAND].tobytes()) for k in range(0, LOOKS, BAND)]
        near = {j for b in bands for j in (first.get(b), last.get(b)) if j is not None}
        if near:
            out.append((i, max(sorted(near), key=lambda j: int((sketches[j] == row).sum()))))
        for b in bands:
            first.setdefault(b, i)
            last[b] = i
    return out


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of runs, sorted, have a Jaccard similarity of ALIKE or more; two empty ones do."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= ALIKE * (len(a) + len(b) - both)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "toxic") -> Ordinal:
    """Fits on at most `sample` labelled rows, whole texts.  Rows with a null id or label are left out, and so are
    rows that are near copies of one of smaller id (ALIKE, on full sets of runs); of labels that repeat an id the
    greatest counts.  Without any rows the model calls nothing toxic.

    The driver gets sketches and labels of these rows, and of their features those that tell or mark: at least
    LEAST rows have each of them."""
    given = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("__label"))
    given = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(given), "doc_id")  # given has `sample` rows at most

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                raw = texts(batch.column("text"))
                row, f, value, _ = features(raw)
                cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
                pack = [pa.array([x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()) for x in (f, value.astype(np.float32))]
                sets = runs(raw)
                marks, sets = (pa.array([x.tobytes() for x in y], pa.binary()) for y in (sketch(sets), sets))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("__label"), *pack, marks, sets], names=["doc_id", "label", "f", "v", "marks", "runs"])

    made = map_texts(rows.withColumn("doc_id", F.col("doc_id").cast("long")), run, schema(None, doc_id="long", label="int", f="binary", v="binary", marks="binary", runs="binary"))
    made, path = stored(made.withColumn("own", F.xxhash64("doc_id", "f")), "labelled")
    seen = made.select("doc_id", "own", "marks", "label").toArrow().sort_by([("doc_id", "ascending"), ("own", "ascending")])
    try:
        if not seen.num_rows:
            return Ordinal(np.zeros(0, np.uint64), np.zeros(0), np.array([10.0]))
        own = seen.column("own").to_numpy()
        maybe = suspects(np.frombuffer(b"".join(seen.column("marks").to_pylist()), np.uint64).reshape(-1, LOOKS))
        copies = _confirmed(made, sorted({(int(own[i]), int(own[j])) for i, j in maybe if own[i] != own[j]}))
        return _fitted(made, np.setdiff1d(own, np.array(copies, np.int64)))
    finally:
        removed(docs.sparkSession, path)


def _confirmed(made: DataFrame, pairs: list[tuple[int, int]]) -> list[int]:
    """Of pairs of rows, SAMPLE at most, the first rows of those that are alike."""

    def compare(batches):
        for whole in batches:
            for batch in slices(whole, "runs"):
                mine, other = ([np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in ("runs", "other"))
                yield pa.RecordBatch.from_arrays([batch.column("own").filter(pa.array([alike(a, b) for a, b in zip(mine, other, strict=True)], pa.bool_()))], names=["own"])

    table_ = made.sparkSession.createDataFrame(pairs, "own long, of long")
    sets = made.select("own", "runs").dropDuplicates(["own"])
    met = sets.join(F.broadcast(table_), "own").join(sets.select(F.col("own").alias("of"), F.col("runs").alias("other")), "of")
    return [r["own"] for r in map_texts(met.select("own", "runs", "other"), compare, schema(None, own="long")).collect()]


def _fitted(made: DataFrame, kept: np.ndarray) -> Ordinal:
    """The model of the rows of these numbers; rows alike count once."""
    spark = made.sparkSession
    chosen = spark.sparkContext.broadcast(kept)  # SAMPLE numbers at most

    def count(batches):
        for batch in batches:
            use = batch.filter(pa.array(np.isin(batch.column("own").to_numpy(), chosen.value)))
            f, label = (use.column(c).to_pylist() for c in ("f", "label"))
            every = np.frombuffer(b"".join(f), np.int64)
            toxic = np.repeat(np.array(label) > 0, [len(x) // 8 for x in f]) if f else np.zeros(0, bool)
            name, which = np.unique(every, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(np.bincount(which, minlength=len(name)).astype(np.int64)), pa.array(np.bincount(which[toxic], minlength=len(name)).astype(np.int64))], names=["f", "has", "pos"])

    each = made.dropDuplicates(["own"])
    labelled = each.select("own", "label").toArrow()
    toxic = labelled.column("label").to_numpy()[np.isin(labelled.column("own").to_numpy(), kept)] > 0
    n, ones = len(toxic), int(toxic.sum())
    counts = map_texts(each.select("own", "label", "f"), count, schema(None, f="long", has="long", pos="long")).groupBy("f").agg(F.sum("has").alias("has"), F.sum("pos").alias("pos"))
    counts, path = stored(counts, "counts")
    tested = counts.count()
    some = counts.where(F.col("has") >= LEAST).toArrow()
    has, pos = some.column("has").to_numpy(), some.column("pos").to_numpy()
    names = np.sort(some.column("f").to_numpy()[telling(has, pos, n, ones, tested) | marking(pos, has, n, ones)].view(np.uint64))
    known = spark.sparkContext.broadcast(names)

    def pick(batches):
        for batch in batches:
            use = batch.filter(pa.array(np.isin(batch.column("own").to_numpy(), chosen.value)))
            f, v = [], []
            for a, b in zip(use.column("f").to_pylist(), use.column("v").to_pylist(), strict=True):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.float32)
                hit = np.isin(a, known.value)
                f.append(a[hit].tobytes())
                v.append(b[hit].tobytes())
            yield pa.RecordBatch.from_arrays([use.column("own"), use.column("label"), pa.array(f, pa.binary()), pa.array(v, pa.binary())], names=["own", "label", "f", "v"])

    got = map_texts(each.select("own", "label", "f", "v"), pick, schema(None, own="long", label="int", f="binary", v="binary")).toArrow().sort_by("own")
    removed(spark, path)
    f, v = (np.frombuffer(b"".join(got.column(n).to_pylist()), t) for n, t in (("f", np.uint64), ("v", np.float32)))
    row = np.repeat(np.arange(got.num_rows), [len(x) // 8 for x in got.column("f").to_pylist()])
    y = (got.column("label").to_numpy() > 0).astype(int)
    return fit(row, f, v, severity(row, f, v, y), tested=tested)


def predict(docs: DataFrame, model: Ordinal, limit: float = 0.4) -> DataFrame:
    """docs with severity (expected grade), grade (the likeliest), p_toxic and kept (p_toxic < limit).

    Null and empty texts have no features.  Columns of docs with these names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.names, model.weights, model.thresholds))  # features of the bounded sample

    def run(batches):
        m = Ordinal(*sent.value)
        for whole in batches:
            for batch in slices(whole, "text"):
                row, f, value, _ = features(texts(batch.column("text")), m.names)
                s = np.bincount(row, m.weights[f] * value, batch.num_rows)
                above = m.above(s)
                each = np.concatenate((np.ones((len(s), 1)), above), 1) - np.concatenate((above, np.zeros((len(s), 1))), 1)
                yield with_columns(batch, severity=pa.array(above.sum(1)), grade=pa.array(each.argmax(1), pa.int64()), p_toxic=pa.array(above[:, 0]), kept=pa.array(above[:, 0] < limit))

    return map_texts(docs, run, schema(docs, severity="double", grade="long", p_toxic="double", kept="boolean"))
