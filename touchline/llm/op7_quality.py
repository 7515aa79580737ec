"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

Each whole text becomes a vector of statistics (lengths, kinds of characters, repetition, stop words).
Random Fourier features approximate a Gaussian kernel on the standardised vectors. The normal equations
of the ridge fit are summed within partitions and added up, so all labelled rows count and at most
``SUMS_AT_ONCE`` matrices reach the driver. Rows are dealt and sorted by doc_id before, so sums are added in
the same order whenever the fit is run. Raw scores of a calibration fold are counted in ``BINS`` bins and
made monotone by pooling adjacent violators.

Labels are read only from rows whose crc32(doc_id as text) mod 4 is not 2; of these, remainder 3 is the
calibration fold and the rest fits the scores. Nothing but the text enters a score. Null text: as empty.
A document with several labels counts with their mean; null labels and null doc_ids are no labels.
Without labelled rows every score is 0.5. Repeated rows are scored each; no rows give no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import shipped, slices, text_bytes

FEATURES = 256
BANDWIDTH = 3.0
RIDGE = 1e-3
BINS = 512
#: Labelled rows of a partition of the fit, and partition sums that reach the driver at once.
FIT_ROWS, SUMS_AT_ONCE = 100_000, 16
THRESHOLD = 0.7
SEED = 17

#: Frequent function words of the four languages.
STOP_WORDS = frozenset((
    "the be to of and that have with is are was it in for on this by as at from "
    "le la les de des du et un une est que qui en dans pour sur par au pas avec "
    "der die das und den von zu mit ist im auf für nicht ein eine sich dem des "
    "el los las y una es por con para se no al lo su como más del").encode().split())
SYMBOLS = np.frombuffer(b"#*$%&|<>@^_~{}[]\\=+/", np.uint8)
MARKS = np.frombuffer(b".,;:!?\"'()-", np.uint8)


def statistics(text: bytes) -> list[float]:
    """Statistics of one text; ratios of an empty text are 0."""
    n = len(text)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    k = len(words)
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    sizes = np.fromiter(map(len, words), np.int64, k)
    per_byte, per_word = max(n, 1), max(k, 1)
    pairs = len(set(zip(words, words[1:]))) / max(k - 1, 1) if k > 1 else 0.0
    share = count[count > 0] / per_byte
    return [
        np.log1p(k), np.log1p(n), k > 0,
        sizes.mean() if k else 0.0, sizes.std() if k else 0.0, np.log1p(sizes.max()) if k else 0.0,
        upper / max(upper + lower, 1), count[48:58].sum() / per_byte,
        count[SYMBOLS].sum() / per_word, count[MARKS].sum() / per_word, count[33] / per_word,
        count[46] / per_word, count[44] / per_word, count[124] / per_word,
        count[128:].sum() / per_byte, count[:32].sum() / per_byte,
        len(set(words)) / per_word, pairs, sum(a == b for a, b in zip(words, words[1:])) / per_word,
        sum(map(STOP_WORDS.__contains__, words)) / per_word,
        np.log1p(len(lines)), np.log1p(k / max(len(lines), 1)), 1 - len(set(lines)) / max(len(lines), 1),
        float(-(share * np.log2(share)).sum()) if n else 0.0,
    ]


def with_statistics(docs: DataFrame, text_col: str = "text", out: str = "_stats") -> DataFrame:
    """``docs`` with the vector of statistics of each text (a column of that name is replaced)."""
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])
    text_at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, 4 << 20):
            found = [statistics(t or b"") for t in text_bytes(batch.column(text_at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.float64()))],
                                             names=[*batch.schema.names, out])

    return shipped(docs).mapInArrow(run, schema)


def remainder(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray      # raw scores, ascending
    values: np.ndarray     # calibrated scores at the knots

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.sqrt(2 / len(self.phase)) * np.cos(x @ self.waves + self.phase)
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.values)


def _vectors(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy().reshape(len(column), -1)


def _sums(rows: DataFrame, add) -> np.ndarray:
    """Sum over all rows of ``add(stats, labels)``, an array of fixed size: partition sums in their order, added
    in groups first where there are many. Empty if there are no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = add(_vectors(batch, "_stats"), batch.column("label").to_numpy())
                total = part if total is None else total + part
        if total is not None:
            yield _sum_row(TaskContext.get().partitionId(), total)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, now = None, None
        for batch in batches:
            for group, own in zip(batch.column("part").to_pylist(), batch.column("sum").to_pylist()):
                if group != now:
                    if total is not None:
                        yield _sum_row(now, total)
                    total, now = None, group
                own = np.frombuffer(own)
                total = own if total is None else total + own
        if total is not None:
            yield _sum_row(now, total)

    sums = shipped(rows).mapInArrow(run, "part long, sum binary")
    if rows.rdd.getNumPartitions() > SUMS_AT_ONCE:      # never more rows to the driver than this
        sums = (sums.withColumn("group", F.col("part") % SUMS_AT_ONCE).repartition(SUMS_AT_ONCE, "group")
                .sortWithinPartitions("group", "part").select(F.col("group").alias("part"), "sum"))
        sums = shipped(sums).mapInArrow(together, "part long, sum binary")
    total = np.zeros(0)
    for r in sorted(sums.collect(), key=lambda r: r["part"]):
        own = np.frombuffer(bytes(r["sum"]))
        total = total + own if len(total) else own
    return total


def _sum_row(part: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                                      names=["part", "sum"])


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: centres and values of the blocks of the best non-decreasing fit."""
    blocks: list[list[float]] = []
    for a, b, w in zip(x, y, weight):
        blocks.append([a * w, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    found = np.array(blocks)
    return found[:, 0] / found[:, 2], found[:, 1] / found[:, 2]


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> Model:
    """Fit on documents with statistics (columns ``id_col`` and _stats) and labels (0 or 1)."""
    known = (labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id"))
             .agg(F.avg(label_col).alias("label")))
    rows = (stats.select(F.col(id_col).alias("_id"), "_stats").join(known, "_id")
            .withColumn("fold", remainder("_id")).filter("fold <> 2").select("fold", "_stats", "label"))
    n = known.count()      # at least the labelled rows, but for rows that repeat a doc_id
    rows = rows.repartition(max(8, -(-n // FIT_ROWS)), "_id").sortWithinPartitions("_id", "_stats").persist()
    try:
        return _fit(rows)
    finally:
        rows.unpersist()


def _fit(rows: DataFrame) -> Model:
    train, hold = rows.filter("fold <> 3"), rows.filter("fold = 3")
    moments = _sums(train, lambda x, y: np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)]))
    size = len(statistics(b""))
    if not len(moments):
        zero = np.zeros(size)
        return Model(zero, zero + 1, np.zeros((size, 1)), np.zeros(1), np.zeros(2), np.array([0.0]), np.array([0.5]))
    n, mean = moments[0], moments[2:2 + size] / moments[0]
    scale = np.sqrt(np.maximum(moments[2 + size:] / n - mean ** 2, 0)) + 1e-6
    random = np.random.default_rng(SEED)
    model = Model(mean, scale, random.normal(0, 1 / BANDWIDTH, (size, FEATURES)),
                  random.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5]))
    wide = FEATURES + 1

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.features(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = _sums(train, equations)
    gram = sums[:wide * wide].reshape(wide, wide) / n
    model.weights = np.linalg.solve(gram + RIDGE * np.eye(wide), sums[wide * wide:] / n)

    def bins(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.clip(((model.raw(x) + 0.5) * BINS / 2).astype(int), 0, BINS - 1)    # raw scores -0.5 to 1.5
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, BINS)])

    counted = _sums(hold, bins)
    if not len(counted):
        counted = _sums(train, bins)
    seen, good = counted[:BINS], counted[BINS:]
    at = np.flatnonzero(seen)
    model.knots, model.values = isotonic((at + 0.5) * 2 / BINS - 0.5, good[at] / seen[at], seen[at])
    return model


def with_score(stats: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``stats`` with a calibrated score instead of the statistics."""
    held = stats.sparkSession.sparkContext.broadcast(model)      # a few hundred numbers a statistic
    schema = T.StructType([f for f in stats.schema.fields if f.name != "_stats"] + [T.StructField(out, T.DoubleType())])
    at = stats.columns.index("_stats")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = np.clip(held.value.score(_vectors(batch, "_stats")), 0, 1)
                keep = [i for i in range(batch.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(score)],
                                                 names=[*(batch.schema.names[i] for i in keep), out])

    return shipped(stats).mapInArrow(run, schema)


def held_out(doc_id) -> bool:
    """The fold that no label is read from, for one doc_id."""
    return zlib.crc32(str(doc_id).encode()) % 4 == 2
