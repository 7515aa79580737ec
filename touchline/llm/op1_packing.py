"""Best-two-fit packing of tokenised documents into fixed-length sequences.

Documents become token ids plus a separator, pieces of at most ``capacity`` ids, and the pieces are
placed into sequences. The placement works on the histogram of piece lengths (at most ``capacity``
rows, whatever the corpus holds): a sequence is filled greedily with the longest piece that still
fits, then its shortest piece is exchanged for two unpacked ones whenever those fill the widened gap
more tightly. The resulting pattern of lengths is applied as often as the counts allow, so the plan is
a short list of (pattern, times). Pieces get their place by their rank among the pieces of their
length; ranks are counted in salted groups, as many as a length's pieces need, so one frequent length does not
meet in one task.

Null or empty text: the separator alone. Equal lengths (ties) rank by (salt, doc_id, piece), rows that
repeat a doc_id are packed each. No rows give no rows. Columns other than the two named are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import id_text, shipped, slices
from touchline.llm.wordbpe import word_encoder
from touchline.session import checkpointed

CAPACITY = 2048
SEPARATOR = 0
#: Pieces of one length that are ranked by one task.
RANKED_ROWS = 50_000


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids themselves."""
    rows = id_text(docs)
    out = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64())] + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(tokenizer_path)
        for batch in slices(batches, "text", 8 << 20):
            ids, counts = encode(batch.column(1))
            ids = np.insert(ids.astype("<u4"), np.cumsum(counts), SEPARATOR)
            found, at = [], 0
            for doc, n in zip(batch.column(0).to_pylist(), (counts + 1).tolist()):
                for piece, start in enumerate(range(0, n, capacity)):
                    own = ids[at + start:at + min(n, start + capacity)]
                    row = (doc, piece, start, len(own), zlib.crc32(own))
                    found.append(row + (own.view("<i4"),) if with_ids else row)
                at += n
            columns = list(zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return shipped(rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(cut, ddl)


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns of lengths, longest first, with the number of sequences that follow each.

    ``counts`` maps a length to its number of pieces. Every round fixes one pattern and uses it until a
    length in it runs short, so the rounds depend on the number of lengths, not on the pieces.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left)
    plan = []
    while lengths:
        used: dict[int, int] = {}

        def spare(n: int, used=used) -> int:
            return left[n] - used.get(n, 0)

        def longest(limit: int) -> int | None:
            for k in range(bisect_right(lengths, limit) - 1, -1, -1):
                if spare(lengths[k]) > 0:
                    return lengths[k]
            return None

        def take(n: int, used=used) -> None:
            used[n] = used.get(n, 0) + 1

        gap = capacity
        while (n := longest(gap)) is not None:
            take(n)
            gap -= n
        if gap and used:
            small = min(used)
            used[small] -= 1
            pair = _best_pair(lengths, spare, gap + small)
            if pair and sum(pair) > small:
                for n in pair:
                    take(n)
            else:
                used[small] += 1
        used = {n: c for n, c in used.items() if c}
        times = min(left[n] // c for n, c in used.items())
        plan.append(([n for n in sorted(used, reverse=True) for _ in range(used[n])], times))
        for n, c in used.items():
            left[n] -= c * times
        lengths = [n for n in lengths if left[n]]
    return plan


def _best_pair(lengths: list[int], spare, limit: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum up to ``limit``, by two pointers."""
    best, low, high = None, 0, bisect_right(lengths, limit) - 1
    while low <= high:
        a, b = lengths[low], lengths[high]
        if a + b > limit or spare(b) < 1:
            high -= 1
        elif spare(a) < 1 or a == b and spare(a) < 2:
            low += 1
        else:
            if best is None or a + b > sum(best):
                best = (a, b)
            low += 1
    return best


def _slots(plan: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first sequence, pieces of this length in a sequence, offset of the first)."""
    found: dict[int, list] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan:
        offset = 0
        for n in dict.fromkeys(pattern):
            each = pattern.count(n)
            found.setdefault(n, []).append((ranks.get(n, 0), sequence, each, offset))
            ranks[n] = ranks.get(n, 0) + each * times
            offset += each * n
        sequence += times
    return {n: np.array(rows, np.int64) for n, rows in found.items()}


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with sequence_id and offset; no sequence is longer than ``capacity``."""
    pieces = checkpointed(token_pieces(docs, tokenizer_path, capacity), "op1-pieces")
    return place(pieces, capacity)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Place rows with a ``length`` of at most ``capacity`` into sequences; ``doc_id`` and ``piece`` order ties."""
    spark = pieces.sparkSession
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    salts = spark.createDataFrame([(n, -(-c // RANKED_ROWS)) for n, c in counts.items()], "_length long, _salts long")
    salted = (pieces.join(F.broadcast(salts), F.col("length") == F.col("_length"))      # a row a length
              .withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "start"), "_salts")).drop("_length", "_salts"))
    groups = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    slots = spark.sparkContext.broadcast(_slots(best_two_fit(counts, capacity)))   # at most a few rows a length
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    first = groups.select(F.col("length").alias("_l"), F.col("_salt").alias("_s"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start")
    ranked = salted.withColumn("_rank", F.row_number().over(own) - 1)
    ranked = (ranked.join(first, (F.col("length") == F.col("_l")) & (F.col("_salt") == F.col("_s")))
              .withColumn("_rank", F.col("_rank") + F.col("_first")).drop("_l", "_s", "_first", "_salt"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        for batch in batches:
            rank = batch.column("_rank").to_numpy()
            length = batch.column("length").to_numpy()
            sequence, offset = np.empty_like(length), np.empty_like(length)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                rows = table[int(n)]
                row = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                past = rank[at] - row[:, 0]
                sequence[at] = row[:, 1] + past // row[:, 2]
                offset[at] = row[:, 3] + past % row[:, 2] * n
            keep = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "_rank"]
            names = [name for name in batch.schema.names if name != "_rank"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)],
                                             names=[*names, "sequence_id", "offset"])

    from pyspark.sql import types as T
    schema = T.StructType([f for f in pieces.schema.fields]
                          + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return shipped(ranked).mapInArrow(assign, schema)
