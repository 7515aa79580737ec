"""Document fingerprints from closed syncmers of words, with built-in functions.

A k-mer of ``K`` words is an anchor if the least of its inner ``S``-mers (by hash) is its first or last
one. That depends on the k-mer alone, so equal passages have equal anchors wherever they stand, and an
edit moves only the anchors that touch it. A fingerprint holds all anchors of a text in order, each with the
distance to the one before it, so positions can be matched: ``likeness`` is the share of anchors that two
texts have in common, ``same_places`` counts those that stand at the same place. No anchor is dropped,
however long the text.

Null, empty or blank text: empty fingerprint; two empty ones are alike (1), an empty and another one
are not (0). A text of fewer than K words, or without any closed syncmer, is one anchor: all its words. A null
doc_id comes first in the order of documents; equal doc_ids are ordered by text. The document after the
last one is the first, a lone document is its own neighbour. No rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.common import id_text, words

K, S = 5, 2
#: Bytes of text in a range of doc_ids, which one task puts in order.
RANGE_BYTES = 32 << 20
#: Heads of ranges that are broadcast (16 bytes each); with more, the join is left to Spark.
BROADCAST_HEADS = 100_000
_NONE = "array<struct<hash:bigint,position:int>>"


def _smers(w: Column) -> Column:
    """Hash of the S words from each place on; the last S - 1 places have fewer words and are never used."""
    return F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, S)]))


def _anchor(h: Column, last: Column, i: Column) -> Column:
    """The hash of the k-mer at place i if it is a closed syncmer, else null."""
    inner = [F.get(h, i + k) for k in range(K - S + 1)]
    return F.when((i <= last) & (F.least(inner[0], inner[-1]) <= F.least(*inner[1:-1])), F.xxhash64(*inner))


def with_anchors(frame: DataFrame, text_col: str, out: str, whole: bool = True) -> DataFrame:
    """``frame`` with the anchors of a text: array of (hash, position in words), in text order.

    ``whole``: a text with words but without a closed syncmer has one anchor, the hash of all its words.
    """
    w, h = f"_{out}_w", f"_{out}_h"
    cut = frame.withColumn(w, words(text_col))
    cut = cut.withColumn(h, _smers(F.col(w)))
    last = F.size(w) - K
    every = F.transform(h, lambda x, i: F.struct(_anchor(F.col(h), last, i).alias("hash"), i.alias("position")))
    found = F.filter(every, lambda a: a["hash"].isNotNull())
    cut = cut.withColumn(out, F.when(F.size(w) >= K, found).otherwise(F.array().cast(_NONE)))
    if whole:
        all_words = F.array(F.struct(F.xxhash64(F.array_join(w, " ")).alias("hash"), F.lit(0).alias("position")))
        cut = cut.withColumn(out, F.when((F.size(out) == 0) & (F.size(w) > 0), all_words).otherwise(F.col(out)))
    return cut.drop(w, h)


def syncmers(docs: DataFrame) -> DataFrame:
    """doc_id, ``anchors``: array of (hash, position in words) of every closed syncmer, in text order."""
    return with_anchors(id_text(docs), "text", "anchors", whole=False).drop("text")


def with_hashes(frame: DataFrame, anchors: str, out: str) -> DataFrame:
    """``frame`` with the distinct unsigned 32-bit hashes of its anchors."""
    return frame.withColumn(out, F.array_distinct(F.transform(anchors, lambda a: a["hash"].bitwiseAND(0xFFFFFFFF))))


def likeness(a: Column | str, b: Column | str) -> Column:
    """Share of common anchors (Dice: twice the common ones over the sum of both counts) of two arrays of
    distinct hashes."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(2 * F.size(F.array_intersect(a, b)) / total)


def _placed(anchors: Column | str) -> Column:
    """Hash and position as one number each."""
    return F.transform(anchors, lambda a: F.xxhash64(a["hash"], a["position"]))


def same_places(a: Column | str, b: Column | str) -> Column:
    """Number of anchors that two texts have at the same position."""
    return F.size(F.array_intersect(_placed(a), _placed(b)))


def with_text(frame: DataFrame, anchors: str, out: str) -> DataFrame:
    """Fingerprint as text: for each anchor the words since the one before it (one hexadecimal digit, for closed
    syncmers of this size are at most K - S apart; f stands for more), and eight digits of its hash."""
    def digits(x: Column, before: Column) -> Column:
        step = F.least(x["position"] - F.coalesce(before["position"], F.lit(0)), F.lit(15))
        return F.concat(F.hex(step), F.lpad(F.hex(x["hash"].bitwiseAND(0xFFFFFFFF)), 8, "0"))

    joined = F.array_join(F.transform(anchors, lambda x, i: digits(x, F.get(F.col(anchors), i - 1))), "")
    return frame.withColumn(out, F.lower(joined))


def _range_of(key: Column, bounds: list[int]) -> Column:
    """Number of bounds below the key: the coarse ones first, then those behind the last coarse one."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))

    def held(values: list, kind: str) -> Column:
        return F.from_json(F.lit(json.dumps(values)), kind)      # one constant, however many bounds

    coarse = held(bounds[step - 1::step], "array<bigint>")
    fine = held([bounds[a:a + step] for a in range(0, len(bounds), step)], "array<array<bigint>>")
    block = F.size(F.filter(coarse, lambda b: b < key))
    inside = F.size(F.filter(F.coalesce(F.get(fine, block), F.array().cast("array<bigint>")), lambda b: b < key))
    return block * step + inside


def _task_keys(spark: SparkSession, n: int) -> list[int]:
    """For each of n partitions, a number that is dealt to it by its hash: a range each goes to a task of its own."""
    ids = spark.range(n * (20 + n.bit_length()))
    rows = ids.groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("part")).agg(F.min("id").alias("id")).collect()
    found = {r["part"]: r["id"] for r in rows}
    return [found.get(part, part) for part in range(n)]


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, text and anchors, and those of the next document in ascending doc_id.

    Documents are dealt by ranges of doc_id (approximate quantiles), as many as the bytes of all texts need;
    the first document of each range is copied to the end of the range before it, so a document always
    meets its neighbour in its own task. Rows with the same doc_id (all null ones too) are in one range.
    """
    spark = docs.sparkSession
    rows = id_text(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_key"), "doc_id",
                                F.coalesce(F.col("text"), F.lit("")).alias("text"))
    if ranges is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    quantiles = [i / ranges for i in range(1, ranges)]
    bounds = rows.agg(F.percentile_approx("_key", quantiles, 100 * ranges).alias("q")).first()["q"] if quantiles else []
    bounds = sorted(set(bounds or []))
    rows = rows.withColumn("_range", _range_of(F.col("_key"), bounds))
    heads = rows.groupBy("_range").agg(F.min("_key").alias("_key")).orderBy("_range").collect()
    # head's key -> range before; the first range comes after the last
    order = [(r["_key"], heads[i - 1]["_range"]) for i, r in enumerate(heads)]
    before = spark.createDataFrame(order, "_key long, _before int")
    before = F.broadcast(before) if len(order) <= BROADCAST_HEADS else before
    copies = (rows.join(before, "_key").groupBy("_key", "_before").agg(F.min("text").alias("text"))
              .select("_key", F.lit(None).cast("long").alias("doc_id"), "text",
                      F.col("_before").alias("_range"), F.lit(1).alias("_copy")))
    n = len(bounds) + 1
    key = F.get(F.from_json(F.lit(json.dumps(_task_keys(spark, n))), "array<bigint>"), F.col("_range"))
    dealt = rows.withColumn("_copy", F.lit(0)).unionByName(copies).withColumn("_task", key).repartition(n, "_task")
    dealt = with_hashes(with_anchors(dealt, "text", "anchors"), "anchors", "hashes")
    # a task is a range: the window needs no shuffle of its own
    side = Window.partitionBy("_task").orderBy("_copy", "_key", "text")
    return (dealt.withColumn("next_text", F.lead("text").over(side))
            .withColumn("next_hashes", F.lead("hashes").over(side))
            .filter(F.col("_copy") == 0).drop("_copy", "_key", "_range", "_task"))


def edited(text: Column, other: Column) -> Column:
    """A text whose last half (rounded down) is replaced by the first as many code points of another."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness, the numbers of their anchors
    and of those at the same place."""
    rows = with_next(docs).withColumn("_edited", edited(F.col("text"), F.col("next_text")))
    rows = with_hashes(with_anchors(rows, "_edited", "_edited_anchors"), "_edited_anchors", "_edited_hashes")
    rows = with_text(with_text(rows, "anchors", "fingerprint"), "_edited_anchors", "edited_fingerprint")
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("_edited"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness("hashes", "_edited_hashes").alias("near_edited"), likeness("hashes", "next_hashes").alias("near_next"),
        F.size("anchors").cast("long").alias("n_anchors"),
        same_places("anchors", "_edited_anchors").cast("long").alias("same_places"))
