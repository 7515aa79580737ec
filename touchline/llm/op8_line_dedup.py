"""Line deduplication with built-in functions: lines found in several documents stay only in one.

Lines are exploded, normalised and hashed (128 bits); the distinct documents of each hash are counted
with partial aggregation, so a line of a third of all documents adds one row a task. Lines whose count
reaches the threshold are dropped everywhere but in the smallest doc_id that holds them, and documents
are put together again by line position. Only hashes and positions are shuffled, the texts once.

Null or empty text: one empty line. A null doc_id is a document of its own and comes after all others.
Rows that repeat a doc_id are one document; each row keeps or loses its own lines. Lines that normalise
to fewer than ``min_chars`` code points always stay. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import ASCII_SPACES, free
from touchline.session import checkpointed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(ASCII_SPACES)), UPPER, LOWER)


def dropped_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each text that loses lines: _id, _text (its hash) and _places, sorted positions from 0."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = (docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_text"),
                         F.posexplode(F.split(text, "\n")).alias("_place", "_line"))
             .select("_id", "_text", "_place", line_key(F.col("_line")).alias("_key"))
             .filter(F.length("_key") >= min_chars)
             .select("_id", "_text", "_place", F.xxhash64("_key").alias("_h1"),
                     F.xxhash64(F.lit("second"), "_key").alias("_h2")))
    holders = (lines.groupBy("_h1", "_h2", "_id").agg(F.lit(1).alias("_one"))
               .groupBy("_h1", "_h2").agg(F.count("_one").alias("_docs"), F.min("_id").alias("_first"))
               .filter(F.col("_docs") >= min_docs).drop("_docs"))
    # written, so that the join reads it through an exchange of its own and Spark can split hot lines
    holders = checkpointed(holders, "op8-holders")
    return (lines.join(holders, ["_h1", "_h2"]).filter(~F.col("_id").eqNullSafe(F.col("_first")))
            .groupBy("_id", "_text").agg(F.sort_array(F.collect_set("_place")).alias("_places")))


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, id_col: str = "doc_id",
                text_col: str = "text", lines: str = "n_lines", dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with the kept lines as text and the numbers of lines before and dropped (columns of these
    names are replaced)."""
    base = docs.drop(lines, dropped)
    mine = {c: free(c, base.columns) for c in ("_id", "_text", "_places", "_flags")}
    found = dropped_lines(docs, min_chars, min_docs, id_col, text_col)
    found = found.select(*[F.col(c).alias(mine[c]) for c in ("_id", "_text", "_places")])
    text = F.coalesce(F.col(text_col), F.lit(""))
    both = base.join(found, F.col(id_col).eqNullSafe(F.col(mine["_id"])) & (F.xxhash64(text) == F.col(mine["_text"])),
                     "left")
    places = F.col(mine["_places"])
    flags = F.flatten(F.transform(places, lambda p, k: F.concat(
        F.array_repeat(F.lit(False), p - F.coalesce(F.get(places, k - 1), F.lit(-1)) - 1), F.array(F.lit(True)))))
    both = both.withColumn(mine["_flags"], flags)
    flags = F.col(mine["_flags"])
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.coalesce(F.get(flags, i), F.lit(False))), "\n")
    return both.withColumns({
        # the flags are used twice, so the optimizer keeps them a column instead of putting them into the lambda
        text_col: F.when(flags.isNull(), text).otherwise(kept),
        lines: (F.length(F.regexp_replace(text, r"[^\n]+", "")) + 1).cast("long"),
        dropped: F.coalesce(F.size(places), F.lit(0)).cast("long"),
    }).drop(*mine.values())
