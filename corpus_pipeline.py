"""A corpus from raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the
checkpoint folder and reads it back as the next stage's documents. All but the last stage return the
columns of their input; n_chars, where present, follows the text. Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import op1_packing, op5_near_dedup, op7_quality, op8_line_dedup, op9_substrings
from touchline.llm.common import free
from touchline.session import checkpointed, delete_paths, recorded


def _like(docs: DataFrame, frame: DataFrame) -> DataFrame:
    """The columns of ``docs``, n_chars counted anew."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        frame = frame.withColumn("n_chars", F.length("text").cast(kind))
    return frame.select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is fitted on the labels of these documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    # two passes over the texts instead of one and a shuffle of them
    stats = checkpointed(op7_quality.with_statistics(docs.select("doc_id", "text")).drop("text"), "op7-statistics")
    score = free("_score", docs.columns)
    scored = op7_quality.with_score(op7_quality.with_statistics(docs), op7_quality.fit(stats, labels), score)
    return scored.filter(F.col(score) >= op7_quality.THRESHOLD).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has."""
    names = [free(c, docs.columns) for c in ("_lines", "_dropped")]
    return _like(docs, op8_line_dedup.dedup_lines(docs, lines=names[0], dropped=names[1]))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates; of rows with the same doc_id and shingles, one."""
    own = free("_set", docs.columns)
    name, kind = (free(c, [*docs.columns, own]) for c in ("_kept", "_kind"))
    kept = op5_near_dedup.near_duplicates_by_set(docs).filter("kept").select(
        F.col("doc_id").alias(name), F.col("set_id").alias(kind)).distinct()
    rows = op5_near_dedup.with_set_id(docs, own)
    same = F.col("doc_id").eqNullSafe(F.col(name)) & F.col(own).eqNullSafe(F.col(kind))
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere; those without any stay as they are."""
    names = [free(c, docs.columns) for c in ("_words", "_removed")]
    cut = op9_substrings.remove_repeats(docs, words=names[0], removed=names[1], untouched=True)
    return _like(docs, cut)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in the training sequences."""
    import public_tokenizers
    return op1_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", quality), ("line dedup", line_dedup), ("near dedup", near_dedup),
          ("substring dedup", substring_dedup), ("packing", packing)]

#: The classifier, the near-duplicate search and the packing cannot be said in SQL; tests hold the stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage stores on its way, and its input, is deleted once its own output is
    written; only what the last stage still reads stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for k, (name, stage) in enumerate(STAGES):
        passing: list[str] = []
        with recorded(passing):
            docs = stage(spark, docs, sf_dir)
            if k < len(STAGES) - 1:
                docs = checkpointed(docs, "pipeline-" + name.replace(" ", "-"))
        if k < len(STAGES) - 1:
            delete_paths(spark, before + passing[:-1])
            before = passing[-1:]
    return docs
