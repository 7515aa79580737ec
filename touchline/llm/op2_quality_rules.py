"""Quality rules: a table of thresholds compiled into one projection, without user functions.

``base_counts`` adds the counts that the rules' ratios are made of; ``RULES`` names for each ratio the
lowest and highest value a good document may have; ``apply_rules`` turns the table into one boolean
column a rule and the verdict. All of it is built-in expressions over one row: no shuffle, nothing kept
between rows.

Null or empty text: no words, one line, base_failed (too short). A ratio without a denominator counts
as 0. Repeated rows are judged each; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import SPACE, id_text, words

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the be to of and that have with is are was it in for on this by as at from "
    "le la les de des du et un une est que qui en dans pour sur par au pas avec "
    "der die das und den von zu mit ist im auf für nicht ein eine sich dem des "
    "el los las y una es por con para se no al lo su como más del"
).split()

MIN_WORDS = 50
WINDOW = 3


@dataclass(frozen=True)
class Rule:
    """A ratio's allowed range, both ends included; None: open."""
    name: str
    ratio: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("word_length", "word_chars / n_words", 2.0, 12.0),
    Rule("symbols", "n_symbols / n_words", None, 0.1),
    Rule("stop_words", "n_stop_words / n_words", 0.03, None),
    Rule("repeated_lines", "n_dup_lines / n_lines", None, 0.5),
    Rule("repeated_words", "n_repeat_words / n_words", None, 0.5),
    Rule("exclamations", "n_shouts / n_words", None, 0.1),
)


def _with_repeat_words(frame: DataFrame) -> DataFrame:
    """``frame`` (column w: words) with n_repeat_words: words that lie in a window of three words found
    more than once.

    Windows are compared by hash first; only windows with an equal hash are compared as text, so the
    count is exact. Work is that of one sort of the document's windows. Every step is a column of its own
    (and used more than once, so that the optimizer keeps it): inside a lambda an expression would be
    evaluated for every element.
    """
    def gram(i: Column) -> list[Column]:
        return [F.get(F.col("w"), i + k) for k in range(WINDOW)]

    def alike(name: str) -> Column:
        return F.filter(name, lambda x, k: (x["key"].eqNullSafe(F.get(F.col(name), k - 1)["key"]))
                        | (x["key"].eqNullSafe(F.get(F.col(name), k + 1)["key"])))

    some = F.greatest(F.size("w") - (WINDOW - 1), F.lit(0))
    keyed = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("key"), i.alias("at"))))
    texts = F.transform(alike("_by_hash"), lambda x: F.struct(F.concat_ws(" ", *gram(x["at"])).alias("key"),
                                                              x["at"].alias("at")))
    spans = F.transform("_places", lambda p, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get(F.col("_places"), k + 1) - p, F.lit(WINDOW))))
    return (frame
            .withColumn("_hashes", F.slice(F.transform("w", lambda x, i: F.xxhash64(*gram(i))), F.lit(1), some))
            .withColumn("_by_hash", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), keyed))
            .withColumn("_by_text", F.sort_array(texts))
            .withColumn("_places", F.sort_array(F.transform(alike("_by_text"), lambda x: x["at"])))
            .withColumn("n_repeat_words", F.coalesce(F.aggregate(spans, F.lit(0), lambda a, x: a + x), F.lit(0)))
            .drop("_hashes", "_by_hash", "_by_text", "_places"))


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id with the counts of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    cut = id_text(docs).select("doc_id", text.alias("text"), words("text").alias("w"), lines.alias("lines"))
    return _with_repeat_words(cut).select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.col("n_repeat_words").cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("w", lambda x: x.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.length(F.regexp_replace("text", "[^!]+", "")).cast("long").alias("n_shouts"),
    )


def compile_rules(rules: tuple[Rule, ...]) -> dict[str, Column]:
    """One column a rule: true where the ratio is within its range."""
    found = {}
    for rule in rules:
        over, under = rule.ratio.split(" / ")
        ratio = F.when(F.col(under) == 0, 0.0).otherwise(F.col(over) / F.col(under))
        inside = F.lit(True)
        if rule.low is not None:
            inside = inside & (ratio >= rule.low)
        if rule.high is not None:
            inside = inside & (ratio <= rule.high)
        found[rule.name] = inside
    return found


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the counts, base_failed, kept and ``failed_rules`` (names joined by commas)."""
    counts = base_counts(docs)
    passed = compile_rules(rules)
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    kept = ~base_failed
    for column in passed.values():
        kept = kept & column
    failed = F.concat_ws(",", *[F.when(~column, F.lit(name)) for name, column in passed.items()])
    return counts.select("*", base_failed.alias("base_failed"), kept.alias("kept"), failed.alias("failed_rules"))
