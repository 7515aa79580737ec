r"""Tab-separated text with escapes: every value survives, whatever characters it holds.

A row is a line, a field ends at a tab. Inside fields a backslash, tab, line feed, carriage return, backspace,
form feed and zero byte are written as ``\\ \t \n \r \b \f \0``, NULL as ``\N`` (an empty field is an empty
text). Reading takes back these and ``\'``; other escapes stand for the character after the backslash.
Quotes mean nothing. Built from column expressions, so files split between tasks at line ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The letter after a backslash, and the character it stands for.
ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f", "0": "\0"}
NULL = "\\N"
_FORMAT = {"sep": "\t", "quote": "", "lineSep": "\n", "emptyValue": "", "ignoreLeadingWhiteSpace": False,
           "ignoreTrailingWhiteSpace": False, "encoding": "UTF-8"}


def escape(value: Column | str) -> Column:
    r"""A text as a field; NULL becomes ``\N``."""
    c = F.col(value) if isinstance(value, str) else value
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for letter, char in ESCAPES.items():
        c = F.replace(c, F.lit(char), F.lit("\\" + letter))
    return F.coalesce(c, F.lit(NULL))


def unescape(field: Column | str) -> Column:
    r"""The text of a field; ``\N`` is NULL.

    Two backslashes are taken as a pair from the left, so in the pieces between pairs every backslash
    begins an escape.
    """
    c = F.col(field) if isinstance(field, str) else field

    def piece(p: Column) -> Column:
        for letter, char in ESCAPES.items():
            p = F.replace(p, F.lit("\\" + letter), F.lit(char))
        return F.regexp_replace(p, r"\\(.)", "$1")

    plain = F.when(F.contains(c, F.lit("\\")), F.array_join(F.transform(F.split(c, r"\\\\"), piece), "\\")).otherwise(c)
    return F.when(c != NULL, plain)


def _field(f: T.StructField) -> Column:
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
        c = F.to_json(c)
    elif isinstance(f.dataType, T.BooleanType):
        c = c.cast("int")
    return escape(c.cast("string")).alias(f.name)


def write_tsv(rows: DataFrame, path: str, header: bool = True, one_file: bool = False) -> None:
    """Write ``rows``; nested values are written as JSON text, booleans as 1 and 0.

    ``one_file``: small results in a single file.
    """
    fields = rows.select(*[_field(f) for f in rows.schema.fields])
    names = [escape(F.lit(n)) for n in rows.columns]
    named = fields.sparkSession.range(1).select(*names).first()
    fields = fields.toDF(*named)
    writer = (fields.coalesce(1) if one_file else fields).write.mode("overwrite").options(**_FORMAT)
    writer.option("header", header).option("nullValue", NULL).csv(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | None = None, header: bool = True) -> DataFrame:
    """Rows of files of fields. With ``schema``, columns are taken by its names from the header (or by place
    without one) and cast; a column that the header lacks is NULL. Without, all columns are texts."""
    reader = spark.read.options(**_FORMAT).option("nullValue", "\x01no value\x01").option("header", header)
    if schema is not None and not header:
        reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))
    found = reader.csv(path)
    texts = found.select(*[unescape(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in found.columns])
    given = spark.createDataFrame([tuple(found.columns)], ", ".join(f"c{i} string" for i in range(len(found.columns))))
    names = given.select(*[unescape(f"c{i}").alias(f"c{i}") for i in range(len(found.columns))]).first() \
        if found.columns else ()
    texts = texts.toDF(*names)
    if schema is None:
        return texts
    return texts.select(*[(_value(F.col(f"`{f.name}`"), f.dataType) if f.name in texts.columns
                           else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def _value(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.from_json(c, kind)
    return c.cast(kind)
