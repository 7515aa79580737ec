"""Raw visit scans and loaders (versioned, signed visit rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.time import epoch_ntz
from touchline.schema import GOAL, PURCHASE, RAW_VISITS, TRAFFIC_SOURCE

# unsigned 64-bit ids; values >= 2**63 arrive as DECIMAL(20,0) (parquet UINT64) or as
# quoted text (JSON exports quote 64-bit integers)
_U64_FIELDS = {"UserIDHash", "VisitID"}
_U64_GROUP_FIELDS = {("TrafficSource", "ClickBannerID")}


def u64_to_long(c):
    """An unsigned 64-bit id as the signed BIGINT with the same bits (2**63.. maps to negatives).

    Ids are only compared and hashed, which the mapping preserves; a plain cast
    would fail (ANSI mode) on values above 2**63 - 1.
    """
    d = c.cast("decimal(20,0)")
    return F.when(d >= F.lit(str(2 ** 63)).cast("decimal(20,0)"),
                  d - F.lit(str(2 ** 64)).cast("decimal(21,0)")).otherwise(d).cast("long")


_GROUPS = {
    "TrafficSource": TRAFFIC_SOURCE,
    "EPurchase": PURCHASE,
    "Goals": GOAL,
}


def read_raw_visits(spark: SparkSession, path_or_table: str, fmt: str = "parquet") -> DataFrame:
    """Scan a raw visit table (a catalog table name, or a parquet/ORC path).

    Date filters applied later reach the scan (partition pruning when the
    table is partitioned by StartDate, row-group skipping otherwise).
    """
    if fmt == "table":
        df = spark.table(path_or_table)
    else:
        df = spark.read.format(fmt).load(path_or_table)
    return normalize_raw_visits(df)


#: The sub-column that every row of a group has; the others may be missing and take type defaults.
_KEY = {"TrafficSource": "Model", "EPurchase": "ID", "Goals": "ID"}
_REQUIRED = {"TrafficSource": ("Model", "ID"), "EPurchase": ("ID",), "Goals": ("ID",)}


def _value(c: Column, source: T.DataType, target: T.DataType, u64: bool = False) -> Column:
    """``c`` as ``target``. Instants become their UTC wall clock, whatever the session's zone."""
    if u64:
        return u64_to_long(c)
    if isinstance(target, T.TimestampNTZType) and isinstance(source, T.TimestampType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(c), epoch_ntz())
    return c.cast(target)


def _default(target: T.DataType) -> Column:
    if isinstance(target, T.TimestampNTZType):
        return epoch_ntz()
    return F.lit("" if isinstance(target, T.StringType) else 0).cast(target)


def _converter(source: T.DataType, target: T.DataType, u64: bool):
    return lambda x: _value(x, source, target, u64)


def _constant(value: Column):
    return lambda x: value


def _missing(what: str) -> ValueError:
    return ValueError(f"raw visits lack {what}")


def _nested_group(df: DataFrame, name: str) -> Column:
    """An array of structs rebuilt field by field, by name."""
    struct_t, kind = _GROUPS[name], df.schema[name].dataType
    if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType):
        raise _missing(f"an array of structs {name} (found {kind.simpleString()})")
    own = {f.name: f.dataType for f in kind.elementType.fields}
    for sub in _REQUIRED[name]:
        if sub not in own:
            raise _missing(f"{name}.{sub}")

    def build(x: Column) -> Column:
        return F.struct(*[(_value(x[f.name], own[f.name], f.dataType, (name, f.name) in _U64_GROUP_FIELDS)
                           if f.name in own else _default(f.dataType)).alias(f.name) for f in struct_t.fields])

    return F.transform(F.coalesce(F.col(f"`{name}`"), F.array().cast(kind)), build)


def _flat_group(df: DataFrame, name: str) -> Column:
    """Parallel arrays ``name.field`` zipped into one array of structs; NULL arrays are empty."""
    struct_t = _GROUPS[name]
    own = {f.name: df.schema[f"{name}.{f.name}"].dataType for f in struct_t.fields if f"{name}.{f.name}" in df.columns}
    for sub in _REQUIRED[name]:
        if sub not in own:
            raise _missing(f"{name}.{sub}")

    def array(sub: str) -> Column:
        return F.coalesce(F.col(f"`{name}.{sub}`"), F.array().cast(own[sub]))

    key = array(_KEY[name])
    parts = []
    for f in struct_t.fields:
        if f.name in own:
            values = F.transform(F.col(f"`{name}.{f.name}`"), _converter(
                own[f.name].elementType, f.dataType, (name, f.name) in _U64_GROUP_FIELDS))
            if f.name not in _REQUIRED[name]:    # a row without this sub-column
                values = F.coalesce(values, F.transform(key, _constant(_default(f.dataType))))
            else:
                values = F.coalesce(values, F.array().cast(T.ArrayType(f.dataType)))
        else:
            values = F.transform(key, _constant(_default(f.dataType)))
        parts.append(values.alias(f.name))
    return F.arrays_zip(*parts)


def normalize_raw_visits(df: DataFrame) -> DataFrame:
    """Bring a raw visit frame to schema.RAW_VISITS.

    Accepts either the nested form (``TrafficSource`` as array of struct, fields in any order) or the
    flat form of the source system, where a group is a set of parallel arrays named
    ``TrafficSource.Model``, ``TrafficSource.ID``, ... , zipped element-wise into one array of structs.
    Without a group's ``Model`` or ``ID`` no row could be read right, so their absence raises; other
    missing sub-columns take their type's default (also where only some rows lack one), NULL groups are empty.
    """
    cols = set(df.columns)
    out = []
    for field in RAW_VISITS.fields:
        name = field.name
        if name in _GROUPS:
            out.append((_nested_group(df, name) if name in cols else _flat_group(df, name)).alias(name))
        elif name == "UserIDHash" and name not in cols and "UserID" in cols:
            out.append(u64_to_long(F.col("UserID")).alias(name))
        elif name not in cols:
            raise _missing(name)
        else:
            out.append(_value(F.col(name), df.schema[name].dataType, field.dataType, name in _U64_FIELDS).alias(name))
    return df.select(*out)


def _export_schema() -> T.StructType:
    """Rows of a JSON export: dates and times as text, 64-bit integers as text or number."""
    kept = (T.IntegerType,)
    fields = []
    for f in RAW_VISITS.fields:
        if f.name in _GROUPS:
            fields += [T.StructField(f"{f.name}.{x.name}", T.ArrayType(
                x.dataType if isinstance(x.dataType, kept) else T.StringType())) for x in f.dataType.elementType.fields]
        else:
            fields.append(T.StructField(f.name, f.dataType if isinstance(f.dataType, kept) else T.StringType()))
    return T.StructType([*fields, T.StructField("UserID", T.StringType())])


def _present_columns(pieces: DataFrame, names: list[str]) -> set[str]:
    """The export's columns: the union of the keys of all rows (pieces of text, one JSON object each).

    The set is merged like any aggregate: each task sends a row a known column at most.
    """
    keys = pieces.select(F.explode(F.expr("json_object_keys(value)")).alias("k")).filter(F.col("k").isin(names))
    return {r["k"] for r in keys.groupBy("k").agg(F.count(F.lit(1))).select("k").collect()}


#: Where a record ends in an export of one document that stands on several lines. A line feed cannot be
#: inside a JSON text, so this end is never one.
RECORD_END = "\n\t\t},"
_COMPACT_END = "},"


def _records(spark: SparkSession, path: str, end: str) -> DataFrame:
    """Texts of the records of one-document exports, cut at ``end`` by the scan itself, so that a file which
    is not compressed is read by many tasks. The head of the document (up to its list of columns, and from
    there to its row list) is dropped from its pieces; what follows the last record in its piece is not read."""
    pieces = spark.read.option("lineSep", end).text(path)
    head = F.when(F.contains("value", F.lit('"meta"')), F.regexp_replace("value", r'(?s)^[^\[]*"meta"\s*:\s*\[', "")) \
        .otherwise(F.col("value"))
    rest = F.when(F.contains(head, F.lit('"data"')), F.regexp_replace(head, r'(?s)^.*"data"\s*:\s*\[', "")) \
        .otherwise(head)
    value = F.btrim(rest, F.lit(" \t\r\n"))
    # the scan took the closing brace of all but the last piece; one more brace behind a record does no harm.
    # What is no record is null, so that it cannot fail a parser that Spark runs before the filter
    record = F.transform(F.array(value), lambda v: F.when(F.startswith(v, F.lit("{")), F.concat(v, F.lit("}"))))
    return pieces.select(F.get(record, F.lit(0)).alias("value")).filter(F.col("value").isNotNull())


def _is_column_list(keys: Column) -> Column:
    """Whether an object is an entry of the document's list of columns (name and type)."""
    return (F.size(keys) == 2) & F.array_contains(keys, "name") & F.array_contains(keys, "type")


def _envelope_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The texts of the rows (column ``value``) of exports of one document a file."""
    lines = spark.read.text(path)
    if lines.filter(F.col("value") == RECORD_END[1:]).head(1):
        pieces = _records(spark, path, RECORD_END)
    else:
        # all in one line: the end of a record may also stand inside a text, which cuts a record
        pieces = _records(spark, path, _COMPACT_END)
        if pieces.filter("json_object_keys(value) IS NULL").head(1):
            doc = spark.read.option("multiLine", True).schema(T.StructType([T.StructField("data", T.ArrayType(schema))]))
            return doc.json(path).select(F.explode("data").alias("r")).select(
                F.to_json("r", {"ignoreNullFields": "true"}).alias("value"))
    # only texts with both words are parsed for it
    listed = (F.contains("value", F.lit('"name"')) & F.contains("value", F.lit('"type"'))
              & _is_column_list(F.expr("json_object_keys(value)")))
    return pieces.filter(~F.coalesce(listed, F.lit(False)))


def load_json_dump(spark: SparkSession, path: str, envelope: bool = False) -> DataFrame:
    """Load a JSON export of raw visits.

    The normal form is JSON lines, one visit row per line, which splits across tasks.
    ``envelope=True`` reads documents ``{"meta": [...], "data": [{...}, ...], "rows": n}`` (may be
    gzip-compressed). They are cut at the ends of records by the scan, so one file that is not compressed is read by
    many tasks too, and a document may be spread over several files, each of whole records. A document without line
    feeds between records is cut at ``},``; only if one of its texts holds that, each file is read whole by one task.

    Groups are parallel arrays (``TrafficSource.Model``, ...); date-time fields are ``YYYY-MM-DD hh:mm:ss``
    text. Which columns the export has is the union over all rows, found in a pass of its own; a column that
    no row has is missing (see ``normalize_raw_visits``), in a row without a sub-column its values are the
    type's default. A row that is no JSON object raises.
    """
    schema = _export_schema()
    texts = _envelope_rows(spark, path, schema) if envelope else spark.read.text(path).filter(F.btrim("value") != "")
    present = _present_columns(texts, schema.names)
    if not present and not texts.head(1):
        present = set(schema.names)     # no rows: no column can be missing
    rows = texts.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    fixed = []
    for c in rows.columns:
        if c not in present:
            continue
        if c == "UTCStartTime":
            fixed.append(F.to_timestamp_ntz(F.col(c)).alias(c))
        elif c == "TrafficSource.StartTime":
            fixed.append(F.transform(F.col(f"`{c}`"), lambda x: F.to_timestamp_ntz(x)).alias(c))
        elif c == "StartDate":
            fixed.append(F.to_date(F.col(c)).alias(c))
        else:
            fixed.append(F.col(f"`{c}`").alias(c))
    return normalize_raw_visits(rows.select(*fixed))
