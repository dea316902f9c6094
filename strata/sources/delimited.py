"""Tolerant delimited-text ingestion with a quarantine.

The source contract: one header line, ``,`` separator, optional ``"`` quoting,
missing trailing fields are NULL, and unreadable rows are set aside without
limit instead of failing the load.

Spark's typed CSV modes cannot express that contract (PERMISSIVE nulls a bad
field silently, DROPMALFORMED also drops short rows), so each feed is read as
all-text columns plus one overflow column and the raw record; typing happens
afterwards with ``try_*`` conversions, and a row is quarantined, whole line
included, when it has too many fields, when a quote is not closed, when a
non-empty value does not convert, or when the declared type would round it.  File splits are read in parallel and
the split into good and quarantined rows is a narrow map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BRONZE, DATE_PATTERNS, FEED_FILES

OVERFLOW = "_overflow"
RECORD = "_record"    # the whole line as delivered; kept for rejected rows
REASON = "reject_reason"
SOURCE_FILE = "source_file"

CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": RECORD,
    "ignoreLeadingWhiteSpace": "false",  # padded codes are data, kept as they are
    "ignoreTrailingWhiteSpace": "false",
}


# Whole fields, each with its comma, and then one that is opened by a quote and never closed.  A quote
# opens a field only as its first character; anywhere else it is a character like any other.
UNCLOSED = r'\A(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+)?+,)*+"(?:[^"]++|"")*+\z'


def case_insensitive_glob(name: str) -> str:
    """``PX_cat.csv`` → ``[pP][xX]_[cC][aA][tT].[cC][sS][vV]`` (a Hadoop glob)."""
    out = []
    for ch in name:
        if ch.isalpha():
            out.append(f"[{ch.lower()}{ch.upper()}]")
        elif ch in "[]{}*?\\":
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "".join(out)


def feed_path(root: str, feed: str) -> str:
    """Location of a feed under a landing root, matched case-insensitively."""
    folder, file_name = FEED_FILES[feed]
    return f"{root.rstrip('/')}/{folder}/{case_insensitive_glob(file_name)}"


def text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields]
                        + [T.StructField(OVERFLOW, T.StringType(), True), T.StructField(RECORD, T.StringType(), True)])


def read_text_fields(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """All-text scan: declared fields + overflow; short records get NULL tails."""
    reader = spark.read.schema(text_schema(schema)).option("header", str(header).lower())
    for k, v in CSV_OPTIONS.items():
        reader = reader.option(k, v)
    return reader.csv(path).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def typed_value(name: str, text: Column, dtype: T.DataType) -> Column:
    """Text → declared type; NULL when it does not convert."""
    if isinstance(dtype, T.DateType):
        patterns = DATE_PATTERNS.get(name, ("yyyy-MM-dd",))
        parsed = [F.try_to_timestamp(text, F.lit(p)) for p in patterns]
        return (F.coalesce(*parsed) if len(parsed) > 1 else parsed[0]).cast("date")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        patterns = DATE_PATTERNS.get(name, ("yyyy-MM-dd HH:mm:ss",))
        return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns]).cast(dtype)
    if isinstance(dtype, T.StringType):
        return text
    return text.try_cast(dtype)


def with_rejects(raw: DataFrame, schema: T.StructType, max_text: int | None = None) -> DataFrame:
    """Adds typed columns and a ``reject_reason`` (NULL for good rows)."""
    # the reader keeps the line unless it has exactly one field too many: then its fields give it back
    quoted = [F.when(c.contains(",") | c.contains('"'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
              for c in (F.coalesce(F.col(n), F.lit("")) for n in [*schema.names, OVERFLOW])]
    record = F.coalesce(F.col(RECORD), F.concat_ws(",", *quoted))
    reasons = [F.when(F.col(OVERFLOW).isNotNull(), F.lit("too_many_fields")),
               F.when(F.col(RECORD).contains('"') & F.col(RECORD).rlike(UNCLOSED), F.lit("unclosed_quote"))]
    typed = {}
    for f in schema.fields:
        text = F.col(f.name)
        exact = text.try_cast(T.DecimalType(38, 18)) if isinstance(f.dataType, T.DecimalType) else None
        value = typed_value(f.name, text, f.dataType) if exact is None else exact.try_cast(f.dataType)
        typed[f.name] = value
        reasons.append(F.when(text.isNotNull() & value.isNull(), F.lit(f"bad_{f.name}")))
        if exact is not None:
            reasons.append(F.when(exact != value, F.lit(f"rounded_{f.name}")))
        if max_text is not None and isinstance(f.dataType, T.StringType):
            reasons.append(F.when(F.length(text) > max_text, F.lit(f"long_{f.name}")))
    reason = F.concat_ws(";", *reasons)
    rejected = F.when(reason != "", reason)
    # raw text and file path are kept for quarantined rows only (NULL costs
    # nothing), so persisting the checked rows stores each good value once
    keep = rejected.isNotNull()
    return raw.select(*[F.when(keep, F.col(f.name)).alias(f"_raw_{f.name}") for f in schema.fields],
                      F.col(OVERFLOW), F.when(keep, record).alias(RECORD), F.when(keep, F.col(SOURCE_FILE)).alias(SOURCE_FILE),
                      *[v.alias(n) for n, v in typed.items()], rejected.alias(REASON))


STATUS = "_status"


def checked_schema(schema: T.StructType) -> T.StructType:
    """Layout of :func:`with_rejects` output (raw text, overflow, file, typed, reason)."""
    text = [T.StructField(f"_raw_{f.name}", T.StringType(), True) for f in schema.fields]
    return T.StructType([*text, T.StructField(OVERFLOW, T.StringType(), True), T.StructField(RECORD, T.StringType(), True),
                         T.StructField(SOURCE_FILE, T.StringType(), True),
                         *[T.StructField(f.name, f.dataType, True) for f in schema.fields],
                         T.StructField(REASON, T.StringType(), True)])


def rejected_rows(checked: DataFrame, schema: T.StructType) -> DataFrame:
    return checked.filter(F.col(REASON).isNotNull()).select(
        *[F.col(f"_raw_{n}").alias(n) for n in schema.names], F.col(OVERFLOW), F.col(RECORD), F.col(REASON), F.col(SOURCE_FILE))


def split(checked: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good typed rows, quarantined raw rows with reason and source file)."""
    good = checked.filter(F.col(REASON).isNull()).select(*schema.names)
    return good, rejected_rows(checked, schema)


def ingest(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
           max_text: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Scan one delimited source into (good, quarantine)."""
    checked = with_rejects(read_text_fields(spark, path, schema, header), schema, max_text)
    return split(checked, schema)


def ingest_feed(spark: SparkSession, root: str, feed: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    return ingest(spark, feed_path(root, feed), BRONZE[feed], header)


def write_feed(df: DataFrame, path: str) -> None:
    """Write a feed the way the source systems deliver it: delimited text with a
    header, NULL as an empty field, padding preserved.  The pieces are gzipped: they are
    as many as the tasks that write them, so a reader need not split one."""
    (df.write.mode("overwrite").option("header", "true").option("compression", "gzip")
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
       .option("dateFormat", "yyyy-MM-dd").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
