"""CSV and JSON inputs with explicit schemas."""

from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlens.functions.ids import pad_cik
from quarterlens.session import cut_lineage


def read_csv(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str] | None = None,
             date_format: str = "yyyy-MM-dd") -> DataFrame:
    """A5: header CSV with a declared schema (no inference pass); malformed rows fail
    the read, extra or missing columns are an error (FAILFAST)."""
    df = (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
          .option("dateFormat", date_format).option("enforceSchema", False).csv(path))
    return df.select(*columns) if columns else df


class CsvLoad(NamedTuple):
    """Rows that fit the schema, rows that do not (file, record, reason), and their numbers."""
    good: DataFrame
    bad: DataFrame
    n_good: int
    n_bad: int


_FILE, _RAW, _REASON = "_file", "_record", "_reason"


def _typed(text: Column, to: T.DataType, date_format: str) -> Column:
    """The text as a value of a type; null where it is none."""
    if isinstance(to, T.StringType):
        return text
    if isinstance(to, T.DateType):
        return F.try_to_date(text, date_format)
    if isinstance(to, (T.TimestampType, T.TimestampNTZType)):
        return text.try_cast(to)
    return F.trim(text).try_cast(to)


def load_csv(spark: SparkSession, path: str, schema: T.StructType, date_format: str = "yyyy-MM-dd"
             ) -> CsvLoad:
    """A5 with quarantine: header CSV of which bad rows do not fail the job.

    A row is bad if it has not as many fields as the schema, if a field is not of its type, or if
    a field that must not be null is. Reasons name the first such column and its text. An empty
    field is null. Both kinds come from one pass over the files, whose result is checkpointed (a
    count and a second write do not parse again); a header that differs from the schema is an
    error, as its rows can not be told apart.
    """
    raw = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema],
                        T.StructField(_RAW, T.StringType())])
    text = spark.read.schema(raw).option("header", True).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", _RAW).option("enforceSchema", False).csv(path) \
        .withColumn(_FILE, F.col("_metadata.file_path"))
    reason = F.when(F.col(_RAW).isNotNull(), F.lit(f"not {len(schema)} fields"))
    for f in schema:
        c = F.col(f"`{f.name}`")
        wrong = c.isNotNull() & _typed(c, f.dataType, date_format).isNull()
        reason = reason.when(wrong, F.concat(F.lit(f"{f.name}: not {f.dataType.simpleString()}: "),
                                             F.substring(c, 1, 200)))
        if not f.nullable:
            reason = reason.when(c.isNull(), F.lit(f"{f.name}: missing"))
    seen = Observation("csv")
    is_bad = F.col(_REASON).isNotNull()
    record = F.coalesce(F.col(_RAW), F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in schema])))
    rows = text.withColumn(_REASON, reason).withColumn(_RAW, record).observe(
        seen, F.count_if(is_bad).alias("bad"), F.count_if(~is_bad).alias("good"))
    kept = cut_lineage(rows)
    good = kept.filter(~is_bad).select(*[
        _typed(F.col(f"`{f.name}`"), f.dataType, date_format).alias(f.name) for f in schema])
    bad = kept.filter(is_bad).select(F.col(_FILE).alias("file"), F.col(_RAW).alias("record"),
                                     F.col(_REASON).alias("reason"))
    found = seen.get
    return CsvLoad(good, bad, found["good"], found["bad"])


def read_column_array_json(spark: SparkSession, path: str, wanted: Sequence[str]) -> DataFrame:
    """A JSON document ``{"fields": [...], "data": [[...], ...]}`` -> one row per
    ``data`` entry, columns looked up by name in ``fields`` (order-independent;
    extra fields are ignored; values arrive as strings)."""
    raw = spark.read.option("multiLine", True).json(path)
    rows = raw.select("fields", F.explode("data").alias("row"))
    out = []
    for name in wanted:
        pos = F.array_position(F.col("fields"), F.lit(name)).cast("int")
        out.append(F.when(pos > 0, F.element_at(F.col("row"), pos)).alias(name))
    return rows.select(*out)


def ticker_conversion(spark: SparkSession, path: str) -> DataFrame:
    """N2 input: (cik padded to 10, ticker, company_name) from the column-array JSON."""
    df = read_column_array_json(spark, path, ["cik", "ticker", "name"])
    return df.select(pad_cik("cik").alias("cik"), "ticker", F.col("name").alias("company_name"))
