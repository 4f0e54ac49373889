"""Delimited feeds with a header row and a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import any_of

REJECT = "_reject"


def read_feed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a feed plus `_reject`, the raw line of a row that does not fit.

    Columns are bound by position, the header row is skipped. A row is rejected
    when a value does not parse, fields are missing or surplus, or a text is
    longer than declared; text columns of a rejected row keep what was read.
    Numbers and dates may have outer blanks, texts keep theirs. The line of a row
    with the right number of fields is put together again, each field in its place.
    """
    texts = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    parsed = (
        spark.read.schema(T.StructType([*texts, T.StructField(REJECT, T.StringType())]))
        .option("header", True)
        .option("sep", ",")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECT)
        .csv(path)
    )
    too_long = any_of(
        [
            F.coalesce(F.length(f.name) > f.metadata["max_length"], F.lit(False))
            for f in schema.fields
            if "max_length" in f.metadata
        ]
    )
    typed = {
        f.name: F.nullif(F.trim(f.name), F.lit("")).try_cast(f.dataType)
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    }
    unread = any_of([(F.trim(name) != "") & value.isNull() for name, value in typed.items()])
    wrong = too_long | F.coalesce(unread, F.lit(False))
    line = F.concat_ws(",", *[F.coalesce(_quoted(F.col(f.name)), F.lit("")) for f in schema.fields])
    marked = parsed.withColumn(REJECT, F.coalesce(F.col(REJECT), F.when(wrong, line)))
    kept = {f.name: F.col(f.name) for f in schema.fields if f.name not in typed}
    return marked.select(
        *[(typed | kept)[f.name].alias(f.name, metadata=f.metadata) for f in schema.fields], REJECT
    )


def _quoted(text: Column) -> Column:
    """A field as the feed would have it; the reader's own quoting."""
    inner = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.when(text.rlike('[,"\n\r]'), F.concat(F.lit('"'), inner, F.lit('"'))).otherwise(text)


def split(df: DataFrame, condition) -> tuple[DataFrame, DataFrame]:
    """Rows that do not meet `condition` (or leave it NULL), and rows that do."""
    hit = F.coalesce(condition, F.lit(False))
    return df.filter(~hit), df.filter(hit)
