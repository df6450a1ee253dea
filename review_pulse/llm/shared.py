"""Column idioms, stored intermediates and held-out rows shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_pulse.session import scratch_path

SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def text_words(text: Column) -> Column:
    """Words of a whole text; NULL has none."""
    pieces = F.split(F.coalesce(text, F.lit("")), rf"[{SPACE}]+")
    return F.filter(pieces, lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels nothing may learn from: crc32 of the id as text, divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def nullable(schema: T.StructType) -> T.StructType:
    """``schema`` with every column allowed to be NULL."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def packed(df: DataFrame) -> DataFrame:
    """``df`` with all its columns once more in ``whole_row``, safe from columns added later."""
    return df.withColumn("whole_row", F.struct(*[F.col(f"`{c}`") for c in df.columns]))


def stored(df: DataFrame, label: str, options: dict[str, int] | None = None) -> DataFrame:
    """``df`` written once below the shared folder and read back: its lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    jvm = df.sparkSession._jvm
    for path in {name.rpartition("/")[0] for name in df.inputFiles()}:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
