"""CSV sources and sinks (header scans, headerless score files).

Nothing is lost silently: a malformed value or row fails the read, a header that disagrees
with the schema fails it too, timestamps keep their microseconds, blanks around text stay,
and text with line breaks is refused at write time unless ``multi_line`` is asked for (such
files cannot be split between tasks). Schemas are explicit; ``schema=None`` infers one with an
extra pass over the files. Writes default to ``errorifexists``; ``overwrite`` is opt-in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from orderlens.session import scratch_path

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
FORMAT = {"timestampFormat": STAMP, "timestampNTZFormat": STAMP, "escape": '"',
          "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "errorifexists",
              multi_line: bool = False) -> str:
    if not multi_line:
        broken = lambda c: F.when(F.col(c).rlike("[\r\n]"), F.raise_error(F.lit(
            f"write_csv: line break in column {c}; pass multi_line=True"))).otherwise(F.col(c))
        df = df.select([broken(f.name).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
                        for f in df.schema.fields])
    df.write.mode(mode).options(header=header, **FORMAT).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = False,
             multi_line: bool = False, timestamps: str | None = STAMP) -> DataFrame:
    """A strict scan. ``timestamps`` is the pattern of timestamp columns; None accepts Spark's
    default forms. All columns are parsed, so a bad value fails even a query that skips it."""
    options = dict(FORMAT) if timestamps else {k: v for k, v in FORMAT.items() if not k.startswith("timestamp")}
    if timestamps:
        options |= {"timestampFormat": timestamps, "timestampNTZFormat": timestamps}
    reader = spark.read.options(header=header, mode="FAILFAST", multiLine=multi_line, columnPruning=False, **options)
    if schema is None:
        return reader.options(inferSchema=True).csv(path)
    return reader.schema(schema).options(enforceSchema=not header).csv(path)


def read_headerless(spark: SparkSession, path: str, schema: StructType, names: list[str]) -> DataFrame:
    """Positional scan (``_c0``, ``_c1`` ...) renamed to ``names``."""
    positional = StructType([f.__class__(f"_c{i}", f.dataType, f.nullable) for i, f in enumerate(schema.fields)])
    df = read_csv(spark, path, positional, header=False)
    return df.select([F.col(f"_c{i}").alias(n) for i, n in enumerate(names)])


def csv_roundtrip(df: DataFrame, path: str | None = None, header: bool = True) -> DataFrame:
    """Write ``df`` as CSV with a header and scan it back with ``df``'s own schema."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "csv-roundtrip")
    write_csv(df, path, header=header)
    return read_csv(spark, path, df.schema, header=header)


def csv_headerless_roundtrip(df: DataFrame, names: list[str], path: str | None = None,
                             mode: str = "errorifexists") -> DataFrame:
    """A score file: headerless write, positional read, rename."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "csv-headerless")
    write_csv(df, path, header=False, mode=mode)
    return read_headerless(spark, path, df.schema, names)
