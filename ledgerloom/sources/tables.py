"""Scans. Schemas are explicit: inference would turn a 'yyyy-MM' month into a timestamp."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.session import cut_lineage

REJECTED = "_rejected_line"


def warehouse_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet table of a warehouse folder; column pruning and pushdown come from the later select and filter."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def csv_table(spark: SparkSession, path: str | list[str], schema: StructType | str) -> DataFrame:
    """Headered CSV, with or without a byte-order mark; columns the caller does not select are not parsed."""
    return spark.read.schema(schema).option("header", True).csv(path)


def csv_checked(
    spark: SparkSession, path: str | list[str], schema: StructType | str, pattern: str | None = None, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): rows of CSV files that fit the schema, and the lines that do not, from one scan.

    A line is rejected when a value does not parse as its type, when it has fewer or more fields than the schema, or when its
    quotes do not close; `rejected` has `file`, `line` (as read) and the columns that could be parsed, so that a caller
    may still use them knowingly. Blank lines are not rows, nor is the first line of a file with `header`. The scan is
    written once in the shared folder and both results read from there, so every row is in exactly one of them.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # a separator and a quote that no line has: one column with the whole line, headers and byte-order marks taken off
    reader = spark.read.schema(f"{REJECTED} string").option("header", header).option("sep", "\u0001").option("quote", "")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    lines = reader.csv(path)
    name = lines.metadataColumn("_metadata")["file_name"].alias("_file")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*wanted.fields, StructField("_malformed", StringType())])
    row = F.from_csv(REJECTED, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"})
    scanned = cut_lineage(lines.select(REJECTED, name, row.alias("_row")))
    quotes = F.length(F.regexp_replace(REJECTED, r'\\.|[^"\\]', ""))
    fits = F.coalesce(F.col("_row._malformed").isNull() & (quotes % 2 == 0), F.lit(False))
    columns = [F.col("_row")[c].alias(c) for c in wanted.names]
    bad = scanned.filter(~fits).select(F.col("_file").alias("file"), F.col(REJECTED).alias("line"), *columns)
    return scanned.filter(fits).select(*columns), bad


def csv_folder(
    spark: SparkSession, folder: str, pattern: str, schema: StructType | str, keep: Sequence[str]
) -> DataFrame:
    """Every CSV of a folder whose name fits the pattern, reduced to the kept columns."""
    reader = spark.read.schema(schema).option("header", True).option("pathGlobFilter", pattern)
    return reader.csv(folder).select(*keep)


def tagged_union(parts: Mapping[str, DataFrame], tag: str, names: Mapping[str, str] | None = None) -> DataFrame:
    """Union of several sources with a source tag (and optionally its display name); missing columns become NULL."""
    tagged = []
    for code, frame in parts.items():
        out = frame.withColumn(tag, F.lit(code))
        if names is not None:
            out = out.withColumn(f"{tag}_name", F.lit(names.get(code)))
        tagged.append(out)
    return concat_frames(tagged)


def concat_frames(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def split_empty_documents(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(readable, failed): a document whose text is NULL or only white space failed."""
    blank: Column = F.coalesce(~F.col(text).rlike(r"\S"), F.lit(True))
    return docs.filter(~blank), docs.filter(blank)


def document_folder(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """One row per text file: filename, text."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=pattern)
    return files.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("filename"), F.col("value").alias("text"))
