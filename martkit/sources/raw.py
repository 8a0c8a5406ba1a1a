"""Raw sources (S1, S2, S6, S9): all-string CSV files with drifting headers.

Raw files are read with every column as text (no schema inference - a bad value in row
10 million must not change a column's type), header names are normalised, and yearly
files with the same layout are unioned by name.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.spec import conform_layout, normalise_headers


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """A raw CSV as all-string columns, headers stripped of padding.

    With ``columns`` the file's header row is skipped and the given names are used
    positionally (an explicit schema: no extra pass over the file to read the header).
    """
    reader = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
              .option("multiLine", False).option("mode", "PERMISSIVE"))
    if columns is not None:
        return reader.schema(string_schema(columns)).csv(path)
    return normalise_headers(reader.option("inferSchema", False).csv(path))


CORRUPT, SOURCE_FILE = "_corrupt_record", "_source_file"


class HeaderMismatch(ValueError):
    """Files whose header is not the expected one; nothing of them has been read."""


def check_headers(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], sep: str = ",",
                  encoding: str = "UTF-8") -> None:
    """Raise unless every file has exactly the given header names, padding aside (one line a file is read)."""
    bad = {}
    for path in paths:
        found = read_raw_csv(spark, path, sep=sep, encoding=encoding).columns
        if list(found) != list(columns):
            bad[path] = (sorted(set(columns) - set(found)), sorted(set(found) - set(columns)))
    if bad:
        raise HeaderMismatch("; ".join(f"{p}: missing {m}, unexpected {u}" if m or u else f"{p}: other order"
                                       for p, (m, u) in bad.items()))


def read_raw_checked(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], sep: str = ",",
                     encoding: str = "UTF-8", checked: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of CSV files with one header; every column is text, ``_source_file`` tells the file.

    A line with too few or too many fields, or with broken quotes, becomes a reject with its whole text; nothing is
    dropped and no line stops the load.  ``checked``: the headers are compared first and a file with another
    header raises.
    """
    if checked:
        check_headers(spark, paths, columns, sep, encoding)
    schema = T.StructType([*string_schema(columns).fields, T.StructField(CORRUPT, T.StringType())])
    # without column pruning a line is judged by all its fields, whatever is selected later; the condition is always
    # true and only keeps all columns in the scan, as Spark refuses to read the corrupt-record column alone
    lines = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
             .schema(schema).csv(list(paths)).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
             .where(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(1)) == 0))
    good = lines.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    rejects = lines.where(F.col(CORRUPT).isNotNull()).select(SOURCE_FILE, F.col(CORRUPT).alias("line"))
    return good, rejects


def read_yearly(spark: SparkSession, paths: Mapping[int, str], layouts: Mapping[int, Mapping[str, str]],
                targets: Sequence[str], year_col: str = "ReportYear") -> DataFrame:
    """The same logical table from one file per year, each with its own header map,
    conformed to ``targets`` and unioned (year added as a column)."""
    return read_yearly_checked(spark, paths, layouts, targets, year_col)[0]


def read_yearly_checked(spark: SparkSession, paths: Mapping[int, str], layouts: Mapping[int, Mapping[str, str]],
                        targets: Sequence[str], year_col: str = "ReportYear") -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of yearly files; every year's header is read first and its lines are judged by it."""
    frames, rejects = [], []
    for year, path in paths.items():
        columns = read_raw_csv(spark, path).columns
        good, bad = read_raw_checked(spark, [path], columns, checked=False)
        frames.append(conform_layout(good.drop(SOURCE_FILE), layouts.get(year, {}), targets)
                      .withColumn(year_col, F.lit(year)))
        rejects.append(bad.withColumn(year_col, F.lit(year)))
    return tuple(functools.reduce(lambda a, b: a.unionByName(b), x) for x in (frames, rejects))


def rows(spark: SparkSession, data: Sequence[Sequence], schema: str | T.StructType) -> DataFrame:
    """Inline constant relation (VALUES ...) - only for small fixed seed tables."""
    return spark.createDataFrame(list(data), schema)
