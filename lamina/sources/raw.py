"""All-string readers for landed CSV and JSON files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.operators.shaping import quoted, union_drifted
from lamina.sources.folders import base_name, matching

CANDIDATE_SEPARATORS = (",", ";")
DEFAULT_SEPARATOR = ","
CORRUPT = "_corrupt_record"
HEADERS_AT_ONCE = 8

# Position of a row in its source. Keep-last needs an order: files by name,
# blocks by offset, rows by reading order inside a block.
SEQUENCE_COLUMNS = ("_source_file", "_block_start", "_row_seq")


class MalformedFile(ValueError):
    """A raw file cannot be read as its dataset demands."""


def choose_separator(header: str) -> str:
    """The candidate that is most frequent in the header; ``,`` on a tie or none."""
    ranked = sorted((header.count(s) for s in CANDIDATE_SEPARATORS), reverse=True)
    if ranked[0] == ranked[1]:
        return DEFAULT_SEPARATOR
    return max(CANDIDATE_SEPARATORS, key=header.count)


def separator_of(header: str) -> str:
    """:func:`choose_separator` as an SQL expression."""
    commas, semicolons = (
        f"length({header}) - length(replace({header}, '{s}', ''))" for s in CANDIDATE_SEPARATORS
    )
    return f"if({semicolons} > {commas}, ';', '{DEFAULT_SEPARATOR}')"


def detect_separator(spark: SparkSession, path: str) -> str:
    """Separator of one file, from its header line only."""
    first = spark.read.text(path).first()
    if first is None:
        raise MalformedFile(f"empty file: {path}")
    return choose_separator(first[0])


def _too_long(record: Column, separator: str, width: int) -> Column:
    unquoted = F.regexp_replace(record, r'"([^"]|"")*"', "")
    separators = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(separator)))
    return separators >= width


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Files that a path or pattern stands for, in name order; those of a folder for itself."""
    found = []
    for entry in matching(spark, path):
        inside = [f for f in matching(spark, f"{entry}/*") if not base_name(f).startswith(("_", "."))]
        found += inside or [entry]
    return found


def _regular(reader: DataFrameReader, path: str, header: list[str]) -> bool:
    """Whether the header is as written: the reader renames a blank or repeated cell."""
    written = reader.option("header", False).csv(path).first()
    reader.option("header", True)
    return written is not None and list(written) == header


def _without_headers(rows: DataFrame, cells: list[str], written: list[str | None]) -> DataFrame:
    """Rows that were read with their headers as rows: these are compared, and go.

    A file's first row is that with the least number in its first block. The
    numbers follow from the split alone, so both passes over the files agree.
    """
    whole = F.concat_ws("\x1f", *[F.coalesce(quoted(c), F.lit("\x1e")) for c in cells])
    heads = (
        rows.where("_block_start = 0")
        .groupBy(F.col("_path").alias("_head_of"))
        .agg(F.min("_row_seq").alias("_head_seq"), F.min_by(whole, "_row_seq").alias("_head"))
    )
    joined = rows.join(heads, F.col("_path") == F.col("_head_of"), "left")
    other = F.col("_head") != F.lit("\x1f".join("\x1e" if c is None else c for c in written))
    message = F.concat(F.lit("another header in "), F.col("_source_file"))
    alike = F.when(other, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return joined.where(alike & (F.col("_row_seq") != F.col("_head_seq"))).drop("_head_of", "_head_seq", "_head")


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    separator: str,
    encoding: str,
    pad_short_rows: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header, every column a string, plus :data:`SEQUENCE_COLUMNS`.

    An empty cell is NULL. A row with more cells than the header fails the job;
    a row with fewer is padded with NULL, or fails it when ``pad_short_rows``
    is off. Quoted cells may hold line breaks, which keeps a file in one task;
    ``multi_line=False`` reads large files that have none in parallel blocks.
    All ``paths`` must share one header; a file with another fails the job. In
    block mode a record with an open quote, which a line break has cut, does too.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", separator)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("inferSchema", False)
    )
    located = [paths] if isinstance(paths, str) else list(paths)
    # The first file's header, by the reader before a schema is set on it.
    first = next(iter(files_below(spark, located[0])), located[0])
    header = reader.csv(first).columns
    if not header:
        raise MalformedFile(f"empty file: {first}")
    regular = _regular(reader, first, header)
    written = None if regular else list(reader.option("header", False).csv(first).first())
    # Where the reader had to rename cells it can't compare headers, so they are read as rows.
    # Every column is parsed, so that headers and row lengths are checked whatever is read.
    reader.option("header", regular).option("enforceSchema", not regular).option("columnPruning", False)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
    rows = (
        reader.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(located)
    )
    rows = rows.select(
        *[quoted(c) for c in header],
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block_start"),
        F.monotonically_increasing_id().alias("_row_seq"),
        F.col(CORRUPT),
    )
    if not regular:
        rows = _without_headers(rows, header, written)
    bad = F.col(CORRUPT).isNotNull()
    if pad_short_rows:
        bad = bad & _too_long(F.col(CORRUPT), separator, len(header))
    if not multi_line:
        quotes = F.length(CORRUPT) - F.length(F.replace(F.col(CORRUPT), F.lit('"')))
        bad = bad | (F.col(CORRUPT).isNotNull() & (quotes % 2 == 1))
    # The message names a cell, for the reader refuses a query on the corrupt column alone.
    begins = F.coalesce(F.substring(quoted(header[0]), 1, 20), F.lit(""))
    message = F.concat(F.lit("malformed row in "), F.col("_source_file"), F.lit(", after "), begins)
    fine = F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return rows.where(fine).drop(CORRUPT, "_path")


def separators(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files below a path by the separator of their own header line.

    A job reads the first line of a file and no more of it; several run at once.
    Files without a line are left out.
    """
    files = files_below(spark, path)
    if not files:
        raise FileNotFoundError(path)
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        lines = list(pool.map(lambda file: spark.read.text(file).first(), files))
    found: dict[str, list[str]] = {}
    for file, line in zip(files, lines):
        if line is not None:
            found.setdefault(choose_separator(line[0]), []).append(file)
    if not found:
        raise MalformedFile(f"empty file: {path}")
    return found


def read_csv_detected(spark: SparkSession, path: str, *, encoding: str, **options) -> DataFrame:
    """:func:`read_csv` with the separator found in each file's header.

    Files of one separator are one read and share one header. Where a path has
    files of both, their rows are put together by column name.
    """
    found = separators(spark, path)
    reads = [
        read_csv(spark, files if len(found) > 1 else path, separator=separator, encoding=encoding, **options)
        for separator, files in sorted(found.items())
    ]
    together = union_drifted(reads)
    cells = [c for c in together.columns if c not in SEQUENCE_COLUMNS]
    return together.select(*[quoted(c) for c in cells], *SEQUENCE_COLUMNS)


def year_in_name(name: str, pattern: str) -> int | None:
    """Year captured by the first group of ``pattern``, or ``None``."""
    found = re.search(pattern, name)
    return int(found.group(1)) if found else None


def year_of_file(pattern: str) -> Column:
    """:func:`year_in_name` over the file a row comes from."""
    text = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return F.when(text != "", text.try_cast("int"))


def read_json_pages(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    whole_file: bool = True,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Pages of JSON records, every column a string, in ``_source_file`` order.

    ``whole_file`` reads a page as one JSON array; otherwise one record per
    line. Without a schema all pages are read once to find their keys.
    Nested values become their JSON text. A broken page or line fails the job.
    """
    reader = (
        spark.read.option("multiLine", whole_file)
        .option("primitivesAsString", True)
        .option("mode", "FAILFAST")
    )
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.json(paths)
    columns = [
        (
            F.to_json(quoted(f.name))
            if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
            else quoted(f.name).cast("string")
        ).alias(f.name)
        for f in rows.schema.fields
    ]
    return rows.select(
        *columns,
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_block_start"),
        F.monotonically_increasing_id().alias("_row_seq"),
    )


def read_page_payloads(spark: SparkSession, pattern: str) -> DataFrame:
    """Saved API answers, one per file, as ``page`` (number in the name) and ``payload``."""
    if not matching(spark, pattern):
        raise FileNotFoundError(pattern)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.json$", 1)
    return spark.read.text(pattern, wholetext=True).select(
        number.cast("bigint").alias("page"), F.col("value").alias("payload")
    )
