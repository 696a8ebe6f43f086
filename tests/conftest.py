from __future__ import annotations

import os
import sys
import time
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lamina.session import SETTINGS  # noqa: E402

os.environ["TZ"] = "UTC"  # collected timestamps are in the local zone
time.tzset()

DAY = date(2026, 6, 10)
NOW = datetime(2026, 6, 10, 12, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("lamina-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Apply an expression to a list of strings and return the results in order."""

    def run(cells, expression):
        rows = [(i, cell) for i, cell in enumerate(cells)]
        df = spark.createDataFrame(rows, "i int, x string").selectExpr("i", f"{expression} AS y")
        return [r["y"] for r in df.orderBy("i").collect()]

    return run


def staged(spark, rows, columns, source="file.csv"):
    """A staged frame: string cells plus lineage and order columns."""
    schema = ", ".join(f"`{c}` string" for c in columns) + ", _row_seq bigint"
    df = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], schema)
    return df.selectExpr(
        "*",
        "0L AS _block_start",
        "TIMESTAMP '2026-06-10 12:00:00' AS _ingested_at",
        f"'{source}' AS _source_file",
        "'hash' AS _source_hash",
    )


def bed_columns(given):
    """The given bed headers and, behind them, the attributes they leave out."""
    from lamina.plans.sources import BED_NAMES, BED_PLAIN

    present = {BED_NAMES.get(c) for c in given}
    measures = {"LEITOS_EXISTENTES", "LEITOS_SUS"}
    return [*given, *(c for c in BED_PLAIN if BED_NAMES[c] not in present and c not in measures)]


def staged_beds(spark, rows, columns, source="file.csv"):
    every = bed_columns(columns)
    padded = [(*row, *[None] * (len(every) - len(columns))) for row in rows]
    return staged(spark, padded, every, source)
