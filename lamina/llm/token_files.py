"""Token ids of a corpus in files that give any token without decoding others.

Documents are range-partitioned by id, so the files of a written corpus, in
the order of their parts, hold all ids in ascending order of documents. A part
is a list of blocks; a block holds whole documents, their ids and ends, and
the tokens as directly addressable codes (:mod:`lamina.llm.dac`). Blocks are
binary cells of Parquet files, which any store that Spark writes to can hold
and which Spark commits whole or not at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm import dac, frames, wordpieces
from lamina.session import scratch_folder

END = 1  # id that ends a document
TOKENS_PER_BLOCK = 1 << 20
BLOCKS = "part int, within long, n_docs long, n_tokens long, doc_ids binary, ends binary, codes binary"


def _blocks(tokenizer: str, end: int, bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, within = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        tokens: list[bytes] = []
        size = 0

        def close() -> pd.DataFrame:
            ends = np.cumsum([len(t) // 4 for t in tokens])
            codes = dac.encode(np.frombuffer(b"".join(tokens), "<u4"), bits)
            return pd.DataFrame(
                {
                    "part": [part],
                    "within": [within],
                    "n_docs": [len(ids)],
                    "n_tokens": [int(ends[-1])],
                    "doc_ids": [np.array(ids, "<i8").tobytes()],
                    "ends": [ends.astype("<i8").tobytes()],
                    "codes": [codes],
                }
            )

        for doc_id, coded in wordpieces.coded(batches, tokenizer, end):
            ids.append(doc_id)
            tokens.append(coded)
            size += len(coded) // 4
            if size >= TOKENS_PER_BLOCK:
                yield close()
                within, size = within + size, 0
                ids.clear()
                tokens.clear()
        if ids:
            yield close()

    return run


def write(
    docs: DataFrame, path: str, tokenizer: str = wordpieces.TOKENIZER, end: int = END, bits: int = 8
) -> None:
    """Write the ids of every whole text, with the end id behind each, to ``path``.

    A null or empty text is the end id alone. Rows without an id come first;
    rows of one id are ordered by their texts. No rows, no blocks.
    """
    frames.small_batches(docs.sparkSession)
    ordered = (
        frames.whole_text(docs)
        .withColumn("doc_id", F.coalesce("doc_id", F.lit(int(frames.NO_ID))))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    blocks = ordered.mapInPandas(_blocks(tokenizer, end, bits), BLOCKS)
    blocks.write.option("compression", "uncompressed").parquet(path)


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``, the number of tokens before each.

    A block knows the tokens before it in its part. Those before the part come
    from a running sum of one row a part, of which there are no more than the
    files that the driver lists to read them; so that side is broadcast.
    """
    table = spark.read.schema(BLOCKS).parquet(path)
    parts = table.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    running = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = parts.select("part", F.coalesce(F.sum("total").over(running), F.lit(0)).alias("before"))
    return table.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("within"))


def _documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            codes = dac.Reader(row.codes)
            ids = np.frombuffer(row.doc_ids, "<i8")
            ends = np.frombuffer(row.ends, "<i8")
            begins = np.r_[0, ends[:-1]]
            tokens = codes.run(0, len(codes)).astype("<u4").tobytes()
            yield pd.DataFrame(
                {
                    "doc_id": pd.array(np.where(ids == frames.NO_ID, 0, ids), "Int64").copy(),
                    "unnamed": ids == frames.NO_ID,
                    "start": row.start + begins,
                    "n_tokens": ends - begins,
                    "ids": [tokens[4 * i : 4 * j] for i, j in zip(begins.tolist(), ends.tolist())],
                }
            )


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids`` (little-endian u32) of every document in the files."""
    schema = "doc_id long, unnamed boolean, start long, n_tokens long, ids binary"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    found = blocks(spark, path).select("doc_ids", "ends", "codes", "start").mapInPandas(_documents, schema)
    return found.select(
        F.when(~F.col("unnamed"), F.col("doc_id")).alias("doc_id"), "start", "n_tokens", "ids"
    )


def tokens_at(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """``place``, ``token`` for places counted over the whole corpus; beyond its end: no row.

    Each place meets the block that covers it and reads its own chunks alone.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(p, dac.Reader(c)[p - s]) for p, s, c in zip(pdf["place"], pdf["start"], pdf["codes"])]
            yield pd.DataFrame(rows, columns=["place", "token"])

    span = F.lit(TOKENS_PER_BLOCK)
    covers = blocks(spark, path).select("start", (F.col("start") + F.col("n_tokens")).alias("stop"), "codes")
    # A block and a place meet in one of the equal spans that the block reaches into.
    first, last = F.floor(F.col("start") / span), F.floor((F.col("stop") - 1) / span)
    covers = covers.withColumn("span", F.explode(F.sequence(first, last)))
    asked = places.select(F.col("place").cast("long")).where("place IS NOT NULL")
    asked = asked.withColumn("span", F.floor(F.col("place") / span))
    met = asked.join(covers, "span").where("place >= start AND place < stop")
    return met.select("place", "start", "codes").mapInPandas(run, "place long, token long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, read back from the written files."""
    path = scratch_folder(spark, "tokens")
    write(frames.documents(spark, sf_dir), path)
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
