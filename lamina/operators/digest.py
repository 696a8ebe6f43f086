"""Content hashes of files, hash trees of any size, and order-independent digests of row sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.session import scratch_folder

CELL_LIMIT_BYTES = 256 << 20
FAN = 4096  # hashes that one node of a tree combines

# A 256-bit hash is added up as four 64-bit words. Sums are exact: decimal(38,0)
# holds 2**62 such words before it could overflow.
_WORDS = range(4)


def row_digest(value: Column) -> list[Column]:
    """The four 64-bit words of a value's SHA-256, as decimals."""
    hex_text = F.sha2(value, 256)
    return [
        F.conv(F.substring(hex_text, 16 * w + 1, 16), 16, 10).cast("decimal(20,0)")
        for w in _WORDS
    ]


def set_digest(df: DataFrame, code: str, by: Sequence[str] = ()) -> DataFrame:
    """Digest of the non-empty ``code`` values, per group or over everything.

    Independent of row order, and a repeated value counts every time. The words
    of the single hashes are summed, which is a partial aggregation with five
    numbers per group, however large a group is; no list of values is built.
    The result columns are ``codes`` (how many) and ``digest`` (hex).
    """
    kept = df.where(F.col(code).isNotNull() & (F.col(code) != ""))
    words = [w.alias(f"w{i}") for i, w in enumerate(row_digest(F.col(code)))]
    sums = (
        kept.select(*by, *words)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("codes"),
            *[F.sum(f"w{i}").cast("decimal(38,0)").alias(f"w{i}") for i in _WORDS],
        )
    )
    parts = [F.col("codes").cast("string")] + [
        F.coalesce(F.col(f"w{i}"), F.lit(0)).cast("string") for i in _WORDS
    ]
    return sums.select(*by, "codes", F.sha2(F.concat_ws("|", *parts), 256).alias("digest"))


def row_sums(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """``by`` and ``content``: whether the rows of a group are the same ones, whatever their order.

    Two 64-bit hashes of every row with other seeds are added up beside the
    count: one partial aggregation over the given columns. Nulls count, also
    which column holds them. To compare states of one's own tables, not to
    guard against forged ones.
    """
    cells = [c for name in columns for c in (F.col(name), F.col(name).isNull())]
    sums = [F.sum(F.xxhash64(*cells, F.lit(seed)).cast("decimal(20,0)")).cast("decimal(38,0)") for seed in (0, 1)]
    counts = [F.count(F.lit(1)), *sums]
    return df.groupBy(by).agg(F.concat_ws("|", *[c.cast("string") for c in counts]).alias("content"))


def payload_identity(df: DataFrame, code: str, by: Sequence[str] = ()) -> DataFrame:
    """Identity of the non-empty ``code`` values: ``codes`` and ``identity``.

    The :func:`set_digest` at every size: it ignores the order, counts repeats
    and keeps apart values that only look alike when they are joined.
    """
    return set_digest(df, code, by).withColumnRenamed("digest", "identity")


def _listed(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)


def file_hashes(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """SHA-256 of every file's bytes: ``path, length, source_hash``.

    A file is one binary cell of a task, read through Hadoop's file system
    whatever store it is in. Such a hash is one sequence, so a file over
    ``CELL_LIMIT_BYTES`` is an error here; :func:`tree_hashes` takes any size.
    """
    files = _listed(spark, paths)
    over = files.where(F.col("length") > CELL_LIMIT_BYTES).select("path").limit(5).collect()
    if over:
        raise ValueError(f"too large for one cell, use tree_hashes: {[r['path'] for r in over]}")
    return files.select("path", "length", F.sha2("content", 256).alias("source_hash"))


def _combined(hashes: DataFrame) -> DataFrame:
    """One level of the trees: up to ``FAN`` hashes in a row become one. A finished tree stays."""
    groups = hashes.groupBy("tree", "nodes", F.floor(F.col("n") / FAN).alias("n"))
    row = groups.agg(F.array_sort(F.collect_list(F.struct("n", "hash"))).alias("row"))
    joined = F.sha2(F.array_join("row.hash", ""), 256)
    return row.select(
        "tree",
        F.ceil(F.col("nodes") / FAN).alias("nodes"),
        "n",
        F.when(F.col("nodes") > 1, joined).otherwise(F.col("row")[0]["hash"]).alias("hash"),
    )


def _roots(leaves: DataFrame, piece: Sequence[str], tree: str, place: str) -> DataFrame:
    """``tree, lines, root``: the hash trees over ``leaves``, whose ``hash`` is binary.

    The leaves of a ``piece`` have ascending ids without gaps; the pieces of a
    ``tree`` go by ``place``. Leaves before a piece are a running sum with one
    row a piece. Leaves are written once, so that their ids stay, and shuffled
    once by place; no group exceeds ``FAN`` hashes.
    """
    spark = leaves.sparkSession
    scratch = scratch_folder(spark, "leaves")
    leaves.write.parquet(scratch)
    leaves = spark.read.schema(leaves.schema).parquet(scratch)
    pieces = leaves.groupBy(*piece).agg(F.min("id").alias("first"), F.count("*").alias("held"))
    placed = pieces.select(*piece, "first", "held", F.expr(tree).alias("tree"), F.expr(place).alias("place"))
    before = Window.partitionBy("tree").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")
    totals = placed.groupBy("tree").agg(F.sum("held").alias("lines"))
    firsts = placed.select(*piece, "tree", shift.alias("shift")).join(totals, "tree")
    level = leaves.join(firsts, list(piece)).select(
        "tree",
        F.col("lines").alias("nodes"),
        (F.col("id") + F.col("shift")).alias("n"),
        F.lower(F.hex("hash")).alias("hash"),
    )
    most = totals.agg(F.max("lines")).first()[0] or 0
    while most > 1:
        level, most = _combined(level), -(-most // FAN)
    return totals.join(level.select("tree", F.col("hash").alias("root")), "tree")


def sorted_digest(df: DataFrame, code: str, by: Sequence[str] = ()) -> DataFrame:
    """Digest of the sorted non-empty ``code`` values: ``codes`` (how many) and ``digest``.

    The root of a hash tree (see :func:`tree_hashes`) over the distinct values in
    byte order, whose leaves are SHA-256 hashes of ``count:value``. Unlike
    :func:`set_digest` it can be checked part by part, and a value's place can be
    shown from a few hashes. Repeats are counted before the sort by ranges, so
    neither a hot value nor a hot group is one task. Without values, no row.
    """
    kept = df.where(F.col(code).isNotNull() & (F.col(code) != ""))
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    counted = kept.select(group.alias("group"), F.col(code).alias("value")).groupBy("group", "value")
    counted = counted.agg(F.count(F.lit(1)).alias("times"))
    ordered = counted.repartitionByRange("group", "value").sortWithinPartitions("group", "value")
    leaves = ordered.select(
        "group",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("id"),
        F.unhex(F.sha2(F.concat_ws(":", "times", "value"), 256)).alias("hash"),
    )
    roots = _roots(leaves, ["group", "part"], "group", "part")
    codes = kept.groupBy(group.alias("tree")).agg(F.count(F.lit(1)).alias("codes"))
    return roots.join(codes, "tree").select(
        *[F.col("tree")[name].alias(name) for name in by], "codes", F.col("root").alias("digest")
    )


def tree_hashes(spark: SparkSession, root: str, by_folder: bool = False) -> DataFrame:
    """Hash tree over the lines of every file: ``path, length, lines, source_hash``.

    With ``by_folder`` the part files of a folder, in the order of their tasks,
    are one file. The leaves are SHA-256 hashes of lines (bytes between
    newlines, as they are), made in the tasks that scan the blocks of a file;
    each level above hashes the hex hashes of ``FAN`` neighbours, joined, until
    one is left, the root. ``source_hash`` is the SHA-256 of ``length:lines:root``.
    It depends on the file's bytes alone: how the file is split into blocks, or
    into parts at line ends, and what else is listed does not matter. The length
    tells whether a last newline is there. Empty files have no row, as Spark's
    readers skip them. No bytes of a file pass through the driver or one task.
    """
    name = "regexp_replace(path, '/[^/]+$', '')" if by_folder else "path"
    # Parts sort by task and file number, as Spark names them; other files by name.
    part = "regexp_extract_all(regexp_extract(path, '/part-([0-9]+-.*?[.-]c[0-9]+)[^/]*$', 1), '(^[0-9]+|[0-9]+$)', 1)"
    place = f"struct(transform({part}, x -> bigint(x)) AS part, path, block)"
    sizes = _listed(spark, root).select("path", "length").selectExpr(f"{name} AS tree", "length")
    sizes = sizes.groupBy("tree").agg(F.sum("length").alias("length"))

    scan = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(root)
    leaves = scan.select(
        # As binaryFile spells a path: decoded, not as a URI.
        F.expr("url_decode(replace(_metadata.file_path, '+', '%2B'))").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        F.unhex(F.sha2(F.col("value").cast("binary"), 256)).alias("hash"),
    )
    return sizes.join(_roots(leaves, ["path", "block"], name, place), "tree").select(
        F.col("tree").alias("path"),
        "length",
        "lines",
        F.sha2(F.concat_ws(":", "length", "lines", "root"), 256).alias("source_hash"),
    )
