"""Tables with a commit log: one transaction a replacement, races, crashes, added columns."""

from __future__ import annotations

import threading
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.columns import columns
from lamina.operators.contracts import Audit, ContractViolation, TableSpec
from lamina.sinks import tables
from lamina.sinks.versioned import Conflict, Table
from lamina.sources import folders

OLD, DAY = date(2026, 6, 9), date(2026, 6, 10)


def rows(spark, n, day=DAY):
    return spark.range(n).select("id", F.lit(day).alias("d"))


@pytest.fixture
def stored(spark, tmp_path):
    return Table(spark, str(tmp_path / "table"))


def test_partitions_are_replaced_alone(spark, stored):
    assert not stored.exists() and stored.values() == []
    assert stored.replace_partition(rows(spark, 5, OLD), "d", OLD) == 5
    assert stored.replace_partition(rows(spark, 7), "d", DAY) == 7
    assert stored.replace_partition(rows(spark, 3), "d", DAY) == 3
    assert {r["d"]: r["count"] for r in stored.read().groupBy("d").count().collect()} == {OLD: 5, DAY: 3}
    assert stored.values() == [str(OLD), str(DAY)]
    assert stored.replace_partition(rows(spark, 0, OLD), "d", OLD) == 0
    assert stored.values() == [str(DAY)] and stored.read().count() == 3
    assert stored.read(version=2).count() == 12
    assert "PartitionFilters: [isnotnull(d" in stored.read().where(F.col("d") == DAY)._jdf.queryExecution().toString()


def test_a_row_of_another_partition_fails(spark, stored):
    stored.replace_partition(rows(spark, 5), "d", DAY)
    for stray in (OLD, None):
        mixed = rows(spark, 2).union(spark.range(1).select("id", F.lit(stray).cast("date")))
        with pytest.raises(Exception, match="row outside partition"):
            stored.replace_partition(mixed, "d", DAY)
    assert stored.versions() == [1] and stored.read().count() == 5


def test_odd_partition_values(spark, stored):
    for value in ("a/b:c", "d=e", "plain", None, "1"):
        made = spark.range(3).withColumn("k", F.lit(value).cast("string"))
        assert stored.replace_partition(made, "k", value) == 3
    found = stored.read().groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in found} == {"a/b:c": 3, "d=e": 3, "plain": 3, None: 3, "1": 3}


def test_a_whole_table_is_replaced(spark, stored):
    assert stored.replace(spark.range(5)) == 5
    assert stored.replace(spark.range(0)) == 0
    assert stored.read().collect() == [] and stored.read().columns == ["id"]
    with pytest.raises(ValueError, match="partitioned by None"):
        stored.replace_partition(rows(spark, 1), "d", DAY)
    with pytest.raises(FileNotFoundError):
        Table(spark, stored.path + "-none").read()


def test_of_two_writers_one_fails_cleanly(spark, stored):
    stored.replace_partition(rows(spark, 5), "d", DAY)

    class Slow(Table):
        def _commit(self, made):
            # Another writer is through between this one's first look and its commit.
            Table(self.spark, self.path).replace_partition(rows(self.spark, 2, OLD), "d", OLD)
            super()._commit(made)

    with pytest.raises(Conflict):
        Slow(spark, stored.path).replace_partition(rows(spark, 9), "d", DAY)
    assert stored.versions() == [1, 2] and stored.read().count() == 7
    known = {p[0] for p in stored.snapshot().parts.values()}
    found = {"/".join(f.rsplit("/", 2)[1:]) for f in folders.matching(spark, f"{stored.path}/d=*/*")}
    assert found == known
    assert stored.replace_partition(rows(spark, 9), "d", DAY) == 9


def test_writers_at_once_lose_nothing(spark, stored):
    stored.replace_partition(rows(spark, 1, OLD), "d", OLD)
    done, lost = [], []

    def write(n):
        day = date(2026, 7, n)
        for _ in range(20):
            try:
                stored.replace_partition(rows(spark, n, day), "d", day)
                return done.append(n)
            except Conflict:
                lost.append(n)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(1, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(done) == [1, 2, 3, 4]
    assert stored.read().count() == 1 + 1 + 2 + 3 + 4
    assert len(stored.versions()) == 5


def test_a_reader_always_finds_a_version(spark, stored):
    stored.replace_partition(rows(spark, 4), "d", DAY)
    stop, seen, problems = threading.Event(), [], []

    def look():
        while not stop.is_set():
            try:
                seen.append(stored.read().count())
            except Exception as problem:
                problems.append(problem)

    reader = threading.Thread(target=look)
    reader.start()
    for _ in range(6):
        stored.replace_partition(rows(spark, 4), "d", DAY)
    stop.set()
    reader.join()
    assert not problems and set(seen) == {4}


@pytest.mark.parametrize("step", ["data", "prepared", "rename"])
def test_a_crash_at_any_step_leaves_the_old_version(spark, stored, monkeypatch, step):
    stored.replace_partition(rows(spark, 4), "d", DAY)

    class Crash(BaseException):
        pass

    def crash(*_):
        raise Crash

    def half(spark, text, location):
        # The entry under its other name, half written.
        parent, _, name = location.rpartition("/")
        with open(f"{parent}/.{name}-x", "w") as out:
            out.write(text[:20])
        raise Crash

    if step == "data":
        monkeypatch.setattr(Table, "_commit", crash)
    else:
        monkeypatch.setattr(folders, "publish_text", half if step == "prepared" else crash)
    with pytest.raises(Crash):
        stored.replace_partition(rows(spark, 9), "d", DAY)
    monkeypatch.undo()
    assert stored.read().count() == 4
    assert stored.replace_partition(rows(spark, 9), "d", DAY) == 9
    assert stored.read().count() == 9
    assert stored.vacuum(keep=1, older_than_seconds=0) == 2
    assert stored.read().count() == 9 and stored.versions() == [2]


def test_vacuum_keeps_what_versions_list(spark, stored):
    for n in range(1, 5):
        stored.replace_partition(rows(spark, n), "d", DAY)
    assert stored.vacuum(keep=2) == 0  # too young
    assert stored.versions() == [3, 4]
    assert stored.vacuum(keep=2, older_than_seconds=0) == 2
    assert stored.read(version=3).count() == 3 and stored.read().count() == 4


def test_added_columns_have_defaults(spark, stored):
    with pytest.raises(FileNotFoundError):
        stored.add_column("x", T.LongType())
    stored.replace_partition(rows(spark, 2, OLD), "d", OLD)
    assert stored.add_column("x", T.LongType(), 7)
    assert stored.add_column("day", T.DateType(), "2026-01-02")
    assert not stored.add_column("x", T.LongType(), 8)
    with pytest.raises(ValueError, match="x is bigint"):
        stored.add_column("x", T.StringType())
    newer = rows(spark, 1).select("id", "d", F.lit(1).cast("bigint").alias("x"), F.lit(DAY).alias("day"))
    stored.replace_partition(newer, "d", DAY)
    # A writer that doesn't know the new columns yet.
    stored.replace_partition(rows(spark, 1, date(2026, 6, 1)), "d", date(2026, 6, 1))
    found = sorted((str(r["d"]), r["id"], r["x"], str(r["day"])) for r in stored.read().collect())
    assert found == [
        ("2026-06-01", 0, 7, "2026-01-02"),
        ("2026-06-09", 0, 7, "2026-01-02"),
        ("2026-06-09", 1, 7, "2026-01-02"),
        ("2026-06-10", 0, 1, "2026-06-10"),
    ]
    assert stored.read().columns == ["id", "d", "x", "day"]
    assert stored.read(version=1).columns == ["id", "d"]
    with pytest.raises(ValueError, match="no column y"):
        stored.replace_partition(newer.withColumn("y", F.lit(1)), "d", DAY)
    with pytest.raises(ValueError, match="no column x"):
        stored.replace_partition(newer.withColumn("x", F.lit("a")), "d", DAY)


def test_a_load_that_breaks_its_contract_leaves_no_version(spark, stored):
    spec = TableSpec("t", columns("id bigint not null, d date not null"), key=("id",), ranges={"id": (0, 5)}, partition="d")
    assert stored.load(rows(spark, 5), spec, DAY) == 5
    with pytest.raises(ContractViolation, match="contract of t broken") as found:
        stored.load(rows(spark, 9).union(rows(spark, 2)), spec, DAY)
    assert found.value.counts == {("range", "id"): 3, ("duplicate", "id"): 2}
    with pytest.raises(ContractViolation, match="duplicate"):
        stored.load(rows(spark, 2).union(rows(spark, 2)), spec, DAY)
    assert stored.versions() == [1]


def test_builds_at_once_have_versions_of_their_own(spark, tmp_path):
    path = str(tmp_path / "gold")
    first, second = tables._claimed(spark, path), tables._claimed(spark, path)
    assert first != second
    assert tables.rebuild(spark.range(3), path) == 3
    assert tables.read_rebuilt(spark, path).count() == 3


# --- several partitions at once, appended rows --------------------------------


def test_several_partitions_are_one_transaction(spark, stored):
    days = [date(2026, 6, d) for d in (1, 2, 3)]
    three = rows(spark, 4, days[0]).union(rows(spark, 5, days[1])).union(rows(spark, 6, days[2]))
    assert stored.replace_partitions(three, "d", days, notes={"inputs": {"a": "1"}}) == 15
    assert stored.versions() == [1] and stored.snapshot().notes == {"inputs": {"a": "1"}}
    kept = stored.snapshot().parts[f"d={days[0]}"]
    # The second day is replaced, the third has no rows any more, the first one stays as it is.
    assert stored.replace_partitions(rows(spark, 2, days[1]), "d", days[1:]) == 2
    assert stored.values() == [str(days[0]), str(days[1])]
    assert stored.snapshot().parts[f"d={days[0]}"] == kept
    assert stored.snapshot().notes == {"inputs": {"a": "1"}}
    assert stored.replace_partition(rows(spark, 1, days[2]), "d", days[2]) == 1
    assert stored.read().count() == 7
    assert stored.replace_partitions(rows(spark, 0), "d", []) == 0 and stored.read().count() == 7
    for stray in (days[0], None):
        mixed = rows(spark, 2, days[1]).union(spark.range(1).select("id", F.lit(stray).cast("date")))
        with pytest.raises(Exception, match="row outside the given partitions"):
            stored.replace_partitions(mixed, "d", days[1:])
    assert stored.read().count() == 7 and not folders.matching(spark, f"{stored.path}/prepared-*")


def test_odd_values_of_several_partitions(spark, stored):
    values = ["a/b:c", "d=e", None, "1"]
    made = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, k string")
    assert stored.replace_partitions(made, "k", values) == 4
    assert {(r["id"], r["k"]) for r in stored.read().collect()} == set(enumerate(values))


def test_several_partitions_keep_the_contract(spark, stored):
    spec = TableSpec("t", columns("id bigint not null, d date not null"), key=("id", "d"), partition="d")
    double = rows(spark, 3).union(rows(spark, 3))
    with pytest.raises(ContractViolation, match="duplicate"):
        stored.replace_partitions(double, "d", [DAY], Audit(spec))
    assert not stored.exists() and not folders.matching(spark, f"{stored.path}/*/*")
    assert stored.replace_partitions(rows(spark, 3), "d", [DAY], Audit(spec)) == 3


def test_appended_rows_and_compaction(spark, stored):
    assert not stored.exists()
    for n in (2, 3, 4):
        assert stored.append(spark.range(n).select("id", F.lit(n).alias("n"))) == n
    before = sorted(map(tuple, stored.read().collect()))
    assert len(stored.snapshot().parts) == 3
    assert stored.compact() and not stored.compact()
    assert len(stored.snapshot().parts) == 1 and sorted(map(tuple, stored.read().collect())) == before
    stored.append(spark.range(1).select("id", F.lit(9).alias("n")))
    assert stored.read().count() == 10 and stored.read(version=3).count() == 9
    assert stored.replace(spark.range(1).select("id", F.lit(1).alias("n"))) == 1
    assert stored.read().count() == 1


def test_writers_that_append_at_once_both_stay(spark, stored):
    stored.append(spark.range(1))
    writers = [threading.Thread(target=stored.append, args=(spark.range(n),)) for n in (10, 100, 1000)]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert stored.read().count() == 1111 and stored.versions() == [1, 2, 3, 4]


def test_compaction_meets_other_writers(spark, stored, monkeypatch):
    for n in (1, 2):
        stored.append(spark.range(n))
    write = Table._write

    def meanwhile(step):
        def run(self, df, folder):
            made = write(self, df, folder)
            monkeypatch.setattr(Table, "_write", write)
            step()
            return made

        monkeypatch.setattr(Table, "_write", run)

    meanwhile(lambda: stored.append(spark.range(5)))
    assert stored.compact() and len(stored.snapshot().parts) == 2 and stored.read().count() == 8
    meanwhile(lambda: stored.replace(spark.range(4)))
    with pytest.raises(Conflict):
        stored.compact()
    assert stored.read().count() == 4
