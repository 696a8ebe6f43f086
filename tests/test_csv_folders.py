"""CSV folders of many part files: headers, counts and separators."""

from __future__ import annotations

import pytest

from lamina.sources.raw import SEQUENCE_COLUMNS, MalformedFile, read_csv, read_csv_detected, separators

MODES = pytest.mark.parametrize("multi_line", [True, False])


def parts(folder, bodies, header="id;name"):
    folder.mkdir(exist_ok=True)
    for n, body in enumerate(bodies):
        (folder / f"part-{n:05d}.csv").write_text(header + "\n" + body, encoding="utf-8")
    return str(folder)


def read(spark, path, multi_line):
    return read_csv(spark, path, separator=";", encoding="UTF-8", multi_line=multi_line)


@MODES
def test_two_parts_of_one_header(spark, tmp_path, multi_line):
    path = parts(tmp_path / "two", ["1;a\n2;b\n", "3;c\n"])
    rows = read(spark, path, multi_line)
    assert sorted(map(tuple, rows.drop(*SEQUENCE_COLUMNS).collect())) == [("1", "a"), ("2", "b"), ("3", "c")]
    assert rows.count() == 3


@MODES
def test_two_hundred_parts(spark, tmp_path, multi_line):
    path = parts(tmp_path / "many", [f"{n};x\n{n};y\n" for n in range(200)])
    rows = read(spark, path, multi_line)
    assert rows.count() == 400
    assert rows.select("id").distinct().count() == 200
    assert rows.select("_source_file").distinct().count() == 200


@MODES
@pytest.mark.parametrize("at", [0, 1, 7])
def test_another_header_fails(spark, tmp_path, multi_line, at):
    path = parts(tmp_path / f"other{at}", [f"{n};x\n" for n in range(8)])
    (tmp_path / f"other{at}" / f"part-{at:05d}.csv").write_text("id;title\n9;z\n")
    rows = read(spark, path, multi_line)
    with pytest.raises(Exception, match="(?i)header"):
        rows.collect()
    with pytest.raises(Exception, match="(?i)header"):
        rows.count()


@MODES
@pytest.mark.parametrize("header", ["id;;name", "id;name;name", "id;name;NAME", ";;"])
def test_blank_and_repeated_header_cells(spark, tmp_path, multi_line, header):
    path = parts(tmp_path / "odd", ["1;p;a\n", "2;q;b\n3;r;c\n"], header)
    rows = read(spark, path, multi_line)
    found = sorted(map(tuple, rows.drop(*SEQUENCE_COLUMNS).collect()))
    assert found == [("1", "p", "a"), ("2", "q", "b"), ("3", "r", "c")]
    assert rows.count() == 3
    assert len(set(rows.columns)) == len(rows.columns)


@MODES
def test_another_header_fails_beside_blank_cells(spark, tmp_path, multi_line):
    path = parts(tmp_path / "oddother", ["1;p;a\n", "2;q;b\n"], "id;;name")
    (tmp_path / "oddother" / "part-00001.csv").write_text("id;x;name\n2;q;b\n")
    for action in ("collect", "count"):
        with pytest.raises(Exception, match="another header in part-00001"):
            getattr(read(spark, path, multi_line), action)()


@MODES
def test_a_row_equal_to_the_header_is_a_row(spark, tmp_path, multi_line):
    for name, header in (("plain", "id;name"), ("blank", "id;")):
        path = parts(tmp_path / name, [f"{header}\n1;a\n"], header)
        assert read(spark, path, multi_line).count() == 2


@MODES
def test_parts_without_rows(spark, tmp_path, multi_line):
    path = parts(tmp_path / "empty", ["", "1;a\n", ""])
    assert read(spark, path, multi_line).count() == 1


@MODES
def test_counting_checks_the_rows(spark, tmp_path, multi_line):
    path = parts(tmp_path / "long", ["1;a\n", "2;b;c\n"])
    with pytest.raises(Exception, match="malformed row in part-00001"):
        read(spark, path, multi_line).count()


@MODES
def test_columns_are_checked_even_if_one_is_read(spark, tmp_path, multi_line):
    path = parts(tmp_path / "pruned", ["1;a\n", "2;b\n"])
    (tmp_path / "pruned" / "part-00001.csv").write_text("id;other\n2;b\n")
    with pytest.raises(Exception, match="(?i)header"):
        read(spark, path, multi_line).select("id").collect()


def mixed(folder):
    folder.mkdir()
    (folder / "a.csv").write_text("id;name\n1;x,y\n2;z\n")
    (folder / "b.csv").write_text("name,id\np;q,3\n")
    (folder / "c.csv").write_text("id;name\n4;u\n")
    (folder / "_SUCCESS").write_text("")
    return str(folder)


@MODES
def test_each_file_has_its_own_separator(spark, tmp_path, multi_line):
    path = mixed(tmp_path / "mixed")
    assert {s: len(f) for s, f in separators(spark, path).items()} == {";": 2, ",": 1}
    rows = read_csv_detected(spark, path, encoding="UTF-8", multi_line=multi_line)
    assert rows.columns[-3:] == list(SEQUENCE_COLUMNS)
    found = sorted((r["id"], r["name"], r["_source_file"]) for r in rows.collect())
    assert found == [("1", "x,y", "a.csv"), ("2", "z", "a.csv"), ("3", "p;q", "b.csv"), ("4", "u", "c.csv")]
    assert rows.count() == 4


def test_files_without_a_line_decide_nothing(spark, tmp_path):
    path = mixed(tmp_path / "mixed")
    (tmp_path / "mixed" / "0.csv").write_text("")
    assert sum(len(f) for f in separators(spark, path).values()) == 3
    assert read_csv_detected(spark, path, encoding="UTF-8").count() == 4
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "0.csv").write_text("")
    with pytest.raises(MalformedFile):
        read_csv_detected(spark, str(tmp_path / "none"), encoding="UTF-8")


def test_one_separator_may_still_have_one_header_only(spark, tmp_path):
    path = mixed(tmp_path / "mixed")
    (tmp_path / "mixed" / "d.csv").write_text("id;title\n5;v\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_detected(spark, path, encoding="UTF-8").collect()
