from __future__ import annotations

from datetime import datetime

import pytest

from lamina.functions import cleaning, geo, measures
from lamina.sources.raw import choose_separator, separator_of


def test_sentinels_become_null(evaluate):
    cells = [" nulo ", "n/a", "NaN", "", " ", "None", "NULL", "na", None]
    assert evaluate(cells, cleaning.clean_text("x")) == [None] * len(cells)


def test_text_keeps_inner_blanks(evaluate):
    cells = [" A B\t", "　x\x85", "nulos", "​"]
    assert evaluate(cells, cleaning.clean_text("x")) == ["A B", "x", "nulos", "​"]


def test_blank_characters_are_the_unicode_white_space():
    assert len(cleaning.WHITE_SPACE) == len(set(cleaning.WHITE_SPACE)) == 25
    others = {"\x1c", "\x1d", "\x1e", "\x1f"}  # str.isspace() has these four on top
    found = {chr(c) for c in range(0x110000) if chr(c).isspace()} - others
    assert set(cleaning.WHITE_SPACE) == found


def test_flag_from_number(evaluate):
    cells = ["1.0", "0.0", "0.5", "x", None, " 1.0", "1.0d", "7e-1"]
    expected = [True, False, False, None, None, None, None, True]
    assert evaluate(cells, cleaning.flag_from_number("x")) == expected


def test_flag_from_word(evaluate):
    cells = ["True", "FALSE", " true", "1", None]
    assert evaluate(cells, cleaning.flag_from_word("x")) == [True, False, None, None, None]


def test_latitude(evaluate):
    cells = ["0.0", "-35", "-35.01", "6", "abc", "nan", "inf", "1e-7", None]
    expected = [None, -35.0, None, 6.0, None, None, None, None, None]
    assert evaluate(cells, geo.coordinate("x", *geo.LATITUDE_RANGE)) == expected


def test_longitude_with_decimal_comma(evaluate):
    cells = [" -43,99 ", "-75,0", "-32,9", " -50,5", "1,2,3"]
    expected = [-43.99, -75.0, None, -50.5, None]
    assert evaluate(cells, geo.coordinate_decimal_comma("x", *geo.LONGITUDE_RANGE)) == expected


def test_strict_count(evaluate):
    cells = ["12", "13.0", "x", None, "-1", " 13 ", "+5", "99999999999999999999"]
    assert evaluate(cells, cleaning.strict_count("x")) == [12, 0, 0, 0, -1, 0, 5, 0]


def test_lenient_count(evaluate):
    cells = ["13.0", "13.9", "-2", "x", None, "-0.5", "NaN", "inf", "1e30", "1.5d"]
    expected = [13, 13, 0, 0, 0, 0, None, None, None, 0]
    assert evaluate(cells, cleaning.lenient_count("x")) == expected


def test_timestamps(evaluate):
    cells = ["2022-01-17T03:00:00.000Z", "2022", "2022-01", "2022-01-17", "garbage", None]
    found = evaluate(cells, cleaning.utc_timestamp("x"))
    assert found == [datetime(2022, 1, 17, 3)] + [None] * 5


def test_timestamp_offsets_are_utc(evaluate):
    text = f"date_format({cleaning.utc_timestamp('x')}, 'yyyy-MM-dd HH:mm:ss')"
    assert evaluate(["2021-01-01T00:30:00+03:00"], text) == ["2020-12-31 21:30:00"]


def test_zero_fill_and_lpad(evaluate):
    cells = ["12", "12345678", "-1", "+12", "", "1234567", None]
    filled = ["0000012", "12345678", "-000001", "+000012", "0000000", "1234567", None]
    padded = ["0000012", "1234567", "00000-1", "0000+12", "0000000", "1234567", None]
    assert evaluate(cells, cleaning.zero_fill("x", 7)) == filled
    assert evaluate(cells, "lpad(x, 7, '0')") == padded


def test_leading_year(evaluate):
    assert evaluate(["202101", "2021", "20a1xx", None], cleaning.leading_year("x")) == [
        2021,
        2021,
        None,
        None,
    ]


@pytest.mark.parametrize(
    ("total", "rows", "mean"), [(1, 8, "0.13"), (201, 200, "1.01"), (0, 3, "0.00"), (-1, 8, "-0.13")]
)
def test_rounded_mean(spark, total, rows, mean):
    df = spark.sql(f"SELECT {measures.rounded_mean(f'{total}L', f'{rows}L')} AS m")
    assert str(df.first()["m"]) == mean


def test_ratio_and_overload(spark):
    rows = spark.createDataFrame(
        [(5, 0), (11, 10), (10, 10), (1, 3), (5, None)], "peak bigint, cap bigint"
    ).selectExpr(measures.ratio("peak", "cap") + " AS r", measures.exceeds("peak", "cap") + " AS e")
    found = [(None if r["r"] is None else str(r["r"]), r["e"]) for r in rows.collect()]
    assert found == [
        (None, False),
        ("1.1000", True),
        ("1.0000", False),
        ("0.3333", False),
        (None, False),
    ]


def test_point(spark):
    row = spark.sql(
        f"SELECT {geo.point('-43.5D', '-20D')} AS p, {geo.point('-43.5D', 'cast(NULL AS double)')}"
        f" AS q, {geo.point_wkt('-43.5D', '-20.0D')} AS w"
    ).first()
    assert row["p"].asDict() == {"srid": 4326, "lon": -43.5, "lat": -20.0}
    assert row["q"] is None
    assert row["w"] == "SRID=4326;POINT(-43.5 -20.0)"


def test_radius_keeps_exactly_the_near_points(spark):
    import math

    points = [(i, -60 + i * 0.37, -20 + i * 0.21) for i in range(60)]
    df = spark.createDataFrame(points, "id int, nu_longitude double, nu_latitude double")
    found = {r["id"] for r in geo.within_radius(df, -48.0, -14.0, 500_000).collect()}

    def metres(lon, lat):
        a = (
            math.sin(math.radians(lat + 14) / 2) ** 2
            + math.cos(math.radians(-14))
            * math.cos(math.radians(lat))
            * math.sin(math.radians(lon + 48) / 2) ** 2
        )
        return 2 * geo.EARTH_RADIUS_M * math.asin(math.sqrt(a))

    assert found == {i for i, lon, lat in points if metres(lon, lat) <= 500_000}
    assert 0 < len(found) < 60


@pytest.mark.parametrize(
    ("header", "separator"),
    [("a,b;c,d", ","), ("a;b", ";"), ("a", ","), ("a,b;c", ","), ("a;b;c,d", ";")],
)
def test_separator(evaluate, header, separator):
    assert choose_separator(header) == separator
    assert evaluate([header], separator_of("x")) == [separator]
