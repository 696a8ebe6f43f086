from __future__ import annotations

from datetime import date, datetime, timezone

import pytest

from lamina.operators import manifest as m

FIRST = (date(2026, 6, 1), datetime(2026, 6, 1, 8, tzinfo=timezone.utc))
SECOND = (date(2026, 6, 8), datetime(2026, 6, 8, 8, tzinfo=timezone.utc))


def listing(spark, *rows):
    """(dataset, year, origin, etag, last_modified, hash, reachable)"""
    full = [
        (d, y, o, e, lm, None, h, f"{o}/{d}/{y}/{h}", ok) for d, y, o, e, lm, h, ok in rows
    ]
    return spark.createDataFrame(full, m.LISTING_SCHEMA)


def known(spark, *rows):
    """(dataset, year, etag, last_modified, hash)"""
    full = [
        (d, y, *FIRST, e, lm, None, h, "remote", f"raw/{h}", f"staged/{h}")
        for d, y, e, lm, h in rows
    ]
    return spark.createDataFrame(full, m.MANIFEST_SCHEMA)


def decide(spark, listed, before=()):
    found = m.classify(listing(spark, *listed), known(spark, *before)).collect()
    return {(r["dataset"], r["year"]): r for r in found}


BEFORE = ("beds", 2020, "e1", "mon", "h1")


@pytest.mark.parametrize(
    ("offer", "status"),
    [
        (("beds", 2020, "remote", "e1", "tue", "h9", True), m.UNCHANGED),  # same tag
        (("beds", 2020, "remote", "e2", "mon", "h9", True), m.UNCHANGED),  # same date
        (("beds", 2020, "remote", "e2", "tue", "h1", True), m.METADATA_ONLY),
        (("beds", 2020, "remote", "e2", "tue", "h2", True), m.NEW),
        (("beds", 2020, "remote", "", "", "h2", True), m.NEW),
        (("beds", 2020, "fallback", None, None, "h1", True), m.UNCHANGED),
        (("beds", 2020, "fallback", None, None, "h2", True), m.NEW),
        (("beds", 2020, "remote", "e1", "mon", "h1", False), m.FAILED),
    ],
)
def test_yearly_decision(spark, offer, status):
    assert decide(spark, [offer], [BEFORE])[("beds", 2020)]["status"] == status


def test_single_file_decision(spark):
    before = ("cnes", None, "e1", "mon", "h1")
    for offer, status in (
        (("cnes", None, "remote", "e1", None, "h2", True), m.UNCHANGED),
        (("cnes", None, "remote", "e2", None, "h1", True), m.UNCHANGED),
        (("cnes", None, "remote", "e2", None, "h2", True), m.NEW),
        (("cnes", None, "fallback", None, None, "h1", True), m.UNCHANGED),
    ):
        assert decide(spark, [offer], [before])[("cnes", None)]["status"] == status


def test_empty_marks_never_match(spark):
    found = decide(
        spark,
        [("beds", 2020, "remote", "", "", "h2", True)],
        [("beds", 2020, "", "", "h1")],
    )
    assert found[("beds", 2020)]["status"] == m.NEW


def test_remote_first_then_fallback(spark):
    found = decide(
        spark,
        [
            ("beds", 2020, "remote", "e2", "tue", "r", True),
            ("beds", 2020, "fallback", None, None, "f", True),
            ("beds", 2021, "remote", "e2", "tue", "r", False),
            ("beds", 2021, "fallback", None, None, "f", True),
        ],
        [BEFORE],
    )
    remote, fallback = found[("beds", 2020)], found[("beds", 2021)]
    assert (remote["source"], remote["source_hash"], remote["etag"]) == ("remote", "r", "e2")
    assert (fallback["source"], fallback["source_hash"], fallback["etag"]) == ("fallback", "f", None)
    assert fallback["raw_path"] == "fallback/beds/2021/f"


def test_known_but_no_longer_offered(spark):
    assert decide(spark, [], [BEFORE])[("beds", 2020)]["status"] == m.FAILED


def test_ingest_cycle(spark):
    years = [("beds", y, "remote", f"e{y}", None, f"h{y}", True) for y in (2020, 2021, 2022)]
    first = m.classify(listing(spark, *years), known(spark))
    assert {r["status"] for r in first.collect()} == {m.NEW}
    table = m.next_records(first, *FIRST).selectExpr(
        "* EXCEPT (parquet_path)", "concat('p', year) AS parquet_path"
    )

    # Nothing changed: nothing to ingest, nothing to append.
    again = m.classify(listing(spark, *years), table)
    assert m.to_ingest(again).count() == 0
    assert m.next_records(again, *SECOND).count() == 0

    # 2021 has new content, 2022 only a new tag.
    years[1] = ("beds", 2021, "remote", "x", None, "changed", True)
    years[2] = ("beds", 2022, "remote", "y", None, "h2022", True)
    third = m.classify(listing(spark, *years), table)
    assert [r["year"] for r in m.to_ingest(third).collect()] == [2021]
    table = table.unionByName(m.next_records(third, *SECOND))
    now = {r["year"]: r for r in m.current(table).collect()}
    assert now[2020]["extraction_date"] == FIRST[0]
    assert (now[2021]["extraction_date"], now[2021]["parquet_path"]) == (SECOND[0], None)
    # The renewed tag still points to the partition that was written.
    assert (now[2022]["etag"], now[2022]["extraction_date"]) == ("y", FIRST[0])
    assert now[2022]["parquet_path"] == "p2022"
    assert m.classify(listing(spark, *years), table).where("status <> 'unchanged'").count() == 0


def test_latest_extraction(spark):
    table = known(spark, BEFORE)
    assert m.latest_extraction_of(table, "beds") == (FIRST[0], "staged/h1")
    with pytest.raises(m.NothingExtracted):
        m.latest_extraction_of(table, "ubs")


def test_pages_that_repeat_a_url_are_one_file_by_the_newest(spark, tmp_path):
    from hashlib import sha256

    from lamina.catalogue.changes import QUERIES

    url, other = "http://a.example/de/1", "http://a.example/en/2"
    texts = ["first", "second", "third"]
    # Whichever hash is the largest, the newest page counts.
    for newest in texts:
        pages = [(n, url, t) for n, t in enumerate([*(x for x in texts if x != newest), newest])]
        pages += [(n + 10, other, t) for n, t, in ((n, p[2]) for n, p in enumerate(pages))]
        folder = str(tmp_path / newest)
        spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
        found = {r["dataset"]: r for r in QUERIES["version_classify"](spark, folder).collect()}
        hashed = sha256(newest.encode()).hexdigest()
        assert {k: (r["status"], r["source_hash"]) for k, r in found.items()} == {
            url: ("unchanged", hashed),
            other: ("new", hashed),
        }
        assert sorted(r["dataset"] for r in QUERIES["manifest_advance"](spark, folder).collect()) == [url, other]
