"""Rows out of landed API pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMPTY_STREAK_TO_STOP = 3


def list_key(payload: Column) -> Column:
    """First key of a JSON object, in document order, whose value is a list."""
    keys = F.json_object_keys(payload)
    lists = F.filter(keys, lambda k: F.json_array_length(_member(payload, k)).isNotNull())
    return F.get(lists, F.lit(0))


def _member(payload: Column, key: Column) -> Column:
    path = F.concat(F.lit("$['"), key, F.lit("']"))
    return F.call_function("get_json_object", payload, path)


def page_items(payload: Column, key: Column, page: Column | None = None) -> Column:
    """The records of a page as JSON strings; a page without that list counts as empty.

    A payload that is no JSON object fails the job with the page's number, and
    so does a key that no page has.
    """
    items = F.from_json(_member(payload, key), "array<string>")
    name = F.lit("?") if page is None else page.cast("string")
    broken = F.raise_error(F.concat(F.lit("page "), name, F.lit(" is not a JSON object")))
    nowhere = F.raise_error(F.lit("no page has a list of records"))
    fails = F.when(F.json_object_keys(payload).isNull(), broken.cast("array<string>")).when(
        key.isNull(), nowhere.cast("array<string>")
    )
    return F.coalesce(fails, items, F.array().cast("array<string>"))


def with_list_key(
    pages: DataFrame, by: Sequence[str] = (), payload: str = "payload", page: str = "page"
) -> DataFrame:
    """Add ``data_key``: the list key of the first page that has one, for all pages."""
    found = pages.select(*by, page, list_key(F.col(payload)).alias("data_key"))
    order = F.when(F.col("data_key").isNotNull(), F.col(page))
    first = found.groupBy(*by).agg(F.min_by("data_key", order).alias("data_key"))
    if by:
        return pages.join(first, list(by), "left")
    return pages.withColumn("data_key", first.scalar())


def pages_before_stop(
    pages: DataFrame,
    items: str = "items",
    page: str = "page",
    by: Sequence[str] = (),
    empty_streak: int = EMPTY_STREAK_TO_STOP,
    max_pages: int | None = None,
) -> DataFrame:
    """Pages a reader would have fetched before ``empty_streak`` empty ones in a row.

    An empty page votes for itself and the next ``empty_streak - 1`` pages; a
    page with a full set of votes ends a streak, and the first such page is the
    stop. That is two hash aggregations over page numbers; there is no window
    over all pages. Page numbers are offsets starting at 0 without gaps.
    """
    empty = pages.where(F.size(items) == 0).select(*by, page)
    number = F.col(page).cast("bigint")
    reach = F.sequence(number, number + F.lit(empty_streak - 1).cast("bigint"))
    votes = empty.select(*by, F.explode(reach).alias(page))
    stops = (
        votes.groupBy(*by, page)
        .agg(F.count(F.lit(1)).alias("votes"))
        .where(F.col("votes") >= empty_streak)
        .groupBy(*by)
        .agg(F.min(page).alias("__stop"))
    )
    if by:
        marked = pages.join(stops, list(by), "left")
    else:
        marked = pages.withColumn("__stop", stops.scalar())
    kept = marked.where(F.col("__stop").isNull() | (F.col(page) < F.col("__stop"))).drop("__stop")
    return kept if max_pages is None else kept.where(F.col(page) < max_pages)


def paged_rows(
    pages: DataFrame,
    items: str = "items",
    page: str = "page",
    by: Sequence[str] = (),
    empty_streak: int = EMPTY_STREAK_TO_STOP,
    max_pages: int | None = None,
) -> DataFrame:
    """One row per record, with its page and its position on the page."""
    kept = pages_before_stop(pages, items, page, by, empty_streak, max_pages)
    return kept.select(*by, page, F.posexplode(items).alias("position", "item"))


def paging_stats(rows: DataFrame, page: str = "page", by: Sequence[str] = ()) -> DataFrame:
    """Records and last page with records, per group."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_items"), F.max(page).alias("last_nonempty_page")
    )
