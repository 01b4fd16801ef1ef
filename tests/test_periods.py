from datetime import date, timedelta

import pytest
from fixtures import ADAPTER
from pyspark.sql import functions as F

from foliozone.functions import dates
from foliozone.plans import periods


def windows(spark, start, end, size):
    return [(r["start"], r["end"], r["label"]) for r in periods.plan_windows(spark, start, end, size).orderBy("window_seq").collect()]


def test_a_year_is_twelve_months(spark):
    got = windows(spark, date(2024, 1, 1), date(2025, 1, 1), "monthly")
    assert len(got) == 12 and got[0] == (date(2024, 1, 1), date(2024, 2, 1), "2024-01")


@pytest.mark.parametrize("size", dates.SIZES)
@pytest.mark.parametrize(
    "start,end",
    [(date(2024, 5, 9), date(2024, 7, 21)), (date(2023, 12, 31), date(2024, 1, 1)), (date(2024, 2, 1), date(2024, 3, 1))],
)
def test_windows_cover_each_day_once(spark, start, end, size):
    got = windows(spark, start, end, size)
    days = [s + timedelta(days=i) for s, e, _ in got for i in range((e - s).days)]
    assert days == [start + timedelta(days=i) for i in range((end - start).days)]


def test_weekly_windows_open_on_the_first_day_of_the_range(spark):
    got = windows(spark, date(2024, 1, 3), date(2024, 1, 20), "weekly")
    assert [g[0] for g in got] == [date(2024, 1, 3), date(2024, 1, 10), date(2024, 1, 17)]
    assert got[-1][1:] == (date(2024, 1, 20), "2024-W03")


def test_inverted_and_unknown_are_refused(spark):
    with pytest.raises(ValueError, match="half-open range"):
        periods.plan_windows(spark, date(2024, 1, 2), date(2024, 1, 2), "daily")
    with pytest.raises(ValueError, match="periods are"):
        periods.plan_windows(spark, date(2024, 1, 1), date(2024, 1, 2), "hourly")
    with pytest.raises(ValueError, match="no body 'x' or 'y'"):
        periods.plan_cells(spark, ADAPTER, date(2024, 1, 1), date(2024, 1, 2), "daily", ("first", "x", "y"))


@pytest.mark.parametrize("size", dates.SIZES)
def test_computed_window_is_the_planned_one(spark, size):
    start, end = date(2023, 12, 20), date(2024, 3, 5)
    planned = windows(spark, start, end, size)
    days = [(start + timedelta(days=i),) for i in range(-5, (end - start).days + 5)]
    w = dates.window_of(F.col("d"), F.lit(start), F.lit(end), size)
    for row in spark.createDataFrame(days, "d DATE").select("d", w.alias("w")).collect():
        inside = [p for p in planned if p[0] <= row["d"] < p[1]]
        assert ([tuple(row["w"])] if row["w"] else []) == inside


def test_cells_keep_request_order_and_repeats(spark):
    cells = periods.plan_cells(spark, ADAPTER, date(2024, 1, 1), date(2024, 3, 1), "monthly", ("second", "first", "second"))
    got = [(r["cell_seq"], r["label"], r["body_code"], r["external_id"]) for r in cells.orderBy("cell_seq").collect()]
    assert got[:4] == [(0, "2024-01", "second", "102"), (1, "2024-01", "first", "101"), (2, "2024-01", "second", "102"), (3, "2024-02", "second", "102")]
    assert len(got) == 6


def test_date_arguments_may_be_text():
    assert {periods.as_date(v) for v in ("05/02/2024", "2024-02-05", " 05-02-2024 ", date(2024, 2, 5))} == {date(2024, 2, 5)}
    with pytest.raises(ValueError, match="no date such as"):
        periods.as_date("5 Feb 2024")


def test_single_window():
    assert periods.window_starting_at(date(2024, 12, 1), "monthly") == (date(2024, 12, 1), date(2025, 1, 1))
    assert periods.window_starting_at(date(2024, 1, 31), "monthly") == (date(2024, 1, 31), date(2024, 2, 1))
    assert periods.window_starting_at(date(2024, 2, 26), "weekly") == (date(2024, 2, 26), date(2024, 3, 4))
    assert periods.window_starting_at(date(2024, 2, 29), "daily") == (date(2024, 2, 29), date(2024, 3, 1))


def test_backfill_grid_holds_complete_windows_only(spark):
    monthly = periods.backfill_cells(spark, ADAPTER, date(2015, 3, 15), "monthly")
    assert sorted({r["label"] for r in monthly.collect()}) == ["2015-01", "2015-02"]
    weekly = periods.backfill_cells(spark, ADAPTER, date(2015, 1, 20), "weekly").select("start").distinct().collect()
    assert sorted(r["start"] for r in weekly) == [date(2015, 1, 4), date(2015, 1, 11)]


def test_coverage_and_gaps(spark):
    cells = periods.plan_cells(spark, ADAPTER, date(2024, 1, 1), date(2024, 3, 1))
    records = spark.createDataFrame([("2024-01", "first")] * 2 + [("2024-02", "third")], "partition_date STRING, body_code STRING")
    held = {(r["label"], r["body_code"]): r["records"] for r in periods.coverage(cells, records).collect()}
    assert held[("2024-01", "first")] == 2 and held[("2024-02", "first")] == 0 and len(held) == 8
    assert periods.missing_cells(cells, records).count() == 6


def test_listing_url_ends_on_the_last_included_day(spark):
    cells = periods.plan_cells(spark, ADAPTER, date(2024, 1, 1), date(2024, 2, 1), "monthly", ("first",))
    urls = [r["url"] for r in periods.request_frontier(cells, ADAPTER, F.lit(3)).orderBy("page_number").collect()]
    assert urls[2] == (
        "https://site.example/en/search/?decisions=1&from=01/01/2024&to=31/01/2024&legislationsub=&body=101&pageNumber=3"
    )
