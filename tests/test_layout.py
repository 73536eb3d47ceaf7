"""Facts laid out by event: months pruned in the scan, buckets joined without an exchange; versions of a sheet."""

import re

import pytest
from pyspark.sql import functions as F

from kpistar.config import ReportParams
from kpistar.plans import blocks, reports
from kpistar.registry import domain
from kpistar.sources import layout, sinks

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def laid(spark):
    return layout.by_event(domain(spark, SF_SMALL), buckets=4)


def _subtree(plan: str, line: str) -> list[str]:
    """The lines of a plan's node, itself first, down to its leaves."""
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if re.search(line, x))
    depth = lambda x: re.search(r"[A-Za-z*(]", x).start()
    end = next((i for i in range(at + 1, len(lines)) if depth(lines[i]) <= depth(lines[at])), len(lines))
    return lines[at:end]


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("params", [ReportParams(), ReportParams(period=(("1995-02-10", "1995-02-11"), ("1997-12-31", "1998-01-02")), report_tz="Asia/Tokyo")])
def test_sheets_over_the_layout_are_the_same(spark, laid, params):
    plain = domain(spark, SF_SMALL)
    assert _rows(reports.kpi_report(laid, params, ordered=False)) == _rows(reports.kpi_report(plain, params, ordered=False))


def test_other_queries_over_the_layout_are_the_same(spark, laid):
    plain = domain(spark, SF_SMALL)
    for make in (reports.kpi_brand_report, blocks.window_count, blocks.join_left_fanout):
        assert _rows(make(laid)) == _rows(make(plain)), make


def test_events_meet_participations_without_an_exchange(spark, laid):
    plan = reports.kpi_rows.__wrapped__(laid)._jdf.queryExecution().executedPlan().toString()
    join = _subtree(plan, r"SortMergeJoin \[id#\d+L\], \[_fact0#\d+L\], Inner")
    assert not [x for x in join if "Exchange" in x and "BroadcastExchange" not in x]
    plain = reports.kpi_rows.__wrapped__(domain(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert [x for x in _subtree(plain, r"SortMergeJoin \[id#\d+L\], \[_fact0#\d+L\], Inner") if "Exchange hashpartitioning(id" in x]


def test_the_period_prunes_months_of_both_facts(spark, laid):
    plan = reports.kpi_rows.__wrapped__(laid)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x and re.search("kpistar_(events|participations)_", x)]
    assert len(scans) == 4 and all(re.search(r"PartitionFilters: \[[^]]*event_month#\d+ >= 1995-12-01", x) for x in scans)
    df = layout.in_months(laid.participations, ReportParams().period)
    assert 0 < len(df.inputFiles()) and len({f for f in df.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}) < len(laid.participations.inputFiles())


# ------------------------------------------------------------ versions of a sheet
SHEET = "month string, id long, paid decimal(10,2), place string"


def _sheet(spark, rows):
    return spark.createDataFrame(rows, SHEET)


def test_a_late_correction_rewrites_its_period_alone(spark, tmp_path):
    from decimal import Decimal as D
    path = f"file://{tmp_path}/kpi sheet"
    first = [("1996-01", 1, D("5.00"), "a"), ("1996-01", 2, None, "b"), ("1996-02", 3, D("7.00"), None), (None, 4, None, None), ("x/y=%", 5, None, "c")]
    assert sinks.refresh_report(_sheet(spark, first), path, "month") == ["1996-01", "1996-02", "none", "x/y=%"]
    reader = sinks.read_report(spark, path)
    files = set(reader.inputFiles())
    assert sorted(map(repr, reader.collect())) == sorted(map(repr, _sheet(spark, first).collect()))
    assert sinks.refresh_report(_sheet(spark, first[::-1]), path, "month") == []          # the order does not matter
    # a value moves between columns, a row is repeated, a period ends, one begins
    second = [first[0], ("1996-01", 2, D("1.00"), None), first[2], first[2], first[3], ("1996-03", 9, None, "n")]
    assert sinks.refresh_report(_sheet(spark, second), path, "month") == ["1996-01", "1996-02", "1996-03"]
    now = sinks.read_report(spark, path)
    assert sorted(map(repr, now.collect())) == sorted(map(repr, _sheet(spark, second).collect()))
    assert files & set(now.inputFiles())                                                   # the unchanged period's file
    assert sorted(map(repr, reader.collect())) == sorted(map(repr, _sheet(spark, first).collect()))   # who was reading goes on


def test_a_refresh_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/sheet"
    sinks.refresh_report(_sheet(spark, [("m", 1, None, "a")]), path, "month")
    with monkeypatch.context() as m:
        m.setattr(sinks, "_swap", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            sinks.refresh_report(_sheet(spark, [("m", 2, None, "b")]), path, "month")
    assert [r.id for r in sinks.read_report(spark, path).collect()] == [1]
    assert sinks.refresh_report(_sheet(spark, [("m", 2, None, "b")]), path, "month") == ["m"]
    assert [r.id for r in sinks.read_report(spark, path).collect()] == [2]
    assert sinks.refresh_report(_sheet(spark, []), path, "month") == []
    assert sinks.read_report(spark, path).count() == 0 and sinks.read_report(spark, path).columns == ["month", "id", "paid", "place"]


def test_the_report_refreshed_by_month(spark, tmp_path):
    d, path = domain(spark, SF_SMALL), f"file://{tmp_path}/kpi"
    sheet = reports.kpi_report(d, ordered=False).withColumn("period", F.concat_ws("-", "year", "month"))
    written = sinks.refresh_report(sheet, path, "period")
    assert sinks.read_report(spark, path).count() == sheet.count() and len(written) == sheet.select("period").distinct().count()
    late = sheet.withColumn("payment", F.when((F.col("year") == 1996) & (F.col("month") == 5), F.lit(1).cast("decimal(10,2)")).otherwise(F.col("payment")).cast(sheet.schema["payment"].dataType))
    assert sinks.refresh_report(late, path, "period") == ["1996-5"]
