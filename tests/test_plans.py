"""Physical-plan properties that matter at scale."""

from kpistar.plans import dims, reports
from kpistar.registry import domain

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_period_filter_reaches_the_scan(spark):
    d = domain(spark, SF_SMALL)
    plan = _plan(reports.kpi_rows.__wrapped__(d))          # the plan that writes the report's rows
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_fact_sides_are_never_broadcast(spark):
    import re
    d = domain(spark, SF_SMALL)
    plan = _plan(reports.kpi_rows.__wrapped__(d))
    # events meet participations in a shuffle join on the event id, whatever the size estimate
    assert re.search(r"SortMergeJoin \[id#\d+L\], \[_fact0#\d+L\], Inner", plan)
    assert not re.search(r"Broadcast\w*Join \[[^]]*\], \[_fact0", plan)


def test_scan_reads_only_needed_columns(spark):
    d = domain(spark, SF_SMALL)
    from kpistar.plans.blocks import scan_alias
    plan = _plan(scan_alias(d))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in plan


def test_dimension_broadcast_is_size_checked(spark):
    from kpistar.operators.joins import LIMIT_KEY, bounded_broadcast, estimated_bytes
    d = domain(spark, SF_SMALL)
    chain = dims.region_chain(d)
    assert estimated_bytes(chain) < 10 * 1024 * 1024
    hinted = bounded_broadcast(chain)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" in hinted
    spark.conf.set(LIMIT_KEY, "1")          # one session setting holds for every lookup
    try:
        assert bounded_broadcast(d.participations) is d.participations
        for df in (reports.kpi_rows.__wrapped__(d), reports.kpi_report(d, ordered=False)):
            assert "BroadcastHint" not in df._jdf.queryExecution().analyzed().toString()
            assert "strategy=broadcast" not in df._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.unset(LIMIT_KEY)


def _jobs(spark, make) -> int:
    spark.sparkContext.setJobGroup("plan-only", "plan-only")
    try:
        make()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_scans_and_filters_build_no_dimension(spark):
    """Schema inference of the parquet files apart, nothing runs before the action."""
    from kpistar.registry import QUERIES
    from kpistar.sources.domain import Domain
    from kpistar import registry
    registry._DOMAINS.clear()
    d = registry.domain(spark, SF_SMALL)
    for name in ("seminar_events", "participations", "users", "seminars"):
        getattr(d, name)                    # reads the files' schemas
    for key in ("scan_dump", "scan_alias", "project_rename", "filter_time_range", "filter_or_ranges", "filter_year_in", "date_extract", "flag_presence"):
        QUERIES[key](spark, SF_SMALL)       # the legacy tables' schemas, too
        assert _jobs(spark, lambda: QUERIES[key](spark, SF_SMALL)) == 0, key
    written = {f for f in Domain.__dict__ if f in d.__dict__} & {"regions", "posts", "brands", "region_hierarchies"}
    assert not written


def test_reports_run_no_job_once_their_dimensions_are_written(spark):
    from kpistar.registry import QUERIES
    for key in ("report_kpi", "report_kpi_brand", "report_legacy_kpi", "report_legacy_salon", "report_education_star", "window_running_count"):
        QUERIES[key](spark, SF_SMALL)
        assert _jobs(spark, lambda: QUERIES[key](spark, SF_SMALL)) == 0, key


def test_a_cluster_without_a_shared_folder_is_refused():
    import pytest
    from kpistar.session import _local_folder
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            _local_folder(master, "app")
    assert _local_folder("local[2]", "app") == _local_folder("local[2]", "app")


def test_a_changed_source_gets_a_new_domain(spark, tmp_path):
    import os
    import shutil
    from kpistar import registry
    for f in os.listdir(SF_SMALL):
        shutil.copyfile(f"{SF_SMALL}/{f}", tmp_path / f)
    first = registry.domain(spark, str(tmp_path))
    assert registry.domain(spark, str(tmp_path)) is first
    os.utime(tmp_path / "region.parquet", (1, 1))
    assert registry.domain(spark, str(tmp_path)) is not first


def test_report_rows_come_out_in_sheet_order(spark):
    """ORDER BY started_at, event, participation holds across partitions ."""
    import datetime
    d = domain(spark, SF_SMALL)
    rows = reports.kpi_report(d).select("smr_id", "smr_start_date").collect()
    keys = [(datetime.datetime.strptime(r.smr_start_date, "%d.%m.%Y"), r.smr_id) for r in rows]
    assert keys == sorted(keys)
