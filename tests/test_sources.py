"""Sources and sinks: domain mapping shape, report sink, remote query text."""

import os
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from kpistar.operators.skewsafe import running_sum
from kpistar.sources import jdbc
from kpistar.sources.domain import Domain
from kpistar.sources.sinks import write_report

from conftest import SF_SMALL


def test_domain_tables_have_declared_keys(spark):
    d = Domain.from_sf(spark, SF_SMALL)
    assert d.participations.select("id").distinct().count() == d.participations.count()
    hier = d.region_hierarchies.groupBy("generations").count().orderBy("generations").collect()
    assert [r.generations for r in hier] == [0, 1, 2, 3]


def test_report_sink_rejects_duplicate_names_and_partitions(spark):
    out = tempfile.mkdtemp(prefix="kpistar-sink-", dir="/tmp")
    df = spark.createDataFrame([(1996, "a"), (1997, "b")], "year int, v string")
    write_report(df, os.path.join(out, "sheet"), partition_by=["year"])
    back = spark.read.parquet(os.path.join(out, "sheet"))
    assert sorted(r.year for r in back.collect()) == [1996, 1997]
    dup = df.select("year", "v", F.col("v").alias("v"))
    with pytest.raises(ValueError):
        write_report(dup, os.path.join(out, "dup"))


def test_remote_queries_filter_the_tenant_remotely():
    assert "WHERE c.brand_id = 1" in jdbc.programs_query(1)
    assert "WHEN 1 THEN 'loreal'" in jdbc.programs_query(1) and "NULL AS brand" not in jdbc.programs_query(1)
    assert "SELECT DISTINCT brand_id, master_id, seminar_id" in jdbc.payments_query() and "WHERE" not in jdbc.payments_query()
    assert "WHERE brand_id = 5" in jdbc.payments_query(5)


def test_domains_over_given_tables_and_remote_results(spark):
    """R1 and R2 over given DataFrames, the remote relations as results of the declared schemas."""
    from kpistar.plans import legacy
    from kpistar.sources.legacy import LegacyDomain
    base = LegacyDomain.from_sf(spark, SF_SMALL)
    programs, paid = legacy.remote_programs_all(base).where("brand_id = 1"), legacy.payments_flag(base)
    assert programs.schema.simpleString() == spark.createDataFrame([], jdbc.PROGRAM_SCHEMA).schema.simpleString()
    assert [f.dataType for f in paid.schema] == [f.dataType for f in spark.createDataFrame([], jdbc.PAYMENT_SCHEMA).schema]
    local = {t: getattr(base, t) for t in LegacyDomain.TABLES if not t.startswith("remote")}
    given = LegacyDomain.from_tables(local, remote_programs=programs, remote_paid=paid)
    for report in (legacy.legacy_kpi_report, legacy.legacy_salon_report):
        a, b = report(base), report(given)
        assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
    with pytest.raises(ValueError, match="remote_club_records"):
        LegacyDomain.from_tables(local, remote_paid=paid)
    with pytest.raises(ValueError, match="missing tables"):
        Domain.from_tables({"brands": programs})


def test_report_sink_leaves_the_session_as_it_is(spark, tmp_path):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode", None)
    df = spark.createDataFrame([(1996, "a"), (1997, "b")], "year int, v string")
    write_report(df, str(tmp_path / "s"), partition_by=["year"])
    write_report(df.where("year = 1996").withColumn("v", F.lit("new")), str(tmp_path / "s"), partition_by=["year"])
    assert sorted((r.year, r.v) for r in spark.read.parquet(str(tmp_path / "s")).collect()) == [(1996, "new"), (1997, "b")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", None) == before


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30), st.one_of(st.none(), st.integers(0, 9))),
                min_size=1, max_size=60, unique_by=lambda t: (t[0], t[1])))
def test_running_sum_property(spark, rows):
    df = spark.createDataFrame(rows, "g long, o long, v long")
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = sorted(tuple(r) for r in df.withColumn("s", F.sum("v").over(w)).collect())
    got = sorted(tuple(r) for r in running_sum(df, ["g"], ["o"], "v", "s").select("g", "o", "v", "s").collect())
    assert want == got
