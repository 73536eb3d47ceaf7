"""The remote relations through the data source: parquet files behind a driver's interface stand for the remote database."""

import os
import tempfile

import pytest

from conftest import SF_SMALL
from kpistar.plans import legacy
from kpistar.sources import jdbc
from kpistar.sources.legacy import LegacyDomain
from kpistar.sources.remote import Ranges, RelationReader, conditions, read_relation

TABLES = {"special_program_club_records": "remote_club_records", "special_program_clubs": "remote_clubs", "payments": "remote_payments"}


@pytest.fixture(scope="module")
def remote(spark):
    """Connections over the remote tables as files; each statement that is run leaves a file."""
    base, folder = LegacyDomain.from_sf(spark, SF_SMALL), tempfile.mkdtemp(prefix="kpistar-remote-", dir="/tmp")
    for name, table in TABLES.items():
        base.table(table).write.parquet(f"{folder}/{name}")
    os.mkdir(f"{folder}/log")
    names = list(TABLES)

    def connect():
        import uuid
        import duckdb

        class Cursor:
            def __init__(self):
                self.files = duckdb.connect()
                for n in names:
                    self.files.execute(f"CREATE VIEW {n} AS FROM read_parquet('{folder}/{n}/*.parquet')")

            def execute(self, sql, values=()):
                with open(f"{folder}/log/{uuid.uuid4().hex}", "w") as f:
                    f.write(f"{sql} -- {list(values)}")
                self.rows = self.files.execute(sql, list(values))

            def fetchmany(self, n):
                return self.rows.fetchmany(n)

        class Connection:
            cursor = staticmethod(Cursor)

            def close(self):
                pass
        return Connection()

    def said():
        out = []
        for n in os.listdir(f"{folder}/log"):
            with open(f"{folder}/log/{n}") as f:
                out.append(f.read())
            os.unlink(f"{folder}/log/{n}")
        return out
    return base, connect, said


def test_reports_through_the_remote_read(spark, remote):
    base, connect, said = remote
    programs = read_relation(spark, connect, jdbc.programs_query(None), jdbc.PROGRAM_SCHEMA, {"brand_id": 1}, Ranges("salon_id", 0, 150, 3), placeholder="?")
    paid = read_relation(spark, connect, jdbc.payments_query(), jdbc.PAYMENT_SCHEMA, ranges=Ranges("seminar_id", 0, 6000, 4), placeholder="?", batch_rows=500)
    local = {t: getattr(base, t) for t in LegacyDomain.TABLES if not t.startswith("remote")}
    given = LegacyDomain.from_tables(local, remote_programs=programs, remote_paid=paid)
    for report in (legacy.legacy_kpi_report, legacy.legacy_salon_report):
        a, b = report(base), report(given)
        assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
    texts = said()
    assert len(texts) >= 7 and all('"brand_id" IN (?)' in t for t in texts if "special_program_clubs" in t)


def test_filters_and_ranges_reach_the_remote_side(spark, remote):
    base, connect, said = remote
    said()
    only = {"brand_id": 5, "status": ["accepted", "invited"]}
    programs = read_relation(spark, connect, jdbc.programs_query(None), jdbc.PROGRAM_SCHEMA, only, Ranges("salon_id", 0, 100, 5), placeholder="?")
    assert programs.rdd.getNumPartitions() == 5
    local = legacy.remote_programs_all(base).where("brand_id = 5 and status in ('accepted', 'invited')")
    rows = sorted(map(tuple, programs.collect()))
    assert rows == sorted(map(tuple, local.collect())) and rows
    texts = said()
    assert len(texts) == 5 and all('"brand_id" IN (?)' in t and '"status" IN (?, ?)' in t and t.endswith("[5, 'accepted', 'invited']") for t in texts)
    # one DataFrame under different filters
    for test in ("salon_id >= 10", "name_prog like '%Expert%'", "true"):
        assert programs.where(test).count() == local.where(test).count()
    # every row is in one range, nulls too
    everything = read_relation(spark, connect, jdbc.programs_query(None), jdbc.PROGRAM_SCHEMA, None, Ranges("salon_id", 30, 60, 4), placeholder="?")
    whole = legacy.remote_programs_all(base)
    assert everything.count() == whole.count() and everything.exceptAll(whole).count() == 0


def test_a_read_of_no_rows_and_of_nulls(spark, remote):
    connect = remote[1]
    assert read_relation(spark, connect, jdbc.payments_query(), jdbc.PAYMENT_SCHEMA, {"brand_id": []}, placeholder="?").collect() == []
    query = "SELECT * FROM (VALUES (1, 'a', NULL), (NULL, 'b', 2.5), (7, NULL, 1)) AS v(k, t, d)"
    rows = read_relation(spark, connect, query, "k int, t string, d decimal(5,2)", ranges=Ranges("k", 0, 10, 3), placeholder="?")
    assert sorted(((r.k, r.t, None if r.d is None else str(r.d)) for r in rows.collect()), key=str) == [(1, "a", None), (7, None, "1.00"), (None, "b", "2.50")]
    assert [r.t for r in read_relation(spark, connect, query, "k int, t string", {"k": None}, placeholder="?").collect()] == ["b"]
    with pytest.raises(ValueError, match="no column"):
        read_relation(spark, connect, query, "k int", {"x": 1})


def test_statements(spark):
    schema = spark.createDataFrame([], 'k int, t string, `a"b` long').schema
    assert conditions({"k": 3, 'a"b': None, "t": ("x", "y")}, schema, "%s") == (['"k" IN (%s)', '"a""b" IS NULL', '"t" IN (%s, %s)'], [3, "x", "y"])
    with pytest.raises(ValueError, match="nulls"):
        conditions({"k": [1, None]}, schema, "?")
    make = lambda only: RelationReader(None, "SELECT '%' AS t", schema, only, None, "%s", 10)
    assert make({}).statement("") == "SELECT \"k\", \"t\", \"a\"\"b\" FROM (SELECT '%' AS t) AS remote_q"
    assert make({"k": 3}).statement("(1 = 1)").endswith("FROM (SELECT '%%' AS t) AS remote_q WHERE \"k\" IN (%s) AND (1 = 1)")
    assert Ranges("k", 0, 10, 1).conditions() == [""] and Ranges("k", 5, 5, 8).conditions() == [""]
    assert Ranges("k", 0, 4, 9).conditions() == ['("k" < 1 OR "k" IS NULL)', '("k" >= 1 AND "k" < 2)', '("k" >= 2 AND "k" < 3)', '("k" >= 3)']
