"""Reporting rules on the hand-written fixture (FIXTURES 4): one assertion per quirk."""

import pytest
from pyspark.sql import functions as F

from kpistar.config import ReportParams
from kpistar.plans import dims, reports

import edge_fixture

PARAMS = ReportParams(period=(("1996-01-01", "1997-01-01"),), years=("1996",), brand_code="AM")


@pytest.fixture(scope="module")
def dom(spark):
    return edge_fixture.build(spark)


@pytest.fixture(scope="module")
def r4(dom):
    return reports.kpi_report(dom, PARAMS, ordered=False).cache()


def _rows(df, cond):
    return df.where(cond).collect()


def test_fanout_row_count(r4):
    # p1: 2 memberships x 2 payments, p2: 1, p3: 1; every row doubled by the two-post educator
    assert r4.where("smr_id = 1").count() == 12


def test_emit_once_counts_inflated_by_fanout(r4):
    first = _rows(r4, "smr_id = 1 AND uniq_smr_id IS NOT NULL")
    assert len(first) == 1
    assert first[0].users_count == 10          # joined participant rows, not people
    assert first[0].clients_count == 10
    assert first[0].smr_paid == 4800           # 8 x 100 (15 % -> 10 %) + 2 x 1000 + 2 x 1000
    assert r4.where("smr_id = 1 AND users_count IS NOT NULL").count() == 1


def test_running_count_ties_share_value(r4):
    nums = {r.master_name: r.user_num for r in r4.where("smr_id = 1").select("master_name", "user_num").collect()}
    assert nums["Master Eve"] == 8             # all rows of p1 share the RANGE value
    assert nums[None] in (8, 10)
    got = sorted({(r.user_num) for r in r4.where("smr_id = 1").collect()})
    assert got == [8, 10]


def test_dedup_person_once_per_event(r4):
    ids = [r.user_id for r in r4.where("smr_id = 1 AND user_id IS NOT NULL").collect()]
    assert sorted(ids) == [20, 21, 22]


def test_empty_event(r4):
    (row,) = _rows(r4, "smr_id = 2")
    assert row.status_seminar_users == "no_users"
    assert row.users_count == 0 and row.user_num == 0 and row.clients_count == 0
    # the amount-due CASE does not test for a participant: the empty row owes the full cost once
    assert row.smr_paid == 1000 and row.user_must_pay == 1000


def test_salon_brand_status_and_other_brand_region(r4):
    st = {(r.master_name, r.salon_brand_status, r.com_mreg) for r in r4.where("smr_id = 1").collect()}
    assert ("Master Eve", "brand_salon", "AMERICA") in st
    assert (None, "not_salon", None) in st
    assert (None, "other_brand", "EUROPE") in st          # user 22 has no first name -> NULL name


def test_studio_without_centre_row(r4):
    (row,) = _rows(r4, "smr_id = 3")
    assert row.type_place == "studio" and row.id_place == 5 and row.name_place is None
    assert row.role_name == "education_director"
    assert row.old_smr_id == "33333"                     # concat skips NULL legacy ids


def test_brand_falls_back_to_kpi_type(r4):
    (row,) = _rows(r4, "smr_id = 4")
    assert row.brand == "Consultations" and row.smr_cost_type == "paid"


def test_brand_report_classes_and_level_aware_roles(dom):
    r5 = reports.kpi_brand_report(dom, PARAMS, ordered=False)
    classes = {r.smr_id: r.kpi_class for r in r5.select("smr_id", "kpi_class").distinct().collect()}
    assert classes == {1: "Brand Day", 2: "Brand Day", 3: "studios seminars"}
    roles = {r.role_name for r in r5.where("smr_id = 1").collect()}
    assert roles == {"technolog", "manager"}


def test_staff_hierarchy_levels(dom):
    h = {(r.user_id, r.region_id): r for r in dims.staff_hierarchy(dom).collect()}
    tech = h[(4, 1000)]
    assert (tech.n1_full_name, tech.n2_full_name, tech.n3_full_name) == ("Manager Cid", "Regional Bob", "Director Ann")
    mgr = h[(3, 100)]
    assert (mgr.n1_full_name, mgr.n2_full_name, mgr.n3_full_name) == (None, "Regional Bob", "Director Ann")
    reg = h[(2, 10)]
    assert (reg.n1_full_name, reg.n2_full_name, reg.n3_full_name) == (None, None, "Director Ann")
    fixed = {(r.user_id, r.region_level): r for r in dims.staff_hierarchy_fixed(dom).collect()}
    assert fixed[(2, 4)].n1_full_name == "Director Ann"     # fixed generations ignore the level


def test_full_outer_membership(dom):
    rows = dims.users_salons_dim(dom).collect()
    assert any(r.salon_id == 13 and r.user_id is None for r in rows)   # salon without members
    assert any(r.salon_id is None and r.user_id == 23 for r in rows)   # member of a missing salon


def test_nobrand_salons_exclude_test_region(dom, spark):
    extra = spark.createDataFrame([("p9", 1, 23, None)], dom.participations.schema)
    members = dom.users_salons.unionByName(spark.createDataFrame([(23, 14)], dom.users_salons.schema))
    dom2 = type(dom).from_tables({**{t: getattr(dom, t) for t in dom.TABLES}, "users_salons": members,
                                  "participations": dom.participations.unionByName(extra)})
    got = {(r.salon_id, r.com_mreg_name) for r in dims.nobrand_salons(dom2, PARAMS).collect()}
    assert got == {(12, "EUROPE")}                                     # ASIA is excluded


def test_educator_id_and_role_use_different_priorities(spark):
    """partimer first for the educator id and name, technolog first for the role lookup."""
    from types import SimpleNamespace
    from kpistar.plans import blocks
    sem = spark.createDataFrame(
        [(1, None, 5, 7, None, "P5", "T7", "X"), (2, None, None, None, 9, "P", "T", "R9")],
        "id long, studio_id long, partimer_id long, technolog_id long, partner_id long, "
        "partimer_full_name string, technolog_full_name string, partner_full_name string")
    users = spark.createDataFrame([(5, "partimer"), (7, "technolog"), (9, "partner")], "id long, role string")
    studios = spark.createDataFrame([], "id long, studio_type string")
    ld = SimpleNamespace(seminars=sem, users=users, studios=studios)
    ids = {r.id: (r.educater_id, r.educater) for r in blocks.coalesce_chain(ld).collect()}
    assert ids == {1: (5, "P5"), 2: (9, "R9")}
    roles = {r.id: r.edu_role for r in blocks.scalar_subquery_lookup(ld).collect()}
    assert roles == {1: "technolog", 2: "partner"}


def test_salon_zero_is_a_salon_and_trip_rule(spark):
    from types import SimpleNamespace
    from kpistar.plans import blocks
    sem = spark.createDataFrame(
        [(1, 0, True, False), (2, None, False, True), (3, 7, None, True), (4, None, None, False)],
        "id long, salon_id long, trip boolean, business_trip boolean")
    ld = SimpleNamespace(seminars=sem)
    kinds = {r.id: r.place_kind for r in blocks.predicate_not_in_null(ld).collect()}
    assert kinds == {1: "SALON", 2: "NOT_SALON", 3: "SALON", 4: "NOT_SALON"}   # NOT IN ('0') only tests NULL
    trips = {r.id: r.trip_flag for r in blocks.case_trip(ld).collect()}
    # trip IS TRUE -> 1; otherwise (false or NULL) the business-trip flag decides
    assert trips == {1: 1, 2: 1, 3: 1, 4: 0}


def test_programme_with_null_status_is_empty(spark):
    from types import SimpleNamespace
    from kpistar.plans import legacy
    ld = SimpleNamespace(
        remote_programs=None, remote_club_records=spark.createDataFrame(
            [(None, 1, 10), ("accepted", 2, 11), ("invited", 3, 11)], "status string, club_id int, salon_id int"),
        remote_clubs=spark.createDataFrame(
            [(1, "Expert 1997", 1), (2, "Emotion 1996", 1), (3, "МБК 1997", 1)], "id int, name string, brand_id int"),
        salons=spark.createDataFrame([(10,), (11,), (12,)], "id long"))
    got = {(r.salon_id, r.club, r.emotion) for r in legacy.program_salons(ld).collect()}
    assert got == {(10, "Empty | Empty", "Empty | Empty"),      # matched programme, NULL status
                   (11, "Empty | 1997", "1996 | Empty"),
                   (12, "Empty | Empty", "Empty | Empty")}      # no programme at all


def test_participant_without_a_user_row_is_not_counted(dom):
    """W4, W5, W8 count the joined user: p2's user has no row, so only p1 (two memberships) and p3 count."""
    from kpistar.plans import blocks
    first = blocks.window_count(dom).where("event_id = 1 AND users_count IS NOT NULL").collect()
    assert len(first) == 1 and first[0].users_count == 3
    nums = {(r.prt_id, r.user_num) for r in blocks.window_running_count(dom).where("event_id = 1").collect()}
    assert nums == {("p1", 2), ("p2", 2), ("p3", 3)}
    flags = {r.event_id: r.status_seminar_users for r in blocks.window_presence_flag(dom).collect()}
    assert flags[1] == "attend" and flags[2] == "no_users"


def test_numeric_cost_and_three_decimal_coefficient(spark, dom):
    from decimal import Decimal
    from kpistar.functions import discount_due
    from kpistar.sources.domain import Domain
    rows = spark.createDataFrame([(Decimal("1005.50"), Decimal("15.00")), (Decimal("1005.50"), None), (Decimal("0.00"), Decimal("15.00"))], "cost decimal(10,2), pct decimal(8,2)")
    got = [r[0] for r in rows.select(discount_due(F.col("cost"), F.col("pct"), integral=False)).collect()]
    assert got == [Decimal("100.55"), Decimal("1005.50"), None]
    whole = spark.createDataFrame([(1005, Decimal("15.00"))], "cost long, pct decimal(8,2)")
    assert whole.select(discount_due(F.col("cost"), F.col("pct"))).first()[0] == 100
    tables = {t: getattr(dom, t) for t in Domain.TABLES}
    tables["training_centers"] = spark.createDataFrame([(6, "TC6", "x6", Decimal("1.125"), 0, 10)],
                                                       "id long, name string, address string, costs_coefficient decimal(6,3), center_type int, region_id long")
    values = {str(r.costs_coefficient) for r in dims.places(Domain.from_tables(tables)).collect()}
    assert "1.125" in values


def test_date_label_of_a_seminar_without_booking(spark):
    from kpistar.plans import blocks
    from kpistar.sources.legacy import LegacyDomain
    from conftest import SF_SMALL
    base = LegacyDomain.from_sf(spark, SF_SMALL)
    tables = {t: getattr(base, t) for t in LegacyDomain.TABLES}
    tables["seminar_records"] = base.seminar_records.where("seminar_id % 2 = 0")
    out = blocks.date_interval_days(LegacyDomain.from_tables(tables))
    none = out.where("booking_at IS NULL").collect()
    assert none and all(r.status_booking == "" and r.prebooking_day is None for r in none)


def test_a_second_row_of_a_scalar_lookup_is_refused(spark):
    """One studio id twice: an error where a seminar asks for it, none where nobody does."""
    from kpistar.operators.joins import single_row_lookup
    seminars = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 99)], "id long, studio_id long")
    studios = spark.createDataFrame([(10, "studio"), (11, "classroom"), (12, "studio"), (12, "classroom"), (None, "x"), (None, "y")], "sid long, studio_type string")
    got = single_row_lookup(seminars, F.col("studio_id"), studios, "sid", {"studio_type": "kind"})
    assert {(r.id, r.kind) for r in got.collect()} == {(1, "studio"), (2, "classroom"), (3, None), (4, None)}
    twice = studios.unionByName(spark.createDataFrame([(10, "studio")], studios.schema))
    with pytest.raises(Exception, match="more than one row returned by a lookup of sid 10"):
        single_row_lookup(seminars, F.col("studio_id"), twice, "sid", {"studio_type": "kind"}).collect()
    empty = single_row_lookup(seminars, F.col("studio_id"), studios.limit(0), "sid", {"studio_type": "kind"})
    assert empty.where("kind is null").count() == 4
