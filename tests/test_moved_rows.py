"""Rows of a fact are moved once for a measure, few columns at a time, and no fact-sized table is broadcast."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from kpistar.operators import skewsafe
from kpistar.operators.joins import MANY, large_key_pieces, left_join_many
from kpistar.operators.materialize import materialize
from kpistar.plans import blocks, dims, facts, legacy, reports
from kpistar.registry import domain, legacy_domain
from kpistar.sources.domain import Domain

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _same_rows(want, got):
    got = got.select(*want.columns)
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0


def _rows(spark, n=25_000):
    """Two large groups (one of NULL) and small ones, with tied and repeated rows."""
    return spark.range(n).select(F.expr("if(id % 5 < 2, null, if(id % 5 < 4, 1, id % 700 + 2))").alias("g"), (F.col("id") % 3).alias("u"),
                                 F.expr("if(id % 37 = 0, null, concat('k', id * 7919 % 4001))").alias("o"), F.expr("if(id % 11 = 0, null, id)").alias("v"))


def test_written_rows_are_read_twice_for_a_running_count(spark):
    d = domain(spark, SF_SMALL)
    for make in (blocks.window_row_number, blocks.window_running_count):
        assert _plan(make(d)).count("/event_rows-") <= 2, make


def test_running_count_of_ties_in_cut_groups_matches_window(spark):
    df = _rows(spark)
    want = df.withColumn("c", F.count("v").over(Window.partitionBy("g").orderBy(F.col("o").asc_nulls_last())))
    _same_rows(want, skewsafe.running_count_range(df, ["g"], "o", "v", "c"))


def test_first_in_group_flags_ties_alike_in_large_and_small_groups(spark):
    df = _rows(spark)
    large = skewsafe.large_groups(df, ["g"])
    assert large.count() == 2
    want = df.withColumn("f", F.rank().over(Window.partitionBy("g", "u").orderBy(F.col("o").asc_nulls_last())) == 1)
    _same_rows(want, skewsafe.first_in_group(df, ["g", "u"], ["o"], large, "f"))


def test_only_keys_with_many_rows_are_cut(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (None, "d")], "k long, w string")
    many = spark.createDataFrame([(1, i) for i in range(MANY)] + [(2, 1), (2, 1), (None, 3)], "rk long, v long")
    pieces = large_key_pieces(many, ["rk"])
    assert {r[0] for r in pieces.collect()} == {1}
    _same_rows(left.join(many, left.k == many.rk, "left"), left_join_many(left, many, [(left.k, "rk")], pieces))


def test_discounts_and_payments_are_not_broadcast(spark):
    d = domain(spark, SF_SMALL)
    for rows in (blocks.event_rows.__wrapped__(d), reports.kpi_rows.__wrapped__(d), reports.kpi_brand_rows.__wrapped__(d)):
        joins = [x for x in _plan(rows).splitlines() if "BroadcastHashJoin" in x]
        assert not [x for x in joins if "discount_id" in x or "_item" in x or "_order" in x]


def _broadcast_scans(df) -> str:
    """The scans below the plan's broadcasts."""
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    found, at = [], None
    for x in _plan(df).splitlines():
        at = None if at is not None and depth(x) <= at else at
        if at is None and "BroadcastExchange" in x:
            at = depth(x)
        elif at is not None and "FileScan" in x:
            found.append(x)
    return "\n".join(found)


def test_users_and_seminars_of_the_windowed_rows_are_not_broadcast(spark):
    scans = _broadcast_scans(blocks.event_rows.__wrapped__(domain(spark, SF_SMALL)))
    assert "duration#" in scans                  # of the seminars that events name, a written table
    assert "salon_id#" not in scans and "part.parquet" not in scans


def test_sheet_rows_of_wide_events_meet_written_participants(spark):
    """Discount, payments and memberships move narrow rows, whose shuffle files are gone when the wide events come."""
    d = domain(spark, SF_SMALL)
    for rows in (reports.kpi_rows, reports.kpi_brand_rows):
        assert "l_orderkey" not in _plan(rows.__wrapped__(d)), rows


def test_shuffle_files_of_written_legacy_rows_are_released(spark, monkeypatch):
    from kpistar.operators import materialize as written
    from kpistar.sources.legacy import LegacyDomain
    released = []
    monkeypatch.setattr(written, "release", released.append, raising=False)
    ld = LegacyDomain.from_sf(spark, SF_SMALL)
    legacy.legacy_rows(ld)
    legacy.legacy_rows(ld)
    assert released == [spark]


def test_lookups_by_event_hold_only_what_events_name(spark):
    d = domain(spark, SF_SMALL)
    named = d.seminar_events.select("seminar_id").distinct()
    assert dims.event_seminars(d).join(named, F.col("id") == F.col("seminar_id"), "left_anti").count() == 0
    assert dims.event_seminars(d).count() == d.seminars.join(named, F.col("id") == F.col("seminar_id"), "left_semi").count()
    educators = d.seminar_events.select("educator_id").distinct()
    assert dims.event_educators(d).join(educators, F.col("id") == F.col("educator_id"), "left_anti").count() == 0


def test_bookings_outside_the_period_are_not_joined(spark):
    plan = legacy.legacy_rows.__wrapped__(legacy_domain(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 2


def test_participant_lookups_go_to_no_driver(spark):
    """Users and memberships grow with the data: no report broadcasts them, staff reads the users that posts name."""
    d = domain(spark, SF_SMALL)
    for make in (lambda: reports.education_star(d), lambda: facts.participations_fact(d), lambda: dims.internal_staff.__wrapped__(d)):
        lines = make()._jdf.queryExecution().executedPlan().toString().splitlines()
        hashed = [x for x in lines if "BroadcastHashJoin" in x]
        assert hashed and not any("], [du_user_id" in x or "], [ds_user_id" in x for x in hashed)
    assert not any("customer.parquet" in x for x in lines)
    assert 0 < dims.posted_users(d).count() < d.users.count()


def test_education_star_with_repeated_events_of_two_brands(spark):
    """Narrow participations first gives the rows of D19 LEFT JOIN D20 event row by event row."""
    d = domain(spark, SF_SMALL)
    tables = {t: getattr(d, t) for t in Domain.TABLES}
    seminar = F.col("seminar_id")
    events = d.seminar_events.where("id % 16 < 4")
    again = events.withColumn("seminar_id", F.when(F.col("id") % 3 == 0, seminar + 1).when(F.col("id") % 3 == 1, seminar).cast(d.seminar_events.schema["seminar_id"].dataType))
    tables["seminar_events"] = materialize(d.seminar_events.unionByName(again))
    two = Domain.from_tables(tables)
    sem = facts.seminars_fact(two, keep_brand_code=True)
    prt = two.participations.select("seminar_event_id", F.col("user_id").alias("p_user"))
    du = dims.users_dim(two).select(*[F.col(c).alias(f"du_{c}") for c in dims.users_dim(two).columns])
    ds = dims.users_salons_dim(two).select(*[F.col(c).alias(f"ds_{c}") for c in dims.users_salons_dim(two).columns])
    plain = (sem.join(prt, sem.event_id == prt.seminar_event_id, "left").join(du, F.col("p_user") == F.col("du_user_id"), "left")
             .join(ds, (F.col("p_user") == F.col("ds_user_id")) & (F.col("_brn_code") == F.col("ds_code")), "left"))
    got = reports.education_star(two, ordered=False)
    want = plain.select(*[c for c in sem.columns if c != "_brn_code"], "seminar_event_id", *[a for a, _ in facts.PARTICIPANT_COLS]).toDF(*got.columns)
    _same_rows(want, got)
