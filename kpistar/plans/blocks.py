"""Operator-level queries: one relational building block of the reports each.

Every function runs one operator of the reports (scan, projection, filter,
join, aggregation, window, sort or scalar rule) over whole domain tables, in
the shape the reports use it.  ``d`` is the consolidated domain, ``ld`` the
legacy one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpistar.config import ReportParams
from kpistar.functions import (at_report_tz, base_price, coalesce_case, decode, discount_due, dmy,
                               interval_days, is_integral, is_true, period_filter, pg_concat, pg_concat_op, pg_int,
                               presence_flag, when_present, year_ranges)
from kpistar.operators.joins import bounded_broadcast, fact, fact_led, left_join_many, lookup, single_row_lookup
from kpistar.operators.materialize import dimension, fact_rows
from kpistar.operators.ordering import pg_asc
from kpistar.operators.skewsafe import borders, first_and_totals, first_in_group, large_groups, running_count_range, running_sum
from kpistar.operators.windows import emit_once
from kpistar.plans import dims, legacy
from kpistar.plans.dims import ROLE_BY_LEVEL, TEAM_BY_STRUCTURE
from kpistar.plans.reports import kpi_brand_report, kpi_class as kpi_class_expr

P = ReportParams()


def _pref(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


_bb = bounded_broadcast


# ------------------------------------------------------------- scans
def scan_alias(d) -> DataFrame:
    """``FROM seminar_events AS sme`` with qualified references (pruned scan)."""
    sme = d.seminar_events.alias("sme")
    return sme.select("sme.id", "sme.seminar_id", "sme.started_at", "sme.educator_id")


def tenant_filter(ld, params: ReportParams = P) -> DataFrame:
    """Salons ⟕ programmes ON salon AND programme brand = tenant (constant folded)."""
    sln = ld.salons.select(F.col("id").alias("salon_id"))
    prg = legacy.programs(ld, params).where(F.col("brand") == F.lit(params.tenant)).select(
        F.col("salon_id").alias("p_salon"), "name_prog", "status")
    j = fact_led(sln, prg, [(F.col("salon_id"), "p_salon")])
    return j.select("salon_id", "name_prog", "status")


def case_simple_decode(d) -> DataFrame:
    """Level -> role and structure -> team decodes on the staff dimension (no ELSE -> NULL)."""
    s = dims.internal_staff(d)
    return s.select("region_id", "user_id",
                    decode(F.col("region_level"), ROLE_BY_LEVEL).alias("role_name"),
                    decode(F.col("structure_type"), TEAM_BY_STRUCTURE).alias("team"))


# ------------------------------------------------------- projections
def project_rename(d, params: ReportParams = P) -> DataFrame:
    """Renamed event columns; mixed-case Day/Month/Year as lower-case names."""
    e = d.seminar_events
    t = at_report_tz(F.col("started_at"), params.report_tz)
    return e.select(F.col("id").alias("smr_id"), F.col("seminar_event_type_id").alias("smr_type_id"),
                    F.col("business_trip").alias("smr_status_trip"), F.col("educator_id").alias("educater_id"),
                    F.dayofmonth(t).alias("day"), F.month(t).alias("month"), F.year(t).alias("year"))


def project_star(d) -> DataFrame:
    """``SELECT *`` of the participation fact."""
    return d.participations.select("*")


def project_qualified_star(d) -> DataFrame:
    """``us.*, s.*`` of membership ⟕ salon (no clashing names)."""
    us, s = d.users_salons.alias("us"), d.salons.alias("s")
    return us.join(_bb(s), F.col("us.salon_id") == F.col("s.id"), "left").select("us.*", "s.*")


def project_constants(d) -> DataFrame:
    """P5: constant placeholder columns of the consolidated sheets."""
    return d.seminar_events.select(
        F.col("id").alias("smr_id"), F.lit("").alias("type_master"), F.lit("").alias("booking_user_name"),
        F.lit("").alias("role"), F.lit("").alias("prebooking_day"), F.lit("").alias("status_booking"))


def kpi_class(d) -> DataFrame:
    """KPI class of every event (unnamed CASE of the brand report, aliased)."""
    e = d.seminar_events.alias("e")
    smr = d.seminars.select(F.col("id").alias("s_id"), F.col("seminar_kpis_type_id").alias("s_kt"))
    kt = d.seminar_kpis_types.select(F.col("id").alias("kt_id"), F.col("name").alias("kt_name"))
    j = (e.join(_bb(smr), F.col("e.seminar_id") == F.col("s_id"), "left")
         .join(_bb(kt), F.col("s_kt") == F.col("kt_id"), "left"))
    return j.select(F.col("e.id").alias("smr_id"), F.col("kt_name").alias("smr_kpi_type"),
                    kpi_class_expr(F.col("kt_name"), F.col("e.studio_id"), F.col("e.salon_id")).alias("kpi_class"))


def string_concat_operator(d) -> DataFrame:
    """NULL-propagating ``||``; first-last vs last-first name orders."""
    u = d.users
    return u.select("id",
                    pg_concat_op(F.col("first_name"), " ", F.col("last_name")).alias("educator_name"),
                    pg_concat_op(F.col("last_name"), " ", F.col("first_name")).alias("master_name"),
                    pg_concat_op(F.col("id"), "|", F.col("city")).alias("user_city_key"))


# ------------------------------------------------------------ filters
def filter_time_range(d, params: ReportParams = P) -> DataFrame:
    """half-open period on the event start (bounds shifted, column bare)."""
    e = d.seminar_events
    return e.where(period_filter(F.col("started_at"), params.period, params.report_tz)).select("id", "started_at")


def filter_or_ranges(ld, params: ReportParams = P) -> DataFrame:
    """same quarter of two years (OR of half-open ranges)."""
    s = ld.seminars
    return s.where(period_filter(F.col("started_at"), params.legacy_salon_period, "UTC")).select("id", "started_at")


def filter_year_in(d, params: ReportParams = P) -> DataFrame:
    """``to_char(ts,'YYYY') IN (...)`` as year ranges, so it stays sargable."""
    e = d.seminar_events
    return (e.where(period_filter(F.col("started_at"), year_ranges(params.years), params.report_tz))
            .select("id", "started_at"))


def filter_eq_code(d, params: ReportParams = P) -> DataFrame:
    """``brn.code = 'AM'`` after event ⟕ seminar ⟕ brand (the outer joins turn inner)."""
    e = d.seminar_events.select("id", "seminar_id")
    smr = d.seminars.select(F.col("id").alias("s_id"), F.col("brand_id"))
    brn = d.brands.select(F.col("id").alias("b_id"), F.col("code"))
    j = (e.join(_bb(smr), e.seminar_id == F.col("s_id"), "left")
         .join(_bb(brn), F.col("brand_id") == F.col("b_id"), "left"))
    return j.where(F.col("code") == params.brand_code).select("id", "code")


def filter_not_like(d, params: ReportParams = P) -> DataFrame:
    """F8: ``NOT LIKE`` without wildcards drops the test macro-region (NULL is dropped too)."""
    c = dims.region_chain(d)
    return c.where(~F.col("com_mreg_name").like(params.excluded_mreg)).select("com_ter_id", "com_mreg_name")


def predicate_not_in_null(ld) -> DataFrame:
    """``salon_id IS NOT NULL OR salon_id NOT IN ('0')`` is true exactly when the id is set."""
    s = ld.seminars
    cond = F.col("salon_id").isNotNull() | (F.col("salon_id") != F.lit(0))
    return s.select("id", "salon_id", F.when(cond, "SALON").otherwise("NOT_SALON").alias("place_kind"))


def flag_presence(d) -> DataFrame:
    """Contact presence flags and the e-mail holder id."""
    u = d.users
    return u.select("id", presence_flag(F.col("email")).alias("status_email"),
                    presence_flag(F.col("mobile_number")).alias("status_mobile"),
                    presence_flag(F.col("last_request_at")).alias("status_ecad_active_user"),
                    F.when(F.col("email").isNotNull(), F.col("id")).alias("unuq_hd_with_email"))


def case_trip(ld) -> DataFrame:
    """``trip IS TRUE OR false`` -> trip flag, else business-trip flag (ints)."""
    s = ld.seminars
    trip = F.when(is_true(F.col("trip")), F.lit(1)).otherwise(
        F.when(F.col("business_trip") == F.lit(True), F.lit(1)).otherwise(F.lit(0)))
    return s.select("id", "trip", "business_trip", trip.alias("trip_flag"))


def case_nested(ld) -> DataFrame:
    """Participant type and salon activity from nested CASEs."""
    u = ld.users.alias("u")
    sln, mng = _pref(ld.salons, "sln_"), _pref(ld.salons, "mng_")
    j = (u.join(_bb(sln), F.col("u.salon_id").isNotNull() & (F.col("u.salon_id") == F.col("sln_id")), "left")
         .join(_bb(mng), F.col("u.salon_id").isNull() & (F.col("u.id") == F.col("mng_salon_manager_id")), "left"))
    closed = lambda p: F.when(F.col(f"{p}is_closed") == F.lit(True), "in_ptnc_base").otherwise("in_act_base")
    return j.select(
        F.col("u.id").alias("id"),
        F.when(F.col("u.salon_id").isNotNull(), "salon_master").when(F.col("mng_id").isNotNull(), "salon_master")
        .when(F.col("u.id").isNotNull(), "hairdresser").otherwise("not_reg_user").alias("type_master"),
        F.when(F.col("sln_id").isNotNull(), closed("sln_")).when(F.col("mng_id").isNotNull(), closed("mng_"))
        .alias("active_clnt"))


# -------------------------------------------------------------- joins
def join_left_dim(d) -> DataFrame:
    """N:1 dimension lookup (size-checked broadcast)."""
    e = d.seminar_events.select("id", "seminar_id")
    smr = d.seminars.select(F.col("id").alias("s_id"), "name", "duration")
    return lookup(e, smr, e.seminar_id == smr.s_id).select("id", "seminar_id", "name", "duration")


def join_left_fanout(d) -> DataFrame:
    """Event ⟕ participations, 1:N (events without participants keep one NULL row)."""
    e = d.seminar_events.select("id")
    p = d.participations.select(F.col("id").alias("prt_id"), "seminar_event_id", "user_id")
    return fact_led(e, p, [(e.id, "seminar_event_id")]).select(F.col("id").alias("event_id"), "prt_id", "user_id")


def join_left_composite(d) -> DataFrame:
    """Event ⟕ brand ⟕ training centre ON (studio id, brand code)."""
    e = d.seminar_events.select("id", "seminar_id", "studio_id")
    smr = d.seminars.select(F.col("id").alias("s_id"), "brand_id")
    brn = d.brands.select(F.col("id").alias("b_id"), F.col("code").alias("brn_code"))
    trc = dims.training_centers_regions(d).select(F.col("id").alias("t_id"), F.col("code").alias("t_code"),
                                                  F.col("name").alias("centre_name"))
    j = (e.join(_bb(smr), e.seminar_id == F.col("s_id"), "left")
         .join(_bb(brn), F.col("brand_id") == F.col("b_id"), "left")
         .join(_bb(trc), (F.col("studio_id") == F.col("t_id")) & (F.col("brn_code") == F.col("t_code")), "left"))
    return j.select("id", "studio_id", "brn_code", "centre_name")


def join_left_guarded(ld) -> DataFrame:
    """One-side guards kept in ON: own salon when set, managed salon when not."""
    u = ld.users.select("id", "salon_id")
    sln = ld.salons.select(F.col("id").alias("own_salon"))
    mng = ld.salons.select(F.col("id").alias("managed_salon"), F.col("salon_manager_id"))
    j = (u.join(_bb(sln), F.col("salon_id").isNotNull() & (F.col("salon_id") == F.col("own_salon")), "left")
         .join(_bb(mng), F.col("salon_id").isNull() & (F.col("id") == F.col("salon_manager_id")), "left"))
    return j.select("id", "salon_id", "own_salon", "managed_salon")


def join_left_expr_key(ld, params: ReportParams = P) -> DataFrame:
    """ON coalesce(own salon, managed salon) = programme salon, tenant brand and
    status picked by a CASE in an IN list."""
    u = ld.users.select("id", "salon_id")
    mng = ld.salons.select(F.col("id").alias("mng_id"), F.col("salon_manager_id"))
    name = F.col("name_prog")
    picked = F.when(name.like(legacy.SALON_CLUB_PATTERNS[0]), F.col("status")).when(
        name.like(legacy.SALON_CLUB_PATTERNS[1]), F.col("status"))
    spp = (legacy.remote_programs_all(ld)
           .where((F.col("brand_id") == F.lit(params.tenant_brand_id)) & picked.isin(*legacy.SALON_CLUB_STATUSES))
           .select(F.col("salon_id").alias("p_salon"), "status"))
    key = F.coalesce(F.col("salon_id"), F.col("mng_id"))
    j = u.join(_bb(mng), F.col("salon_id").isNull() & (F.col("id") == F.col("salon_manager_id")), "left")
    j = fact_led(j, spp, [(key, "p_salon")])
    return j.select("id", key.alias("salon_key"), F.col("status").alias("club"))


def join_role_playing(d) -> DataFrame:
    """``users`` as educator and as participant of the same event."""
    e = d.seminar_events.select("id", "educator_id")
    edu = _pref(d.users, "edu_")
    p = d.participations.select(F.col("id").alias("prt_id"), "seminar_event_id", F.col("user_id").alias("p_user"))
    pu = _pref(d.users, "pu_")
    j = e.join(_bb(edu), F.col("educator_id") == F.col("edu_id"), "left")
    j = (fact_led(j, p, [(F.col("id"), "seminar_event_id")])
         .join(_bb(pu), F.col("p_user") == F.col("pu_id"), "left"))
    return j.select(F.col("id").alias("event_id"), "prt_id",
                    pg_concat_op(F.col("edu_first_name"), " ", F.col("edu_last_name")).alias("educator_name"),
                    pg_concat_op(F.col("pu_last_name"), " ", F.col("pu_first_name")).alias("master_name"))


def scalar_subquery_lookup(ld) -> DataFrame:
    """Correlated single-row lookups: studio type by studio id; educator role by
    (technolog, partimer, partner) priority.  A second row for a key that is looked up raises,
    as a scalar subquery does."""
    key = F.coalesce(F.col("technolog_id"), F.col("partimer_id"), F.col("partner_id"))
    j = single_row_lookup(ld.seminars, F.col("studio_id"), ld.studios, "id", {"studio_type": "studio_type"})
    j = single_row_lookup(j, key, ld.users, "id", {"role": "edu_role"})
    return j.select("id", "studio_id", "studio_type", "edu_role")


def join_bridge(d) -> DataFrame:
    """Participation ⟕ membership bridge ⟕ salon (M:N multiplies rows)."""
    p = d.participations.select(F.col("id").alias("prt_id"), "user_id")
    us = d.users_salons.select(F.col("user_id").alias("m_user"), "salon_id")
    s = d.salons.select(F.col("id").alias("s_id"), F.col("name").alias("salon_name"))
    j = (left_join_many(p, us, [(F.col("user_id"), "m_user")])
         .join(_bb(s), F.col("salon_id") == F.col("s_id"), "left"))
    return j.select("prt_id", "user_id", "salon_id", "salon_name")


def audit_fanout(d) -> DataFrame:
    """J17/quality: per event, participation rows vs rows after the membership bridge.

    ``inflation`` > 1 shows how much a row-counting measure (users_count)
    is multiplied by memberships; ``distinct_users`` is the strict count.
    """
    e = d.seminar_events.select("id")
    p = d.participations.select(F.col("id").alias("prt_id"), "seminar_event_id", "user_id")
    per_user = d.users_salons.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_salons"))
    j = (fact_led(e, p, [(F.col("id"), "seminar_event_id")])
         .join(_bb(per_user.withColumnRenamed("user_id", "m_user")), F.col("user_id") == F.col("m_user"), "left"))
    return (j.groupBy(F.col("id").alias("event_id"))
            .agg(F.count("prt_id").alias("participation_rows"),
                 F.sum(F.when(F.col("prt_id").isNull(), F.lit(0))
                       .otherwise(F.coalesce(F.col("n_salons"), F.lit(1)))).cast("long").alias("joined_rows"),
                 F.countDistinct("user_id").alias("distinct_users")))


# -------------------------------------------------------- aggregations
def agg_group_count(ld) -> DataFrame:
    """A2/A3: ``count(usr.id)`` per (seminar, participant), dependent columns listed in GROUP BY."""
    s = ld.seminars.select("id", "started_at")
    smu = ld.seminar_users.select(F.col("seminar_id"), F.col("user_id").alias("smu_user"))
    u = ld.users.select(F.col("id").alias("usr_id"), F.col("full_name"))
    j = (fact_led(s, smu, [(F.col("id"), "seminar_id")])
         .join(_bb(u), F.col("smu_user") == F.col("usr_id"), "left"))
    return (j.groupBy(F.col("id").alias("smr_id"), "started_at", "usr_id", "full_name")
            .agg(F.count("usr_id").alias("users_count")))


def distinct_rows(d) -> DataFrame:
    """A4/A5: SELECT DISTINCT of a projection (educator x venue salon)."""
    return d.seminar_events.select("educator_id", "salon_id").distinct()


# ------------------------------------------------------------ windows
@fact_rows
def event_rows(d) -> DataFrame:
    """Events ⟕ seminar ⟕ participations ⟕ discount ⟕ participants ⟕ their memberships (the
    windowed report grain), written once: every measure over it reads this table, not the facts.

    A participation meets its discount and its participant before its event, so that each
    exchange carries few columns, and the users bring their memberships.  Users and seminars grow
    with the data and compress well, so a broadcast of them holds many times their files' size:
    memberships are shuffled, and of the seminars only those that events name are looked up."""
    e = d.seminar_events.select(F.col("id").alias("event_id"), "started_at", "seminar_id")
    p = d.participations.select(F.col("id").alias("prt_id"), "seminar_event_id", "user_id", "discount_id")
    smr = dims.event_seminars(d).select(F.col("id").alias("s_id"), "duration", "cost")
    dsc = d.discounts.select(F.col("id").alias("d_id"), "percent_value")
    e = e.join(_bb(smr), F.col("seminar_id") == F.col("s_id"), "left")
    j = p.join(fact(dsc), F.col("discount_id") == F.col("d_id"), "left").drop("discount_id", "d_id")
    members = dims.memberships(d).select("pu_id", "salon_id")
    j = left_join_many(j, members, [(F.col("user_id"), "pu_id")], dims.membership_pieces(d), side=fact)
    j = fact_led(e, j, [(F.col("event_id"), "seminar_event_id")], nullable=False, keys_of=p)
    j = j.withColumn("due", discount_due(F.col("cost"), F.col("percent_value"), is_integral(smr, "cost")))
    return j.select("event_id", "started_at", "duration", "prt_id", "user_id", "pu_id", "due", "salon_id")


ROW_ORDER = ["prt_id", "salon_id"]


@dimension
def event_row_borders(d) -> DataFrame:
    return borders(event_rows(d), ["event_id"], ROW_ORDER)


@dimension
def event_tie_borders(d) -> DataFrame:
    return borders(event_rows(d), ["event_id"], ["prt_id"])


@dimension
def large_events(d) -> DataFrame:
    return large_groups(event_rows(d), ["event_id"])


def _totals(j: DataFrame, aggs: dict) -> DataFrame:
    return first_and_totals(j, ["event_id"], ROW_ORDER, aggs, "_first")


def window_first_row(d) -> DataFrame:
    """Event values emitted on the event's first row only (total order)."""
    j = _totals(event_rows(d), {})
    return j.select("event_id", "prt_id", "salon_id", emit_once("_first", F.col("duration")).alias("smr_duration"),
                    emit_once("_first", F.col("event_id")).alias("uniq_smr_id"))


def window_row_number(d) -> DataFrame:
    """``row_number() OVER (PARTITION BY event ORDER BY participation)``
    as a bucketed running count (the order is unique inside an event)."""
    j = event_rows(d).withColumn("_one", F.lit(1))
    j = running_sum(j.select("event_id", *ROW_ORDER, "_one"), ["event_id"], ROW_ORDER, "_one", "rn", event_row_borders(d))
    return j.select("event_id", "prt_id", "salon_id", F.col("rn").cast("long").alias("rn"))


def window_count(d) -> DataFrame:
    """Joined-row counts per event (attendees, client salons), emitted once."""
    j = _totals(event_rows(d), {"_users": F.count("pu_id"), "_clients": F.count("salon_id")})
    return j.select("event_id", "prt_id", "salon_id", emit_once("_first", F.col("_users")).alias("users_count"),
                    emit_once("_first", F.col("_clients")).alias("clients_count"))


def window_running_count(d) -> DataFrame:
    """Running count, default RANGE frame: membership ties on a participation share it."""
    j = event_rows(d).select("event_id", "pu_id", *ROW_ORDER)
    j = running_count_range(j, ["event_id"], "prt_id", "pu_id", "user_num", event_tie_borders(d))
    return j.select("event_id", "prt_id", "salon_id", "user_num")


def window_dedup_person(d) -> DataFrame:
    """Participant id emitted once per (event, participant); two partition columns."""
    j = event_rows(d).select("event_id", "user_id", *ROW_ORDER)
    j = first_in_group(j, ["event_id", "user_id"], ROW_ORDER, large_events(d), "_first")
    return j.select("event_id", "prt_id", "salon_id", emit_once("_first", F.col("user_id")).alias("user_id"))


def window_presence_flag(d) -> DataFrame:
    """W8/M5: 'attend' when the event has any participant with a user row, else 'no_users'."""
    j = _totals(event_rows(d), {"_users": F.count("pu_id")})
    return j.select("event_id", "prt_id", "salon_id",
                    F.when(F.col("_users") > 0, "attend").otherwise("no_users").alias("status_seminar_users"))


def window_sum_case(d) -> DataFrame:
    """``sum(CASE ...) OVER (PARTITION BY event)`` of the amount due, emitted once."""
    j = _totals(event_rows(d), {"_paid": F.sum("due")})
    return j.select("event_id", "prt_id", "salon_id", F.col("due").alias("user_must_pay"),
                    emit_once("_first", F.col("_paid")).alias("smr_paid"))


# ---------------------------------------------------------- sorting
def sort_total(d) -> DataFrame:
    """O1/O2: ``ORDER BY started_at, event, participation`` with PostgreSQL NULL placement."""
    j = event_rows(d)
    return (j.select("event_id", "started_at", "prt_id", "salon_id")
            .orderBy(pg_asc("started_at"), pg_asc("event_id"), pg_asc("prt_id"), pg_asc("salon_id")))


def sort_topn(d, params: ReportParams = P) -> DataFrame:
    """O3: the brand report's preview, first 100 rows of a total order (TakeOrderedAndProject)."""
    return kpi_brand_report(d, params, ordered=True, limit=100)


# ------------------------------------------------------- scalar rules
def string_concat_function(d) -> DataFrame:
    """PostgreSQL ``concat`` skips NULLs (legacy ids, event_type label)."""
    e = d.seminar_events.alias("e")
    smr = d.seminars.select(F.col("id").alias("s_id"), F.col("name").alias("s_name"))
    j = e.join(_bb(smr), F.col("e.seminar_id") == F.col("s_id"), "left")
    return j.select(F.col("e.id").alias("smr_id"),
                    pg_concat(F.col("e.id"), "_", F.col("s_name")).alias("uniq_event"),
                    pg_concat(F.col("e.loreal_former_id"), F.col("e.matrix_former_id"),
                              F.col("e.kerastase_former_id"), F.col("e.redken_former_id")).alias("old_smr_id"))


def date_extract(d, params: ReportParams = P) -> DataFrame:
    """Day, month, year of the event start (the salon opening year, M40, is in join_full_outer)."""
    e = d.seminar_events
    t = at_report_tz(F.col("started_at"), params.report_tz)
    return e.select("id", F.dayofmonth(t).alias("day"), F.month(t).alias("month"), F.year(t).alias("year"))


def date_interval_days(ld) -> DataFrame:
    """Whole days between start and booking, truncated toward zero, and their label
    (empty for a seminar without a booking)."""
    s = ld.seminars.select(F.col("id").alias("smr_id"), "started_at")
    b = legacy.booking(ld).select("seminar_id", "master_id", "booking_at")
    j = fact_led(s, b, [(F.col("smr_id"), "seminar_id")])
    days = interval_days(F.col("started_at"), F.col("booking_at"))
    return j.select("smr_id", "master_id", "booking_at", days.alias("prebooking_day"),
                    F.when(days == 0, "on_seminar").when(days < 0, "after_seminar")
                    .when(days > 0, "pre_booking").otherwise("").alias("status_booking"))


def date_format_dmy(d, params: ReportParams = P) -> DataFrame:
    """``to_char(ts, 'dd.mm.YYYY')`` of creation, start and closing."""
    e = d.seminar_events
    tz = params.report_tz
    return e.select("id", dmy(F.col("created_at"), tz).alias("smr_created_date"),
                    dmy(F.col("started_at"), tz).alias("smr_start_date"),
                    dmy(F.col("performed_at"), tz).alias("smr_closed_date"))


def date_timezone_shift(d, tz: str = "Europe/Moscow") -> DataFrame:
    """Wall clock read as UTC and shown in a report zone (here Moscow): parts and dates."""
    e = d.seminar_events
    t = at_report_tz(F.col("started_at"), tz)
    return e.select("id", F.dayofmonth(t).alias("day"), F.month(t).alias("month"), F.year(t).alias("year"),
                    F.hour(t).alias("hour"), dmy(F.col("started_at"), tz).alias("smr_start_date"))


def math_discount(d) -> DataFrame:
    """Rounded percentage, integer divisions, amount due per participation."""
    p = d.participations.select(F.col("id").alias("prt_id"), "seminar_event_id", "discount_id")
    e = d.seminar_events.select(F.col("id").alias("e_id"), "seminar_id")
    smr = d.seminars.select(F.col("id").alias("s_id"), "cost")
    dsc = d.discounts.select(F.col("id").alias("d_id"), "percent_value")
    j = (p.join(fact(e), F.col("seminar_event_id") == F.col("e_id"), "left")
         .join(_bb(smr), F.col("seminar_id") == F.col("s_id"), "left")
         .join(fact(dsc), F.col("discount_id") == F.col("d_id"), "left"))
    return j.select("prt_id", "cost", "percent_value", pg_int(F.col("percent_value")).alias("percent_int"),
                    discount_due(F.col("cost"), F.col("percent_value"), is_integral(smr, "cost")).alias("user_must_pay"))


def math_base_price(ld) -> DataFrame:
    """Studio coefficient x base price, or the base price alone."""
    s = ld.seminars.select("id", "seminar_type_id", "studio_id")
    st = ld.seminar_types.select(F.col("id").alias("t_id"), "base_price")
    std = ld.studios.select(F.col("id").alias("std_id"), "coefficient")
    j = (s.join(_bb(st), F.col("seminar_type_id") == F.col("t_id"), "left")
         .join(_bb(std), F.col("studio_id").isNotNull() & (F.col("studio_id") == F.col("std_id")), "left"))
    return j.select("id", base_price(F.col("coefficient"), F.col("base_price")).cast("decimal(18,4)")
                    .alias("base_price"))


def coalesce_chain(ld) -> DataFrame:
    """First set of partimer / technolog / partner id, and the matching name."""
    s = ld.seminars
    return s.select(
        "id", coalesce_case(F.col("partimer_id"), F.col("technolog_id"), F.col("partner_id")).alias("educater_id"),
        F.when(F.col("partimer_id").isNotNull(), F.col("partimer_full_name"))
        .when(F.col("technolog_id").isNotNull(), F.col("technolog_full_name"))
        .when(F.col("partner_id").isNotNull(), F.col("partner_full_name")).otherwise("Not_found").alias("educater"))


def case_place(d) -> DataFrame:
    """Venue fields chosen by presence of the studio key (not of the centre row)."""
    e = d.seminar_events.select("id", "studio_id", "salon_id")
    trc = d.training_centers.select(F.col("id").alias("t_id"), F.col("name").alias("t_name"),
                                    F.col("address").alias("t_address"))
    sln = d.salons.select(F.col("id").alias("s_id"), F.col("name").alias("s_name"))
    j = (e.join(_bb(trc), F.col("studio_id") == F.col("t_id"), "left")
         .join(_bb(sln), F.col("salon_id") == F.col("s_id"), "left"))
    studio = F.col("studio_id")
    return j.select(
        "id", F.when(studio.isNotNull(), "studio").otherwise("in_salon").alias("type_place"),
        when_present(studio, studio, F.col("salon_id")).alias("id_place"),
        when_present(studio, pg_concat_op(F.col("t_name"), " ", F.col("t_address")),
                     pg_concat_op("in_salon: ", F.col("s_name"))).alias("name_place"))
