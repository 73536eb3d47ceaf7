"""Named queries: key -> callable(spark, sf_dir) -> DataFrame.

over the whole driver tables (through the domain mapping).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kpistar.plans import blocks, dims, facts, legacy, reports
from kpistar.sources.domain import Domain
from kpistar.sources.legacy import LegacyDomain

_DOMAINS: dict = {}


def _source_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, length and change time of what lies in the source folder (a listing, no job)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path)))


def _domain(kind, spark: SparkSession, sf_dir: str):
    """The domain over a source folder.  Its dimensions are written when a plan first needs
    them and shared until the folder changes or the session ends."""
    state = (spark.sparkContext.applicationId, _source_state(spark, sf_dir))
    held = _DOMAINS.get((kind, sf_dir))
    if held is None or held[0] != state:
        held = _DOMAINS[kind, sf_dir] = (state, kind.from_sf(spark, sf_dir))
    return held[1]


def domain(spark: SparkSession, sf_dir: str) -> Domain:
    return _domain(Domain, spark, sf_dir)


def legacy_domain(spark: SparkSession, sf_dir: str) -> LegacyDomain:
    return _domain(LegacyDomain, spark, sf_dir)


def _g1(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(legacy_domain(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def _g2(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(domain(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # datasets
    "dim_internal_staff": _g2(dims.internal_staff),
    "dim_staff_hierarchy": _g2(dims.staff_hierarchy),
    "dim_staff_hierarchy_fixed": _g2(dims.staff_hierarchy_fixed),
    "dim_region_chain": _g2(dims.region_chain),
    "dim_salons_regions": _g2(dims.salons_regions),
    "dim_training_centers": _g2(dims.training_centers_regions),
    "dim_users": _g2(dims.users_dim),
    "join_full_outer": _g2(dims.users_salons_dim),
    "dim_educators": _g2(dims.educators),
    "union_all_places": _g2(dims.places),
    "join_theta_residual": _g2(dims.nobrand_salons),
    "fact_payments": _g2(dims.payments_usr),
    "agg_distinct_participants": _g2(dims.distinct_participants),
    "fact_seminars": _g2(facts.seminars_fact),
    "fact_participations": _g2(facts.participations_fact),
    # reports
    "report_kpi": _g2(reports.kpi_report),
    "report_kpi_brand": _g2(reports.kpi_brand_report),
    "report_education_star": _g2(reports.education_star),
    "report_coach_events": _g2(reports.coach_events),
    "report_role_roster": _g2(reports.role_roster),
    "join_anti_orphans": _g2(reports.orphan_seminars),
    "scan_dump": _g2(reports.event_dump),
    # legacy single-brand datasets and reports
    "remote_programs": _g1(legacy.programs),
    "filter_like_or": _g1(legacy.club_programs_current),
    "filter_like_and": _g1(legacy.emotion_programs_previous),
    "dim_program_salons": _g1(legacy.program_salons),
    "remote_payments_flag": _g1(legacy.payments_flag),
    "fact_booking": _g1(legacy.booking),
    "report_legacy_kpi": _g1(legacy.legacy_kpi_report),
    "report_legacy_salon": _g1(legacy.legacy_salon_report),
}

_G2_BLOCKS = ["scan_alias", "case_simple_decode", "project_rename", "project_star", "project_qualified_star",
              "project_constants", "kpi_class", "string_concat_operator", "filter_time_range", "filter_year_in",
              "filter_eq_code", "filter_not_like", "flag_presence", "join_left_dim", "join_left_fanout",
              "join_left_composite", "join_role_playing", "join_bridge", "audit_fanout", "distinct_rows",
              "window_first_row", "window_row_number", "window_count", "window_running_count",
              "window_dedup_person", "window_presence_flag", "window_sum_case", "sort_total", "sort_topn",
              "string_concat_function", "date_extract", "date_format_dmy", "date_timezone_shift",
              "math_discount", "case_place"]
_G1_BLOCKS = ["tenant_filter", "filter_or_ranges", "predicate_not_in_null", "case_trip", "case_nested",
              "join_left_guarded", "join_left_expr_key", "scalar_subquery_lookup", "agg_group_count",
              "date_interval_days", "math_base_price", "coalesce_chain"]
QUERIES.update({k: _g2(getattr(blocks, k)) for k in _G2_BLOCKS})
QUERIES.update({k: _g1(getattr(blocks, k)) for k in _G1_BLOCKS})
