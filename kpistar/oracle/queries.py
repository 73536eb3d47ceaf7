"""Oracle SQL per query key (DuckDB dialect, driver views pre-registered)."""

from __future__ import annotations

from kpistar.oracle import blocks, g1, g2
from kpistar.oracle.mapping import with_clause

_W2 = with_clause(g2.ALL_CTES + [blocks.ROWS])
_W1 = with_clause(g1.ALL_CTES)


def _g1(body: str) -> str:
    return f"{_W1}\n{body.strip()}"


def _g2(body: str) -> str:
    return f"{_W2}\n{body.strip()}"


ORACLE: dict[str, str] = {
    "dim_internal_staff": _g2("SELECT * FROM o_staff"),
    "dim_staff_hierarchy": _g2("SELECT * FROM o_hrr"),
    "dim_staff_hierarchy_fixed": _g2("SELECT * FROM o_hrr_fixed"),
    "dim_region_chain": _g2("SELECT * FROM o_chain"),
    "dim_salons_regions": _g2("SELECT * RENAME (salon_id AS id) FROM o_salon_geo"),
    "dim_training_centers": _g2("SELECT * FROM o_trc_geo"),
    "dim_users": _g2("SELECT * FROM o_users"),
    "join_full_outer": _g2("SELECT * FROM o_user_salons"),
    "dim_educators": _g2("SELECT * FROM o_educators"),
    "union_all_places": _g2("SELECT * FROM o_places"),
    "join_theta_residual": _g2("SELECT * FROM o_nobrand"),
    "fact_payments": _g2("SELECT * FROM o_pay"),
    "agg_distinct_participants": _g2(
        "SELECT seminar_event_id, count(DISTINCT user_id) AS user_count FROM participations GROUP BY 1"),
    "fact_seminars": _g2("SELECT * FROM o_seminars"),
    "fact_participations": _g2("SELECT * FROM o_participations"),
    "report_kpi": _g2(g2.REPORT_KPI),
    "report_kpi_brand": _g2(g2.REPORT_KPI_BRAND),
    "report_education_star": _g2(g2.EDUCATION_STAR),
    "remote_programs": _g1("SELECT * FROM g1_programs"),
    "filter_like_or": _g1("SELECT * FROM g1_club_this"),
    "filter_like_and": _g1("SELECT * FROM g1_emo_prev"),
    "dim_program_salons": _g1("SELECT * FROM g1_program_salons"),
    "remote_payments_flag": _g1("SELECT * FROM g1_paid"),
    "fact_booking": _g1("SELECT * FROM g1_booking"),
    "report_legacy_kpi": _g1(g1.LEGACY_KPI),
    "report_legacy_salon": _g1(g1.LEGACY_SALON),
}

ORACLE.update({k: _g2(v) for k, v in blocks.G2_BLOCKS.items()})
ORACLE.update({k: _g1(v) for k, v in blocks.G1_BLOCKS.items()})
