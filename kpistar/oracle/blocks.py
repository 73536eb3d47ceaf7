"""DuckDB oracle text for the operator-level queries (kpistar.plans.blocks)."""

from __future__ import annotations

from kpistar.oracle import g2

PERIOD = "e.started_at >= TIMESTAMP '1996-01-01' AND e.started_at < TIMESTAMP '1997-09-01'"

ROWS = ("o_rows", """
SELECT e.id AS event_id, e.started_at, e.seminar_id, p.id AS prt_id, p.user_id, p.discount_id, pu.id AS pu_id, us.salon_id
FROM seminar_events e
LEFT JOIN participations p ON e.id = p.seminar_event_id
LEFT JOIN users pu ON p.user_id = pu.id
LEFT JOIN users_salons us ON pu.id = us.user_id""")

ORD = "ORDER BY prt_id NULLS LAST, salon_id NULLS LAST"
MUST = ("CASE WHEN s.cost <> 0 THEN CASE WHEN dc.percent_value IS NOT NULL "
        "THEN (s.cost * (CAST(dc.percent_value AS INTEGER) // 10)) // 10 ELSE s.cost * 1 END END")

# key -> (generation, sql body that may start with extra CTE text after a comma)
G2_BLOCKS = {
    "scan_alias": "SELECT sme.id, sme.seminar_id, sme.started_at, sme.educator_id FROM seminar_events AS sme",
    "case_simple_decode": """
SELECT region_id, user_id,
  CASE region_level WHEN 6 THEN 'technolog' WHEN 5 THEN 'manager' WHEN 4 THEN 'regional_technolog'
       WHEN 3 THEN 'education_director' END AS role_name,
  CASE structure_type WHEN 1 THEN 'COM' WHEN 2 THEN 'EDU' END AS team
FROM o_staff""",
    "project_rename": """
SELECT id AS smr_id, seminar_event_type_id AS smr_type_id, business_trip AS smr_status_trip,
  educator_id AS educater_id, CAST(day(started_at) AS INTEGER) AS day,
  CAST(month(started_at) AS INTEGER) AS month, CAST(year(started_at) AS INTEGER) AS year
FROM seminar_events""",
    "project_star": "SELECT * FROM participations",
    "project_qualified_star": "SELECT us.*, s.* FROM users_salons us LEFT JOIN salons s ON us.salon_id = s.id",
    "project_constants": """
SELECT id AS smr_id, '' AS type_master, '' AS booking_user_name, '' AS role, '' AS prebooking_day,
  '' AS status_booking FROM seminar_events""",
    "kpi_class": """
SELECT e.id AS smr_id, kt.name AS smr_kpi_type,
  CASE WHEN kt.name = 'Brand Day' THEN 'Brand Day'
       WHEN kt.name = 'Consultations' THEN 'Consultations'
       WHEN kt.name <> 'Consultations' AND e.studio_id IS NULL AND e.salon_id IS NOT NULL THEN 'training in salon'
       WHEN e.studio_id IS NOT NULL THEN 'studios seminars' ELSE 'Other' END AS kpi_class
FROM seminar_events e LEFT JOIN seminars s ON e.seminar_id = s.id
LEFT JOIN seminar_kpis_types kt ON s.seminar_kpis_type_id = kt.id""",
    "string_concat_operator": """
SELECT id, first_name || ' ' || last_name AS educator_name, last_name || ' ' || first_name AS master_name,
  CAST(id AS VARCHAR) || '|' || city AS user_city_key FROM users""",
    "filter_time_range": f"SELECT e.id, e.started_at FROM seminar_events e WHERE {PERIOD}",
    "filter_year_in": """
SELECT id, started_at FROM seminar_events WHERE strftime(started_at, '%Y') IN ('1996', '1997')""",
    "filter_eq_code": """
SELECT e.id, b.code FROM seminar_events e LEFT JOIN seminars s ON e.seminar_id = s.id
LEFT JOIN brands b ON s.brand_id = b.id WHERE b.code = 'AM'""",
    "filter_not_like": "SELECT com_ter_id, com_mreg_name FROM o_chain WHERE com_mreg_name NOT LIKE 'ASIA'",
    "flag_presence": """
SELECT id, CASE WHEN email IS NULL THEN 0 ELSE 1 END AS status_email,
  CASE WHEN mobile_number IS NULL THEN 0 ELSE 1 END AS status_mobile,
  CASE WHEN last_request_at IS NULL THEN 0 ELSE 1 END AS status_ecad_active_user,
  CASE WHEN email IS NOT NULL THEN id END AS unuq_hd_with_email FROM users""",
    "join_left_dim": """
SELECT e.id, e.seminar_id, s.name, s.duration FROM seminar_events e LEFT JOIN seminars s ON e.seminar_id = s.id""",
    "join_left_fanout": """
SELECT e.id AS event_id, p.id AS prt_id, p.user_id
FROM seminar_events e LEFT JOIN participations p ON e.id = p.seminar_event_id""",
    "join_left_composite": """
SELECT e.id, e.studio_id, b.code AS brn_code, t.name AS centre_name
FROM seminar_events e LEFT JOIN seminars s ON e.seminar_id = s.id LEFT JOIN brands b ON s.brand_id = b.id
LEFT JOIN o_trc_geo t ON e.studio_id = t.id AND b.code = t.code""",
    "join_role_playing": """
SELECT e.id AS event_id, p.id AS prt_id, ed.first_name || ' ' || ed.last_name AS educator_name,
  pu.last_name || ' ' || pu.first_name AS master_name
FROM seminar_events e LEFT JOIN users ed ON e.educator_id = ed.id
LEFT JOIN participations p ON e.id = p.seminar_event_id LEFT JOIN users pu ON p.user_id = pu.id""",
    "join_bridge": """
SELECT p.id AS prt_id, p.user_id, us.salon_id, s.name AS salon_name
FROM participations p LEFT JOIN users_salons us ON p.user_id = us.user_id LEFT JOIN salons s ON us.salon_id = s.id""",
    "join_anti_orphans": """
SELECT s.*, kt.id AS kpis_type_id, kt.name AS kpis_type_name
FROM seminars s LEFT JOIN seminar_kpis_types kt ON s.seminar_kpis_type_id = kt.id WHERE kt.id IS NULL""",
    "audit_fanout": f"""
SELECT e.id AS event_id, count(p.id) AS participation_rows,
  CAST(sum(CASE WHEN p.id IS NULL THEN 0 ELSE coalesce(m.n_salons, 1) END) AS BIGINT) AS joined_rows,
  count(DISTINCT p.user_id) AS distinct_users
FROM seminar_events e LEFT JOIN participations p ON e.id = p.seminar_event_id
LEFT JOIN (SELECT user_id, count(*) AS n_salons FROM users_salons GROUP BY user_id) m ON p.user_id = m.user_id
GROUP BY e.id""",
    "distinct_rows": "SELECT DISTINCT educator_id, salon_id FROM seminar_events",
    "window_first_row": f"""
SELECT r.event_id, r.prt_id, r.salon_id,
  CASE WHEN row_number() OVER (PARTITION BY r.event_id {ORD}) = 1 THEN s.duration END AS smr_duration,
  CASE WHEN row_number() OVER (PARTITION BY r.event_id {ORD}) = 1 THEN r.event_id END AS uniq_smr_id
FROM o_rows r LEFT JOIN seminars s ON r.seminar_id = s.id""",
    "window_row_number": f"""
SELECT event_id, prt_id, salon_id, row_number() OVER (PARTITION BY event_id {ORD}) AS rn FROM o_rows""",
    "window_count": f"""
SELECT event_id, prt_id, salon_id,
  CASE WHEN row_number() OVER (PARTITION BY event_id {ORD}) = 1
       THEN count(pu_id) OVER (PARTITION BY event_id) END AS users_count,
  CASE WHEN row_number() OVER (PARTITION BY event_id {ORD}) = 1
       THEN count(salon_id) OVER (PARTITION BY event_id) END AS clients_count
FROM o_rows""",
    "window_running_count": """
SELECT event_id, prt_id, salon_id,
  count(pu_id) OVER (PARTITION BY event_id ORDER BY prt_id NULLS LAST) AS user_num FROM o_rows""",
    "window_dedup_person": f"""
SELECT event_id, prt_id, salon_id,
  CASE WHEN row_number() OVER (PARTITION BY event_id, user_id {ORD}) = 1 THEN user_id END AS user_id
FROM o_rows""",
    "window_presence_flag": """
SELECT event_id, prt_id, salon_id,
  CASE WHEN count(pu_id) OVER (PARTITION BY event_id) > 0 THEN 'attend' ELSE 'no_users' END
    AS status_seminar_users
FROM o_rows""",
    "window_sum_case": f"""
SELECT r.event_id, r.prt_id, r.salon_id, {MUST} AS user_must_pay,
  CASE WHEN row_number() OVER (PARTITION BY r.event_id {ORD}) = 1
       THEN CAST(sum({MUST}) OVER (PARTITION BY r.event_id) AS BIGINT) END AS smr_paid
FROM o_rows r LEFT JOIN seminars s ON r.seminar_id = s.id LEFT JOIN discounts dc ON r.discount_id = dc.id""",
    "sort_total": """
SELECT event_id, started_at, prt_id, salon_id FROM o_rows
ORDER BY started_at, event_id, prt_id NULLS LAST, salon_id NULLS LAST""",
    "string_concat_function": """
SELECT e.id AS smr_id, concat(e.id, '_', s.name) AS uniq_event,
  concat(e.loreal_former_id, e.matrix_former_id, e.kerastase_former_id, e.redken_former_id) AS old_smr_id
FROM seminar_events e LEFT JOIN seminars s ON e.seminar_id = s.id""",
    "date_extract": """
SELECT id, CAST(extract(day FROM started_at) AS INTEGER) AS day,
  CAST(extract(month FROM started_at) AS INTEGER) AS month,
  CAST(extract(year FROM started_at) AS INTEGER) AS year FROM seminar_events""",
    "date_format_dmy": """
SELECT id, strftime(created_at, '%d.%m.%Y') AS smr_created_date, strftime(started_at, '%d.%m.%Y') AS smr_start_date,
  strftime(performed_at, '%d.%m.%Y') AS smr_closed_date FROM seminar_events""",
    "math_discount": f"""
SELECT p.id AS prt_id, s.cost, dc.percent_value, CAST(dc.percent_value AS INTEGER) AS percent_int,
  {MUST} AS user_must_pay
FROM participations p LEFT JOIN seminar_events e ON p.seminar_event_id = e.id
LEFT JOIN seminars s ON e.seminar_id = s.id LEFT JOIN discounts dc ON p.discount_id = dc.id""",
    "case_place": """
SELECT e.id, CASE WHEN e.studio_id IS NOT NULL THEN 'studio' ELSE 'in_salon' END AS type_place,
  CASE WHEN e.studio_id IS NOT NULL THEN e.studio_id ELSE e.salon_id END AS id_place,
  CASE WHEN e.studio_id IS NOT NULL THEN t.name || ' ' || t.address ELSE 'in_salon: ' || s.name END AS name_place
FROM seminar_events e LEFT JOIN training_centers t ON e.studio_id = t.id LEFT JOIN salons s ON e.salon_id = s.id""",
    "date_timezone_shift": """
SELECT id, CAST(day(t) AS INTEGER) AS day, CAST(month(t) AS INTEGER) AS month, CAST(year(t) AS INTEGER) AS year,
  CAST(hour(t) AS INTEGER) AS hour, strftime(t, '%d.%m.%Y') AS smr_start_date
FROM (SELECT id, timezone('Europe/Moscow', timezone('UTC', started_at)) AS t FROM seminar_events) z""",
    "sort_topn": g2.PREVIEW,
}

G2_BLOCKS.update({
    "report_coach_events": """
SELECT a.id, c.id AS coach_id, s.name AS sem_name, a.started_date,
  c.first_name || ' ' || c.last_name AS coach_last_name, a.educator_id,
  e.first_name || ' ' || e.last_name AS stolbew, e.last_name AS educator_last_name
FROM admin_coach_events a
LEFT JOIN admin_coach_seminars s ON a.admin_coach_seminar_id = s.id
LEFT JOIN users c ON a.user_id = c.id
LEFT JOIN users e ON a.educator_id = e.id""",
    "report_role_roster": """
SELECT u.*, us.user_id AS usrs_user_id, us.salon_id AS usrs_salon_id,
  up.id AS usp_id, up.user_id AS usp_user_id, up.post_id AS usp_post_id, up.salon_id AS usp_salon_id,
  ps.id AS pst_id, ps.role_id AS pst_role_id
FROM users u
LEFT JOIN users_salons us ON u.id = us.user_id
LEFT JOIN user_posts up ON u.id = up.user_id
LEFT JOIN posts ps ON up.post_id = ps.id
WHERE ps.role_id = 4 AND up.salon_id IS NOT NULL
ORDER BY u.id, us.salon_id NULLS LAST, up.id
LIMIT 100""",
    "scan_dump": "SELECT * FROM seminar_events",
})

G1_BLOCKS = {
    "tenant_filter": """
SELECT s.id AS salon_id, p.name_prog, p.status
FROM g1_salons s LEFT JOIN g1_programs p ON s.id = p.salon_id AND p.brand = 'loreal'""",
    "filter_or_ranges": """
SELECT id, started_at FROM g1_seminars
WHERE (started_at >= TIMESTAMP '1996-01-01' AND started_at < TIMESTAMP '1996-04-01')
   OR (started_at >= TIMESTAMP '1997-01-01' AND started_at < TIMESTAMP '1997-04-01')""",
    "predicate_not_in_null": """
SELECT id, salon_id, CASE WHEN salon_id IS NOT NULL OR salon_id NOT IN (0) THEN 'SALON' ELSE 'NOT_SALON' END
  AS place_kind FROM g1_seminars""",
    "case_trip": """
SELECT id, trip, business_trip,
  CASE WHEN trip IS TRUE OR false THEN CASE WHEN trip THEN 1 ELSE 0 END
       ELSE CASE WHEN business_trip THEN 1 ELSE 0 END END AS trip_flag FROM g1_seminars""",
    "case_nested": """
SELECT u.id,
  CASE WHEN u.salon_id IS NOT NULL THEN 'salon_master' WHEN mg.id IS NOT NULL THEN 'salon_master'
       WHEN u.id IS NOT NULL THEN 'hairdresser' ELSE 'not_reg_user' END AS type_master,
  CASE WHEN own.id IS NOT NULL THEN CASE WHEN own.is_closed THEN 'in_ptnc_base' ELSE 'in_act_base' END
       WHEN mg.id IS NOT NULL THEN CASE WHEN mg.is_closed THEN 'in_ptnc_base' ELSE 'in_act_base' END END
    AS active_clnt
FROM g1_users u LEFT JOIN g1_salons own ON u.salon_id IS NOT NULL AND u.salon_id = own.id
LEFT JOIN g1_salons mg ON u.salon_id IS NULL AND u.id = mg.salon_manager_id""",
    "join_left_guarded": """
SELECT u.id, u.salon_id, own.id AS own_salon, mg.id AS managed_salon
FROM g1_users u LEFT JOIN g1_salons own ON u.salon_id IS NOT NULL AND u.salon_id = own.id
LEFT JOIN g1_salons mg ON u.salon_id IS NULL AND u.id = mg.salon_manager_id""",
    "join_left_expr_key": """
SELECT u.id, CASE WHEN u.salon_id IS NOT NULL THEN u.salon_id ELSE mg.id END AS salon_key, p.status AS club
FROM g1_users u LEFT JOIN g1_salons mg ON u.salon_id IS NULL AND u.id = mg.salon_manager_id
LEFT JOIN g1_programs_all p ON CASE WHEN u.salon_id IS NOT NULL THEN u.salon_id ELSE mg.id END = p.salon_id
  AND p.brand_id = 1
  AND (CASE WHEN p.name_prog LIKE '%Expert%' THEN p.status WHEN p.name_prog LIKE '%МБК%' THEN p.status END)
      IN ('accepted', 'invited')""",
    "scalar_subquery_lookup": """
SELECT s.id, s.studio_id, (SELECT x.studio_type FROM g1_studios x WHERE x.id = s.studio_id) AS studio_type,
  CASE WHEN s.technolog_id IS NOT NULL THEN (SELECT x.role FROM g1_users x WHERE x.id = s.technolog_id)
       WHEN s.partimer_id IS NOT NULL THEN (SELECT x.role FROM g1_users x WHERE x.id = s.partimer_id)
       WHEN s.partner_id IS NOT NULL THEN (SELECT x.role FROM g1_users x WHERE x.id = s.partner_id) END AS edu_role
FROM g1_seminars s""",
    "agg_group_count": """
SELECT s.id AS smr_id, s.started_at, u.id AS usr_id, u.full_name, count(u.id) AS users_count
FROM g1_seminars s LEFT JOIN g1_seminar_users su ON s.id = su.seminar_id LEFT JOIN g1_users u ON su.user_id = u.id
GROUP BY s.id, s.started_at, u.id, u.full_name""",
    "date_interval_days": """
SELECT s.id AS smr_id, b.master_id, b.booking_at,
  CAST(date_part('day', s.started_at - b.booking_at) AS INTEGER) AS prebooking_day,
  CASE WHEN date_part('day', s.started_at - b.booking_at) = 0 THEN 'on_seminar'
       WHEN date_part('day', s.started_at - b.booking_at) < 0 THEN 'after_seminar'
       WHEN date_part('day', s.started_at - b.booking_at) > 0 THEN 'pre_booking' ELSE '' END AS status_booking
FROM g1_seminars s LEFT JOIN g1_booking b ON s.id = b.seminar_id""",
    "math_base_price": """
SELECT s.id, CAST(CASE WHEN d.coefficient IS NOT NULL THEN d.coefficient * t.base_price ELSE t.base_price END
  AS DECIMAL(18,4)) AS base_price
FROM g1_seminars s LEFT JOIN g1_seminar_types t ON s.seminar_type_id = t.id
LEFT JOIN g1_studios d ON s.studio_id IS NOT NULL AND s.studio_id = d.id""",
    "coalesce_chain": """
SELECT id, coalesce(partimer_id, technolog_id, partner_id) AS educater_id,
  CASE WHEN partimer_id IS NOT NULL THEN partimer_full_name WHEN technolog_id IS NOT NULL THEN technolog_full_name
       WHEN partner_id IS NOT NULL THEN partner_full_name ELSE 'Not_found' END AS educater
FROM g1_seminars""",
}
