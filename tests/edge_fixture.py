"""Hand-written consolidated-schema fixture: one row group per reporting rule.

Organisation: HQ(1) -> AMERICA(10, brand AM) -> NATION_A(100) -> territories 1000, 1001
                    -> EUROPE(11, brand EU)  -> NATION_E(101) -> territory 1005
                    -> ASIA(12, brand AS)    -> NATION_S(102) -> territory 1010 (test region)
Staff: u1 HQ director, u2 AMERICA regional technolog, u3 NATION_A manager,
       u4 technolog of 1000 with a second post at NATION_E (multi-post educator).
Salons: 10, 11 in territory 1000 (AM); 12 in 1005 (EU); 14 in 1010 (AS, test region);
        13 has no members; membership of user 23 points at a missing salon 99.
Events (all 1996):
  E1 Brand Day seminar at salon 10, educator u4; participants p1 (user 20, two
     memberships, 15 % discount, two payments), p2 (user 21 has no user row),
     p3 (user 22, member of an EU salon only);
  E2 no participants; E3 studio 5 without a centre row; E4 seminar without brand.
"""

import datetime as dt
from decimal import Decimal

from kpistar.sources.domain import Domain

T = dt.datetime


def build(spark):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    region_cols = ("id long, name string, code string, status string, brand_id long, region_level int, "
                   "structure_type int, is_blocked boolean, parent_id long, education_region_id long")
    regions = [
        (1, "HQ", "HQ", "active", None, 3, 1, False, None, None),
        (10, "AMERICA", "R10", "active", 0, 4, 1, False, 1, None),
        (11, "EUROPE", "R11", "active", 1, 4, 1, False, 1, None),
        (12, "ASIA", "R12", "active", 2, 4, 1, False, 1, None),
        (100, "NATION_A", "R100", "active", 0, 5, 1, False, 10, 11),
        (101, "NATION_E", "R101", "active", 1, 5, 1, False, 11, None),
        (102, "NATION_S", "R102", "active", 2, 5, 1, False, 12, None),
        (1000, "TER_A0", "R1000", "active", 0, 6, 1, False, 100, None),
        (1001, "TER_A1", "R1001", "active", 0, 6, 1, False, 100, None),
        (1005, "TER_E", "R1005", "active", 1, 6, 1, False, 101, None),
        (1010, "TER_S", "R1010", "active", 2, 6, 1, False, 102, None),
    ]
    parent = {r[0]: r[8] for r in regions}
    closure = []
    for rid in parent:
        closure.append((rid, rid, 0))
        a, g = parent[rid], 1
        while a is not None:
            closure.append((a, rid, g))
            a, g = parent[a], g + 1
    users = [
        (1, "Ann", "Director", "d@x", "+1", "C1", T(2001, 1, 1), "A"),
        (2, "Bob", "Regional", "r@x", None, "C1", None, "B"),
        (3, "Cid", "Manager", None, "+3", "C2", T(2001, 1, 1), "C"),
        (4, "Dan", "Tech", "t@x", "+4", "C2", T(2001, 1, 1), "D"),
        (20, "Eve", "Master", "e@x", "+20", "C3", None, "E"),
        (22, None, "Other", "o@x", None, "C3", None, "E"),
        (23, "Gus", "Lost", None, None, "C4", None, "E"),
    ]
    posts_by_region = {1: 1, 10: 2, 100: 3, 1000: 4}
    user_posts = [(rid, u, lvl, None) for rid, u, lvl in
                  [(1, 1, 3), (10, 2, 4), (100, 3, 5), (1000, 4, 6)]] + [(5000, 4, 5, None)]
    user_post_brands = [(rid, rid) for rid in posts_by_region] + [(101, 5000)]
    tables = dict(
        brands=df([(0, "AMERICA", "AM"), (1, "EUROPE", "EU"), (2, "ASIA", "AS")], "id long, name string, code string"),
        regions=df(regions, region_cols),
        region_hierarchies=df(closure, "ancestor_id long, descendant_id long, generations int"),
        posts=df([(3, 1), (4, 2), (5, 3), (6, 4)], "id long, role_id int"),
        user_posts=df(user_posts, "id long, user_id long, post_id long, salon_id long"),
        user_post_brands=df(user_post_brands, "region_id long, user_post_id long"),
        users=df(users, "id long, first_name string, last_name string, email string, mobile_number string, "
                        "city string, last_request_at timestamp_ntz, technolog_salary_category string"),
        salons=df([(10, "S10", "a10", "C1", 0), (11, "S11", "a11", "C1", 0), (12, "S12", "a12", "C2", 1),
                   (13, "S13", "a13", "C2", 1), (14, "S14", "a14", "C3", 0)],
                  "id long, name string, address string, city string, salon_type_id long"),
        salon_types=df([(0, "type_a"), (1, "type_b")], "id long, name string"),
        regions_salons=df([(10, 1000, dt.date(1990, 1, 1), 1), (11, 1000, dt.date(1991, 1, 1), 0),
                           (12, 1005, dt.date(1992, 1, 1), 2), (13, 1001, dt.date(1993, 1, 1), 1),
                           (14, 1010, dt.date(1994, 1, 1), 1)],
                          "salon_id long, region_id long, open_date date, status int"),
        users_salons=df([(20, 10), (20, 11), (22, 12), (23, 99)], "user_id long, salon_id long"),
        seminar_events=df([
            (1, 1, 1, T(1996, 3, 1), T(1996, 2, 1), T(1996, 3, 2), True, None, 10, 4, 111, None, None, None),
            (2, 1, 1, T(1996, 4, 1), T(1996, 3, 1), None, False, None, None, None, None, None, None, None),
            (3, 2, 1, T(1996, 5, 1), T(1996, 4, 1), None, False, 5, None, 1, None, 333, None, 33),
            (4, 3, 1, T(1996, 6, 1), T(1996, 5, 1), None, False, None, 13, 3, None, None, None, None),
        ], "id long, seminar_id long, seminar_event_type_id long, started_at timestamp_ntz, "
           "created_at timestamp_ntz, performed_at timestamp_ntz, business_trip boolean, studio_id long, "
           "salon_id long, educator_id long, loreal_former_id long, matrix_former_id long, "
           "kerastase_former_id long, redken_former_id long"),
        seminars=df([(1, "Color", 0, 4, 1, 8, 1000), (2, "Cut", 0, None, 1, 4, 0), (3, "Care", None, 5, 1, 2, None)],
                    "id long, name string, brand_id long, seminar_kpis_type_id long, "
                    "seminar_specialization_id long, duration int, cost long"),
        seminar_kpis_types=df([(4, "Brand Day"), (5, "Consultations")], "id long, name string"),
        seminar_event_types=df([(1, "event")], "id long, name string"),
        seminar_specializations=df([(1, "spec")], "id long, name string"),
        training_centers=df([(6, "TC6", "x6", Decimal("1.25"), 0, 10)],
                            "id long, name string, address string, costs_coefficient decimal(4,2), "
                            "center_type int, region_id long"),
        regions_training_centers=df([(6, 100)], "training_center_id long, region_id long"),
        participations=df([("p1", 1, 20, "d1"), ("p2", 1, 21, None), ("p3", 1, 22, None)],
                          "id string, seminar_event_id long, user_id long, discount_id string"),
        discounts=df([("d1", Decimal("15.00"))], "id string, percent_value decimal(8,2)"),
        orders=df([("o1", "p1", "Participation", Decimal("10.00"), Decimal("10.00"))],
                  "id string, item_id string, item_type string, base_cost decimal(18,2), cost decimal(18,2)"),
        payments=df([("y1", "o1", Decimal("100.00")), ("y2", "o1", Decimal("5.00"))],
                    "id string, order_id string, amount decimal(18,2)"),
    )
    tables["admin_coach_events"] = df([], "id long, admin_coach_seminar_id long, user_id long, educator_id long, started_date date")
    tables["admin_coach_seminars"] = df([], "id long, name string")
    return Domain.from_tables(tables)
