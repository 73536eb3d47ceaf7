"""Dimension datasets of the consolidated schema.

Every function takes a ``Domain`` (DataFrames with the documented columns)
and returns a DataFrame.  Organisation and geography dimensions are bounded
by the size of the organisation (regions, staff, salons), not by the fact
tables; they are joined with size-checked broadcasts.  Dimensions derived
from facts (educators, salon venues) pre-aggregate the fact to the distinct
keys they need before joining, so the shuffle carries keys, not fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpistar.config import ReportParams
from kpistar.functions import decode, pg_concat_op, presence_flag
from kpistar.operators.joins import bounded_broadcast, fact, full_outer_dim, large_key_pieces
from kpistar.operators.materialize import dimension

P = ReportParams()

# Report vocabulary of the staff and salon decodes.
ROLE_BY_LEVEL = {6: "technolog", 5: "manager", 4: "regional_technolog", 3: "education_director"}
TEAM_BY_STRUCTURE = {1: "COM", 2: "EDU"}
CLIENT_STATUS = {0: "potencial", 1: "active", 2: "closed"}
CENTER_TYPE = {0: "studio", 1: "class"}


_bb = bounded_broadcast


# ------------------------------------------- rows that events ask for
def _asked(by: DataFrame, table: DataFrame, key: str) -> DataFrame:
    asked = by.select(F.col(key).alias("_asked")).distinct()
    return table.join(asked, F.col("id") == F.col("_asked"), "left_semi")


@dimension
def event_seminars(d) -> DataFrame:
    """The seminars that events name, written: what a lookup by event can find, at its measured size."""
    return _asked(d.seminar_events, d.seminars, "seminar_id")


@dimension
def event_educators(d) -> DataFrame:
    """The users that events name as educators, written likewise."""
    return _asked(d.seminar_events, d.users, "educator_id")


@dimension
def posted_users(d) -> DataFrame:
    """The users that posts name, written: organisation-sized, while users grow with the data."""
    return _asked(d.user_posts, d.users, "user_id")


# ------------------------------------------------------------------ staff
@dimension
def internal_staff(d) -> DataFrame:
    """Region x staff member (region ⟕ post-brand ⟕ post ⟕ user)."""
    rgn = d.regions.alias("rgn")
    upb = d.user_post_brands.alias("upb")
    usp = d.user_posts.alias("usp")
    usr = posted_users(d).alias("usr")
    j = (rgn.join(upb, F.col("rgn.id") == F.col("upb.region_id"), "left")
         .join(usp, F.col("usp.id") == F.col("upb.user_post_id"), "left")
         .join(_bb(usr), F.col("usp.user_id") == F.col("usr.id"), "left"))
    return j.select(
        F.col("rgn.id").alias("region_id"), F.col("rgn.name").alias("region_name"),
        F.col("rgn.brand_id"), F.col("rgn.region_level"), F.col("rgn.structure_type"),
        F.col("rgn.is_blocked"), F.col("rgn.code").alias("region_code"),
        F.col("rgn.status").alias("region_status"), F.col("rgn.education_region_id"),
        F.col("usr.id").alias("user_id"),
        pg_concat_op(F.col("usr.last_name"), " ", F.col("usr.first_name")).alias("full_name"),
        F.col("usr.email"), F.col("usr.mobile_number"), F.col("usr.city"))


def _ancestors(d, internal: DataFrame, generation: int, tag: str) -> DataFrame:
    """Staff of the ancestor ``generation`` levels up, keyed by descendant region.

    ``inte ⟕ rgh ON descendant AND generations = g ⟕ l ON ancestor`` equals
    ``inte ⟕ (rgh ⟕ l)`` because the second condition reads only rgh and l.
    """
    rgh = d.region_hierarchies.where(F.col("generations") == generation)
    anc = internal.select(F.col("region_id").alias(f"{tag}_region"),
                          F.col("user_id").alias(f"{tag}_user_id"),
                          F.col("full_name").alias(f"{tag}_full_name"))
    return (rgh.join(anc, rgh.ancestor_id == F.col(f"{tag}_region"), "left")
            .select(F.col("descendant_id").alias(f"{tag}_desc"), f"{tag}_user_id", f"{tag}_full_name"))


def _with_ancestors(d, internal: DataFrame) -> DataFrame:
    inte = internal
    for g, tag in ((1, "l1"), (2, "l2"), (3, "l3")):
        anc = _bb(_ancestors(d, internal, g, tag))
        inte = inte.join(anc, inte.region_id == F.col(f"{tag}_desc"), "left")
    return inte


@dimension
def staff_hierarchy(d) -> DataFrame:
    """Staff with N+1/N+2/N+3 managers chosen by the staff member's own level.

    Level 6 reports to 1, 2 and 3 levels up; level 5 has N+2 one level up and
    N+3 two up; level 4 has N+3 one level up.  Adds team and brand code; distinct.
    """
    inte = _with_ancestors(d, internal_staff(d))
    lvl = F.col("region_level")
    brn = d.brands.select(F.col("id").alias("brn_id"), F.col("code"))
    out = inte.join(_bb(brn), inte.brand_id == brn.brn_id, "left").select(
        "brand_id", "region_id", "region_level", "structure_type", "user_id", "full_name",
        "email", "mobile_number", "city",
        F.when(lvl == 6, F.col("l1_user_id")).alias("n1_user_id"),
        F.when(lvl == 6, F.col("l1_full_name")).alias("n1_full_name"),
        F.when(lvl == 5, F.col("l1_user_id")).when(lvl == 6, F.col("l2_user_id")).alias("n2_user_id"),
        F.when(lvl == 5, F.col("l1_full_name")).when(lvl == 6, F.col("l2_full_name")).alias("n2_full_name"),
        F.when(lvl == 4, F.col("l1_user_id")).when(lvl == 5, F.col("l2_user_id"))
        .when(lvl == 6, F.col("l3_user_id")).alias("n3_user_id"),
        F.when(lvl == 4, F.col("l1_full_name")).when(lvl == 5, F.col("l2_full_name"))
        .when(lvl == 6, F.col("l3_full_name")).alias("n3_full_name"),
        decode(F.col("structure_type"), TEAM_BY_STRUCTURE).alias("team"),
        F.col("code"))
    return out.distinct()


@dimension
def staff_hierarchy_fixed(d) -> DataFrame:
    """Managers exactly 1/2/3 generations up whatever the level; no brand code."""
    inte = _with_ancestors(d, internal_staff(d))
    return inte.select(
        "brand_id", "region_level", "structure_type", "user_id", "full_name", "email",
        "mobile_number", "city",
        F.col("l1_user_id").alias("n1_user_id"), F.col("l1_full_name").alias("n1_full_name"),
        F.col("l2_user_id").alias("n2_user_id"), F.col("l2_full_name").alias("n2_full_name"),
        F.col("l3_full_name").alias("n3_full_name")).distinct()


# -------------------------------------------------------------- geography
@dimension
def region_chain(d) -> DataFrame:
    """Commercial territory -> region -> macro-region, plus education regions.

    Only level-6 commercial (structure 1) territories.  Carries brand name and code.
    """
    r = d.regions
    rgn = r.where((F.col("region_level") == 6) & (F.col("structure_type") == 1)).alias("rgn")
    rgn1, rgn2 = r.alias("rgn1"), r.alias("rgn2")
    e1, e2 = r.alias("rgn1_edu"), r.alias("rgn2_edu")
    brd = d.brands.alias("brd")
    j = (rgn.join(_bb(rgn1), F.col("rgn.parent_id") == F.col("rgn1.id"), "left")
         .join(_bb(rgn2), F.col("rgn1.parent_id") == F.col("rgn2.id"), "left")
         .join(_bb(e1), F.col("rgn1.education_region_id") == F.col("rgn1_edu.id"), "left")
         .join(_bb(e2), F.col("rgn1_edu.parent_id") == F.col("rgn2_edu.id"), "left")
         .join(_bb(brd), F.col("rgn.brand_id") == F.col("brd.id"), "left"))
    return j.select(
        F.col("brd.name").alias("brand"), F.col("brd.code").alias("code"),
        F.col("rgn.id").alias("com_ter_id"), F.col("rgn.name").alias("com_ter_name"),
        F.col("rgn.code").alias("com_ter_code"), F.col("rgn.status").alias("ter_status"),
        F.col("rgn1.id").alias("com_reg_id"), F.col("rgn1.name").alias("com_reg_name"),
        F.col("rgn1.code").alias("com_reg_code"), F.col("rgn1.status").alias("reg_status"),
        F.col("rgn2.id").alias("com_mreg_id"), F.col("rgn2.name").alias("com_mreg_name"),
        F.col("rgn2.code").alias("com_mreg_code"), F.col("rgn2.status").alias("mreg_status"),
        F.col("rgn1.education_region_id").alias("edu_reg_id"),
        F.col("rgn1_edu.name").alias("edu_reg_name"),
        F.col("rgn2_edu.id").alias("edu_mreg_id"), F.col("rgn2_edu.name").alias("edu_mreg_name"))


@dimension
def salons_regions(d, key: str = "id", brand_join: bool = False) -> DataFrame:
    """Salon x its commercial territories (and the territory's brand).

    ``key`` names the salon key column (``id`` in the consolidated report,
    ``salon_id`` in the brand version, which also joins brands by name).
    """
    sln, slt, rgs = d.salons.alias("sln"), d.salon_types.alias("slt"), d.regions_salons.alias("rgs")
    rgu = region_chain(d).alias("rgu")
    j = (sln.join(_bb(slt), F.col("sln.salon_type_id") == F.col("slt.id"), "left")
         .join(rgs, F.col("sln.id") == F.col("rgs.salon_id"), "left")
         .join(_bb(rgu), F.col("rgs.region_id") == F.col("rgu.com_ter_id"), "left"))
    if brand_join:
        brn = d.brands.select(F.col("name").alias("brn_name")).alias("brn")
        j = j.join(_bb(brn), F.col("rgu.brand") == F.col("brn.brn_name"), "left")
    return j.select(
        F.col("sln.id").alias(key), F.col("rgu.brand"),
        pg_concat_op(F.col("sln.name"), ". ", F.col("sln.address"), ". ", F.col("sln.city")).alias("salon_name"),
        F.col("sln.city"), F.col("slt.name").alias("salon_type"),
        "com_ter_id", "com_ter_name", "com_reg_id", "com_reg_name", "com_mreg_id", "com_mreg_name",
        "edu_reg_id", "edu_reg_name", "edu_mreg_id", "edu_mreg_name")


@dimension
def training_centers_regions(d) -> DataFrame:
    """Training centre x education region x brand code."""
    trc = d.training_centers.alias("trc")
    rgn_t = d.regions_training_centers.alias("rgn_t")
    rgn, rgn1, brn = d.regions.alias("rgn"), d.regions.alias("rgn1"), d.brands.alias("brn")
    j = (trc.join(rgn_t, F.col("trc.id") == F.col("rgn_t.training_center_id"), "left")
         .join(_bb(rgn), F.col("rgn_t.region_id") == F.col("rgn.id"), "left")
         .join(_bb(rgn1), F.col("rgn.parent_id") == F.col("rgn1.id"), "left")
         .join(_bb(brn), F.col("rgn.brand_id") == F.col("brn.id"), "left"))
    return j.select(F.col("trc.id"), F.col("trc.name"), F.col("trc.address"),
                    F.col("trc.costs_coefficient"), F.col("trc.center_type"), F.col("brn.code"),
                    F.col("rgn.id").alias("region_id"), F.col("rgn.name").alias("edu_reg"),
                    F.col("rgn1.name").alias("edu_mreg"))


# ----------------------------------------------------------------- people
@dimension
def memberships(d) -> DataFrame:
    """Users with their memberships (a user without any once, salon NULL): one join brings both to a participation."""
    pu = d.users.select(*[F.col(c).alias(f"pu_{c}") for c in d.users.columns])
    us = d.users_salons.select(F.col("user_id").alias("_member"), "salon_id")
    return pu.join(us, F.col("pu_id") == F.col("_member"), "left").drop("_member")


@dimension
def membership_pieces(d) -> DataFrame:
    """The pieces of users with very many memberships."""
    return large_key_pieces(memberships(d), ["pu_id"])


def users_dim(d) -> DataFrame:
    """Participant name and contact presence flags."""
    u = d.users
    return u.select(F.col("id").alias("user_id"),
                    pg_concat_op(F.col("last_name"), " ", F.col("first_name")).alias("user_name"),
                    presence_flag(F.col("email")).alias("status_email"),
                    presence_flag(F.col("mobile_number")).alias("status_mobile"),
                    presence_flag(F.col("last_request_at")).alias("status_ecad_active_user"))


@dimension
def users_salons_dim(d) -> DataFrame:
    """Membership FULL JOIN salon, with status, opening and region chain.

    Keeps salons without members (user_id NULL) and memberships whose salon
    row is missing (salon columns NULL).
    """
    us = d.users_salons.select(F.col("user_id").alias("m_user_id"), F.col("salon_id").alias("m_salon_id"))
    sln = d.salons.select(*[F.col(c).alias(f"s_{c}") for c in d.salons.columns])
    slt, rgs = d.salon_types.alias("slt"), d.regions_salons.alias("rgs")
    rgu = region_chain(d).drop("code").alias("rgu")
    brn = d.brands.alias("brn")
    # FULL JOIN membership x salon, with a hot salon kept on a splittable side
    both = full_outer_dim(us, sln, "m_salon_id", "s_id")
    j = (both.join(_bb(slt), F.col("s_salon_type_id") == F.col("slt.id"), "left")
         .join(rgs, F.col("s_id") == F.col("rgs.salon_id"), "left")
         .join(_bb(rgu), F.col("rgs.region_id") == F.col("rgu.com_ter_id"), "left")
         .join(_bb(brn), F.col("rgu.brand") == F.col("brn.name"), "left"))
    return j.select(
        F.col("s_id").alias("salon_id"),
        pg_concat_op(F.col("s_name"), ". ", F.col("s_address"), ". ", F.col("s_city")).alias("salon_name"),
        F.col("s_city").alias("city"), F.col("slt.name").alias("salon_type"), F.col("rgs.open_date"),
        F.year(F.col("rgs.open_date")).alias("open_year"),
        decode(F.col("rgs.status"), CLIENT_STATUS).alias("client_status"),
        F.col("brn.code"), F.col("rgu.com_ter_name"), F.col("rgu.com_reg_name"),
        F.col("rgu.com_mreg_name"), F.col("rgu.edu_reg_name"), F.col("rgu.edu_mreg_name"),
        F.col("m_user_id").alias("user_id"))


@dimension
def users_salons_pieces(d) -> DataFrame:
    """The pieces of users with very many memberships of a brand."""
    return large_key_pieces(users_salons_dim(d), ["user_id", "code"])


def _event_brand_keys(d, key: str) -> DataFrame:
    """Distinct (event ``key``, seminar brand code) pairs; partial distinct before shuffle."""
    sme = d.seminar_events.select(F.col("seminar_id").alias("e_seminar_id"), F.col(key).alias(key))
    smr = event_seminars(d).select(F.col("id").alias("s_id"), F.col("brand_id").alias("s_brand_id"))
    brn = d.brands.select(F.col("id").alias("b_id"), F.col("code").alias("brn_code"))
    return (sme.join(_bb(smr), sme.e_seminar_id == smr.s_id, "left")
            .join(_bb(brn), F.col("s_brand_id") == brn.b_id, "left")
            .select(key, "brn_code").distinct())


@dimension
def educators(d) -> DataFrame:
    """Distinct educator x seminar brand code x name and managers."""
    keys = _event_brand_keys(d, "educator_id").where(F.col("educator_id").isNotNull())
    usr = event_educators(d).alias("usr")
    inte = staff_hierarchy(d).select(
        F.col("user_id").alias("h_user_id"), F.col("code").alias("h_code"),
        "n1_full_name", "n2_full_name", "n3_full_name")
    j = (keys.join(_bb(usr), F.col("educator_id") == F.col("usr.id"), "left")
         .join(_bb(inte), (F.col("educator_id") == F.col("h_user_id"))
               & (F.col("brn_code") == F.col("h_code")), "left"))
    return j.select(
        "educator_id", F.col("brn_code").alias("code"),
        pg_concat_op(F.col("usr.first_name"), " ", F.col("usr.last_name")).alias("educator_name"),
        F.col("usr.technolog_salary_category"), "n1_full_name", "n2_full_name", "n3_full_name"
    ).distinct()


@dimension
def places(d) -> DataFrame:
    """Venue dimension = training centres UNION ALL salons used as venues.

    Unmatched sides are padded with key 0 (``salon_id`` 0 for centres,
    ``studio_id`` 0 for salons); salon venues have coefficient 1 and type 'salon'.
    """
    trc = training_centers_regions(d)
    centres = trc.select(
        F.col("id").alias("studio_id"), F.lit(0).cast("long").alias("salon_id"), "name", "address",
        F.col("costs_coefficient"),
        decode(F.col("center_type"), CENTER_TYPE).alias("type_place"), "code", "region_id",
        "edu_reg", "edu_mreg")
    keys = (_event_brand_keys(d, "salon_id").where(F.col("salon_id").isNotNull())
            .withColumnRenamed("salon_id", "k_salon"))
    sln = d.salons.alias("sln")
    rgs = d.regions_salons.alias("rgs")
    rgu = region_chain(d).alias("rgu")
    j = (keys.join(_bb(sln), F.col("k_salon") == F.col("sln.id"), "left")
         .join(rgs, F.col("sln.id") == F.col("rgs.salon_id"), "left")
         .join(_bb(rgu), (F.col("rgs.region_id") == F.col("rgu.com_ter_id"))
               & (F.col("brn_code") == F.col("rgu.code")), "left"))
    salon_venues = j.select(
        F.lit(0).cast("long").alias("studio_id"), F.col("k_salon").alias("salon_id"),
        F.col("sln.name").alias("name"), F.col("sln.address").alias("address"),
        F.lit(1).alias("costs_coefficient"), F.lit("salon").alias("type_place"),
        F.col("rgu.code").alias("code"), F.col("rgu.edu_reg_id").alias("region_id"),
        F.col("rgu.edu_reg_name").alias("edu_reg"), F.col("rgu.edu_mreg_name").alias("edu_mreg")
    ).distinct()
    return centres.unionByName(salon_venues)


# ----------------------------------------------------------- side facts
@dimension
def nobrand_salons(d, params: ReportParams = P) -> DataFrame:
    """Distinct (salon, macro-region) of participants' salons of another brand.

    ``usr_sln.salon_id = sln_user.id AND brn.name <> sln_user.brand`` is an
    equi-join with a residual; the NOT NULL filter on the macro-region turns
    the outer chain inner.  The participation side is reduced to distinct
    (user, seminar brand) pairs before it meets the membership bridge.
    """
    prt = d.participations.select(F.col("seminar_event_id").alias("p_event"), F.col("user_id").alias("p_user"))
    sme = d.seminar_events.select(F.col("id").alias("e_id"), F.col("seminar_id").alias("e_seminar"))
    smr = event_seminars(d).select(F.col("id").alias("s_id"), F.col("brand_id").alias("s_brand"))
    brn = d.brands.select(F.col("id").alias("b_id"), F.col("name").alias("brn_name"))
    user_brand = (prt.join(fact(sme), prt.p_event == sme.e_id)
                  .join(_bb(smr), F.col("e_seminar") == smr.s_id)
                  .join(_bb(brn), F.col("s_brand") == brn.b_id)
                  .select("p_user", "brn_name").distinct())
    us = d.users_salons.select(F.col("user_id").alias("m_user"), F.col("salon_id"))
    salon_brand = (user_brand.join(us, F.col("p_user") == F.col("m_user"))
                   .select("salon_id", "brn_name").distinct())
    sr = salons_regions(d).select(F.col("id").alias("r_salon"), F.col("brand").alias("r_brand"),
                                  "com_mreg_name")
    j = salon_brand.join(_bb(sr), (F.col("salon_id") == F.col("r_salon"))
                         & (F.col("brn_name") != F.col("r_brand")))
    return (j.where(F.col("com_mreg_name").isNotNull()
                    & ~F.col("com_mreg_name").like(params.excluded_mreg))
            .select("salon_id", "com_mreg_name").distinct())


def payments_usr(d, with_id: bool = False) -> DataFrame:
    """Participation orders with their payments (several payments stay separate)."""
    ord_ = d.orders.where(F.col("item_type") == "Participation").alias("ord")
    pmt = d.payments.alias("pmt")
    cols = [F.col("ord.item_id"), F.col("ord.base_cost"), F.col("ord.cost"), F.col("pmt.amount")]
    if with_id:
        cols.append(F.col("pmt.id").alias("id"))
    return ord_.join(fact(pmt), F.col("ord.id") == F.col("pmt.order_id"), "left").select(*cols)


def distinct_participants(d) -> DataFrame:
    """Number of distinct participants per seminar event."""
    return (d.participations.groupBy("seminar_event_id")
            .agg(F.countDistinct("user_id").alias("user_count")))
