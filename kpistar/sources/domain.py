"""Consolidated (one database, many brands) domain tables.

The driver ships TPC-H-like tables; the KPI reports expect an education
programme schema.  Each property below derives one domain table from the
driver tables with plain column expressions, unions, self joins and
distincts, so every domain table grows with its source:

    seminar_events  <- orders        participations <- lineitem
    users           <- customer      salons         <- supplier
    seminars        <- part          regions        <- HQ / region / nation / nation x segment
    training centres <- nation       coach events   <- events

On a production deployment these properties are replaced by reads of the real
tables (see ``Domain.from_tables``); the plans in ``kpistar.plans`` only see
DataFrames with the documented columns.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpistar.operators.materialize import materialize
from kpistar.sources.raw import RawTables

# Fixed values of the mapping: customer market segment -> territory index,
# part type -> KPI type id.  Unknown values fall outside both.
SEGMENT_INDEX = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": 3, "MACHINERY": 4}
KPI_TYPE_ID = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6}


def _decode(col: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default)) if default is not None else out


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def participation_id(li: DataFrame | None = None) -> Column:
    """Participation key: the five lineitem columns that are unique together."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"),
                       _s("l_suppkey"), _s(cents))


def days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


def small_table(fn):
    """Domain table bounded by the organisation (regions, posts, type lists):
    derived once, persisted and counted, then shared by every plan."""
    prop = cached_property(lambda self: materialize(fn(self), fn.__name__))
    prop.__doc__ = fn.__doc__
    return prop


def from_tables(cls, tables: dict[str, DataFrame], needed):
    """An instance of a domain class whose tables are the given DataFrames, none derived."""
    missing = sorted(set(needed) - set(tables))
    if missing:
        raise ValueError(f"missing tables: {missing}")
    d = cls.__new__(cls)
    d.raw, d.spark = None, next(iter(tables.values())).sparkSession
    d.__dict__.update({name: tables[name] for name in tables})
    return d


class Domain:
    """G2 domain tables derived from the driver tables."""

    TABLES = ("brands", "regions", "region_hierarchies", "posts", "user_posts",
              "user_post_brands", "users", "salons", "salon_types", "regions_salons",
              "users_salons", "seminar_events", "seminars", "seminar_kpis_types",
              "seminar_event_types", "seminar_specializations", "training_centers",
              "regions_training_centers", "participations", "discounts", "orders",
              "payments", "admin_coach_events", "admin_coach_seminars")

    def __init__(self, raw: RawTables):
        self.raw = raw
        self.spark = raw.spark

    @classmethod
    def from_tables(cls, tables: dict[str, DataFrame]) -> "Domain":
        """A domain over DataFrames of the documented tables (FIXTURES.md), by name."""
        return from_tables(cls, tables, cls.TABLES)

    @classmethod
    def from_sf(cls, spark, sf_dir: str) -> "Domain":
        return cls(RawTables(spark, sf_dir))

    # ------------------------------------------------------------------ org
    @small_table
    def brands(self) -> DataFrame:
        r = self.raw.region
        return r.select(F.col("r_regionkey").cast("long").alias("id"),
                        F.col("r_name").alias("name"),
                        F.upper(F.substring("r_name", 1, 2)).alias("code"))

    @small_table
    def regions(self) -> DataFrame:
        r, n, c = self.raw.region, self.raw.nation, self.raw.customer
        cols = ["id", "name", "code", "status", "brand_id", "region_level",
                "structure_type", "is_blocked", "parent_id", "education_region_id"]
        hq = (r.select(F.lit(1).cast("long").alias("id"), F.lit("HQ").alias("name"),
                       F.lit("HQ").alias("code"), F.lit("active").alias("status"),
                       F.lit(None).cast("long").alias("brand_id"),
                       F.lit(3).alias("region_level"), F.lit(1).alias("structure_type"),
                       F.lit(False).alias("is_blocked"),
                       F.lit(None).cast("long").alias("parent_id"),
                       F.lit(None).cast("long").alias("education_region_id"))
              .distinct())
        lvl4 = r.select((F.col("r_regionkey") + 10).cast("long").alias("id"),
                        F.col("r_name").alias("name"),
                        F.concat(F.lit("R"), _s(F.col("r_regionkey") + 10)).alias("code"),
                        F.lit("active").alias("status"),
                        F.col("r_regionkey").cast("long").alias("brand_id"),
                        F.lit(4).alias("region_level"), F.lit(1).alias("structure_type"),
                        F.lit(False).alias("is_blocked"),
                        F.lit(1).cast("long").alias("parent_id"),
                        F.lit(None).cast("long").alias("education_region_id"))
        lvl5 = n.select((F.col("n_nationkey") + 100).cast("long").alias("id"),
                        F.col("n_name").alias("name"),
                        F.concat(F.lit("R"), _s(F.col("n_nationkey") + 100)).alias("code"),
                        F.lit("active").alias("status"),
                        F.col("n_regionkey").cast("long").alias("brand_id"),
                        F.lit(5).alias("region_level"), F.lit(1).alias("structure_type"),
                        F.lit(False).alias("is_blocked"),
                        (F.col("n_regionkey") + 10).cast("long").alias("parent_id"),
                        F.when(F.col("n_nationkey") % 6 != 5,
                               ((F.col("n_regionkey") + 1) % 5 + 10)).cast("long")
                        .alias("education_region_id"))
        seg = _decode(F.col("c_mktsegment"), SEGMENT_INDEX, 5)
        terr = (c.select(F.col("c_nationkey"), seg.alias("seg")).distinct()
                .join(n.select("n_nationkey", "n_regionkey"),
                      F.col("c_nationkey") == F.col("n_nationkey")))
        tid = F.col("c_nationkey") * 5 + F.col("seg") + 1000
        lvl6 = terr.select(tid.cast("long").alias("id"),
                           F.concat(F.lit("TER_"), _s("c_nationkey"), F.lit("_"), _s("seg")).alias("name"),
                           F.concat(F.lit("R"), _s(tid)).alias("code"),
                           F.when(F.col("seg") == 2, "closed").otherwise("active").alias("status"),
                           F.col("n_regionkey").cast("long").alias("brand_id"),
                           F.lit(6).alias("region_level"),
                           F.when(F.col("seg") == 4, 2).otherwise(1).alias("structure_type"),
                           (F.col("seg") == 3).alias("is_blocked"),
                           (F.col("c_nationkey") + 100).cast("long").alias("parent_id"),
                           F.lit(None).cast("long").alias("education_region_id"))
        return hq.select(cols).unionByName(lvl4).unionByName(lvl5).unionByName(lvl6)

    @small_table
    def region_hierarchies(self) -> DataFrame:
        """Closure table (generations 0..3) from parent self joins."""
        r = self.regions.select("id", "parent_id")
        p1 = r.select(F.col("id").alias("p1_id"), F.col("parent_id").alias("p1_parent"))
        p2 = r.select(F.col("id").alias("p2_id"), F.col("parent_id").alias("p2_parent"))
        g0 = r.select(F.col("id").alias("ancestor_id"), F.col("id").alias("descendant_id"),
                      F.lit(0).alias("generations"))
        g1 = r.where(F.col("parent_id").isNotNull()).select(
            F.col("parent_id").alias("ancestor_id"), F.col("id").alias("descendant_id"),
            F.lit(1).alias("generations"))
        j1 = r.join(p1, r.parent_id == p1.p1_id)
        g2 = j1.where(F.col("p1_parent").isNotNull()).select(
            F.col("p1_parent").alias("ancestor_id"), F.col("id").alias("descendant_id"),
            F.lit(2).alias("generations"))
        g3 = (j1.join(p2, F.col("p1_parent") == F.col("p2_id"))
              .where(F.col("p2_parent").isNotNull())
              .select(F.col("p2_parent").alias("ancestor_id"), F.col("id").alias("descendant_id"),
                      F.lit(3).alias("generations")))
        return g0.unionByName(g1).unionByName(g2).unionByName(g3)

    def _first_posts(self) -> DataFrame:
        lvl = F.col("region_level")
        staff = (F.when(lvl == 3, F.lit(0).cast("long"))
                 .when(lvl == 4, F.col("id") - 9)
                 .when(lvl == 5, F.col("id") - 94)
                 .when(lvl == 6, F.col("id") - 969))
        return self.regions.select(F.col("id").alias("region_id"), F.col("id").alias("post_key"),
                                   staff.alias("user_id"), lvl.cast("long").alias("post_id"),
                                   lvl)

    @small_table
    def posts(self) -> DataFrame:
        return (self.regions.select(F.col("region_level").cast("long").alias("id"),
                                    (F.col("region_level") - 2).alias("role_id"))
                .distinct())

    @small_table
    def user_posts(self) -> DataFrame:
        fp = self._first_posts()
        first = fp.select(F.col("post_key").alias("id"), "user_id", "post_id",
                          F.when((F.col("region_level") == 6) & (F.col("user_id") % 2 == 0),
                                 F.col("user_id") % 100).alias("salon_id"))
        second = (fp.where(F.col("user_id") % 10 == 3)
                  .select((F.col("user_id") + 100000).alias("id"), "user_id",
                          F.lit(5).cast("long").alias("post_id"),
                          F.lit(None).cast("long").alias("salon_id")))
        return first.unionByName(second)

    @small_table
    def user_post_brands(self) -> DataFrame:
        fp = self._first_posts()
        first = fp.select("region_id", F.col("post_key").alias("user_post_id"))
        second = (fp.where(F.col("user_id") % 10 == 3)
                  .select((F.col("user_id") % 25 + 100).alias("region_id"),
                          (F.col("user_id") + 100000).alias("user_post_id")))
        return first.unionByName(second)

    # ---------------------------------------------------------------- people
    @cached_property
    def users(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.raw.customer.select(
            k.alias("id"),
            F.when(k % 41 != 7, F.concat(F.lit("Name"), _s(k % 97))).alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.when(k % 3 != 0, F.concat(F.lit("user"), _s(k), F.lit("@mail.test"))).alias("email"),
            F.when(k % 4 != 1, F.concat(F.lit("+7"), _s(k))).alias("mobile_number"),
            F.concat(F.lit("City"), _s("c_nationkey")).alias("city"),
            F.when(F.col("c_acctbal") >= 0,
                   F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")).alias("last_request_at"),
            F.col("c_mktsegment").alias("technolog_salary_category"))

    @cached_property
    def users_salons(self) -> DataFrame:
        c = self.raw.customer
        k = F.col("c_custkey")
        a = c.where(F.col("c_mktsegment") != "BUILDING").select(
            k.alias("user_id"), (k % 90).alias("salon_id"))
        b = c.where(k % 7 == 0).select(k.alias("user_id"), (k % 10 + 95).alias("salon_id"))
        return a.unionByName(b)

    # ---------------------------------------------------------------- salons
    @cached_property
    def salons(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.raw.supplier.select(
            k.alias("id"), F.col("s_name").alias("name"),
            F.concat(F.lit("Street "), _s(k % 50)).alias("address"),
            F.concat(F.lit("City"), _s("s_nationkey")).alias("city"),
            (k % 6).alias("salon_type_id"))

    @small_table
    def salon_types(self) -> DataFrame:
        return self.raw.region.select(
            F.col("r_regionkey").cast("long").alias("id"),
            F.concat(F.lit("type_"), F.lower("r_name")).alias("name"))

    @cached_property
    def regions_salons(self) -> DataFrame:
        s = self.raw.supplier
        k = F.col("s_suppkey")
        open_date = F.date_add(F.lit("1990-01-01").cast("date"), k.cast("int"))
        a = s.select(k.alias("salon_id"),
                     (F.col("s_nationkey") * 5 + k % 5 + 1000).cast("long").alias("region_id"),
                     open_date.alias("open_date"), (k % 3).cast("int").alias("status"))
        b = s.where(k % 9 == 0).select(
            k.alias("salon_id"),
            (((F.col("s_nationkey") + 1) % 25) * 5 + k % 5 + 1000).cast("long").alias("region_id"),
            open_date.alias("open_date"), F.lit(1).alias("status"))
        return a.unionByName(b)

    # -------------------------------------------------------------- seminars
    @cached_property
    def seminar_events(self) -> DataFrame:
        o = self.raw.orders
        k = F.col("o_orderkey")
        prio = F.substring("o_orderpriority", 1, 1)
        return o.select(
            k.alias("id"),
            (k % 200).alias("seminar_id"),
            prio.cast("long").alias("seminar_event_type_id"),
            F.col("o_orderdate").alias("started_at"),
            (F.col("o_orderdate") - days(k % 30)).alias("created_at"),
            F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + days(F.lit(1)))
            .alias("performed_at"),
            (k % 4 == 0).alias("business_trip"),
            F.when(prio.isin("1", "2"), k % 25).alias("studio_id"),
            F.when(prio.isin("3", "4"), k % 100).alias("salon_id"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_custkey") % 150).alias("educator_id"),
            F.when(k % 4 == 0, k).alias("loreal_former_id"),
            F.when(k % 4 == 1, k).alias("matrix_former_id"),
            F.when(k % 4 == 2, k).alias("kerastase_former_id"),
            F.when(k % 8 == 2, k * 10).alias("redken_former_id"))

    @cached_property
    def seminars(self) -> DataFrame:
        p = self.raw.part
        k = F.col("p_partkey")
        return p.select(
            k.alias("id"), F.col("p_name").alias("name"),
            F.when(k % 6 != 5, k % 6).alias("brand_id"),
            F.when(k % 13 != 0, _decode(F.col("p_type"), KPI_TYPE_ID)).cast("long")
            .alias("seminar_kpis_type_id"),
            F.substring("p_brand", 7, 10).cast("long").alias("seminar_specialization_id"),
            F.col("p_size").alias("duration"),
            F.when(F.col("p_type") == "PROMO", F.lit(0).cast("long"))
            .when(k % 11 != 5, F.round("p_retailprice").cast("long")).alias("cost"))

    @small_table
    def seminar_kpis_types(self) -> DataFrame:
        t = F.col("p_type")
        return (self.raw.part.where(t != "STANDARD").select("p_type").distinct()
                .select(_decode(t, KPI_TYPE_ID).cast("long").alias("id"),
                        F.when(t == "PROMO", "Brand Day").when(t == "SMALL", "Consultations")
                        .when(t != "MEDIUM", t).alias("name")))

    @small_table
    def seminar_specializations(self) -> DataFrame:
        return (self.raw.part.select("p_brand").distinct()
                .select(F.substring("p_brand", 7, 10).cast("long").alias("id"),
                        F.col("p_brand").alias("name")))

    @small_table
    def seminar_event_types(self) -> DataFrame:
        return (self.raw.orders.select("o_orderpriority").distinct()
                .select(F.substring("o_orderpriority", 1, 1).cast("long").alias("id"),
                        F.col("o_orderpriority").alias("name")))

    # ----------------------------------------------------- training centres
    @small_table
    def training_centers(self) -> DataFrame:
        k = F.col("n_nationkey")
        coef = (F.when(k % 3 == 0, F.lit(1.00)).when(k % 3 == 1, F.lit(1.25))
                .otherwise(F.lit(1.50)).cast("decimal(4,2)"))
        return self.raw.nation.select(
            k.cast("long").alias("id"), F.concat(F.lit("Center "), F.col("n_name")).alias("name"),
            F.concat(F.lit("Avenue "), _s(k)).alias("address"), coef.alias("costs_coefficient"),
            (k % 2).alias("center_type"), (F.col("n_regionkey") + 10).cast("long").alias("region_id"))

    @small_table
    def regions_training_centers(self) -> DataFrame:
        k = F.col("n_nationkey")
        return self.raw.nation.select(k.cast("long").alias("training_center_id"),
                                      (k + 100).cast("long").alias("region_id"))

    # ----------------------------------------------------------------- facts
    @cached_property
    def participations(self) -> DataFrame:
        li = self.raw.lineitem
        pid = participation_id()
        return li.select(pid.alias("id"), F.col("l_orderkey").alias("seminar_event_id"),
                         F.col("l_partkey").alias("user_id"),
                         F.when(F.col("l_returnflag").isin("R", "A"), pid).alias("discount_id"))

    @cached_property
    def discounts(self) -> DataFrame:
        li = self.raw.lineitem
        pct = (F.col("l_quantity").cast("decimal(6,2)")
               + F.col("l_discount").cast("decimal(6,2)") * 10).cast("decimal(8,2)")
        return (li.where(F.col("l_returnflag").isin("R", "A"))
                .select(participation_id().alias("id"),
                        F.when(F.col("l_returnflag") == "R", pct).alias("percent_value")))

    @cached_property
    def orders(self) -> DataFrame:
        li = self.raw.lineitem
        pid = participation_id()
        money = F.col("l_extendedprice").cast("decimal(18,2)")
        return li.select(F.concat(F.lit("ord-"), pid).alias("id"), pid.alias("item_id"),
                         F.when(F.col("l_linenumber") % 7 == 0, "Product")
                         .otherwise("Participation").alias("item_type"),
                         money.alias("base_cost"), money.alias("cost"))

    @cached_property
    def payments(self) -> DataFrame:
        """Payments of finished lines; the first line of an order also has a second
        (tax) payment.  One scan: each row yields one or two payment rows."""
        li = self.raw.lineitem.where(F.col("l_linestatus") == "F")
        pid = participation_id()
        first = F.struct(F.concat(F.lit("pay-"), pid, F.lit("-1")).alias("id"),
                         F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
        second = F.struct(F.concat(F.lit("pay-"), pid, F.lit("-2")).alias("id"),
                          F.col("l_tax").cast("decimal(18,2)").alias("amount"))
        pays = F.when(F.col("l_linenumber") == 1, F.array(first, second)).otherwise(F.array(first))
        return (li.select(F.concat(F.lit("ord-"), pid).alias("order_id"), F.explode(pays).alias("p"))
                .select(F.col("p.id").alias("id"), "order_id", F.col("p.amount").alias("amount")))

    # ----------------------------------------------------------- coaching
    @staticmethod
    def _coach_seminar_id(col: Column) -> Column:
        return (F.length(col) * 100 + F.ascii(col)).cast("long")

    @small_table
    def admin_coach_seminars(self) -> DataFrame:
        e = self.raw.events
        return (e.select("event_type").distinct()
                .select(self._coach_seminar_id(F.col("event_type")).alias("id"),
                        F.col("event_type").alias("name")))

    @cached_property
    def admin_coach_events(self) -> DataFrame:
        e = self.raw.events
        return e.select(
            F.col("event_id").alias("id"),
            F.when(F.col("event_type") != "error", self._coach_seminar_id(F.col("event_type")))
            .alias("admin_coach_seminar_id"),
            F.col("ts").cast("date").alias("started_date"),
            F.col("user_id").alias("educator_id"),
            ((F.col("user_id") * 7 + 3) % 200).alias("user_id"))

    # ---------------------------------------------------------------- access
    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
