"""Merged sketches against exact distinct counts."""

from pyspark.sql import functions as F

from kpistar.functions import period_filter
from kpistar.plans import approximate
from kpistar.registry import domain

from conftest import SF_MID

PERIODS = {"a quarter": (("1996-01-01", "1996-04-01"),), "two years": (("1996-01-01", "1998-01-01"),),
           "overlapping": (("1996-02-01", "1996-02-10"), ("1997-02-01", "1997-02-10")), "nothing": (("1900-01-01", "1901-01-01"),)}


def test_merged_sketches_stay_within_their_error(spark):
    d = domain(spark, SF_MID)
    got = {r.period: r.people for r in approximate.distinct_participants(d, PERIODS).collect()}
    joined = d.participations.join(d.seminar_events.select(F.col("id").alias("e"), "started_at"), F.col("seminar_event_id") == F.col("e"))
    for name, ranges in PERIODS.items():
        exact = joined.where(period_filter(F.col("started_at"), ranges)).agg(F.countDistinct("user_id")).first()[0]
        assert abs(got[name] - exact) <= max(1, 4 * 0.013 * exact), name


def test_single_events_equal_the_exact_key(spark):
    d = domain(spark, SF_MID)
    exact = d.participations.groupBy("seminar_event_id").agg(F.countDistinct("user_id").alias("n"))
    both = approximate.participant_sketches(d).join(exact, F.col("event_id") == F.col("seminar_event_id"))
    assert both.where(F.abs(F.hll_sketch_estimate("sketch") - F.col("n")) > 1).count() == 0 and both.count() == exact.count()
