"""Invariants of the two allocators on the sf0.01 fixtures."""

import pytest
from pyspark.sql import functions as F

from reshift.plans.queries import stages_for
from tests.conftest import SF_MEDIUM


@pytest.fixture(scope="module")
def st(spark):
    return stages_for(spark, SF_MEDIUM)


def test_pool_total_strictly_below_average_unused(st):
    per_pool = (st.suggestions
                .groupBy("productname", "region", "unused_ri_availabilityzone", "os",
                         "unused_ri_instancetype")
                .agg(F.sum("instances_tobe_shifted").alias("s"), F.max("avg_unused_instances").alias("cap")))
    assert per_pool.filter(F.col("s") >= F.col("cap")).count() == 0
    assert per_pool.count() > 0


def test_each_demand_served_once(st):
    picks = st.picks
    dup = picks.groupBy("region", "os", "availabilityzone", "ondemand_instancetype").count()
    assert dup.filter(F.col("count") > 1).count() == 0


def test_reservation_never_over_promised(st):
    over = (st.reservation_shift
            .groupBy("reserved_instance_id", "region", "availability_zone", "os", "instancetype", "active")
            .agg(F.sum("active_instances_tobe_shifted").alias("s"))
            .filter(F.col("s") > F.col("active")))
    assert over.count() == 0


def test_every_shift_comes_from_a_suggestion(st):
    keys = ["productname", "region", "os", "ondemand_availabilityzone", "ondemand_instancetype"]
    sug = st.suggestions.withColumnRenamed("unused_ri_availabilityzone", "availability_zone")
    shifts = st.reservation_shift
    cond = [shifts[k].eqNullSafe(sug[k]) for k in keys + ["availability_zone"]]
    missing = shifts.join(sug, cond, "left_anti")
    assert missing.count() == 0
    assert st.reservation_shift.count() <= st.suggestions.count()


def test_candidate_key_is_unique(st):
    # the job's regrouping of candidates by this key is an identity
    from reshift.operators.moves import CANDIDATE_KEYS
    dup = st.candidate_moves.groupBy(*CANDIDATE_KEYS).count().filter(F.col("count") > 1)
    assert dup.count() == 0
