"""The greedy walk against the recursive-CTE walk of the oracle, on random candidates."""

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reshift.plans.oracle import sql_between
from tests.rows import walked

PRODUCTS = ["Amazon Elastic Compute Cloud", "AMAZON ELASTIC COMPUTE CLOUD"]
POOLS = [(p, t, z) for p in PRODUCTS for t in ("m3.large", "m3.xlarge", "c4.large")
         for z in ("us-east-1", "us-east-1a")]
DEMANDS = [(z, t) for z in ("us-east-1a", "us-east-1b", None) for t in ("m3.medium", "m3.large", "c4.xlarge")]


@st.composite
def candidates(draw):
    caps = {pool: float(draw(st.integers(1, 9))) for pool in POOLS}
    pairs = draw(st.lists(st.tuples(st.sampled_from(POOLS), st.sampled_from(DEMANDS)),
                          min_size=1, max_size=40, unique=True))
    rows = []
    for (product, itype, zone), (od_zone, od_type) in pairs:
        rows.append(dict(
            productname=product, region="us-east-1", availability_zone=zone, os="linux",
            instancetype=itype, avg_unused_instances=caps[(product, itype, zone)],
            availabilityzone=od_zone, ondemand_instancetype=od_type, avg_ondemand_instances=1.0,
            instances_tobe_shifted=float(draw(st.integers(1, 6))),
            ondemand_instances_increased=1.0,
            savings=draw(st.sampled_from([None, 1.0, 2.0, 2.0, 5.5]))))
    return pd.DataFrame(rows)


def keys(df):
    return sorted((r.productname, r.instancetype, r.availability_zone, r.availabilityzone or "",
                   r.ondemand_instancetype) for r in df.itertuples())


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(candidates(), st.sampled_from([1, 2, 7, 1000]))
def test_walk_equals_recursive_sql(cands, batch):
    cands = cands.astype({"savings": "float64"})
    con = duckdb.connect()
    con.register("candidate_moves", cands)
    want = con.sql(sql_between("walk_input", "picks")).df()
    assert keys(walked(cands, batch)) == keys(want)
