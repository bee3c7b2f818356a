
import pytest

from reshift.functions.cpu import CPU_RULES, rule_rows, rule_table, with_cpu_weight
from reshift.operators.greedy import greedy_picks
from reshift.operators.moves import _sides, candidate_moves, reachable_pairs, walk_candidates

HIGH_SCHEMA = ("productname string, region string, availability_zone string, os string, "
               "instancetype string, hrcount long, dollarsum double, consumptionsum double, "
               "activesum double, unused_ritotal double, unused_ritotal_hrs long, "
               "non_usage_hr_prop_month double")
OD_SCHEMA = ("productname string, region string, availabilityzone string, os string, "
             "ondemand_instancetype string, ondemand_hrs long, dollar_spent double, "
             "quantity_used double, ondemand_days long, demand_hr_month_prop double")
EC2 = "Amazon Elastic Compute Cloud"


def pool(itype, avg_unused, hours=10, az="us-east-1a"):
    return (EC2, "us-east-1", az, "linux", itype, hours, 1.0, 1.0, 1.0, float(avg_unused * hours),
            hours, 100.0)


def demand(itype, avg_used, hours=10, dollars=None, az="us-east-1b"):
    qty = float(avg_used * hours)
    return (EC2, "us-east-1", az, "linux", itype, hours,
            dollars if dollars is not None else qty * 0.5, qty, 1, 100.0)


def moves(spark, pools, demands):
    return candidate_moves(spark.createDataFrame(pools, HIGH_SCHEMA),
                           spark.createDataFrame(demands, OD_SCHEMA)).collect()


# fixed values: what the job's rules give
WEIGHTS = [
    ("m3.large", 2), ("m3.xlarge", 4), ("m3.2xlarge", 8), ("m4.4xlarge", 16),
    ("c4.8xlarge", 36), ("m4.8xlarge", 32), ("m4.10xlarge", 40), ("r4.10xlarge", 1),
    ("m4.16xlarge", 64), ("x1.32xlarge", 128), ("m3.medium", 1), ("m1.medium", 1),
    ("t2.nano", 1), ("t2.small", 1), ("t2.medium", 2), ("r5.12xlarge", 1), ("c5.metal", 1),
    ("t2.micro", 1), ("m5", 1), ("a..large", 2), (None, 1),
]


def test_cpu_weight_rules(spark):
    df = spark.createDataFrame([(t, c) for t, c in WEIGHTS], "t string, want int")
    got = with_cpu_weight(df, "t", "cpu", rule_rows(spark)).collect()
    assert len(got) == len(WEIGHTS)
    assert [(r["t"], r["cpu"]) for r in got if r["cpu"] != r["want"]] == []


@pytest.fixture
def rule_table_of(spark):
    names = []

    def build(rows):
        name = f"reshift_rules_{len(names)}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.createDataFrame(rows, "rank long, key string, kind string, weight long, note string").write.saveAsTable(name)
        names.append(name)
        return name

    yield build
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_rules_from_a_catalog_table(spark, rule_table_of):
    # the list as a table, in any row order, weighs as the list does
    rows = [(i, key, kind, weight, None) for i, (kind, key, weight) in enumerate(CPU_RULES)][::-1]
    df = spark.createDataFrame([(t,) for t, _ in WEIGHTS], "t string")
    got = with_cpu_weight(df, "t", "cpu", rule_table(spark, rule_table_of(rows))).collect()
    assert {r["t"]: r["cpu"] for r in got} == dict(WEIGHTS)


def test_rule_priorities_and_ties(spark, rule_table_of):
    rows = [(5, "large", "size", 3, None), (5, "m3.large", "type", 7, None),   # equal rank: the type rule
            (1, "xlarge", "size", 4, None), (2, "m3.xlarge", "type", 9, None),  # smaller rank first
            (2, "c4.xlarge", "type", 8, None), (0, "c4.xlarge", "type", 6, None),  # one key twice: smaller rank
            (3, "nano", "size", 5, None), (3, "nano", "size", 2, None),             # and then the smaller weight
            (0, None, "size", 99, None), (0, None, "type", 99, None)]
    df = spark.createDataFrame([("m3.large",), ("r5.large",), ("m3.xlarge",), ("c4.xlarge",), ("t2.nano",), ("t2.x",), (None,)], "t string")
    got = with_cpu_weight(df, "t", "cpu", rule_table(spark, rule_table_of(rows))).collect()
    assert {r["t"]: r["cpu"] for r in got} == {
        "m3.large": 7, "r5.large": 3, "m3.xlarge": 4, "c4.xlarge": 6, "t2.nano": 2, "t2.x": 1, None: 1}
    with pytest.raises(ValueError, match="unknown rule kind"):
        rule_rows(spark, [("shape", "large", 2)])
    wrong = rule_table(spark, rule_table_of([(1, "large", "shape", 2, None)]))
    with pytest.raises(Exception, match="unknown rule kind: shape"):
        with_cpu_weight(df, "t", "cpu", wrong).collect()


def test_weights_of_many_rules_are_joined(spark, rule_table_of):
    name = rule_table_of([(i, f"f{i}.s{i % 97}", "type", 1 + i % 50, None) for i in range(3_000)])
    df = spark.range(3_500).selectExpr("concat('f', id, '.s', id % 97) as t", "id")
    weighed = with_cpu_weight(df, "t", "cpu", rule_table(spark, name))
    assert weighed.where("cpu = case when id < 3000 then 1 + id % 50 else 1 end").count() == 3_500
    assert "CASE WHEN (t" not in weighed._jdf.queryExecution().toString()  # no list of names in the plan


def test_e1_demand_exceeds_pool(spark):
    # m3.xlarge 10 unused (40 CPU) vs m3.2xlarge 44 demanded (352 CPU)
    (m,) = moves(spark, [pool("m3.xlarge", 10)], [demand("m3.2xlarge", 44)])
    assert (m["instances_tobe_shifted"], m["ondemand_instances_reduced"]) == (10.0, 5.0)
    assert m["ondemand_instances_increased"] == 5.0
    assert m["savings"] == 10.0 * 10 * 0.5


def test_e2_pool_covers_demand(spark):
    # m3.xlarge 10 unused vs m3.large 4 demanded: 8 CPU needed
    (m,) = moves(spark, [pool("m3.xlarge", 10)], [demand("m3.large", 4)])
    assert (m["instances_tobe_shifted"], m["ondemand_instances_increased"]) == (2.0, 4.0)
    assert m["ondemand_instances_reduced"] == 4.0


def test_family_is_two_characters(spark):
    got = moves(spark, [pool("r5.xlarge", 10)],
                [demand("r5a.large", 4), demand("r4.large", 4, az="us-east-1c")])
    assert [m["ondemand_instancetype"] for m in got] == ["r5a.large"]


def test_unviable_moves_dropped_without_error(spark):
    got = moves(spark, [pool("m3.xlarge", 0.4), pool("m3.2xlarge", 10, az="us-east-1c")],
                [demand("m3.large", 0.0, dollars=0.0), demand("m3.medium", 0.4, az="us-east-1c")])
    # avg unused rounds to 0; zero quantity gives zero demand; 0.4 rounds to 0
    assert got == []


def random_market(spark, seed, pools=60, demands=60):
    import random

    rng = random.Random(seed)
    types = ["m3.medium", "m3.large", "m3.xlarge", "m3.2xlarge", "c4.large", "c4.8xlarge"]
    some = [pool(rng.choice(types), rng.randint(0, 40), az=f"us-east-1{chr(97 + i)}") for i in range(pools)]
    wanted = [demand(rng.choice(types), rng.randint(0, 60), az=f"us-east-1{chr(97 + i)}", dollars=float(rng.randint(1, 5)))
              for i in range(demands)]
    return spark.createDataFrame(some, HIGH_SCHEMA), spark.createDataFrame(wanted, OD_SCHEMA)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pairs_out_of_reach_change_no_pick(spark, seed):
    high, od = random_market(spark, seed)
    whole, near = candidate_moves(high, od), walk_candidates(high, od)
    columns = whole.columns
    cut = {tuple(r) for r in whole.collect()} - {tuple(r) for r in near.select(*columns).collect()}
    # what is cut asks for more than the pool has, and would give all of it
    short = [columns.index(c) for c in ("avg_ondemand_cpu_needed", "avg_unused_cpu_available",
                                        "instances_tobe_shifted", "avg_unused_instances")]
    assert len(cut) > 100 and all(r[short[0]] > r[short[1]] and r[short[2]] == r[short[3]] for r in cut)
    assert near.exceptAll(whole.select(*near.columns)).isEmpty()
    picks = [sorted(map(tuple, greedy_picks(c).collect()), key=repr) for c in (whole, near)]
    assert picks[0] == picks[1] and len(picks[0]) > 5


def test_fewer_pairs_are_made(spark):
    """A few large pools beside many small ones, and mostly large demands: most pairs are never made."""
    some = [pool("m3.medium", 1 + i % 7, az=f"z{i}") for i in range(200)] + [pool("m3.medium", 900, az="large")]
    wanted = [demand("m3.medium", 200 + i, az=f"z{i}") for i in range(100)] + [demand("m3.medium", 2, az="small")]
    pools, demands = _sides(spark.createDataFrame(some, HIGH_SCHEMA), spark.createDataFrame(wanted, OD_SCHEMA), CPU_RULES)
    assert pools.join(demands, ["productname", "region", "os", "family"]).count() == 201 * 101
    made = reachable_pairs(pools, demands)
    made.collect()
    plan = made._jdf.queryExecution().executedPlan()
    assert made.count() == 101 + sum(1 for i in range(200) if 1 + i % 7 >= 2)
    assert "CartesianProduct" not in plan.toString() and "NestedLoop" not in plan.toString()


def test_powers_of_two_stay_in_reach(spark):
    some = [pool("m3.medium", 2 ** k, az=f"z{k}") for k in range(31)]
    wanted = [demand("m3.medium", 2 ** k, az=f"z{k}") for k in range(31)]
    pools, demands = _sides(spark.createDataFrame(some, HIGH_SCHEMA), spark.createDataFrame(wanted, OD_SCHEMA), CPU_RULES)
    assert reachable_pairs(pools, demands).count() == 31 * 32 // 2
    zero = rule_rows(spark, [("size", "medium", 0)])
    pools, demands = _sides(spark.createDataFrame(some[:3], HIGH_SCHEMA), spark.createDataFrame(wanted[:3], OD_SCHEMA), zero)
    assert reachable_pairs(pools, demands).count() == 9
