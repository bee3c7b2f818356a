"""Test inputs derived from the provided tables.

``usage`` (hourly billing lines) is derived from ``events`` and
``reservations`` (the reservation inventory) from ``part``, row for row, with
the rules of FIXTURES.md section 2. The rules are pure column expressions, so
both builders are one narrow projection over a scan and grow with the
tables. The same derivation as DuckDB SQL lives in ``reshift.plans.oracle``.

Deviation from FIXTURES.md: the inventory is built from the *whole* ``part``
table (FIXTURES.md keeps ``p_partkey < 200``), so that it grows with the
scale factor; at sf0.001 ``part`` has exactly 200 rows and both agree.
Reservation ids are zero-padded to six digits and never truncated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# The fixture rules of FIXTURES.md section 2 as Spark SQL
# expressions (one analysis pass per table instead of one call per literal).
# Every 1,000 events and every 200 parts are a block with two regions of its own (the first one keeps
# the plain names), so the number of pools grows with the tables and a pool stays near its demand.
_BLOCK_SUFFIX = "case when block = 0 then '' else concat('-', cast(block as string)) end"
_REGION_BY_USER = f"concat(case user_id % 2 when 0 then 'us-east-1' else 'us-west-2' end, {_BLOCK_SUFFIX})"
_REGION_BY_PART = ("concat(case cast(floor(p_partkey / 2) as bigint) % 2 "
                   f"when 0 then 'us-east-1' else 'us-west-2' end, {_BLOCK_SUFFIX})")
# Instance types of a block, by block % 4: together they meet every CPU rule, its default and families
# that share two letters.
TYPES_BY_BLOCK = (
    ("m3.medium", "m3.large", "m3.xlarge", "m3.2xlarge", "c4.large", "c4.8xlarge", "m1.small"),
    ("m4.large", "m4.4xlarge", "m4.8xlarge", "m4.10xlarge", "m4.16xlarge", "t2.nano", "t2.small"),
    ("r5.large", "r5a.xlarge", "r5.2xlarge", "x1.16xlarge", "x1.32xlarge", "m1.medium", "m1.small"),
    ("t2.medium", "t2.small", "t2.nano", "m3.medium", "m3.large", "c4.8xlarge", "c4.xlarge"),
)


def _type(number: str) -> str:
    """The ``number``-th type of the block's list."""
    lists = " ".join(f"when {b} then array({', '.join(repr(t) for t in types)})"
                     for b, types in enumerate(TYPES_BY_BLOCK))
    return f"get(case block % {len(TYPES_BY_BLOCK)} {lists} end, cast({number} as int))"


USAGE_RULES = (
    "case when event_id % 11 = 0 then 'AMAZON ELASTIC COMPUTE CLOUD' "
    "when event_id % 13 = 0 then 'Amazon Simple Storage Service' "
    "else 'Amazon Elastic Compute Cloud' end as productname",
    "cast(date_trunc('hour', ts) as timestamp_ntz) as usagestartdate",
    "cast(date_trunc('hour', ts) + case when event_id % 50 = 0 then interval 2 hours "
    "else interval 1 hour end as timestamp_ntz) as usageenddate",
    f"{_REGION_BY_USER} as region",
    f"case when event_id % 101 = 0 then null else concat({_REGION_BY_USER}, "
    "case event_id % 3 when 0 then 'a' when 1 then 'b' else 'c' end) end as availabilityzone",
    "case when k = 7 then null else case k % 8 when 0 then 'Linux' when 1 then 'Windows' "
    "when 2 then 'windows' when 3 then 'N/A' else 'linux' end end as os",
    f"case when cast(floor(event_id / 3) as bigint) % 8 = 0 then null "
    f"else {_type('cast(floor(event_id / 3) as bigint) % 8 - 1')} end as instancetype",
    "case event_type when 'click' then 'reservedinstance' when 'view' then 'reservedinstance' "
    "when 'signup' then 'spot' else 'on-demand' end as purchaseoption",
    "cast(1 + k % 3 as double) as usagequantity",
    "cast(1 + k % 3 as double) * cast(0.25 as double) * cast(1 + user_id % 4 as double) "
    "as unblendedcost",
    "case when event_id % 37 = 0 then 'GB' else 'Hour' end as measure",
    "case when event_id % 41 = 0 then null "
    "when event_id % 43 = 0 then 'data transfer 10 Mbps per Instance' "
    "when event_id % 47 = 0 then 'EBS snapshot' "
    "else 'per On Demand Instance Hour' end as itemdescription",
)

RESERVATION_RULES = (
    "concat('acct-', cast(p_partkey % 3 as string)) as account_id",
    "format_string('ri-%06d', p_partkey) as reserved_instance_id",
    "case p_partkey % 2 when 0 then 'Partial Upfront' else 'All Upfront' end as offering_type",
    f"{_REGION_BY_PART} as region",
    f"concat({_REGION_BY_PART}, case cast(floor(p_partkey / 4) as bigint) % 4 "
    "when 0 then 'a' when 1 then 'b' when 2 then 'c' else '' end) as availability_zone",
    "case p_partkey % 5 when 0 then 'Windows (Amazon VPC)' when 1 then 'Windows' "
    "when 2 then 'Linux/UNIX' when 3 then 'Linux/UNIX (Amazon VPC)' "
    "else 'SUSE Linux' end as product_description",
    f"concat({_type('cast(floor(p_partkey / 3) as bigint) % 7')}, "
    "case when p_partkey % 7 = 0 then ' ' else '' end) as instance_type",
    "cast(p_size % 6 as int) as instance_count",
    "case when p_partkey % 10 = 9 then 'retired' else 'active' end as state",
)


def usage_from_events(events: DataFrame) -> DataFrame:
    """Hourly billing lines, one per event."""
    with_k = events.selectExpr("*", "cast(regexp_extract(props, '[0-9]+', 0) as int) as k",
                               "cast(floor(event_id / 1000) as bigint) as block")
    return with_k.selectExpr(*USAGE_RULES)


def reservations_from_part(part: DataFrame) -> DataFrame:
    """Reservation inventory, one reservation per part."""
    blocks = part.selectExpr("*", "cast(floor(p_partkey / 200) as bigint) as block")
    return blocks.selectExpr(*RESERVATION_RULES)
