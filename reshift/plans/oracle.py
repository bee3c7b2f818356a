"""DuckDB SQL for every query key: an independent statement of each stage.

The SQL follows the job's own formulation where ours differs (left join plus
filter, ``sum(active) / count(*)``, date casts for the window, the CPU rule
list as one ordered CASE), so agreement checks the rewrites too. The two
greedy allocators are recursive CTEs that walk one row per step.

Views ``events`` and ``part`` must be registered; parameters are those of
``reshift.plans.queries.TEST_PARAMS``.
"""

from __future__ import annotations

from dataclasses import replace

from reshift.params import RunParams
from reshift.plans.features import BACKFILL_DATES
from reshift.plans.queries import QUERY_KEYS, TEST_PARAMS


# The job's CPU weights, written out here on their own.
CPU_SQL = """CAST(CASE
  WHEN {size} = 'large' THEN 2 WHEN {size} = 'xlarge' THEN 4 WHEN {size} = '2xlarge' THEN 8
  WHEN {size} = '4xlarge' THEN 16 WHEN {type} = 'c4.8xlarge' THEN 36 WHEN {size} = '8xlarge' THEN 32
  WHEN {type} = 'm4.10xlarge' THEN 40 WHEN {size} = '16xlarge' THEN 64 WHEN {size} = '32xlarge' THEN 128
  WHEN {type} IN ('m1.medium', 't2.nano', 't2.small', 'm3.medium') THEN 1 WHEN {size} = 'medium' THEN 2
  ELSE 1 END AS INTEGER)"""

# The fixtures' instance types by block of keys.
TYPE_SQL = """(CASE block % 4
  WHEN 0 THEN ['m3.medium','m3.large','m3.xlarge','m3.2xlarge','c4.large','c4.8xlarge','m1.small']
  WHEN 1 THEN ['m4.large','m4.4xlarge','m4.8xlarge','m4.10xlarge','m4.16xlarge','t2.nano','t2.small']
  WHEN 2 THEN ['r5.large','r5a.xlarge','r5.2xlarge','x1.16xlarge','x1.32xlarge','m1.medium','m1.small']
  ELSE ['t2.medium','t2.small','t2.nano','m3.medium','m3.large','c4.8xlarge','c4.xlarge'] END)"""
SUFFIX_SQL = "CASE WHEN block = 0 THEN '' ELSE concat('-', block) END"


def _cpu_case(col: str) -> str:
    """The CPU weight of an instance type."""
    return CPU_SQL.format(size=f"string_split_regex({col}, '[.]+')[2]", type=col)


def _ctes(params: RunParams) -> list[tuple[str, str]]:
    """The stages as (CTE head, SQL body) pairs, for one set of run parameters."""
    run_date = params.run_date.isoformat()
    lookback = params.lookback_days
    cutoff = float(params.cutoff_pct)
    return [
        ("usage", f"""
 select case when event_id%11=0 then 'AMAZON ELASTIC COMPUTE CLOUD' when event_id%13=0 then 'Amazon Simple Storage Service' else 'Amazon Elastic Compute Cloud' end as productname,
 cast(date_trunc('hour',ts) as timestamp) as usagestartdate,
 cast(date_trunc('hour',ts) + case when event_id%50=0 then interval 2 hour else interval 1 hour end as timestamp) as usageenddate,
 concat(case user_id%2 when 0 then 'us-east-1' else 'us-west-2' end, {SUFFIX_SQL}) as region,
 case when event_id%101=0 then null else concat(concat(case user_id%2 when 0 then 'us-east-1' else 'us-west-2' end, {SUFFIX_SQL}), case event_id%3 when 0 then 'a' when 1 then 'b' else 'c' end) end as availabilityzone,
 case when k=7 then null else case k%8 when 0 then 'Linux' when 1 then 'Windows' when 2 then 'windows' when 3 then 'N/A' else 'linux' end end as os,
 case when cast(floor(event_id/3) as bigint)%8 = 0 then null else {TYPE_SQL}[cast(floor(event_id/3) as bigint)%8] end as instancetype,
 case event_type when 'click' then 'reservedinstance' when 'view' then 'reservedinstance' when 'signup' then 'spot' else 'on-demand' end as purchaseoption,
 cast(1+k%3 as double) as usagequantity,
 cast(1+k%3 as double) * cast(0.25 as double) * cast(1+user_id%4 as double) as unblendedcost,
 case when event_id%37=0 then 'GB' else 'Hour' end as measure,
 case when event_id%41=0 then null when event_id%43=0 then 'data transfer 10 Mbps per Instance' when event_id%47=0 then 'EBS snapshot' else 'per On Demand Instance Hour' end as itemdescription
 from (select *, cast(regexp_extract(props,'[0-9]+',0) as int) as k, cast(floor(event_id/1000) as bigint) as block from events) e"""),
        ("reservations", f"""
 select concat('acct-',cast(p_partkey%3 as varchar)) as account_id, printf('ri-%06d', p_partkey) as reserved_instance_id,
 case p_partkey%2 when 0 then 'Partial Upfront' else 'All Upfront' end as offering_type,
 concat(case cast(floor(p_partkey/2) as bigint)%2 when 0 then 'us-east-1' else 'us-west-2' end, {SUFFIX_SQL}) as region,
 concat(concat(case cast(floor(p_partkey/2) as bigint)%2 when 0 then 'us-east-1' else 'us-west-2' end, {SUFFIX_SQL}), case cast(floor(p_partkey/4) as bigint)%4 when 0 then 'a' when 1 then 'b' when 2 then 'c' else '' end) as availability_zone,
 case p_partkey%5 when 0 then 'Windows (Amazon VPC)' when 1 then 'Windows' when 2 then 'Linux/UNIX' when 3 then 'Linux/UNIX (Amazon VPC)' else 'SUSE Linux' end as product_description,
 concat({TYPE_SQL}[cast(floor(p_partkey/3) as bigint)%7 + 1], case when p_partkey%7=0 then ' ' else '' end) as instance_type,
 cast(p_size%6 as int) as instance_count, case when p_partkey%10=9 then 'retired' else 'active' end as state
 from (select *, cast(floor(p_partkey/200) as bigint) as block from part) p"""),
        ("window_filter", f"""
 SELECT * FROM usage
 WHERE lower(productname) = 'amazon elastic compute cloud'
   AND date_diff('second', usagestartdate, usageenddate) <= 3600
   AND CAST(usagestartdate AS DATE) <= DATE '{run_date}'
   AND CAST(usagestartdate AS DATE) > DATE '{run_date}' - {lookback}"""),
        ("reserved_hourly", """
 SELECT productname,
   CAST(year(usagestartdate) AS INTEGER) AS yr, CAST(month(usagestartdate) AS INTEGER) AS mon,
   CAST(day(usagestartdate) AS INTEGER) AS dy, CAST(hour(usagestartdate) AS INTEGER) AS hr,
   region, availabilityzone, lower(b.os) AS os, coalesce(b.instancetype, 'm1.small') AS instancetype,
   sum(usagequantity) AS consumption, sum(unblendedcost) AS dollar
 FROM window_filter b
 WHERE purchaseoption = 'reservedinstance'
 GROUP BY productname, year(usagestartdate), month(usagestartdate), day(usagestartdate),
   hour(usagestartdate), region, availabilityzone, b.os, b.instancetype"""),
        ("reservation_list", """
 SELECT account_id, reserved_instance_id, offering_type, region, availability_zone,
   CASE WHEN lower(product_description) LIKE '%windows%' THEN 'windows'
        WHEN lower(product_description) LIKE '%linux%' THEN 'linux'
        ELSE product_description END AS os,
   trim(instance_type) AS instancetype, CAST(sum(instance_count) AS BIGINT) AS active,
   product_description, instance_type
 FROM reservations WHERE state = 'active'
 GROUP BY account_id, reserved_instance_id, offering_type, region, availability_zone,
   product_description, instance_type"""),
        ("active_pools", """
 SELECT region, availability_zone, os, instancetype, CAST(sum(active) AS BIGINT) AS active
 FROM reservation_list GROUP BY region, availability_zone, os, instancetype"""),
        ("pool_match", """
 SELECT DISTINCT c.productname, c.yr, c.mon, c.dy, c.hr, c.region, c.availabilityzone, c.os,
   c.instancetype, c.consumption, c.dollar, a.availability_zone, a.active
 FROM reserved_hourly c
 LEFT JOIN active_pools a ON c.region = a.region AND c.os = a.os AND c.instancetype = a.instancetype
 WHERE c.availabilityzone = a.availability_zone OR c.region = a.availability_zone"""),
        ("hourly_balance", """
 SELECT *, CASE WHEN active - consumption < 0 THEN CAST(0 AS DOUBLE) ELSE active - consumption END AS unused_ri
 FROM (SELECT productname, yr, mon, dy, hr, region, availability_zone, os, instancetype,
         sum(dollar) AS dollar, sum(consumption) AS consumption, sum(active) / count(*) AS active
       FROM pool_match
       GROUP BY productname, yr, mon, dy, hr, region, availability_zone, os, instancetype) x"""),
        ("unused_daily", """
 SELECT *, unused_ritotal_hrs * 100 / hrcount AS non_usage_hr_prop_day
 FROM (SELECT productname, yr, mon, dy, region, availability_zone, os, instancetype,
         count(hr) AS hrcount, sum(dollar) AS dollarsum, sum(consumption) AS consumptionsum,
         sum(active) AS activesum, sum(unused_ri) AS unused_ritotal,
         CAST(sum(CASE WHEN unused_ri > 0 THEN 1 ELSE 0 END) AS BIGINT) AS unused_ritotal_hrs
       FROM hourly_balance
       GROUP BY productname, yr, mon, dy, region, availability_zone, os, instancetype) x"""),
        ("unused_window", """
 SELECT *, unused_ritotal_hrs * 100 / hrcount AS non_usage_hr_prop_month
 FROM (SELECT productname, region, availability_zone, os, instancetype,
         count(hr) AS hrcount, sum(dollar) AS dollarsum, sum(consumption) AS consumptionsum,
         sum(active) AS activesum, sum(unused_ri) AS unused_ritotal,
         CAST(sum(CASE WHEN unused_ri > 0 THEN 1 ELSE 0 END) AS BIGINT) AS unused_ritotal_hrs
       FROM hourly_balance
       GROUP BY productname, region, availability_zone, os, instancetype) x"""),
        ("high_unused", f"""
 SELECT * FROM unused_window WHERE non_usage_hr_prop_month >= {cutoff}"""),
        ("ondemand_hourly", """
 SELECT productname,
   CAST(year(usagestartdate) AS INTEGER) AS yr, CAST(month(usagestartdate) AS INTEGER) AS mon,
   CAST(day(usagestartdate) AS INTEGER) AS dy, CAST(hour(usagestartdate) AS INTEGER) AS hr,
   region, availabilityzone, lower(b.os) AS os,
   coalesce(b.instancetype, 'm1.small') AS ondemand_instancetype,
   sum(usagequantity) AS quantity_used, sum(unblendedcost) AS dollar_spent
 FROM window_filter b
 WHERE purchaseoption = 'on-demand'
   AND instr(lower(itemdescription), 'instance') > 0
   AND NOT instr(itemdescription, 'Mbps') > 0
   AND measure = 'Hour'
   AND b.os != 'N/A'
 GROUP BY productname, year(usagestartdate), month(usagestartdate), day(usagestartdate),
   hour(usagestartdate), region, availabilityzone, b.os, b.instancetype"""),
        ("ondemand_daily", """
 SELECT productname, yr, mon, dy, region, availabilityzone, os, ondemand_instancetype,
   count(hr) AS ondemand_hrs, sum(dollar_spent) AS dollar_spent,
   sum(quantity_used) AS quantity_used, count(hr) * 100 / 24 AS demand_hr_day_prop
 FROM ondemand_hourly
 GROUP BY productname, yr, mon, dy, region, availabilityzone, os, ondemand_instancetype"""),
        ("ondemand_window", """
 SELECT productname, region, availabilityzone, os, ondemand_instancetype,
   count(hr) AS ondemand_hrs, sum(dollar_spent) AS dollar_spent,
   sum(quantity_used) AS quantity_used, count(DISTINCT dy) AS ondemand_days,
   (count(hr) * 100) / (count(DISTINCT dy) * 24) AS demand_hr_month_prop
 FROM ondemand_hourly
 GROUP BY productname, region, availabilityzone, os, ondemand_instancetype"""),
        ("cpu_weight", f"""
 SELECT instancetype, {_cpu_case('instancetype')} AS cpu
 FROM (SELECT coalesce(instancetype, 'm1.small') AS instancetype FROM window_filter
       UNION SELECT trim(instance_type) FROM reservations) t"""),
        ("candidate_moves", f"""
 SELECT productname, region, availability_zone, os, instancetype, availabilityzone,
   ondemand_instancetype, hrcount, dollarsum, consumptionsum, activesum, unused_ritotal,
   unused_ritotal_hrs, non_usage_hr_prop_month, ondemand_hrs, quantity_used, dollar_spent,
   ondemand_days, demand_hr_month_prop, unused_instance_cpu, ondemand_instance_cpu,
   avg_unused_instances, avg_ondemand_instances, avg_unused_cpu_available,
   avg_ondemand_cpu_needed, instances_tobe_shifted, ondemand_instances_reduced,
   ondemand_instances_increased, savings
 FROM (
  SELECT *,
    round(instances_tobe_shifted * unused_instance_cpu / ondemand_instance_cpu) AS ondemand_instances_increased,
    instances_tobe_shifted * ondemand_hrs * (dollar_spent / quantity_used) AS savings
  FROM (
   SELECT *,
     CASE WHEN avg_ondemand_cpu_needed > avg_unused_cpu_available
          THEN round(avg_unused_cpu_available / unused_instance_cpu)
          ELSE round(avg_ondemand_cpu_needed / unused_instance_cpu) END AS instances_tobe_shifted,
     CASE WHEN avg_ondemand_cpu_needed > avg_unused_cpu_available
          THEN round(avg_unused_cpu_available / ondemand_instance_cpu)
          ELSE round(avg_ondemand_cpu_needed / ondemand_instance_cpu) END AS ondemand_instances_reduced
   FROM (
    SELECT *, avg_unused_instances * unused_instance_cpu AS avg_unused_cpu_available,
      avg_ondemand_instances * ondemand_instance_cpu AS avg_ondemand_cpu_needed
    FROM (
     SELECT h.productname, h.region, h.availability_zone, h.os, h.instancetype,
       d.availabilityzone, d.ondemand_instancetype, h.hrcount, h.dollarsum, h.consumptionsum,
       h.activesum, h.unused_ritotal, h.unused_ritotal_hrs, h.non_usage_hr_prop_month,
       d.ondemand_hrs, d.quantity_used, d.dollar_spent, d.ondemand_days, d.demand_hr_month_prop,
       {_cpu_case('h.instancetype')} AS unused_instance_cpu,
       {_cpu_case('d.ondemand_instancetype')} AS ondemand_instance_cpu,
       round(h.unused_ritotal / h.hrcount) AS avg_unused_instances,
       round(d.quantity_used / d.ondemand_hrs) AS avg_ondemand_instances
     FROM high_unused h
     LEFT JOIN ondemand_window d ON h.productname = d.productname AND h.region = d.region AND h.os = d.os
     WHERE substr(d.ondemand_instancetype, 1, 2) = substr(h.instancetype, 1, 2)) a) b) c) d
 WHERE avg_unused_instances > 0 AND ondemand_instances_reduced > 0 AND instances_tobe_shifted >= 1"""),
        ("walk_input", """
 SELECT *, substr(instancetype, 1, 2) AS fam,
   productname || '|' || instancetype || '|' || availability_zone AS pool_id,
   coalesce(availabilityzone, '~null~') || '|' || ondemand_instancetype AS demand_id,
   row_number() OVER (PARTITION BY region, os, substr(instancetype, 1, 2)
     ORDER BY productname DESC, instancetype DESC, availability_zone DESC,
              savings DESC NULLS LAST, availabilityzone ASC NULLS LAST,
              ondemand_instancetype ASC) AS rn
 FROM candidate_moves"""),
        ("walk(region, os, fam, rn, pool_id, used, claimed, took)", """
 SELECT DISTINCT region, os, fam, CAST(0 AS BIGINT), CAST(NULL AS VARCHAR), CAST(0 AS DOUBLE),
   CAST([] AS VARCHAR[]), false
 FROM walk_input
 UNION ALL
 SELECT region, os, fam, rn, pool_id,
   CASE WHEN took THEN prior + shift ELSE prior END,
   CASE WHEN took THEN list_append(claimed, demand_id) ELSE claimed END,
   took
 FROM (
   SELECT i.region, i.os, i.fam, i.rn, i.pool_id, i.demand_id,
     i.instances_tobe_shifted AS shift, w.claimed,
     CASE WHEN i.pool_id = w.pool_id THEN w.used ELSE 0 END AS prior,
     (NOT list_contains(w.claimed, i.demand_id))
       AND (CASE WHEN i.pool_id = w.pool_id THEN w.used ELSE 0 END)
           + i.instances_tobe_shifted < i.avg_unused_instances AS took
   FROM walk w JOIN walk_input i
     ON i.region = w.region AND i.os = w.os AND i.fam = w.fam AND i.rn = w.rn + 1) s"""),
        ("picks", """
 SELECT i.* FROM walk_input i JOIN walk w
   ON i.region = w.region AND i.os = w.os AND i.fam = w.fam AND i.rn = w.rn
 WHERE w.took"""),
        ("suggestions", """
 SELECT productname, region, availability_zone AS unused_ri_availabilityzone, os,
   instancetype AS unused_ri_instancetype, avg_unused_instances,
   CASE WHEN region = availability_zone THEN availability_zone ELSE availabilityzone END
     AS ondemand_availabilityzone,
   ondemand_instancetype, avg_ondemand_instances, instances_tobe_shifted,
   ondemand_instances_increased, savings
 FROM picks"""),
        ("moves", """
 SELECT region, availability_zone, os, instancetype, productname,
   CASE WHEN region = availability_zone THEN availability_zone ELSE availabilityzone END
     AS ondemand_availabilityzone,
   ondemand_instancetype, instances_tobe_shifted AS shift, savings,
   row_number() OVER (PARTITION BY region, availability_zone, os, instancetype
     ORDER BY productname DESC, savings DESC NULLS LAST, availabilityzone ASC NULLS LAST,
              ondemand_instancetype ASC) AS k
 FROM picks"""),
        ("res_rows", """
 SELECT *, row_number() OVER (PARTITION BY region, availability_zone, os, instancetype
   ORDER BY account_id ASC NULLS FIRST, reserved_instance_id ASC NULLS FIRST,
            offering_type ASC NULLS FIRST, region ASC NULLS FIRST,
            availability_zone ASC NULLS FIRST, product_description ASC NULLS FIRST,
            instance_type ASC NULLS FIRST) AS j
 FROM reservation_list"""),
        ("pool_caps", """
 SELECT region, availability_zone, os, instancetype, list(CAST(active AS DOUBLE) ORDER BY j) AS rem
 FROM res_rows GROUP BY region, availability_zone, os, instancetype"""),
        ("fit(region, availability_zone, os, instancetype, k, rem, idx)", """
 SELECT region, availability_zone, os, instancetype, CAST(0 AS BIGINT), rem, CAST(NULL AS BIGINT)
 FROM pool_caps
 UNION ALL
 SELECT region, availability_zone, os, instancetype, k,
   CASE WHEN idx IS NULL THEN rem
        ELSE list_transform(rem, lambda x, p: CASE WHEN p = idx THEN x - shift ELSE x END) END,
   idx
 FROM (
   SELECT f.region, f.availability_zone, f.os, f.instancetype, m.k, f.rem, m.shift,
     list_position(list_transform(f.rem, lambda x: x >= m.shift AND x > 0), true) AS idx
   FROM fit f JOIN moves m
     ON m.region = f.region AND m.availability_zone = f.availability_zone AND m.os = f.os
    AND m.instancetype = f.instancetype AND m.k = f.k + 1) s"""),
        ("reservation_shift", """
 SELECT m.productname, r.reserved_instance_id, r.account_id, r.offering_type, r.instancetype,
   r.region, r.availability_zone, r.os, r.active, m.ondemand_availabilityzone,
   m.ondemand_instancetype, m.shift AS active_instances_tobe_shifted, m.savings
 FROM fit f
 JOIN moves m ON m.region = f.region AND m.availability_zone = f.availability_zone
   AND m.os = f.os AND m.instancetype = f.instancetype AND m.k = f.k
 JOIN res_rows r ON r.region = f.region AND r.availability_zone = f.availability_zone
   AND r.os = f.os AND r.instancetype = f.instancetype AND r.j = f.idx
 WHERE m.shift > 0"""),
    ]


def _cte_name(head: str) -> str:
    return head.split("(")[0]


def sql_for(key: str, params: RunParams = TEST_PARAMS) -> str:
    """``WITH RECURSIVE`` over the stages up to ``key``, selecting ``key``."""
    ctes = _ctes(params)
    names = [_cte_name(h) for h, _ in ctes]
    upto = names.index(key) + 1
    body = ",\n".join(f"{head} AS ({text}\n)" for head, text in ctes[:upto])
    return f"WITH RECURSIVE {body}\nSELECT * FROM {key}"


def sql_between(first: str, last: str, params: RunParams = TEST_PARAMS) -> str:
    """The stages ``first`` .. ``last`` only; earlier stages must exist as views."""
    ctes = _ctes(params)
    names = [_cte_name(h) for h, _ in ctes]
    lo, hi = names.index(first), names.index(last) + 1
    body = ",\n".join(f"{head} AS ({text}\n)" for head, text in ctes[lo:hi])
    return f"WITH RECURSIVE {body}\nSELECT * FROM {last}"


def _rollups_sql() -> str:
    pool = "productname, region, availability_zone, os, instancetype"
    sums = "hrcount, dollarsum, consumptionsum, activesum, unused_ritotal, unused_ritotal_hrs"
    return (f"SELECT {pool}, yr, mon, dy, {sums}, non_usage_hr_prop_day AS non_usage_hr_prop FROM ({sql_for('unused_daily')})\n"
            f"UNION ALL SELECT {pool}, NULL, NULL, NULL, {sums}, non_usage_hr_prop_month FROM ({sql_for('unused_window')})")


def _hours_sql() -> str:
    keys = "productname, yr, mon, dy, hr, region, availabilityzone, os"
    return (f"SELECT 'reserved' AS branch, {keys}, instancetype, consumption AS quantity, dollar AS cost "
            f"FROM ({sql_for('reserved_hourly')})\n"
            f"UNION ALL SELECT 'ondemand', {keys}, ondemand_instancetype, quantity_used, dollar_spent "
            f"FROM ({sql_for('ondemand_hourly')})")


def _dated_sql(key: str) -> str:
    """One run for each date of the back-fill."""
    return "\nUNION ALL ".join(f"SELECT *, '{date}' AS dt FROM ({sql_for(key, replace(TEST_PARAMS, run_date=date))})"
                               for date in BACKFILL_DATES)


def oracle_sql() -> dict[str, str]:
    return {key: sql_for(key) for key in QUERY_KEYS} | {
        "unused_rollups": _rollups_sql(),
        "walk_candidates": f"SELECT * FROM ({sql_for('candidate_moves')}) "
                           "WHERE avg_ondemand_cpu_needed <= avg_unused_cpu_available",
        "incremental_hourly": _hours_sql(),
        "backfill_suggestions": _dated_sql("suggestions"),
        "backfill_shifts": _dated_sql("reservation_shift"),
    }
