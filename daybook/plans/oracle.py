"""DuckDB SQL for every registered query, over the raw test tables.

These are the independent statement of each result: the same semantics
written as plain SQL, run by a different engine. ``BASE`` holds the shared
CTEs (DuckDB ignores the ones a query does not use).
"""

from __future__ import annotations

from daybook.config import FIXTURE_CUT_DATE, RAW_COLUMNS

_LEAD = "date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date))"
_ORDER_ALL = ", ".join(f"{c} nulls first" for c in RAW_COLUMNS)
_RAW = ", ".join(RAW_COLUMNS)
CUT = f"date '{FIXTURE_CUT_DATE}'"

BASE = f"""
tx as (
  select concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) as transaction_id,
    strftime(l_shipdate, '%Y-%m-%d') as transaction_date,
    cast(year(l_shipdate) as int) as transaction_year,
    cast(quarter(l_shipdate) as int) as transaction_quarter,
    cast(month(l_shipdate) as int) as transaction_month,
    p_type as product_name, p_brand as product_category, 'EA' as quantity_unit,
    s_name as supplier_name, sn.n_name as supplier_country, s_acctbal as supplier_reliability_score,
    concat('REFINERY_', cast(s_nationkey as varchar)) as refinery_name,
    r_name as destination_city, o_orderpriority as transportation_mode,
    l_quantity as ordered_quantity, l_quantity as demand_quantity,
    cast(p_size as double) as available_inventory,
    cast(floor(l_extendedprice / l_quantity) as double) as unit_price_usd,
    p_retailprice as product_cost_usd, l_tax as transportation_cost_usd,
    l_extendedprice as total_cost_usd,
    cast(30 as int) as expected_lead_time_days,
    cast({_LEAD} as int) as actual_lead_time_days,
    cast(greatest({_LEAD} - 30, 0) as int) as delay_days,
    cast(case when {_LEAD} - 30 > 0 then 1 else 0 end as int) as is_delayed,
    cast(case when l_quantity > p_size then 1 else 0 end as int) as is_stockout,
    l_returnflag as quality_status, l_discount as quality_score, l_linestatus as disruption_type,
    o_orderstatus as delivery_status,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as ingestion_timestamp,
    c_mktsegment as source_system, 'INSERT' as operation_type
  from lineitem
    join orders on o_orderkey = l_orderkey
    join customer on c_custkey = o_custkey
    join nation cn on cn.n_nationkey = c_nationkey
    join region on r_regionkey = cn.n_regionkey
    join part on p_partkey = l_partkey
    join supplier on s_suppkey = l_suppkey
    join nation sn on sn.n_nationkey = s_nationkey
),
dedup as (
  select {_RAW} from (
    select *, row_number() over (partition by transaction_id order by {_ORDER_ALL}) as rn from tx
  ) where rn = 1
),
silver as (
  select * replace (cast(try_strptime(transaction_date, '%Y-%m-%d') as date) as transaction_date)
  from dedup
),
agg as (
  select transaction_date, product_name, destination_city,
    sum(demand_quantity) as total_demand, avg(unit_price_usd) as avg_unit_price,
    sum(available_inventory) as total_inventory, count(*) as transaction_count
  from silver group by 1, 2, 3
),
extent as (
  select product_name, destination_city, min(transaction_date) as first_date,
    max(transaction_date) as last_date
  from agg group by 1, 2
),
spine as (
  select product_name, destination_city,
    cast(unnest(generate_series(cast(first_date as timestamp), cast(last_date as timestamp),
      interval 1 day)) as date) as transaction_date
  from extent
),
full_days as (
  select s.transaction_date, s.product_name, s.destination_city,
    coalesce(a.total_demand, 0) as total_demand, a.avg_unit_price, a.total_inventory,
    coalesce(a.transaction_count, 0) as transaction_count
  from spine s left join agg a on s.transaction_date = a.transaction_date
    and s.product_name = a.product_name and s.destination_city = a.destination_city
),
feat as (
  select *, lag(total_demand, 1) over w as demand_1, lag(total_demand, 7) over w as demand_7,
    avg(total_demand) over (partition by product_name, destination_city order by transaction_date
      rows between 7 preceding and 1 preceding) as rolling_7_day_avg,
    cast(month(transaction_date) as int) as "month",
    cast(dayofweek(transaction_date) + 1 as int) as day_of_week
  from full_days
  window w as (partition by product_name, destination_city order by transaction_date)
),
test_rows as (
  select * from feat where transaction_date > {CUT}
),
preds as (
  select transaction_date, product_name, destination_city, total_demand as actual_demand,
    rolling_7_day_avg as predicted_demand, '1' as model_version from test_rows
  union all
  select transaction_date, product_name, destination_city, total_demand as actual_demand,
    demand_7 as predicted_demand, '2' as model_version from test_rows
)
"""

# Metrics per model version over ``preds``: n, r2, rmse, mae rounded to 6
# digits; r2 is 1.0 / 0.0 when the target is constant (SSE = 0 / SSE > 0).
METRICS = """
metrics as (
  select model_version, n,
    round(case when sst = 0 then (case when sse = 0 then 1.0 else 0.0 end) else 1 - sse / sst end, 6) as r2,
    round(sqrt(sse / n), 6) as rmse, round(sum_abs / n, 6) as mae
  from (
    select p.model_version, count(*) as n, sum((actual_demand - predicted_demand) ^ 2) as sse,
      sum((actual_demand - m.mean_y) ^ 2) as sst, sum(abs(actual_demand - predicted_demand)) as sum_abs
    from preds p join (
      select model_version, avg(actual_demand) as mean_y from preds
      where actual_demand is not null and predicted_demand is not null and not isnan(predicted_demand)
      group by 1) m on p.model_version = m.model_version
    where actual_demand is not null and predicted_demand is not null and not isnan(predicted_demand)
    group by 1
  ) s
)
"""


def with_base(select: str) -> str:
    return f"with {BASE}, {METRICS} {select}"
