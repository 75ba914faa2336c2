"""DuckDB SQL twins of ``strata.plans.upkeep``: the definitions by range joins, recomputation and plain comparison."""

from __future__ import annotations

from strata.plans import oracle
from strata.plans.oracle import BEGIN, CUST, OPEN, RETIRED, THIRD, THIRD_LOAD, _asof, _hash, _jobs_sql, _month, _ratio_half_up, _scd2_sql, _tasks_ctes, q

# Fixed values shared with strata.plans.upkeep.
LATE = "date '2000-07-15'"
FOURTH = "date '2000-12-01'"

_NAMES = ", ".join(["id", *CUST, "hash"])


def _valid(alias: str, day: str) -> str:
    return f"{alias}.beg_date <= {day} and {day} < {alias}.exp_date"


def _late() -> str:
    """Cut the version of the day into pieces, add the load's, and join what touches and has one hash."""
    return f"""pieces as (
      select {_NAMES}, beg_date, exp_date from before_late t
      where not coalesce({_valid('t', LATE)} and exists (select 1 from late_src l where l.id = t.id and l.hash <> t.hash), false)
      union all
      select {_NAMES}, beg_date, {LATE} from cut where beg_date < {LATE}
      union all
      select {_NAMES}, {THIRD}, exp_date from cut where exp_date > {THIRD}
      union all
      select {", ".join(f"l.{c}" for c in ["id", *CUST, "hash"])}, {LATE}, least(c.exp_date, {THIRD}) from late_src l join cut c using (id)
      union all
      select {_NAMES}, {LATE}, least({THIRD}, coalesce((select min(t.beg_date) from before_late t where t.id = l.id and t.beg_date > {LATE}), {OPEN}))
      from late_src l where exists (select 1 from before_late t where t.id = l.id)
        and not exists (select 1 from before_late t where t.id = l.id and {_valid('t', LATE)})
      union all
      select {_NAMES}, {BEGIN}, {OPEN} from late_src l where not exists (select 1 from before_late t where t.id = l.id)),
    runs as (
      select *, sum(new_run) over (partition by id order by beg_date) as run from (
        select *, (lag(hash) over w is distinct from hash or lag(exp_date) over w <> beg_date)::int as new_run
        from pieces window w as (partition by id order by beg_date)))"""


_BEFORE_LATE = f"""customers_s3 as (select id, case when id % 12 = 0 then 'PARTNER' else type end as type, status, createdOn from customers_s2 where id % 9 <> 8),
    s3_src as (select *, {_hash(*CUST)} as hash from customers_s3),
    retired as (select * replace (case when exp_date = {OPEN} and id % 17 = 5 then {RETIRED} else exp_date end as exp_date) from dim_customers),
    before_late as ({_scd2_sql("retired", "s3_src", CUST, THIRD)}),
    late_src as (select *, {_hash(*CUST)} as hash from (
      select id, case when id % 6 = 1 then 'LATE' when id % 24 = 0 then 'PARTNER' else type end as type, status, createdOn from customers_s2 where id % 7 <> 6
      union all select id + 1000000, type, status, createdOn from customers where id % 40 = 3)),
    cut as (select t.* from before_late t join late_src l on l.id = t.id and l.hash <> t.hash where {_valid('t', LATE)})"""

_KEPT = "t.id is not null and (s.id is null or s.hash = t.hash)"

ORACLES: dict[str, str] = {
    "asof_by_fact_date": q(
        f"""select o.id as orderId, o.customerId, o.deliveryDate, c.type, c.status, c.beg_date as valid_from
        from fct_orders o left join dim_third c on c.id = o.customerId and {_valid('c', 'o.deliveryDate')}""",
        THIRD_LOAD,
    ),
    "mart_sales_on_the_day": q(
        f"""select {_month('o.deliveryDate')} as ReportingPeriod, a.city, cast(sum(d.totalQuantity) as decimal(38,2)) as TotalUnits,
               cast(sum(d.totalQuantity * i.price) as decimal(38,4)) as TotalRevenue
        from fct_orders o join fct_orderdetails d on d.orderId = o.id
        join dim_addresses a on a.id = o.addressId and {_valid('a', 'o.deliveryDate')}
        join dim_items i on i.id = d.itemId and {_valid('i', 'o.deliveryDate')}
        group by 1, 2"""
    ),
    "scd2_late_load": q(
        f"select {', '.join(f'any_value({c}) as {c}' for c in ['type', 'status', 'createdOn'])}, id, hash, min(beg_date) as beg_date, max(exp_date) as exp_date "
        "from runs group by id, hash, run",
        _BEFORE_LATE + ",\n" + _late(),
    ),
    "scd2_replay": q(
        "select * from after_s4",
        f"""customers_s3 as (select id, case when id % 12 = 0 then 'PARTNER' else type end as type, status, createdOn from customers_s2 where id % 9 <> 8),
    s3_src as (select *, {_hash(*CUST)} as hash from customers_s3),
    s4_src as (select *, {_hash(*CUST)} as hash from (select id, case when id % 24 = 0 then 'CORRECTED' else type end as type, status, createdOn from customers_s3)),
    after_s3 as ({_scd2_sql("dim_customers", "s3_src", CUST, THIRD)}),
    after_s4 as ({_scd2_sql("after_s3", "s4_src", CUST, FOURTH)})""",
    ),
    "mart_city_delivery_kept_up": q(
        f"""select a.city, count(*) as OrdersCount,
               {_ratio_half_up("sum(m.deliveredOn - m.deliveryDate) * 24", "count(m.deliveredOn)")} as AvgHoursDelivery
        from merged m join dim_addresses a on a.id = m.addressId and {_asof('a')} group by a.city""",
        """merged as (
          select * from fct_orders where id % 13 <> 5
          union all
          select * replace (case when deliveredOn < date '1998-01-01' then deliveredOn end as deliveredOn)
          from fct_orders where id % 13 = 5 and deliveryDate < date '1999-01-01')""",
    ),
    "mart_city_sales_kept_up": q(
        f"""select a.city, count(distinct o.id) as TotalOrders, cast(sum(m.totalQuantity * i.price) as decimal(38,4)) as TotalRevenue
        from merged m join fct_orders o on o.id = m.orderId and o.deliveredOn is not null
        join dim_addresses a on a.id = o.addressId and {_asof('a')}
        join dim_items i on i.id = m.itemId and {_asof('i')} group by a.city""",
        """stored as (
          select orderId, itemId, sum(quantity) as totalQuantity
          from (select l_orderkey as orderId, l_partkey as itemId, cast(l_quantity as decimal(18,2)) as quantity
                from lineitem where l_shipdate < timestamp '1998-01-01') group by orderId, itemId),
        merged as (
          select orderId, itemId, totalQuantity from fct_orderdetails where itemId % 13 <> 5
          union all select * from stored where itemId % 13 = 5)""",
    ),
    "mart_customers_distinct": q(
        """select f.frequency, cast(date_trunc(f.unit, o.deliveryDate) as date) as beg_date, count(distinct o.customerId) as Customers
        from fct_orders o, (values ('monthly', 'month'), ('quarterly', 'quarter'), ('yearly', 'year')) f(frequency, unit)
        where o.deliveryDate between date '1995-01-01' and date '2001-12-31' group by 1, 2"""
    ),
    "reconcile_differences": q(
        """select coalesce(s.id, t.id) as id, case when t.id is null then 'missing' when s.id is null then 'extra' else 'changed' end as difference,
               coalesce(s.n, 0) as source_rows, coalesce(t.n, 0) as target_rows
        from (select id, count(*) as n, list(concat_ws('|', type, status, createdOn)) as r from customers_s2 group by id) s
        full join (select id, count(*) as n, list_sort(list(concat_ws('|', type, status, createdOn))) as r from loaded group by id) t on s.id = t.id
        where s.id is null or t.id is null or s.r <> t.r""",
        """copied as (select id, type, case when id % 89 = 5 then 'LOST' else status end as status, createdOn from customers_s2 where id % 97 <> 3),
        loaded as (select * from copied union all select * from copied where id % 101 = 7
                   union all select * from customers_s1 where id % 50 = 49)""",
    ),
}

ORACLES |= {
    "load_report": q(
        """select count(*) as table_rows, count_if(t.id is null) as insert_rows, count_if(t.hash <> s.hash) as update_rows,
               count_if(t.hash = s.hash) as keep_rows, count_if(s.id is null) as absent_rows,
               count_if(case when t.id is null or t.hash <> s.hash then s.createdOn is null else t.createdOn is null end) as invalid_rows
        from customers_seed t full join customers_src s on s.id = t.id"""
    ),
    "upsert_touched_ranges": q(
        f"""select coalesce(t.id, s.id) as id, {", ".join(f"case when {_KEPT} then t.{c} else s.{c} end as {c}" for c in [*CUST, "hash", "loaded_on"])}
        from (select *, date '2000-01-01' as loaded_on from customers_seed) t
        full join (select *, date '2000-06-01' as loaded_on from customers_src where (id // 100) % 5 = 1) s on s.id = t.id"""
    ),
    "append_rerun": q("select * from customers_dup"),
    "mart_city_sales_bucketed": oracle.ORACLES["mart_city_sales"],
    "runlog_from_drifting": q(
        """select job_run_id, job_id, job_name, date, start_time, end_time, duration, status, null::varchar as line, null::varchar as rejected
        from (select * from jobs where job_run_id % 6 not in (3, 4))
        union all
        select null, null, null, null, null, null, null, null,
               case when job_run_id % 6 = 3 then '{"run_id": ' || job_run_id || ', broken'
                    else '{"job_id":' || job_id || ',"start_time":' || epoch_ms(start_time) || ',"end_time":' || epoch_ms(end_time) || '}' end,
               case when job_run_id % 6 = 3 then 'no JSON' else 'no run id' end
        from jobs where job_run_id % 6 in (3, 4)""",
        _tasks_ctes("all") + f",\njobs as ({_jobs_sql('all_runs')})",
    ),
    "stream_first_seen": "select * from events",
    "stream_latest_changes": oracle.ORACLES["stream_latest_events"],
    "period_rollup_filled": q(
        """select s.frequency, s.city, s.beg_date, s.exp_date, count(p.addressId) as Orders_Number
        from (select * from spans, (select distinct city from placed)) s
        left join placed p on p.city = s.city and p.deliveryDate between s.beg_date and s.exp_date
        group by 1, 2, 3, 4""",
        f"""placed as (select o.addressId, o.deliveryDate, a.city from fct_orders o join dim_addresses a on a.id = o.addressId and {_asof('a')}),
        ends as (select min(deliveryDate) as a, max(deliveryDate) as z from placed),
        spans as (
          select 'daily' as frequency, cast(d as date) as beg_date, cast(d as date) as exp_date from ends, unnest(generate_series(a, z, interval 1 day)) t(d)
          union all select 'weekly', cast(d as date), cast(d as date) + 6 from ends, unnest(generate_series(date_trunc('week', a), z, interval 7 day)) t(d)
          union all select 'monthly', cast(d as date), last_day(cast(d as date)) from ends, unnest(generate_series(date_trunc('month', a), z, interval 1 month)) t(d)
          union all select 'yearly', cast(d as date), make_date(year(d), 12, 31) from ends, unnest(generate_series(date_trunc('year', a), z, interval 1 year)) t(d))""",
    ),
}

oracle.ORACLES.update(ORACLES)
