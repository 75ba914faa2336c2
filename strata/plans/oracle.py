"""DuckDB SQL twins of the registered queries (the correctness oracle).

The tables of the driver's testdata are views in DuckDB. Every oracle starts
with the same chain of CTEs that rebuilds the store and its processing layer
in plain SQL (fixtures, cleaning, fingerprints, SCD2 as a ``union all``), then
states the query from its definition.
"""

from __future__ import annotations

# Fixed values shared with strata.plans.warehouse.
EFF = "date '2000-06-01'"
RETIRED = "date '2000-07-01'"
THIRD = "date '2000-09-01'"
REPORT = "date '2000-05-31'"
LATER = "date '2001-01-01'"
RANGE = "date '1996-03-15' and date '1999-10-20'"
OPEN = "date '4444-01-01'"
BEGIN = "date '1980-01-01'"


def _clean(x: str) -> str:
    kept = f"regexp_replace(trim(regexp_replace({x}, '[^a-zA-Z0-9'']', ' ', 'g')), '\\s+', ' ', 'g')"
    return f"array_to_string(list_transform(string_split({kept}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"


def _hash(*cols: str, marker: bool = True) -> str:
    def escaped(c: str) -> str:
        return f"replace(replace(cast({c} as varchar), '\\', '\\\\'), '~', '\\~')"

    parts = [f"coalesce({escaped(c)}, '\\N')" if marker else f"cast({c} as varchar)" for c in cols]
    return f"sha256(concat_ws('~', {', '.join(parts)}))"


def _asof(alias: str, d: str = REPORT, inclusive: bool = False) -> str:
    if inclusive:
        return f"{d} between {alias}.beg_date and {alias}.exp_date"
    return f"{alias}.beg_date <= {d} and {d} < {alias}.exp_date"


def _scd2_sql(table: str, src: str, cols: list[str], day: str) -> str:
    """One SCD2 load of ``src`` over a table that may have closed history."""
    names = ["id", *cols, "hash"]
    t_cols, s_cols = (", ".join(f"{x}.{c}" for c in names) for x in "ts")
    return f"""
      select {", ".join(names)}, beg_date, exp_date from {table} where exp_date <> {OPEN}
      union all
      select {t_cols}, t.beg_date, case when s.hash <> t.hash then {day} else t.exp_date end as exp_date
      from {table} t left join {src} s on s.id = t.id
      where t.exp_date = {OPEN} and not coalesce(s.hash <> t.hash and t.beg_date = {day}, false)
      union all
      select {s_cols}, case when exists (select 1 from {table} h where h.id = s.id) then {day} else {BEGIN} end as beg_date,
             {OPEN} as exp_date
      from {src} s where not exists (select 1 from {table} t where t.id = s.id and t.exp_date = {OPEN} and t.hash = s.hash)"""


CUST = ["type", "status", "createdOn"]
ITEM = ["Codes", "Descriptions", "price"]
ADDR = ["city", "state", "country", "validFlag"]
JOB_COLS = ["job_id", "job_name", "date", "start_time", "end_time", "duration", "status"]

MOVED_CITY = "case when id % 8 = 1 then 'Newtown' else city end"
MOVED_STATE = "case when id % 8 = 1 then 'S9' else state end"

CTES: list[tuple[str, str]] = [
    (
        "customers",
        "select c_custkey as id, c_mktsegment as type, case when c_acctbal > 9000 then 'VIP' else 'REGULAR' end as status, "
        "cast(min(o_orderdate) as date) as createdOn from customer left join orders on o_custkey = c_custkey "
        "group by c_custkey, c_mktsegment, c_acctbal",
    ),
    (
        "addresses",
        "select c_custkey as id, case when c_custkey % 4 = 0 then n_name else replace(n_name,'NATION_','Nation ') end as city, "
        "concat('S', cast(c_custkey % 3 as varchar)) as state, concat(upper(substr(r_name,1,1)), lower(substr(r_name,2))) as country "
        "from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey",
    ),
    (
        "items",
        "select p_partkey as id, p_brand as Codes, p_name as Descriptions, cast(p_retailprice as decimal(18,2)) as price from part",
    ),
    (
        "fct_orders",
        "select o_orderkey as id, o_custkey as customerId, o_custkey as addressId, cast(o_orderdate as date) + 30 as deliveryDate, "
        "case when o_orderstatus = 'F' then cast(o_orderdate as date) + cast(o_orderkey % 60 as int) end as deliveredOn from orders",
    ),
    (
        "raw_orderdetails",
        "select l_orderkey as orderId, l_partkey as itemId, cast(l_quantity as decimal(18,2)) as quantity from lineitem",
    ),
    (
        "fct_orderdetails",
        "select concat_ws('_', cast(itemId as varchar), cast(orderId as varchar)) as id, orderId, itemId, "
        "cast(sum(quantity) as decimal(18,2)) as totalQuantity from raw_orderdetails group by orderId, itemId",
    ),
    ("customers_s1", "select * from customers where id % 50 <> 7"),
    (
        "customers_s2",
        "select id, case when id % 10 = 0 then 'PREMIUM' else type end as type, case when id % 10 = 3 then 'VIP' else status end as status, "
        "createdOn from customers where id % 25 <> 24",
    ),
    (
        "items_s2",
        "select id, Codes, Descriptions, case when id % 20 = 0 then cast(price * cast(1.10 as decimal(4,2)) as decimal(18,2)) else price end as price from items",
    ),
    (
        "customers_dup",
        "select id, type, status, createdOn, 1 as load_no from customers union all "
        "select id, 'DUP' as type, status, createdOn, 2 as load_no from customers where id % 100 = 0",
    ),
    (
        "addresses_clean",
        f"select id, {_clean('city')} as city, {_clean('state')} as state, {_clean('country')} as country, "
        f"case when {_clean('city')} = city and {_clean('state')} = state and {_clean('country')} = country then 1 else 0 end as validFlag "
        "from addresses",
    ),
    (
        "addresses_s2_clean",
        f"select id, city, state, {_clean('country')} as country, case when city = raw_city and state = raw_state and "
        f"{_clean('country')} = country then 1 else 0 end as validFlag from (select id, country, "
        f"{_clean(MOVED_CITY)} as city, {MOVED_CITY} as raw_city, {_clean(MOVED_STATE)} as state, {MOVED_STATE} as raw_state from addresses)",
    ),
    ("addresses_seed", f"select *, {_hash(*ADDR)} as hash, {BEGIN} as beg_date, {OPEN} as exp_date from addresses_clean"),
    ("addresses_src", f"select *, {_hash(*ADDR)} as hash from addresses_s2_clean"),
    ("dim_addresses", _scd2_sql("addresses_seed", "addresses_src", ADDR, EFF)),
    ("customers_seed", f"select *, {_hash(*CUST)} as hash, {BEGIN} as beg_date, {OPEN} as exp_date from customers_s1"),
    ("customers_src", f"select *, {_hash(*CUST)} as hash from customers_s2"),
    ("dim_customers", _scd2_sql("customers_seed", "customers_src", CUST, EFF)),
    ("items_seed", f"select *, {_hash(*ITEM)} as hash, {BEGIN} as beg_date, {OPEN} as exp_date from items"),
    ("items_src", f"select *, {_hash(*ITEM)} as hash from items_s2"),
    ("dim_items", _scd2_sql("items_seed", "items_src", ITEM, EFF)),
]

_PRELUDE = "with " + ",\n".join(f"{name} as ({sql})" for name, sql in CTES)


#: The third load and its correction, over the second load's result with some versions closed.
THIRD_LOAD = f"""customers_s3 as (select id, case when id % 12 = 0 then 'PARTNER' else type end as type, status, createdOn
                    from customers_s2 where id % 9 <> 8),
    customers_s4 as (select id, case when id % 24 = 0 then 'CORRECTED' else type end as type, status, createdOn from customers_s3),
    s3_src as (select *, {_hash(*CUST)} as hash from customers_s3),
    s4_src as (select *, {_hash(*CUST)} as hash from customers_s4),
    retired as (select * replace (case when exp_date = {OPEN} and id % 17 = 5 then {RETIRED} else exp_date end as exp_date)
                from dim_customers),
    after_s3 as ({_scd2_sql("retired", "s3_src", CUST, THIRD)}),
    dim_third as ({_scd2_sql("after_s3", "s4_src", CUST, THIRD)})"""


def q(body: str, extra_ctes: str = "") -> str:
    """Oracle text: the shared CTE chain, optional extra CTEs, then the body."""
    return _PRELUDE + (",\n" + extra_ctes if extra_ctes else "") + "\n" + body


def _ratio_half_up(num: str, den: str) -> str:
    """Twin of strata.functions.numeric.ratio_half_up with scale 2."""
    return (
        f"case when {den} > 0 then cast(cast(sign({num}) * ((abs({num}) * 200 + {den}) // (2 * {den})) "
        f"as decimal(38,0)) * 0.01 as decimal(38,2)) end"
    )


def _month(c: str) -> str:
    return f"strftime(date_trunc('month', {c}), '%Y-%b')"


def _tasks_ctes(prefix: str, where: str = "") -> str:
    """Runs of a user's day and the latest start per (task_key, run)."""
    return f"""{prefix}_ev as (select event_id, user_id, event_type, epoch_us(ts) // 1000 as ms,
                                 cast(ts as date) as day from events {where}),
    {prefix}_runs as (select user_id, day, min(event_id) as run_id, min(ms) as start_ms, max(ms) as end_ms
                      from {prefix}_ev group by user_id, day),
    {prefix}_tasks as (
      select task_key, job_run_id, make_timestamp(start_ms * 1000) as start_time,
             make_timestamp(end_ms * 1000) as end_time, status
      from (select e.event_type as task_key, r.run_id as job_run_id, e.ms as start_ms, e.ms + 1000 as end_ms,
                   case when e.event_type = 'error' then 'FAILED' else 'SUCCESS' end as status
            from {prefix}_ev e join {prefix}_runs r on e.user_id = r.user_id and e.day = r.day)
      qualify row_number() over (partition by task_key, job_run_id order by start_ms desc) = 1)"""


def _jobs_sql(runs: str) -> str:
    """Jobs log of one listing of runs."""
    return f"""select r.run_id as job_run_id, r.user_id % 3 as job_id,
               case r.user_id % 3 when 0 then 'ingestion' when 1 then 'processing' else 'monitoring' end as job_name,
               cast(make_timestamp(r.start_ms * 1000) as date) as date,
               make_timestamp(r.start_ms * 1000) as start_time, make_timestamp(r.end_ms * 1000) as end_time,
               cast(r.end_ms - r.start_ms as double) / 1000.0 as duration,
               case when r.user_id % 7 = 0 then 'SUCCESS' when r.user_id % 5 = 0 then 'FAILED' else 'SUCCESS' end as status
        from {runs} r"""


def _upsert_all(t: str, s: str, keys: list[str], cols: list[str], own: tuple[str, ...] = ()) -> str:
    """``own``: columns that only the table has."""
    on = " and ".join(f"t.{k} = s.{k}" for k in keys)
    present = f"s.{keys[0]} is not null"
    out = [f"coalesce(t.{k}, s.{k}) as {k}" for k in keys]
    out += [f"case when {present} then s.{c} else t.{c} end as {c}" for c in cols]
    out += [f"t.{c}" for c in own]
    return f"select {', '.join(out)} from {t} t full join {s} s on {on}"


def _new_customers(days: str, report: str) -> str:
    return f"""select {_month('month')} as ReportingPeriod, type, status, count(*) as NewCustomerNumber from (
          select date_trunc('month', c.createdOn) as month, c.type, c.status from dim_customers c
          where {_asof('c', report)} and c.createdOn between {days}) group by month, type, status"""


def _daily(days: str) -> str:
    return f"""select strftime(day, '%Y-%m-%d') as ReportingPeriod, n as Orders_Number from (
          select deliveryDate as day, count(*) as n from fct_orders group by deliveryDate) where day between {days}"""


def _if_changed() -> str:
    cols = [*CUST, "hash", "loaded_on"]
    old, new = "t.id is not null and (s.id is null or s.hash = t.hash)", "s"
    picked = ", ".join(f"case when {old} then t.{c} else {new}.{c} end as {c}" for c in cols)
    return f"""select coalesce(t.id, s.id) as id, {picked}
        from (select *, date '2000-01-01' as loaded_on from customers_seed) t
        full join (select *, date '2000-06-01' as loaded_on from customers_src) s on t.id = s.id"""


def _two_runs(grain: list[str]) -> str:
    """The later run's rows, and the earlier run's where the later one has none of the grain."""
    same = " and ".join(f"l.{g} = e.{g}" for g in grain)
    return f"""select * from later union all
        select e.* from earlier e where not exists (select 1 from later l where {same})"""


ORACLES: dict[str, str] = {
    "mart_city_sales": q(
        """select city, count(*) as TotalOrders, cast(sum(revenue) as decimal(38,4)) as TotalRevenue from sold
        join delivered using (orderId) group by city""",
        f"""priced as (select id as itemId, price from dim_items i where {_asof('i')}),
        sold as (select orderId, sum(totalQuantity * price) as revenue from fct_orderdetails join priced using (itemId) group by orderId),
        delivered as (select o.id as orderId, (select a.city from dim_addresses a where a.id = o.addressId and {_asof('a')}) as city
                      from fct_orders o where o.deliveredOn is not null
                      and exists (select 1 from dim_addresses a where a.id = o.addressId and {_asof('a')}))""",
    ),
    "join_inner": q(
        f"""select o.id as orderId, o.customerId, a.city, a.state, a.country
        from (select * from dim_addresses where exp_date = {OPEN}) a, fct_orders o where a.id = o.addressId"""
    ),
    "mart_geo_orders": q(
        """select country, state, count(*) as OrdersCount from (
          select distinct p.country, p.state, o.id from places p join fct_orders o on o.addressId = p.id) group by all""",
        "places as (select distinct id, country, state from dim_addresses)",
    ),
    "mart_product_performance": q(
        """select Codes, Descriptions, cast(sum(units) as decimal(38,2)) as TotalUnitsSold,
               cast(sum(units * price) as decimal(38,4)) as TotalRevenue
        from (select itemId, sum(totalQuantity) as units from fct_orderdetails group by itemId) u
        join valid on valid.id = u.itemId group by all""",
        f"valid as (select id, Codes, Descriptions, price from dim_items i where {_asof('i')})",
    ),
    "mart_city_delivery": q(
        f"""select city, sum(n)::bigint as OrdersCount, {_ratio_half_up("sum(days) * 24", "sum(known)")} as AvgHoursDelivery
        from late join valid using (addressId) group by city""",
        f"""late as (select addressId, count(*) as n, sum(deliveredOn - deliveryDate) as days, count(deliveredOn) as known
                     from fct_orders group by addressId),
        valid as (select id as addressId, city from dim_addresses a where {_asof('a')})""",
    ),
    "mart_vip_cities": q(
        f"""select city, count(*) as NumberOfVIPCustomers from (
          select a.city, v.id from vip v join fct_orders o on o.customerId = v.id
          join (select id, city from dim_addresses a where {_asof('a')}) a on a.id = o.addressId group by all)
        group by city order by 2 desc, 1 limit 5""",
        f"vip as (select id from dim_customers c where c.status = 'VIP' and {_asof('c')})",
    ),
    "mart_orders_monthly": q(
        f"""select {_month('month')} as ReportingPeriod, sum(n)::bigint as Orders_Number from (
          select date_trunc('month', deliveryDate) as month, count(*) as n from fct_orders
          where deliveryDate between {RANGE} group by deliveryDate) group by month"""
    ),
    "mart_new_customers": q(_new_customers(RANGE, REPORT)),
    "mart_orders_daily": q(_daily(RANGE)),
    "period_filter": q(
        "select * from fct_orders where deliveryDate between date '1997-01-01' and date '1998-12-31'"
    ),
    "orderdetails_rollup": q("select * from fct_orderdetails"),
    "surrogate_key": q(
        "select concat_ws('_', cast(itemId as varchar), cast(orderId as varchar)) as id, orderId, itemId, quantity "
        "from raw_orderdetails"
    ),
    "clean_strings": q("select * from addresses_clean"),
    "valid_flag": q("select id, validFlag from addresses_clean"),
    "mart_valid_addresses": q(
        f"""select validFlag, count(*) as count from (
          select if(validFlag = 1, 'Valid', 'Invalid') as validFlag from dim_addresses a where {_asof('a')}) group by validFlag"""
    ),
    "row_hash": q(
        f"select id, {_hash(*CUST, marker=False)} as hash_plain, {_hash(*CUST)} as hash from customers"
    ),
    "dedupe_key": q(
        "select * from customers_dup qualify row_number() over (partition by id order by load_no desc) = 1"
    ),
    "dedupe_latest": q(
        "select * from events qualify row_number() over "
        "(partition by event_type, user_id order by ts desc, event_id desc) = 1"
    ),
    "upsert_all": q(_upsert_all("customers_s1", "customers_s2", ["id"], CUST)),
    "upsert_bucketed": q(_if_changed()),
    "upsert_composite": q(
        _upsert_all("stored", "new_tasks", ["job_run_id", "task_key"], ["start_time", "end_time", "status"], ("loaded_on",)),
        _tasks_ctes("old", "where ts < timestamp '2024-01-16'") + ",\n" + _tasks_ctes("new", "where user_id % 11 <> 3")
        + ",\nstored as (select *, date '2000-01-01' as loaded_on from old_tasks)",
    ),
    "upsert_if_changed": q(_if_changed()),
    "upsert_column": q(
        """select case when t.id is not null then t.id else s.id end as id,
               case when t.id is not null then t.orderId else s.orderId end as orderId,
               case when t.id is not null then t.itemId else s.itemId end as itemId,
               case when t.id is null then s.totalQuantity
                    when s.id is not null and t.totalQuantity is distinct from s.totalQuantity then s.totalQuantity
                    else t.totalQuantity end as totalQuantity,
               case when t.id is not null then date '2000-01-01' else date '2000-06-01' end as loaded_on
        from old_fct t full join (select * from fct_orderdetails where itemId % 13 <> 5) s
          on t.orderId is not distinct from s.orderId and t.itemId is not distinct from s.itemId""",
        """old_fct as (
          select concat_ws('_', cast(itemId as varchar), cast(orderId as varchar)) as id, orderId, itemId,
                 cast(sum(quantity) as decimal(18,2)) as totalQuantity
          from (select l_orderkey as orderId, l_partkey as itemId, cast(l_quantity as decimal(18,2)) as quantity
                from lineitem where l_shipdate < timestamp '1998-01-01')
          group by orderId, itemId)""",
    ),
    "mart_new_customers_merge": q(
        _two_runs(["ReportingPeriod", "type", "status"]),
        f"""earlier as ({_new_customers("date '1995-01-01' and date '1995-06-20'", REPORT)}),
        later as ({_new_customers("date '1995-06-15' and date '1995-12-31'", LATER)})""",
    ),
    "mart_orders_daily_merge": q(
        _two_runs(["ReportingPeriod"]),
        f"""earlier as ({_daily("date '1996-03-15' and date '1998-02-10'")}),
        later as ({_daily("date '1998-02-05' and date '1999-10-20'")})""",
    ),
    "mart_runner_sql": q(
        f"""select a.state, count(o.deliveredOn) as Delivered, count(*) as Orders
        from fct_orders o join dim_addresses a on a.id = o.addressId and {_asof('a', LATER)}
        where o.deliveryDate >= date '1996-03-15' group by a.state"""
    ),
    "mart_merge_period": q(
        """select coalesce(e.ReportingPeriod, l.ReportingPeriod) as ReportingPeriod,
               case when l.ReportingPeriod is not null then l.Orders_Number else e.Orders_Number end as Orders_Number
        from earlier e full join later l on e.ReportingPeriod = l.ReportingPeriod""",
        f"""earlier as (select {_month('deliveryDate')} as ReportingPeriod, count(1) as Orders_Number from fct_orders
                        where deliveryDate between date '1995-01-01' and date '1999-06-15' group by 1),
        later as (select {_month('deliveryDate')} as ReportingPeriod, count(1) as Orders_Number from fct_orders
                  where deliveryDate between date '1999-06-01' and date '2001-12-31' group by 1)""",
    ),
    "mart_period_partitions": q(
        """select coalesce(e.ReportingPeriod, l.ReportingPeriod) as ReportingPeriod,
               case when l.ReportingPeriod is not null then l.Orders_Number else e.Orders_Number end as Orders_Number
        from earlier e full join later l on e.ReportingPeriod = l.ReportingPeriod""",
        f"""earlier as (select {_month('deliveryDate')} as ReportingPeriod, count(1) as Orders_Number from fct_orders
                        where deliveryDate between date '1995-01-01' and date '1999-06-15' group by 1),
        later as (select {_month('deliveryDate')} as ReportingPeriod, count(1) as Orders_Number from fct_orders
                  where deliveryDate between date '1999-06-01' and date '2001-12-31' group by 1)""",
    ),
    "scd2_seed": q("select * from customers_seed"),
    "scd2_apply": q("select * from dim_customers"),
    "scd2_current": q(f"select * from dim_customers where exp_date = {OPEN}"),
    "scd2_third_load": q("select * from dim_third", THIRD_LOAD),
    "scd2_default_date": q(
        f"""select id, type, status, case when beg_date = {EFF} then 0 end as days_since, exp_date = {OPEN} as is_open
        from dim_customers"""
    ),
    "asof_before": q(f"select * from dim_third c where {_asof('c')}", THIRD_LOAD),
    "asof_dim": q(f"select * from dim_third c where {_asof('c', EFF)}", THIRD_LOAD),
    "asof_after": q(f"select * from dim_third c where {_asof('c', LATER)}", THIRD_LOAD),
    "asof_inclusive": q(f"select * from dim_third c where {_asof('c', EFF, inclusive=True)}", THIRD_LOAD),
    "asof_join": q(
        f"""select o.id as orderId, o.customerId, c.type, c.status, o.deliveryDate, c.beg_date
        from fct_orders o join dim_customers c on o.customerId = c.id and {_asof('c')}"""
    ),
    "bootstrap_ignore": q("select * from customers_s1"),
    "ingest_overwrite": q("select * from customers_s2"),
    "append_load": q("select * from customers_dup"),
    "reconcile_counts": q(
        """select count(*) as source_rows, count(distinct id) as target_rows, count(*) = count(distinct id) as rows_match
        from customers_dup"""
    ),
    "reconcile_keys": q(
        """select source_rows, target_rows, source_keys, target_keys,
               source_rows = target_rows as rows_match, source_keys = target_keys as keys_match
        from (select (select count(*) from customers_dup) as source_rows,
                     (select count(*) from loaded) as target_rows,
                     (select count(distinct id) from customers_dup) as source_keys,
                     (select count(distinct id) from loaded) as target_keys)""",
        "loaded as (select * from customers_dup qualify row_number() over (partition by id order by load_no desc) = 1)",
    ),
    "reporting_periods": """with cal as (select distinct cast(o_orderdate as date) as d from orders)
        select 'daily' as frequency, d as report_date, d - 1 as beg_date, d - 1 as exp_date from cal
        union all select 'weekly', d, d - 7, d - 1 from cal where isodow(d) = 1
        union all select 'monthly', d, cast(d - interval 1 month as date), d - 1 from cal where day(d) = 1
        union all select 'yearly', d, make_date(year(d) - 1, 1, 1), make_date(year(d) - 1, 12, 31) from cal
                  where month(d) = 1 and day(d) = 1""",
    "period_rollup": q(
        """select 'daily' as frequency, deliveryDate as beg_date, deliveryDate as exp_date, count(*) as Orders_Number
             from fct_orders where deliveryDate is not null group by deliveryDate
        union all
        select 'weekly', cast(date_trunc('week', deliveryDate) as date), cast(date_trunc('week', deliveryDate) as date) + 6,
               count(*) from fct_orders where deliveryDate is not null group by date_trunc('week', deliveryDate)
        union all
        select 'monthly', cast(date_trunc('month', deliveryDate) as date), max(last_day(deliveryDate)), count(*)
             from fct_orders where deliveryDate is not null group by date_trunc('month', deliveryDate)
        union all
        select 'yearly', cast(date_trunc('year', deliveryDate) as date), make_date(year(deliveryDate), 12, 31), count(*)
             from fct_orders where deliveryDate is not null group by date_trunc('year', deliveryDate), year(deliveryDate)"""
    ),
    "runlog_jobs": q(_jobs_sql("all_runs"), _tasks_ctes("all")),
    "runlog_tasks": q("select * from all_tasks", _tasks_ctes("all")),
    "runlog_from_json": q(_jobs_sql("all_runs"), _tasks_ctes("all")),
    "runlog_jobs_upsert": q(
        _upsert_all("stored", "new_jobs", ["job_run_id"], JOB_COLS, ("loaded_on",)),
        _tasks_ctes("old", "where ts < timestamp '2024-01-16'") + ",\n" + _tasks_ctes("new", "where user_id % 11 <> 3")
        + f",\nstored as (select *, date '2000-01-01' as loaded_on from ({_jobs_sql('old_runs')})),\nnew_jobs as ({_jobs_sql('new_runs')})",
    ),
    "stream_latest_events": "select * from events qualify row_number() over "
    "(partition by event_type, user_id order by ts desc, event_id desc) = 1",
}

# Adds its own to ORACLES; here, as it is written with the helpers above.
import strata.plans.oracle_upkeep  # noqa: E402, F401
