"""The fixture derivations and warehouse layers as DuckDB SQL (oracle side).

Independent re-statement of ``emporia.sources.fixtures`` and the operators,
written as SQL over the driver's views.  ``with_ctes(sql, *names)`` prepends
the needed CTEs (dependencies resolved) to a query.
"""

from __future__ import annotations

AS_OF = "2024-01-31"

# name -> (sql, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def _cte(name: str, sql: str, deps: tuple[str, ...] = ()):
    CTES[name] = (sql.strip(), deps)


_cte("startup_log", """
select event_id, 'mid_' || cast(user_id as varchar) mid, cast(user_id as varchar) uid,
       'AR' || cast(user_id % 34 as varchar) ar, event_type ch, 'v' || cast(user_id % 5 as varchar) vc,
       case when event_type in ('view', 'signup') then 'icon' end start_entry,
       epoch_us(ts) // 1000 ts
from events
""")

_cte("startup_dated", """
select *, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') dt, strftime(make_timestamp(ts * 1000), '%H') hr
from startup_log
""", ("startup_log",))

_cte("dau", """
select mid, uid, ar, ch, vc, dt, hr, '00' mi, ts from (
  select *, row_number() over (partition by dt, mid order by ts, ch nulls first, uid nulls first, ar nulls first, vc nulls first) rn
  from startup_dated where start_entry is not null) x
where rn = 1
""", ("startup_dated",))

_cte("province", """
select n_nationkey id, n_name name, cast(100000 + n_nationkey * 1000 as varchar) area_code,
       'CN-' || cast(n_nationkey as varchar) iso_code, 'CN-P' || cast(n_nationkey as varchar) iso_3166_2
from nation where n_nationkey <> 24
""")

_cte("user_info", """
select c_custkey id, cast(c_custkey % 3 + 1 as varchar) user_level,
       date '1950-01-01' + cast(c_custkey % 25000 * 9973 % 25000 as integer) birthday,
       case when c_custkey % 10 = 0 then null when c_custkey % 2 = 0 then 'M' else 'F' end gender
from customer where c_custkey % 97 <> 0
""")

_cte("users", f"""
select id, user_level, birthday, gender,
       case when age < 20 then '20岁及以下' when age > 30 then '30岁以上' when age is not null then '21岁到30岁' end age_group,
       case when gender = 'M' then '男' else '女' end gender_name
from (select *, cast(floor((date '{AS_OF}' - birthday) / 365.0) as bigint) age from user_info) u
""", ("user_info",))

_cte("category3", """
select cast(row_number() over (order by p_type) as integer) id, p_type name, 1 category2_id
from (select distinct p_type from part) t
""")

_cte("trademark", """
select distinct cast(replace(p_brand, 'Brand#', '') as bigint) tm_id, p_brand tm_name
from part where p_brand <> 'Brand#7'
""")

_cte("spu", """
select distinct p_partkey % 200 id, 'SPU_' || cast(p_partkey % 200 as varchar) spu_name from part
""")

_cte("sku", """
select p_partkey id, p_partkey % 200 spu_id, p_retailprice price, p_name sku_name,
       cast(replace(p_brand, 'Brand#', '') as bigint) tm_id, k.id category3_id
from part join category3 k on k.name = p_type
""", ("category3",))

_cte("skus", """
select s.id, s.spu_id, s.price, s.sku_name, s.tm_id, s.category3_id,
       k.name category3_name, p.spu_name, t.tm_name
from sku s left join category3 k on k.id = s.category3_id
left join trademark t on t.tm_id = s.tm_id
left join spu p on p.id = s.spu_id
""", ("sku", "category3", "trademark", "spu"))

_cte("numbered_lines", """
select *, cast(l_extendedprice as decimal(12,2)) * (l_partkey % 3 + 1) o,
       row_number() over (partition by l_orderkey order by l_partkey, l_suppkey, l_linenumber,
             l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) n
from lineitem
""")

_cte("order_info", """
select o_orderkey id, c_nationkey province_id, o_orderstatus order_status, o_custkey user_id,
       cast(o_totalprice as decimal(12,2)) final_total_amount,
       cast(gross + o_orderkey % 3 * 5 - cast(o_totalprice as decimal(12,2)) as decimal(12,2)) benefit_reduce_amount,
       cast(gross as decimal(12,2)) original_total_amount,
       cast(o_orderkey % 3 * 5 as decimal(12,2)) feight_fee,
       o_orderdate + to_seconds(cast(o_orderkey % 86400 * 7919 % 86400 as bigint)) create_time
from (select *, coalesce(t, 0) + case when o_orderkey % 11 = 5 then 100 when o_orderkey % 11 = 6 then -coalesce(last, 0) else 0 end gross
      from orders left join (
        select l_orderkey, cast(sum(o) as decimal(12,2)) t, max(case when n = c then o end) last
        from (select *, count(*) over (partition by l_orderkey) c from numbered_lines) x group by l_orderkey) g
      on l_orderkey = o_orderkey) y
join customer on c_custkey = o_custkey
""", ("numbered_lines",))

_cte("order_detail", """
select l_orderkey * (select max(c) + 1 from (select count(*) c from lineitem group by l_orderkey) m) + n id, l_orderkey order_id, l_partkey sku_id,
       cast(l_extendedprice as decimal(12,2)) order_price, cast(l_partkey % 3 + 1 as integer) sku_num, p_name sku_name,
       o_orderdate + to_seconds(cast(o_orderkey % 86400 * 7919 % 86400 as bigint))
         + to_seconds(cast(case when n % 2 = 0 then (l_orderkey % 11 * 310 + n % 11 * 31) % 11
                                else (l_orderkey % 900 * 310 + n % 900 * 31) % 900 end as bigint)) create_time
from numbered_lines l
join part on p_partkey = l_partkey
join orders on o_orderkey = l_orderkey
""", ("numbered_lines",))

_cte("dwd_order", """
select o.id, o.province_id, o.order_status, o.user_id, o.final_total_amount, o.benefit_reduce_amount,
       o.original_total_amount, o.feight_fee, cast(null as varchar) expire_time,
       strftime(o.create_time, '%Y-%m-%d %H:%M:%S') create_time, cast(null as varchar) operate_time,
       strftime(o.create_time, '%Y-%m-%d') create_date, strftime(o.create_time, '%H') create_hour,
       cast(null as varchar) if_first_order,
       p.name province_name, p.area_code province_area_code, p.iso_3166_2 province_3166_2_code,
       u.age_group user_age_group, u.gender_name user_gender
from order_info o left join province p on p.id = o.province_id left join users u on u.id = o.user_id
""", ("order_info", "province", "users"))

_cte("dwd_detail", """
select d.id, d.order_id, d.sku_id, d.order_price, d.sku_num, d.sku_name,
       strftime(d.create_time, '%Y-%m-%d %H:%M:%S') create_time,
       s.spu_id, s.tm_id, s.category3_id, s.spu_name, s.tm_name, s.category3_name
from order_detail d left join skus s on s.id = d.sku_id
""", ("order_detail", "skus"))

_cte("wide_unsplit", """
select d.id order_detail_id, o.id order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
       d.order_price sku_price, cast(d.sku_num as bigint) sku_num, d.sku_name, o.benefit_reduce_amount,
       o.original_total_amount, o.feight_fee, o.final_total_amount, o.if_first_order, o.province_name,
       o.province_area_code, o.user_age_group, o.user_gender, o.create_date dt,
       cast(d.spu_id as bigint) spu_id, cast(d.tm_id as bigint) tm_id, cast(d.category3_id as bigint) category3_id,
       d.spu_name, d.tm_name, d.category3_name
from dwd_detail d join dwd_order o on o.id = d.order_id
""", ("dwd_detail", "dwd_order"))

# Paid share per line with the reference's sequential rule, as a window over
# integer cents (HALF_UP division: (2*F*o + T) // (2*T) for non-negative values).
WIDE_SQL = """
select * exclude (o_c, t_c, f_c, raw_c, run_c, prev_c, rn),
       cast(case when t_c = 0 then (case when rn = 1 then f_c when o_c = 0 then 0 end)
                 when rn > 1 and run_c = t_c and o_c <> 0 then f_c - prev_c
                 else raw_c end as double) / 100 final_detail_amount
from (
  select *, sum(o_c) over (partition by order_id order by order_detail_id rows between unbounded preceding and current row) run_c,
         coalesce(sum(raw_c) over (partition by order_id order by order_detail_id rows between unbounded preceding and 1 preceding), 0) prev_c,
         row_number() over (partition by order_id order by order_detail_id) rn
  from (
    select *, case when t_c <> 0 then (2 * f_c * o_c + t_c) // (2 * t_c) end raw_c
    from (select *, cast(round(sku_price * 100) as hugeint) * sku_num o_c,
                 cast(round(original_total_amount * 100) as hugeint) t_c,
                 cast(round(final_total_amount * 100) as hugeint) f_c
          from {src}) a) b) c
"""

_cte("wide", WIDE_SQL.format(src="wide_unsplit"), ("wide_unsplit",))

# the lines that a stream join of 600 s lets through
_cte("near_unsplit", """
select w.* from wide_unsplit w join order_detail d on d.id = w.order_detail_id join order_info o on o.id = w.order_id
where abs(epoch(d.create_time) - epoch(o.create_time)) <= 600
""", ("wide_unsplit", "order_detail", "order_info"))

_cte("near_wide", WIDE_SQL.format(src="near_unsplit"), ("near_unsplit",))



_cte("cdc_ids", """
select tbl, id, ['insert', 'insert', 'insert', 'insert', 'insert', 'insert', 'update', 'update', 'delete',
                 'bootstrap-insert'][id % 10 + 1] typ
from (select 'order_info' tbl, id from order_info union all select 'order_detail', id from order_detail
      union all select 'base_province', id from province union all select 'user_info', id from user_info
      union all select 'sku_info', id from sku) x
""", ("order_info", "order_detail", "province", "user_info", "sku"))


def _resolve(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in CTES[n][1]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(sql: str, *names: str) -> str:
    order = _resolve(names)
    if not order:
        return sql.strip()
    body = ",\n".join(f"{n} as (\n{CTES[n][0]}\n)" for n in order)
    return f"with {body}\n{sql.strip()}"
