"""Independent SQL (DuckDB dialect) for the registered queries.

Written from the model's semantics, not generated from the DataFrame code.
Money sums use exact decimals on both sides, so values compare bit-for-bit.
"""

from __future__ import annotations

_ITEMS_LATEST = """
items_latest as (
    select * from lineitem
    qualify row_number() over (
        partition by l_orderkey, l_linenumber
        order by l_shipdate desc nulls last, l_partkey asc nulls first,
                 l_suppkey asc nulls first, l_extendedprice asc nulls first) = 1
)"""

_FACT = _ITEMS_LATEST + """,
item_totals as (
    select l_orderkey as venda_id,
           cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as total_itens,
           cast(sum(cast(l_quantity as bigint)) as bigint) as total_quantidade,
           count(*) as qtd_itens
    from items_latest group by l_orderkey
),
orders_latest as (
    select * from orders
    qualify row_number() over (partition by o_orderkey order by o_orderdate desc nulls last) = 1
),
fact as (
    select o.o_orderkey as venda_id, o.o_custkey as cliente_id,
           cast(c.c_nationkey as bigint) as loja_id,
           cast(o.o_orderdate as date) as data,
           cast(year(o.o_orderdate) as bigint) as ano,
           cast(month(o.o_orderdate) as bigint) as mes,
           o.o_orderstatus as status, cast(o.o_totalprice as double) as total,
           i.total_itens, i.total_quantidade, i.qtd_itens
    from orders_latest o
    left join item_totals i on o.o_orderkey = i.venda_id
    left join customer c on c.c_custkey = o.o_custkey
    where o.o_orderstatus = 'F'
)"""

_TARGETS = """
sales_lines as (
    select year(l_shipdate) as ano, month(l_shipdate) as mes, s_nationkey as loja_id,
           p_type as categoria, l_extendedprice
    from lineitem
    left join supplier on l_suppkey = s_suppkey
    left join part on l_partkey = p_partkey
),
targets as (
    select cast(ano as bigint) as ano, cast(mes as bigint) as mes,
           cast(loja_id as bigint) as loja_id, categoria,
           cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as meta_valor,
           make_date(cast(ano as bigint), cast(mes as bigint), 1) as data_mes
    from sales_lines group by ano, mes, loja_id, categoria
)"""

_ATTAINMENT = "with " + _FACT + "," + _TARGETS + """,
stacked as (
    select 'sale' as side, ano, mes, loja_id, total as amount from fact
    union all
    select 'target', ano, mes, loja_id, meta_valor from targets
),
mart as (
    -- One grouped pass over both sides.  A group whose key holds a NULL matches
    -- nothing, so sales and targets stay apart there.
    select ano, mes, loja_id,
           cast(sum(case when side = 'sale' then cast(amount as decimal(18,2)) end) as double) as total_vendas,
           cast(sum(case when side = 'target' then cast(amount as decimal(18,2)) end) as double) as meta_total,
           round(cast(sum(case when side = 'sale' then cast(amount as decimal(18,2)) end) as double)
                 / nullif(cast(sum(case when side = 'target' then cast(amount as decimal(18,2)) end) as double), 0)
                 * 100, 2) as pct_meta
    from stacked
    group by ano, mes, loja_id,
             case when ano is null or mes is null or loja_id is null then side end
)"""


def _series_cte(name: str, event: str, monthly: bool) -> str:
    day = ("cast(date_trunc('month', ts) - interval 1 month as date)" if monthly
           else "cast(ts as date)")
    return f"""
{name} as (
    select d as data, cast(v as double) as {name}
    from (select {day} as d, sum(cast(value as decimal(18,2))) as v
          from events where event_type = '{event}' group by 1)
)"""


_SERIES = ("with " + _series_cte("dolar", "click", False) + ","
           + _series_cte("selic", "error", False) + ","
           + _series_cte("ipca", "purchase", True))


def _align(keep_monthly_date: bool) -> str:
    """All series by date in one grouping of the stacked series; a NULL date matches nothing."""
    shown = "day" if keep_monthly_date else "case when daily then day end"
    return _SERIES + f""",
points as (
    select 'dolar' as name, data as day, dolar as amount from dolar
    union all select 'selic', data, selic from selic
    union all select 'ipca', data, ipca from ipca
),
by_day as (
    select day, bool_or(name <> 'ipca') as daily,
           max(amount) filter (where name = 'dolar') as dolar,
           max(amount) filter (where name = 'selic') as selic,
           max(amount) filter (where name = 'ipca') as ipca
    from points group by day, case when day is null then name end
),
aligned as (select {shown} as data, dolar, selic, ipca from by_day)"""


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["sales_fact"] = "with " + _FACT + "\nselect * from fact"

ORACLE_SQL["sales_vs_target_monthly"] = _ATTAINMENT + "\nselect * from mart"

ORACLE_SQL["latest_version"] = "with " + _ITEMS_LATEST + "\nselect * from items_latest"

ORACLE_SQL["latest_completed"] = """
with latest as (
    select * from events
    qualify row_number() over (partition by user_id
                               order by ts desc nulls last, event_id asc nulls first) = 1
)
select user_id as venda_id, cast(ts as timestamp) as data_venda,
       cast(ts as date) as data_venda_date, event_type as status,
       cast(value as double) as total, cast(ts as timestamp) as updated_at
from latest where event_type = 'purchase'
"""

ORACLE_SQL["stage_items"] = "with " + _ITEMS_LATEST + """
select l_linenumber as item_id, l_orderkey as venda_id, l_partkey as produto_id,
       cast(l_quantity as bigint) as quantidade,
       l_extendedprice / l_quantity as preco_unit,
       cast(l_extendedprice as double) as subtotal
from items_latest
"""

ORACLE_SQL["conform_dimension"] = """
select * from (
    select cast(n_nationkey as bigint) as loja_id, n_name as loja_nome, r_name as regiao
    from nation left join region on n_regionkey = r_regionkey
)
qualify row_number() over (partition by loja_id
                           order by loja_nome asc nulls first, regiao asc nulls first) = 1
"""

ORACLE_SQL["dim_customer"] = """
select * from (
    select c_custkey as cliente_id, c_name as cliente_nome from customer
    qualify row_number() over (partition by c_custkey order by c_name asc nulls first) = 1
)
qualify row_number() over (partition by cliente_id order by cliente_nome asc nulls first) = 1
"""

ORACLE_SQL["dim_product"] = """
select * from (
    select p_partkey as produto_id, p_name as produto_nome, p_type as categoria,
           cast(p_retailprice as double) as preco
    from part
)
qualify row_number() over (partition by produto_id
                           order by produto_nome asc nulls first, categoria asc nulls first,
                                    preco asc nulls first) = 1
"""

ORACLE_SQL["indicator_align"] = _align(False) + "\nselect * from aligned"

ORACLE_SQL["indicator_align_all_keys"] = (_align(True)
                                          + "\nselect * from aligned")

ORACLE_SQL["series_parse"] = _SERIES + """
select 'dolar' as serie, cast(1 as bigint) as codigo, data, dolar as valor from dolar
union all
select 'selic' as serie, cast(11 as bigint) as codigo, data, selic as valor from selic
union all
select 'ipca' as serie, cast(433 as bigint) as codigo, data, ipca as valor from ipca
"""

ORACLE_SQL["calendar"] = """
with bounds as (
    select min(cast(o_orderdate as date)) as lo, max(cast(o_orderdate as date)) as hi
    from orders
),
days as (
    select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as data from bounds
)
select data,
       cast(year(data) as bigint) as ano, cast(month(data) as bigint) as mes,
       cast(day(data) as bigint) as dia, cast(strftime(data, '%U') as bigint) as semana,
       cast(quarter(data) as bigint) as trimestre,
       monthname(data) as mes_nome, dayname(data) as dia_semana,
       dayofweek(data) in (0, 6) as fim_de_semana
from days
"""

ORACLE_SQL["stage_targets"] = "with " + _TARGETS + "\nselect * from targets"

ORACLE_SQL["kpi_overview"] = _ATTAINMENT + """,
base as (
    select cast(sum(cast(total as decimal(18,2))) as double) as total_vendas,
           count(*) as n_vendas
    from fact
),
mart_totals as (
    select cast(sum(cast(meta_total as decimal(18,2))) as double) as meta_total,
           cast(sum(cast(total_vendas as decimal(18,2))) as double) as vendas_mart
    from mart
)
select b.total_vendas, b.n_vendas,
       b.total_vendas / nullif(b.n_vendas, 0) as ticket_medio,
       (select meta_total from mart_totals) as meta_total,
       round((select vendas_mart from mart_totals)
             / nullif((select meta_total from mart_totals), 0) * 100, 2) as pct_meta
from base b
"""

ORACLE_SQL["monthly_vs_indicator"] = _align(False) + """,
s as (
    select cast(year(cast(ts as date)) as bigint) as ano,
           cast(month(cast(ts as date)) as bigint) as mes,
           cast(sum(cast(value as decimal(18,2))) as double) as total_vendas,
           count(*) as n_vendas
    from events where event_type = 'purchase' group by 1, 2
),
i as (
    select cast(year(data) as bigint) as ano, cast(month(data) as bigint) as mes,
           cast(sum(cast(dolar as decimal(28,8))) as double) / count(*) as dolar_medio
    from aligned where data is not null and dolar is not null group by 1, 2
)
select s.ano, s.mes, s.total_vendas, s.n_vendas, i.dolar_medio
from s left join i on s.ano = i.ano and s.mes = i.mes
"""

ORACLE_SQL["store_ranking"] = _ATTAINMENT + """
select *, cast(rank() over (partition by ano, mes order by pct_meta desc nulls last) as bigint)
          as posicao
from mart
"""

ORACLE_SQL["target_plan"] = "with " + _TARGETS.split(",\ntargets as")[0] + """,
keys as (select distinct ano, mes, loja_id, categoria from sales_lines)
select cast(ano as bigint) as ano, cast(mes as bigint) as mes,
       cast(loja_id as bigint) as loja_id, categoria,
       round(15000.0::double
             * power(1.05::double, cast(ano - (select min(ano) from keys) as double))
             * (case when mes = 11 then 1.4::double when mes = 12 then 1.4::double
                     when mes = 1 then 0.85::double when mes = 2 then 0.85::double
                     else 1.0::double end), 2) as meta_valor
from keys
"""

ORACLE_SQL["unique_violations"] = """
select l_orderkey, l_linenumber, count(*) as n_rows
from lineitem group by l_orderkey, l_linenumber having count(*) > 1
"""

ORACLE_SQL["orphan_rows"] = "with " + _ITEMS_LATEST + """
select i.l_linenumber as item_id, i.l_orderkey as venda_id, i.l_partkey as produto_id,
       cast(i.l_quantity as bigint) as quantidade,
       i.l_extendedprice / i.l_quantity as preco_unit,
       cast(i.l_extendedprice as double) as subtotal
from items_latest i
where i.l_orderkey is not null
  and not exists (select 1 from orders o
                  where o.o_orderkey = i.l_orderkey and o.o_orderstatus = 'F')
"""

_ISO = "regexp_replace(strftime({c}, '%Y-%m-%dT%H:%M:%S.%f'), '\\.000000$', '')"

ORACLE_SQL["high_water_mark"] = f"""
select 'erp_vendas' as tabela,
       coalesce({_ISO.format(c='max(o_orderdate)')}, '1970-01-01T00:00:00') as watermark
from orders
union all
select 'erp_itens_venda' as tabela,
       coalesce({_ISO.format(c='max(l_shipdate)')}, '1970-01-01T00:00:00') as watermark
from lineitem
union all
select 'events' as tabela,
       coalesce({_ISO.format(c='max(ts)')}, '1970-01-01T00:00:00') as watermark
from events
"""

ORACLE_SQL["incremental_extract"] = f"""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       {_ISO.format(c='o_orderdate')} as o_orderdate, o_orderpriority,
       '2024-02-01T06:00:00' as _loaded_at, 'erp.orders' as _source
from orders where o_orderdate > timestamp '2000-01-01 00:00:00'
"""

ORACLE_SQL["series_window"] = """
with run as (select max(cast(o_orderdate as date)) as hi from orders),
bounds as (select hi, cast(hi - interval 1095 day as date) as lo from run)
select strftime(cast(o_orderdate as date), '%d/%m/%Y') as data,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) as valor,
       strftime((select lo from bounds), '%d/%m/%Y') as data_inicio,
       strftime((select hi from bounds), '%d/%m/%Y') as data_fim
from orders
where cast(o_orderdate as date) >= (select lo from bounds)
  and cast(o_orderdate as date) <= (select hi from bounds)
group by cast(o_orderdate as date)
"""


def _coerce_sql(c: str) -> str:
    int_re = "'^\\s*[+-]?[0-9]+\\s*$'"
    return f"""
       case when {c} is null then null
            when regexp_matches({c}, {int_re}) then 'int'
            when try_cast(trim({c}) as double) is not null then 'float'
            else 'string' end as {c}_kind,
       case when regexp_matches({c}, {int_re}) then cast(trim({c}) as bigint) end as {c}_long,
       try_cast(trim({c}) as double) as {c}_double"""


ORACLE_SQL["numeric_coercion"] = f"""
with cells as (
    select event_id, json_extract_string(props, '$.k') as k_text,
           cast(cast(value as decimal(18,2)) as varchar) as value_text,
           event_type as type_text, cast(user_id as varchar) || 'D' as suffix_text
    from events
)
select event_id, k_text, value_text, type_text, suffix_text,
{_coerce_sql('k_text')},
{_coerce_sql('value_text')},
{_coerce_sql('type_text')},
{_coerce_sql('suffix_text')}
from cells
"""

ORACLE_SQL["normalise_types"] = f"""
select event_id, {_ISO.format(c='ts')} as ts, user_id, event_type, value, props,
       '2024-02-01T06:00:00' as _loaded_at, 'events' as _source
from events
"""

ORACLE_SQL["csv_roundtrip"] = ORACLE_SQL["stage_targets"]
ORACLE_SQL["csv_rejects"] = "with " + _TARGETS + """
select loja_id, count(*) filter (where loja_id is distinct from 3) as n_loaded,
       count(*) filter (where loja_id is distinct from 3) as n_whole,
       count(*) filter (where loja_id = 3) as n_rejected,
       case when loja_id = 3 then 'meta_valor: not a double' end as reason
from targets group by loja_id
"""
# The series as ingested lie within the loaded window, so the alignment is that of all of them.
ORACLE_SQL["daily_indicators"] = ORACLE_SQL["indicator_align"]
# The loaded window: 1,095 days up to the newest event.
ORACLE_SQL["rest_series_source"] = f"""
select * from ({ORACLE_SQL["series_parse"]}) parsed
where data >= (select cast(max(cast(ts as date)) - interval 1095 day as date) from events)
  and data <= (select max(cast(ts as date)) from events)
"""
ORACLE_SQL["layered_build"] = ORACLE_SQL["sales_vs_target_monthly"]
ORACLE_SQL["daily_run"] = ORACLE_SQL["sales_vs_target_monthly"]
ORACLE_SQL["incremental_upsert"] = ORACLE_SQL["latest_version"]
ORACLE_SQL["stream_upsert"] = ORACLE_SQL["latest_version"]
ORACLE_SQL["partition_refresh"] = ORACLE_SQL["sales_fact"]

ORACLE_SQL["bronze_append"] = f"""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       {_ISO.format(c='o_orderdate')} as o_orderdate, o_orderpriority,
       case when o_orderdate < timestamp '1997-01-01' then '2024-02-01T06:00:00'
            when o_orderdate < timestamp '1999-01-01' then '2024-02-02T06:00:00'
            else '2024-02-03T06:00:00' end as _loaded_at,
       'erp.orders' as _source
from orders
"""
