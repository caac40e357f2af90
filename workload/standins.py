"""Stand-in tables: the shapes the operators work on, derived from the given tables.

One text serves both engines, so inputs are equal by construction and a compare
tests the operators. Targets lag their sources on purpose: keys divisible by 7
are missing, the highest keys are unsent, some rows are stale and some were
reverted at the source after the load.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

STANDINS = {
    "developers": "select n_nationkey as iddev, n_regionkey as idcorp from nation",
    "rates": """
        select 'MXN' as currency, 1994 + n_nationkey as anio,
               cast(15 + n_nationkey % 6 as decimal(9,4)) as rate
        from nation where n_nationkey <> 4""",
    "clients": """
        select c_custkey as clientid, cast(c_custkey % 12 as int) as dppaidin,
               cast(c_custkey % 2 as int) as with_card, c_nationkey as company,
               c_name as name, c_mktsegment as product
        from customer""",
    # every third client holds a second contract, in the product that follows
    "client_view": """
        select c_mktsegment as product, length(c_mktsegment) as productid,
               c_custkey * 10 as contractid, c_custkey as clientid,
               concat('c', cast(c_custkey as string), '@example.com') as email,
               'web' as capdata, c_name as firstname, concat('L', cast(c_custkey % 97 as string)) as lastname,
               cast(c_nationkey as string) as countrycode, concat('N', cast(c_nationkey as string)) as country,
               'E' as estate, 'C' as ciudad, concat('Calle ', cast(c_custkey % 500 as string)) as address,
               cast(10000 + c_custkey % 90000 as string) as zip, cast(c_nationkey % 5 as string) as corpcode,
               concat('G', cast(c_nationkey % 5 as string)) as corp,
               timestamp '2000-01-01 00:00:00' as ingreso, cast(null as timestamp) as egreso,
               case when c_custkey % 5 = 0 then null else cast(c_custkey % 4 as int) end as rank,
               cast(c_custkey % 2 as int) as estatusn, case when c_custkey % 2 = 1 then 'A' else 'B' end as estatusl
        from customer
        union all
        select case c_mktsegment when 'AUTOMOBILE' then 'BUILDING' when 'BUILDING' then 'FURNITURE'
                 when 'FURNITURE' then 'HOUSEHOLD' when 'HOUSEHOLD' then 'MACHINERY' else 'AUTOMOBILE' end,
               0, c_custkey * 10 + 1, c_custkey, concat('d', cast(c_custkey as string), '@example.com'),
               'tel', c_name, concat('M', cast(c_custkey % 97 as string)),
               cast(c_nationkey as string), concat('N', cast(c_nationkey as string)),
               'E', 'C', concat('Calle ', cast(c_custkey % 500 as string)),
               cast(10000 + c_custkey % 90000 as string), cast(c_nationkey % 5 as string),
               concat('G', cast(c_nationkey % 5 as string)),
               timestamp '2001-01-01 00:00:00', timestamp '2002-01-01 00:00:00',
               cast(c_custkey % 3 as int), 1, 'A'
        from customer where c_custkey % 3 = 0""",
    # keys up to half of the source's highest
    "bronze_target": """
        select c_mktsegment as product, cast(c_custkey / 2 as bigint) as clientid,
               cast(c_custkey / 2 as bigint) * 10 as contractid
        from customer
        where c_custkey % 2 = 0 and c_custkey % 7 <> 0 and c_mktsegment <> 'MACHINERY'""",
    "gold_target": """
        select clientid, firstname, lastname, case when clientid % 4 = 0 then null else email end as email,
               country, product, contractid, timestamp '2001-01-01 00:00:00' as createdat,
               cast(null as timestamp) as updatedat
        from client_view where contractid % 10 = 0 and clientid % 6 <> 0""",
    # one in eight requests belongs to the payment of the next one, which has two then
    "redeems": """
        select o_orderkey as indice, o_custkey as clientid,
               case when o_orderkey % 13 = 0 then null else o_orderdate end as fcorreo,
               case o_orderstatus when 'F' then 3 when 'O' then 1 else 0 end as status_r,
               case when o_orderkey % 5 = 0 then null
                    when o_orderkey % 8 = 3 then o_orderkey + 1 else o_orderkey end as pagoid,
               cast(o_totalprice as decimal(11,2)) as monto,
               case when o_orderkey % 3 = 0 then 'MXN' else 'USD' end as currency,
               cast(1 + o_orderkey % 6 + case when o_custkey % 10 = 0 then 1 else 0 end as int) as redeem_no,
               cast(null as date) as inicio_r,
               case when o_orderkey % 11 = 0 then timestamp '2001-09-01 10:00:00' else o_orderdate end as updateat
        from orders""",
    "payments": """
        select l_orderkey as indice,
               case when l_orderkey % 17 = 0 then null else min(l_shipdate) end as f_authorized,
               case when l_orderkey % 4 = 0 then max(l_shipdate) end as f_excel,
               case when l_orderkey % 9 = 0 then null else max(l_shipdate) end as f_pago,
               cast(l_orderkey % 6 as int) as status_p, cast(max(l_extendedprice) as decimal(11,2)) as monto,
               max(l_shipdate) as updateat
        from lineitem group by l_orderkey""",
    "cardcollec": """
        select o_orderkey as indice, o_custkey as clientid,
               case when o_orderkey % 13 = 0 then null else o_orderdate end as fcobrado,
               cast(o_orderkey % 13 as int) as statusc, cast(o_totalprice as decimal(18,6)) as monto,
               case when o_orderkey % 3 = 0 then 'MXN' else 'USD' end as currency,
               o_orderpriority as agente,
               case o_orderkey % 3 when 0 then 'PA' when 1 then 'CC' else 'WT' end as pay_method
        from orders""",
    "tickets": """
        select l_orderkey as idticket, min(l_shipdate) as reference_date
        from lineitem group by l_orderkey""",
    "ticket_items": """
        select l_orderkey * 10 + l_linenumber as id, l_orderkey as ticket_id, l_orderkey as idcc,
               case max(case l_returnflag when 'R' then 3 when 'N' then 2 else 1 end)
                 when 3 then 'NC' when 2 then 'PA' else 'DTO' end as tipodoc,
               cast(max(l_extendedprice) as decimal(18,6)) as abono
        from lineitem group by l_orderkey, l_linenumber""",
    # every 9th change repeats what the history holds, so nothing is late about it
    "colleclog": """
        select event_id as id, o_orderkey as cardcollec_id,
               case when event_type = 'error' then 'INSERT' else 'UPDATE' end as reg, ts as fecha,
               cast(case when event_id % 9 = 0 then o_totalprice else value end as decimal(18,6)) as monto,
               cast(case when event_id % 9 = 0 then o_orderkey else event_id end % 13 as int) as statusc,
               case when event_id % 9 = 0 then o_orderdate
                    when event_id % 3 = 0 then timestamp '2024-01-10 00:00:00'
                    else timestamp '2000-05-15 00:00:00' end as fcobrado,
               case when event_id % 9 = 0 and o_orderkey % 3 = 0 then 'MXN' else 'USD' end as currency,
               case when event_id % 9 <> 0 then 'CC'
                    when o_orderkey % 3 = 0 then 'PA' when o_orderkey % 3 = 1 then 'CC' else 'WT' end as pay_method
        from events join orders on o_orderkey = event_id""",
    "requested_target": """
        select indice as contador, clientid, cast(fcorreo as date) as fecha,
               cast(year(fcorreo) as int) as anio, cast(month(fcorreo) as int) as mes,
               cast(monto * case when indice % 23 = 0 then 2 else 1 end as decimal(11,2)) as monto,
               case when indice % 29 = 0 then null else currency end as currency, status_r, 0 as eliminado,
               timestamp '2001-07-15 05:30:00' as create_at,
               case when indice % 11 = 0 then timestamp '2001-01-01 00:00:00' else updateat end as update_at
        from redeems
        where fcorreo is not null and (coalesce(status_r, 0) <> 0 or indice % 19 = 0) and indice % 7 <> 0
          and indice * 5 < 4 * (select max(o_orderkey) from orders)""",
    "authorized_target": """
        select indice as contador, cast(f_authorized as date) as fecha,
               cast(year(f_authorized) as int) as anio, cast(month(f_authorized) as int) as mes,
               cast(monto as decimal(11,2)) as monto, 0 as eliminado,
               timestamp '2001-07-15 05:30:00' as create_at, updateat as update_at
        from payments where f_authorized is not null and indice % 7 <> 0""",
    "paid_target": """
        select indice as pagoid, cast(coalesce(f_excel, f_pago) as date) as fecha,
               cast(year(coalesce(f_excel, f_pago)) as int) as anio,
               cast(month(coalesce(f_excel, f_pago)) as int) as mes,
               cast(monto as decimal(11,2)) as monto, 0 as eliminado,
               timestamp '2001-07-15 05:30:00' as create_at,
               case when indice % 10 = 0 then null else updateat end as update_at
        from payments
        where coalesce(f_excel, f_pago) is not null and (status_p >= 3 or indice % 19 = 0) and indice % 7 <> 0""",
    "history_target": """
        select h.indice, 1 as is_packed, h.indice as idcc, h.clientid,
               cast(year(h.fcobrado) as int) as pay_year, cast(month(h.fcobrado) as int) as pay_month,
               cast(h.fcobrado as date) as pay_date, d.idcorp, d.iddev,
               cast(case when h.indice % 31 = 0 then null else 4 end as int) as modoin,
               case when h.indice % 37 = 0 then null else h.agente end as agente,
               h.monto as amount_bruta_usd,
               cast(case when h.statusc in (1, 2, 3) then h.monto else 0 end as decimal(18,6)) as amount_neta_usd,
               h.currency, h.pay_method, h.statusc, timestamp '2000-06-01 06:00:00' as insertat,
               cast(null as timestamp) as updateat
        from cardcollec h join clients c on c.clientid = h.clientid join developers d on d.iddev = c.company
        where h.fcobrado is not null and h.indice % 7 <> 0
        union all
        select i.id, 2, i.idcc, h.clientid, cast(year(t.reference_date) as int),
               cast(month(t.reference_date) as int), cast(t.reference_date as date), d.idcorp, d.iddev,
               2, h.agente, i.abono, cast(case when i.tipodoc = 'PA' then i.abono else 0 end as decimal(18,6)),
               h.currency, h.pay_method, h.statusc, timestamp '2000-06-01 06:00:00', cast(null as timestamp)
        from ticket_items i join tickets t on t.idticket = i.ticket_id join cardcollec h on h.indice = i.idcc
             join clients c on c.clientid = h.clientid join developers d on d.iddev = c.company
        where c.dppaidin = 2 and i.id % 5 <> 0""",
    # a row when a run starts, and one when it has ended
    "runlog": """
        select event_id as id, concat('job_', event_type) as paquete,
               case event_id % 10 when 0 then 'ERROR' else 'OK' end as estado,
               cast(floor(value) as bigint) as filas_insertadas, date_trunc('hour', ts) as fecha_inicio,
               ts + interval '1' minute as fecha_fin
        from events where event_id % 10 <> 1
        union all
        select event_id, concat('job_', event_type), 'RUNNING', 0, date_trunc('hour', ts), cast(null as timestamp)
        from events""",
    "runs_ended": """
        select * from runlog
        where estado <> 'RUNNING' or id not in (select id from runlog where estado <> 'RUNNING')""",
    "archive": "select id from runlog where estado in ('OK', 'ERROR') and id % 3 <> 0",
    # rows that carry the run which loaded them; some runs left no log row, some started together
    "loaded": "select o_orderkey as clientid, o_orderkey - o_orderkey % 50 as run_id from orders",
    # new versions of a third of the requests: some moved by 40 days, some there twice
    "requested_changes": """
        select indice as contador, clientid, cast(fcorreo as date) + v.days as fecha,
               cast(year(cast(fcorreo as date) + v.days) as int) as anio,
               cast(month(cast(fcorreo as date) + v.days) as int) as mes,
               cast(monto + v.more as decimal(11,2)) as monto, currency, status_r, v.more as version
        from redeems join versions v on v.part = case when indice % 51 = 0 then 2 when indice % 17 = 0 then 1 else 0 end
        where indice % 3 = 0 and fcorreo is not null and coalesce(status_r, 0) <> 0""",
    "versions": """
        select 0 as part, 0 as more, 0 as days union all select 1, 0, 40
        union all select 2, 0, 40 union all select 2, 1, 40""",
    # requests as an earlier load saw them: some not there yet, some of another date, some deleted since
    "redeems_before": """
        select indice, clientid, cast(fcorreo as date) + case when indice % 11 = 0 then 200 else 0 end as fcorreo
        from redeems where indice % 7 <> 0
        union all
        select indice + 100000000, clientid, cast(fcorreo as date) - 300 from redeems where indice % 29 = 0""",
    "dated_rates": """
        select 'MXN' as currency, date '1994-03-01' + n_nationkey * 97 as desde,
               cast(15 + n_nationkey % 6 as decimal(9,4)) as rate
        from nation
        union all select 'MXN', date '1994-03-01' + n_nationkey * 97, cast(7 as decimal(9,4)) from nation where n_nationkey = 3""",
    "phones": """
        select distinct o_custkey as clientid, c_mktsegment as product,
               concat('+52', lpad(cast(o_custkey * 7 + o_orderkey % 3 as string), 8, '0')) as phone
        from orders join customer on c_custkey = o_custkey""",
}
# Declared, so that reading a table needs no job to look at a file first.
BASE = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _used(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b(?:from|join)\s+{n}\b", sql)]


def with_standins(sql: str) -> str:
    """SQL that reads stand-ins, with their definitions in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _used(text, STANDINS):
            if name not in needed:
                visit(STANDINS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    head = ", ".join(f"{n} as ({STANDINS[n]})" for n in needed)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {head}, {body[5:]}"
    return f"with {head} {body}"


class Tables:
    """The given tables and the stand-ins of one data folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in STANDINS:
                self._made[name] = self._standin(STANDINS[name])
            elif name in BASE:
                reader = self.spark.read.schema(BASE[name])
                self._made[name] = reader.parquet(f"{self.folder}/{name}.parquet")
            else:
                raise AttributeError(name)
        return self._made[name]

    def _standin(self, sql: str) -> DataFrame:
        inputs = _used(sql, (*BASE, *STANDINS))
        text = re.sub(r"\btimestamp '", "timestamp_ntz '", sql)
        text = re.sub(r"\bas timestamp\)", "as timestamp_ntz)", text)
        for name in inputs:
            text = re.sub(rf"\b(from|join)\s+{name}\b", rf"\1 {{{name}}}", text)
        return self.spark.sql(text, **{n: getattr(self, n) for n in inputs})


@lru_cache(maxsize=8)
def tables(spark: SparkSession, folder: str) -> Tables:
    """One set of tables per session and folder: a stand-in is analysed once, not per query."""
    return Tables(spark, folder)
