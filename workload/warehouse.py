"""Loads, merges, facts, collections, gold tables, cleanup, reconciliation, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import cleanup, load, merge, shape
from tidemark.operators.aggregates import hot_cold
from tidemark.plans import audit, facts, gold, recon, runlog
from tidemark.plans import collections as coll
from workload.basic import (
    ALL_MONTHS,
    ASOF,
    AT,
    CHARGE_MODE,
    COLLECTED,
    MONTH,
    month_name,
    sources,
)
from workload.registry import query

PRODUCTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
STAMPED = "timestamp '2001-07-20 05:30:00'"

# --- loads


@query(
    "append_incremental",
    "clientid:i contractid:i product email createdat:s updatedat:s",
    f"""select clientid, contractid, product, email, {STAMPED} as createdat, cast(null as timestamp) as updatedat
        from client_view where clientid > (select coalesce(max(clientid), 0) from bronze_target)""",
)
def _(t):
    return load.append_incremental(t.client_view, t.bronze_target, "clientid", AT)


@query(
    "append_five_products",
    "product clientid:i contractid:i createdat:s",
    f"""select s.product, s.clientid, s.contractid, {STAMPED} as createdat
        from client_view s left join (select product, max(clientid) as m from bronze_target group by product) w
          on w.product = s.product where s.clientid > coalesce(w.m, 0)""",
)
def _(t):
    return load.append_products(t.client_view, t.bronze_target, "clientid", AT, PRODUCTS)


@query(
    "refresh_full",
    "clientid:i phone atinsert:s atupdate:s",
    f"select clientid, phone, {STAMPED} as atinsert, cast(null as timestamp) as atupdate from phones",
)
def _(t):
    return load.refresh_full(t.phones, AT)


@query(
    "refresh_five_products",
    "product clientid:i phone atinsert:s",
    f"select product, clientid, phone, {STAMPED} as atinsert from phones",
)
def _(t):
    views = {p: t.phones.where(F.col("product") == p).drop("product") for p in PRODUCTS}
    return load.refresh_products(views, AT)


@query(
    "repair_missing",
    "clientid:i contractid:i createdat:s",
    f"""select clientid, contractid, {STAMPED} as createdat from client_view
        where clientid <= (select coalesce(max(clientid), 0) from bronze_target)
          and clientid not in (select clientid from bronze_target)""",
)
def _(t):
    return load.repair_missing(t.client_view, t.bronze_target, "clientid", AT)


# --- event facts

DIMS = "clients c left join developers d on d.iddev = c.company"
# a payment takes its highest request; of known clients only, where the client is joined inside
LAST_REQUEST = """(select * from (select *, row_number() over (partition by pagoid order by indice desc) as rn
    from redeems where pagoid is not null) o where rn = 1)"""
LAST_KNOWN = """(select * from (select o.*, row_number() over (partition by pagoid order by indice desc) as rn
    from redeems o join clients k on k.clientid = o.clientid where pagoid is not null) o where rn = 1)"""


def _fact_sql(kind: str, level: int, on: str, key: str, status: str, tables: str, where: str) -> str:
    return f"""select '{kind}' as tipo, cast({on} as date) as fecha, day({on}) as dia, month({on}) as mes,
       year({on}) as anio, year({on}) * 100 + month({on}) as aniomes, {month_name(on)} as nommes,
       a.indice as {key}, r.clientid, case when c.dppaidin = 2 then 1 else 0 end as pack,
       a.monto, r.currency, d.idcorp, d.iddev, a.{status}, {level} as nivel, 0 as eliminado,
       {STAMPED} as create_at, a.updateat as update_at from {tables} where {where}"""


def _fact_spec(key: str, status: str) -> str:
    return (
        f"tipo fecha:s dia:i mes:i anio:i aniomes:i nommes {key}:i clientid:i pack:i monto:d currency "
        f"idcorp:i iddev:i {status}:i nivel:i eliminado:i create_at:s update_at:s"
    )


@query(
    "event_fact_requested",
    _fact_spec("contador", "status_r"),
    _fact_sql(
        "Solicitados", 1, "a.fcorreo", "contador", "status_r",
        """redeems a join redeems r on r.indice = a.indice left join clients c on c.clientid = a.clientid
           left join developers d on d.iddev = c.company""",
        "a.fcorreo is not null and coalesce(a.status_r, 0) <> 0",
    ),
)
def _(t):
    return facts.requested_fact(t.redeems, t.clients, t.developers, AT)


@query(
    "event_fact_authorized",
    _fact_spec("contador", "status_p"),
    _fact_sql(
        "Autorizados", 2, "a.f_authorized", "contador", "status_p",
        f"""payments a join {LAST_KNOWN} r on r.pagoid = a.indice join clients c on c.clientid = r.clientid
           left join developers d on d.iddev = c.company""",
        "a.f_authorized is not null",
    ),
)
def _(t):
    return facts.authorized_fact(t.payments, t.redeems, t.clients, t.developers, AT)


@query(
    "event_fact_paid",
    _fact_spec("pagoid", "status_p"),
    _fact_sql(
        "Pagados", 3, "coalesce(a.f_excel, a.f_pago)", "pagoid", "status_p",
        f"""payments a join {LAST_REQUEST} r on r.pagoid = a.indice left join clients c on c.clientid = r.clientid
           left join developers d on d.iddev = c.company""",
        "a.status_p >= 3 and coalesce(a.f_excel, a.f_pago) is not null",
    ),
)
def _(t):
    return facts.paid_fact(t.payments, t.redeems, t.clients, t.developers, AT)


# --- pending rows

REQUESTED = "s.fcorreo is not null and coalesce(s.status_r, 0) <> 0"


@query(
    "pending_table_wm",
    "indice:i updateat:s",
    f"""select s.indice, s.updateat from redeems s where {REQUESTED} and (
          s.indice > (select coalesce(max(contador), 0) from requested_target)
          or s.updateat > (select coalesce(max(create_at), timestamp '2000-01-01 00:00:00') from requested_target))""",
)
def _(t):
    rows = shape.requested(t.redeems)
    return merge.pending_table(rows, t.requested_target, "indice", "contador")


def _pending_requested(t):
    rows = shape.requested(t.redeems).select("indice", "updateat")
    return merge.pending_row(rows, t.requested_target, "indice", "contador")


def _pending_authorized(t):
    rows = shape.authorized(t.payments).select("indice", "updateat")
    rows = merge.pending_row(rows, t.authorized_target, "indice", "contador")
    return rows.join(facts.request_counts(t.redeems, t.clients), "indice")


def _pending_paid(t):
    rows = shape.paid(t.payments).select("indice", "updateat")
    rows = merge.pending_row(rows, t.paid_target, "indice", "pagoid")
    return rows.join(facts.request_counts(t.redeems), "indice")


NEWER = """(k is null or cast(coalesce(s.updateat, timestamp '2000-01-01 00:00:00') as date)
              > cast(coalesce(u, timestamp '2000-01-01 00:00:00') as date))"""
PENDING = {
    "requested": f"""select s.indice from redeems s
        left join clients c on c.clientid = s.clientid
        left join (select contador as k, update_at as u from requested_target) x on x.k = s.indice
        where {REQUESTED} and {NEWER}""",
    "authorized": f"""select s.indice from payments s join redeems r on r.pagoid = s.indice
        join clients c on c.clientid = r.clientid
        left join (select contador as k, update_at as u from authorized_target) x on x.k = s.indice
        where s.f_authorized is not null and {NEWER}""",
    "paid": f"""select s.indice from payments s join redeems r on r.pagoid = s.indice
        left join clients c on c.clientid = r.clientid
        left join (select pagoid as k, update_at as u from paid_target) x on x.k = s.indice
        where s.status_p >= 3 and coalesce(s.f_excel, s.f_pago) is not null and {NEWER}""",
}


@query(
    "pending_row_wm",
    "task indice:i requests:i",
    " union all ".join(
        f"select '{k}' as task, indice, count(*) as requests from ({v}) p_{k} group by indice"
        for k, v in PENDING.items()
    ),
)
def _(t):
    found = {
        "requested": _pending_requested(t).withColumn("requests", F.lit(1)),
        "authorized": _pending_authorized(t),
        "paid": _pending_paid(t),
    }
    rows = [df.select(F.lit(k).alias("task"), "indice", "requests") for k, df in found.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "audit_pending",
    "task_id dag_id pendientes:i",
    "select * from ("
    + " union all ".join(
        f"select '{k}' as task_id, 'sync_facts' as dag_id, count(*) as pendientes from ({v}) p_{k}"
        for k, v in PENDING.items()
    )
    + ") w where pendientes > 0",
)
def _(t):
    job = "sync_facts"
    return audit.pending_report(
        {
            ("requested", job): (_pending_requested(t), F.lit(1)),
            ("authorized", job): (_pending_authorized(t), F.col("requests")),
            ("paid", job): (_pending_paid(t), F.col("requests")),
        }
    )


# --- upsert


def _request_rows(t):
    return facts.requested_fact(t.redeems, t.clients, t.developers, AT)


FACT_SPEC = (
    "contador:i clientid:i fecha:s anio:i mes:i monto:d currency status_r:i eliminado:i create_at:s update_at:s"
)
FACT_NOW = f"""select indice as contador, clientid, cast(fcorreo as date) as fecha, year(fcorreo) as anio,
    month(fcorreo) as mes, monto, currency, status_r, 0 as eliminado, {STAMPED} as create_at, updateat as update_at
    from redeems where fcorreo is not null and coalesce(status_r, 0) <> 0"""


@query(
    "upsert",
    FACT_SPEC,
    f"""select coalesce(t.contador, s.contador) as contador,
          case when s.contador is null then t.clientid else s.clientid end as clientid,
          case when s.contador is null then t.fecha else s.fecha end as fecha,
          case when s.contador is null then t.anio else s.anio end as anio,
          case when s.contador is null then t.mes else s.mes end as mes,
          case when s.contador is null then t.monto else s.monto end as monto,
          case when s.contador is null then t.currency else s.currency end as currency,
          case when s.contador is null then t.status_r else s.status_r end as status_r,
          case when s.contador is null then t.eliminado else s.eliminado end as eliminado,
          case when t.contador is null then s.create_at else t.create_at end as create_at,
          case when s.contador is null then t.update_at else s.update_at end as update_at
        from requested_target t full outer join ({FACT_NOW}) s on s.contador = t.contador""",
)
def _(t):
    rows = _request_rows(t)
    known = [c for c in rows.columns if c in t.requested_target.columns]
    return merge.upsert(t.requested_target, rows.select(known), ["contador"], keep=("create_at",))


@query(
    "upsert_counts",
    "inserted:i updated:i unchanged:i",
    f"""select sum(case when t.contador is null then 1 else 0 end) as inserted,
          sum(case when t.contador is not null and (t.monto is distinct from s.monto
               or t.currency is distinct from s.currency or t.fecha is distinct from s.fecha) then 1 else 0 end) as updated,
          sum(case when t.contador is not null and not (t.monto is distinct from s.monto
               or t.currency is distinct from s.currency or t.fecha is distinct from s.fecha) then 1 else 0 end) as unchanged
        from ({FACT_NOW}) s left join requested_target t on t.contador = s.contador""",
)
def _(t):
    cols = ["monto", "currency", "fecha"]
    return merge.merge_counts(t.requested_target, _request_rows(t), ["contador"], cols)


# --- collections

HISTORY_SPEC = (
    "indice:i is_packed:i idcc:i clientid:i pay_year:i pay_month:i pay_date:s idcorp:i iddev:i modoin:i "
    "agente amount_bruta_usd:d amount_neta_usd:d currency pay_method statusc:i"
)
HISTORY_COLS = [c.partition(":")[0] for c in HISTORY_SPEC.split()]


def _branches(plain_where: str, packed_where: str, plain_join: str = "") -> str:
    return f"""select h.indice, 1 as is_packed, h.indice as idcc, h.clientid,
        cast(year(h.fcobrado) as int) as pay_year, cast(month(h.fcobrado) as int) as pay_month,
        cast(h.fcobrado as date) as pay_date, d.idcorp, d.iddev,
        {CHARGE_MODE.replace('clientid', 'h.clientid')} as modoin, h.agente, h.monto as amount_bruta_usd,
        cast(case when h.statusc in (1, 2, 3) then h.monto else 0 end as decimal(18,6)) as amount_neta_usd,
        h.currency, h.pay_method, h.statusc
      from cardcollec h left join clients c on c.clientid = h.clientid join developers d on d.iddev = c.company
      {plain_join} where h.fcobrado is not null and h.statusc in {COLLECTED} and c.dppaidin not in (2) and ({plain_where})
      union all
      select i.id, 2, i.idcc, h.clientid, cast(year(t.reference_date) as int),
        cast(month(t.reference_date) as int), cast(t.reference_date as date), d.idcorp, d.iddev, 2, h.agente,
        i.abono, cast(case when i.tipodoc = 'PA' then i.abono else 0 end as decimal(18,6)),
        h.currency, h.pay_method, h.statusc
      from tickets t join ticket_items i on i.ticket_id = t.idticket and i.tipodoc in ('NC', 'PA', 'DTO')
      join cardcollec h on h.indice = i.idcc join clients c on c.clientid = h.clientid
      join developers d on d.iddev = c.company where c.dppaidin = 2 and ({packed_where})"""


def _ym(c: str) -> str:
    return f"year({c}) * 100 + month({c})"


def _months(ym_from: int, ym_to: int) -> str:
    span = f"between {ym_from} and {ym_to}"
    return _branches(f"{_ym('h.fcobrado')} {span}", f"{_ym('t.reference_date')} {span}")


EVERY_MONTH = _branches("true", "t.reference_date is not null")


@query("collections_month", HISTORY_SPEC, _months(MONTH, MONTH))
def _(t):
    return coll.collections(sources(t), MONTH)


# changes are logged in January 2024, so that is the month a late load looks at
LATE_MONTH = 202401
LATE = f"""select u.cardcollec_id, u.monto, u.statusc, u.fcobrado, u.currency, u.pay_method from (
      select *, row_number() over (partition by cardcollec_id order by fecha desc, id desc) as rn from colleclog
      where reg = 'UPDATE' and {_ym('fecha')} = {LATE_MONTH} and {_ym('fcobrado')} < {LATE_MONTH}
        and fcobrado is not null and statusc in {COLLECTED}) u
    left join history_target x on x.indice = u.cardcollec_id and x.is_packed = 1
    where u.rn = 1 and (x.indice is null or u.monto is distinct from x.amount_bruta_usd
      or u.statusc is distinct from x.statusc or cast(u.fcobrado as date) is distinct from x.pay_date
      or u.currency is distinct from x.currency or u.pay_method is distinct from x.pay_method)"""


@query(
    "collections_late_changes",
    "cardcollec_id:i monto:d statusc:i fcobrado:s currency pay_method",
    f"""select cardcollec_id, monto, statusc, cast(fcobrado as date) as fcobrado, currency, pay_method
        from ({LATE}) z""",
)
def _(t):
    return coll.late_changes(t.colleclog, t.history_target, LATE_MONTH)


def _merged_sql(rows: str) -> str:
    take = ", ".join(
        f"case when s.indice is null then t.{c} else s.{c} end as {c}"
        for c in HISTORY_COLS
        if c not in ("indice", "is_packed")
    )
    compared = "amount_bruta_usd amount_neta_usd statusc pay_date clientid idcc modoin agente pay_method"
    differs = " or ".join(f"t.{c} is distinct from s.{c}" for c in compared.split())
    return f"""select coalesce(t.indice, s.indice) as indice, coalesce(t.is_packed, s.is_packed) as is_packed,
        {take}, case when t.indice is null then {STAMPED} else t.insertat end as insertat,
        case when t.indice is not null and s.indice is not null and ({differs}) then {STAMPED}
             else t.updateat end as updateat
      from history_target t full outer join ({rows}) s on s.indice = t.indice and s.is_packed = t.is_packed"""


LOADED_SPEC = HISTORY_SPEC + " insertat:s updateat:s"


@query(
    "collections_load",
    LOADED_SPEC,
    _merged_sql(
        _branches(
            f"({_ym('h.fcobrado')} = {LATE_MONTH} or z.cardcollec_id is not null)",
            f"{_ym('t.reference_date')} = {LATE_MONTH}",
            f"left join ({LATE}) z on z.cardcollec_id = h.indice",
        )
    ),
)
def _(t):
    return coll.load_month(sources(t), t.colleclog, t.history_target, LATE_MONTH, AT)


@query("upsert_stamp_changed", LOADED_SPEC, _merged_sql(_months(MONTH, MONTH)))
def _(t):
    return coll.merge_history(t.history_target, coll.collections(sources(t), MONTH), AT)


@query("rebuild_months", LOADED_SPEC, _merged_sql(EVERY_MONTH))
def _(t):
    return coll.load_months(sources(t), t.history_target, *ALL_MONTHS, AT)


@query(
    "union_hot_cold",
    "indice:i is_packed:i pay_date:s amount_bruta_usd:d",
    f"""select indice, is_packed, pay_date, amount_bruta_usd from history_target where pay_date < date '2000-05-01'
        union all
        select indice, is_packed, pay_date, amount_bruta_usd from ({EVERY_MONTH}) l
        where pay_date >= date '2000-05-01'""",
)
def _(t):
    live = coll.collections(sources(t), MONTH, ALL_MONTHS[1])
    return hot_cold(t.history_target.select(live.columns), live, MONTH)


USD = """cast(case when x.currency = 'MXN' then round(cast({a} as double) / cast(rate as double), 6)
              else cast({a} as double) end as decimal(18,6))"""


@query(
    "corp_year_report",
    "pay_year:i idcorp:i no_packed:d packed:d no_packed_neta:d packed_neta:d total:d total_neta:d",
    f"""select pay_year, idcorp,
          coalesce(sum(case when is_packed = 1 then gross end), 0) as no_packed,
          coalesce(sum(case when is_packed = 2 then gross end), 0) as packed,
          coalesce(sum(case when is_packed = 1 then net end), 0) as no_packed_neta,
          coalesce(sum(case when is_packed = 2 then net end), 0) as packed_neta,
          coalesce(sum(gross), 0) as total, coalesce(sum(net), 0) as total_neta
        from (
          select pay_year, idcorp, is_packed, {USD.format(a='amount_bruta_usd')} as gross,
                 {USD.format(a='amount_neta_usd')} as net
          from (select {', '.join(HISTORY_COLS)} from history_target where pay_date < date '2000-05-01'
                union all
                select {', '.join(HISTORY_COLS)} from ({EVERY_MONTH}) l
                where pay_date >= date '2000-05-01') x
          left join rates r on r.currency = x.currency and r.anio = x.pay_year) y
        group by pay_year, idcorp""",
)
def _(t):
    live = coll.collections(sources(t), MONTH, ALL_MONTHS[1])
    return coll.corp_year_report(t.history_target, live, MONTH, t.rates)


AMOUNT_SPEC = (
    "pay_year_month:i cnt_origen:i monto_origen:d cnt_destino:i monto_destino:d diff_cnt:i diff_monto:d "
    "cnt_idcc:i cnt_clientid_uniq:i cnt_agente:i cnt_pay_method:i cnt_modoin:i"
)


def _amounts(source: str) -> str:
    return f"""select s.pay_year * 100 + s.pay_month as pay_year_month, count(s.indice) as cnt_origen,
          round(sum(s.amount_bruta_usd), 2) as monto_origen, count(x.indice) as cnt_destino,
          round(sum(x.amount_bruta_usd), 2) as monto_destino, count(s.indice) - count(x.indice) as diff_cnt,
          round(sum(s.amount_bruta_usd) - sum(x.amount_bruta_usd), 2) as diff_monto,
          count(x.idcc) as cnt_idcc, count(distinct x.clientid) as cnt_clientid_uniq,
          count(x.agente) as cnt_agente, count(x.pay_method) as cnt_pay_method,
          sum(case when x.modoin is not null then 1 else 0 end) as cnt_modoin
        from ({source}) s
        left join history_target x on x.indice = s.indice and x.is_packed = s.is_packed
        group by 1 order by 1"""


@query("recon_amount", AMOUNT_SPEC, _amounts(EVERY_MONTH))
def _(t):
    return recon.recon_amount(coll.collections(sources(t), *ALL_MONTHS), t.history_target)


# without developers, as the audit's own source has it
OWN_SOURCE = f"""select h.indice, 1 as is_packed, year(h.fcobrado) as pay_year, month(h.fcobrado) as pay_month,
        h.monto as amount_bruta_usd
      from cardcollec h left join clients c on c.clientid = h.clientid
      where h.fcobrado is not null and h.statusc in {COLLECTED} and c.dppaidin not in (2)
      union all
      select i.id, 2, year(t.reference_date), month(t.reference_date), i.abono
      from tickets t join ticket_items i on i.ticket_id = t.idticket and i.tipodoc in ('NC', 'PA', 'DTO')
      join cardcollec h on h.indice = i.idcc join clients c on c.clientid = h.clientid
      where c.dppaidin = 2 and t.reference_date is not null"""


@query("recon_amount_independent", AMOUNT_SPEC, _amounts(OWN_SOURCE))
def _(t):
    return recon.recon_amount_independent(sources(t), t.history_target, *ALL_MONTHS)


# --- cleanup

YEAR = "date '2001-01-01'"
BAD_SOL = f"""select t.contador as k from requested_target t join redeems r on r.indice = t.contador
    where (coalesce(r.status_r, 0) = 0 or r.fcorreo is null) and t.fecha < {YEAR}"""


def _bad_status(target: str, key: str) -> str:
    return f"""select t.{key} as k from {target} t join payments p on p.indice = t.{key}
        where coalesce(p.status_p, 0) = 0 and t.fecha < {YEAR}"""


def _bad_orphan(target: str, key: str) -> str:
    return f"""select t.{key} as k from {target} t left join redeems r on r.pagoid = t.{key}
        where r.indice is null and t.fecha < {YEAR}"""


@query(
    "delete_reverted",
    "contador:i fecha:s monto:d",
    f"select contador, fecha, monto from requested_target where contador not in ({BAD_SOL})",
)
def _(t):
    bad = cleanup.suspect_requests(t.requested_target, t.redeems, ASOF)
    return cleanup.delete_reverted(t.requested_target, bad, "contador")


@query(
    "delete_orphans",
    "contador:i fecha:s monto:d",
    f"""select contador, fecha, monto from authorized_target
        where contador not in ({_bad_orphan('authorized_target', 'contador')})""",
)
def _(t):
    bad = cleanup.suspect_payments(
        t.authorized_target, t.payments, t.redeems, ASOF, "contador"
    )
    return cleanup.delete_orphans(t.authorized_target, bad, "contador")


def _cleanup_inputs(t):
    return (t.requested_target, t.authorized_target, t.paid_target, t.redeems, t.payments, ASOF)


@query(
    "cleanup_monthly",
    "sol:i aut:i pag:i total:i mensaje",
    f"""select sol, aut, pag, sol + aut + pag as total,
          concat('SOL: ', cast(sol as varchar), ' | AUT: ', cast(aut as varchar), ' | PAG: ', cast(pag as varchar)) as mensaje
        from (select
          (select count(distinct k) from ({BAD_SOL}) a) as sol,
          (select count(distinct k) from ({_bad_status('authorized_target', 'contador')} union
             {_bad_orphan('authorized_target', 'contador')}) b) as aut,
          (select count(distinct k) from ({_bad_status('paid_target', 'pagoid')} union
             {_bad_orphan('paid_target', 'pagoid')}) c) as pag) n""",
)
def _(t):
    return recon.cleanup_counts(*_cleanup_inputs(t))


ORPHANS = f"""select 'Solicitados' as tabla, count(*) as huerfanos from ({BAD_SOL}) a
    union all select 'Autorizados_status0', count(*) from ({_bad_status('authorized_target', 'contador')}) b
    union all select 'Autorizados_huerfanos', count(*) from ({_bad_orphan('authorized_target', 'contador')}) c
    union all select 'Pagados_status0', count(*) from ({_bad_status('paid_target', 'pagoid')}) d
    union all select 'Pagados_huerfanos', count(*) from ({_bad_orphan('paid_target', 'pagoid')}) e"""


@query("orphan_audit", "tabla huerfanos:i", ORPHANS)
def _(t):
    return recon.orphan_audit(*_cleanup_inputs(t))


@query(
    "union_counts",
    "tabla cnt:i",
    """select 'requested' as tabla, count(*) as cnt from requested_target
       union all select 'authorized', count(*) from authorized_target
       union all select 'paid', count(*) from paid_target""",
)
def _(t):
    return audit.table_check(
        {
            "requested": (t.requested_target, "contador"),
            "authorized": (t.authorized_target, "contador"),
            "paid": (t.paid_target, "pagoid"),
        }
    )


# --- gold


@query(
    "gold_clients",
    "clientid:i firstname lastname email country product contractid:i createdat:s updatedat:s",
    f"""select coalesce(t.clientid, s.clientid) as clientid,
          case when s.clientid is null then t.firstname else s.firstname end as firstname,
          case when s.clientid is null then t.lastname else s.lastname end as lastname,
          case when s.clientid is null then t.email else s.email end as email,
          case when s.clientid is null then t.country else s.country end as country,
          case when s.clientid is null then t.product else s.product end as product,
          case when s.clientid is null then t.contractid else s.contractid end as contractid,
          case when t.clientid is null then {STAMPED} else t.createdat end as createdat,
          case when t.clientid is not null and s.clientid is not null and (t.firstname is distinct from s.firstname
               or t.lastname is distinct from s.lastname or t.email is distinct from s.email
               or t.country is distinct from s.country or t.product is distinct from s.product
               or t.contractid is distinct from s.contractid) then {STAMPED} else t.updatedat end as updatedat
        from gold_target t full outer join (
          select * from (select *, row_number() over (partition by clientid
            order by rank asc nulls last, product, contractid) as n from client_view) b where n = 1) s
          on s.clientid = t.clientid""",
)
def _(t):
    return gold.gold_clients(t.gold_target, t.client_view, AT)


@query(
    "gold_client_detail",
    "product clientid:i contractid:i corpcode ingreso:s egreso:s rank:i estatusn:i",
    "select product, clientid, contractid, corpcode, ingreso, egreso, rank, estatusn from client_view",
)
def _(t):
    return gold.gold_client_detail(t.client_view)


@query("gold_phones", "clientid:i phone", "select distinct clientid, phone from phones")
def _(t):
    return gold.gold_phones(t.phones)


ACTIVE = """select c.clientid, c.company as iddev, d.idcorp from clients c left join developers d on d.iddev = c.company
    where exists (select 1 from redeems r where r.clientid = c.clientid and r.redeem_no = 1)"""


@query("active_clients", "clientid:i iddev:i idcorp:i", ACTIVE)
def _(t):
    return gold.active_clients(t.redeems, t.clients, t.developers)


@query(
    "expire_contracts",
    "clientid:i iddev:i ultimo:s finalizado:i",
    f"""select a.clientid, a.iddev, l.ultimo, case when year(l.ultimo) <= 2000 then 1 else 0 end as finalizado
        from ({ACTIVE}) a left join (
          select clientid, cast(max(fcorreo) as date) as ultimo from redeems group by clientid) l
          on l.clientid = a.clientid""",
)
def _(t):
    active = gold.active_clients(t.redeems, t.clients, t.developers)
    return gold.expire_contracts(active, t.redeems, ASOF)


@query(
    "update_column",
    "indice:i clientid:i inicio_r:s",
    """select r.indice, r.clientid, f.primero as inicio_r from redeems r left join (
         select clientid, cast(min(fcorreo) as date) as primero from redeems group by clientid) f
         on f.clientid = r.clientid""",
)
def _(t):
    return gold.set_first_request(t.redeems)


# --- reconciliation and audits

RECON_SPEC = "anio:i mes:i nommes cant_origen:i cant_destino:i diferencia:i"


def _recon_sql(on: str, tables: str, where: str, target: str) -> str:
    return f"""select s.anio, s.mes, s.nommes, s.cant as cant_origen, coalesce(x.cant, 0) as cant_destino,
          s.cant - coalesce(x.cant, 0) as diferencia
        from (select year({on}) as anio, month({on}) as mes, {month_name(on)} as nommes, count(*) as cant
              from {tables} where {where} and {on} < date '2001-07-01' group by all) s
        left join (select anio, mes, count(*) as cant from {target} where fecha < date '2001-07-01'
                   group by anio, mes) x on x.anio = s.anio and x.mes = s.mes
        order by s.anio, s.mes"""


@query(
    "recon_requested",
    RECON_SPEC,
    _recon_sql(
        "r.fcorreo",
        "redeems r left join clients c on c.clientid = r.clientid",
        "r.fcorreo is not null and coalesce(r.status_r, 0) <> 0",
        "requested_target",
    ),
)
def _(t):
    return recon.recon_requested(t.redeems, t.requested_target, ASOF)


@query(
    "recon_authorized",
    RECON_SPEC,
    _recon_sql(
        "p.f_authorized",
        "payments p join redeems r on r.pagoid = p.indice join clients c on c.clientid = r.clientid",
        "p.f_authorized is not null",
        "authorized_target",
    ),
)
def _(t):
    return recon.recon_authorized(t.payments, t.redeems, t.clients, t.authorized_target, ASOF)


@query(
    "recon_paid",
    RECON_SPEC,
    _recon_sql(
        "coalesce(p.f_excel, p.f_pago)",
        "payments p join redeems r on r.pagoid = p.indice left join clients c on c.clientid = r.clientid",
        "p.status_p >= 3 and coalesce(p.f_excel, p.f_pago) is not null",
        "paid_target",
    ),
)
def _(t):
    return recon.recon_paid(t.payments, t.redeems, t.paid_target, ASOF)


# The count rule as a catalogue writes it: pending source rows, found by a left join to the target.
_PENDING = {
    "solicitados": """select count(*), max(b.indice) from redeems b
        left join clients c on c.clientid = b.clientid left join requested_target t on t.contador = b.indice
        where not isnull(b.fcorreo) and ifnull(b.status_r, 0) <> 0 and (t.contador is null
          or date(coalesce(b.updateat, '2000-01-01')) > date(coalesce(t.update_at, '2000-01-01')))""",
    "autorizados": """select count(*), max(a.indice) from payments a
        inner join redeems b on b.pagoid = a.indice inner join clients c on c.clientid = b.clientid
        left join authorized_target t on t.contador = a.indice
        where not isnull(a.f_authorized) and (t.contador is null
          or date(coalesce(a.updateat, '2000-01-01')) > date(coalesce(t.update_at, '2000-01-01')))""",
    "pagados": """select count(*), max(a.indice) from payments a
        inner join redeems b on b.pagoid = a.indice left join clients c on c.clientid = b.clientid
        left join paid_target t on t.pagoid = a.indice
        where a.status_p >= 3 and not isnull(ifnull(a.f_excel, a.f_pago)) and (t.pagoid is null
          or date(coalesce(a.updateat, '2000-01-01')) > date(coalesce(t.update_at, '2000-01-01')))""",
}
AUDITED = ("redeems", "payments", "clients", "requested_target", "authorized_target", "paid_target")
CATALOGUE = [
    {
        "task_id": task,
        "descripcion": f"{task} events",
        "dag_id": "sync_facts",
        "origen": {"sql_count": text, "tabla": source, "id_col": "indice"},
        "destino": {
            "sql_count": f"select count(*), max({key}) from {target}",
            "tabla": target,
            "id_col": key,
        },
    }
    for task, source, target, key, text in (
        ("solicitados", "redeems", "requested_target", "contador", _PENDING["solicitados"]),
        ("autorizados", "payments", "authorized_target", "contador", _PENDING["autorizados"]),
        ("pagados", "payments", "paid_target", "pagoid", _PENDING["pagados"]),
    )
] + [
    {
        "task_id": "sin_tabla",
        "descripcion": "names a table that is not there",
        "dag_id": "none",
        "origen": {"tabla": "absent_table", "id_col": "id"},
        "destino": {"tabla": "redeems", "id_col": "indice"},
    },
    {
        "task_id": "se_rompe",
        "descripcion": "fails while it runs",
        "dag_id": "none",
        "origen": {
            "sql_count": "select count(*), max(cast(concat('x', indice) as bigint)) from redeems",
            "tabla": "absent_table",
            "id_col": "id",
        },
        "destino": {"tabla": "redeems", "id_col": "indice"},
    },
]
AUDIT_SPEC = (
    "task_id dag_id count_origen:i count_destino:i max_origen:i max_destino:i diferencia:i estado con_error:i"
)


def _audit(t, by: str):
    # the catalogue names tables in SQL text, as its users write it
    for name in AUDITED:
        getattr(t, name).createOrReplaceTempView(name)
    rows = audit.audit(t.spark, CATALOGUE, by)
    return rows.withColumn("con_error", F.col("error").isNotNull().cast("int"))


FAILED_ROW = " union all ".join(
    f"select '{task}', 'none', null, null, null, null, null, 'ERROR', 1" for task in ("sin_tabla", "se_rompe")
)


def _outcome(rows: str, gap: str) -> str:
    return f"""select *, {gap} as diferencia,
        case when {gap} > 0 then 'DIFERENCIA' else 'SINCRONIZADO' end as estado, 0 as con_error from ({rows}) o"""


_NEVER = "timestamp '2000-01-01 00:00:00'"
_NEWER = f"cast(coalesce(a.updateat, {_NEVER}) as date) > cast(coalesce(t.update_at, {_NEVER}) as date)"
_COUNTED = {
    "solicitados": (
        f"""select count(*) as n, max(a.indice) as m from redeems a left join requested_target t on t.contador = a.indice
            where a.fcorreo is not null and coalesce(a.status_r, 0) <> 0 and (t.contador is null or {_NEWER})""",
        "select count(*) as n, max(contador) as m from requested_target",
    ),
    "autorizados": (
        f"""select count(*) as n, max(a.indice) as m from payments a join redeems b on b.pagoid = a.indice
            join clients c on c.clientid = b.clientid left join authorized_target t on t.contador = a.indice
            where a.f_authorized is not null and (t.contador is null or {_NEWER})""",
        "select count(*) as n, max(contador) as m from authorized_target",
    ),
    "pagados": (
        f"""select count(*) as n, max(a.indice) as m from payments a join redeems b on b.pagoid = a.indice
            left join clients c on c.clientid = b.clientid left join paid_target t on t.pagoid = a.indice
            where a.status_p >= 3 and coalesce(a.f_excel, a.f_pago) is not null and (t.pagoid is null or {_NEWER})""",
        "select count(*) as n, max(pagoid) as m from paid_target",
    ),
}
_HIGHEST = {
    "solicitados": ("select max(indice) as m from redeems", "select max(contador) as m from requested_target"),
    "autorizados": ("select max(indice) as m from payments", "select max(contador) as m from authorized_target"),
    "pagados": ("select max(indice) as m from payments", "select max(pagoid) as m from paid_target"),
}


def _audit_sql(by_count: bool) -> str:
    def one(task: str) -> str:
        a, b = (_COUNTED if by_count else _HIGHEST)[task]
        counts = (
            f"(select n from ({a}) a1) as count_origen, (select n from ({b}) b1) as count_destino"
            if by_count
            else "null as count_origen, null as count_destino"
        )
        return f"""select '{task}' as task_id, 'sync_facts' as dag_id, {counts},
            (select coalesce(m, 0) from ({a}) a2) as max_origen, (select coalesce(m, 0) from ({b}) b2) as max_destino"""

    gap = "count_origen - count_destino" if by_count else "max_origen - max_destino"
    return _outcome(" union all ".join(one(task) for task in _COUNTED), gap) + f" union all {FAILED_ROW}"


@query("audit_catalogue", AUDIT_SPEC, _audit_sql(True))
def _(t):
    return _audit(t, "count")


@query("audit_max_only", AUDIT_SPEC, _audit_sql(False))
def _(t):
    return _audit(t, "max")


@query(
    "bronze_check",
    "tabla cnt:i max_id:i",
    """select 'bronze_clients' as tabla, count(*) as cnt, coalesce(max(clientid), 0) as max_id from bronze_target
       union all select 'phones', count(*), coalesce(max(clientid), 0) from phones
       union all select 'gold_clients', count(*), coalesce(max(clientid), 0) from gold_target""",
)
def _(t):
    return audit.table_check(
        {
            "bronze_clients": (t.bronze_target, "clientid"),
            "phones": (t.phones, "clientid"),
            "gold_clients": (t.gold_target, "clientid"),
        }
    )


# --- run log


@query(
    "runlog_summary",
    "paquete corridas:i errores:i ultima_corrida:s ultimo_estado filas:i segundos_prom:d",
    """select paquete, count(*) as corridas, sum(case when estado = 'ERROR' then 1 else 0 end) as errores,
          max(fecha_inicio) as ultima_corrida, arg_max(estado, (fecha_inicio, id)) as ultimo_estado,
          sum(filas_insertadas) as filas, avg(date_diff('second', fecha_inicio, fecha_fin)) as segundos_prom
       from runs_ended group by paquete""",
)
def _(t):
    return runlog.summary(t.runlog)


@query(
    "load_metrics",
    "run_id:i fecha_inicio:s paquete filas:i min_id:i max_id:i segundos:i filas_seg:d",
    """select l.run_id, r.fecha_inicio, r.paquete, l.filas, l.min_id, l.max_id,
          date_diff('second', r.fecha_inicio, r.fecha_fin) as segundos,
          cast(l.filas as double) / nullif(date_diff('second', r.fecha_inicio, r.fecha_fin), 0) as filas_seg
       from (select run_id, count(*) as filas, min(clientid) as min_id, max(clientid) as max_id
             from loaded group by run_id) l
       left join runs_ended r on r.id = l.run_id""",
)
def _(t):
    return runlog.load_metrics(t.loaded, t.runlog, "clientid")
