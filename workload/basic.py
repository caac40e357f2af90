"""Scans, filters, joins, aggregates, windows, set operations and scalar functions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.operators import aggregates as agg
from tidemark.operators import cleanup, joins, load, shape
from tidemark.plans import collections as coll
from tidemark.plans import runlog
from tidemark.sources.tables import CLIENT_COLUMNS, PHONE_COLUMNS, run_template, scan
from workload.registry import query

ASOF = date(2001, 7, 1)
AT = datetime(2001, 7, 20, 5, 30)
ALL_MONTHS = (None, shape.OPEN)
MONTH = 200005

MONTH_NAME = (
    "case month({d}) when 1 then 'Enero' when 2 then 'Febrero' when 3 then 'Marzo' when 4 then 'Abril' "
    "when 5 then 'Mayo' when 6 then 'Junio' when 7 then 'Julio' when 8 then 'Agosto' "
    "when 9 then 'Septiembre' when 10 then 'Octubre' when 11 then 'Noviembre' when 12 then 'Diciembre' end"
)
COLLECTED = "(1, 2, 3, 6, 7, 9, 10, 12)"


def month_name(d: str) -> str:
    return MONTH_NAME.format(d=d)


def sources(t) -> coll.Sources:
    return coll.Sources(t.cardcollec, t.tickets, t.ticket_items, t.clients, t.developers)


# --- scans

CLIENT_SPEC = (
    "productid:i contractid:i clientid:i email capdata firstname lastname countrycode country estate "
    "ciudad address zip corpcode corp ingreso:s egreso:s rank:i estatusn:i estatusl"
)


@query("scan_projected", CLIENT_SPEC, "select * from client_view")
def _(t):
    return scan(t.client_view, CLIENT_COLUMNS)


@query("scan_pair", "clientid:i phone", "select clientid, phone from phones")
def _(t):
    return scan(t.phones, PHONE_COLUMNS)


@query(
    "param_query",
    "product cnt:i max_id:i",
    """select product, count(*) as cnt, max(clientid) as max_id from client_view
       where clientid > 20 group by product""",
)
def _(t):
    t.client_view.createOrReplaceTempView("source_clients")
    text = """select product, count(*) as cnt, max(clientid) as max_id from {tabla}
              where clientid > {max_id} group by product"""
    return run_template(t.spark, text, {"max_id": 20}, {"tabla": "source_clients"})


# --- projections and filters


@query(
    "stamp_insert",
    "clientid:i contractid:i createdat:s updatedat:s deletedat:s",
    """select clientid, contractid, timestamp '2001-07-20 05:30:00' as createdat,
              cast(null as timestamp) as updatedat, cast(null as timestamp) as deletedat from client_view""",
)
def _(t):
    return shape.stamp_insert(t.client_view, AT)


@query(
    "stamp_refresh",
    "clientid:i phone atinsert:s atupdate:s",
    """select clientid, phone, timestamp '2001-07-20 05:30:00' as atinsert,
              cast(null as timestamp) as atupdate from phones""",
)
def _(t):
    return shape.stamp_refresh(t.phones, AT)


@query(
    "filter_above_watermark",
    "clientid:i contractid:i email",
    """select clientid, contractid, email from client_view
       where clientid > (select coalesce(max(clientid), 0) from bronze_target)""",
)
def _(t):
    return shape.above(t.client_view, "clientid", load.watermark(t.bronze_target, "clientid"))


@query(
    "filter_id_list",
    "clientid:i contractid:i email",
    """select clientid, contractid, email from client_view
       where clientid in (select clientid from client_view
         where clientid <= (select max(clientid) from bronze_target)
           and clientid not in (select clientid from bronze_target))""",
)
def _(t):
    wanted = load.missing_keys(t.client_view, t.bronze_target, "clientid")
    return shape.by_ids(t.client_view, "clientid", wanted)


@query(
    "filter_requested",
    "indice:i clientid:i fcorreo:s status_r:i",
    "select * from redeems where fcorreo is not null and coalesce(status_r, 0) <> 0",
)
def _(t):
    return shape.requested(t.redeems)


@query(
    "filter_authorized",
    "indice:i f_authorized:s",
    "select * from payments where f_authorized is not null",
)
def _(t):
    return shape.authorized(t.payments)


@query(
    "filter_paid",
    "indice:i status_p:i on_date:s",
    """select indice, status_p, coalesce(f_excel, f_pago) as on_date from payments
       where status_p >= 3 and coalesce(f_excel, f_pago) is not null""",
)
def _(t):
    return shape.paid(t.payments).withColumn("on_date", shape.paid_date())


@query(
    "filter_before_today",
    "indice:i fcorreo:s",
    "select indice, fcorreo from redeems where fcorreo < date '2001-07-01'",
)
def _(t):
    return shape.before(t.redeems, "fcorreo", ASOF)


@query(
    "filter_status_list",
    "indice:i statusc:i fcobrado:s",
    f"select * from cardcollec where fcobrado is not null and statusc in {COLLECTED}",
)
def _(t):
    return shape.collected(t.cardcollec)


@query(
    "filter_year_month",
    "indice:i fcobrado:s",
    """select indice, fcobrado from cardcollec
       where year(fcobrado) * 100 + month(fcobrado) between 200003 and 200008""",
)
def _(t):
    return shape.in_month(t.cardcollec, "fcobrado", 200003, 200008)


@query(
    "filter_prior_years",
    "contador:i fecha:s",
    "select contador, fecha from requested_target where fecha < date '2001-01-01'",
)
def _(t):
    return shape.before_year(t.requested_target, "fecha", ASOF)


# --- joins


@query(
    "join_left_client",
    "indice:i clientid:i dppaidin:i company:i",
    """select r.indice, r.clientid, c.dppaidin, c.company
       from redeems r left join clients c on c.clientid = r.clientid
       where r.fcorreo is not null and coalesce(r.status_r, 0) <> 0""",
)
def _(t):
    dim = t.clients.select("clientid", "dppaidin", "company")
    return joins.enrich(shape.requested(t.redeems), dim, "clientid")


@query(
    "join_inner_chain",
    "indice:i request:i clientid:i dppaidin:i f_authorized:s",
    """select p.indice, r.indice as request, c.clientid, c.dppaidin, p.f_authorized
       from payments p join redeems r on r.pagoid = p.indice join clients c on c.clientid = r.clientid
       where p.f_authorized is not null""",
)
def _(t):
    asked = t.redeems.select(F.col("indice").alias("request"), "pagoid", "clientid")
    return joins.chain(
        shape.authorized(t.payments),
        (asked, F.col("pagoid") == F.col("indice"), "inner"),
        (t.clients.select("clientid", "dppaidin"), "clientid", "inner"),
    )


@query(
    "join_inner_then_left",
    "indice:i request:i clientid:i dppaidin:i",
    """select p.indice, r.indice as request, r.clientid, c.dppaidin
       from payments p join redeems r on r.pagoid = p.indice left join clients c on c.clientid = r.clientid
       where p.status_p >= 3 and coalesce(p.f_excel, p.f_pago) is not null""",
)
def _(t):
    asked = t.redeems.select(F.col("indice").alias("request"), "pagoid", "clientid")
    return joins.chain(
        shape.paid(t.payments),
        (asked, F.col("pagoid") == F.col("indice"), "inner"),
        (t.clients.select("clientid", "dppaidin"), "clientid", "left"),
    )


@query(
    "join_five_way",
    "indice:i idcc:i clientid:i iddev:i idcorp:i pay_date:s amount_bruta_usd:d",
    """select i.id as indice, i.idcc, h.clientid, d.iddev, d.idcorp,
              cast(t.reference_date as date) as pay_date, i.abono as amount_bruta_usd
       from tickets t join ticket_items i on i.ticket_id = t.idticket and i.tipodoc in ('NC', 'PA', 'DTO')
       join cardcollec h on h.indice = i.idcc join clients c on c.clientid = h.clientid
       join developers d on d.iddev = c.company
       where c.dppaidin = 2 and t.reference_date is not null""",
)
def _(t):
    return coll.packed(sources(t), *ALL_MONTHS)


@query(
    "join_on_condition",
    "idticket:i id:i tipodoc abono:d",
    """select t.idticket, i.id, i.tipodoc, i.abono from tickets t
       join ticket_items i on i.ticket_id = t.idticket and i.tipodoc in ('NC', 'PA')""",
)
def _(t):
    on = (F.col("ticket_id") == F.col("idticket")) & F.col("tipodoc").isin("NC", "PA")
    return joins.chain(t.tickets, (t.ticket_items, on, "inner"))


@query(
    "join_composite_key",
    "indice:i is_packed:i amount_bruta_usd:d held:d",
    """select s.indice, s.is_packed, s.amount as amount_bruta_usd, h.amount_bruta_usd as held from (
         select indice, 1 as is_packed, monto as amount from cardcollec
         union all select id, 2, abono from ticket_items) s
       join history_target h on h.indice = s.indice and h.is_packed = s.is_packed""",
)
def _(t):
    plain = t.cardcollec.select("indice", F.col("monto").alias("amount_bruta_usd"))
    items = t.ticket_items.select(
        F.col("id").alias("indice"), F.col("abono").alias("amount_bruta_usd")
    )
    held = t.history_target.select(
        "indice", "is_packed", F.col("amount_bruta_usd").alias("held")
    )
    return joins.enrich(agg.union_tagged(plain, items), held, coll.HISTORY_KEY, "inner")


@query(
    "join_aggregates",
    "anio:i mes:i nommes cant:i held:i",
    f"""select s.*, h.held from (
          select year(fcorreo) as anio, month(fcorreo) as mes, {month_name('fcorreo')} as nommes,
                 count(*) as cant from redeems where fcorreo is not null group by all) s
        left join (select anio, mes, count(*) as held from requested_target group by anio, mes) h
          on h.anio = s.anio and h.mes = s.mes""",
)
def _(t):
    rows = t.redeems.where("fcorreo is not null")
    held = t.requested_target.groupBy("anio", "mes").agg(F.count("*").alias("held"))
    return agg.month_count(rows, F.col("fcorreo")).join(held, ["anio", "mes"], "left")


@query(
    "semi_in_subquery",
    "indice:i fcobrado:s",
    """select indice, fcobrado from cardcollec
       where (fcobrado >= date '2000-05-01' and fcobrado < date '2000-06-01')
          or indice in (select cardcollec_id from colleclog where reg = 'UPDATE')""",
)
def _(t):
    changed = t.colleclog.where("reg = 'UPDATE'").select("cardcollec_id").distinct()
    this_month = shape.month_range("fcobrado", MONTH)
    return t.cardcollec.where(joins.listed_or(this_month, "indice", changed))


@query(
    "semi_exists",
    "id:i paquete estado",
    "select id, paquete, estado from runlog r where exists (select 1 from archive a where a.id = r.id)",
)
def _(t):
    return joins.exists_in(t.runlog, t.archive, "id")


@query(
    "anti_missing",
    "indice:i status_p:i",
    """select p.indice, p.status_p from payments p left join redeems r on r.pagoid = p.indice
       where r.indice is null""",
)
def _(t):
    return joins.missing_in(t.payments, t.redeems, "indice", "pagoid")


@query(
    "missing_keys",
    "clientid:i",
    """select clientid from client_view
       where clientid <= (select coalesce(max(clientid), 0) from bronze_target)
         and clientid not in (select clientid from bronze_target)""",
)
def _(t):
    return load.missing_keys(t.client_view, t.bronze_target, "clientid")


# --- aggregates


@query(
    "agg_max_key",
    "max_id:i",
    "select coalesce(max(clientid), 0) as max_id from bronze_target",
)
def _(t):
    return agg.max_key(t.bronze_target, "clientid")


@query(
    "agg_count_max",
    "cnt:i max_id:i",
    "select count(*) as cnt, coalesce(max(contador), 0) as max_id from requested_target",
)
def _(t):
    return agg.count_max(t.requested_target, "contador")


@query(
    "agg_month_count",
    "anio:i mes:i nommes cant:i",
    f"""select year(o_orderdate) as anio, month(o_orderdate) as mes,
               {month_name('o_orderdate')} as nommes, count(*) as cant from orders group by all""",
)
def _(t):
    return agg.month_count(t.orders, F.col("o_orderdate"))


@query(
    "agg_month_amount",
    "pay_year_month:i cnt:i monto:d",
    """select year(pay_date) * 100 + month(pay_date) as pay_year_month, count(*) as cnt,
              round(sum(amount_bruta_usd), 2) as monto from history_target group by 1""",
)
def _(t):
    return agg.month_amount(t.history_target, "pay_date", "amount_bruta_usd")


@query(
    "agg_count_nonnull",
    "pay_year:i cnt_idcc:i cnt_clientid_uniq:i cnt_agente:i cnt_pay_method:i cnt_modoin:i",
    """select pay_year, count(idcc) as cnt_idcc, count(distinct clientid) as cnt_clientid_uniq,
              count(agente) as cnt_agente, count(pay_method) as cnt_pay_method,
              sum(case when modoin is not null then 1 else 0 end) as cnt_modoin
       from history_target group by pay_year""",
)
def _(t):
    return t.history_target.groupBy("pay_year").agg(*agg.filled_counts())


@query(
    "null_profile",
    "total_registros:i null_idcc:i null_clientid:i null_pay_date:i null_modoin:i null_agente:i "
    "null_pay_method:i null_statusc:i",
    """select count(*) as total_registros, count(*) - count(idcc) as null_idcc,
              count(*) - count(clientid) as null_clientid, count(*) - count(pay_date) as null_pay_date,
              count(*) - count(modoin) as null_modoin, count(*) - count(agente) as null_agente,
              count(*) - count(pay_method) as null_pay_method, count(*) - count(statusc) as null_statusc
       from history_target""",
)
def _(t):
    cols = ["idcc", "clientid", "pay_date", "modoin", "agente", "pay_method", "statusc"]
    return agg.null_profile(t.history_target, cols)


@query(
    "agg_year_totals",
    "pay_year:i total_bruta:d packed_bruta:d total_neta:d",
    """select pay_year, sum(amount_bruta_usd) as total_bruta,
              sum(case when is_packed = 2 then amount_bruta_usd else 0 end) as packed_bruta,
              sum(amount_neta_usd) as total_neta from history_target group by pay_year""",
)
def _(t):
    return agg.year_totals(t.history_target)


@query(
    "dedupe_by_key",
    "clientid:i contractid:i product rank:i",
    """select clientid, contractid, product, rank from (
         select *, row_number() over (partition by clientid
           order by rank asc nulls last, contractid desc) as n from client_view) x where n = 1""",
)
def _(t):
    order = [F.asc_nulls_last("rank"), F.desc("contractid")]
    return agg.one_per_key(t.client_view, ["clientid"], order)


@query(
    "agg_state_count",
    "paquete estado cnt:i",
    "select paquete, estado, count(*) as cnt from runlog group by paquete, estado",
)
def _(t):
    return agg.state_counts(t.runlog)


# --- window, sort, set operations


@query(
    "latest_change",
    "cardcollec_id:i id:i fecha:s monto:d statusc:i",
    """select cardcollec_id, id, fecha, monto, statusc from (
         select *, row_number() over (partition by cardcollec_id order by fecha desc, id desc) as n
         from colleclog where reg = 'UPDATE') x where n = 1""",
)
def _(t):
    return agg.latest(t.colleclog.where("reg = 'UPDATE'"), ["cardcollec_id"], "fecha", "id")


@query(
    "sort_month",
    "anio:i mes:i nommes cant:i",
    f"""select year(fecha) as anio, month(fecha) as mes, {month_name('fecha')} as nommes,
               count(*) as cant from paid_target group by all order by 1, 2""",
)
def _(t):
    return agg.month_count(t.paid_target, F.col("fecha")).orderBy("anio", "mes")


@query(
    "top_recent",
    "view id:i paquete estado fecha_inicio:s",
    """select 'all' as view, * from (select * from runs_ended order by fecha_inicio desc, id desc limit 20) a
       union all
       select 'errors', * from (select * from runs_ended where estado = 'ERROR'
         order by fecha_inicio desc, id desc limit 10) b
       union all
       select 'job', * from (select * from runs_ended where paquete = 'job_click'
         order by fecha_inicio desc, id desc limit 5) c""",
)
def _(t):
    named = {
        "all": agg.recent(runlog.ended(t.runlog), 20),
        "errors": agg.recent(runlog.ended(t.runlog), 10, state="ERROR"),
        "job": agg.recent(runlog.ended(t.runlog), 5, job="job_click"),
    }
    views = [df.withColumn("view", F.lit(v)) for v, df in named.items()]
    return views[0].unionByName(views[1]).unionByName(views[2])


@query(
    "union_branches",
    "indice:i is_packed:i monto:d",
    """select indice, 1 as is_packed, monto from cardcollec
       union all select id, 2, abono from ticket_items""",
)
def _(t):
    items = t.ticket_items.select(F.col("id").alias("indice"), F.col("abono").alias("monto"))
    return agg.union_tagged(t.cardcollec.select("indice", "monto"), items)


# --- scalar functions


@query(
    "fn_null_default",
    "clientid:i rank:i egreso:s",
    """select clientid, coalesce(rank, -1) as rank,
              coalesce(egreso, timestamp '9999-12-31 00:00:00') as egreso from client_view""",
)
def _(t):
    return t.client_view.select(
        "clientid",
        fn.null_default("rank", -1).alias("rank"),
        F.coalesce("egreso", fn.as_ntz("9999-12-31 00:00:00")).alias("egreso"),
    )


@query(
    "fn_month_name",
    "indice:i nommes",
    f"select indice, {month_name('fcorreo')} as nommes from redeems",
)
def _(t):
    return t.redeems.select("indice", fn.month_name("fcorreo").alias("nommes"))


@query(
    "fn_date_parts",
    "indice:i fecha:s dia:i mes:i anio:i aniomes:i nommes",
    f"""select indice, cast(fcorreo as date) as fecha, day(fcorreo) as dia, month(fcorreo) as mes,
               year(fcorreo) as anio, year(fcorreo) * 100 + month(fcorreo) as aniomes,
               {month_name('fcorreo')} as nommes from redeems""",
)
def _(t):
    return t.redeems.select("indice", *fn.date_parts("fcorreo"))


@query(
    "fn_prev_month",
    "indice:i prev:i",
    """select indice, year(fcorreo - interval '1' month) * 100 + month(fcorreo - interval '1' month) as prev
       from redeems""",
)
def _(t):
    return t.redeems.select("indice", fn.previous_month("fcorreo").alias("prev"))


@query(
    "fn_year_start",
    "indice:i first_day:s",
    "select indice, cast(date_trunc('year', fcorreo) as date) as first_day from redeems",
)
def _(t):
    return t.redeems.select("indice", fn.year_start("fcorreo").alias("first_day"))


@query(
    "fn_week",
    "id:i week:i",
    "select id, weekofyear(fecha_inicio) as week from runlog",
)
def _(t):
    return t.runlog.select("id", fn.iso_week("fecha_inicio").alias("week"))


CHARGE_MODE = (
    "case when with_card = 1 and dppaidin in (1, 3, 6, 7, 8, 9) then 1 when dppaidin = 2 then 2 "
    "when dppaidin in (4, 5) or clientid < 0 then 3 when dppaidin = 10 then 4 when dppaidin = 11 then 5 "
    "else 0 end"
)


@query(
    "fn_charge_mode",
    "clientid:i modoin:i",
    f"select clientid, {CHARGE_MODE} as modoin from clients",
)
def _(t):
    mode = fn.charge_mode(F.col("dppaidin"), F.col("with_card"), F.col("clientid"))
    return t.clients.select("clientid", mode.alias("modoin"))


@query(
    "fn_pack_flag",
    "clientid:i pack:i",
    "select clientid, case when dppaidin = 2 then 1 else 0 end as pack from clients",
)
def _(t):
    return t.clients.select("clientid", fn.pack_flag(F.col("dppaidin")).alias("pack"))


@query(
    "fn_net_amount",
    "kind indice:i net:d",
    """select 'plain' as kind, indice, case when statusc in (1, 2, 3) then monto else 0 end as net from cardcollec
       union all select 'packed', id, case when tipodoc = 'PA' then abono else 0 end from ticket_items""",
)
def _(t):
    plain = t.cardcollec.select(
        F.lit("plain").alias("kind"),
        "indice",
        fn.net_amount(F.col("monto"), statusc=F.col("statusc")).alias("net"),
    )
    packed = t.ticket_items.select(
        F.lit("packed").alias("kind"),
        F.col("id").alias("indice"),
        fn.net_amount(F.col("abono"), tipodoc=F.col("tipodoc")).alias("net"),
    )
    return plain.unionByName(packed)


@query(
    "fn_to_usd",
    "indice:i is_packed:i amount_bruta_usd:d",
    """select indice, is_packed, round(case when h.currency = 'MXN'
          then cast(amount_bruta_usd as double) / cast(rate as double)
          else cast(amount_bruta_usd as double) end, 6) as amount_bruta_usd
       from history_target h left join rates r on r.currency = h.currency and r.anio = h.pay_year""",
)
def _(t):
    return coll.in_usd(t.history_target, t.rates)


@query(
    "fn_changed",
    "contador:i distinto:i",
    """select t.contador, case when t.monto is distinct from r.monto
          or t.currency is distinct from r.currency then 1 else 0 end as distinto
       from requested_target t join redeems r on r.indice = t.contador""",
)
def _(t):
    now = t.redeems.select(
        F.col("indice").alias("contador"), F.col("monto").alias("n_monto"), F.col("currency").alias("n_currency")
    )
    differs = fn.changed(F.col, lambda c: F.col("n_" + c), ["monto", "currency"])
    return t.requested_target.join(now, "contador").select(
        "contador", differs.cast("int").alias("distinto")
    )


# --- archive


@query(
    "archive_rows",
    "id:i paquete estado archived_at:s archived_week:i archived_date:s",
    """select id, paquete, estado, timestamp '2001-07-20 05:30:00' as archived_at,
              weekofyear(date '2001-07-20') as archived_week, date '2001-07-20' as archived_date
       from runs_ended where estado in ('OK', 'ERROR')""",
)
def _(t):
    return cleanup.archive_rows(runlog.ended(t.runlog), ["OK", "ERROR"], AT)


@query(
    "delete_archived",
    "id:i paquete estado",
    "select id, paquete, estado from runlog where id not in (select id from archive)",
)
def _(t):
    return cleanup.purge_archived(t.runlog, t.archive)
