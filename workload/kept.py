"""Located differences, and results that follow from state kept between loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import asof, extremes, intervals, load, merge, profiles, shape, totals
from tidemark.plans import collections as coll
from tidemark.plans import gold, recon, runlog
from tidemark.session import new_folder
from tidemark.sources import keyed
from tidemark.streaming import changes
from workload.basic import ALL_MONTHS, ASOF, AT, month_name, sources
from workload.registry import query
from workload.warehouse import EVERY_MONTH, LATE, LATE_MONTH, NEWER, REQUESTED, STAMPED, _merged_sql, _ym

# --- rows behind a difference

UNTIL = "date '2001-07-01'"
DIFF_SPEC = "lado mes_origen:i mes_destino:i filas_origen:i filas_destino:i"


def _located(keys: str, source: str, target: str) -> str:
    """Keys of which one side holds a row, as often as it does, that the other does not; m is the month, n the weight."""
    return f"""
        select {keys}, case when max(d) is null then 'origen' when max(o) is null then 'destino' else 'distinto' end as lado,
            max(o) as mes_origen, max(d) as mes_destino, sum(no) as filas_origen, sum(nd) as filas_destino
        from (
            select {keys}, m, v, max(o) as o, max(d) as d, sum(no) as no, sum(nd) as nd
            from (
                select {keys}, m, v, m as o, null as d, n as no, 0 as nd from ({source}) s
                union all select {keys}, m, v, null, m, 0, n from ({target}) t) u
            group by {keys}, m, v) w
        group by {keys} having bool_or(no <> nd)"""


def _fact_rows(target: str, key: str, *values: str) -> str:
    cells = ", ".join(("fecha", *values))
    return f"select {key}, anio * 100 + mes as m, ({cells}) as v, 1 as n from {target} where fecha < {UNTIL}"


def _source_rows(key: str, on: str, cells: str, tables: str, where: str, weight: str = "1") -> str:
    return f"""select a.indice as {key}, {_ym(on)} as m, (cast({on} as date), {cells}) as v, {weight} as n
        from {tables} where {where} and {on} < {UNTIL}"""


PER_PAYMENT = "(select pagoid, count(*) as n from redeems r {join} where pagoid is not null group by pagoid) q on q.pagoid = a.indice"


@query(
    "recon_requested_rows",
    f"contador:i {DIFF_SPEC}",
    _located(
        "contador",
        _source_rows(
            "contador", "a.fcorreo", "cast(monto as decimal(11,2)), cast(status_r as int)", "redeems a",
            "a.fcorreo is not null and coalesce(a.status_r, 0) <> 0",
        ),
        _fact_rows("requested_target", "contador", "monto", "status_r"),
    ),
)
def _(t):
    return recon.requested_differences(t.redeems, t.requested_target, ASOF)


@query(
    "recon_authorized_rows",
    f"contador:i {DIFF_SPEC}",
    _located(
        "contador",
        _source_rows(
            "contador", "a.f_authorized", "cast(monto as decimal(11,2))",
            f"payments a join {PER_PAYMENT.format(join='join clients c on c.clientid = r.clientid')}",
            "a.f_authorized is not null", "q.n",
        ),
        _fact_rows("authorized_target", "contador", "monto"),
    ),
)
def _(t):
    return recon.authorized_differences(t.payments, t.redeems, t.clients, t.authorized_target, ASOF)


@query(
    "recon_paid_rows",
    f"pagoid:i {DIFF_SPEC}",
    _located(
        "pagoid",
        _source_rows(
            "pagoid", "coalesce(a.f_excel, a.f_pago)", "cast(monto as decimal(11,2))",
            f"payments a join {PER_PAYMENT.format(join='')}",
            "a.status_p >= 3 and coalesce(a.f_excel, a.f_pago) is not null", "q.n",
        ),
        _fact_rows("paid_target", "pagoid", "monto"),
    ),
)
def _(t):
    return recon.paid_differences(t.payments, t.redeems, t.paid_target, ASOF)


_AMOUNT_ROWS = "select indice, is_packed, pay_year * 100 + pay_month as m, amount_bruta_usd as v, 1 as n from "


@query(
    "recon_amount_rows",
    f"indice:i is_packed:i {DIFF_SPEC}",
    _located("indice, is_packed", f"{_AMOUNT_ROWS} ({EVERY_MONTH}) e", f"{_AMOUNT_ROWS} history_target"),
)
def _(t):
    return recon.amount_differences(coll.collections(sources(t), *ALL_MONTHS), t.history_target)


# --- runs of loaded keys


def _held(t):
    """Keys of the target as three loads recorded them."""
    loads = [intervals.runs(t.bronze_target.where(F.col("clientid") % 3 == i), "clientid") for i in range(3)]
    return intervals.merged(loads[0].unionByName(loads[1]).unionByName(loads[2]))


MISSING = """clientid <= (select coalesce(max(clientid), 0) from bronze_target)
          and clientid not in (select clientid from bronze_target)"""


@query("missing_keys_by_runs", "clientid:i", f"select clientid from client_view where {MISSING}")
def _(t):
    return load.missing_keys_by_runs(t.client_view, _held(t), "clientid")


@query(
    "repair_missing_by_runs",
    "clientid:i contractid:i createdat:s",
    f"select clientid, contractid, {STAMPED} as createdat from client_view where {MISSING}",
)
def _(t):
    return load.repair_missing_by_runs(t.client_view, _held(t), "clientid", AT)


@query(
    "key_runs",
    "lo:i hi:i n:i",
    """select min(k) as lo, max(k) as hi, sum(n) as n
       from (select k, n, b, k - row_number() over (partition by b order by k) as run
             from (select clientid as k, floor(clientid / 1024) as b, count(*) as n from bronze_target
                   where clientid is not null group by clientid))
       group by b, run""",
)
def _(t):
    return _held(t)


# --- the change log as a stream


def _folded(t):
    """Last changes, from the log read as a stream of files."""
    spark, base = t.spark, new_folder(t.spark, "changes")
    log = t.colleclog
    log.repartition(8).write.parquet(f"{base}/log")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 3).parquet(f"{base}/log")
    changes.fold_changes(stream, f"{base}/last", f"{base}/checkpoint").awaitTermination()
    return changes.folded_changes(spark, f"{base}/last", LATE_MONTH)


@query(
    "collections_late_changes_folded",
    "cardcollec_id:i monto:d statusc:i fcobrado:s currency pay_method",
    f"""select cardcollec_id, monto, statusc, cast(fcobrado as date) as fcobrado, currency, pay_method
        from ({LATE}) z""",
)
def _(t):
    return coll.unseen_changes(_folded(t), t.history_target)


# --- totals and extremes by signed changes

LAST_VERSION = """(select * from (select *, row_number() over (partition by contador order by version desc) as rn
    from requested_changes) c where rn = 1)"""
KEPT_COLS = "contador, clientid, fecha, anio, mes, monto"
AFTER = f"""(select {KEPT_COLS} from {LAST_VERSION} n where contador % 41 <> 0
    union all select {KEPT_COLS} from requested_target
    where contador % 41 <> 0 and contador not in (select contador from requested_changes))"""
REQUEST_COLS = ["clientid", "fecha", "anio", "mes", "monto"]


def _requested_after(t):
    """The table after its load and its deletes, and both as signed changes."""
    old, new, order = t.requested_target, t.requested_changes, [F.desc("version")]
    loaded = merge.upsert(old, new, ["contador"], order=order)
    gone = loaded.where("contador % 41 = 0")
    signed = merge.captured(old, new, ["contador"], REQUEST_COLS, order=order).unionByName(
        merge.removed(loaded, gone, ["contador"], REQUEST_COLS)
    )
    return loaded.where("contador % 41 <> 0"), signed


@query(
    "upsert_repeated_keys",
    "contador:i clientid:i fecha:s anio:i mes:i monto:d currency status_r:i eliminado:i create_at:s",
    f"""select s.contador, s.clientid, s.fecha, s.anio, s.mes, s.monto, s.currency, s.status_r,
          t.eliminado, t.create_at from {LAST_VERSION} s left join requested_target t on t.contador = s.contador
        union all
        select contador, clientid, fecha, anio, mes, monto, currency, status_r, eliminado, create_at
        from requested_target where contador not in (select contador from requested_changes)""",
)
def _(t):
    return merge.upsert(t.requested_target, t.requested_changes, ["contador"], order=[F.desc("version")])


def _moved_totals(before, signed, by, sums):
    parts = totals.signed_totals(before, by, sums).unionByName(totals.signed_totals(signed, by, sums))
    return totals.shown(totals.added_up(parts, parts.columns[: len(by)]), list(sums))


@query(
    "totals_month_count",
    "anio:i mes:i nommes cant:i",
    f"""select anio, mes, {month_name('min(fecha)')} as nommes, count(*) as cant from {AFTER} a group by anio, mes""",
)
def _(t):
    found = _moved_totals(t.requested_target, _requested_after(t)[1], [F.col("anio"), F.col("mes")], {})
    return found.select("anio", "mes", recon.name_of_month("mes").alias("nommes"), F.col("cnt").alias("cant"))


@query(
    "totals_month_amount",
    "pay_year_month:i cnt:i monto:d",
    f"""select anio * 100 + mes as pay_year_month, count(*) as cnt, round(sum(monto), 2) as monto
        from {AFTER} a group by 1""",
)
def _(t):
    by = [(F.col("anio") * 100 + F.col("mes")).alias("pay_year_month")]
    found = _moved_totals(t.requested_target, _requested_after(t)[1], by, {"monto": F.col("monto")})
    return found.withColumn("monto", F.round("monto", 2))


HISTORY_SUMS = {
    "total_bruta": F.col,
    "packed_bruta": lambda c: F.when(F.col("is_packed") == 2, F.col(c)),
}
HISTORY_AFTER = f"(select * from ({_merged_sql(EVERY_MONTH)}) m where indice % 41 <> 0)"


@query(
    "totals_year",
    "pay_year:i total_bruta:d packed_bruta:d total_neta:d",
    f"""select pay_year, sum(amount_bruta_usd) as total_bruta,
          coalesce(sum(case when is_packed = 2 then amount_bruta_usd end), 0) as packed_bruta,
          sum(amount_neta_usd) as total_neta from {HISTORY_AFTER} h group by pay_year""",
)
def _(t):
    keys, cols = ["indice", "is_packed"], ["pay_year", "amount_bruta_usd", "amount_neta_usd"]
    rows = coll.collections(sources(t), *ALL_MONTHS)
    loaded = merge.upsert(t.history_target, rows, keys, filtered=True)
    gone = merge.removed(loaded, F.expr("indice % 41 = 0"), keys, cols)
    signed = merge.captured(t.history_target, rows, keys, cols).unionByName(gone)
    sums = {name: of("amount_bruta_usd") for name, of in HISTORY_SUMS.items()} | {"total_neta": F.col("amount_neta_usd")}
    found = _moved_totals(t.history_target, signed, [F.col("pay_year")], sums)
    return found.withColumn("packed_bruta", F.coalesce("packed_bruta", F.lit(0))).drop("cnt")


@query(
    "first_last_requests",
    "clientid:i filas:i primero:s ultimo:s",
    f"select clientid, count(*) as filas, min(fecha) as primero, max(fecha) as ultimo from {AFTER} a group by clientid",
)
def _(t):
    after, signed = _requested_after(t)
    kept = extremes.extremes(t.requested_target, "clientid", "fecha")
    return extremes.after_changes(kept, signed, after, "clientid", "fecha")


FIRST_KNOWN = """select c.clientid, c.company as iddev from clients c
    where c.clientid in (select clientid from redeems where redeem_no = 1)"""


@query(
    "expire_contracts_kept",
    "clientid:i iddev:i idcorp:i ultimo:s finalizado:i",
    f"""select a.clientid, a.iddev, d.idcorp, u.ultimo,
          case when year(u.ultimo) <= 2000 then 1 else 0 end as finalizado
        from ({FIRST_KNOWN}) a left join developers d on d.iddev = a.iddev
        left join (select clientid, cast(max(fcorreo) as date) as ultimo from redeems group by clientid) u
          on u.clientid = a.clientid""",
)
def _(t):
    old = t.redeems_before
    new = t.redeems.select("indice", "clientid", F.to_date("fcorreo").alias("fcorreo"))
    gone = old.join(new, "indice", "left_anti")
    cols = ["clientid", "fcorreo"]
    signed = merge.captured(old, new, ["indice"], cols).unionByName(merge.removed(old, gone, ["indice"], cols))
    last = extremes.after_changes(extremes.extremes(old, "clientid", "fcorreo"), signed, new, "clientid", "fcorreo")
    active = gold.active_clients(t.redeems, t.clients, t.developers)
    return gold.expire_by_last(active, last, ASOF)


# --- changed rows found in key tables that lie by key


@query(
    "pending_row_bucketed",
    "indice:i updateat:s",
    f"""select s.indice, s.updateat from redeems s
        left join (select contador as k, update_at as u from requested_target) x on x.k = s.indice
        where {REQUESTED} and {NEWER}""",
)
def _(t):
    name = "keys_" + new_folder(t.spark, "requested").rpartition("-")[2]
    held = keyed.write_keys(t.requested_target, name, "contador", "update_at", buckets=8)
    rows = shape.requested(t.redeems).select("indice", "updateat")
    return merge.pending_row(rows, held, "indice", "contador")


# --- runs that overlapped, profiles, rates by date


@query(
    "runlog_overlaps",
    "destino id_1:i id_2:i desde:s hasta:s",
    """select x.paquete as destino, x.id as id_1, y.id as id_2, y.fecha_inicio as desde,
          least(x.fecha_fin, y.fecha_fin) as hasta
       from runlog x join runlog y on x.paquete = y.paquete and (x.fecha_inicio, x.id) < (y.fecha_inicio, y.id)
         and y.fecha_inicio < x.fecha_fin and y.fecha_inicio < y.fecha_fin and x.fecha_inicio < x.fecha_fin""",
)
def _(t):
    return runlog.overlaps(t.runlog, "paquete", text=True)


PROFILED = ("modoin", "agente", "clientid", "currency")
PROFILE_SPEC = "total_registros:i " + " ".join(f"null_{c}:i cerca_{c}:i" for c in PROFILED)


def _profile_sql(by: str) -> str:
    cols = ", ".join(f"count(*) filter ({c} is null) as null_{c}, 1 as cerca_{c}" for c in PROFILED)
    return f"select {by}, count(*) as total_registros, {cols} from history_target group by 1"


def _close(t, found, by):
    """Exact counts beside the estimates: within five standard errors or not."""
    exact = t.history_target.withColumn(*by).groupBy(by[0]).agg(*[F.count_distinct(c).alias(f"exact_{c}") for c in PROFILED])
    both = found.join(exact, by[0])
    for c in PROFILED:
        near = F.abs(F.col(f"distinct_{c}") - F.col(f"exact_{c}")) <= 1 + 0.08 * F.col(f"exact_{c}")
        both = both.withColumn(f"cerca_{c}", near.cast("int"))
    return both


def _profiles(t):
    month = (F.col("pay_year") * 100 + F.col("pay_month")).alias("mes")
    return profiles.profile(t.history_target, [month], PROFILED)


@query("null_profile_months", f"mes:i {PROFILE_SPEC}", _profile_sql("pay_year * 100 + pay_month as mes"))
def _(t):
    return _close(t, profiles.read(_profiles(t), PROFILED), ("mes", F.col("pay_year") * 100 + F.col("pay_month")))


@query("null_profile_years", f"anio:i {PROFILE_SPEC}", _profile_sql("pay_year as anio"))
def _(t):
    years = profiles.merged(_profiles(t), [F.floor(F.col("mes") / 100).cast("int").alias("anio")], PROFILED)
    return _close(t, profiles.read(years, PROFILED), ("anio", F.col("pay_year")))


@query(
    "rate_on_date",
    "indice:i is_packed:i pay_date:s rate:d amount_usd:d",
    """select h.indice, h.is_packed, h.pay_date, r.rate,
          cast(case when h.currency = 'MXN' then round(cast(h.amount_bruta_usd as double) / cast(r.rate as double), 6)
               else cast(h.amount_bruta_usd as double) end as decimal(18,6)) as amount_usd
       from history_target h asof left join
         (select currency, desde, max(rate) as rate from dated_rates group by currency, desde) r
         on r.currency = h.currency and h.pay_date >= r.desde""",
)
def _(t):
    return coll.in_usd_on_date(t.history_target, t.dated_rates)
