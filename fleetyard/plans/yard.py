"""Yard entry/exit events and hour-meter telemetry.

Asset codes are keyed on ``upper(trim(code))`` and labels compared on
``lower(trim(label))``: the source database compares text case-insensitively,
so its partitions already merged case variants of the same code.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetyard.functions import not_blank
from fleetyard.operators.keyed import latest_by, latest_then
from fleetyard.plans.common import dbl

YARD = "relatorio_entrada_saida_uca"
# Event type labels as typed in the field application.
ENTRY = "entrada"
EXIT_LABELS = ("entrada", "saída", "saida")
SNAPSHOT_EVENTS = 50000


def _asset(c: str = "n_armac"):
    return F.upper(F.trim(F.col(c)))


def _yard_row(df: DataFrame) -> DataFrame:
    return df.select(
        _asset().alias("n_armac"), F.col("tipo_equipamento").alias("equipamento"),
        F.upper(F.trim("marca")).alias("marca"), F.upper(F.trim("modelo")).alias("modelo"),
        "cliente", "situacao", F.col("created_at_form").alias("data_entrada"),
        dbl("horimetro").alias("horimetro"), "filial")


def yard_current(src) -> DataFrame:
    """Assets whose latest event, over all branches, is an entry.

    Ranking happens before the entry filter: an asset whose last event is an
    exit is out of every yard, even if it entered somewhere earlier.
    """
    ev = src.table(YARD).filter(F.col("n_armac").isNotNull())
    latest = latest_then(
        ev, _asset(),
        [F.col("created_at_form").desc_nulls_last(), F.col("id").desc()],
        F.lower(F.trim("tipo_relatorio")) == ENTRY)
    return _yard_row(latest)


def yard_history(src) -> DataFrame:
    """All valid entry / exit events (one scan, no join)."""
    ev = src.table(YARD)
    ev = ev.filter(not_blank("n_armac") & F.col("created_at_form").isNotNull()
                   & F.lower(F.trim("tipo_relatorio")).isin(list(EXIT_LABELS)))
    return ev.select(
        _asset().alias("n_armac"), "tipo_relatorio", F.col("created_at_form").alias("ts"),
        "filial", "cliente", "situacao", dbl("horimetro").alias("horimetro"),
        F.col("tipo_equipamento").alias("descricao"))


def _newest_events(src, n_events: int) -> DataFrame:
    """The newest ``n_events`` events (the row id decides between equal times).

    Events per day are counted first (a few numbers a year); the day that
    reaches ``n_events`` bounds the scan, so tasks send on the events of the
    last days and not ``n_events`` of each partition.
    """
    ev = src.table(YARD).filter(F.col("n_armac").isNotNull()
                                & F.col("created_at_form").isNotNull())
    days = (ev.groupBy(F.to_date("created_at_form").alias("d")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("d")).collect())
    total = 0
    for r in days:
        total += r["n"]
        if total >= n_events:
            ev = ev.filter(F.col("created_at_form") >= F.lit(r["d"]).cast(ev.schema["created_at_form"].dataType))
            break
    return ev.orderBy(F.col("created_at_form").desc(), F.col("id").desc()).limit(n_events)


def _is_current():
    """The asset's newest event, and its type starts with "entrada"."""
    newest = Window.partitionBy(_asset()).orderBy(F.col("created_at_form").desc(), F.col("id").desc())
    return ((F.row_number().over(newest) == 1) & (F.trim(_asset()) != "")
            & F.lower(F.trim(F.coalesce("tipo_relatorio", F.lit("")))).startswith(ENTRY))


def yard_snapshot(src, n_events: int = SNAPSHOT_EVENTS) -> tuple[DataFrame, DataFrame]:
    """Legacy yard payload: the newest ``n_events`` events and, among them,
    the current row per asset kept when its type starts with "entrada".

    The event cap is the feature of this payload.
    """
    top = _newest_events(src, n_events)
    return _yard_row(top.withColumn("__now", _is_current()).filter("__now")), _event_row(top)


def _event_row(df: DataFrame) -> DataFrame:
    return df.select(_asset().alias("n_armac"), "tipo_relatorio", F.col("created_at_form").alias("ts"),
                     "filial", "cliente", dbl("horimetro").alias("horimetro"))


def yard_snapshot_rows(src) -> DataFrame:
    return yard_snapshot(src)[0]


def hourmeter_latest(src) -> DataFrame:
    """Last valid reading per asset (newest reading, then newest update)."""
    h = src.table("hourmeter").filter(
        F.col("armac_code").isNotNull() & (F.col("armac_code") != ""))
    last = latest_by(h, _asset("armac_code"),
                     [F.col("event_datetime").desc_nulls_last(),
                      F.col("updated_at").desc_nulls_last(), F.col("id").desc()])
    return last.select(
        _asset("armac_code").alias("n_armac"), F.col("event_datetime").alias("data_comunicacao"),
        dbl(F.coalesce("equipment_hourmeter", "panel_hourmeter")).alias("horimetro_sistema"),
        F.col("contract").alias("contrato"), F.col("updated_at").alias("atualizado_em"))


def hourmeter_invalid_latest(src) -> DataFrame:
    """Last rejected reading per asset with its error code."""
    h = src.table("hourmeter_invalid").filter(
        F.col("armac_code").isNotNull() & (F.col("armac_code") != ""))
    last = latest_by(h, _asset("armac_code"),
                     [F.col("event_datetime").desc_nulls_last(), F.col("id").desc()])
    return last.select(
        _asset("armac_code").alias("n_armac"),
        F.col("event_datetime").alias("comunicacao_rastreador_em"),
        dbl("hourmeter").alias("horimetro_rastreador"), F.col("source").alias("fonte_rastreador"),
        F.col("error_code").alias("motivo_rastreador"))


def yard_payload(src, started_at: str, n_events: int = SNAPSHOT_EVENTS) -> DataFrame:
    """Legacy yard document ``{started_at, rows, eventos}`` (one row of JSON).

    Both arrays are bounded: ``eventos`` by the event cap, ``rows`` by the
    assets among those events, so gathering them in one document is safe.
    One pass over the newest events; newest first in both arrays, the row id
    deciding between equal times. Values in the legacy yard style (decimals
    as text, dates as midnight UTC).
    """
    from fleetyard.sources.delivery import encode
    top = _newest_events(src, n_events).withColumn("__now", _is_current())

    keyed = top.withColumn("__at", F.struct("created_at_form", "id"))
    parts = keyed.select(
        "__at", "__now",
        F.struct(_asset().alias("n_armac"), "tipo_relatorio", F.col("created_at_form").alias("ts"), "filial", "cliente",
                 F.col("horimetro").alias("horimetro")).alias("e"),
        F.struct(_asset().alias("n_armac"), F.col("tipo_equipamento").alias("equipamento"), F.upper(F.trim("marca")).alias("marca"),
                 F.upper(F.trim("modelo")).alias("modelo"), "cliente", "situacao", F.col("created_at_form").alias("data_entrada"),
                 F.col("horimetro").alias("horimetro"), "filial").alias("r"))

    def rendered(name: str):
        fields = parts.schema[name].dataType.fields
        return F.struct(*[encode(F.col(f"{name}.{f.name}"), f.dataType, "legacy_yard").alias(f.name) for f in fields])

    def newest(value, when=None):
        item = F.struct(F.col("__at"), value.alias("v"))
        return F.transform(F.sort_array(F.collect_list(F.when(when, item) if when is not None else item), asc=False),
                           lambda x: x["v"])

    doc = parts.agg(newest(rendered("e")).alias("eventos"), newest(rendered("r"), F.col("__now")).alias("rows"))
    return doc.select(F.to_json(F.struct(F.lit(started_at).alias("started_at"), "rows", "eventos"),
                                {"ignoreNullFields": "false"}).alias("json"))
