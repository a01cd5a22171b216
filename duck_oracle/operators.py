"""Oracle SQL for the operator-level queries and data-quality checks."""
from __future__ import annotations

from duck_oracle.adapters import with_tables
from duck_oracle.blocks import (ACCOUNT_NAMES, PAID, STORES, bare, filled, flag, has, lowest, named, one_of, ranked)
from duck_oracle.reports import (BRANCH, NOT_STOCKED, OPEN_RESERVATION, PHASE, RESERVATION_KEY, YARD, activity, back, centre,
                                 destination, kind, kind_by_code, po_payment, po_payment_by_item, process_status, received, system_status,
                                 text, user_status, work_orders_latest, yard_history, yard_snapshot_events,
                                 yard_snapshot_rows)
from fleetyard.plans.params import CUT_WINDOW, FULL_WINDOW, PAYMENT_GROUPS


def latest_by_key() -> str:
    return with_tables(["aufk", "afih"], f"""
best AS (SELECT nullif({bare("equnr")}, '') AS ativo, max((erdat, aufnr)) AS last_order
  FROM aufk JOIN afih USING (aufnr) WHERE {has("equnr")} GROUP BY 1)
SELECT ativo, {bare("last_order[2]")} AS ordem, last_order[1] AS data_criacao FROM best""")


def latest_then_filter() -> str:
    return with_tables(["ztwf_log_wf"], f"""
last AS ({ranked("SELECT trim(chave) AS chave_reserva, acao, data, hora FROM ztwf_log_wf", "chave_reserva",
                 "data DESC NULLS LAST, hora DESC NULLS LAST, acao")})
SELECT chave_reserva, {filled("data")} AS data, {filled("hora")} AS hora FROM last WHERE trim(acao) = 'REPROVADO'""")


def text_lookup() -> str:
    return with_tables(["makt"], f"""
named AS ({lowest(f"SELECT {bare('matnr')} AS material, maktx, spras FROM makt WHERE lower(spras) IN ('p', 'pt')",
                  "t.material", "spras, maktx")})
SELECT material, maktx FROM named""")


def work_centre_branch() -> str:
    return with_tables(["afih", "crhd"], f"""
SELECT aufnr, gewrk, {centre("afih.gewrk", "arbpl")} AS arbpl, {centre("afih.gewrk", BRANCH)} AS filial FROM afih""")


def norm_ids() -> str:
    return with_tables(["afih"], f"""
SELECT aufnr, {bare("equnr")} AS sem_zeros, {filled("equnr")} AS sem_branco, nullif({bare("equnr")}, '') AS ativo FROM afih""")


def maintenance_type() -> str:
    return with_tables(["afih", "t353i_t"], f"""
named AS (SELECT aufnr, ilart, {activity("afih.ilart")} AS tipo_atividade FROM afih)
SELECT *, ifnull({kind("named.ilart", "ifnull(named.tipo_atividade, '')")}, 'Outro') AS tipo_manutencao,
  {kind_by_code("named.ilart")} AS tipo_por_codigo FROM named""")


def order_phase() -> str:
    return with_tables(["aufk"], f"SELECT aufnr, {PHASE} AS fase_os FROM aufk")


def status_rollup() -> str:
    return with_tables(["aufk", "jsto", "jest", "tj30t"], f"""
listed AS (SELECT aufnr, {user_status("aufk.objnr", "tj30t.txt04")} AS status_usuario,
  {user_status("aufk.objnr", "jest.stat")} AS cod_status_usuario FROM aufk)
SELECT * FROM listed WHERE cod_status_usuario IS NOT NULL""")


def operation_statuses() -> str:
    return with_tables(["afvc", "afvv", "jest", "tj02t"], f"""
SELECT aufpl, aplzl, vornr, arbei::DOUBLE AS arbei, {system_status("afvc.objnr")} AS status_operacao
FROM afvc LEFT JOIN afvv USING (aufpl, aplzl)""")


def semi_restrict() -> str:
    return with_tables(["aufk", "resb"], """
SELECT rsnum, rspos, aufnr FROM resb SEMI JOIN (SELECT aufnr FROM aufk WHERE erdat >= '2024-01-01') recent USING (aufnr)""")


def plant_scope() -> str:
    return with_tables(["eban", "t001l"], f"""
SELECT banfn, bnfpo, werks FROM eban SEMI JOIN (SELECT werks FROM t001l WHERE lgort IN {one_of(STORES)}) owner USING (werks)""")


def active_equipment() -> str:
    return with_tables(["equi", "jest"], """
SELECT equnr, objnr FROM equi
ANTI JOIN (SELECT objnr FROM jest WHERE stat = 'I0076' AND inact IS DISTINCT FROM 'X') gone USING (objnr)""")


def received_qty() -> str:
    return with_tables(["ekbe"], """
SELECT ebeln, ebelp, sum(menge)::DOUBLE AS qtd_recebida FROM ekbe WHERE vgabe = '1' GROUP BY ALL""")


def purchase_status() -> str:
    return with_tables(["eban", "ekpo", "ekko", "ekbe"], f"""
bought AS (SELECT eban.banfn, eban.bnfpo, eban.loekz, ekpo.ebeln AS po, ekpo.ebelp AS pos, ekpo.menge, ekpo.loekz AS gone, frgrl
  FROM eban LEFT JOIN ekpo ON (ekpo.banfn, ekpo.bnfpo) = (eban.banfn, eban.bnfpo) LEFT JOIN ekko ON ekko.ebeln = ekpo.ebeln),
counted AS (SELECT *, {received()} AS got FROM bought)
SELECT banfn, bnfpo, po AS ebeln, pos AS ebelp,
  {process_status("got", "menge", "frgrl", "po", "gone", "loekz")} AS status_processo FROM counted""")


def account_assignment() -> str:
    return with_tables(["eban", "ekpo"], f"""
assigned AS (SELECT eban.banfn, eban.bnfpo, if(ekpo.knttp IS NULL, eban.knttp, ekpo.knttp) AS code
  FROM eban LEFT JOIN ekpo ON (ekpo.banfn, ekpo.bnfpo) = (eban.banfn, eban.bnfpo))
SELECT banfn, bnfpo, {filled("code")} AS knttp, {destination("code")} AS destinacao,
  {named("trim(ifnull(code, ''))", ACCOUNT_NAMES, "'Outro'")} AS tipo_consumo FROM assigned""")


def invoice_flag() -> str:
    return with_tables(["ekko", "ekbe"], f"""
posted AS (SELECT ebeln, (SELECT max((true, budat)) FROM ekbe WHERE ekbe.ebeln = ekko.ebeln AND vgabe = '2') AS invoice FROM ekko)
SELECT ebeln, {flag("invoice IS NOT NULL", PAID)} AS status_pagamento,
  (SELECT max(budat) FROM ekbe WHERE ekbe.ebeln = posted.ebeln AND vgabe = '2') AS data_pagamento FROM posted""")


def parts_consumption() -> str:
    return with_tables(["aufk", "afih", "resb"], f"""
used AS (SELECT afih.equnr, resb.matnr, count(DISTINCT aufnr) AS qtd_ocorrencias, sum(bdmng)::DOUBLE AS qtd_total,
    max((erdat, aufnr)) AS last_order
  FROM resb JOIN aufk USING (aufnr) JOIN afih USING (aufnr)
  WHERE erdat BETWEEN {back(FULL_WINDOW)} AND {back(0)} AND {has("afih.equnr")} AND {has("resb.matnr")} GROUP BY 1, 2)
SELECT * EXCLUDE (last_order), last_order[1] AS ultima_data, last_order[2] AS ultima_ordem FROM used""")


def window_filter() -> str:
    """A window that ends before the newest and begins after the oldest date."""
    return with_tables(["eban"], f"""
SELECT banfn, bnfpo, badat FROM eban WHERE badat BETWEEN {back(CUT_WINDOW[0])} AND {back(CUT_WINDOW[1])}""")


def null_safe_filters() -> str:
    return with_tables(["resb"], f"""
SELECT rsnum, rspos, {RESERVATION_KEY} AS chave_reserva FROM resb WHERE {OPEN_RESERVATION}""")


def delivery_batches() -> str:
    return f"""WITH pay AS ({po_payment()}),
placed AS (SELECT pedido, row_number() OVER (ORDER BY pedido) - 1 AS place, count(*) OVER () AS total_rows FROM pay)
SELECT place // 2000 + 1 AS batch, any_value((total_rows + 1999) // 2000) AS total_batches, count(*) AS row_count,
  any_value(total_rows) AS total_rows, min(pedido) AS first_key, max(pedido) AS last_key
FROM placed GROUP BY 1"""


def dq_code_profile() -> str:
    return with_tables(["resb"], "SELECT postp AS valor, len(postp) AS tamanho, count(*) AS qtd FROM resb GROUP BY ALL")


def dq_duplicate_keys() -> str:
    return with_tables(["rsadd"], """
SELECT DISTINCT rsnum, rspos, qtd FROM (SELECT *, count(*) OVER (PARTITION BY rsnum, rspos) AS qtd FROM rsadd) c WHERE qtd > 1""")


def dq_language_profile() -> str:
    return with_tables(["eqkt", "makt"], """
SELECT tabela, spras, count(*) AS qtd
FROM (SELECT 'eqkt' AS tabela, spras FROM eqkt UNION ALL SELECT 'makt', spras FROM makt) every GROUP BY ALL""")


def dq_null_impact() -> str:
    """What the NULL-safe comparisons keep and plain ones would lose."""
    return with_tables(["resb"], f"""
kept AS (SELECT (sgtxt IS NULL)::INT AS s, (xloek IS NULL)::INT AS x FROM resb
  WHERE lgort IN {one_of(STORES)} AND bwart IN ('261', '201') AND ifnull(postp, '') IN ('L', '')
    AND ifnull(sgtxt, '') != {text(NOT_STOCKED)} AND ifnull(xloek, '') != 'X')
SELECT sum(s)::BIGINT AS sgtxt_nulo, sum(x)::BIGINT AS xloek_nulo, sum(greatest(s, x))::BIGINT AS linhas_novas,
  count(*) AS total_apos_correcao FROM kept""")


def dq_row_counts() -> str:
    return f"""SELECT (SELECT count(*) FROM ({po_payment()}) n) AS linhas_nova,
  (SELECT count(*) FROM ({po_payment_by_item()}) o) AS linhas_antiga"""


def dq_diff() -> str:
    """Rows that one side has more often, as often as it has them more."""
    return f"""WITH both_sides AS (
  SELECT pedido, status_pagamento, 1 AS side FROM ({po_payment()}) n
  UNION ALL SELECT pedido, status_pagamento, -1 FROM ({po_payment_by_item()}) o),
net AS (SELECT pedido, status_pagamento, sum(side)::BIGINT AS more FROM both_sides GROUP BY ALL)
SELECT pedido, status_pagamento, if(more > 0, 'so_nova', 'so_antiga') AS lado
FROM (SELECT *, unnest(range(abs(more))) AS nth FROM net) each_row"""


def dq_orders_without_items() -> str:
    return with_tables(["ekko", "ekpo"], """
SELECT ebeln FROM ekko WHERE (SELECT count(*) FROM ekpo WHERE ekpo.ebeln = ekko.ebeln) = 0""")


def dq_branch_distribution() -> str:
    return f"SELECT filial, count(*) AS qtd FROM ({work_orders_latest()}) j GROUP BY filial"


def dq_fill_rate() -> str:
    return f"""SELECT count(*) AS linhas, count(status_usuario) AS preenchidas, count(status_usuario) / count(*) AS taxa
FROM ({work_orders_latest()}) j"""


# --- features that leave rows out ----------------------------------------------

def yard_newest_500() -> str:
    return yard_snapshot_events(500)


def yard_newest_500_current() -> str:
    return yard_snapshot_rows(500)


def po_payment_of_groups() -> str:
    return po_payment_by_item(PAYMENT_GROUPS)


def po_payment_with_items() -> str:
    return po_payment(require_items=True)


# --- what the application receives ---------------------------------------------

def _iso(ts: str) -> str:
    """ISO time in UTC, with microseconds where there are any."""
    return f"replace(strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') || '+00:00'"


def json_fields() -> str:
    return f"""SELECT * REPLACE ({_iso("ts")} AS ts, horimetro::DECIMAL(18, 3)::VARCHAR AS horimetro) FROM ({yard_history()}) h"""


def yard_payload_fields() -> str:
    newest = f"""SELECT *, row_number() OVER (ORDER BY created_at_form DESC, id DESC) AS nth FROM {YARD}
  WHERE n_armac IS NOT NULL AND created_at_form IS NOT NULL QUALIFY nth <= 500"""
    fields = f"{_iso('created_at_form')} AS at, filial, cliente, horimetro::VARCHAR AS horimetro"
    return with_tables([YARD], f"""
newest AS ({newest}),
last_of AS (SELECT upper(trim(n_armac)) AS asset, min(nth) AS nth FROM newest GROUP BY 1 HAVING trim(asset) != ''),
current_row AS (SELECT newest.* FROM newest JOIN last_of USING (nth) WHERE trim(tipo_relatorio) ILIKE 'entrada%')
SELECT 'evento' AS part, nth - 1 AS place, upper(trim(n_armac)) AS n_armac, tipo_relatorio AS what, {fields} FROM newest
UNION ALL
SELECT 'row', row_number() OVER (ORDER BY nth) - 1, upper(trim(n_armac)), situacao, {fields} FROM current_row""")


def work_orders_ordered() -> str:
    return f"""SELECT row_number() OVER (ORDER BY filial NULLS LAST, ativo NULLS LAST, tipo_manutencao) - 1 AS place,
  filial, ativo, tipo_manutencao, ordem FROM ({work_orders_latest()}) j"""


SQL = {f.__name__: f for f in (
    latest_by_key, latest_then_filter, text_lookup, work_centre_branch, norm_ids, maintenance_type, order_phase, status_rollup, operation_statuses,
    semi_restrict, plant_scope, active_equipment, received_qty, purchase_status, account_assignment, invoice_flag,
    parts_consumption, window_filter, null_safe_filters, delivery_batches, dq_code_profile, dq_duplicate_keys,
    dq_language_profile, dq_null_impact, dq_row_counts, dq_diff, dq_branch_distribution, dq_fill_rate, yard_newest_500,
    yard_newest_500_current, po_payment_of_groups, po_payment_with_items, json_fields, yard_payload_fields,
    work_orders_ordered, dq_orders_without_items)}
