"""DuckDB CTEs that derive the ERP-shaped tables from the driver test data.

Same rules as ``fleetyard.sources.testdata`` (see its docstring), written a
second time in SQL so the oracle does not share code with the Spark side.
``with_tables(names, body)`` prefixes a query with the CTEs it needs.
"""
from __future__ import annotations

from fleetyard.sources import dictionaries as D


def z(x: str, w: int) -> str:
    return f"lpad(CAST({x} AS VARCHAR), {w}, '0')"


def shifted(ts: str, years: int = 28) -> str:
    return f"(CAST(year({ts}) + {years} AS VARCHAR) || strftime({ts}, '-%m-%d'))"


def _values(rows, cols) -> str:
    def lit(v):
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(cols)})"


REQ_KNTTP = ("CASE id % 9 WHEN 0 THEN 'K' WHEN 1 THEN 'A' WHEN 2 THEN 'F' WHEN 3 THEN 'P' "
             "WHEN 4 THEN 'Q' WHEN 5 THEN 'N' WHEN 6 THEN '' WHEN 7 THEN NULL ELSE 'Z' END")
PO_KEYS = f"CAST(4500000000 + l_orderkey AS VARCHAR) AS ebeln, {z('rspos * 10', 5)} AS ebelp"

TABLES: dict[str, tuple[tuple[str, ...], str]] = {}


def _t(name, deps, sql):
    TABLES[name] = (tuple(deps), sql)


_t("o", [], f"""
SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS od, o_orderpriority AS prio,
       {shifted('o_orderdate')} AS dt
FROM orders""")

_t("li", [], f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_returnflag, l_linestatus, l_shipdate, rspos, l_orderkey * 1000 + rspos AS id,
       {shifted('l_shipdate')} AS sd
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
             l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
             l_linestatus, l_shipdate) AS rspos
      FROM lineitem) numbered""")

_t("aufk", ["o"], f"""
SELECT {z('k', 12)} AS aufnr, 'OR' || {z('k', 12)} || '  ' AS objnr, dt AS erdat,
       CASE WHEN k % 4 <> 0 THEN dt END AS idat1,
       CASE WHEN k % 4 >= 2 THEN dt END AS idat2,
       CASE WHEN k % 4 = 3 THEN dt END AS idat3,
       CASE WHEN k % 50 = 0 THEN 'X' ELSE '' END AS loekz,
       'Ordem ' || prio AS ktext,
       'USR' || CAST(c % 40 AS VARCHAR) AS ernam,
       'PM0' || CAST(k % 3 AS VARCHAR) AS auart,
       CASE k % 3 WHEN 0 THEN {z('c', 10)} WHEN 1 THEN {z('c % 1000', 7)} END AS kostl,
       CASE WHEN k % 11 = 0 THEN '0000-00-00' WHEN k % 19 = 0 THEN '' ELSE dt END AS aedat,
       'USR' || CAST(k % 40 AS VARCHAR) AS aenam
FROM o""")

_t("afih", ["o"], f"""
SELECT {z('k', 12)} AS aufnr,
       CASE WHEN k % 61 = 0 THEN NULL WHEN k % 67 = 0 THEN '   '
            WHEN k % 71 = 0 THEN '000000000000000000' ELSE {z('c', 18)} END AS equnr,
       CASE substr(prio, 1, 1) WHEN '1' THEN 'PRP' WHEN '2' THEN 'OFI' WHEN '3' THEN 'X01'
            WHEN '4' THEN 'X02' ELSE 'INS' END AS ilart,
       CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN '999'
            ELSE CAST(100 + k % 25 AS VARCHAR) END AS gewrk,
       substr(prio, 1, 1) AS priok,
       'G' || CAST(k % 4 AS VARCHAR) AS ingpr,
       CASE WHEN k % 2 = 0 THEN {z('k', 12)} END AS qmnum,
       CASE WHEN k % 5 = 0 THEN {z('k % 100', 12)} END AS warpl,
       CASE WHEN k % 5 = 0 THEN CAST(k % 7 AS VARCHAR) END AS wapos,
       {z('c', 12)} AS iloan
FROM o""")

_t("afko", ["o"], f"""
SELECT {z('k', 12)} AS aufnr, dt AS gstrp, CASE WHEN k % 9 <> 0 THEN dt END AS gltrp,
       {z('k', 10)} AS aufpl
FROM o""")

_t("afvc", ["li"], f"""
SELECT {z('l_orderkey', 10)} AS aufpl, {z('rspos', 8)} AS aplzl, {z('rspos * 10', 4)} AS vornr,
       'Operacao ' || l_returnflag || l_linestatus AS ltxa1,
       CASE WHEN l_partkey % 13 = 0 THEN '900' ELSE CAST(100 + l_suppkey % 25 AS VARCHAR) END AS arbid,
       CASE WHEN id % 37 <> 0 THEN 'OV' || {z('l_orderkey', 12)} || {z('rspos', 4)} END AS objnr
FROM li""")

_t("afvv", ["li"], f"""
SELECT {z('l_orderkey', 10)} AS aufpl, {z('rspos', 8)} AS aplzl,
       CAST(l_quantity AS DECIMAL(18,3)) AS arbei
FROM li, range(CASE WHEN l_orderkey % 7 = 0 THEN 2 ELSE 1 END) WHERE l_returnflag <> 'A'""")

_t("crhd", [], """
SELECT CAST(100 + n_nationkey AS VARCHAR) AS objid,
       CASE n_nationkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN ' a' WHEN 2 THEN '' WHEN 3 THEN NULL
            ELSE 'V' END AS objty,
       CASE WHEN n_nationkey = 7 THEN '|MANU' WHEN n_nationkey % 6 = 0 THEN n_name
            ELSE n_name || '|MANU' END AS arbpl
FROM nation
UNION ALL SELECT '900', CASE r_regionkey WHEN 0 THEN 'A' ELSE '' END, 'OFICINA|MANU' FROM region WHERE r_regionkey < 2""")

_t("jsto", ["o"], f"""
SELECT 'OR' || {z('k', 12)} AS objnr,
       CASE WHEN k % 2 = 0 THEN 'ZPM00001' ELSE 'ZPM00002' END AS stsma
FROM o""")

_ORDER_OBJ = f"'OR' || {z('k', 12)} || CASE WHEN k % 2 = 1 THEN ' ' ELSE '' END"
_OP_OBJ = f"'OV' || {z('l_orderkey', 12)} || {z('rspos', 4)} || CASE WHEN id % 2 = 0 THEN ' ' ELSE '' END"
_t("jest", ["o", "li"], f"""
SELECT {_ORDER_OBJ} AS objnr, 'E0001' AS stat,
       CASE k % 5 WHEN 0 THEN 'X' WHEN 1 THEN NULL ELSE '' END AS inact FROM o
UNION ALL
SELECT {_ORDER_OBJ}, CASE WHEN k % 3 = 0 THEN 'E0002' ELSE 'E0003' END,
       CASE WHEN k % 7 = 0 THEN 'X' END FROM o
UNION ALL
SELECT {_ORDER_OBJ}, 'I0001', NULL FROM o
UNION ALL
SELECT 'IE' || {z('c_custkey', 18)}, CASE WHEN c_custkey % 23 = 0 THEN 'I0076' ELSE 'I0099' END,
       CASE WHEN c_custkey % 46 = 0 THEN 'X' END FROM customer
UNION ALL
SELECT {_OP_OBJ}, CASE WHEN id % 3 = 0 THEN 'I0009' ELSE 'I0002' END,
       CASE WHEN id % 10 = 0 THEN 'X' ELSE '' END FROM li
UNION ALL
SELECT {_OP_OBJ}, CASE WHEN id % 4 = 0 THEN 'I0045' ELSE 'I0010' END, '' FROM li""")

_t("equi", [], f"""
SELECT {z('c_custkey', 18)} AS equnr,
       CASE WHEN c_custkey % 29 <> 0 THEN 'IE' || {z('c_custkey', 18)} END AS objnr,
       CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '  '
            ELSE 'SN' || CAST(c_custkey AS VARCHAR) END AS sernr,
       CASE WHEN c_custkey % 3 = 0 THEN 'MF' || CAST(c_custkey AS VARCHAR) END AS serge,
       ' ' || c_mktsegment AS herst,
       'Modelo ' || CAST(c_custkey % 7 AS VARCHAR) AS typbz,
       CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'EQ' || CAST(c_custkey % 3 AS VARCHAR) END AS eqart,
       CAST((c_custkey % 4) * 10 AS VARCHAR) || 'T' AS groes,
       CAST(2000 + c_custkey % 25 AS VARCHAR) AS baujj
FROM customer""")

_t("eqkt", [], f"""
SELECT {z('c_custkey', 18)} AS equnr,
       CASE WHEN c_custkey % 4 = 0 THEN 'pt' WHEN c_custkey % 9 = 0 THEN 'E' ELSE 'P' END AS spras,
       'Equipamento ' || c_name AS eqktx FROM customer
UNION ALL
SELECT {z('c_custkey', 18)}, 'E', 'Equipment ' || c_name FROM customer
UNION ALL
SELECT {z('c_custkey', 18)}, CASE WHEN c_custkey % 6 = 0 THEN 'P' ELSE 'X' END,
       'Maquina ' || c_name FROM customer""")

_t("equz", [], f"""
SELECT {z('c_custkey', 18)} AS equnr, CASE WHEN c_custkey % 10 <> 0 THEN {z('c_custkey', 12)} END AS iloan,
       '9999-12-31' AS datbi FROM customer
UNION ALL
SELECT {z('c_custkey', 18)}, 'OLD' || {z('c_custkey', 9)}, '2023-06-30' FROM customer""")

_t("iloa", [], f"""
SELECT {z('c_custkey', 12)} AS iloan,
       CASE WHEN c_custkey % 8 = 0 THEN ' '
            ELSE 'BR-' || CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR) END AS tplnr,
       'W' || CAST(c_nationkey % 4 AS VARCHAR) AS swerk,
       {z('c_custkey', 10)} AS kostl
FROM customer""")

_t("eban", ["li"], f"""
SELECT {z('l_orderkey', 10)} AS banfn, {z('rspos', 5)} AS bnfpo,
       CASE WHEN id % 13 = 0 THEN '' WHEN id % 17 = 0 THEN NULL
            WHEN id % 19 = 0 THEN '000000000000000000' ELSE {z('l_partkey', 18)} END AS matnr,
       'Item ' || CAST(l_partkey AS VARCHAR) AS txz01,
       CAST(l_quantity AS DECIMAL(18,3)) AS menge,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS preis,
       CAST(200 + l_suppkey % 5 AS VARCHAR) AS ekgrp,
       'USR' || CAST(l_suppkey % 40 AS VARCHAR) AS ernam,
       sd AS badat,
       {REQ_KNTTP} AS knttp,
       CASE WHEN id % 23 = 0 THEN 'X' END AS loekz,
       'C00' || CAST(l_suppkey % 9 AS VARCHAR) AS werks
FROM li""")

_t("ebkn", ["li"], f"""
SELECT {z('l_orderkey', 10)} AS banfn, {z('rspos', 5)} AS bnfpo, {z('l_orderkey', 12)} AS aufnr,
       {z('l_suppkey', 10)} AS kostl FROM li
UNION ALL
SELECT {z('l_orderkey', 10)}, {z('rspos', 5)}, CASE WHEN id % 6 = 0 THEN {z('l_orderkey + 1', 12)} END,
       {z('l_suppkey + 1', 10)} FROM li""")

_t("po_li", ["li"], "SELECT * FROM li WHERE l_returnflag <> 'R'")

_t("ekpo", ["po_li"], f"""
SELECT {PO_KEYS}, {z('l_orderkey', 10)} AS banfn, {z('rspos', 5)} AS bnfpo,
       CAST(l_quantity AS DECIMAL(18,3)) AS menge,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS netpr,
       CASE WHEN id % 10 <> 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS netwr,
       CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE {REQ_KNTTP} END AS knttp,
       CASE WHEN id % 29 = 0 THEN 'L' ELSE '' END AS loekz
FROM po_li""")

_t("ekko", ["o"], f"""
SELECT CAST(4500000000 + k AS VARCHAR) AS ebeln,
       CASE WHEN k % 7 = 0 THEN ' ' ELSE CAST(200 + k % 5 AS VARCHAR) END AS ekgrp,
       'USR' || CAST(k % 40 AS VARCHAR) AS ernam,
       {z('c % 1000', 10)} AS lifnr, dt AS bedat,
       CASE WHEN k % 6 = 0 THEN 'X' ELSE '' END AS frgrl
FROM o""")

_t("ekkn", ["po_li"], f"""
SELECT {PO_KEYS}, {z('l_suppkey', 10)} AS kostl FROM po_li
UNION ALL
SELECT {PO_KEYS}, CASE WHEN id % 5 <> 0 THEN {z('l_suppkey + 7', 10)} END FROM po_li""")

_t("ekbe", ["po_li"], f"""
SELECT {PO_KEYS}, '1' AS vgabe,
       CASE id % 3 WHEN 0 THEN CAST(l_quantity AS DECIMAL(18,3))
                   WHEN 1 THEN CAST(l_quantity / 2 AS DECIMAL(18,3))
                   ELSE CAST(0 AS DECIMAL(18,3)) END AS menge,
       sd AS budat FROM po_li
UNION ALL
SELECT {PO_KEYS}, CASE WHEN l_orderkey % 2 = 0 THEN '2' ELSE '9' END,
       CAST(l_quantity AS DECIMAL(18,3)), sd FROM po_li""")

_t("eket", ["po_li"], f"""
SELECT {PO_KEYS}, sd AS eindt FROM po_li
UNION ALL
SELECT {PO_KEYS}, {shifted('l_shipdate', 29)} FROM po_li""")

_t("lfa1", [], f"SELECT {z('s_suppkey', 10)} AS lifnr, s_name AS name1 FROM supplier")

_t("resb", ["li"], f"""
SELECT {z('l_orderkey', 10)} AS rsnum, {z('rspos', 4)} AS rspos,
       CASE WHEN id % 29 = 0 THEN NULL WHEN id % 31 = 0 THEN '  ' ELSE {z('l_partkey', 18)} END AS matnr,
       CAST(l_quantity AS DECIMAL(18,3)) AS bdmng,
       CASE WHEN id % 3 <> 0 THEN CAST(l_quantity / 2 AS DECIMAL(18,3)) END AS enmng,
       'C00' || CAST(l_suppkey % 9 AS VARCHAR) AS werks,
       CASE id % 7 WHEN 0 THEN 'D005' WHEN 1 THEN 'D090' WHEN 2 THEN 'D007' WHEN 3 THEN 'D002'
                   WHEN 4 THEN 'D123' WHEN 5 THEN 'D071' ELSE 'D555' END AS lgort,
       CASE id % 5 WHEN 0 THEN '311' WHEN 1 THEN '201' ELSE '261' END AS bwart,
       CASE id % 6 WHEN 0 THEN NULL WHEN 1 THEN '{D.NON_STOCK_TEXT}' ELSE 'Texto ' || l_returnflag END AS sgtxt,
       'REC' || CAST(l_suppkey % 10 AS VARCHAR) AS wempf,
       'Doca ' || CAST(l_linenumber AS VARCHAR) AS ablad,
       'OK' || {z('l_orderkey', 10)} || {z('rspos', 4)} AS objnr,
       CASE id % 8 WHEN 0 THEN 'X' WHEN 3 THEN NULL ELSE '' END AS xloek,
       CASE WHEN l_linestatus = 'F' THEN 'X' ELSE '' END AS kzear,
       CASE id % 4 WHEN 0 THEN 'L' WHEN 1 THEN 'N' WHEN 2 THEN '' ELSE NULL END AS postp,
       CASE WHEN id % 2 = 0 THEN 'X' ELSE '' END AS xwaok,
       CASE WHEN id % 31 <> 0 THEN sd END AS bdter,
       {z('l_orderkey', 12)} AS aufnr,
       {z('l_orderkey', 10)} AS banfn, {z('rspos', 5)} AS bnfpo
FROM li""")

_t("rkpf", ["o"], f"""
SELECT {z('k', 10)} AS rsnum,
       CASE WHEN k % 43 = 0 THEN NULL WHEN k % 47 = 0 THEN ' ' ELSE {z('k', 12)} END AS aufnr,
       dt AS rsdat,
       CASE WHEN k % 2 = 0 THEN ' USR' ELSE 'USR' END || CAST(c % 40 AS VARCHAR) AS usnam,
       CASE WHEN k % 3 <> 0 THEN 'USR' || CAST((k + 7) % 40 AS VARCHAR) END AS lastchangedbyuser,
       CASE WHEN k % 5 = 0 THEN CAST(0 AS DECIMAL(21,7))
            ELSE CAST(CAST(replace(dt, '-', '') || '101500' AS BIGINT) AS DECIMAL(21,7)) END
         AS lastchangedatetime
FROM o""")

_t("rsadd", ["li"], f"""
SELECT {z('l_orderkey', 10)} AS rsnum, {z('rspos', 4)} AS rspos, sd AS creadat
FROM li WHERE l_returnflag <> 'N'
UNION ALL
SELECT {z('l_orderkey', 10)}, {z('rspos', 4)}, {shifted('l_shipdate', 29)}
FROM li WHERE l_returnflag = 'A'""")

_t("lips", ["li"], f"""
SELECT {z('l_orderkey', 10)} AS rsnum, {z('rspos', 4)} AS rspos,
       CAST(800000000000 + id AS VARCHAR) AS vbeln
FROM li WHERE l_returnflag <> 'R'
UNION ALL
SELECT {z('l_orderkey', 10)}, {z('rspos', 4)}, CAST(900000000000 + id AS VARCHAR)
FROM li WHERE l_returnflag = 'A'""")

_t("makt", [], f"""
SELECT {z('p_partkey', 18)} AS matnr, CASE WHEN p_partkey % 7 = 0 THEN 'E' ELSE 'P' END AS spras,
       p_name AS maktx FROM part
UNION ALL
SELECT {z('p_partkey', 18)}, CASE WHEN p_partkey % 5 = 0 THEN 'PT' ELSE 'E' END, 'pt ' || p_name
FROM part""")

_t("mara", [], f"""
SELECT CASE WHEN p_partkey % 2 = 0 THEN {z('p_partkey', 18)} ELSE {z('p_partkey', 12)} END AS matnr,
       unhex(md5(CAST(p_partkey AS VARCHAR))) AS scm_matid_guid16,
       'GRP' || CAST(p_partkey % 10 AS VARCHAR) AS matkl
FROM part""")

_SLOT = f"'A' || {z('p_partkey % 100', 3)}"
_GUID = "unhex(md5(CAST(p_partkey AS VARCHAR)))"
_t("scwm_aqua", [], f"""
SELECT {_GUID} AS matid, 'L1' AS charg, {_SLOT} || '-0' AS lgpla,
       CAST(p_size AS DECIMAL(18,3)) AS quan, 'OURO' AS lgnum FROM part
UNION ALL
SELECT {_GUID}, 'L1', CASE WHEN p_partkey % 5 = 0 THEN {_SLOT} || '-0' ELSE {_SLOT} || '-1' END,
       CASE WHEN p_partkey % 10 = 0 THEN CAST(0 AS DECIMAL(18,3)) ELSE CAST(p_size + 1 AS DECIMAL(18,3)) END,
       'OURO' FROM part
UNION ALL
SELECT {_GUID}, CASE WHEN p_partkey % 4 = 0 THEN ' ' ELSE 'L2' END, 'B' || {z('p_partkey % 100', 3)},
       CAST(p_size + 2 AS DECIMAL(18,3)), 'OURO' FROM part
UNION ALL
SELECT {_GUID}, NULL, CASE WHEN p_partkey % 6 <> 0 THEN 'C' || {z('p_partkey % 100', 3)} END,
       CAST(p_size + 3 AS DECIMAL(18,3)), CASE WHEN p_partkey % 3 = 0 THEN 'PRAT' ELSE 'OURO' END
FROM part""")

_KEY = f"{z('l_orderkey', 10)} || {z('rspos', 4)}"
_t("ztwf_log_wf", ["li"], f"""
SELECT CASE WHEN id % 2 = 0 THEN ' ' || {_KEY} ELSE {_KEY} END AS chave,
       CASE WHEN id % 3 = 0 THEN ' ' ELSE 'APROVADO' END AS acao, sd AS data, '08:00:00' AS hora
FROM li
UNION ALL
SELECT {_KEY}, 'REPROVADO', CASE WHEN id % 13 <> 0 THEN sd END,
       CASE WHEN id % 4 <> 0 THEN '17:30:00' END
FROM li""")

_t("usr21", [], f"""
SELECT 'USR' || CAST(s_suppkey AS VARCHAR) AS bname,
       CASE WHEN s_suppkey % 2 = 0 THEN {z('s_suppkey', 10)} || ' ' ELSE {z('s_suppkey', 10)} END AS persnumber
FROM supplier""")

_t("adrp", [], f"""
SELECT {z('s_suppkey', 10)} AS persnumber, s_name AS name_text FROM supplier
UNION ALL
SELECT {z('s_suppkey', 10)}, CASE WHEN s_suppkey % 3 <> 0 THEN 'Z ' || s_name END FROM supplier""")

_t("csks", [], f"""
SELECT {z('c_custkey', 10)} AS kostl, 'PC' || CAST(c_custkey % 50 AS VARCHAR) AS prctr,
       '9999-12-31' AS datbi FROM customer
UNION ALL
SELECT {z('c_custkey', 10)}, 'PCOLD', '2020-12-31' FROM customer""")

_t("cepct", [], """
SELECT 'PC' || CAST(n_nationkey AS VARCHAR) AS prctr, 'P' AS spras,
       'Centro de lucro ' || n_name AS ltext, '9999-12-31' AS datbi FROM nation
UNION ALL
SELECT 'PC' || CAST(n_nationkey + 25 AS VARCHAR), 'P', 'Centro de lucro ' || n_name || ' B',
       '9999-12-31' FROM nation
UNION ALL
SELECT 'PC' || CAST(n_nationkey AS VARCHAR), 'E', 'Profit center', '9999-12-31' FROM nation
UNION ALL
SELECT 'PC' || CAST(n_nationkey AS VARCHAR), 'P', 'Antigo', '2019-12-31' FROM nation""")

_t("anlh", [], f"""
SELECT {z('c_custkey', 7)} AS anln1, 'Imobilizado ' || c_name AS anlhtxt FROM customer""")

_t("t353i_t", [], _values(D.ACTIVITY_TEXTS, ["ilart", "spras", "ilatx"]))
_t("t356_t", [], _values(D.PRIORITY_TEXTS, ["priok", "artpr", "spras", "priokx"]))
_t("t003p", [], _values(D.ORDER_TYPE_TEXTS, ["auart", "spras", "txt"]))
_t("t024i", [], _values(D.PLANNER_GROUPS, ["ingrp", "iwerk", "innam"]))
_t("tj30t", [], _values(D.USER_STATUS_TEXTS, ["stsma", "estat", "spras", "txt04"]))
_t("tj02t", [], _values(D.SYSTEM_STATUS_TEXTS, ["istat", "spras", "txt04"]))
_t("t001l", [], _values(D.STORAGE_LOCATIONS, ["werks", "lgort"]))

_t("relatorio_entrada_saida_uca", [], f"""
SELECT event_id AS id,
       CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN ''
            WHEN user_id % 2 = 0 AND event_id % 2 = 0 THEN ' eq' || CAST(user_id AS VARCHAR)
            WHEN user_id % 2 = 0 THEN 'EQ' || CAST(user_id AS VARCHAR) || ' '
            ELSE 'EQ' || CAST(user_id AS VARCHAR) END AS n_armac,
       CASE event_type WHEN 'signup' THEN 'Entrada' WHEN 'error' THEN 'Saída'
            WHEN 'view' THEN 'Saida' WHEN 'click' THEN 'entrada' ELSE 'Outro' END AS tipo_relatorio,
       'Tipo ' || CAST(user_id % 6 AS VARCHAR) AS tipo_equipamento,
       ' marca' || CAST(user_id % 4 AS VARCHAR) || ' ' AS marca,
       'mod-' || CAST(user_id % 9 AS VARCHAR) AS modelo,
       'Cliente ' || CAST(user_id % 13 AS VARCHAR) AS cliente,
       event_type AS situacao,
       CASE WHEN event_id % 101 = 0 THEN NULL WHEN user_id % 5 = 0 THEN date_trunc('hour', ts)
            ELSE ts END AS created_at_form,
       CAST(value AS DECIMAL(18,3)) AS horimetro,
       'F' || {z('user_id % 25', 2)} AS filial
FROM events""")

_t("hourmeter", [], """
SELECT event_id AS id,
       CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN ''
            WHEN event_id % 2 = 0 THEN 'eq' || CAST(user_id AS VARCHAR)
            ELSE 'EQ' || CAST(user_id AS VARCHAR) END AS armac_code,
       CASE WHEN user_id % 3 = 0 THEN date_trunc('hour', ts) ELSE ts END AS event_datetime,
       CASE WHEN event_id % 3 <> 0 THEN CAST(value AS DECIMAL(18,3)) END AS equipment_hourmeter,
       CAST(CAST(value AS DECIMAL(18,3)) + 1000 AS DECIMAL(18,3)) AS panel_hourmeter,
       'CT' || CAST(user_id % 7 AS VARCHAR) AS contract,
       CASE WHEN event_id % 7 <> 0 THEN ts END AS updated_at
FROM events WHERE event_type <> 'error'""")

_t("hourmeter_invalid", [], """
SELECT event_id AS id,
       CASE WHEN event_id % 97 <> 0 THEN 'EQ' || CAST(user_id AS VARCHAR) END AS armac_code,
       CASE WHEN user_id % 4 = 0 THEN date_trunc('hour', ts) ELSE ts END AS event_datetime,
       CAST(value AS DECIMAL(18,3)) AS hourmeter,
       CASE event_id % 3 WHEN 0 THEN 'GPS' WHEN 1 THEN 'CAN' ELSE 'MANUAL' END AS source,
       'E' || CAST(event_id % 5 AS VARCHAR) AS error_code
FROM events WHERE event_type = 'error'""")

_t("evidencia_recebimentos", [], f"""
SELECT o_orderkey AS id, {z('o_custkey', 10)} AS pedido,
       CASE WHEN o_orderkey % 2 = 0 THEN '' WHEN o_orderkey % 3 = 0 THEN NULL
            ELSE '00' || CAST(o_orderkey AS VARCHAR) END AS requisicao_de_compra_os,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS requisicao_de_compra_id,
       CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate END AS data_recebimento
FROM orders""")

_t("requisicoes_de_compra", [], """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 6 <> 0 THEN '00' || CAST(4500000000 + o_orderkey AS VARCHAR) END
         AS numero_pedido_gerado
FROM orders""")

_t("bi_bs_fluxo_aprov", ["li"], """
SELECT CAST(4500000000 + l_orderkey AS VARCHAR) AS NumeroPedido,
       'APR' || CAST(l_suppkey % 3 AS VARCHAR) AS NomeAprovador,
       sd AS DataInicio,
       CASE WHEN l_linenumber % 2 = 0 THEN '08:00' ELSE '14:00' END AS HorarioInicioAprovacao,
       CASE WHEN id % 8 <> 0 THEN lpad(CAST(8 + rspos AS VARCHAR), 2, '0') || ':30' END
         AS HorarioFinalAprovacao,
       CASE id % 5 WHEN 0 THEN 'STARTED' WHEN 1 THEN 'READY' WHEN 2 THEN 'COMPLETED'
                   WHEN 3 THEN 'CANCELLED' ELSE 'UNKNOWN' END AS StatusFluxoAprovacao,
       CASE WHEN id % 8 <> 0 THEN sd END AS DataFinal
FROM li""")

_t("swwwihead", ["li"], """
SELECT id AS wi_id, CASE WHEN l_linestatus = 'F' THEN 'W' ELSE 'B' END AS wi_type,
       sd AS wi_cd, CASE WHEN l_linenumber % 2 = 0 THEN '08:00' ELSE '14:00' END AS wi_ct,
       CASE WHEN id % 8 <> 0 THEN sd END AS wi_aed,
       CASE id % 5 WHEN 0 THEN 'STARTED' WHEN 1 THEN 'READY' WHEN 2 THEN 'COMPLETED'
                   WHEN 3 THEN 'CANCELLED' ELSE 'ERROR' END AS wi_stat,
       'USR' || CAST(l_suppkey % 60 AS VARCHAR) AS wi_aagent
FROM li""")

_t("sww_wi2obj", ["li"], """
SELECT id AS wi_id, 'BO' AS catid,
       CASE WHEN l_returnflag = 'N' THEN 'BUS2105' ELSE 'BUS2012' END AS typeid,
       '00' || CAST(4500000000 + l_orderkey AS VARCHAR) AS instid
FROM li""")


def _collect(names, seen, out):
    for n in names:
        if n in seen:
            continue
        deps, _ = TABLES[n]
        _collect(deps, seen, out)
        seen.add(n)
        out.append(n)


def with_tables(names, body: str) -> str:
    """``WITH <adapter ctes>, <body ctes/select>``. ``body`` either starts with
    more CTE definitions (``name AS (...) ... SELECT``) or is a plain SELECT."""
    order: list[str] = []
    _collect(list(names), set(), order)
    ctes = ",\n".join(f"{n} AS ({TABLES[n][1].strip()})" for n in order)
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {ctes}\n{body}"
    return f"WITH {ctes},\n{body}"
