"""ERP-shaped tables derived from the driver's TPC-H-like test data.

The reports read maintenance, purchasing, stock and yard tables. The test
data has none of them, so each one is derived here, with DataFrame code, from
``orders``, ``lineitem``, ``customer``, ``part``, ``supplier``, ``nation`` and
``events``. The rules inject on purpose what the real replica shows: blank and
NULL keys, padded identifiers, zero dates, several text languages, ties,
duplicate lookup rows. The same rules are written independently in DuckDB SQL
(``duck_oracle.adapters``) for the correctness oracle.

Conventions: ``k`` = order key, ``c`` = customer key, ``p`` = part key,
``s`` = supplier key; ``z(x, w)`` = left-pad to ``w`` digits with zeros;
``id`` = ``l_orderkey * 1000 + rspos`` identifies a line item; order dates are
moved 28 years forward (whole leap cycles, so every date stays valid) and
rendered as ISO text, as in the replica.

Every table grows linearly with the input tables; nothing is sampled.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetyard.sources import dictionaries as D

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events")

YEAR_SHIFT = 28
PO_BASE = 4500000000
DELIVERY_BASE = 800000000000
DELIVERY_BASE_2 = 900000000000


def z(x, w: int) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    return F.lpad(c.cast("string"), w, "0")


def shifted(ts, years: int = YEAR_SHIFT) -> Column:
    """Timestamp -> ISO text date moved forward by whole years."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.concat((F.year(c) + F.lit(years)).cast("string"), F.date_format(c, "-MM-dd"))


def cases(expr: Column, mapping: list[tuple[object, object]], default=None) -> Column:
    out = None
    for when, then in mapping:
        v = F.lit(then) if not isinstance(then, Column) else then
        out = F.when(expr == F.lit(when), v) if out is None else out.when(expr == F.lit(when), v)
    if default is None:
        return out
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def pick(n: Column, values: list[str | None]) -> Column:
    """The text number ``n`` (from 0) of ``values``: ``n`` is computed once, not for each
    value as in :func:`cases`. Stages that make many columns stay small enough to be compiled."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), n.cast("int"))


def dec3(x) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    return c.cast("decimal(18,3)")


def dec2(x) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    return c.cast("decimal(18,2)")


def hour_trunc(ts) -> Column:
    """Truncate a wall-clock timestamp to the hour (independent of the session zone)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, "yyyy-MM-dd HH:00:00").cast("timestamp_ntz")


class TestdataTables:
    """Table source over the driver test data: ``table(name)`` returns the
    derived ERP table (lazy DataFrame)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    # ------------------------------------------------------------------ raw
    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            builder = getattr(self, f"_t_{name}", None)
            if builder is None:
                if name in TEST_TABLES:
                    self._cache[name] = self.raw(name)
                else:
                    raise KeyError(f"unknown table {name!r}")
            else:
                self._cache[name] = builder()
        return self._cache[name]

    __getitem__ = table

    # -------------------------------------------------------------- bases
    @cached_property
    def _orders(self) -> DataFrame:
        o = self.raw("orders")
        return o.select(
            F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"),
            F.col("o_orderdate").alias("od"), F.col("o_orderpriority").alias("prio"),
            shifted("o_orderdate").alias("dt"))

    @cached_property
    def _lines(self) -> DataFrame:
        """Line items numbered 1..n inside their order (``rspos``); the pair
        (order, line number) is not unique in the data, so every column takes
        part in the numbering order.

        The numbering goes by a copy of the order key: filters that a report
        puts on the key stay above it, so that all tables made of line items
        share one shuffle of them."""
        li = self.raw("lineitem").withColumn("__order", F.col("l_orderkey"))
        w = Window.partitionBy("__order").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
        li = li.withColumn("rspos", F.row_number().over(w))
        return li.select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate", "rspos",
            (F.col("l_orderkey") * 1000 + F.col("rspos")).alias("id"),
            shifted("l_shipdate").alias("sd"))

    def _po_lines(self) -> DataFrame:
        """Line items that got a purchase order (all but returned-flag R)."""
        return self._lines.filter(F.col("l_returnflag") != "R")

    @staticmethod
    def _rows(li: DataFrame, key: list[Column], rows: Column) -> DataFrame:
        """Rows made of each line item: ``key`` and the fields of every struct in
        ``rows`` (none where it is NULL), in one pass over the line items."""
        return li.select(*key, F.inline(rows))

    # ------------------------------------------------------ maintenance orders
    def _t_aufk(self) -> DataFrame:
        o = self._orders
        k, c = F.col("k"), F.col("c")
        return o.select(
            z(k, 12).alias("aufnr"),
            F.concat(F.lit("OR"), z(k, 12), F.lit("  ")).alias("objnr"),
            F.col("dt").alias("erdat"),
            F.when(k % 4 != 0, F.col("dt")).alias("idat1"),
            F.when(k % 4 >= 2, F.col("dt")).alias("idat2"),
            F.when(k % 4 == 3, F.col("dt")).alias("idat3"),
            F.when(k % 50 == 0, F.lit("X")).otherwise(F.lit("")).alias("loekz"),
            F.concat(F.lit("Ordem "), F.col("prio")).alias("ktext"),
            F.concat(F.lit("USR"), (c % 40).cast("string")).alias("ernam"),
            F.concat(F.lit("PM0"), (k % 3).cast("string")).alias("auart"),
            cases(k % 3, [(0, z(c, 10)), (1, z(c % 1000, 7))]).alias("kostl"),
            F.when(k % 11 == 0, F.lit("0000-00-00")).when(k % 19 == 0, F.lit(""))
             .otherwise(F.col("dt")).alias("aedat"),
            F.concat(F.lit("USR"), (k % 40).cast("string")).alias("aenam"))

    def _t_afih(self) -> DataFrame:
        o = self._orders
        k, c = F.col("k"), F.col("c")
        return o.select(
            z(k, 12).alias("aufnr"),
            F.when(k % 61 == 0, F.lit(None).cast("string"))
             .when(k % 67 == 0, F.lit("   "))
             .when(k % 71 == 0, F.lit("0" * 18))
             .otherwise(z(c, 18)).alias("equnr"),
            cases(F.substring("prio", 1, 1),
                  [("1", "PRP"), ("2", "OFI"), ("3", "X01"), ("4", "X02")], "INS").alias("ilart"),
            F.when(k % 13 == 0, F.lit(None).cast("string")).when(k % 17 == 0, F.lit("999"))
             .otherwise((F.lit(100) + k % 25).cast("string")).alias("gewrk"),
            F.substring("prio", 1, 1).alias("priok"),
            F.concat(F.lit("G"), (k % 4).cast("string")).alias("ingpr"),
            F.when(k % 2 == 0, z(k, 12)).alias("qmnum"),
            F.when(k % 5 == 0, z(k % 100, 12)).alias("warpl"),
            F.when(k % 5 == 0, (k % 7).cast("string")).alias("wapos"),
            z(c, 12).alias("iloan"))

    def _t_afko(self) -> DataFrame:
        o = self._orders
        k = F.col("k")
        return o.select(z(k, 12).alias("aufnr"), F.col("dt").alias("gstrp"),
                        F.when(k % 9 != 0, F.col("dt")).alias("gltrp"), z(k, 10).alias("aufpl"))

    def _t_afvc(self) -> DataFrame:
        li = self._lines
        return li.select(
            z("l_orderkey", 10).alias("aufpl"), z("rspos", 8).alias("aplzl"),
            z(F.col("rspos") * 10, 4).alias("vornr"),
            F.concat(F.lit("Operacao "), F.col("l_returnflag"), F.col("l_linestatus")).alias("ltxa1"),
            F.when(F.col("l_partkey") % 13 == 0, "900")
             .otherwise((F.lit(100) + F.col("l_suppkey") % 25).cast("string")).alias("arbid"),
            F.when(F.col("id") % 37 != 0,
                   F.concat(F.lit("OV"), z("l_orderkey", 12), z("rspos", 4))).alias("objnr"))

    def _t_afvv(self) -> DataFrame:
        # every seventh order has its hours twice
        li = self._lines.filter(F.col("l_returnflag") != "A").withColumn(
            "copy", F.explode(F.sequence(F.lit(1), F.when(F.col("l_orderkey") % 7 == 0, 2).otherwise(1))))
        return li.select(z("l_orderkey", 10).alias("aufpl"), z("rspos", 8).alias("aplzl"),
                         dec3("l_quantity").alias("arbei"))

    def _t_crhd(self) -> DataFrame:
        n = self.raw("nation")
        nk = F.col("n_nationkey")
        centres = n.select(
            (F.lit(100) + nk).cast("string").alias("objid"),
            cases(nk % 5, [(0, "A"), (1, " a"), (2, ""), (3, F.lit(None).cast("string"))],
                  "V").alias("objty"),
            F.when(nk == 7, F.lit("|MANU")).when(nk % 6 == 0, F.col("n_name"))
             .otherwise(F.concat(F.col("n_name"), F.lit("|MANU"))).alias("arbpl"))
        # one centre of operations is listed under two object types
        twice = self.raw("region").filter("r_regionkey < 2").select(
            F.lit("900").alias("objid"), F.when(F.col("r_regionkey") == 0, "A").otherwise("").alias("objty"),
            F.lit("OFICINA|MANU").alias("arbpl"))
        return centres.unionByName(twice)

    def _t_jsto(self) -> DataFrame:
        o = self._orders
        k = F.col("k")
        return o.select(F.concat(F.lit("OR"), z(k, 12)).alias("objnr"),
                        F.when(k % 2 == 0, F.lit("ZPM00001")).otherwise(F.lit("ZPM00002"))
                        .alias("stsma"))

    def _t_jest(self) -> DataFrame:
        o = self._orders
        k = F.col("k")
        order_obj = F.concat(F.lit("OR"), z(k, 12),
                             F.when(k % 2 == 1, F.lit(" ")).otherwise(F.lit("")))
        r1 = o.select(order_obj.alias("objnr"), F.lit("E0001").alias("stat"),
                      cases(k % 5, [(0, "X"), (1, F.lit(None).cast("string"))], "").alias("inact"))
        r2 = o.select(order_obj.alias("objnr"),
                      F.when(k % 3 == 0, F.lit("E0002")).otherwise(F.lit("E0003")).alias("stat"),
                      F.when(k % 7 == 0, F.lit("X")).alias("inact"))
        r3 = o.select(order_obj.alias("objnr"), F.lit("I0001").alias("stat"),
                      F.lit(None).cast("string").alias("inact"))
        cu = self.raw("customer")
        c = F.col("c_custkey")
        r4 = cu.select(F.concat(F.lit("IE"), z(c, 18)).alias("objnr"),
                       F.when(c % 23 == 0, F.lit("I0076")).otherwise(F.lit("I0099")).alias("stat"),
                       F.when(c % 46 == 0, F.lit("X")).alias("inact"))
        li = self._lines
        i = F.col("id")
        op_obj = F.concat(F.lit("OV"), z("l_orderkey", 12), z("rspos", 4),
                          F.when(i % 2 == 0, F.lit(" ")).otherwise(F.lit("")))
        r5 = li.select(op_obj.alias("objnr"),
                       F.when(i % 3 == 0, F.lit("I0009")).otherwise(F.lit("I0002")).alias("stat"),
                       F.when(i % 10 == 0, F.lit("X")).otherwise(F.lit("")).alias("inact"))
        r6 = li.select(op_obj.alias("objnr"),
                       F.when(i % 4 == 0, F.lit("I0045")).otherwise(F.lit("I0010")).alias("stat"),
                       F.lit("").alias("inact"))
        return r1.unionByName(r2).unionByName(r3).unionByName(r4).unionByName(r5).unionByName(r6)

    # ------------------------------------------------------------ equipment
    def _t_equi(self) -> DataFrame:
        cu = self.raw("customer")
        c = F.col("c_custkey")
        return cu.select(
            z(c, 18).alias("equnr"),
            F.when(c % 29 != 0, F.concat(F.lit("IE"), z(c, 18))).alias("objnr"),
            cases(c % 4, [(0, F.lit(None).cast("string")), (1, "  ")],
                  F.concat(F.lit("SN"), c.cast("string"))).alias("sernr"),
            F.when(c % 3 == 0, F.concat(F.lit("MF"), c.cast("string"))).alias("serge"),
            F.concat(F.lit(" "), F.col("c_mktsegment")).alias("herst"),
            F.concat(F.lit("Modelo "), (c % 7).cast("string")).alias("typbz"),
            F.when(c % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("EQ"), (c % 3).cast("string")))
             .alias("eqart"),
            F.concat(((c % 4) * 10).cast("string"), F.lit("T")).alias("groes"),
            (F.lit(2000) + c % 25).cast("string").alias("baujj"))

    def _t_eqkt(self) -> DataFrame:
        cu = self.raw("customer")
        c = F.col("c_custkey")
        r1 = cu.select(z(c, 18).alias("equnr"),
                       F.when(c % 4 == 0, F.lit("pt")).when(c % 9 == 0, F.lit("E"))
                       .otherwise(F.lit("P")).alias("spras"),
                       F.concat(F.lit("Equipamento "), F.col("c_name")).alias("eqktx"))
        r2 = cu.select(z(c, 18).alias("equnr"), F.lit("E").alias("spras"),
                       F.concat(F.lit("Equipment "), F.col("c_name")).alias("eqktx"))
        r3 = cu.select(z(c, 18).alias("equnr"),
                       F.when(c % 6 == 0, F.lit("P")).otherwise(F.lit("X")).alias("spras"),
                       F.concat(F.lit("Maquina "), F.col("c_name")).alias("eqktx"))
        return r1.unionByName(r2).unionByName(r3)

    def _t_equz(self) -> DataFrame:
        cu = self.raw("customer")
        c = F.col("c_custkey")
        r1 = cu.select(z(c, 18).alias("equnr"), F.when(c % 10 != 0, z(c, 12)).alias("iloan"),
                       F.lit("9999-12-31").alias("datbi"))
        r2 = cu.select(z(c, 18).alias("equnr"), F.concat(F.lit("OLD"), z(c, 9)).alias("iloan"),
                       F.lit("2023-06-30").alias("datbi"))
        return r1.unionByName(r2)

    def _t_iloa(self) -> DataFrame:
        cu = self.raw("customer")
        c = F.col("c_custkey")
        return cu.select(
            z(c, 12).alias("iloan"),
            F.when(c % 8 == 0, F.lit(" ")).otherwise(
                F.concat(F.lit("BR-"), F.col("c_nationkey").cast("string"), F.lit("-"),
                         c.cast("string"))).alias("tplnr"),
            F.concat(F.lit("W"), (F.col("c_nationkey") % 4).cast("string")).alias("swerk"),
            z(c, 10).alias("kostl"))

    # ------------------------------------------------------------ purchasing
    @staticmethod
    def _req_knttp(i: Column) -> Column:
        return cases(i % 9, [(0, "K"), (1, "A"), (2, "F"), (3, "P"), (4, "Q"), (5, "N"), (6, ""),
                             (7, F.lit(None).cast("string"))], "Z")

    def _t_eban(self) -> DataFrame:
        li = self._lines
        i = F.col("id")
        return li.select(
            z("l_orderkey", 10).alias("banfn"), z("rspos", 5).alias("bnfpo"),
            F.when(i % 13 == 0, F.lit("")).when(i % 17 == 0, F.lit(None).cast("string"))
             .when(i % 19 == 0, F.lit("0" * 18)).otherwise(z("l_partkey", 18)).alias("matnr"),
            F.concat(F.lit("Item "), F.col("l_partkey").cast("string")).alias("txz01"),
            dec3("l_quantity").alias("menge"), dec2("l_extendedprice").alias("preis"),
            (F.lit(200) + F.col("l_suppkey") % 5).cast("string").alias("ekgrp"),
            F.concat(F.lit("USR"), (F.col("l_suppkey") % 40).cast("string")).alias("ernam"),
            F.col("sd").alias("badat"),
            self._req_knttp(i).alias("knttp"),
            F.when(i % 23 == 0, F.lit("X")).alias("loekz"),
            F.concat(F.lit("C00"), (F.col("l_suppkey") % 9).cast("string")).alias("werks"))

    def _t_ebkn(self) -> DataFrame:
        li = self._lines
        i = F.col("id")
        r1 = F.struct(z("l_orderkey", 12).alias("aufnr"), z("l_suppkey", 10).alias("kostl"))
        r2 = F.struct(F.when(i % 6 == 0, z(F.col("l_orderkey") + 1, 12)).alias("aufnr"),
                      z(F.col("l_suppkey") + 1, 10).alias("kostl"))
        return self._rows(li, [z("l_orderkey", 10).alias("banfn"), z("rspos", 5).alias("bnfpo")], F.array(r1, r2))

    def _t_ekpo(self) -> DataFrame:
        li = self._po_lines()
        i = F.col("id")
        return li.select(
            (F.lit(PO_BASE) + F.col("l_orderkey")).cast("string").alias("ebeln"),
            z(F.col("rspos") * 10, 5).alias("ebelp"),
            z("l_orderkey", 10).alias("banfn"), z("rspos", 5).alias("bnfpo"),
            dec3("l_quantity").alias("menge"), dec2("l_extendedprice").alias("netpr"),
            F.when(i % 10 != 0, dec2("l_extendedprice")).alias("netwr"),
            cases(i % 4, [(0, F.lit(None).cast("string")), (1, "")], self._req_knttp(i))
             .alias("knttp"),
            F.when(i % 29 == 0, F.lit("L")).otherwise(F.lit("")).alias("loekz"))

    def _t_ekko(self) -> DataFrame:
        o = self._orders
        k, c = F.col("k"), F.col("c")
        return o.select(
            (F.lit(PO_BASE) + k).cast("string").alias("ebeln"),
            F.when(k % 7 == 0, F.lit(" ")).otherwise((F.lit(200) + k % 5).cast("string"))
             .alias("ekgrp"),
            F.concat(F.lit("USR"), (k % 40).cast("string")).alias("ernam"),
            z(c % 1000, 10).alias("lifnr"), F.col("dt").alias("bedat"),
            F.when(k % 6 == 0, F.lit("X")).otherwise(F.lit("")).alias("frgrl"))

    def _po_keys(self, li: DataFrame) -> list[Column]:
        return [(F.lit(PO_BASE) + F.col("l_orderkey")).cast("string").alias("ebeln"),
                z(F.col("rspos") * 10, 5).alias("ebelp")]

    def _t_ekkn(self) -> DataFrame:
        li = self._po_lines()
        i = F.col("id")
        r1 = F.struct(z("l_suppkey", 10).alias("kostl"))
        r2 = F.struct(F.when(i % 5 != 0, z(F.col("l_suppkey") + 7, 10)).alias("kostl"))
        return self._rows(li, self._po_keys(li), F.array(r1, r2))

    def _t_ekbe(self) -> DataFrame:
        li = self._po_lines()
        i = F.col("id")
        r1 = li.select(*self._po_keys(li), F.lit("1").alias("vgabe"),
                       cases(i % 3, [(0, dec3("l_quantity")),
                                     (1, dec3(F.col("l_quantity") / 2))],
                             F.lit(0).cast("decimal(18,3)")).alias("menge"),
                       F.col("sd").alias("budat"))
        r2 = li.select(*self._po_keys(li),
                       F.when(F.col("l_orderkey") % 2 == 0, F.lit("2")).otherwise(F.lit("9"))
                       .alias("vgabe"),
                       dec3("l_quantity").alias("menge"), F.col("sd").alias("budat"))
        return r1.unionByName(r2)

    def _t_eket(self) -> DataFrame:
        li = self._po_lines()
        r1 = F.struct(F.col("sd").alias("eindt"))
        r2 = F.struct(shifted("l_shipdate", YEAR_SHIFT + 1).alias("eindt"))
        return self._rows(li, self._po_keys(li), F.array(r1, r2))

    def _t_lfa1(self) -> DataFrame:
        s = self.raw("supplier")
        return s.select(z("s_suppkey", 10).alias("lifnr"), F.col("s_name").alias("name1"))

    # ------------------------------------------------------ reservations / stock
    def _t_resb(self) -> DataFrame:
        li = self._lines
        i = F.col("id")
        return li.select(
            z("l_orderkey", 10).alias("rsnum"), z("rspos", 4).alias("rspos"),
            F.when(i % 29 == 0, F.lit(None).cast("string")).when(i % 31 == 0, F.lit("  "))
             .otherwise(z("l_partkey", 18)).alias("matnr"),
            dec3("l_quantity").alias("bdmng"),
            F.when(i % 3 != 0, dec3(F.col("l_quantity") / 2)).alias("enmng"),
            F.concat(F.lit("C00"), (F.col("l_suppkey") % 9).cast("string")).alias("werks"),
            pick(i % 7, ["D005", "D090", "D007", "D002", "D123", "D071", "D555"]).alias("lgort"),
            pick(i % 5, ["311", "201", "261", "261", "261"]).alias("bwart"),
            cases(i % 6, [(0, F.lit(None).cast("string")), (1, D.NON_STOCK_TEXT)],
                  F.concat(F.lit("Texto "), F.col("l_returnflag"))).alias("sgtxt"),
            F.concat(F.lit("REC"), (F.col("l_suppkey") % 10).cast("string")).alias("wempf"),
            F.concat(F.lit("Doca "), F.col("l_linenumber").cast("string")).alias("ablad"),
            F.concat(F.lit("OK"), z("l_orderkey", 10), z("rspos", 4)).alias("objnr"),
            pick(i % 8, ["X", "", "", None, "", "", "", ""]).alias("xloek"),
            F.when(F.col("l_linestatus") == "F", F.lit("X")).otherwise(F.lit("")).alias("kzear"),
            pick(i % 4, ["L", "N", "", None]).alias("postp"),
            F.when(i % 2 == 0, F.lit("X")).otherwise(F.lit("")).alias("xwaok"),
            F.when(i % 31 != 0, F.col("sd")).alias("bdter"),
            z("l_orderkey", 12).alias("aufnr"),
            z("l_orderkey", 10).alias("banfn"), z("rspos", 5).alias("bnfpo"))

    def _t_rkpf(self) -> DataFrame:
        o = self._orders
        k, c = F.col("k"), F.col("c")
        user = F.concat(F.lit("USR"), (c % 40).cast("string"))
        stamp = F.concat(F.regexp_replace(F.col("dt"), "-", ""), F.lit("101500")) \
            .cast("bigint").cast("decimal(21,7)")
        return o.select(
            z(k, 10).alias("rsnum"),
            F.when(k % 43 == 0, F.lit(None).cast("string")).when(k % 47 == 0, F.lit(" "))
             .otherwise(z(k, 12)).alias("aufnr"),
            F.col("dt").alias("rsdat"),
            F.when(k % 2 == 0, F.concat(F.lit(" "), user)).otherwise(user).alias("usnam"),
            F.when(k % 3 != 0, F.concat(F.lit("USR"), ((k + 7) % 40).cast("string")))
             .alias("lastchangedbyuser"),
            F.when(k % 5 == 0, F.lit(0).cast("decimal(21,7)")).otherwise(stamp)
             .alias("lastchangedatetime"))

    def _t_rsadd(self) -> DataFrame:
        li = self._lines
        r1 = F.struct(F.col("sd").alias("creadat"))
        r2 = F.struct(shifted("l_shipdate", YEAR_SHIFT + 1).alias("creadat"))
        flag = F.col("l_returnflag")
        return self._rows(li, [z("l_orderkey", 10).alias("rsnum"), z("rspos", 4).alias("rspos")],
                          F.when(flag == "A", F.array(r1, r2)).when(flag != "N", F.array(r1)))

    def _t_lips(self) -> DataFrame:
        li = self._lines
        r1 = F.struct((F.lit(DELIVERY_BASE) + F.col("id")).cast("string").alias("vbeln"))
        r2 = F.struct((F.lit(DELIVERY_BASE_2) + F.col("id")).cast("string").alias("vbeln"))
        flag = F.col("l_returnflag")
        return self._rows(li, [z("l_orderkey", 10).alias("rsnum"), z("rspos", 4).alias("rspos")],
                          F.when(flag == "A", F.array(r1, r2)).when(flag != "R", F.array(r1)))

    def _t_makt(self) -> DataFrame:
        pa = self.raw("part")
        p = F.col("p_partkey")
        r1 = pa.select(z(p, 18).alias("matnr"),
                       F.when(p % 7 == 0, F.lit("E")).otherwise(F.lit("P")).alias("spras"),
                       F.col("p_name").alias("maktx"))
        r2 = pa.select(z(p, 18).alias("matnr"),
                       F.when(p % 5 == 0, F.lit("PT")).otherwise(F.lit("E")).alias("spras"),
                       F.concat(F.lit("pt "), F.col("p_name")).alias("maktx"))
        return r1.unionByName(r2)

    def _t_mara(self) -> DataFrame:
        pa = self.raw("part")
        p = F.col("p_partkey")
        return pa.select(
            F.when(p % 2 == 0, z(p, 18)).otherwise(z(p, 12)).alias("matnr"),
            F.unhex(F.md5(p.cast("string"))).alias("scm_matid_guid16"),
            F.concat(F.lit("GRP"), (p % 10).cast("string")).alias("matkl"))

    def _t_scwm_aqua(self) -> DataFrame:
        pa = self.raw("part")
        p = F.col("p_partkey")
        guid = F.unhex(F.md5(p.cast("string"))).alias("matid")
        slot = F.concat(F.lit("A"), z(p % 100, 3))
        size = F.col("p_size")
        r0 = pa.select(guid, F.lit("L1").alias("charg"), F.concat(slot, F.lit("-0")).alias("lgpla"),
                       dec3(size).alias("quan"), F.lit("OURO").alias("lgnum"))
        r1 = pa.select(guid, F.lit("L1").alias("charg"),
                       F.when(p % 5 == 0, F.concat(slot, F.lit("-0")))
                       .otherwise(F.concat(slot, F.lit("-1"))).alias("lgpla"),
                       F.when(p % 10 == 0, F.lit(0).cast("decimal(18,3)"))
                       .otherwise(dec3(size + 1)).alias("quan"),
                       F.lit("OURO").alias("lgnum"))
        r2 = pa.select(guid, F.when(p % 4 == 0, F.lit(" ")).otherwise(F.lit("L2")).alias("charg"),
                       F.concat(F.lit("B"), z(p % 100, 3)).alias("lgpla"),
                       dec3(size + 2).alias("quan"), F.lit("OURO").alias("lgnum"))
        r3 = pa.select(guid, F.lit(None).cast("string").alias("charg"),
                       F.when(p % 6 != 0, F.concat(F.lit("C"), z(p % 100, 3))).alias("lgpla"),
                       dec3(size + 3).alias("quan"),
                       F.when(p % 3 == 0, F.lit("PRAT")).otherwise(F.lit("OURO")).alias("lgnum"))
        return r0.unionByName(r1).unionByName(r2).unionByName(r3)

    def _t_ztwf_log_wf(self) -> DataFrame:
        li = self._lines
        i = F.col("id")
        key = F.concat(z("l_orderkey", 10), z("rspos", 4))
        r1 = F.struct(F.when(i % 2 == 0, F.concat(F.lit(" "), key)).otherwise(key).alias("chave"),
                      F.when(i % 3 == 0, F.lit(" ")).otherwise(F.lit("APROVADO")).alias("acao"),
                      F.col("sd").alias("data"), F.lit("08:00:00").alias("hora"))
        r2 = F.struct(key.alias("chave"), F.lit("REPROVADO").alias("acao"),
                      F.when(i % 13 != 0, F.col("sd")).alias("data"),
                      F.when(i % 4 != 0, F.lit("17:30:00")).alias("hora"))
        return self._rows(li, [], F.array(r1, r2))

    def _t_usr21(self) -> DataFrame:
        s = self.raw("supplier")
        sk = F.col("s_suppkey")
        return s.select(F.concat(F.lit("USR"), sk.cast("string")).alias("bname"),
                        F.when(sk % 2 == 0, F.concat(z(sk, 10), F.lit(" "))).otherwise(z(sk, 10))
                        .alias("persnumber"))

    def _t_adrp(self) -> DataFrame:
        s = self.raw("supplier")
        sk = F.col("s_suppkey")
        r1 = s.select(z(sk, 10).alias("persnumber"), F.col("s_name").alias("name_text"))
        r2 = s.select(z(sk, 10).alias("persnumber"),
                      F.when(sk % 3 != 0, F.concat(F.lit("Z "), F.col("s_name"))).alias("name_text"))
        return r1.unionByName(r2)

    def _t_csks(self) -> DataFrame:
        cu = self.raw("customer")
        c = F.col("c_custkey")
        r1 = cu.select(z(c, 10).alias("kostl"), F.concat(F.lit("PC"), (c % 50).cast("string"))
                       .alias("prctr"), F.lit("9999-12-31").alias("datbi"))
        r2 = cu.select(z(c, 10).alias("kostl"), F.lit("PCOLD").alias("prctr"),
                       F.lit("2020-12-31").alias("datbi"))
        return r1.unionByName(r2)

    def _t_cepct(self) -> DataFrame:
        n = self.raw("nation")
        nk = F.col("n_nationkey")
        pc = F.concat(F.lit("PC"), nk.cast("string"))
        r1 = n.select(pc.alias("prctr"), F.lit("P").alias("spras"),
                      F.concat(F.lit("Centro de lucro "), F.col("n_name")).alias("ltext"),
                      F.lit("9999-12-31").alias("datbi"))
        r2 = n.select(F.concat(F.lit("PC"), (nk + 25).cast("string")).alias("prctr"),
                      F.lit("P").alias("spras"),
                      F.concat(F.lit("Centro de lucro "), F.col("n_name"), F.lit(" B")).alias("ltext"),
                      F.lit("9999-12-31").alias("datbi"))
        r3 = n.select(pc.alias("prctr"), F.lit("E").alias("spras"),
                      F.lit("Profit center").alias("ltext"), F.lit("9999-12-31").alias("datbi"))
        r4 = n.select(pc.alias("prctr"), F.lit("P").alias("spras"), F.lit("Antigo").alias("ltext"),
                      F.lit("2019-12-31").alias("datbi"))
        return r1.unionByName(r2).unionByName(r3).unionByName(r4)

    def _t_anlh(self) -> DataFrame:
        cu = self.raw("customer")
        return cu.select(z("c_custkey", 7).alias("anln1"),
                         F.concat(F.lit("Imobilizado "), F.col("c_name")).alias("anlhtxt"))

    # ------------------------------------------------------------ dictionaries
    def _dict(self, rows, schema) -> DataFrame:
        """A code table. Its rows are literals of the plan, so that its size is known and
        it can be broadcast (a frame of Python rows has no size: joins with it would
        shuffle whole tables by a handful of codes)."""
        names = [c.split()[0] for c in schema.split(",")]
        table = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r, strict=True)]) for r in rows])
        return self.spark.range(1).select(F.inline(table))

    def _t_t353i_t(self):
        return self._dict(D.ACTIVITY_TEXTS, "ilart string, spras string, ilatx string")

    def _t_t356_t(self):
        return self._dict(D.PRIORITY_TEXTS, "priok string, artpr string, spras string, priokx string")

    def _t_t003p(self):
        return self._dict(D.ORDER_TYPE_TEXTS, "auart string, spras string, txt string")

    def _t_t024i(self):
        return self._dict(D.PLANNER_GROUPS, "ingrp string, iwerk string, innam string")

    def _t_tj30t(self):
        return self._dict(D.USER_STATUS_TEXTS, "stsma string, estat string, spras string, txt04 string")

    def _t_tj02t(self):
        return self._dict(D.SYSTEM_STATUS_TEXTS, "istat string, spras string, txt04 string")

    def _t_t001l(self):
        return self._dict(D.STORAGE_LOCATIONS, "werks string, lgort string")

    # ------------------------------------------------------ yard and telemetry
    def _t_relatorio_entrada_saida_uca(self) -> DataFrame:
        e = self.raw("events")
        eid, uid = F.col("event_id"), F.col("user_id")
        u = uid.cast("string")
        return e.select(
            eid.alias("id"),
            F.when(eid % 97 == 0, F.lit(None).cast("string")).when(eid % 89 == 0, F.lit(""))
             .when((uid % 2 == 0) & (eid % 2 == 0), F.concat(F.lit(" eq"), u))
             .when(uid % 2 == 0, F.concat(F.lit("EQ"), u, F.lit(" ")))
             .otherwise(F.concat(F.lit("EQ"), u)).alias("n_armac"),
            cases(F.col("event_type"), [("signup", "Entrada"), ("error", "Saída"), ("view", "Saida"),
                                        ("click", "entrada")], "Outro").alias("tipo_relatorio"),
            F.concat(F.lit("Tipo "), (uid % 6).cast("string")).alias("tipo_equipamento"),
            F.concat(F.lit(" marca"), (uid % 4).cast("string"), F.lit(" ")).alias("marca"),
            F.concat(F.lit("mod-"), (uid % 9).cast("string")).alias("modelo"),
            F.concat(F.lit("Cliente "), (uid % 13).cast("string")).alias("cliente"),
            F.col("event_type").alias("situacao"),
            F.when(eid % 101 == 0, F.lit(None).cast("timestamp_ntz"))
             .when(uid % 5 == 0, hour_trunc("ts")).otherwise(F.col("ts")).alias("created_at_form"),
            dec3("value").alias("horimetro"),
            F.concat(F.lit("F"), z(uid % 25, 2)).alias("filial"))

    def _t_hourmeter(self) -> DataFrame:
        e = self.raw("events").filter(F.col("event_type") != "error")
        eid, uid = F.col("event_id"), F.col("user_id")
        u = uid.cast("string")
        return e.select(
            eid.alias("id"),
            F.when(eid % 97 == 0, F.lit(None).cast("string")).when(eid % 89 == 0, F.lit(""))
             .when(eid % 2 == 0, F.concat(F.lit("eq"), u))
             .otherwise(F.concat(F.lit("EQ"), u)).alias("armac_code"),
            F.when(uid % 3 == 0, hour_trunc("ts")).otherwise(F.col("ts")).alias("event_datetime"),
            F.when(eid % 3 != 0, dec3("value")).alias("equipment_hourmeter"),
            (dec3("value") + F.lit(1000)).cast("decimal(18,3)").alias("panel_hourmeter"),
            F.concat(F.lit("CT"), (uid % 7).cast("string")).alias("contract"),
            F.when(eid % 7 != 0, F.col("ts")).alias("updated_at"))

    def _t_hourmeter_invalid(self) -> DataFrame:
        e = self.raw("events").filter(F.col("event_type") == "error")
        eid, uid = F.col("event_id"), F.col("user_id")
        return e.select(
            eid.alias("id"),
            F.when(eid % 97 != 0, F.concat(F.lit("EQ"), uid.cast("string"))).alias("armac_code"),
            F.when(uid % 4 == 0, hour_trunc("ts")).otherwise(F.col("ts")).alias("event_datetime"),
            dec3("value").alias("hourmeter"),
            cases(eid % 3, [(0, "GPS"), (1, "CAN")], "MANUAL").alias("source"),
            F.concat(F.lit("E"), (eid % 5).cast("string")).alias("error_code"))

    # ------------------------------------------------------------ receipts app
    def _t_evidencia_recebimentos(self) -> DataFrame:
        o = self.raw("orders")
        k = F.col("o_orderkey")
        return o.select(
            k.alias("id"), z("o_custkey", 10).alias("pedido"),
            F.when(k % 2 == 0, F.lit("")).when(k % 3 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("00"), k.cast("string"))).alias("requisicao_de_compra_os"),
            F.when(k % 5 != 0, k).alias("requisicao_de_compra_id"),
            F.when(k % 4 != 0, F.col("o_orderdate")).alias("data_recebimento"))

    def _t_requisicoes_de_compra(self) -> DataFrame:
        o = self.raw("orders")
        k = F.col("o_orderkey")
        return o.select(k.alias("id"),
                        F.when(k % 6 != 0, F.concat(F.lit("00"), (F.lit(PO_BASE) + k).cast("string")))
                        .alias("numero_pedido_gerado"))

    def _t_bi_bs_fluxo_aprov(self) -> DataFrame:
        li = self._lines
        i = F.col("id")
        return li.select(
            (F.lit(PO_BASE) + F.col("l_orderkey")).cast("string").alias("NumeroPedido"),
            F.concat(F.lit("APR"), (F.col("l_suppkey") % 3).cast("string")).alias("NomeAprovador"),
            F.col("sd").alias("DataInicio"),
            F.when(F.col("l_linenumber") % 2 == 0, F.lit("08:00")).otherwise(F.lit("14:00"))
             .alias("HorarioInicioAprovacao"),
            F.when(i % 8 != 0, F.concat(F.lpad((F.lit(8) + F.col("rspos")).cast("string"), 2, "0"),
                                        F.lit(":30"))).alias("HorarioFinalAprovacao"),
            cases(i % 5, [(0, "STARTED"), (1, "READY"), (2, "COMPLETED"), (3, "CANCELLED")],
                  "UNKNOWN").alias("StatusFluxoAprovacao"),
            F.when(i % 8 != 0, F.col("sd")).alias("DataFinal"))

    # ------------------------------------------------- native workflow (V4)
    def _t_swwwihead(self) -> DataFrame:
        li = self._lines
        i = F.col("id")
        return li.select(
            i.alias("wi_id"),
            F.when(F.col("l_linestatus") == "F", F.lit("W")).otherwise(F.lit("B")).alias("wi_type"),
            F.col("sd").alias("wi_cd"),
            F.when(F.col("l_linenumber") % 2 == 0, F.lit("08:00")).otherwise(F.lit("14:00"))
             .alias("wi_ct"),
            F.when(i % 8 != 0, F.col("sd")).alias("wi_aed"),
            cases(i % 5, [(0, "STARTED"), (1, "READY"), (2, "COMPLETED"), (3, "CANCELLED")],
                  "ERROR").alias("wi_stat"),
            F.concat(F.lit("USR"), (F.col("l_suppkey") % 60).cast("string")).alias("wi_aagent"))

    def _t_sww_wi2obj(self) -> DataFrame:
        li = self._lines
        i = F.col("id")
        return li.select(
            i.alias("wi_id"), F.lit("BO").alias("catid"),
            F.when(F.col("l_returnflag") == "N", F.lit("BUS2105")).otherwise(F.lit("BUS2012"))
             .alias("typeid"),
            F.concat(F.lit("00"), (F.lit(PO_BASE) + F.col("l_orderkey")).cast("string"))
             .alias("instid"))
