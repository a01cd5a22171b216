"""Shared pieces of the report pipelines."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetyard.functions import branch_of, is_code_in
from fleetyard.operators.joins import code_table
from fleetyard.operators.keyed import text_lookup

# Fixed cut-off of the maintenance reports: orders created from this date on.
ORDERS_SINCE = "2024-01-01"


def dbl(x) -> Column:
    """Quantities and amounts stay decimal up to the sink, which renders them as
    text; only the checked queries turn them into doubles (``registry``)."""
    return F.col(x) if isinstance(x, str) else x


def zero_strip(x) -> Column:
    """``TRIM(LEADING '0' FROM x)`` without trimming blanks."""
    c = F.col(x) if isinstance(x, str) else x
    return F.ltrim(c, F.lit("0"))


def work_centres(crhd: DataFrame) -> DataFrame:
    """Work-centre dictionary: objid -> arbpl, filial (tolerant object type)."""
    return code_table(crhd.filter(is_code_in("objty", ["A", ""]))
                      .select("objid", "arbpl", branch_of("arbpl").alias("filial")))


def activity_texts(t353i_t: DataFrame) -> DataFrame:
    return code_table(text_lookup(t353i_t, "ilart", "ilatx", lang="spras", langs=["P"]))


def priority_texts(t356_t: DataFrame) -> DataFrame:
    return code_table(text_lookup(t356_t, "priok", "priokx", lang="spras", langs=["P"],
                                  order=[F.col("artpr").asc_nulls_last()]))


def sort_report(df: DataFrame, order: list[Column], ordered: bool) -> DataFrame:
    """Presentation order is optional: a global sort is a range shuffle that a
    downstream writer or the application does not need."""
    return df.orderBy(*order) if ordered else df
