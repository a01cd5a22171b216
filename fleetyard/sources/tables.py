"""Table sources for production runs.

Reports only call ``src.table(name)``; any object with that method is a
source. ``ParquetTables`` reads a landing zone of Parquet folders (predicate
and projection pushdown apply); ``JdbcTables`` reads the replica directly
with one Spark partition per slice predicate.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fleetyard.functions.dates import days_back, slice_bounds, slice_count
from fleetyard.sources.key_ranges import equal_depth_bounds, range_predicates

# The bin-stock table has a non-identifier name in the replica.
SOURCE_NAMES = {"scwm_aqua": '"/scwm/aqua"'}


def checked(df: DataFrame, name: str, declared: Mapping[str, Mapping[str, str]] | None) -> DataFrame:
    """``df`` if it has the declared columns (name -> Spark type name); else an error.

    Text dates and padded codes are compared as text: a landing table with
    another type would be read without complaint and filtered wrongly.
    """
    for column, kind in (declared or {}).get(name, {}).items():
        have = dict(df.dtypes).get(column)
        if have != kind:
            raise TypeError(f"table {name}: column {column} should be {kind}, is {have or 'missing'}")
    return df


# Columns whose type decides how reports filter, join or rank.
DECLARED = {
    "aufk": {"aufnr": "string", "erdat": "string", "objnr": "string"},
    "afih": {"aufnr": "string", "equnr": "string", "ilart": "string"},
    "resb": {"rsnum": "string", "rspos": "string", "bdter": "string", "lgort": "string"},
    "eban": {"banfn": "string", "bnfpo": "string", "badat": "string"},
    "ekko": {"ebeln": "string", "bedat": "string"},
    "ekpo": {"ebeln": "string", "ebelp": "string"},
    "ekbe": {"ebeln": "string", "ebelp": "string", "vgabe": "string", "budat": "string"},
    "jest": {"objnr": "string", "stat": "string"},
}


class ParquetTables:
    """``root/<name>`` Parquet folders, or an explicit ``paths`` mapping."""

    def __init__(self, spark: SparkSession, root: str | None = None,
                 paths: Mapping[str, str] | None = None,
                 declared: Mapping[str, Mapping[str, str]] | None = DECLARED):
        self.spark, self.root, self.paths = spark, (root or "").rstrip("/"), dict(paths or {})
        self.declared = declared
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """Lazy frame of the table; the handle (not the data) is reused, so the
        file listing and footer read happen once per table."""
        if name not in self._frames:
            path = self.paths.get(name) or f"{self.root}/{name}"
            self._frames[name] = checked(self.spark.read.parquet(path), name, self.declared)
        return self._frames[name]


class CatalogTables:
    """Tables of a catalog database (``spark.table``). Bucketed tables keep
    their bucket spec here, so joins on the bucket key need no shuffle."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.table(f"{self.database}.{name}")
        return self._frames[name]


@dataclass(frozen=True)
class KeyRange:
    """A table's key columns and the number of parts that it is read in; bounds come
    from a sample of ``percent`` of the table's blocks or rows."""

    columns: tuple[str, ...]
    parts: int
    percent: float = 1.0


class JdbcTables:
    """Direct replica reads, each table in several parallel partitions.

    A table is cut in one of three ways: ``slices`` maps it to WHERE predicates,
    one partition each; ``keys`` to a :class:`KeyRange`, whose parts hold about
    as many rows each whatever the key's skew; ``ranges`` to ``(column, lowest,
    highest, partitions)`` of a numeric or date key, which Spark cuts into equal
    strides. A table with none is read over one connection. ``schemas`` gives
    the database schema of tables that are not in ``schema``.
    """

    def __init__(self, spark: SparkSession, url: str, properties: Mapping[str, str],
                 schema: str | None = None, slices: Mapping[str, Sequence[str]] | None = None,
                 ranges: Mapping[str, tuple] | None = None,
                 schemas: Mapping[str, str] | None = None, fetchsize: int = 10000,
                 keys: Mapping[str, KeyRange] | None = None):
        self.spark, self.url, self.schema = spark, url, schema
        self.props = {"fetchsize": str(fetchsize), **properties}
        self.slices, self.ranges, self.schemas = dict(slices or {}), dict(ranges or {}), dict(schemas or {})
        self.keys = dict(keys or {})
        for name in self.keys:
            if name in self.slices or name in self.ranges:
                raise ValueError(f"table {name} is cut in two ways")
        self._parts: dict[str, list[str]] = {}

    @property
    def engine(self) -> str:
        return self.url.split(":")[1]

    def _name(self, name: str) -> str:
        n = SOURCE_NAMES.get(name, name)
        schema = self.schemas.get(name, self.schema)
        return f"{schema}.{n}" if schema else n

    def sample_query(self, name: str) -> str:
        """Statement that reads the sample of a table's keys, in the database's own way."""
        key = self.keys[name]
        some = (f"WHERE RAND() < {key.percent / 100:g}" if self.engine == "mysql" else f"TABLESAMPLE SYSTEM ({key.percent:g})")
        return f"SELECT {', '.join(key.columns)} FROM {self._name(name)} {some}"

    def _sample(self, name: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(url=self.url, query=self.sample_query(name), **self.props).load()

    def _key_parts(self, name: str) -> list[str]:
        """Predicates of the table's parts; the sample is taken once."""
        if name not in self._parts:
            key = self.keys[name]
            bounds = equal_depth_bounds(self._sample(name), key.columns, key.parts)
            # text of digits and one length is in one order everywhere; other text is
            # compared as bytes, as the bounds were
            texts = [v for b in bounds for v in b if isinstance(v, str)]
            plain = all(t.isdigit() for t in texts) and all(
                len({len(b[i]) for b in bounds if isinstance(b[i], str)}) <= 1 for i in range(len(key.columns)))
            self._parts[name] = range_predicates(key.columns, bounds, "{}" if plain else BYTE_ORDER[self.engine])
        return self._parts[name]

    def options(self, name: str) -> dict:
        """Arguments of the read of one table."""
        out: dict = {"url": self.url, "table": self._name(name), "properties": self.props}
        if self.slices.get(name):
            out["predicates"] = list(self.slices[name])
        elif name in self.keys:
            out["predicates"] = self._key_parts(name)
        elif name in self.ranges:
            column, low, high, parts = self.ranges[name]
            out |= {"column": column, "lowerBound": low, "upperBound": high, "numPartitions": int(parts)}
        return out

    def table(self, name: str) -> DataFrame:
        return self.spark.read.jdbc(**self.options(name))


class RoutedTables:
    """Tables from several sources in one run: some by name, the rest from the main one."""

    def __init__(self, main, by_name: Mapping[str, object]):
        self.main, self.by_name, self.spark = main, dict(by_name), main.spark

    def table(self, name: str) -> DataFrame:
        return self.by_name.get(name, self.main).table(name)


# How a text column is compared byte by byte.
BYTE_ORDER = {"postgresql": '{} COLLATE "C"', "mysql": "BINARY {}"}

# Keys of the large tables, for reads in parts.
TABLE_KEYS = {
    "aufk": ("aufnr",), "afih": ("aufnr",), "afko": ("aufnr",), "afvc": ("aufpl", "aplzl"), "afvv": ("aufpl", "aplzl"),
    "jest": ("objnr", "stat"), "jsto": ("objnr",), "eban": ("banfn", "bnfpo"), "ebkn": ("banfn", "bnfpo"),
    "ekko": ("ebeln",), "ekpo": ("ebeln", "ebelp"), "ekkn": ("ebeln", "ebelp"), "ekbe": ("ebeln", "ebelp"),
    "eket": ("ebeln", "ebelp"), "lips": ("rsnum", "rspos"), "rkpf": ("rsnum",), "rsadd": ("rsnum", "rspos"),
    "ztwf_log_wf": ("chave", "data"), "makt": ("matnr",), "mara": ("matnr",), "equi": ("equnr",), "equz": ("equnr", "datbi"),
    "swwwihead": ("wi_id",), "sww_wi2obj": ("wi_id",),
}


def key_ranges(parts: int, percent: float = 1.0) -> dict[str, KeyRange]:
    """All large tables in ``parts`` parts each."""
    return {name: KeyRange(columns, parts, percent) for name, columns in TABLE_KEYS.items()}


# Default port and URL options of each engine.
ENGINES = {"postgresql": (5432, ""), "mysql": (3306, "?useUnicode=true&characterEncoding=utf8")}


def jdbc_url(engine: str, host: str, database: str, port: int | None = None) -> str:
    """JDBC URL of a replica; the engine (a key of ENGINES) is always named."""
    default, options = ENGINES[engine]
    return f"jdbc:{engine}://{host}:{port or default}/{database}{options}"


def quoted(value) -> str:
    """SQL text literal."""
    return "'" + str(value).replace("'", "''") + "'"


def value_slices(column: str, values: Sequence[str]) -> list[str]:
    """One predicate per value (e.g. one per storage location)."""
    return [f"{column} = {quoted(v)}" for v in values]


def day_slices(column: str, as_of, ini: int, fim: int, size: int) -> list[str]:
    """One text-date range predicate per day slice of the window; together
    they cover it with no gap and no overlap."""
    days = (slice_bounds(i, ini, fim, size) for i in range(slice_count(ini, fim, size)))
    return [f"{column} BETWEEN {quoted(days_back(as_of, a))} AND {quoted(days_back(as_of, b))}" for a, b in days]
