"""Registry of queries, the tables they read, and SQL building blocks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldweave import session

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Timestamps are read as instants (in UTC), as the item tables have them.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, "
    "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def schema_of(name: str) -> str:
    return _SCHEMAS[name]


def plain(rows: DataFrame) -> DataFrame:
    """Instants as wall-clock times and decimals as doubles, the types the SQL gives."""
    def column(f: T.StructField):
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        return F.col(f.name)

    return rows.select(*[column(f) for f in rows.schema.fields])


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            session.configure(spark)
            return plain(fn(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, byte by byte and bit by bit."""
    steps = (
        f"list_concat([4294967295], flatten(list_transform(string_split({text}, ''), lambda s: "
        "list_concat([CAST(ascii(s) AS BIGINT)], list_transform(range(8), lambda z: CAST(-1 AS BIGINT))))))"
    )
    return (
        f"CAST(xor(list_reduce({steps}, lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) "
        "WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END), 4294967295) AS BIGINT)"
    )


def ranked(columns: Sequence[str], last: bool = False) -> str:
    return ", ".join(f"{c} {'DESC NULLS LAST' if last else 'ASC NULLS FIRST'}" for c in columns)


class SqlSource:
    """A source of :func:`merge_sql`: the SQL of its rows and what it owns."""

    def __init__(self, name, rows, update, insert=(), constants=None, first_by=(), last_by=(),
                 keys=None):
        self.name, self.rows, self.update, self.insert = name, rows, list(update), list(insert)
        self.constants, self.keys = constants or {}, keys
        self.first_by, self.last_by = list(first_by), list(last_by)

    def ctes(self, keys: Sequence[str]) -> list[str]:
        payload = [
            c for c in dict.fromkeys([*self.insert, *self.update])
            if c not in keys and c not in self.constants
        ]
        by = ", ".join(keys)
        known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        out = []
        for prefix, order, last in (("a", self.first_by, False), ("z", self.last_by, True)):
            rank = ranked([*order, *payload] or keys, last)
            out.append(
                f"{prefix}_{self.name} AS (SELECT * FROM (SELECT *, row_number() OVER "
                f"(PARTITION BY {by} ORDER BY {rank}) AS rank_ FROM ({self.rows}) WHERE {known}) "
                f"WHERE rank_ = 1)"
            )
        return out


def merge_sql(
    master: str, sources: Sequence[SqlSource], keys: Sequence[str], columns: Sequence[str],
    casts: dict[str, str] | None = None,
) -> str:
    """SQL of applying sources in order to a master table."""
    by = ", ".join(keys)
    ctes = [f"m AS ({master})"]
    universe = [f"SELECT {by} FROM m"]
    same = " AND ".join(f"m.{k} IS NOT DISTINCT FROM k.{k}" for k in keys)
    joins, there = [f"FROM k LEFT JOIN m ON {same}"], [f"m.{keys[0]} IS NOT NULL"]
    value = {c: f"m.{c}" for c in columns}
    for s in sources:
        own = s.keys or list(keys)
        ctes += s.ctes(own)
        a, z = f"a_{s.name}", f"z_{s.name}"
        for t in (a, z):
            joins.append(f"LEFT JOIN {t} ON " + " AND ".join(f"{t}.{k} = k.{k}" for k in own))
        if s.insert:
            universe.append(f"SELECT {by} FROM {z}")
        hit = f"{z}.{own[0]} IS NOT NULL"
        for c in columns:
            if c in keys:
                continue
            if c in s.update:
                v = s.constants.get(c, f"{z}.{c}")
                value[c] = f"CASE WHEN {hit} THEN {v} ELSE {value[c]} END"
            elif c in s.insert:
                v = s.constants.get(c, f"{a}.{c}")
                value[c] = f"CASE WHEN {hit} AND NOT ({' OR '.join(there)}) THEN {v} ELSE {value[c]} END"
        if s.insert:
            there.append(hit)
    ctes.append("k AS (" + " UNION ".join(universe) + ")")
    out = []
    for c in columns:
        v = f"k.{c}" if c in keys else value[c]
        if casts and c in casts:
            v = f"CAST({v} AS {casts[c]})"
        out.append(f"{v} AS {c}")
    return f"WITH {', '.join(ctes)} SELECT {', '.join(out)} {' '.join(joins)}"
