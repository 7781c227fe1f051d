"""SQL source (S2): run a query text through Spark SQL.

The query runs against the session catalog (temp views or tables).  For an
external database, pass ``jdbc`` options (url, user, password, driver...) and
the text runs in that database: as Spark's JDBC ``query`` option in one task, or,
with ``partition`` (column, lower, upper, num), as a subquery read by ``num`` tasks
by ranges of a numeric, date or timestamp column.  Blank inputs or any failure give an empty frame plus the query text, as the reference
does, and the failure is logged.
"""

from __future__ import annotations

import logging
import os
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def jdbc_url(dsn: str) -> dict[str, str]:
    """JDBC options (url, user, password) of a ``dialect+driver://user:password@host:port/database`` DSN;
    a text that is a JDBC url already stays as it is."""
    if dsn.startswith("jdbc:"):
        return {"url": dsn}
    u = urlsplit(dsn)
    dialect, db = u.scheme.split("+")[0], u.path.removeprefix("/")
    host = (u.hostname or "") + (f":{u.port}" if u.port else "")
    if dialect == "sqlite":
        return {"url": f"jdbc:sqlite:{db}"}
    if not dialect or not host:
        raise ValueError("a DSN must read dialect://host/database")
    url = f"jdbc:sqlserver://{host};databaseName={db}" if dialect == "mssql" else \
        f"jdbc:{ {'postgres': 'postgresql'}.get(dialect, dialect)}://{host}/{db}"
    return {"url": url} | ({"user": unquote(u.username)} if u.username else {}) | \
        ({"password": unquote(u.password)} if u.password else {})


def jdbc_options(query: str, jdbc: dict | None = None, dsn: str = "", partition: dict | None = None) -> dict[str, str]:
    """All options of the JDBC read; ``jdbc`` wins over what the DSN says."""
    opts = (jdbc_url(dsn) if dsn else {}) | dict(jdbc or {})
    if not partition:
        return opts | {"query": query}
    return opts | {"dbtable": f"({query.rstrip().rstrip(';')}) q", "partitionColumn": partition["column"],
                   "lowerBound": str(partition["lower"]), "upperBound": str(partition["upper"]),
                   "numPartitions": str(partition["num"])}


def read_sql_source(spark: SparkSession, item: dict) -> tuple[DataFrame, str]:
    query = (item.get("query") or "").strip()
    jdbc = item.get("jdbc")
    dsn = item.get("dsn") or os.getenv(str(item.get("env_dsn") or ""), "")
    empty = spark.createDataFrame([], "_empty string").drop("_empty")
    if not query:
        log.info("SQL source skipped: no query")
        return empty, query
    try:
        if jdbc or dsn:
            df = spark.read.format("jdbc").options(**jdbc_options(query, jdbc, dsn, item.get("partition"))).load()
        else:
            df = spark.sql(query)
        return df, query
    except Exception as e:  # noqa: BLE001 — reference semantics: any failure -> empty
        log.warning("SQL source failed: %s", e)
        return empty, query
