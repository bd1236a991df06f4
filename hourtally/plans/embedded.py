"""The database the registered table queries use.

``spark.hourtally.jdbc.url`` (with ``.driver``, ``.user``, ``.password``, ``.quote``) names one that all
executors reach. Without it, a local session uses the in-memory database that comes
with Spark. That one lives inside a single process, so it cannot serve a cluster.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from hourtally import session
from hourtally.sources.tables import Database

_CONF = "spark.hourtally.jdbc"


def database(spark: SparkSession) -> Database:
    url = spark.conf.get(f"{_CONF}.url", None)
    if url:
        login = {n: spark.conf.get(f"{_CONF}.{n}", None) for n in ("user", "password")}
        given = {name: value for name, value in login.items() if value}
        quote = spark.conf.get(f"{_CONF}.quote", "")
        return Database(url, spark.conf.get(f"{_CONF}.driver"), given, quote)
    if not session.is_local(spark):
        raise RuntimeError(f"set {_CONF}.url to a database that all executors reach")
    url = "jdbc:derby:memory:hourtally;create=true"
    return Database(url, "org.apache.derby.jdbc.EmbeddedDriver", quote='"')
