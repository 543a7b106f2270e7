"""Tables of a relational database over JDBC.

A cluster names its database in ``spark.millrace.jdbc.url`` (and ``.driver``, ``.user``,
``.password``), and how many connections it takes at once in ``.connections``. A local session without that setting uses the embedded in-memory
database that comes with Spark: only its own process sees it, so it serves tests and
local runs and cannot serve executors on other machines.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.session import is_local
from millrace.sinks.verify import verify

_SETTING = "spark.millrace.jdbc."
_LOCAL_URL = "jdbc:derby:memory:millrace;create=true"
_LOCAL_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


@dataclass(frozen=True)
class Database:
    spark: SparkSession
    options: dict[str, str]

    @classmethod
    def of(cls, spark: SparkSession) -> Database:
        """The database the session is configured for."""
        url = spark.conf.get(_SETTING + "url", None)
        if url:
            options = {"url": url}
            for name in ("driver", "user", "password"):
                value = spark.conf.get(_SETTING + name, None)
                if value:
                    options[name] = value
            return cls(spark, options)
        if not is_local(spark):
            raise ValueError(f"set {_SETTING}url to a database that all executors can reach")
        return cls(spark, {"url": _LOCAL_URL, "driver": _LOCAL_DRIVER})

    @property
    def connections(self) -> int:
        """How many connections the database takes at a time."""
        return int(self.spark.conf.get(_SETTING + "connections", "8"))

    @contextmanager
    def _connection(self) -> Iterator[object]:
        jvm = self.spark.sparkContext._jvm
        properties = jvm.java.util.Properties()
        for name in ("user", "password"):
            if name in self.options:
                properties.setProperty(name, self.options[name])
        connection = jvm.java.sql.DriverManager.getConnection(self.options["url"], properties)
        try:
            yield connection
        finally:
            connection.close()

    def in_one_transaction(self, *statements: str) -> None:
        """Run all statements, or none of them."""
        with self._connection() as connection:
            connection.setAutoCommit(False)
            try:
                for text in statements:
                    statement = connection.createStatement()
                    statement.executeUpdate(text)
                    statement.close()
                connection.commit()
            except Exception:
                connection.rollback()
                raise

    def has(self, table: str) -> bool:
        """Whether there is a table of that name, whatever case the database stores names in."""
        with self._connection() as connection:
            found = connection.getMetaData().getTables(None, None, None, None)
            while found.next():
                if found.getString("TABLE_NAME").lower() == table.lower():
                    return True
        return False

    def drop(self, table: str) -> None:
        self.in_one_transaction(f"DROP TABLE {table}")

    def _rename(self, table: str, to: str) -> str:
        verb = "RENAME TABLE {} TO {}" if self.options["url"].startswith("jdbc:derby:") else "ALTER TABLE {} RENAME TO {}"
        return verb.format(table, to)

    def replace(self, df: DataFrame, table: str, column_types: str | None = None, split: Sequence[str] = ()) -> DataFrame:
        """Put the rows of ``df`` in place of a table's, all of them or none.

        The rows are written to ``<table>_staged``, read again and compared; only if they are the
        same does that table take the name, in the transaction in which the old one goes. Whoever
        reads the table finds the old rows or the new ones. A load that fails, is ended or whose
        rows the database has changed leaves the old table alone, and the next load overwrites
        what it left. The database must be able to undo a change of names, as PostgreSQL and Derby
        are. Returns ``verify``'s row; ``split`` names the columns for ``read_split``.
        """
        staged, old = f"{table}_staged", f"{table}_old"
        self.write(df, staged, "overwrite", column_types)
        found = self.read_split(staged, split, self.connections) if split else self.read_table(staged)
        row = verify(df, found).first()
        if row["same_rows"]:
            swap = [self._rename(staged, table)]
            if self.has(table):
                swap = [self._rename(table, old), *swap, f"DROP TABLE {old}"]
            self.in_one_transaction(*swap)
        else:
            self.drop(staged)
        return self.spark.createDataFrame([tuple(row)], "rows_written BIGINT, rows_found BIGINT, same_rows BOOLEAN")

    def read_table(self, table: str) -> DataFrame:
        """A whole table through one connection."""
        return self._reader().option("dbtable", table).load()

    def read_query(self, query: str) -> DataFrame:
        """The rows of a query that the database runs."""
        return self._reader().option("dbtable", f"({query}) q").load()

    def read_split(self, table: str, columns: str | Sequence[str], parts: int) -> DataFrame:
        """A whole table through at most ``parts`` connections that read about as many rows each.

        The database sorts the keys and names the ones at which to cut, so keys may crowd
        anywhere and may be numbers, texts or dates; rows without a first key are a part of their
        own. Rows of one value of the columns stay together: name further columns, such as the
        primary key, to divide a value that very many rows share.
        """
        columns = [columns] if isinstance(columns, str) else list(columns)
        cuts = self.quantiles(table, columns, parts)
        names = [f'"{column}"' for column in columns]
        bounds = [None, *cuts, None]
        predicates = [" AND ".join(filter(None, (_beyond(names, low, True), _beyond(names, high, False)))) for low, high in zip(bounds, bounds[1:])]
        predicates = [f"{names[0]} IS NOT NULL AND {text}" if text else f"{names[0]} IS NOT NULL" for text in predicates]
        options = {name: value for name, value in self.options.items() if name != "url"}
        return self.spark.read.jdbc(self.options["url"], table, predicates=[*predicates, f"{names[0]} IS NULL"], properties=options)

    def quantiles(self, table: str, columns: Sequence[str], parts: int) -> list[tuple]:
        """Keys, ascending and different, that cut the rows with a first key into ``parts`` of about one size.

        At most ``parts`` rows leave the database.
        """
        names = [f'"{column}"' for column in columns]
        order, first = ", ".join(names), names[0]
        total = self.read_query(f"SELECT COUNT({first}) AS n FROM {table}").first()[0]
        step = -(-total // parts)
        if step == 0 or parts < 2:
            return []
        if self.options["url"].startswith("jdbc:derby:"):  # it numbers rows in the order of a sub-query only
            numbered = f'SELECT ROW_NUMBER() OVER () AS "place", k.* FROM (SELECT {order} FROM {table} WHERE {first} IS NOT NULL ORDER BY {order}) k'
        else:
            numbered = f'SELECT ROW_NUMBER() OVER (ORDER BY {order}) AS "place", {order} FROM {table} WHERE {first} IS NOT NULL'
        cuts = self.read_query(f'SELECT "place", {order} FROM ({numbered}) n WHERE MOD("place", {step}) = 0 AND "place" < {total}').orderBy("place").collect()
        found: list[tuple] = []
        for row in cuts:
            key = tuple(row[1:])
            # A null in a further column cannot be compared with.
            if None not in key and (not found or found[-1] != key):
                found.append(key)
        return found

    def write(
        self, df: DataFrame, table: str, mode: str = "error", column_types: str | None = None
    ) -> None:
        """Write a table over at most ``connections`` at a time; ``overwrite`` drops it first."""
        writer = df.write.format("jdbc").options(**self.options)
        writer = writer.option("dbtable", table).option("numPartitions", self.connections)
        if column_types:
            writer = writer.option("createTableColumnTypes", column_types)
        writer.mode(mode).save()

    def _reader(self):
        return self.spark.read.format("jdbc").options(**self.options)


def _literal(value) -> str:
    """A value as SQL text; databases read quoted dates and times by the type they are compared with."""
    if isinstance(value, bool) or not isinstance(value, (str, datetime.date, datetime.datetime)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def _beyond(names: Sequence[str], key: tuple | None, above: bool) -> str | None:
    """Rows above a key, or up to it, column after column; null in a further column counts as smallest."""
    if key is None:
        return None
    literals = [_literal(value) for value in key]
    above_sql = ""
    for name, literal in reversed(list(zip(names, literals))):
        above_sql = f"({name} > {literal}" + (f" OR ({name} = {literal} AND {above_sql})" if above_sql else "") + ")"
    if above:
        return above_sql
    up_to = ""
    for at, (name, literal) in reversed(list(enumerate(zip(names, literals)))):
        null = f"{name} IS NULL OR " if at else ""
        up_to = f"({null}{name} < {literal} OR ({name} = {literal} AND {up_to}))" if up_to else f"({null}{name} <= {literal})"
    return up_to
