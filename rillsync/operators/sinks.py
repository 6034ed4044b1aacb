"""Sinks beside the snapshot store: load files of rendered rows, and a keyed apply to a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillsync.functions.decode import load_cell
from rillsync.operators.merge import delete_set, upsert_set
from rillsync.sources.schema import TableSpec


def load_lines(rows: DataFrame, delimiter: str = "|") -> DataFrame:
    """(line) of each row in the bulk-load format: cells in column order, null the empty cell."""
    return rows.select(F.concat_ws(delimiter, *[load_cell(F.col(c), kind) for c, kind in rows.dtypes]).alias("line"))


def write_load_files(net: DataFrame, path: str) -> None:
    """Files of a batch for a loader that is not Spark: path/delete with the keys to delete, path/insert with the rows
    to put in afterwards. A row whose text holds a line break spans lines, inside quotes."""
    load_lines(delete_set(net)).write.mode("overwrite").text(f"{path}/delete")
    load_lines(upsert_set(net)).write.mode("overwrite").text(f"{path}/insert")


class JdbcTarget:
    """Applies net changes to a table of a database: the executors write delete keys and rows side by side into
    staging tables, then one transaction deletes by key and inserts, so readers of the target see all of a batch or
    nothing, and applying twice is applying once. Needs the database's driver on the class path."""

    def __init__(self, spark: SparkSession, url: str, table: TableSpec, properties: dict[str, str] | None = None):
        self.spark, self.url, self.table, self.properties = spark, url, table, dict(properties or {})

    def _connect(self):
        jvm = self.spark.sparkContext._jvm
        given = jvm.java.util.Properties()
        for k, v in self.properties.items():
            given.setProperty(k, v)
        return jvm.java.sql.DriverManager.getConnection(self.url, given)

    def execute(self, *statements: str) -> list[int]:
        """Rows touched by each of the statements, in one transaction: all of them or none."""
        connection = self._connect()
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            try:
                done = [statement.executeUpdate(s) for s in statements]
                connection.commit()
                return done
            except Exception:
                connection.rollback()
                raise
        finally:
            connection.close()

    def statements(self, keys: str, rows: str) -> list[str]:
        """The transaction that takes a batch from its staging tables into the target."""
        t, jvm = self.table, self.spark.sparkContext._jvm
        # the staging columns are named as Spark writes them, quoted; the target's as the database knows them
        quoted = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url).quoteIdentifier
        same = lambda other: " AND ".join(f"{other}.{quoted(k)} = {t.name}.{k}" for k in t.keys)
        columns, staged = ", ".join(t.columns), ", ".join(map(quoted, t.columns))
        return [
            f"DELETE FROM {t.name} WHERE EXISTS (SELECT 1 FROM {keys} WHERE {same(keys)})",
            f"DELETE FROM {t.name} WHERE EXISTS (SELECT 1 FROM {rows} WHERE {same(rows)})",
            f"INSERT INTO {t.name} ({columns}) SELECT {staged} FROM {rows}",
        ]

    def apply(self, net: DataFrame) -> list[int]:
        """Rows deleted by the delete set, rows deleted for being put anew, and rows inserted."""
        stem = self.table.name.replace(".", "_")
        keys, rows = f"{stem}_keys", f"{stem}_rows"
        delete_set(net).write.jdbc(self.url, keys, "overwrite", self.properties)
        upsert_set(net).write.jdbc(self.url, rows, "overwrite", self.properties)
        return self.execute(*self.statements(keys, rows))
