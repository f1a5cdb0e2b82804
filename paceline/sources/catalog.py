"""Named schemas, tables, views and comments over a ``Layers`` root.

``Catalog`` puts the datasets of a root into the session catalog: one schema a
layer, external tables at the datasets' locations, persistent views kept as SQL
text.  Every session of the application sees them, and ``spark.table``, SQL,
``STREAM`` and ``DESCRIBE`` work on them.  Table data is never owned by the
catalog: dropping a table or schema leaves the files.

``save`` also records the definitions under the root, so that an application
whose catalog does not know them yet (the default one lives in memory) gets
them back with ``Catalog.attach``.

A file-based table's listing is cached by session.  ``put_table`` refreshes it
in this session; another that has read the table before runs ``refresh``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from paceline.sources.tables import Layers, overwrite, read_current

LAYERS = ("bronze", "silver", "gold")
_DEFINITION = ("position int, kind string, layer string, name string, body string, columns string, comment string, "
               "bucket_key string, buckets int")
# A streamed table's files are read whatever their age.
_OPTIONS = "OPTIONS ('maxFileAge' '36500d')"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """``text`` as a SQL string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Catalog:
    """Schemas ``<prefix>bronze``, ``<prefix>silver`` and ``<prefix>gold``."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix
        self.definitions: dict[tuple[str, str], tuple[str, str, str, str, str, int]] = {}

    def name(self, layer: str, name: str) -> str:
        """The qualified, quoted name of a table or view."""
        return f"{quoted(self.prefix + layer)}.{quoted(name)}"

    def sql(self, text: str) -> str:
        """``text`` with ${bronze}, ${silver} and ${gold} as schema names."""
        for layer in LAYERS:
            text = text.replace("${" + layer + "}", quoted(self.prefix + layer))
        return text

    def create_schemas(self) -> None:
        """What exists already stays as it is."""
        for layer in LAYERS:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(self.prefix + layer)} COMMENT {literal(layer + ' layer')}"
                           f" LOCATION {literal(f'{self.root}/schemas/{layer}')}")

    def put_table(self, layer: str, name: str, location: str, comment: str, columns: list[str] | None = None,
                  bucket_key: str = "", buckets: int = 0) -> None:
        """The table at ``location``; ``columns``: those of its files that it
        shows (all if none are named).  A table of the same shape that is
        elsewhere moves: readers see the old files or the new ones.  With
        ``buckets``, the files are those of ``write_bucketed``."""
        found = self.spark.read.parquet(location).schema
        fields = [found[c] for c in columns] if columns else found.fields
        shape = [(f.name, f.dataType.simpleString()) for f in fields]
        table = self.name(layer, name)
        if self.spark.catalog.tableExists(table):
            same = [(f.name, f.dataType.simpleString()) for f in self.spark.table(table).schema] == shape
            if same and not buckets:
                self.spark.sql(f"ALTER TABLE {table} SET LOCATION {literal(location)}")
                self.spark.sql(f"COMMENT ON TABLE {table} IS {literal(comment)}")
            else:
                self.spark.sql(f"DROP TABLE {table}")
        listed = ", ".join(f"{quoted(n)} {t}" for n, t in shape)
        spread = f" CLUSTERED BY ({quoted(bucket_key)}) SORTED BY ({quoted(bucket_key)}) INTO {buckets} BUCKETS"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({listed}) USING parquet {_OPTIONS}{spread if buckets else ''}"
                       f" LOCATION {literal(location)} COMMENT {literal(comment)}")
        self.spark.catalog.refreshTable(table)
        self.definitions[layer, name] = ("table", location, ",".join(columns or ()), comment, bucket_key, buckets)

    def write_bucketed(self, df: DataFrame, layer: str, name: str, location: str, comment: str, key: str,
                       buckets: int) -> DataFrame:
        """``df`` written to ``location`` and put as a table whose rows lie in
        ``buckets`` buckets by ``key``, sorted: tables with the same buckets
        are joined by it, and grouped by it, without a shuffle."""
        written = self.name(layer, f"{name}_{uuid.uuid4().hex}")
        (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", location)
         .saveAsTable(written))
        self.spark.sql(f"DROP TABLE {written}")                    # external: the files stay
        self.put_table(layer, name, location, comment, bucket_key=key, buckets=buckets)
        return self.table(layer, name)

    def put_view(self, layer: str, name: str, text: str, comment: str) -> None:
        """A view as SQL text over ${bronze}, ${silver} and ${gold}."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, name)} COMMENT {literal(comment)} AS {self.sql(text)}")
        self.definitions[layer, name] = ("view", text, "", comment, "", 0)

    def drop(self, layer: str, name: str) -> None:
        """S11's ``DROP TABLE IF EXISTS``: the name goes, the files stay."""
        kind = "VIEW" if self.definitions.pop((layer, name), ("table",))[0] == "view" else "TABLE"
        self.spark.sql(f"DROP {kind} IF EXISTS {self.name(layer, name)}")

    def refresh(self) -> None:
        """List the files of all tables anew in this session."""
        for (layer, name), (kind, *_) in self.definitions.items():
            if kind == "table":
                self.spark.catalog.refreshTable(self.name(layer, name))

    def comment(self, layer: str, name: str) -> str | None:
        """The comment that DESCRIBE TABLE EXTENDED shows."""
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(layer, name)}").collect()
        detail = [i for i, r in enumerate(rows) if r.col_name == "# Detailed Table Information"]
        return next((r.data_type for r in rows[detail[0]:] if r.col_name == "Comment"), None)

    def table(self, layer: str, name: str) -> DataFrame:
        return self.spark.table(self.name(layer, name))

    def save(self) -> None:
        """Record the definitions under the root, as one commit."""
        rows = [(i, kind, layer, name, *rest) for i, ((layer, name), (kind, *rest)) in enumerate(self.definitions.items())]
        overwrite(self.spark.createDataFrame(rows, _DEFINITION).coalesce(1), f"{self.root}/catalog")

    @classmethod
    def attach(cls, spark: SparkSession, root: str, prefix: str = "") -> Catalog:
        """Schemas, tables and views as last saved under ``root``."""
        catalog = cls(spark, root, prefix)
        catalog.create_schemas()
        saved = sorted(read_current(spark, f"{catalog.root}/catalog").collect())       # as they were made
        for r in saved:
            if r.kind == "table":
                catalog.put_table(r.layer, r.name, r.body, r.comment, r.columns.split(",") if r.columns else None,
                                  r.bucket_key, r.buckets)
            else:
                catalog.put_view(r.layer, r.name, r.body, r.comment)
        return catalog
