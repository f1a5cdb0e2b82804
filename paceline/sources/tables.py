"""Layer storage S5-S12: parquet tables under one root, one folder per layer.

S10: ``Layers(root)`` lays out ``root/{bronze,silver,gold}/<table>`` with
checkpoints beside them under ``root/_checkpoints``; ``sources.catalog`` puts
named schemas over them.  S11: a dataset that was reset lives in a folder of a
new generation, data and checkpoint together; ``open_layers`` reads which
generation counts.  S12: ``with_comment`` stores a table's comment in the
footers of its files, ``comment_of`` reads it back.

What counts is recorded in commit logs: small append-only Parquet tables, one
row a commit, which Spark commits whole or not at all.  A log has one writer
at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery

_ANY_AGE = "36500d"
_COMMENT = "table_comment"


@dataclass(frozen=True)
class Layers:
    """Paths of all datasets.  ``generations``: (dataset "layer.name",
    generation) of those that were reset since the root was made."""

    root: str
    generations: tuple[tuple[str, str], ...] = ()

    def landing(self, source: str) -> str:
        return f"{self.root}/landing/{source}"

    def archive(self, source: str) -> str:
        """Where finished files of a source go."""
        return f"{self.root}/landed/{source}"

    def _of(self, layer: str, name: str) -> str:
        generation = dict(self.generations).get(f"{layer}.{name}")
        return f"{layer}/{name}" if generation is None else f"{layer}/{name}-{generation}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{self._of(layer, name)}"

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.root}/_checkpoints/{self._of(layer, name)}"


def open_layers(spark: SparkSession, root: str) -> Layers:
    """The root's layout as of its last published reset."""
    published = {r.dataset: r.generation for r in _log(spark, f"{root}/generations", _GENERATION)}
    return Layers(root, tuple(sorted(published.items())))


def next_generation(layers: Layers, datasets: list[str]) -> Layers:
    """``datasets`` ("layer.name") moved to a new, empty generation each.
    Nothing is published: whoever opens the root still gets the old ones."""
    generation = uuid.uuid4().hex
    return replace(layers, generations=tuple(sorted({**dict(layers.generations),
                                                     **{d: generation for d in datasets}}.items())))


def publish_generations(spark: SparkSession, layers: Layers) -> None:
    """Make the generations of ``layers`` those that count, all in one commit."""
    path = f"{layers.root}/generations"
    number = max((r.number for r in _log(spark, path, _GENERATION)), default=0) + 1
    _append(spark, path, _GENERATION, number, list(layers.generations))


_GENERATION = "number long, dataset string, generation string"
_VERSION = "number long, folder string, batch long, expired boolean"


def _log(spark: SparkSession, path: str, schema: str) -> list[Row]:
    """The rows of a commit log, oldest first."""
    try:
        return sorted(spark.read.schema(schema).parquet(path).collect())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _append(spark: SparkSession, path: str, schema: str, number: int, rows: list[tuple]) -> None:
    """One commit: ``rows`` under their number."""
    if rows:
        spark.createDataFrame([(number, *r) for r in rows], schema).coalesce(1).write.mode("append").parquet(path)


def with_comment(df: DataFrame, comment: str) -> DataFrame:
    """``df`` whose files will carry ``comment`` in their footers."""
    first = df.columns[0]
    return df.withMetadata(first, {**df.schema[first].metadata, _COMMENT: comment})


def comment_of(spark: SparkSession, path: str) -> str | None:
    """The comment in the footers of the files at ``path``."""
    return spark.read.parquet(path).schema[0].metadata.get(_COMMENT)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Static read of a layer table."""
    return spark.read.parquet(path)


def stream_table(spark: SparkSession, path: str, batch: dict[str, str] | None = None) -> DataFrame:
    """Append stream over an upstream table; schema from its files, which
    are read whatever their age.  ``batch``: limits of a micro-batch."""
    schema = spark.read.parquet(path).schema
    return (spark.readStream.schema(schema).option("maxFileAge", _ANY_AGE)
            .options(**(batch or {})).parquet(path))


def append_available(df: DataFrame, path: str, checkpoint: str, name: str | None = None,
                     timeout: int | None = None) -> StreamingQuery:
    """Write every new input row once (availableNow), then stop.

    The checkpoint records which input files are done, so a rerun adds
    nothing and a new file adds only its rows; a failed run resumes from
    the last committed micro-batch (the file sink is exactly-once).  It waits
    as long as the backlog takes unless the caller sets ``timeout`` seconds.
    """
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    if name:
        writer = writer.queryName(name)
    query = writer.start(path)
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream into {path} did not finish")
    if query.exception() is not None:
        raise query.exception()
    return query


class Versions:
    """The versions of a materialized table, as its commit log has them when
    this is made.  Each is a folder of its own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.rows = spark, path, _log(spark, f"{path}/commits", _VERSION)

    @property
    def live(self) -> list[Row]:
        gone = {r.folder for r in self.rows if r.expired}
        return [r for r in self.rows if r.folder not in gone]

    @property
    def current(self) -> Row | None:
        """(number, folder, batch) of the version that counts."""
        return self.live[-1] if self.live else None

    def replace(self, df: DataFrame, batch: int = -1, keep: int | None = None) -> None:
        """``df`` as a new version, which counts once it is in the log; a
        refresh that fails leaves the version before it.  ``batch``: the
        micro-batch it includes.  With ``keep``, all but the last so many
        versions are emptied (never the one that counts until now)."""
        folder = f"{self.path}/v{uuid.uuid4().hex}"
        df.write.parquet(folder)
        old = [] if keep is None else self.live[:-1][:len(self.live) + 1 - keep]
        self._empty(old)
        self._commit([(folder, batch, False), *((r.folder, r.batch, True) for r in old)])

    def expire(self, keep: int = 2) -> int:
        """Empty the folders of all but the last ``keep`` versions; how many.
        Readers of those versions are not protected."""
        old = self.live[:-keep]
        self._empty(old)
        self._commit([(r.folder, r.batch, True) for r in old])
        return len(old)

    def _empty(self, rows: list[Row]) -> None:
        for r in rows:
            schema = self.spark.read.parquet(r.folder).schema
            self.spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(r.folder)

    def _commit(self, rows: list[tuple]) -> None:
        number = max((r.number for r in self.rows), default=0) + 1
        _append(self.spark, f"{self.path}/commits", _VERSION, number, rows)
        self.rows += [Row(number=number, folder=f, batch=b, expired=e) for f, b, e in rows]


def overwrite(df: DataFrame, path: str, batch: int = -1) -> None:
    """A materialized table replaced, as a new version."""
    Versions(df.sparkSession, path).replace(df, batch)


def current_version(spark: SparkSession, path: str) -> Row | None:
    return Versions(spark, path).current


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The last committed version of a table that ``overwrite`` writes."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no committed version in {path}")
    return spark.read.parquet(version.folder)


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    """S9 in one session: lazy views over DataFrames (see ``sources.catalog``
    for views that outlive it)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a parquet table in the shared scratch folder.

    Used where a relation feeds several branches of one plan (silver under
    the fact and each dimension): the expensive cleaning runs once, the
    lineage is cut (a lost executor re-reads files instead of recomputing
    the chain), and the branches read pruned columns with real statistics
    for AQE.  Every call takes a new folder; nothing is overwritten.
    """
    from paceline.session import fresh_dir

    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)
