"""CSV sources S1-S4 and the CSV landing writer.

* S1 ``header_schema``: column names from the header, every type string.  No
  value decides a type, so no file can hold one that does not fit; silver
  types the columns.  ``probe_schema`` infers types from all files, for
  callers that want them.
* S2 ``stream_csv``: file stream with the schema pinned.  A file whose header
  differs in names or order raises instead of being read by position.  Files
  are taken whatever their age.  A record is a line, so a large file is split
  over many tasks; ``multiline`` reads quoted line breaks too, one task a file.
  ``archive`` moves finished files away, so that the folder's listing and the
  checkpoint's list of seen files stay as small as what is new.
* S3 ``stream_csv_inferred`` = S1 (inferred) + S2.
* S4 ``read_quoted_csv``: batch scan of quoted fields that may hold quotes and
  line breaks (such files are not split across tasks: land many files).

Writer and readers share one form: a doubled quote escapes a quote, blanks are
kept, and null is written as ``NULL_MARK`` so that empty text stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

NULL_MARK = r"\N"
# A landed file is never too old to be read (the default is seven days).
_ANY_AGE = "36500d"


def _form(null_value: str, multiline: bool = False) -> dict[str, str]:
    return {"header": "true", "multiLine": str(multiline).lower(), "escape": '"', "encoding": "UTF-8",
            "nullValue": null_value}


def header_schema(spark: SparkSession, path: str, null_value: str = NULL_MARK) -> StructType:
    """Names from the header line of one file, all columns string."""
    return spark.read.options(**_form(null_value)).csv(path).schema


def probe_schema(spark: SparkSession, path: str, null_value: str = NULL_MARK, multiline: bool = False) -> StructType:
    """S1 with types: a full pass over all files, so that no later value is
    lost to a type inferred from the first ones."""
    return spark.read.options(**_form(null_value, multiline)).option("inferSchema", "true").csv(path).schema


def stream_csv(spark: SparkSession, path: str, schema: StructType, null_value: str = NULL_MARK,
               batch: dict[str, str] | None = None, multiline: bool = False, archive: str | None = None) -> DataFrame:
    """Append stream over a landing folder, schema pinned.  ``batch``:
    limits of a micro-batch, e.g. {"maxBytesPerTrigger": "200g"}.  ``archive``:
    folder outside ``path`` to which files go after the batch that follows theirs."""
    options = dict(batch or {})
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    return (spark.readStream.schema(schema).options(**_form(null_value, multiline))
            .option("enforceSchema", "false").option("maxFileAge", _ANY_AGE)
            .options(**options).csv(path))


def stream_csv_inferred(spark: SparkSession, path: str, probe_path: str | None = None) -> DataFrame:
    """S3: the SQL ``STREAM read_files(..., inferSchema)`` form = S1 + S2."""
    return stream_csv(spark, path, probe_schema(spark, probe_path or path))


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType, null_value: str = NULL_MARK) -> DataFrame:
    """Quoted multi-line CSV (a doubled quote escapes a quote)."""
    return spark.read.options(**_form(null_value, True)).option("enforceSchema", "false").schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "append", null_value: str = NULL_MARK) -> None:
    """Land a DataFrame as CSV files that read back unchanged."""
    (df.write.mode(mode)
     .option("header", "true").option("escape", '"').option("nullValue", null_value).option("emptyValue", '""')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))
