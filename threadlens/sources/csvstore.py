"""CSV storage: items in folders by id prefix, and named batches."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.functions.dates import format_iso, parse_iso, run_stamp
from threadlens.scale import PART, ROW, laid_out
from threadlens.schemas import check_item_type

FOLDERS = {"submission": "submissions_csv", "comment": "comments_csv"}
SHORT_ID = "root"
FILE_ROWS = 200_000

# Missing values are written as \N so that empty texts stay apart from them.
_DIALECT = {"header": "true", "quote": '"', "escape": '"', "nullValue": "\\N",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def shard_columns(item_id: Column) -> dict[str, Column]:
    """Two folder levels from the first four characters; short ids share one folder."""
    long_enough = F.length(item_id) >= 4
    return {"s1": F.when(long_enough, F.substring(item_id, 1, 2)).otherwise(F.lit(SHORT_ID)),
            "s2": F.when(long_enough, F.substring(item_id, 3, 2)).otherwise(F.lit(SHORT_ID))}


def shard_of(item_id: str) -> tuple[str, str]:
    return (item_id[:2], item_id[2:4]) if len(item_id) >= 4 else (SHORT_ID, SHORT_ID)


_LOOKS_MISSING = r"^\\+N$"


def _as_text(df: DataFrame) -> DataFrame:
    """Times in ISO form and nested values as JSON, as CSV has neither. Texts that
    look like the sign for a missing value get one more backslash."""
    changed = {}
    for field in df.schema:
        if isinstance(field.dataType, T.StringType):
            text = F.col(field.name)
            changed[field.name] = F.when(text.rlike(_LOOKS_MISSING), F.concat(F.lit("\\"), text)).otherwise(text)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            changed[field.name] = format_iso(F.col(field.name).cast("timestamp"))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            changed[field.name] = F.to_json(field.name)
    return df.withColumns(changed) if changed else df


def _text_schema(schema: T.StructType) -> T.StructType:
    complex_types = (T.TimestampType, T.TimestampNTZType, T.StructType, T.ArrayType, T.MapType)
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, complex_types)
                                       else f.dataType) for f in schema])


def _revived(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared times and nested values back from text."""
    changed = {}
    for field in schema:
        if isinstance(field.dataType, T.StringType):
            text = F.col(field.name)
            changed[field.name] = F.when(text.rlike(_LOOKS_MISSING), F.expr(f"substring(`{field.name}`, 2)")).otherwise(text)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            changed[field.name] = parse_iso(F.col(field.name)).cast(field.dataType)
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            changed[field.name] = F.from_json(field.name, field.dataType)
    return df.withColumns(changed) if changed else df


class CsvStore:
    """A folder of CSV data; ``base_path`` must be storage that every executor sees."""

    def __init__(self, spark: SparkSession, base_path: str, compress: bool = True):
        self.spark = spark
        self.base_path = base_path.rstrip("/")
        self.compress = compress

    def _folder(self, item_type: str) -> str:
        return f"{self.base_path}/{FOLDERS[check_item_type(item_type)]}"

    def _writer(self, df: DataFrame):
        codec = "gzip" if self.compress else "none"
        # A compressed file with line breaks in its values is read by one task.
        return df.write.options(**_DIALECT).option("compression", codec).option("maxRecordsPerFile", FILE_ROWS)

    def _reader(self, schema: T.StructType):
        return self.spark.read.options(**_DIALECT).option("multiLine", "true").schema(schema)

    def store_items(self, items: DataFrame, item_type: str, stored_at=None) -> DataFrame:
        """Store items by id prefix and return the rows refused for want of an id.

        A rebalance on the folder columns before the write gives few files a folder
        and splits folders that are much larger than the rest.
        """
        accepted = items.filter(F.col("id").isNotNull())
        stamped = _as_text(accepted).withColumns({"stored_at": format_iso(run_stamp(stored_at)), "item_type": F.lit(item_type)})
        self._write_items(stamped, self._current(item_type))
        return items.filter(F.col("id").isNull())

    def _write_items(self, rows: DataFrame, path: str) -> None:
        rows = rows.withColumns(shard_columns(F.col("id")))
        self._writer(rows.hint("rebalance", "s1", "s2")).mode("append").partitionBy("s1", "s2").csv(path)

    def _generations(self, item_type: str) -> list[str]:
        """Folders of items, oldest first; readers use the last. One row a compaction."""
        first = f"{self._folder(item_type)}/items"
        try:
            rows = self.spark.read.schema("number long, path string").json(self._list(item_type)).collect()
        except AnalysisException as problem:
            if "PATH_NOT_FOUND" not in str(problem.getCondition()):
                raise
            rows = []
        return [first, *(row["path"] for row in sorted(rows, key=lambda row: row["number"]))]

    def _list(self, item_type: str) -> str:
        return f"{self._folder(item_type)}/generations"

    def _current(self, item_type: str) -> str:
        return self._generations(item_type)[-1]

    def read_items(self, item_type: str, schema: T.StructType) -> DataFrame:
        stored = (T.StructType(_text_schema(schema).fields).add("stored_at", "string")
                  .add("item_type", "string").add("s1", "string").add("s2", "string"))
        rows = self._reader(stored).csv(self._current(item_type))
        return _revived(rows, schema).withColumn("stored_at", parse_iso(F.col("stored_at")))

    def retrieve_item(self, item_id: str, item_type: str, schema: T.StructType) -> DataFrame:
        """The latest stored version of an item; only its folder is read."""
        s1, s2 = shard_of(item_id)
        rows = self.read_items(item_type, schema)
        own = rows.filter((F.col("s1") == s1) & (F.col("s2") == s2) & (F.col("id") == item_id))
        return own.orderBy(F.col("stored_at").desc()).limit(1).drop("s1", "s2")

    def latest_items(self, item_type: str, schema: T.StructType) -> DataFrame:
        """One row per id: the version stored last.

        The files are read once into a layout; ids, times and places decide, and the rows
        that are left are read where they lie, so no text is shuffled.
        """
        rows = laid_out(self.read_items(item_type, schema))
        newest = rows.groupBy("id").agg(F.max(F.struct("stored_at", ROW, PART)).alias("at")).select(F.col(f"at.{PART}").alias(PART), F.col(f"at.{ROW}").alias(ROW))
        return rows.join(newest, [PART, ROW], "left_semi").drop(PART, ROW)

    def compact(self, item_type: str, schema: T.StructType) -> list[str]:
        """Keep the version of each item that was stored last, and give the folders that
        no reader needs any more.

        The versions kept are written to a folder of their own; readers go over to it when
        its name is added to the list of folders, and the old one stays as it is, so
        at every moment there is a whole table to read. Items must not be stored
        meanwhile. Once readers that began before are done, delete the folders given.
        """
        old = self._generations(item_type)
        latest = self.latest_items(item_type, schema).drop("s1", "s2")
        path = f"{self._folder(item_type)}/items-{uuid.uuid4().hex}"
        self._write_items(_as_text(latest), path)
        added = self.spark.createDataFrame([(len(old), path)], "number long, path string")
        added.coalesce(1).write.mode("append").json(self._list(item_type))
        return old

    def store_batch(self, items: DataFrame, item_type: str, batch_id: str | None = None) -> dict:
        """Write one batch, all or nothing, and count it in the same job.

        Each write has a folder of its own, given as ``path``; an earlier batch of the
        same name stays. A write that fails stores nothing and gives its ``error``.
        """
        batch_id = batch_id or f"batch_{datetime.now(timezone.utc):%Y%m%d_%H%M%S}"
        path = f"{self.batch_path(item_type, batch_id)}/{uuid.uuid4().hex}"
        seen = Observation("stored rows")
        rows = _as_text(items).observe(seen, F.count(F.lit(1)).alias("rows"))
        try:
            self._writer(rows).csv(path)
        except (PySparkException, Py4JJavaError) as problem:
            return {"success": 0, "failure": None, "batch_id": batch_id, "error": str(problem)}
        stored = seen.get["rows"]
        if stored == 0:
            return {"success": 0, "failure": 0}
        return {"success": stored, "failure": 0, "batch_id": batch_id, "path": path}

    def batch_path(self, item_type: str, batch_id: str) -> str:
        return f"{self._folder(item_type)}/batches/{batch_id}"

    def retrieve_batch(self, path: str, schema: T.StructType) -> DataFrame:
        """All rows of a batch with their declared types."""
        return _revived(self._reader(_text_schema(schema)).csv(path), schema)
