"""Raw tables in and out.

Raw files are header CSV (UTF-8, quoted when needed, empty field = NULL)
read with the declared schema, never inferred. Warehouse tables live in
catalog databases whose folders sit on shared storage.
"""

from __future__ import annotations

import json
import logging
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pyspark.errors import AnalysisException

from ..functions.casts import typed
from ..operators.upsert import SEQ
from ..schemas import RAW
from ..session import ensure_checkpoint_dir

log = logging.getLogger(__name__)

# multiLine: a quoted field may hold line breaks; white space around a value
# is part of it, on both sides.
CSV_OPTIONS = {"header": "true", "escape": '"', "encoding": "UTF-8", "multiLine": "true",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "dateFormat": "yyyy-MM-dd", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}


# G2
def sequenced(files: DataFrame) -> DataFrame:
    """Add ``SEQ``, the place of a row in the input: file, start of the split,
    place in the split. Rows of one split are read by one task in file order, so
    the third part needs to be comparable within a split only; files follow each
    other by path, as a collector's numbered or dated files do."""
    return files.withColumn(SEQ, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                                          F.monotonically_increasing_id().alias("pos")))


# A1
def read_raw(spark: SparkSession, path: str, table: str, fmt: str = "csv", sequence: bool = False) -> DataFrame:
    """Read one raw table (CSV or Parquet) into its declared schema;
    ``sequence`` adds each row's place in the input.

    CSV columns are matched by header name, as a keyed-dict reader does: a
    file may list the columns in any order, a missing column reads as NULL,
    extra columns are ignored. Text is converted with ``typed`` (try_cast):
    a malformed number or date becomes NULL instead of failing the load.
    Empty fields are NULL."""
    schema = RAW[table]
    if fmt == "parquet":
        stored = spark.read.schema(schema).parquet(path)
        return sequenced(stored) if sequence else stored
    text = _csv_text(spark, path, table)
    if text is None:
        return spark.createDataFrame([], schema)
    return typed(text, schema, keep=[SEQ] if sequence else [])


def _csv_text(spark: SparkSession, path: str, table: str) -> DataFrame | None:
    """The declared columns as text, with ``SEQ``; None without data files."""
    try:
        text = spark.read.options(**CSV_OPTIONS).option("inferSchema", "false").csv(path)
    except AnalysisException:      # an existing folder without data files
        return None
    have = set(text.columns)
    cols = [(F.col(f"`{f.name}`") if f.name in have else F.lit(None).cast("string")).alias(f.name)
            for f in RAW[table].fields]
    return sequenced(text).select(*cols, SEQ)


def rejects(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A1's side output: every value that ``read_raw`` turns into NULL although
    the file holds text for it, as (file, start, pos, column_name, text). One
    scan; a row without bad values gives nothing."""
    text = _csv_text(spark, path, table)
    schema = RAW[table]
    if text is None:
        return spark.createDataFrame([], "file string, start long, pos long, column_name string, text string")
    read = typed(text.select(*[F.col(f.name).alias(f"_t_{f.name}") for f in schema.fields], *schema.fieldNames(), SEQ), schema,
                 keep=[f"_t_{f.name}" for f in schema.fields] + [SEQ])
    bad = [F.when(F.col(f.name).isNull() & F.col(f"_t_{f.name}").isNotNull(),
                  F.struct(F.lit(f.name).alias("column_name"), F.col(f"_t_{f.name}").alias("text")))
           for f in schema.fields if f.dataType.typeName() != "string"]
    return (read.select(SEQ, F.explode(F.array_compact(F.array(*bad))).alias("b"))
            .select(f"{SEQ}.file", f"{SEQ}.start", f"{SEQ}.pos", "b.column_name", "b.text"))


def reject_counts(found: DataFrame) -> DataFrame:
    """Rejected values of each column."""
    return found.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_rejected"), F.countDistinct("file").alias("n_files"))


# A5
def write_rows(df: DataFrame, path: str, overwrite: bool = True, table: str | None = None) -> None:
    """Header CSV sink; ``overwrite=False`` appends new part files. With
    ``table`` the columns are written in that raw table's declared order."""
    if table:
        df = df.select(*RAW[table].fieldNames())
    df.write.mode("overwrite" if overwrite else "append").options(**CSV_OPTIONS).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


# A2
def source(spark: SparkSession, db: str, table: str) -> DataFrame:
    return spark.table(f"{db}.{table}")


def table_path(spark: SparkSession, db: str, name: str) -> str:
    """Folder of ``db.name``: under the database's location. Tables are
    written there as external tables, so a later session (or a catalog
    that does not persist) can attach and overwrite them."""
    return spark.catalog.getDatabase(db).locationUri.rstrip("/") + "/" + name


def drop_table(spark: SparkSession, db: str, name: str) -> None:
    """Drop ``db.name`` and delete its folder (dropping an external table
    alone would leave the data to be attached again)."""
    path = table_path(spark, db, name)
    spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def save_table(df: DataFrame, db: str, name: str, partition_by: list[str] | None = None) -> None:
    """Overwrite ``db.name`` as an external Parquet table at ``table_path``."""
    w = df.write.mode("overwrite").format("parquet").option("path", table_path(df.sparkSession, db, name))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(f"{db}.{name}")
    _record_schema(df.sparkSession, db, name, partition_by or [])


SCHEMA_FILE = "_table_schema.json"     # readers skip names with an underscore


def _file(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _record_schema(spark: SparkSession, db: str, name: str, partition_by: list[str]) -> None:
    """Keep the table's types and partition columns beside its files: neither
    can be read back from partition folder names."""
    fs, p = _file(spark, f"{table_path(spark, db, name)}/{SCHEMA_FILE}")
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps({"schema": spark.table(f"{db}.{name}").schema.json(), "partition_by": partition_by}), "utf-8"))
    finally:
        out.close()


def attach_table(spark: SparkSession, db: str, name: str, path: str) -> None:
    """Register an existing table folder with its recorded types and all its
    partitions; a folder without a record is registered as it reads."""
    fs, p = _file(spark, f"{path}/{SCHEMA_FILE}")
    if not fs.exists(p):
        spark.catalog.createTable(f"{db}.{name}", path=path, source="parquet")
        return
    stream = fs.open(p)
    try:
        told = json.loads(spark.sparkContext._jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A").next())
    finally:
        stream.close()
    schema = StructType.fromJson(json.loads(told["schema"]))
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in told['partition_by'])})" if told["partition_by"] else ""
    spark.sql(f"CREATE TABLE {db}.{name} ({cols}) USING parquet{parts} LOCATION '{path}'")
    if told["partition_by"]:
        spark.sql(f"ALTER TABLE {db}.{name} RECOVER PARTITIONS")


def create_database(spark: SparkSession, db: str, location: str | None = None) -> str:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")
    return db


# A4
def materialize(df: DataFrame, db: str, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Full rebuild of ``db.name`` as a Parquet table; returns the stored
    table so downstream models read it instead of recomputing.

    Partitioned writes are rebalanced on the partition columns first: AQE
    groups each value's rows into few files and splits a value that is
    too large (a hot partition) across several tasks."""
    save_table(df.hint("rebalance", *partition_by) if partition_by else df, db, name, partition_by)
    # partition columns come back last; keep the model's column order
    return df.sparkSession.table(f"{db}.{name}").select(*df.columns)


# A3
def load_raw(spark: SparkSession, path: str, db: str, table: str, fmt: str = "csv") -> int:
    """Truncate-and-load one raw table from ``path``; returns the row count.
    A missing input is skipped with a warning (the table is left as it is)
    and counts 0."""
    if not path_exists(spark, path):
        log.warning("raw input %s is missing; %s.%s not loaded", path, db, table)
        return 0
    obs = Observation(f"load_{table}_{uuid.uuid4().hex[:8]}")
    df = read_raw(spark, path, table, fmt).observe(obs, F.count(F.lit(1)).alias("rows"))
    save_table(df, db, table)
    return int(obs.get["rows"])


# A7
def table_counts(spark: SparkSession, db: str, tables: list[str]) -> DataFrame:
    """(table_name, row_count) for each table; a missing table counts 0."""
    parts = []
    for t in tables:
        if spark.catalog.tableExists(f"{db}.{t}"):
            parts.append(spark.table(f"{db}.{t}").agg(F.count(F.lit(1)).alias("row_count"))
                         .select(F.lit(t).alias("table_name"), "row_count"))
        else:
            parts.append(spark.range(1).select(F.lit(t).alias("table_name"),
                                               F.lit(0).cast("bigint").alias("row_count")))
    return reduce(DataFrame.unionByName, parts)


def diff_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Before/after counts per table with the signed change as text."""
    b = before.select("table_name", F.col("row_count").alias("before_rows"))
    a = after.select("table_name", F.col("row_count").alias("after_rows"))
    j = b.join(a, "table_name", "full")
    d = F.coalesce(F.col("after_rows"), F.lit(0)) - F.coalesce(F.col("before_rows"), F.lit(0))
    return j.select("table_name", "before_rows", "after_rows", d.alias("change"),
                    F.when(d >= 0, F.concat(F.lit("+"), d.cast("string")))
                    .otherwise(d.cast("string")).alias("change_text"))


def scratch_root(spark: SparkSession) -> str:
    """A fresh folder under the reliable checkpoint location (shared storage
    on a cluster) for jobs that write and read back."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch-{uuid.uuid4().hex[:12]}"


def stored(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables written once to a fresh folder and read from there: for jobs that
    read them many times, each of which would compute them anew."""
    out = {}
    for name, df in tables.items():
        spark = df.sparkSession
        path = f"{scratch_root(spark)}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        out[name] = spark.read.schema(df.schema).parquet(path)
    return out
