"""Incremental raw ingest with Structured Streaming.

New collection drops (header CSV files) arrive in a folder; an
``availableNow`` stream picks up every file not yet seen (the stream's
checkpoint remembers which), and ``foreachBatch`` merges each micro-batch
into the stored table with the newest-wins upsert. Each micro-batch writes
a new table version ``v<batch id>`` next to the previous ones; a replayed
batch rebuilds the same version from the version before it, so a lost
executor or a restarted driver cannot double-apply a drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.upsert import upsert_newest
from ..schemas import RAW, UPSERT_KEYS
from ..sources.raw import CSV_OPTIONS


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, table_root: str) -> list[int]:
    """Completed versions (folders with a _SUCCESS marker), ascending."""
    fs, root = _fs(spark, table_root)
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v") and name[1:].isdigit():
            if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[1:]))
    return sorted(out)


def read_version(spark: SparkSession, table_root: str, table: str,
                 before: int | None = None) -> DataFrame:
    """The newest completed version (older than ``before`` if given); an
    empty frame with the table schema when there is none."""
    vs = [v for v in versions(spark, table_root) if before is None or v < before]
    if not vs:
        return spark.createDataFrame([], RAW[table])
    return spark.read.schema(RAW[table]).parquet(f"{table_root}/v{vs[-1]:09d}")


def prune_versions(spark: SparkSession, table_root: str, keep: int = 3) -> list[int]:
    """Delete all but the newest ``keep`` completed versions (at least 2 are
    kept: a replay of the last micro-batch reads the version before it).
    Returns the versions deleted."""
    keep = max(keep, 2)
    vs = versions(spark, table_root)
    old = vs[:-keep] if len(vs) > keep else []
    fs, _ = _fs(spark, table_root)
    jvm = spark.sparkContext._jvm
    for v in old:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{table_root}/v{v:09d}"), True)
    return old


def ingest(spark: SparkSession, drops_dir: str, state_root: str, table: str,
           max_files_per_batch: int = 1000, keep_versions: int = 3) -> DataFrame:
    """Merge every new drop file of ``drops_dir`` into ``state_root/table``
    and return the newest table version; older versions beyond
    ``keep_versions`` are removed once the stream has finished."""
    keys = UPSERT_KEYS[table]
    table_root = f"{state_root}/{table}"

    def merge(batch: DataFrame, batch_id: int) -> None:
        base = read_version(spark, table_root, table, before=batch_id)
        merged = upsert_newest(base, batch, keys, ["scraped_at"])
        merged.write.mode("overwrite").parquet(f"{table_root}/v{batch_id:09d}")

    # the file stream needs a positional schema: enforceSchema=false makes a
    # file whose header differs from it fail instead of shifting columns
    stream = (spark.readStream.schema(RAW[table]).options(**CSV_OPTIONS)
              .option("enforceSchema", "false")
              .option("maxFilesPerTrigger", max_files_per_batch).csv(drops_dir))
    q = (stream.writeStream.foreachBatch(merge)
         .option("checkpointLocation", f"{state_root}/_streams/{table}")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    prune_versions(spark, table_root, keep_versions)
    return read_version(spark, table_root, table)
