"""Operator 7. WARC archives: write with revisits, read by boundary chains.

Writing. Each page becomes one record whose HTTP body is the payload. Of
records with equal payloads (SHA-1 and length) of at least ``min_bytes`` bytes
the one with the smallest page id is a response and the others are revisits
that name it. The records are lines of a Spark text table with CR LF CR LF as
line end, which is the end of a WARC record, so any file system that Spark
writes to can hold the archive, and a lost task is simply written again. Files are
gzipped, as archives are kept (.gz), and hold at most ``RECORDS_PER_FILE`` records.

Reading. The files are cut at every occurrence of the version line, be it the
start of a record or part of a payload; a gzipped file is read by one task as a
stream, splits of a plain one by several. A cut whose header can be parsed is a candidate record and points at
its successor's offset. Of the candidates only (offset, successor) pairs move:
for each file, pointer jumping from offset 0 marks those that can be reached
from the start, and candidates inside payloads drop out. Cuts then join the
record that they lie in, and the payload is put together again.

Defined cases: a null payload is an empty one; rows that repeat the smallest
page id with equal payload are all responses; a null page id sorts last and
comes back as null; a null url is left out of the record; an empty table gives
an archive without records and no rows. Other columns are ignored. A file that
breaks off is read up to the last whole record.
"""

from __future__ import annotations

import base64
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchstar.session import ensure_checkpoint_dir

from .common import NULL_ID, cut, release, table

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
RECORDS_PER_FILE = 5_000


def base32_of_hex(batches):
    for b in batches:
        names = [base64.b32encode(bytes.fromhex(x)).decode() for x in b.column("sha1").to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string())], [*b.schema.names, "digest"])


def records(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(id, url, payload, size, digest, refers_to): refers_to is null for responses."""
    body = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(url_col).alias("url"), body.alias("payload"),
                        F.octet_length(body).cast("long").alias("size"), F.sha1(body.cast("binary")).alias("sha1"))
    first = rows.where(F.col("size") >= min_bytes).groupBy("sha1", "size").agg(F.min("id").alias("first_id"), F.count("*").alias("many")).where("many > 1").drop("many")
    joined = rows.join(first, ["sha1", "size"], "left")
    named = joined.mapInArrow(base32_of_hex, "sha1 string, size long, id long, url string, payload string, first_id long, digest string")
    return named.select("id", "url", "payload", "size", "digest", F.when(F.col("first_id") < F.col("id"), F.col("first_id")).alias("refers_to"))


def write_archive(rows: DataFrame, path: str) -> None:
    """Write the rows of ``records`` as WARC files under ``path``."""
    name = lambda c: F.concat(F.lit("<urn:page:"), F.when(F.col(c) == NULL_ID, F.lit("null")).otherwise(F.col(c).cast("string")), F.lit(">"))
    line = lambda key, value: F.coalesce(F.concat(F.lit(f"{key}: "), value, F.lit("\r\n")), F.lit(""))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit(MAGIC), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        line("WARC-Record-ID", name("id")), line("WARC-Target-URI", F.regexp_replace("url", "[\\r\\n]", " ")),
        F.when(revisit, F.concat(line("WARC-Refers-To", name("refers_to")), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"))).otherwise(""),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n"),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END))
    rows.select(F.concat(head, block).alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def reachable(rows: pd.DataFrame) -> pd.DataFrame:
    """The candidates of one file that the chain from offset 0 reaches, by
    doubling jumps: marks spread from every marked candidate over jumps of
    1, 2, 4, ... records."""
    rows = rows.sort_values("offset", ignore_index=True)
    at, to = rows["offset"].to_numpy(np.int64), rows["successor"].to_numpy(np.int64)
    n = len(at)
    jump = np.searchsorted(at, to)
    jump[(jump == n) | (at[np.minimum(jump, n - 1)] != to)] = n  # past the last
    jump = np.append(jump, n)
    marked = np.zeros(n + 1, bool)
    marked[:1] = at[:1] == 0
    while True:
        before = int(marked[:n].sum())
        marked[jump[marked]] = True
        marked[n] = False
        jump = jump[jump]
        if int(marked[:n].sum()) == before:
            break
    return rows[marked[:n]][["file", "offset", "successor"]]


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """(id, record_type, refers_to, url, declared_bytes, digest, payload_bytes, sha1)
    and with ``payloads`` the payload. Without, a record that lies in one cut
    is digested where it is read, and only broken-up records move."""
    width = len(MAGIC)
    cuts = (spark.read.option("lineSep", MAGIC).text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("nth")))
    head = F.substring_index("value", END, 1)
    declared = F.regexp_extract(head, "(?i)(?:^|\\r\\n)Content-Length:[ \\t]*([0-9]{1,18})[ \\t]*(?:\\r\\n|$)", 1)
    seen = cuts.withColumn("head", F.when(F.locate(END, F.col("value")) > 0, head)).withColumn("size", F.when(declared != "", declared.cast("long")))
    seen = seen.withColumn("length", F.octet_length("value").cast("long")).withColumn("head_bytes", F.octet_length("head").cast("long"))
    seen = seen.withColumn("whole", F.coalesce(F.col("length") == F.col("head_bytes") + F.col("size") + 2 * len(END), F.lit(False)))
    spaced = cut(_block_fields(seen.withColumn("r", F.when(F.col("whole"), F.col("value"))), payloads=False)
                 .select("file", "split", "nth", "length", "head", "head_bytes", "size", "whole", "http", "payload_bytes", "sha1"))
    order = Window.partitionBy("file").orderBy("split", "nth")
    # offsets follow from the lengths; before the first version line there is an empty cut
    spaced = spaced.withColumn("offset", F.sum(F.col("length") + width).over(order) - F.col("length") - 2 * width)
    spaced = cut(spaced)
    candidates = (spaced.where("offset >= 0 and size is not null and head_bytes is not null")
                  .select("file", "offset", (F.col("offset") + width + F.col("head_bytes") + len(END) + F.col("size") + len(END)).alias("successor")))
    chain = candidates.groupBy("file").applyInPandas(reachable, "file string, offset long, successor long")
    # every cut belongs to the last reached record at or before it
    starts = spaced.join(chain, ["file", "offset"], "left")
    owned = (starts.withColumn("owner", F.last(F.when(F.col("successor").isNotNull(), F.struct("offset", "successor", "head_bytes", "size", "whole")), ignorenulls=True).over(order))
             .withColumn("file_end", F.max(F.col("offset") + F.col("length") + width).over(Window.partitionBy("file")))
             .where("owner is not null and offset < owner.successor and owner.successor <= file_end"))
    owned = cut(owned.withColumn("record", F.col("owner.offset")))
    simple = owned.where("owner.whole and offset = record")
    broken = owned.where("not owner.whole").select("file", "split", "nth", "offset", "record", F.col("owner.head_bytes").alias("head_bytes"), F.col("owner.size").alias("size"))

    def contents(of: DataFrame) -> DataFrame:
        many = of.limit(PIECES + 1).count()
        if not many:
            return None
        pieces = cuts.join(F.broadcast(of) if many <= PIECES else of, ["file", "split", "nth"])
        text = F.concat_ws(MAGIC, F.transform(F.sort_array(F.collect_list(F.struct("offset", "value"))), lambda x: x["value"]))
        inside = pieces.where(F.col("offset") > F.col("record")).groupBy("file", "record").agg(text.alias("more"))
        return pieces.where(F.col("offset") == F.col("record")).join(inside, ["file", "record"], "left").select(
            F.concat(F.col("value"), F.coalesce(F.concat(F.lit(MAGIC), F.col("more")), F.lit(""))).alias("r"), F.substring_index("value", END, 1).alias("head"), "head_bytes", "size")

    if payloads:
        everything = contents(owned.select("file", "split", "nth", "offset", "record", F.col("owner.head_bytes").alias("head_bytes"), F.col("owner.size").alias("size")))
        return _fields(simple.withColumn("payload", F.lit("")).where("false") if everything is None else _block_fields(everything, True), True)
    rest = contents(broken)
    out = _fields(simple, False)
    return out if rest is None else out.unionByName(_fields(_block_fields(rest, False), False))


#: Pieces of records that may be broadcast: three numbers and a file name each.
PIECES = 50_000


def _block_fields(records_: DataFrame, payloads: bool) -> DataFrame:
    """http header, payload size and digest of whole records ``r``; null where r is."""
    block = F.expr("substring(cast(r as binary), cast(head_bytes + 5 as int), cast(size as int))").cast("string")
    out = records_.withColumn("block", block).withColumn("http", F.substring_index("block", END, 1))
    payload = F.when(F.locate(END, F.col("block")) > 0, F.expr("substring(block, instr(block, '\\r\\n\\r\\n') + 4)")).when(F.col("block").isNotNull(), F.lit(""))
    out = out.withColumn("payload", payload).withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    return out.drop("block") if payloads else out.drop("block", "payload")


def _fields(rows: DataFrame, payloads: bool) -> DataFrame:
    field = lambda key: F.regexp_extract("head", f"(?i)(?:^|\\r\\n){key}:[ \\t]*([^\\r\\n]*)", 1)
    page = lambda c: F.regexp_extract(c, "<urn:page:([0-9-]+)>", 1)
    number = lambda c: F.when(c != "", c.cast("long"))
    length = number(F.regexp_extract("http", "(?i)\\r\\nContent-Length:[ \\t]*([0-9]{1,18})", 1))
    response = field("WARC-Type") == "response"
    return rows.select(
        number(page(field("WARC-Record-ID"))).alias("id"), field("WARC-Type").alias("record_type"), number(page(field("WARC-Refers-To"))).alias("refers_to"),
        F.nullif(field("WARC-Target-URI"), F.lit("")).alias("url"), length.alias("declared_bytes"),
        F.regexp_extract(field("WARC-Payload-Digest"), "sha1:([A-Z2-7]*)", 1).alias("digest"),
        F.when(response, F.col("payload_bytes")).alias("payload_bytes"), F.when(response, F.col("sha1")).alias("sha1"),
        *([F.when(response, F.col("payload")).alias("payload")] if payloads else []))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page, read the archives, report each record."""
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(records(table(spark, sf_dir, "pages")), path)
    release(spark)
    got = read_archive(spark, path, payloads=False)
    size = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(F.col("declared_bytes"))
    checked = got.select("id", "record_type", "refers_to", size.alias("payload_bytes"), "digest", F.coalesce("sha1", F.lit("")).alias("sha1"))
    checked = checked.mapInArrow(_check_digest, "id long, record_type string, refers_to long, payload_bytes long, digest string")
    return checked.select(F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def _check_digest(batches):
    """The digest of a response is that of the payload as read, whatever its header says."""
    for b in batches:
        out = [base64.b32encode(bytes.fromhex(x)).decode() if x else d for x, d in zip(b.column("sha1").to_pylist(), b.column("digest").to_pylist())]
        yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(out, pa.string())], ["id", "record_type", "refers_to", "payload_bytes", "digest"])
