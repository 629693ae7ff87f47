"""Operator 2. Removal of repeated runs of lines by winnowing line hashes.

A line is a maximal run of characters other than line feed and carriage return,
so empty lines are none. Runs of at least ``window`` consecutive lines that also
start earlier (smaller id, or same document and earlier) are deleted: a line
goes when a window of ``window`` lines that covers it equals one that starts
earlier, which is the union of all maximal matches of that length.

Method. Of every window the line with the smallest hash (the rightmost, if
several) is selected; equal windows select equal lines at the same place, so
the selected lines are fingerprints that no common run can avoid. Fingerprints
are joined by their hash; a window whose fingerprint stands nowhere else is
done. A matching position is then extended to both sides over the windows that
selected it, by comparing hashes of the whole window: the earliest position of
each is kept and all others deleted, so no list of positions is ever paired
with itself. The exchange of fingerprints and windows is that of
``substring_dedup``: packed, one entry per chunk of documents, answered in bits.

Defined cases: a null text has no lines and becomes an empty text where lines
are asked for, but ``keep_rows`` leaves null texts null; a null id sorts last;
rows that share an id are one document for the order; a text with fewer lines
than ``window`` stays whole; texts without removed lines stay as they are,
others lose each removed line with the line break after it; an empty table
gives no rows; other columns stay, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BREAKS, mix, table
from .substring_dedup import Chunk, run

WINDOW = 3


class LineChunk(Chunk):
    """Units are lines, interior spans are the selected lines."""

    separators = BREAKS

    def interior(self) -> tuple[np.ndarray, np.ndarray]:
        h, w, first = mix(self.words.hash), self.window, self.words.first
        n = len(h)
        start = np.arange(n)
        start = start[start + w <= np.repeat(first[1:], np.diff(first))]
        best = start.copy()
        for k in range(1, w):
            better = h[start + k] <= h[best]
            best[better] = start[better] + k
        self.starts = start
        low, self.selected = np.unique(best, return_inverse=True)
        return low, low + 1

    def possible(self, shared: np.ndarray) -> np.ndarray:
        """Only a window's own line is sure to be selected wherever it recurs."""
        return self.starts[shared[self.selected]]

    def kept(self, row: int, gone: np.ndarray) -> bytes:
        w = self.words
        a, b = int(w.offsets[row]), int(w.offsets[row + 1])
        if not gone.any():
            return w.data[a:b].tobytes()
        first = int(w.first[row])
        starts = np.append(w.start[first:first + len(gone)], b)
        parts = [w.data[a:starts[0]].tobytes()]
        parts += [w.data[starts[i]:starts[i + 1]].tobytes() for i in np.flatnonzero(~gone)]
        return b"".join(parts)


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Return (id, n_lines, n_removed, kept_text, removed)."""
    return run(docs, LineChunk, id_col, text_col, window).select("id", F.col("n_units").alias("n_lines"), "n_removed", "kept_text", "removed")


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The table itself, with repeated runs of lines taken out of its texts."""
    out = run(docs.withColumn("was_null_text", F.col(text_col).isNull()), LineChunk, id_col, text_col, window, keep=True)
    text = F.when(~F.col("rest.was_null_text"), F.col("kept_text"))
    return out.select(*[text.alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of three lines over every whole text of documents."""
    out = remove_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


#: Texts of the driver's tables use single line feeds; the kept text of a
#: changed document is rebuilt from its pieces up to each next line.
OP2_CTE = r"""
d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\r\n]+[\r\n]*') AS p,
         regexp_extract(coalesce(text, ''), '^[\r\n]*') AS lead FROM {docs}
), l AS (
  SELECT doc_id, unnest(p) AS p, generate_subscripts(p, 1) AS i FROM d
), h AS (
  SELECT doc_id, i, p, rtrim(p, chr(10) || chr(13)) AS t, count(*) OVER (PARTITION BY doc_id) AS n FROM l
), w AS (
  SELECT doc_id, i, n, md5(t || chr(10) || lead(t, 1) OVER o || chr(10) || lead(t, 2) OVER o) AS k FROM h WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), f AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM w WHERE i + 2 <= n
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 3)) AS i FROM f WHERE r > 1
), kept AS (
  SELECT h.doc_id, string_agg(h.p, '' ORDER BY h.i) AS s FROM h LEFT JOIN gone g ON g.doc_id = h.doc_id AND g.i = h.i WHERE g.i IS NULL GROUP BY 1
), c AS (
  SELECT doc_id, count(*) AS gone FROM gone GROUP BY 1
), lines AS (
  SELECT d.doc_id, CAST(len(p) AS BIGINT) AS n_lines, CAST(coalesce(c.gone, 0) AS BIGINT) AS n_removed, lead || coalesce(s, '') AS kept
  FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN c USING (doc_id)
)"""

OP2_SQL = "WITH " + OP2_CTE.format(docs="documents") + "\nSELECT doc_id, n_lines, n_removed, sha256(kept) AS kept_sha256 FROM lines"
