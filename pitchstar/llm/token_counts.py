"""Operator 8. Token counts that follow edits.

A document's text is cut into segments between a letter and a space followed by
a letter; byte-level BPE pre-tokens never cross such a place, so the count of a
text is the sum over its segments. The counts are the leaves of a segment tree
kept with the document. An edit (start, end, replacement; character offsets of
the old text) touches some segments; these are joined, with the next segment on
a side where the edit comes so near the cut that it is no longer a safe one,
re-encoded once with the edits in place, and the sums on the paths from their
leaves to the root are renewed. All other segments keep their counts.

Rows are independent: a build or an update is one pass over the table, nothing
is shuffled, and a lost task is simply run again.

Defined cases: a null text counts as empty, with 0 tokens and no segment; null
or no edits leave the tree as it is; edits are applied as if at once, must not
overlap (of overlapping ones the earlier start wins; of equal starts the longer
one; later ones are skipped) and are clipped to the text; a null replacement is
an empty one; a long text without safe places is one segment; rows repeat as
they are; an empty table gives no rows; other columns are kept by ``build``.

The vocabulary is a file of ranks (token in base64, rank) named by a parameter.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pre-token pattern of that vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of a segment, at least.
SEGMENT = 512
_SAFE = regex.compile(r"(?<=\p{L}) (?=\p{L})")
_encoders: dict[str, tiktoken.Encoding] = {}


def encoder(path: str) -> tiktoken.Encoding:
    """One per worker and file."""
    if path not in _encoders:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def cuts_of(text: str, least: int = SEGMENT) -> list[int]:
    """Starts of the segments."""
    out, at = [0] if text else [], least
    while at < len(text):
        m = _SAFE.search(text, at)
        if not m:
            break
        out.append(m.start())
        at = m.start() + least
    return out


def tree_of(leaves: list[int]) -> list[int]:
    """Sums in heap order: node k has children 2k and 2k + 1, leaves come last."""
    width = 1
    while width < len(leaves):
        width *= 2
    sums = [0] * (2 * width)
    sums[width:width + len(leaves)] = leaves
    for k in range(width - 1, 0, -1):
        sums[k] = sums[2 * k] + sums[2 * k + 1]
    return sums


def accepted(edits: list[dict] | None, length: int) -> list[tuple[int, int, str]]:
    """Edits in order, clipped, without overlaps."""
    out: list[tuple[int, int, str]] = []
    for e in sorted(edits or [], key=lambda e: (e["start"], -e["end"], e["text"] or "")):
        a = min(max(e["start"], 0), length)
        b = min(max(e["end"], a), length)
        if out and a < out[-1][1] or out and (a, b) == out[-1][:2]:
            continue
        out.append((a, b, e["text"] or ""))
    return out


def edited(text: str, edits: list[tuple[int, int, str]], lo: int = 0, hi: int | None = None) -> str:
    """text[lo:hi] with the edits inside it."""
    parts, at = [], lo
    for a, b, new in edits:
        parts += [text[at:a], new]
        at = b
    return "".join([*parts, text[at:hi]])


def update(text: str, cuts: list[int], sums: list[int], edits: list[tuple[int, int, str]], count) -> tuple[list[int], int, int]:
    """(sums, segments encoded again, characters encoded again). ``count`` is
    called once for each touched region."""
    sums = list(sums)
    width = len(sums) // 2
    if not cuts:
        n = count(edited(text, edits))
        return ([0, n] if edits else sums), int(bool(edits)), sum(len(e[2]) for e in edits)
    starts = np.array([*cuts, len(text)])
    regions: list[list] = []
    for e in edits:
        # a cut is safe while the characters around it stay: one before, the space and one after
        lo = max(int(np.searchsorted(starts, e[0] - 2, "right")) - 1, 0)
        hi = min(max(int(np.searchsorted(starts, e[1] + 1, "right")), lo + 1), len(cuts))
        if regions and lo < regions[-1][1]:
            regions[-1][1] = max(hi, regions[-1][1])
            regions[-1][2].append(e)
        else:
            regions.append([lo, hi, [e]])
    done = chars = 0
    for lo, hi, own in regions:
        new = edited(text, own, int(starts[lo]), int(starts[hi]))
        values = [count(new)] + [0] * (hi - lo - 1)
        for i, v in enumerate(values):
            k = width + lo + i
            more = v - sums[k]
            while k and more:
                sums[k] += more
                k //= 2
        done, chars = done + hi - lo, chars + len(new)
    return sums, done, chars


def build(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """The table with ``cuts`` and ``sums``, the segment tree of each text;
    the whole count is the second entry of ``sums``."""
    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_ordinary
        for b in batches:
            for part in slices(b, text_col):
                cuts = [cuts_of(t or "") for t in part.column(text_col).to_pylist()]
                sums = []
                for t, c in zip(part.column(text_col).to_pylist(), cuts):
                    ends = [*c[1:], len(t or "")]
                    sums.append(tree_of([len(encode(t[x:y])) for x, y in zip(c, ends)]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cuts, pa.list_(pa.int32())), pa.array(sums, pa.list_(pa.int64()))], [*part.schema.names, "cuts", "sums"])
    return docs.mapInArrow(trees, _with(docs, "cuts array<int>, sums array<bigint>"))


def _with(df: DataFrame, ddl: str):
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields])


def apply_edits(trees: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits", vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, n_before, n_after, n_edits, n_segments, n_encoded, chars_encoded, text, sums)
    from rows of ``build`` with an array of edits (start, end, text) each."""
    def renew(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_ordinary
        for b in batches:
            out = []
            for i, t, c, s, e in zip(*(b.column(x).to_pylist() for x in ("id", "text", "cuts", "sums", "edits"))):
                t = t or ""
                e = accepted(e, len(t))
                sums, done, chars = update(t, c, s, e, lambda x: len(encode(x)))
                out.append((i, s[1], sums[1], len(e), len(c), done, chars, edited(t, e), sums))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(
                [pa.int64()] * 7 + [pa.string(), pa.list_(pa.int64())])], ["id", "n_before", "n_after", "n_edits", "n_segments", "n_encoded", "chars_encoded", "text", "sums"])
    rows = trees.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), "cuts", "sums", F.col(edits_col).alias("edits"))
    return rows.mapInArrow(renew, "id long, n_before long, n_after long, n_edits long, n_segments long, n_encoded long, chars_encoded long, text string, sums array<bigint>")


#: What the query edits: mail addresses, secrets and long numbers give way to marks.
_PRIVATE = regex.compile(r"(?P<mail>[\w.+-]+@[\w-]+\.[\w.]+)|(?P<secret>\b\w*(?:password|key|token)\w*\s*[=:]\s*\S+)|(?P<number>\+?\d[\d ()./-]{5,}\d)")


def redactions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        edits = [[{"start": m.start(), "end": m.end(), "text": f"<{m.lastgroup}>"} for m in _PRIVATE.finditer(t or "")] for t in b.column("text").to_pylist()]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(edits, kind)], [*b.schema.names, "edits"])


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count every document, mask private spans, and follow the counts."""
    trees = build(table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = apply_edits(trees.mapInArrow(redactions, _with(trees, "edits array<struct<start:int,end:int,text:string>>")))
    return out.select(F.col("id").alias("doc_id"), "n_before", "n_after", "n_edits", "n_segments", "n_encoded")
