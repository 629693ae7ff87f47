"""Key expressions: hashed surrogate keys and composite text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the public surrogate-key macro the models use):
# NULL inputs are replaced by this marker and parts are joined with "-".
NULL_MARKER = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """md5 over the text of each column, NULL-safe, in the given order.

    Runs as one codegen'd expression; no UDF.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def packed(c) -> Column:
    """Text as bytes, for shuffles: the 32 hex digits of a hashed key become their
    16 bytes, other text gets a byte more (two if it then had 16). Different texts
    have different bytes; ``unpacked`` gives the text back."""
    c = _col(c)
    digest = F.unhex(c)
    end = F.when(F.octet_length(c) == 15, F.lit(b"\xff\xff")).otherwise(F.lit(b"\x00"))
    return F.when((F.octet_length(c) == 32) & digest.isNotNull() & (F.lower(c) == c), digest).otherwise(F.concat(c.cast("binary"), end))


def unpacked(v) -> Column:
    """The text of ``packed`` bytes."""
    v = _col(v)
    size = F.octet_length(v)
    more = F.when((size == 17) & (F.substring(v, 17, 1) == F.lit(b"\xff")), 2).otherwise(1)
    return F.when(size == 16, F.lower(F.hex(v))).otherwise(F.substring(v, F.lit(1), size - more).cast("string"))


def text_key(*parts, sep: str = "_") -> Column:
    """Composite text key; NULL parts become empty text (C11)."""
    return F.concat_ws(sep, *[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts])


def match_text_key(season, match_date, home, away) -> Column:
    """In-run match identity ``season_date_home_vs_away``."""
    return F.concat_ws("_", *[F.coalesce(_col(c).cast("string"), F.lit(""))
                              for c in (season, match_date, home)],
                       F.concat(F.lit("vs_"), F.coalesce(_col(away).cast("string"), F.lit(""))))
