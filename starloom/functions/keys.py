"""Stable hash keys for dimension and surrogate ids.

``stable_key`` (default) takes 60 bits of the MD5 of a collision-free key
text: every part is written with its length in front and a NULL part as a
bare marker, so ("A_B", "C") and ("A", "B_C"), or NULL and a text equal to
the marker, give different texts.  It is reproducible in any engine that
has MD5.  Two natural keys may still share 60 hash bits; tables that are
merged on such an id are therefore checked for it before they are published
(``operators.load``), and readings are merged on their composite natural
key, never on the hash.  ``murmur_key`` is the 32-bit
``abs(hash(concat_ws("_", ...)))`` form, widened to bigint before ``abs``
so that the minimum int cannot overflow under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator between key parts, separator of a part's length
# and text, marker of a NULL part (no length, so no part can equal it).
KEY_SEPARATOR = "_"
LENGTH_SEPARATOR = ":"
NULL_MARKER = "N"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_text_sql(parts: tuple[str, ...]) -> str:
    cols = []
    for p in parts:
        x = f"CAST(`{p}` AS STRING)"
        cols.append(f"coalesce(concat(length({x}), '{LENGTH_SEPARATOR}', {x}), '{NULL_MARKER}')")
    return f"concat_ws('{KEY_SEPARATOR}', {', '.join(cols)})"


def key_text(*parts: Column | str) -> Column:
    """Unambiguous text of a composite key."""
    if all(isinstance(p, str) for p in parts):
        return F.expr(key_text_sql(parts))
    texts = [_c(p).cast("string") for p in parts]
    return F.concat_ws(KEY_SEPARATOR, *[
        F.coalesce(F.concat(F.length(x).cast("string"), F.lit(LENGTH_SEPARATOR), x),
                   F.lit(NULL_MARKER)) for x in texts])


def stable_key(*parts: Column | str) -> Column:
    """60-bit non-negative bigint from MD5 of the key text (O-66b, O-21)."""
    if all(isinstance(p, str) for p in parts):
        return F.expr(f"CAST(conv(substring(md5({key_text_sql(parts)}), 1, 15), 16, 10) AS BIGINT)")
    return F.conv(F.substring(F.md5(key_text(*parts)), 1, 15), 16, 10).cast("bigint")


def murmur_key(*parts: Column | str) -> Column:
    """abs(hash(concat_ws("_", parts))) with NULL parts skipped (O-66a)."""
    plain = F.concat_ws(KEY_SEPARATOR, *[_c(p).cast("string") for p in parts])
    return F.abs(F.hash(plain).cast("bigint"))
