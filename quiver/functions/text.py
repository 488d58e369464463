"""Text column functions."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from quiver.functions.stop_words import ENGLISH

TOKEN_PATTERN = "[a-z0-9_]{2,}"  # two or more word characters, after ASCII folding
NON_ASCII = "[^\\x00-\\x7F]"

# Code point ranges whose letters decompose (NFKD) into an ASCII base letter
# plus marks: Latin-1 Supplement, Latin Extended-A/B, Latin Extended Additional.
_FOLD_RANGES = ((0x00C0, 0x0250), (0x1E00, 0x1F00))


@functools.lru_cache(maxsize=None)
def accent_table() -> tuple[str, str]:
    """(from, to) strings for ``translate``: each accented Latin letter
    maps to the first character of its NFKD decomposition when that is an
    ASCII letter. Built by rule from the Unicode database."""
    src, dst = [], []
    for lo, hi in _FOLD_RANGES:
        for cp in range(lo, hi):
            ch = chr(cp)
            d = unicodedata.normalize("NFKD", ch)
            if len(d) > 1 and d[0].isascii() and d[0].isalpha():
                src.append(ch)
                dst.append(d[0])
    return "".join(src), "".join(dst)


def fold_ascii(c) -> Column:
    """Accents stripped, then every remaining non-ASCII character dropped."""
    x = F.col(c) if isinstance(c, str) else c
    src, dst = accent_table()
    return F.regexp_replace(F.translate(x, src, dst), NON_ASCII, "")


def tokens(c) -> Column:
    """Lower-case, fold to ASCII, tokens of >= 2 word characters."""
    x = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(fold_ascii(F.lower(x)), F.lit(TOKEN_PATTERN), 0)


def english_stop_words() -> tuple[str, ...]:
    """Spark ML's default English stop-word list (what ``StopWordsRemover`` removes)."""
    return ENGLISH


def sql_quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_tokens(expr: str) -> str:
    """DuckDB twin of :func:`tokens`."""
    src, dst = accent_table()
    return (f"regexp_extract_all(regexp_replace(translate(lower({expr}), {sql_quote(src)}, {sql_quote(dst)}), "
            f"'[^\\x00-\\x7F]', '', 'g'), '{TOKEN_PATTERN}')")
