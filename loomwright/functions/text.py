"""Normalisation, identities and splits as column expressions.

Every pattern goes through :func:`rx`, which asks the JVM for Unicode classes, so
that ``\\s``, ``\\d`` and ``\\b`` know full-width and ideographic signs.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F


def rx(pattern: str, ignore_case: bool = False) -> str:
    """The pattern with Unicode classes and only ``\\n`` as line end."""
    return f"(?{'i' if ignore_case else ''}Ud){pattern}"


def bound(value: Column, body) -> Column:
    """``body`` of a value that is worked out once: inside a lambda function a plain column would be worked out again for each element."""
    return F.transform(F.array(value), body)[0]


def once(col: Column) -> Column:
    """The same value, as a column that the optimiser doesn't put, worked out again, in the place of each of its uses (what isn't deterministic stays where it is)."""
    return F.when(F.monotonically_increasing_id() >= 0, col)


def nfkc(col: Column) -> Column:
    """Compatibility composition; plain ASCII keeps its form without a call."""

    @F.pandas_udf("string")
    def compose(s: pd.Series) -> pd.Series:
        return s.map(lambda x: x if x is None or unicodedata.is_normalized("NFKC", x) else unicodedata.normalize("NFKC", x))

    # null stands for "as it is", so that plain texts aren't shipped to Python
    foreign = F.when(~col.rlike(r"^\p{ASCII}*$"), col)
    return F.coalesce(compose(foreign), col)


def strip(col: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(F.regexp_replace(col, rx(r"^\s+"), ""), rx(r"\s+$"), "")


def inline(col: Column, compose: bool = True) -> Column:
    """One line: compatibility form, runs of white space as one blank, no blanks at the ends; null becomes empty.

    ``compose=False`` skips the compatibility form where the input is known to have it.
    """
    text = F.coalesce(col, F.lit(""))
    return strip(F.regexp_replace(nfkc(text) if compose else text, rx(r"\s+"), " "))


def document(col: Column, compose: bool = True) -> Column:
    """Lines kept: one kind of line end, blanks of a line as one, at most one empty line in a row; null becomes empty."""
    text = F.coalesce(col, F.lit(""))
    text = F.regexp_replace(nfkc(text) if compose else text, r"\r\n?", "\n")
    lines = F.transform(F.split(text, "\n"), lambda line: strip(F.regexp_replace(line, r"[ \t]+", " ")))
    return strip(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"))


URL = r"(?:https?://|www\.)\S+"


def without_urls(col: Column, compose: bool = True) -> Column:
    return inline(F.regexp_replace(F.coalesce(col, F.lit("")), rx(URL, True), " "), compose)


def key(col: Column, compose: bool = True) -> Column:
    """Comparison key of a text: its one-line form in lower case."""
    return F.lower(inline(col, compose))


def name_key(col: Column, compose: bool = True) -> Column:
    """Latin letters, digits and ideographs of a name, lower case."""
    return F.regexp_replace(key(col, compose), r"[^a-z0-9一-鿿]+", "")


def digest(col: Column, length: int = 16) -> Column:
    """Hex prefix of SHA-256."""
    return F.substring(F.sha2(col.cast("string"), 256), 1, length)


def identity(prefix: str, *parts: Column) -> Column:
    """``prefix_`` and a digest of the parts, joined by NUL; a null part counts as empty."""
    joined = F.concat_ws("\0", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix + "_"), digest(joined))


def bucket(col: Column, buckets: int = 100) -> Column:
    return F.conv(digest(col, 8), 16, 10).cast("long") % buckets


def split_of(col: Column, train: int = 90, validation: int = 5) -> Column:
    """train / validation / test by a stable bucket of the key."""
    b = bucket(col)
    return F.when(b < train, "train").when(b < train + validation, "validation").otherwise("test")


def shuffle_key(seed: int, *parts: Column) -> Column:
    """A stable pseudo-random order: digest of ``seed:part:...``."""
    return digest(F.concat_ws(":", F.lit(str(seed)), *parts))


_CURLY = "“”„‟‘’‚‛"


def quote_supported(quote: Column, source: Column, compose: bool = True) -> Column:
    """The quote of four or more signs stands in the source, whichever way its quotation marks curl."""
    plain = lambda c: F.translate(inline(c, compose), _CURLY, "\"\"\"\"''''")
    return (F.length(plain(quote)) >= 4) & F.contains(plain(source), plain(quote))
