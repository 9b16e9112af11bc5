"""Slug and URL-path expressions, all built-in Catalyst expressions (no UDF).

Normalisation: fold accents, lower-case, turn every run of characters
outside ``[a-z0-9]`` into ``-`` and trim ``-`` at both ends. The function is
idempotent, which the already-correct test relies on.
"""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_MARK_CATEGORIES = ("Mn", "Mc", "Me")


@functools.lru_cache(maxsize=1)
def accent_fold_table() -> tuple[str, str]:
    """(from, to) strings for ``translate``, derived by rule.

    Every Basic Multilingual Plane character whose canonical decomposition
    (NFD) is one base character plus combining marks maps to that base
    character; this is what stripping accents after decomposition does.
    """
    src, dst = [], []
    for code in range(0x80, 0x10000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        ch = chr(code)
        decomposed = unicodedata.normalize("NFD", ch)
        base = "".join(x for x in decomposed if unicodedata.category(x) not in _MARK_CATEGORIES)
        if len(base) == 1 and base != ch:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_accents(c: Column | str) -> Column:
    """Drop combining marks, then map precomposed letters to their base."""
    src, dst = accent_fold_table()
    no_marks = F.regexp_replace(_col(c), r"\p{M}+", "")
    return F.translate(no_marks, src, dst)


def normalize_slug(c: Column | str) -> Column:
    """Text -> URL slug; null stays null, may yield ``''``."""
    dashed = F.regexp_replace(F.lower(fold_accents(c)), "[^a-z0-9]+", "-")
    return F.btrim(dashed, F.lit("-"))


def evaluated_once(c: Column) -> Column:
    """The column from a generator: later filters and expressions read its value instead of repeating it."""
    return F.explode(F.array(c))


def slug_stem(c: Column | str) -> Column:
    """The slug without its trailing ``-<digits>`` groups; suffixed candidates keep it."""
    return F.regexp_replace(_col(c), "(-[0-9]+)+$", "")


def slug_level(c: Column | str) -> Column:
    """Number of trailing ``-<digits>`` groups (``a-1-22`` -> 2, ``a`` -> 0).

    Appending ``-<sku>`` for a numeric SKU raises the level by exactly one,
    which lets collisions be settled level by level.
    """
    tail = F.regexp_extract(_col(c), r"((-[0-9]+)*)$", 1)
    return F.size(F.split(tail, "-")) - F.lit(1)


def is_numeric_sku(c: Column | str) -> Column:
    return _col(c).rlike("^[0-9]+$")


def suffixed_slug(slug: Column | str, sku: Column | str) -> Column:
    """``slug-sku``, the second candidate after a collision."""
    return F.concat(_col(slug), F.lit("-"), _col(sku))


def product_path(slug: Column | str) -> Column:
    """Storefront path of a product slug: ``/<slug>/p`` (null in, null out)."""
    return F.concat(F.lit("/"), _col(slug), F.lit("/p"))


def numeric_order_key(sku: Column | str) -> Column:
    """First sort key of a SKU: its numeric value, null for non-numeric."""
    return _col(sku).try_cast("bigint")
