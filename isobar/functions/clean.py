"""Cleaning and labelling expressions for text-typed feed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def percent(text) -> Column:
    """strip ``%`` (``'23%'`` -> ``'23'``); NULL stays NULL."""
    return F.replace(_c(text), F.lit("%"), F.lit(""))


def to_int(x) -> Column:
    """text or number -> int, truncating toward zero; junk -> NULL.

    Via double so ``'49.3'`` -> 49 and ``'-0.7'`` -> 0 even with ANSI on,
    where a direct ``cast('49.3' as int)`` raises.
    """
    return _c(x).try_cast("double").try_cast("int")


def to_long(x) -> Column:
    """Text or number -> bigint, truncating toward zero; junk -> NULL. Epochs
    are bigint: an int ends in 2038. Whole numbers keep all their digits."""
    c = _c(x)
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))


def to_double(x) -> Column:
    """Text or number -> double; junk, NaN and infinity -> NULL (one such
    value would make every sum it enters useless)."""
    d = _c(x).try_cast("double")
    return F.when(F.abs(d) < float("inf"), d)


def hhmm(hour, minute, blank_empty: bool = True) -> Column:
    """``hour:minute`` label; ``''`` when both parts are empty."""
    lab = F.concat(_c(hour), F.lit(":"), _c(minute))
    if not blank_empty:
        return lab
    return F.when(lab == F.lit(":"), F.lit("")).otherwise(lab)


def slug(name) -> Column:
    """lower case without spaces (``'Salt Lake City'`` -> ``saltlakecity``)."""
    return F.lower(F.replace(_c(name), F.lit(" "), F.lit("")))


def prettify(label) -> Column:
    """``local_tz_offset`` -> ``Local Tz Offset``."""
    return F.initcap(F.replace(_c(label), F.lit("_"), F.lit(" ")))


def regex_literal(text) -> Column:
    """Quote a column's text for use inside a Java regex."""
    return F.concat(F.lit("\\Q"), F.replace(_c(text), F.lit("\\E"), F.lit("\\E\\\\E\\Q")),
                    F.lit("\\E"))


def replacement_literal(text) -> Column:
    """Escape ``\\`` and ``$`` so a column's text is a literal replacement."""
    t = F.replace(_c(text), F.lit("\\"), F.lit("\\\\"))
    return F.replace(t, F.lit("$"), F.lit("\\$"))
