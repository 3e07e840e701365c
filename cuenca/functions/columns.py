"""Column-level helpers: labels, safe parsing, identifiers.

All are built-in expressions (JVM-side, whole-stage codegen); none is a
Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def review_label(score) -> Column:
    """1-2 → 'mala', 3 → 'neutral', 4-5 → 'buena' (NULL otherwise)."""
    s = _c(score)
    return (F.when(s.between(1, 2), "mala").when(s == 3, "neutral")
            .when(s.between(4, 5), "buena"))


def purchase_gap_bucket(days) -> Column:
    """≤30 'frecuente', 31-90 'ocasional', >90 'raro'; NULL gap (first purchase) → NULL."""
    d = _c(days)
    return F.when(d <= 30, "frecuente").when(d <= 90, "ocasional").when(d > 90, "raro")


def delivery_label(delivered, estimated) -> Column:
    """'not_delivered' without a delivery time, else on_time / late."""
    dl, es = _c(delivered), _c(estimated)
    return (F.when(dl.isNull(), "not_delivered").when(dl <= es, "on_time").otherwise("late"))


def share(part, total) -> Column:
    """part / NULLIF(total, 0): NULL instead of a division error."""
    return F.try_divide(_c(part), F.nullif(_c(total), F.lit(0)))


def unknown_if_null(c, label: str = "UNKNOWN") -> Column:
    return F.coalesce(_c(c), F.lit(label))


def not_true(c) -> Column:
    """Mongo ``$ne: true``: keeps false, NULL and missing."""
    return ~_c(c).eqNullSafe(True)


def null_or_empty(c) -> Column:
    x = _c(c)
    return x.isNull() | (F.trim(x.cast("string")) == "")


def clean_id(c) -> Column:
    """Identifier read as a number or a string → trimmed string without '.0'."""
    return F.regexp_replace(F.trim(_c(c).cast("string")), r"\.0$", "")


def try_number(c) -> Column:
    return _c(c).cast("string").try_cast("double")


def try_date(c, fmt: str | None = None) -> Column:
    x = _c(c).cast("string")
    return F.try_to_date(x, fmt) if fmt else F.try_to_date(x)


def try_timestamp(c, fmt: str | None = None) -> Column:
    x = _c(c).cast("string")
    return F.try_to_timestamp(x, F.lit(fmt)) if fmt else F.try_to_timestamp(x)


def pseudonymise(c, salt: str) -> Column:
    """Salted SHA-256 of a PII value (deterministic, joinable, not reversible)."""
    return F.sha2(F.concat(F.lit(salt), _c(c).cast("string")), 256)


def zero_pad(c, width: int) -> Column:
    """Left-pad with zeros to ``width``; longer values are kept whole
    (``lpad`` alone would cut them and make ids collide)."""
    s = _c(c).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))
