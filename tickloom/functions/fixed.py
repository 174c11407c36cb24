"""Exact decimal text to fixed-point mantissas, as column expressions; no value ever passes through a double.

A group of texts shares one scale, the largest number of decimals in it. If a value exceeds 32 bits at that scale, the scale
goes down by one until all fit; at each scale the first bad value in order decides whether that is a retry (too large) or the
end (not a number).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

U32_MAX = 4294967295
OK, BAD_NUMBER, SCALE_OVERFLOW = "ok", "bad_number", "scale_overflow"
#: A mantissa that isn't a number, and one beyond 32 bits.
INVALID, TOO_LARGE = -1, U32_MAX + 1


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value worked out once however often `then` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _after(text: Column, dot: Column) -> Column:
    return F.when(dot > 0, F.substring(text, dot + 1, F.length(text))).otherwise(F.lit(""))


def decimals_of(text: Column) -> Column:
    """Digits after the first dot without trailing zeros."""
    return F.length(F.rtrim(_after(text, F.instr(text, ".")), F.lit("0")))


def mantissa_at(text: Column, scale: Column) -> Column:
    """text * 10^scale, further decimals cut off; INVALID or TOO_LARGE where there is none. Decimals beyond scale aren't
    looked at."""

    def of_dot(dot: Column) -> Column:
        whole = F.when(dot > 0, F.substring(text, F.lit(1), dot - 1)).otherwise(text)
        return F.concat(whole, F.rpad(F.substring(_after(text, dot), F.lit(1), scale), scale, F.lit("0")))

    def of_digits(digits: Column) -> Column:
        valid = (text != "") & digits.rlike(r"\A[0-9]*\z")
        return F.when(F.coalesce(~valid, F.lit(True)), F.lit(INVALID).cast("bigint")).otherwise(let(F.ltrim(digits, F.lit("0")), of_significant))

    def of_significant(digits: Column) -> Column:
        number = F.concat(F.lit("0"), digits).try_cast("bigint")
        return F.when(F.length(digits) > 10, F.lit(TOO_LARGE).cast("bigint")).otherwise(F.least(number, F.lit(TOO_LARGE)))

    return let(let(F.instr(text, "."), of_dot), of_digits)


def _at(texts: Column, scale: Column) -> Column:
    return F.transform(texts, lambda t: mantissa_at(t, scale))


def _first_bad(mantissas: Column) -> Column:
    return F.get(F.filter(mantissas, lambda m: (m == INVALID) | (m == TOO_LARGE)), F.lit(0))


def encode_group(texts: Column) -> Column:
    """struct(status, scale, mantissas) of an array of texts. status is ok, bad_number or scale_overflow; scale and mantissas
    are null unless ok.

    Nearly all groups fit at once; only others, behind a CASE branch, try all lower scales.
    """

    def of_top(top: Column) -> Column:
        return let(_at(texts, top), lambda m: F.when(_first_bad(m).isNull(), _struct(OK, top, m)).otherwise(lowered(top)))

    def lowered(top: Column) -> Column:
        tries = F.transform(F.sequence(top, F.lit(0), F.lit(-1)), lambda s: let(_at(texts, s), lambda m: F.struct(s.alias("scale"), m.alias("m"), _first_bad(m).alias("bad"))))
        decided = F.get(F.filter(tries, lambda t: F.coalesce(t["bad"] != TOO_LARGE, F.lit(True))), F.lit(0))
        return let(decided, lambda t: F.when(t.isNull(), _struct(SCALE_OVERFLOW, None, None)).when(t["bad"] == INVALID, _struct(BAD_NUMBER, None, None)).otherwise(_struct(OK, t["scale"], t["m"])))

    return let(F.coalesce(F.array_max(F.transform(texts, decimals_of)), F.lit(0)), of_top)


def _struct(status: str, scale: Column | None, mantissas: Column | None) -> Column:
    none = F.lit(None)
    return F.struct(
        F.lit(status).alias("status"),
        (none if scale is None else scale).cast("int").alias("scale"),
        (none if mantissas is None else mantissas).cast("array<bigint>").alias("mantissas"),
    )


def to_decimal(mantissa: Column, scale: Column) -> Column:
    """The decimal text of a mantissa: 6884 at scale 2 is 68.84."""
    digits = F.lpad(mantissa.cast("string"), F.greatest(F.length(mantissa.cast("string")), scale + 1), F.lit("0"))
    whole = F.substring(digits, F.lit(1), F.length(digits) - scale)
    return F.when(scale == 0, mantissa.cast("string")).otherwise(F.concat(whole, F.lit("."), F.substring(digits, F.length(digits) - scale + 1, scale)))


def to_i64(text: Column) -> Column:
    """A signed 64-bit integer that is the whole text: no blanks, no plus; else null."""
    return F.when(text.rlike(r"\A-?[0-9]+\z"), text.try_cast("bigint"))


def to_u64(text: Column) -> Column:
    """An unsigned 64-bit integer, as decimal(20,0), that is the whole text; else null."""
    number = F.when(text.rlike(r"\A[0-9]+\z"), F.concat(F.lit("0"), F.ltrim(text, F.lit("0"))).try_cast("decimal(20,0)"))
    return F.when(number <= F.lit("18446744073709551615").cast("decimal(20,0)"), number)
