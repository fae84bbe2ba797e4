"""Scalar Column expressions: keys, hash order, text pieces and the inverse normal CDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hex digits of an md5 that fit a double exactly: 13 * 4 = 52 bits.
UNIFORM_DIGITS = 13


def hash_key(seed, *keys) -> Column:
    """md5 over ``seed|key|...``: the deterministic random order behind every split and draw."""
    parts = [F.lit(str(seed))] + [F.coalesce(_col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def hash_uniform(hash_col) -> Column:
    """The first 52 bits of a hex hash as a number in [0, 1)."""
    digits = F.substring(_col(hash_col), 1, UNIFORM_DIGITS)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(16**UNIFORM_DIGITS))


def sigmoid(margin) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(margin)))


def clip(value, low: float, high: float) -> Column:
    """Clamp to [low, high]; null stays null (``least``/``greatest`` alone would drop it)."""
    c = _col(value)
    return F.when(c.isNull(), c).otherwise(F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def first_token_upper(text) -> Column:
    """Upper-cased first whitespace-separated token; empty for blank or null text."""
    return F.split(F.trim(F.upper(F.coalesce(_col(text), F.lit(""))), F.lit(" \t\r\n\f\v")), r"\s+").getItem(0)


def int_list(text, sep: str = "-") -> Column:
    """``"64-32"`` -> ``[64, 32]``."""
    return F.transform(F.split(_col(text), sep), lambda part: part.cast("int"))


def preview(text, width: int = 45) -> Column:
    return F.substring(_col(text), 1, width)


def ceil_div(value, step: int) -> Column:
    return F.ceil(_col(value) / F.lit(step)).cast("long")


# Rational approximation of the inverse normal CDF (Acklam), relative error < 1.15e-9.
PROBIT_CENTRE_NUM = (
    -3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
    1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00,
)
PROBIT_CENTRE_DEN = (
    -5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
    6.680131188771972e01, -1.328068155288572e01, 1.0,
)
PROBIT_TAIL_NUM = (
    -7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
    -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00,
)
PROBIT_TAIL_DEN = (
    7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0,
)
PROBIT_TAIL = 0.02425


def _horner(coefs, x: Column) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def probit_argument(p) -> Column:
    """What the rational functions of :func:`probit` take: of the tail that ``p`` lies in, or of the centre."""
    p = _col(p)

    def tail(share: Column) -> Column:
        return F.sqrt(F.lit(-2.0) * F.log(share))

    centre = (p - 0.5) * (p - 0.5)
    return F.when(p < PROBIT_TAIL, tail(p)).when(p > 1.0 - PROBIT_TAIL, tail(F.lit(1.0) - p)).otherwise(centre)


def probit(p, argument=None) -> Column:
    """Inverse normal CDF for 0 < p < 1, as codegen-friendly arithmetic.

    ``argument`` names a column that holds :func:`probit_argument`. It stands in the formula twenty times: without a column of its
    own, or with the result used more than once, the generated method is too long for the JVM to compile.
    """
    p = _col(p)
    x = probit_argument(p) if argument is None else _col(argument)
    centre = _horner(PROBIT_CENTRE_NUM, x) * (p - 0.5) / _horner(PROBIT_CENTRE_DEN, x)
    tail = _horner(PROBIT_TAIL_NUM, x) / _horner(PROBIT_TAIL_DEN, x)
    return F.when(p < PROBIT_TAIL, tail).when(p > 1.0 - PROBIT_TAIL, -tail).otherwise(centre)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
