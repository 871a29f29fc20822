"""Number and label text, as column expressions (no UDF).

Two formatting conventions must be reproduced:

- report text (``{:,.0f}``, ``{:.1f}``, ``{:.1%}``): thousands separators and
  round-half-even on the exact binary value, which is what ``format_number``
  does;
- viewer text (``Intl.NumberFormat("en-US", maximumFractionDigits=d)``):
  round-half-away-from-zero on the exact binary value and no trailing
  zeros. The two roundings differ only on exact binary ties (for one
  decimal: fractions .25 and .75), which are detected exactly by scaling
  with powers of two and nudged away from zero before ``format_number``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DASH = "—"
DOT = " · "


def fixed_text(x: Column, digits: int) -> Column:
    """Python ``format(x, ',.{digits}f')``."""
    return F.format_number(x, digits)


def money_text(x: Column) -> Column:
    """Python ``f'${x:,.0f}'`` (a negative amount reads ``$-25``)."""
    return F.concat(F.lit("$"), F.format_number(x, 0))


def percent_text(x: Column) -> Column:
    """Python ``f'{x:.1%}'``."""
    return F.concat(F.format_number(x * 100, 1), F.lit("%"))


def _half_away(x: Column, digits: int) -> Column:
    """``x`` moved off an exact tie at ``digits`` decimals, away from zero."""
    up, down = float(2 ** (digits + 1)), float(2 ** digits)
    tie = (F.floor(x * up) == x * up) & (F.floor(x * down) != x * down)
    nudge = F.signum(x) * F.lit(2.0 ** -(digits + 3))
    return F.when(tie, x + nudge).otherwise(x)


def js_number(x: Column, digits: int = 0) -> Column:
    """``Intl.NumberFormat('en-US', {maximumFractionDigits: digits})``; null
    reads as a dash."""
    text = F.format_number(_half_away(x.cast("double"), digits), digits)
    if digits > 0:
        text = F.regexp_replace(F.regexp_replace(text, r"0+$", ""), r"\.$", "")
    return F.when(x.isNull(), F.lit(DASH)).otherwise(text)


def js_currency(x: Column, digits: int = 0) -> Column:
    """US-dollar currency text, whole dollars: ``$1,234``, ``-$25``."""
    v = x.cast("double")
    body = js_number(F.abs(v), digits)
    return (F.when(x.isNull(), F.lit(DASH))
            .when(v < 0, F.concat(F.lit("-$"), body))
            .otherwise(F.concat(F.lit("$"), body)))


def title_case(x: Column) -> Column:
    """Underscores to spaces, each word capitalised; empty reads as a dash.

    Only first letters change: ``SMB`` stays ``SMB``."""
    words = F.split(F.replace(x, F.lit("_"), F.lit(" ")), " ")
    raised = F.transform(words, lambda w: F.concat(
        F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30)))
    return F.when(x.isNull() | (x == ""), F.lit(DASH)).otherwise(F.array_join(raised, " "))


def risk_label(band: Column) -> Column:
    return F.when(band == "already_churned", F.lit("Already churned")).otherwise(title_case(band))


def _js_double_text(x: Column) -> Column:
    """Shortest round-trip digits of a double in the viewer's notation.

    Spark prints the same digits as the viewer, but in ``d.dddE<n>``
    notation below 1e-3 and from 1e7 up, where the viewer writes plain
    decimals (it uses an exponent only below 1e-6 or from 1e21)."""
    text = x.cast("string")
    pattern = r"^(-?)(\d)\.(\d+)E(-?\d+)$"
    sign = F.regexp_extract(text, pattern, 1)
    lead = F.regexp_extract(text, pattern, 2)
    rest = F.regexp_extract(text, pattern, 3)
    rest = F.when(rest == "0", F.lit("")).otherwise(rest)
    exp = F.regexp_extract(text, pattern, 4).cast("int")
    digits = F.concat(lead, rest)
    width = F.length(rest)
    mantissa = F.concat(lead, F.when(rest == "", F.lit("")).otherwise(F.concat(F.lit("."), rest)))
    below_one = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    above_one = F.when(width <= exp, F.concat(sign, digits, F.repeat(F.lit("0"), exp - width))) \
        .otherwise(F.concat(sign, lead, rest.substr(F.lit(1), exp), F.lit("."),
                            rest.substr(exp + 1, width)))
    return (F.when(~text.contains("E"), text)
            .when(exp < -6, F.concat(sign, mantissa, F.lit("e-"), (-exp).cast("string")))
            .when(exp < 0, below_one)
            .when(exp >= 21, F.concat(sign, mantissa, F.lit("e+"), exp.cast("string")))
            .otherwise(above_one))


def js_string(x: Column, type_name: str) -> Column:
    """``String(value)`` of the viewer for one field; missing is empty.

    Whole doubles print without a fraction (``100``, not ``100.0``); other
    doubles print their shortest round-trip digits in plain notation."""
    if type_name == "double":
        whole = (x == F.floor(x)) & (F.abs(x) < F.lit(1e15))
        text = F.when(whole, x.cast("bigint").cast("string")).otherwise(_js_double_text(x))
    else:
        text = x.cast("string")
    return F.coalesce(text, F.lit(""))
