"""Null-safe scalar expressions.

Every function takes SQL expression text and returns SQL expression text, for ``selectExpr``,
``where`` and ``F.expr``: a projection of a hundred formulas is then one call to Spark instead of
thousands of column calls. Division by zero, unparsable text and NaN all become NULL, the only
"unknown" this library has (ANSI mode would raise instead).
"""

from __future__ import annotations

from tickloom import schema

# Shapes of a landed date: 2001-06-30, 2001/06/30 and 20010630.
LANDED_DATE = "^[0-9]{4}(?:-[0-9]{1,2}-|/[0-9]{1,2}/)[0-9]{1,2}$|^[0-9]{8}$"
DATE_PARTS = "^([0-9]{4})[-/]?([0-9]{1,2})[-/]?([0-9]{1,2})$"


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """A column name quoted for use in an expression."""
    return "`" + column.replace("`", "``") + "`"


def num(x: str) -> str:
    """Double, with NaN turned into NULL so that aggregates skip it."""
    return f"nanvl(double({x}), NULL)"


def parse_num(x: str) -> str:
    """Text to double; anything that is not a number is NULL.

    Text without a digit never reaches the cast: a failed one costs an exception inside Spark.
    """
    text = f"trim(string({x}))"
    return f"nanvl(if({text} RLIKE '[0-9]', try_cast({text} AS double), NULL), NULL)"


def parse_date(x: str) -> str:
    """Text to date in any of the three landed formats; anything else is NULL.

    The text is named once only, so an expensive expression behind it is evaluated once.
    """
    shaped = f"regexp_extract(trim(string({x})), '{LANDED_DATE}', 0)"
    return f"try_cast(regexp_replace({shaped}, '{DATE_PARTS}', '$1-$2-$3') AS date)"


def clean_text(x: str) -> str:
    return f"trim(coalesce(string({x}), ''))"


def ndiv(a: str, b: str) -> str:
    """a / b, NULL when b is zero or either side is NULL."""
    return f"try_divide({a}, {b})"


def pct(a: str, b: str) -> str:
    return f"(try_divide({a}, {b}) * 100)"


def rounded(x: str, digits: int = 4) -> str:
    """A double rounded half up by its binary value, scaled first, as SQL engines with binary rounding do.

    ``round(x, digits)`` rounds the shortest decimal text of a double instead, and differs where a quotient lies on a tie.
    """
    return f"(round({x} * 1e{digits}) / 1e{digits})"


def ratio4(a: str, b: str, scale: int = 1) -> str:
    """A ratio rounded to four digits, the precision all stored ratios share."""
    quotient = f"try_divide({num(a)}, {num(b)})"
    return rounded(quotient if scale == 1 else f"{quotient} * {scale}")


def positive(x: str) -> str:
    """The value if it is above zero, else NULL."""
    return f"if({x} > 0, {x}, NULL)"


def non_zero(x: str) -> str:
    return f"if({x} != 0, {x}, NULL)"


def floor_at_zero(x: str) -> str:
    """max(x, 0) that keeps NULL (``greatest`` alone would skip it)."""
    return f"if({x} < 0, 0D, {x})"


def settle(x: str, digits: int = 4) -> str:
    """Round by explicit arithmetic, with ties nudged up.

    Summation order moves a double by an ulp; two engines then round an exact tie apart. The nudge
    keeps the step well clear of such ties.
    """
    return f"(floor(double({x}) * 1e{digits} + 0.500001D) / 1e{digits})"


def to_decimal(x: str, digits: int, scale: int) -> str:
    """``try_cast`` of a double to a decimal, for a fraction of what it costs.

    Spark takes a double's decimal text. Unless the text lies next to a tie, where it decides, the nearest whole number of
    units is the same; all values near ties, and those that hardly fit, are cast.
    """
    units = f"({x} * 1e{scale}D)"
    whole = f"try_cast(try_cast(rint({units}) AS bigint) AS decimal(18,0))"  # shorter code than one that can fail
    near = f"try_cast({whole} * cast('1e-{scale}' AS decimal({scale},{scale})) AS decimal({digits},{scale}))"
    sure = f"abs({units}) < 1e{min(digits - 1, 10)}D AND abs({units} - rint({units})) < 0.499D"
    return f"if({sure}, {near}, try_cast({x} AS decimal({digits},{scale})))"


def decimal4(x: str) -> str:
    """A double settled to four digits and stored as decimal(10,4)."""
    units = f"cast(floor(double({x}) * 1e4 + 0.500001D) AS decimal(18,0))"
    return f"cast({units} * cast('0.0001' AS decimal(5,4)) AS decimal(10,4))"


# --- instrument codes -------------------------------------------------------------------------


def to_symbol(bare: str) -> str:
    """'600519' -> 'sh600519', '000858' -> 'sz000858'."""
    code = f"trim(string({bare}))"
    return f"concat(if({code} rlike '{schema.SHANGHAI_PREFIX}', 'sh', 'sz'), {code})"


def bare_code(symbol: str) -> str:
    return f"substring({symbol}, 3)"


def to_dotted(symbol: str) -> str:
    """'sh600519' -> 'sh.600519'."""
    return f"concat(left({symbol}, 2), '.', substring({symbol}, 3))"


def from_dotted(code: str) -> str:
    """'sh.600519' -> 'sh600519' (first dot only)."""
    return f"regexp_replace({code}, '^([^.]*)[.]', '$1')"


def to_upper_symbol(symbol: str) -> str:
    """'sh600519' -> 'SH600519'."""
    return f"upper({symbol})"


def to_market_id(symbol: str) -> str:
    """'sh600519' -> '1.600519', everything else -> '0.…'."""
    return f"concat(if(startswith({symbol}, 'sh'), '1.', '0.'), substring({symbol}, 3))"


def is_fund(symbol: str) -> str:
    return f"({symbol} rlike '{schema.FUND_PATTERN}')"


# --- fiscal calendar --------------------------------------------------------------------------


def quarter_end(year: str, quarter: str) -> str:
    return f"last_day(make_date({year}, ({quarter}) * 3, 1))"


def quarter_type(report_date: str) -> str:
    """Q1, Q2, Q3 or FY by calendar month."""
    names = ", ".join(f"'{n}'" for n in schema.QUARTER_TYPES)
    return f"element_at(array({names}), quarter({report_date}))"


def first_number(*columns: str) -> str:
    """First candidate that parses as a number, in the given order."""
    return f"coalesce({', '.join(parse_num(c) for c in columns)})"
