"""Column expressions shared by batch and streaming operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Col = Column | str


def col(c: Col) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: Col) -> Column:
    return col(c).cast("double")


def dsum(c: Col) -> Column:
    """Exact decimal sum, shown as a double."""
    return F.sum(col(c)).cast("double")


def davg(c: Col) -> Column:
    return F.sum(col(c)).cast("double") / F.count(col(c))


def dstd(c: Col) -> Column:
    """Sample standard deviation from exact sums: the same value in whatever order rows arrive."""
    x = col(c)
    n, s = F.count(x), F.sum(x).cast("double")
    sq = F.sum((x * x).cast("decimal(38,4)")).cast("double")
    return F.when(n > 1, F.sqrt(F.greatest((sq - s * s / n) / F.nullif(n - 1, F.lit(0)), F.lit(0.0))))


def ratio(num: Col, den: Col, scale: float = 1.0) -> Column:
    """``num * scale / den``, NULL where the denominator is zero."""
    return dbl(num) * F.lit(scale) / F.nullif(dbl(den), F.lit(0.0))


def pct(num: Col, den: Col) -> Column:
    return ratio(num, den, 100.0)


def sum_if(cond: Column, value: Col) -> Column:
    return F.coalesce(F.sum(F.when(cond, col(value))).cast("double"), F.lit(0.0))


def band(value: Column, steps: Sequence[tuple[float, str]], default: str, inclusive: bool = False) -> Column:
    """The label of the first step whose limit the value exceeds (or reaches)."""
    out = None
    for limit, label in steps:
        hit = value >= limit if inclusive else value > limit
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def standardize(column: str, groups: dict[str, Sequence[str]], default: str) -> Column:
    """Map raw codes, whatever their case and padding, to one name per group."""
    raw = f"upper(trim(`{column}`))"
    cases = " ".join(f"WHEN {raw} IN ({', '.join(repr(c) for c in codes)}) THEN '{name}'" for name, codes in groups.items())
    return F.expr(f"CASE {cases} ELSE '{default}' END")


def weekend(c: Col) -> Column:
    return F.dayofweek(col(c)).isin(1, 7)


def time_bucket_label(ts: Col) -> Column:
    h = F.hour(col(ts))
    return F.when(h.between(6, 11), "MORNING").when(h.between(12, 17), "AFTERNOON").when(h.between(18, 22), "EVENING").otherwise("NIGHT")


def epoch(ts: Col) -> Column:
    """Whole seconds of wall-clock time since 1970, whatever the session zone."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", start, col(ts).cast("timestamp_ntz"))


def minutes_between(start: Col, end: Col) -> Column:
    return F.floor((epoch(end) - epoch(start)) / 60)


def key_hash(*cols: Col) -> Column:
    """Surrogate key: md5 of one part (NULL stays NULL), or of several parts, each with its length before it and
    NULL as ``-``, so that different part lists never have the same text."""
    return F.md5(col(cols[0]).cast("string")) if len(cols) == 1 else row_hash(*cols)


def row_hash(*cols: Col) -> Column:
    """md5 of a row's content, never NULL: each part with its length before it, NULL as ``-``, any number of columns."""
    text = lambda c: col(c).cast("string")
    return F.md5(F.concat(F.lit(""), *[F.coalesce(F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("-")) for c in cols]))


def valid_email(c: Col) -> Column:
    return F.trim(col(c)).rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$")


def valid_phone(c: Col) -> Column:
    return col(c).rlike("^[0-9]{10,15}$")


def emi(principal: Col, annual_rate: Col, months: Col) -> Column:
    """Instalment of an annuity loan; ``annual_rate`` in percent."""
    r = dbl(annual_rate) / 1200.0
    growth = F.pow(F.lit(1.0) + r, dbl(months))
    return F.when(r == 0, dbl(principal) / dbl(months)).otherwise(dbl(principal) * r * growth / F.nullif(growth - 1.0, F.lit(0.0)))


def parse_dates(c: Col, formats: Sequence[str] = ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MMM-yyyy")) -> Column:
    """First format that fits; NULL if none does."""
    return F.coalesce(*[F.try_to_date(col(c), f) if hasattr(F, "try_to_date") else F.to_date(col(c), f) for f in formats])


def split_name(c: Col) -> tuple[Column, Column]:
    parts = F.split(F.trim(col(c)), " ")
    return F.element_at(parts, 1), F.element_at(parts, -1)


# --- masking -----------------------------------------------------------------------------
def mask_card(c: Col) -> Column:
    return F.concat(F.lit("XXXX-XXXX-XXXX-"), F.right(col(c), F.lit(4)))


def mask_tail(c: Col, visible: int = 4, fill: str = "X") -> Column:
    """The last characters in clear; a value no longer than those is masked whole, with the same width for all."""
    x = col(c).cast("string")
    masked = F.concat(F.repeat(F.lit(fill), F.length(x) - visible), F.right(x, F.lit(visible)))
    return F.when(F.length(x) <= visible, F.lit(fill * visible)).otherwise(masked)


def mask_email(c: Col) -> Column:
    """Two characters of the user and the domain; a user of up to two characters is masked whole."""
    x = F.trim(col(c))
    at = F.locate("@", x)
    shown = F.when(at > 3, F.left(x, F.lit(2))).otherwise(F.lit(""))
    return F.when(at > 0, F.concat(shown, F.lit("***"), F.substr(x, at))).otherwise(F.lit("***"))


def mask_name(c: Col) -> Column:
    """The first letter in clear; a name of one letter is masked."""
    x = F.trim(col(c))
    return F.when(F.length(x) <= 1, F.lit("*")).otherwise(F.concat(F.left(x, F.lit(1)), F.repeat(F.lit("*"), F.length(x) - 1)))
