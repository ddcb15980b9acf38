"""Null-safe ratios, scaling and ages as column expressions."""

from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def round_even(c, n=0):
    """Round half to even on the scaled value, the way numpy does."""
    scale = float(10 ** n)
    return F.rint(_col(c) * scale) / scale if n else F.rint(_col(c))


def text_number(c, dtype="double"):
    """Text to a number, null if it does not start like one (a failed cast is costly)."""
    return F.when(_col(c).rlike(r"^\s*[-+]?[0-9.]"), _col(c).try_cast(dtype))


def safe_div(a, b, n=4):
    """a / b, null if either side is null or b is zero, rounded half-even."""
    return round_even(F.try_divide(_col(a).cast("double"), _col(b).cast("double")), n)


def norm01(c, lo, hi):
    """Min-max scale with hand-set bounds, clipped to [0, 1]; 0 if the bounds meet."""
    if lo == hi:
        return F.when(_col(c).isNotNull(), F.lit(0.0))
    return clip((_col(c) - float(lo)) / (float(hi) - float(lo)), 0.0, 1.0)


def clip(c, lo, hi):
    return F.when(_col(c).isNotNull(),
                  F.least(F.greatest(_col(c), F.lit(float(lo))), F.lit(float(hi))))


def per90(cols, minutes="MinutesPlayed", rounded=True):
    """Columns ``<c>Per90``.  Players use the factor rounded to 4 places, teams the raw one."""
    m = F.col(minutes).cast("double")
    factor = safe_div(F.lit(90.0), m) if rounded else F.try_divide(F.lit(90.0), m)
    return [(F.col(c).cast("double") * factor).alias(c + "Per90") for c in cols]


def age(birth, as_of):
    """Age in years of 365.25 days."""
    return F.datediff(F.lit(as_of).cast("date"), _col(birth)) / 365.25


def age_whole(birth, as_of):
    """Whole years of 365 days."""
    return F.floor(F.datediff(F.lit(as_of).cast("date"), _col(birth)) / 365.0)


# Upper age and its share of remaining potential.
AGE_CURVE = [(18, 1.00), (20, 0.90), (22, 0.80), (24, 0.65), (26, 0.45), (29, 0.25), (31, 0.10)]


def age_potential(a):
    """Step curve from 1.0 for the youngest to 0.0 above 31; 0.5 if unknown."""
    expr = F.when(_col(a).isNull(), F.lit(0.5))
    for limit, value in AGE_CURVE:
        expr = expr.when(_col(a) <= limit, F.lit(value))
    return expr.otherwise(F.lit(0.0))


def season_start(as_of):
    """First day of August of the season: from September on this year's, else last year's."""
    d = F.lit(as_of).cast("date")
    year = F.year(d) - F.when(F.month(d) >= 9, 0).otherwise(1)
    return F.make_date(year, F.lit(8), F.lit(1))
