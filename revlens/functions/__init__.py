"""Column-level functions (JVM expressions only, no Python UDFs).

Each function takes and returns ``Column`` objects so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Season labels of the fiscal rule, indexed 1..4 by ((month % 12 + 2) div 3) % 4 + 1.
FISCAL_SEASONS = ["Winter", "Spring", "Summer", "Autumn"]
# Meteorological seasons by month.
METEOROLOGICAL_SEASONS = {
    "Winter": [12, 1, 2],
    "Spring": [3, 4, 5],
    "Summer": [6, 7, 8],
    "Autumn": [9, 10, 11],
}
# Accepted sales channels.
SALES_CHANNELS = ["B2B", "B2C", "B2B2C"]
# Distribution centre of each German state; every other value (and null) -> Brandenburg.
DISTRIBUTION_CENTRES = {
    "Baden-Württemberg": ["Baden-Württemberg", "Saarland"],
    "Nordrhein-Westfalen": ["Nordrhein-Westfalen", "Hessen", "Niedersachsen", "Bremen",
                            "Hamburg", "Rheinland-Pfalz", "Schleswig-Holstein"],
    "Bayern": ["Bayern", "Sachsen", "Thüringen", "Sachsen-Anhalt"],
}
DEFAULT_CENTRE = "Brandenburg"
# The sixteen German states.
STATES = ["Baden-Württemberg", "Bayern", "Berlin", "Brandenburg", "Bremen", "Hamburg", "Hessen", "Mecklenburg-Vorpommern",
          "Niedersachsen", "Nordrhein-Westfalen", "Rheinland-Pfalz", "Saarland", "Sachsen", "Sachsen-Anhalt",
          "Schleswig-Holstein", "Thüringen"]
# States set by hand for four postal codes whose state stays unknown.
STATE_OVERRIDES = {
    "69966": "Baden-Württemberg",
    "08312": "Sachsen",
    "40002": "Nordrhein-Westfalen",
    "07801": "Thüringen",
}
# Search radius of the nearest-postal-code state lookup.
NEAREST_CODE_RADIUS = 200

# Money columns carry at most four decimals (two-decimal price times
# two-decimal discount); summing them as this decimal is exact.
MONEY_TYPE = "decimal(18,4)"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- dates -----------------------------------------------------------------

def parse_yyyymmdd(c) -> Column:
    """YYYYMMDD integer or text -> date; invalid values become null (ANSI safe)."""
    return F.expr("try_to_date(cast({} as string), 'yyyyMMdd')".format(_sql(c)))


def week_start(c) -> Column:
    """Label of the right-closed week (Mon, Mon] containing ``c``: the left Monday.

    A Monday belongs to the week that ends on it, so its label is the Monday
    before; every other day is labelled by the Monday on or before it.
    """
    return F.to_date(F.date_trunc("week", F.date_sub(F.to_date(col_(c)), 1)))


def days_since(reference_date: str, c) -> Column:
    """Whole days from ``c`` to a fixed reference date (never ``current_date``)."""
    return F.datediff(F.lit(reference_date).cast("date"), F.to_date(col_(c)))


def year_range(c, year: int) -> Column:
    """``year(c) == year`` written as a range so it reaches the parquet scan."""
    c = col_(c)
    return (c >= F.lit(f"{year}-01-01").cast("date")) & (c < F.lit(f"{year + 1}-01-01").cast("date"))


# --- derived categorical columns -------------------------------------------

def season_fiscal(date_col) -> Column:
    """Jan–Mar Spring, Apr–Jun Summer, Jul–Sep Autumn, Oct–Dec Winter."""
    m = F.month(col_(date_col))
    idx = (F.floor((m % 12 + 2) / 3) % 4 + 1).cast("int")
    return F.element_at(F.array(*[F.lit(s) for s in FISCAL_SEASONS]), idx)


def season_meteorological(date_col) -> Column:
    """Dec–Feb Winter, Mar–May Spring, Jun–Aug Summer, Sep–Nov Autumn, else Unknown."""
    m = F.month(col_(date_col))
    out = None
    for name, months in METEOROLOGICAL_SEASONS.items():
        out = (F.when(m.isin(months), F.lit(name)) if out is None
               else out.when(m.isin(months), F.lit(name)))
    return out.otherwise(F.lit("Unknown"))


def sales_channel(category) -> Column:
    """Part of the channel category before the first underscore."""
    return F.substring_index(col_(category), "_", 1)


def distribution_center(state) -> Column:
    s = col_(state)
    out = None
    for centre, states in DISTRIBUTION_CENTRES.items():
        out = (F.when(s.isin(states), F.lit(centre)) if out is None
               else out.when(s.isin(states), F.lit(centre)))
    return out.otherwise(F.lit(DEFAULT_CENTRE))


# --- strings ---------------------------------------------------------------

def similarity(a, b) -> Column:
    """Case-folded normalised Levenshtein similarity in [0, 1]."""
    a, b = F.lower(col_(a)), F.lower(col_(b))
    longest = F.greatest(F.length(a), F.length(b), F.lit(1))
    return F.lit(1.0) - F.levenshtein(a, b) / longest


def first_part(c, sep: str) -> Column:
    return F.substring_index(col_(c), sep, 1)


def format_percent(c, decimals: int = 2) -> Column:
    return F.format_string(f"%.{decimals}f%%", col_(c))


def pad_postal(c) -> Column:
    """Postal code as text of five characters at least (leading zeros kept, longer codes left whole)."""
    s = col_(c).cast("string")
    return F.when(F.length(s) < 5, F.lpad(s, 5, "0")).otherwise(s)


# --- numbers ---------------------------------------------------------------

def money(c) -> Column:
    return col_(c).cast(MONEY_TYPE)


def money_sum(c) -> Column:
    """Exact sum of a money column, returned as double."""
    return F.sum(money(c)).cast("double")


def coerce_double(c) -> Column:
    """Text or number -> double; failures become null."""
    return F.expr("try_cast({} as double)".format(_sql(c)))


def nan_to_null(c) -> Column:
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def zero_to_null_rounded(c, scale: int = 2) -> Column:
    """null -> 0, round half-even, 0 -> null."""
    r = F.bround(F.coalesce(col_(c).cast("double"), F.lit(0.0)), scale)
    return F.when(r == 0, F.lit(None).cast("double")).otherwise(r)


def null_where_equal(actual, predicted) -> Column:
    """``actual`` unless it equals ``predicted`` (NULL-safe, NaN already nulled)."""
    a = col_(actual)
    return F.when(a == col_(predicted), F.lit(None).cast("double")).otherwise(a)


def attach_row(df, one_row):
    """Add the columns of a one-row frame (totals, parameters) to every row.

    Joined on a constant with the one-row side broadcast.  Catalyst folds the
    constant away and plans a nested-loop join: one build row, so every row is met once.
    """
    key = "__one"
    return (df.withColumn(key, F.lit(1))
              .join(F.broadcast(one_row.withColumn(key, F.lit(1))), key).drop(key))


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name for SQL-expression helpers")
