"""Column expressions for labels, keys, packed values and per-row arithmetic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

WHITESPACE = " \t\r\n\f\x0b"

# Labels that mean "no label" after trimming and upper-casing.
MISSING_LABELS = ("", "NA", "N/A", "NONE", "NULL", "NAN", "<NA>")
UNASSIGNED = "Unassigned"

# Occupancy classes in display order.
CLASS_ORDER = ("Core", "Soft-core", "Shell", "Cloud")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of ASCII white space, not only blanks."""
    return F.trim(as_col(c), F.lit(WHITESPACE))


def is_missing_label(c: Column | str) -> Column:
    c = as_col(c)
    return c.isNull() | F.upper(strip(c)).isin(*MISSING_LABELS)


def label_or(c: Column | str, missing: str = UNASSIGNED) -> Column:
    """Trimmed label; missing ones become ``missing`` and stay countable."""
    c = as_col(c).cast("string")
    return F.when(is_missing_label(c), F.lit(missing)).otherwise(strip(c))


def label_or_null(c: Column | str) -> Column:
    """Trimmed label; missing ones become NULL so that they can be excluded and counted."""
    c = as_col(c).cast("string")
    return F.when(~is_missing_label(c), strip(c))


def split_multi(c: Column | str) -> Column:
    """``a; b,c`` -> array(a, b, c); NULL, empty and ``NA`` cells -> empty array."""
    text = strip(as_col(c).cast("string"))
    items = F.transform(F.split(F.translate(text, ";", ","), ","), strip)
    kept = F.filter(items, lambda item: item != "")
    empty = text.isNull() | (F.upper(text) == "NA")
    return F.when(empty, F.array().cast("array<string>")).otherwise(kept)


def pack_sorted(c: Column | str, separator: str = ";") -> Column:
    """Aggregate: sorted distinct values joined into one cell, NULL when there are none."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(as_col(c))), separator), F.lit(""))


def safe_fraction(numerator: Column | str, denominator: Column | str) -> Column:
    """Ratio as double; NULL for a zero or missing denominator."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def number_or_null(c: Column | str) -> Column:
    """Numeric coercion: text that is no number becomes NULL."""
    return strip(as_col(c).cast("string")).try_cast("double")


def numbers_of(df: DataFrame, column: str) -> Column:
    """Column as double: numbers are cast, text is parsed with bad text as NULL."""
    field = df.schema[column].dataType
    return F.col(column).cast("double") if isinstance(field, NumericType) else number_or_null(column)


def number_strict(c: Column | str) -> Column:
    """Numeric coercion: text that is no number fails the job; NULL stays NULL."""
    c = as_col(c)
    parsed = number_or_null(c)
    message = F.concat(F.lit("not a number: "), c.cast("string"))
    return F.when(c.isNull() | parsed.isNotNull(), parsed).otherwise(F.raise_error(message).cast("double"))


def stable_key(unit: Column | str, item: Column | str, separator: str = "__") -> Column:
    return F.concat(as_col(unit).cast("string"), F.lit(separator), as_col(item).cast("string"))


def key_unit(key: Column | str, separator: str = "__", default: Column | None = None) -> Column:
    """Part before the first separator; ``default`` (or NULL) when there is no separator."""
    key = as_col(key)
    fallback = F.lit(None).cast("string") if default is None else default
    return F.when(F.contains(key, F.lit(separator)), F.substring_index(key, separator, 1)).otherwise(fallback)


def key_item(key: Column | str, separator: str = "__") -> Column:
    """Part after the first separator; the whole key when there is none."""
    key = as_col(key)
    after = F.substr(key, F.instr(key, separator) + F.lit(len(separator)))
    return F.when(F.contains(key, F.lit(separator)), after).otherwise(key)


def cell_id(dimensions: Sequence[str]) -> Column:
    """``dim=value|dim=value`` for the given columns."""
    return F.concat_ws("|", *[F.concat(F.lit(f"{name}="), F.col(name)) for name in dimensions])


def pair_stratum(left: Column | str, right: Column | str) -> Column:
    """Shared label of a pair, ``Mixed`` when the ends differ, ``Unassigned`` when one has none."""
    a, b = label_or(left), label_or(right)
    return (
        F.when((a == UNASSIGNED) | (b == UNASSIGNED), F.lit(UNASSIGNED)).when(a == b, a).otherwise(F.lit("Mixed"))
    )


def is_finite(c: Column | str) -> Column:
    c = as_col(c).cast("double")
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def ratio_or_infinity(numerator: Column | str, denominator: Column | str) -> Column:
    n, d = as_col(numerator).cast("double"), as_col(denominator).cast("double")
    return F.when(d == 0, F.lit(float("inf"))).otherwise(F.try_divide(n, d))


def substitution_flags(ks: Column | str, ratio: Column | str, saturation: float) -> Column:
    """Quality flags of a Ka/Ks estimate joined by ``;``, ``PASS`` when there is none."""
    ks, ratio = as_col(ks), as_col(ratio)
    flags = F.concat_ws(
        ";",
        F.when(ks == 0, F.lit("KS_ZERO")),
        F.when(ks >= F.lit(saturation), F.lit("POTENTIAL_SATURATION")),
        F.when(~is_finite(ratio), F.lit("RATIO_NON_FINITE")),
    )
    return F.coalesce(F.nullif(flags, F.lit("")), F.lit("PASS"))


def occupancy_class(fraction: Column | str, core: float = 0.99, soft: float = 0.90, shell: float = 0.10) -> Column:
    if not 0 <= shell <= soft <= core <= 1:
        raise ValueError("thresholds must satisfy 0 <= shell <= soft <= core <= 1")
    f = as_col(fraction)
    return (
        F.when(f >= F.lit(core), F.lit(CLASS_ORDER[0]))
        .when(f >= F.lit(soft), F.lit(CLASS_ORDER[1]))
        .when(f >= F.lit(shell), F.lit(CLASS_ORDER[2]))
        .otherwise(F.lit(CLASS_ORDER[3]))
    )


def log2_plus_one(c: Column | str) -> Column:
    return F.log2(as_col(c) + F.lit(1.0))


def closed_length(start: Column | str, end: Column | str) -> Column:
    """Length of a 1-based closed interval."""
    return as_col(end) - as_col(start) + F.lit(1)


def midpoint(start: Column | str, end: Column | str) -> Column:
    return (as_col(start).cast("double") + as_col(end).cast("double")) / F.lit(2.0)


def resolve_column(columns: Sequence[str], aliases: Sequence[str], required: bool = True) -> str | None:
    """First alias present among ``columns``; case-insensitive, blanks equal underscores."""

    def normal(name: str) -> str:
        return name.strip().lower().replace(" ", "_")

    by_name: Mapping[str, str] = {normal(c): c for c in columns}
    found = next((by_name[normal(a)] for a in aliases if normal(a) in by_name), None)
    if found is None and required:
        raise ValueError("none of these columns exist: " + ", ".join(aliases))
    return found
