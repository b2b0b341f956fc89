"""Column expressions: numbers, text repair, dates and buckets. All run inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, functions as F

from tillwise.schema import MONEY

__all__ = [
    "bucketize", "cents", "clip_fill", "day_name", "digits_only", "dollars",
    "label_at", "line_total", "money", "month_index",
    "month_start", "null_outside", "parse_date", "parse_money", "ratio", "repair_email",
    "round_half", "standardise", "title_case", "trim_upper", "try_int", "week_number",
    "year_month",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- numbers -----------------------------------------------------------------------------

def money(c: Column | str) -> Column:
    return _col(c).cast(MONEY)


def cents(c: Column | str) -> Column:
    """Money as whole cents, BIGINT: sums of it are exact, order-free and stay in codegen."""
    return (_col(c) * 100).cast("bigint")


def dollars(c: Column | str) -> Column:
    """Cents back to a DOUBLE amount, for results."""
    return _col(c).cast("double") / 100.0


def round_half(c: Column | str, places: int = 2) -> Column:
    """Round a DOUBLE half away from zero, on the scaled binary value."""
    factor = float(10 ** places)
    return F.round(_col(c).cast("double") * factor) / factor


def ratio(
    num: Column | str, den: Column | str, scale: float = 1.0, places: int | None = None,
    default: float | None = None,
) -> Column:
    """``num / den * scale`` as DOUBLE; NULL (or ``default``) where ``den`` is 0 or NULL."""
    value = _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))
    if scale != 1.0:
        value = value * scale
    if places is not None:
        value = round_half(value, places)
    return value if default is None else F.coalesce(value, F.lit(default))


def line_total(qty: Column | str, price: Column | str, disc: Column | str) -> Column:
    """``round(qty * price * (1 - disc), 2)`` in exact decimals."""
    return F.round(_col(qty) * _col(price) * (F.lit(1) - _col(disc)), 2).cast(MONEY)


def clip_fill(c: Column | str, lo: float, hi: float, fill: float) -> Column:
    """Clip to [lo, hi]; NULL becomes ``fill`` (``greatest`` alone would skip the NULL)."""
    c = _col(c)
    return F.when(c.isNull(), F.lit(fill)).otherwise(F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def try_int(c: Column | str, kind: str = "bigint") -> Column:
    """Integer from text, NULL where it is none; ``12.0`` counts as 12, on a slower path."""
    c = _col(c)
    return F.coalesce(c.try_cast(kind), c.try_cast("decimal(38,6)").try_cast(kind))


def parse_money(c: Column | str) -> Column:
    """Drop every character but digits and dots, then read as money; NULL where unreadable."""
    return F.regexp_replace(_col(c), "[^0-9.]", "").try_cast(MONEY)


def bucketize(c: Column | str, bounds: Sequence, labels: Sequence[str]) -> Column:
    """First label whose bound is >= the value; the last label takes the rest and NULL."""
    c = _col(c)
    chain = F.when(c <= F.lit(bounds[0]), labels[0])
    for bound, label in zip(bounds[1:], labels[1:]):
        chain = chain.when(c <= F.lit(bound), label)
    return chain.otherwise(labels[-1])


# --- text --------------------------------------------------------------------------------

def title_case(c: Column | str, parity: bool = False) -> Column:
    """Trimmed title case.

    ``parity=True`` restarts after every non-letter (``O'Neil``, ``Men'S``, ``Non-Fiction``);
    the default capitalises after blanks only.
    """
    text = F.trim(_col(c))
    if not parity:
        return F.initcap(text)
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def trim_upper(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c)))


def repair_email(c: Column | str, loose: bool = False) -> Column:
    """Spell out AT / DOT as ``@`` / ``.``, lower, trim; NULL where still no address.

    By default AT and DOT must stand as words; ``loose`` also repairs ``joeATmailDOTcom``.
    """
    at, dot = (r"AT", r"DOT") if loose else (r"\bAT\b", r"\bDOT\b")
    fixed = F.regexp_replace(_col(c), at, "@")
    fixed = F.trim(F.lower(F.regexp_replace(fixed, dot, ".")))
    return F.when(fixed.rlike(r"^[^@]+@[^@]+\.[^@]+$"), fixed)


def digits_only(c: Column | str, min_len: int = 7) -> Column:
    digits = F.regexp_replace(_col(c), "[^0-9]", "")
    return F.when(F.length(digits) >= min_len, digits)


def standardise(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace known spellings; leave every other value as it is."""
    c = _col(c)
    lookup = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.element_at(lookup, c), c)


def null_outside(c: Column | str, domain: Iterable[str]) -> Column:
    c = _col(c)
    return F.when(c.isin(*domain), c)


# --- dates -------------------------------------------------------------------------------

def parse_date(c: Column | str, formats: Sequence[str]) -> Column:
    """DATE by the first layout that fits, NULL when none does (also under ANSI)."""
    c = F.trim(_col(c))
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("date") for f in formats])


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "month")


def year_month(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def month_index(later: Column | str, earlier: Column | str) -> Column:
    """Whole calendar months between two dates."""
    later, earlier = _col(later), _col(earlier)
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def label_at(c: Column | str, labels: Sequence[str]) -> Column:
    """The label at a position counted from 0, as ``weekday`` does from Monday on."""
    return F.element_at(F.array(*[F.lit(x) for x in labels]), _col(c) + 1)


def day_name(c: Column | str) -> Column:
    return F.date_format(_col(c), "EEEE")


def week_number(c: Column | str) -> Column:
    """Week of the year; weeks start on Sunday and 1 January is in week 1."""
    c = _col(c)
    lead = F.dayofweek(F.trunc(c, "year")) - 1
    return (F.floor((F.dayofyear(c) - 1 + lead) / 7) + 1).cast("int")
