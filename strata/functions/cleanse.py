"""Column-level cleansing rules of the silver layer.

Every rule is a function ``Column -> Column`` built from JVM-side expressions,
so it stays inside whole-stage codegen and runs as a narrow map.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import AMOUNT, PRICE

UNKNOWN = "n/a"

# Fixed code tables of the source systems (values must stay exactly as written).
MARITAL_CODES = {"S": "Single", "M": "Married"}
GENDER_CODES = {"F": "Female", "M": "Male"}
GENDER_SPELLINGS = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
PRODUCT_LINE_CODES = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRY_CODES = {"DE": "Germany", "US": "United States", "USA": "United States"}
ERP_ID_PREFIX = "NAS"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_date(as_of=None) -> Column:
    """The 'today' of a run: a fixed date for reproducible runs, else current_date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.date):
        as_of = as_of.isoformat()
    return F.lit(as_of).cast("date")


def normalized(c) -> Column:
    """``upper(trim(x))`` — the comparison form of a code."""
    return F.upper(F.trim(_col(c)))


def decode(c, mapping: Mapping[str, str], default: str | None = UNKNOWN, *,
           normalize: bool = True, passthrough: bool = False, blank_to: str | None = None) -> Column:
    """Translate a code through ``mapping``.

    normalize   compare ``upper(trim(x))`` (else ``trim(x)``, case kept)
    passthrough unknown values come out trimmed instead of ``default``
    blank_to    value for NULL or blanks-only input, checked before the mapping
    A NULL input never matches a code, so it takes ``default`` (or ``blank_to``).
    """
    src = _col(c)
    key = normalized(src) if normalize else F.trim(src)
    out = None
    if blank_to is not None:
        out = F.when(src.isNull() | (F.trim(src) == ""), F.lit(blank_to))
    for code, label in mapping.items():
        out = F.when(key == code, F.lit(label)) if out is None else out.when(key == code, F.lit(label))
    fallback = F.trim(src) if passthrough else F.lit(default)
    return out.otherwise(fallback) if out is not None else fallback


def blank_to_null(c) -> Column:
    """The source has no empty strings: an empty result is NULL."""
    return F.nullif(_col(c), F.lit(""))


def trim_text(c) -> Column:
    return blank_to_null(F.trim(_col(c)))


def null_to(c, value) -> Column:
    return F.coalesce(_col(c), F.lit(value))


def strip_prefix(c, prefix: str = ERP_ID_PREFIX) -> Column:
    """Drop a case-sensitive leading prefix; other values unchanged."""
    src = _col(c)
    return blank_to_null(F.when(src.startswith(prefix), F.substr(src, F.lit(len(prefix) + 1))).otherwise(src))


def remove_chars(c, chars: str = "-") -> Column:
    return blank_to_null(F.replace(_col(c), F.lit(chars), F.lit("")))


def key_category(c, width: int = 5) -> Column:
    """Category id of a compound product key: first chars, '-' → '_'."""
    return blank_to_null(F.replace(F.substring(_col(c), 1, width), F.lit("-"), F.lit("_")))


def key_number(c, start: int = 7) -> Column:
    """Product number of a compound product key: everything from ``start`` on."""
    return blank_to_null(F.substr(_col(c), F.lit(start)))


def int_to_date(c, strict: bool = False) -> Column:
    """yyyymmdd integer → date; 0, negative or not 8 digits → NULL.

    An 8-digit value that is not a calendar date gives NULL, or raises with
    ``strict=True`` (the load then fails as a whole).  A cast reads the ISO form faster
    than a pattern parser does.
    """
    v = _col(c)
    text, eight = v.cast("string"), v.between(10000000, 99999999)
    if strict:
        return F.when(eight, F.to_date(text, "yyyyMMdd"))
    iso = F.concat(F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2), F.lit("-"), F.substring(text, 7, 2))
    return F.when(eight, iso.try_cast("date"))


def future_to_null(c, as_of=None) -> Column:
    v = _col(c)
    return F.when(v > as_of_date(as_of), F.lit(None)).otherwise(v)


def repair_amount(sales, qty, price) -> Column:
    """Sales amount = quantity × |price| when missing, not positive or inconsistent."""
    s, q, p = _col(sales), _col(qty), _col(price)
    derived = q * F.abs(p)
    return F.when(s.isNull() | (s <= 0) | (s != derived), derived).otherwise(s).cast(AMOUNT)


def repair_price(sales, qty, price) -> Column:
    """Price = raw sales / quantity when missing or not positive (NULL if qty is 0)."""
    s, q, p = _col(sales), _col(qty), _col(price)
    derived = F.when(q.isNotNull() & (q != 0), F.coalesce(s, F.lit(0).cast(AMOUNT)) / q)
    return F.when(p.isNull() | (p <= 0), derived).otherwise(p).cast(PRICE)


def coalesce_sources(primary, fallback, unknown: str = UNKNOWN) -> Column:
    """Master-source rule: primary unless unknown/NULL, else fallback, else unknown."""
    p, f = _col(primary), _col(fallback)
    return F.when(p != unknown, p).otherwise(F.coalesce(f, F.lit(unknown)))


def full_name(first, last) -> Column:
    """first || ' ' || last where a NULL side counts as empty text."""
    return F.concat(F.coalesce(_col(first), F.lit("")), F.lit(" "), F.coalesce(_col(last), F.lit("")))


def untrimmed(c) -> Column:
    v = _col(c)
    return v != F.trim(v)


def any_of(conds: Iterable[Column]) -> Column:
    out = None
    for c in conds:
        out = c if out is None else (out | c)
    return out if out is not None else F.lit(False)
