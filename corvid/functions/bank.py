"""Column functions for bank transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvid.functions.text import py_strip

# The ten target categories.
CATEGORIES = ["Transport", "Food", "Shopping", "Transfer", "Bills", "Entertainment",
              "Health", "Education", "Subscriptions", "Other"]
# Portuguese month abbreviations, January first.
PT_MONTHS = ["jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"]
EN_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
PROMPT_PREFIX = "Normalize this bank transaction: "


def clean_text(c: Column) -> Column:
    """Whitespace of any kind -> one space, special characters dropped,
    trimmed; empty -> NULL."""
    s = F.regexp_replace(c, "[\\s\\u00a0]+", " ")
    s = F.regexp_replace(s, "[^\\p{L}\\p{N} *.,&/-]", "")
    s = F.regexp_replace(s, " +", " ")
    s = F.trim(s)
    return F.when(F.length(s) > 0, s)


def match_key(c: Column) -> Column:
    """Leading alphanumeric run of the upper-cased text."""
    return F.regexp_extract(F.upper(c), "^([A-Z0-9]+)", 1)


def month_number(text: Column) -> Column:
    """1-12 from a Portuguese or English abbreviation, else NULL."""
    found = [F.array_position(F.array(*[F.lit(m) for m in names]), F.lower(text))
             for names in (PT_MONTHS, EN_MONTHS)]
    return F.coalesce(*[F.when(i > 0, i) for i in found])


def parse_date(s: Column, fmt: str, default_year: Column | None = None) -> Column:
    """X13 for one pattern. Year-less patterns take ``default_year``; ``MMM``
    reads Portuguese or English month abbreviations. Text that does not fit the
    pattern, however malformed, gives NULL."""
    s = py_strip(s)
    if "MMM" in fmt:
        sep = fmt.replace("d", "").replace("M", "").replace("y", "")[:1] or "/"
        parts = F.split(s, "[" + sep + "]")
        order = sorted("dMy", key=lambda c: fmt.find(c) if c in fmt else len(fmt))
        of = {c: F.get(parts, order.index(c)) for c in order}
        year = of["y"] if "y" in fmt else default_year.cast("string")
        txt = F.concat_ws("-", year, month_number(of["M"]).cast("string"), of["d"])
        fits = (F.size(parts) == (3 if "y" in fmt else 2)) & month_number(of["M"]).isNotNull()
        return F.when(fits, F.try_to_date(txt, "yyyy-M-d"))
    if "y" not in fmt:
        return F.try_to_date(F.concat(default_year.cast("string"), F.lit("-"), s),
                             "yyyy-" + fmt)
    return F.try_to_date(s, fmt)


def normalize_date(s: Column, formats: Sequence[str], default_year: Column | None = None) -> Column:
    """First pattern that parses wins; result as ISO ``yyyy-MM-dd`` text."""
    d = F.coalesce(*[parse_date(s, f, default_year) for f in formats])
    return F.date_format(d, "yyyy-MM-dd")


def parse_amount(s: Column, decimal_mark: str = ".", thousands: str | None = None) -> Column:
    """Text -> signed double, or NULL when the **whole** text is not one
    amount in the bank's style.

    Accepted: an optional currency mark, a hyphen or U+2212 minus before or
    after it, or parentheses around the amount (negative), digits plain or in
    thousands groups, and an optional decimal part.
    """
    t = F.regexp_replace(py_strip(s), "\u2212", "-")
    bracketed = t.rlike(r"^\(.*\)$")
    t = F.when(bracketed, F.regexp_replace(t, r"^\(\s*|\s*\)$", "")).otherwise(t)
    groups = rf"\d{{1,3}}(?:[{thousands}]\d{{3}})+|" if thousands else ""
    pattern = rf"^(-?)\s*(?:[A-Z]{{0,3}}[$€£])?\s*(-?)\s*((?:{groups}\d+)(?:[{decimal_mark}]\d+)?)$"
    number = F.regexp_extract(t, pattern, 3)
    if thousands:
        number = F.regexp_replace(number, f"[{thousands}]", "")
    if decimal_mark != ".":
        number = F.regexp_replace(number, f"[{decimal_mark}]", ".")
    signs = (bracketed.cast("int") + F.length(F.regexp_extract(t, pattern, 1))
             + F.length(F.regexp_extract(t, pattern, 2)))
    value = number.try_cast("double")
    return F.when(t.rlike(pattern) & (signs <= 1), F.when(signs == 1, -value).otherwise(value))


def format_amount(x: Column, decimal_mark: str = ".", thousands: str | None = None,
                  prefix: str = "") -> Column:
    """Render a double with two decimals in a bank's style."""
    if thousands:
        s = F.format_number(x, 2)  # 1,234.56
        s = F.translate(s, ",.", thousands + decimal_mark)
    else:
        s = F.format_string("%.2f", x)
        if decimal_mark != ".":
            s = F.translate(s, ".", decimal_mark)
    return F.concat(F.lit(prefix), s) if prefix else s


def category_check(c: Column) -> Column:
    """One of the ten names, else ``Other``."""
    return F.when(c.isin(CATEGORIES), c).otherwise(F.lit("Other"))


def format_row(names: Sequence[str], values: Sequence[Column]) -> Column:
    """``Normalize this bank transaction: Name: value, Name: value, ...``."""
    pairs = [F.concat(F.lit(n + ": "), F.coalesce(v, F.lit(""))) for n, v in zip(names, values)]
    return F.concat(F.lit(PROMPT_PREFIX), F.concat_ws(", ", *pairs))
