"""Text functions: ids from urls, fields out of page text, codes and prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwright.functions._util import as_col

# Patterns for profile fields found in page text.
RECRUIT_YEAR_PATTERN = r"Recruiting Rank:\s*([0-9]{4})"
RECRUIT_RANK_PATTERN = r"Recruiting Rank:.*?\(([0-9]+)\)"
HEIGHT_PATTERN = r"\b([4-7])-([0-9]{1,2})\b"
WEIGHT_PATTERN = r"(?i)\b([0-9]{2,3})\s*lb"
# Accepted position codes; the first is the dummy baseline.
POSITION_CODES = ("PG", "SG", "SF", "PF", "C")
UNKNOWN_CODE = "UNK"


def extract_or_null(c, pattern: str, group: int = 1) -> Column:
    """First regex group, or null when the pattern does not match."""
    return F.nullif(F.regexp_extract(as_col(c), pattern, group), F.lit(""))


def url_id(url, pattern: str, group: int = 1) -> Column:
    """Id parsed out of a url by a regex group; null when absent."""
    return extract_or_null(url, pattern, group)


def recruiting_year(text) -> Column:
    return extract_or_null(text, RECRUIT_YEAR_PATTERN).cast("int")


def recruiting_rank(text) -> Column:
    return extract_or_null(text, RECRUIT_RANK_PATTERN).cast("int")


def height_inches(text) -> Column:
    """``6-10`` -> 82.0; only the first match counts and inches must be <= 11."""
    feet = extract_or_null(text, HEIGHT_PATTERN, 1).cast("int")
    inch = extract_or_null(text, HEIGHT_PATTERN, 2).cast("int")
    return F.when(inch <= 11, (feet * 12 + inch).cast("double"))


def weight_lb(text) -> Column:
    return extract_or_null(text, WEIGHT_PATTERN).cast("double")


def position_code(pos, valid=POSITION_CODES, unknown: str = UNKNOWN_CODE) -> Column:
    """Upper, trim, first token split on ``-``, ``/`` or ``,``; unknown if not valid."""
    first = F.trim(F.split(F.upper(F.trim(as_col(pos))), "[-/,]").getItem(0))
    return F.when(first.isin(*valid), first).otherwise(F.lit(unknown))


def dummies(code, levels, prefix: str) -> list[Column]:
    """0/1 double columns, one per level (the omitted level is the baseline)."""
    c = F.coalesce(as_col(code), F.lit(UNKNOWN_CODE))
    return [(c == F.lit(lv)).cast("double").alias(f"{prefix}{lv}") for lv in levels]


def strip_prefixes(name, prefixes) -> Column:
    """Remove the first listed prefix that matches (list order wins)."""
    out = None
    col = as_col(name)
    for p in prefixes:
        cond = col.startswith(p)
        stripped = F.substring(col, len(p) + 1, 1 << 30)
        out = F.when(cond, stripped) if out is None else out.when(cond, stripped)
    return col if out is None else out.otherwise(col)


def url_join(base: str, rel) -> Column:
    """Absolute link from a page-relative href (root-relative, scheme-relative or absolute)."""
    r = as_col(rel)
    scheme = base.split("://", 1)[0]
    root = base.split("://", 1)[0] + "://" + base.split("://", 1)[1].split("/", 1)[0]
    directory = base.rsplit("/", 1)[0] + "/" if base.count("/") > 2 else root + "/"
    return (
        F.when(r.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), r)
        .when(r.startswith("//"), F.concat(F.lit(scheme + ":"), r))
        .when(r.startswith("/"), F.concat(F.lit(root), r))
        .otherwise(F.concat(F.lit(directory), r))
    )


def url_join_col(base, rel) -> Column:
    """``url_join`` with a per-row base url (scheme-relative, root-relative, relative or absolute)."""
    b, r = as_col(base), as_col(rel)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    root = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    directory = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^?#]*/)", 1)
    return (
        F.when(r.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), r)
        .when(r.startswith("//"), F.concat(scheme, F.lit(":"), r))
        .when(r.startswith("/"), F.concat(root, r))
        .otherwise(F.concat(F.when(directory == "", F.concat(root, F.lit("/"))).otherwise(directory), r))
    )


def contains_text(c, needle: str) -> Column:
    """Substring test with null -> false."""
    return F.coalesce(as_col(c).contains(needle), F.lit(False))


def blank_to_null(c) -> Column:
    """Whitespace-only strings become null."""
    s = as_col(c)
    return F.when(~s.rlike(r"^\s*$"), s)
