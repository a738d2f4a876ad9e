"""Scalar column functions (all built-in Spark expressions, no Python UDF)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronoset.schemas import FILE_NAME_PATTERN, OPEN_END_SQL, RAW_TS_FORMAT, RAW_TS_REGEX


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_date_text(name, pattern: str = FILE_NAME_PATTERN) -> Column:
    """Date text captured from a file name; '' when the name does not match."""
    return F.regexp_extract(_c(name), pattern, 1)


def file_date(name, pattern: str = FILE_NAME_PATTERN) -> Column:
    """Date captured from a file name, NULL when it does not match."""
    txt = file_date_text(name, pattern)
    return F.when(txt != "", txt.try_cast("date"))


def file_name_for(date_col, template_prefix: str = "transactions_", suffix: str = ".json") -> Column:
    """`transactions_YYYY-MM-DD.json` for a date column."""
    return F.concat(F.lit(template_prefix), F.date_format(_c(date_col), "yyyy-MM-dd"), F.lit(suffix))


def base_name(path) -> Column:
    """Last path segment."""
    return F.regexp_extract(_c(path), r"([^/]+)$", 1)


def parse_raw_timestamp(txt) -> Column:
    """Strict `yyyy-MM-ddTHH:mm:ssZ` text to TIMESTAMP_NTZ, NULL when malformed.

    The written wall clock is kept whatever the session time zone is: the
    shape is checked by regex, then the text without its `Z` is cast to the
    zone-less timestamp type.
    """
    t = _c(txt)
    return F.when(t.rlike(RAW_TS_REGEX), F.substring(t, 1, 19).try_cast("timestamp_ntz"))


def format_timestamp(ts, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(_c(ts), fmt)


def raw_timestamp_text(ts) -> Column:
    """Timestamp to the raw feed's text layout."""
    return F.date_format(_c(ts), RAW_TS_FORMAT)


def parse_date(txt) -> Column:
    """Text to DATE; NULL for malformed text instead of an error under ANSI."""
    t = _c(txt)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t.try_cast("date"))


def date_of_raw_timestamp(txt) -> Column:
    """Calendar date as written in the raw text (zone independent)."""
    return F.to_date(parse_raw_timestamp(txt))


def amount_decimal(txt, precision: int = 18, scale: int = 2) -> Column:
    """Text amount to DECIMAL; 'nan', junk and NULL give NULL."""
    return _c(txt).cast("string").try_cast(f"decimal({precision},{scale})")


def amount_class(txt) -> Column:
    """Label of the planted amount fault classes."""
    t = _c(txt)
    num = amount_decimal(t)
    return (
        F.when(t.isNull(), F.lit("null"))
        .when(num.isNull(), F.lit("not_numeric"))
        .when(num == 0, F.lit("zero"))
        .when(num < 0, F.lit("negative"))
        .otherwise(F.lit("positive"))
    )


def open_end() -> Column:
    return F.lit(OPEN_END_SQL).cast("date")


def date_list(start, end) -> Column:
    """Inclusive list of dates; empty when start > end or a bound is NULL.

    `sequence` would count backwards for start > end, hence the guard.
    """
    s, e = _c(start), _c(end)
    return F.when(s <= e, F.sequence(s, e, F.expr("interval 1 day"))).otherwise(F.array().cast("array<date>"))


def hash_order(seed: str, *cols) -> Column:
    """Reproducible pseudo-random order: md5 of seed and the given columns; a NULL counts as empty text."""
    return F.md5(F.concat(F.lit(seed), *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]))


def null_safe_changed(a_cols: list, b_cols: list) -> Column:
    """True when any attribute differs, NULL compared as a value."""
    return reduce(lambda x, y: x | y, [~_c(a).eqNullSafe(_c(b)) for a, b in zip(a_cols, b_cols)])


def three_valued_changed(a_cols: list, b_cols: list) -> Column:
    """OR of `a <> b`: NULL on either side is unknown, not a change."""
    return reduce(lambda x, y: x | y, [_c(a) != _c(b) for a, b in zip(a_cols, b_cols)])
