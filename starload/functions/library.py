"""Scalar functions of the load library, as Column expressions.

All of them stay inside the JVM.  Where only the name of a function is known to
users of such loads, the docstring marks the semantics as chosen here.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F

# Fixed values.
PART_SEPARATOR = "|"
NULL_MARKER = "\\N"
TEXT_HASH_PREFIX = "sha256:"
DATE_FORMAT = "yyyy-MM-dd"
TIME_PATTERN = r"^([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?$"
UUID_PATTERN = r"^(.{8})(.{4})(.{4})(.{4})(.{12})$"
UUID_LAYOUT = "$1-$2-$3-$4-$5"


def calculate_age(dob: Column, as_of: Column | datetime.date | str) -> Column:
    """Whole years from dob to as_of, truncated towards zero; NULL stays NULL.

    A birthday on 29 February is reached on 1 March of a common year.
    """
    day = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    born = dob.cast("date")
    month_day = lambda c: F.month(c) * 100 + F.dayofmonth(c)
    years = F.year(day) - F.year(born)
    ahead = F.when(month_day(day) < month_day(born), 1).otherwise(0)
    behind = F.when(month_day(day) > month_day(born), 1).otherwise(0)
    return F.when(born <= day, years - ahead).when(born > day, years + behind).cast("int")


def full_name(first: Column, last: Column) -> Column:
    """Both names joined by one blank, outer blanks removed, NULL read as ''."""
    return F.trim(F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit(""))))


def clean_email(email: Column) -> Column:
    """Lower case without outer blanks; empty becomes NULL (semantics chosen here)."""
    return F.nullif(F.lower(F.trim(email)), F.lit(""))


def clean_phone(phone: Column) -> Column:
    """The digits only, country codes kept; none becomes NULL (semantics chosen here)."""
    return F.nullif(F.regexp_replace(phone, "[^0-9]", ""), F.lit(""))


def flag_to_boolean(flag: Column) -> Column:
    """Y/N in any case to true/false, anything else to NULL (semantics chosen here)."""
    return yes_no(flag, "Y", "N")


def yes_no(flag: Column, yes: str, no: str) -> Column:
    """flag_to_boolean for other letters than Y and N."""
    letter = F.upper(F.trim(flag))
    return F.when(letter == yes.upper(), F.lit(True)).when(letter == no.upper(), F.lit(False))


def parse_date(text: Column) -> Column:
    """ISO date text to DATE; text that is no date becomes NULL (semantics chosen here)."""
    return F.try_to_date(F.trim(text), DATE_FORMAT)


def parse_time(text: Column) -> Column:
    """Clock text to an HH:mm:ss string; anything else becomes NULL (semantics chosen here)."""
    clock = F.trim(text)
    padded = F.lpad(F.when(F.length(clock) <= 5, F.concat(clock, F.lit(":00"))).otherwise(clock), 8, "0")
    return F.when(clock.rlike(TIME_PATTERN), padded)


def business_key(*parts: Column) -> Column:
    """The parts as text joined by '|'; NULL when any part is NULL."""
    texts = [p.cast("string") for p in parts]
    joined = [texts[0]]
    for t in texts[1:]:
        joined += [F.lit(PART_SEPARATOR), t]
    return F.concat(*joined) if len(joined) > 1 else joined[0]


def domain_key(bk: Column, version_ts: Column) -> Column:
    """md5 of a business key and the timestamp of its version (semantics chosen here)."""
    return F.md5(F.concat(bk, F.lit(PART_SEPARATOR), timestamp_text(version_ts)))


def timestamp_text(ts: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss.ffffff', whatever the time zone of the session."""
    text = ts.cast("timestamp_ntz").cast("string")
    return F.concat(F.substring(text, 1, 19), F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"))


def hashdiff(*columns: Column) -> Column:
    """md5 over all columns; NULL counts as a value of its own (semantics chosen here).

    A separator or backslash inside a value is escaped, so that values cannot
    move from one column to the next unnoticed.  Floating point columns should
    be cast to a decimal first, because the text of a double is not the same in
    every engine.
    """
    return F.md5(F.concat_ws(PART_SEPARATOR, *[_escaped(c.cast("string")) for c in columns]))


def _escaped(text: Column) -> Column:
    special = text.contains(PART_SEPARATOR) | text.contains("\\")
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")),
                        F.lit(PART_SEPARATOR), F.lit("\\" + PART_SEPARATOR))
    return F.when(special, escaped).otherwise(F.coalesce(text, F.lit(NULL_MARKER)))


def text_hash(text: Column) -> Column:
    """'sha256:' and the hex SHA-256 of the text."""
    return F.concat(F.lit(TEXT_HASH_PREFIX), F.sha2(text, 256))


def key_uuid(*parts: Column) -> Column:
    """UUID-shaped text made from a business key, the same on every run."""
    return F.regexp_replace(F.md5(business_key(*parts)), UUID_PATTERN, UUID_LAYOUT)
