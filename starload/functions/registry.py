"""Functions by name: the ones a UDF mapping may call, and their SQL versions."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, SparkSession, functions as F

from starload.functions import library as lib
from starload.spec import SpecError

Function = Callable[..., Column]

# The function names that mappings use.
# name -> (Column function, SQL signature, SQL body or None where SQL has no version of it)
_LIBRARY: dict[str, tuple[Function, str, str | None]] = {
    "udf_calculate_age": (
        lib.calculate_age, "dob DATE, as_of DATE RETURNS INT",
        "CASE WHEN dob <= as_of THEN year(as_of) - year(dob)"
        " - int(month(as_of) * 100 + day(as_of) < month(dob) * 100 + day(dob))"
        " WHEN dob > as_of THEN year(as_of) - year(dob)"
        " + int(month(as_of) * 100 + day(as_of) > month(dob) * 100 + day(dob)) END"),
    "udf_full_name": (
        lib.full_name, "first_name STRING, last_name STRING RETURNS STRING",
        "trim(coalesce(first_name, '') || ' ' || coalesce(last_name, ''))"),
    "udf_clean_email": (
        lib.clean_email, "email STRING RETURNS STRING", "nullif(lower(trim(email)), '')"),
    "udf_clean_phone": (
        lib.clean_phone, "phone STRING RETURNS STRING", "nullif(regexp_replace(phone, '[^0-9]', ''), '')"),
    "udf_flag_to_boolean": (
        lib.flag_to_boolean, "flag STRING RETURNS BOOLEAN",
        "CASE upper(trim(flag)) WHEN 'Y' THEN true WHEN 'N' THEN false END"),
    "udf_parse_date": (
        lib.parse_date, "text STRING RETURNS DATE", f"try_to_date(trim(text), '{lib.DATE_FORMAT}')"),
    "udf_parse_time": (
        lib.parse_time, "text STRING RETURNS STRING",
        f"CASE WHEN trim(text) RLIKE '{lib.TIME_PATTERN}' THEN"
        " lpad(if(length(trim(text)) <= 5, trim(text) || ':00', trim(text)), 8, '0') END"),
    "udf_calculate_patient_bk": (
        lib.business_key, "id STRING RETURNS STRING", "id"),
    "udf_calculate_doctor_bk": (
        lib.business_key, "id STRING, license STRING RETURNS STRING",
        f"id || '{lib.PART_SEPARATOR}' || license"),
    "udf_generate_dk": (
        lib.domain_key, "bk STRING, ts TIMESTAMP_NTZ RETURNS STRING",
        f"md5(bk || '{lib.PART_SEPARATOR}' || substring(string(ts), 1, 19) || '.'"
        " || rpad(substring(string(ts), 21, 6), 6, '0'))"),
    "udf_hashdiff": (lib.hashdiff, "", None),
    "udf_text_hash": (
        lib.text_hash, "text STRING RETURNS STRING", f"'{lib.TEXT_HASH_PREFIX}' || sha2(text, 256)"),
    "udf_key_uuid": (lib.key_uuid, "", None),
}


class FunctionRegistry:
    """Resolves function names of UDF mappings; users add their own next to the library."""

    def __init__(self, functions: Mapping[str, Function] | None = None) -> None:
        self._functions = {name: entry[0] for name, entry in _LIBRARY.items()}
        self._functions.update({k.lower(): v for k, v in (functions or {}).items()})

    def add(self, name: str, function: Function) -> None:
        self._functions[name.lower()] = function

    def __contains__(self, name: str) -> bool:
        return name.lower() in self._functions

    def call(self, name: str, *args: Column) -> Column:
        """The named function applied; a name without a body here must be a SQL function."""
        function = self._functions.get(name.lower())
        return function(*args) if function else F.call_function(name, *args)


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the library as temporary SQL functions, for use in EXPRESSION text.

    Catalyst inlines their bodies, so a call costs the same as the expression.
    """
    created = []
    for name, (_, signature, body) in _LIBRARY.items():
        if body is not None:
            create_sql_function(spark, name, signature, body)
            created.append(name)
    return created


def create_sql_function(spark: SparkSession, name: str, signature: str, body: str) -> None:
    """One SQL-bodied function; `signature` is 'a TYPE, b TYPE RETURNS TYPE'."""
    if not re.fullmatch(r"\w+", name):
        raise SpecError(f"not a function name: {name!r}")
    if not body or not body.strip():
        raise SpecError(f"{name}: a signature without a body; calls of it would fail")
    arguments, _, returns = signature.partition("RETURNS")
    escaped = body.replace("\\", "\\\\")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments.strip()})"
              f" RETURNS {returns.strip()} RETURN {escaped}")
