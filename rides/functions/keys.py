"""Deterministic surrogate keys."""

from pyspark.sql import Column

from rides.functions._util import as_sql, expr

# The placeholder for NULL parts and the separator between
# parts, as used by the common SQL surrogate-key macro (md5 of the parts).
NULL_PART = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key_sql(*cols) -> str:
    """md5 hex of the text form of the parts, NULLs replaced, joined by '-'."""
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    parts = [f"coalesce(cast(({as_sql(c)}) as string), '{NULL_PART}')" for c in cols]
    text = parts[0] if len(parts) == 1 else f"concat_ws('{SEPARATOR}', {', '.join(parts)})"
    return f"md5({text})"


def surrogate_key(*cols) -> Column:
    return expr(surrogate_key_sql(*cols))
