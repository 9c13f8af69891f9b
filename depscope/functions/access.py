"""Access semantics: read or write, allowed or denied, kind of object."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..model import (
    ALLOWED_WORDS, DENIED_WORDS, FLAT_WRITE_WORDS, READ_WORDS, SERVICE_OBJECT_TYPES,
    WRITE_FRAGMENTS, WRITE_WORDS,
)
from .text import col, or_empty, strip


def infer_op(access: Column | str, action: Column | str) -> Column:
    """READ or WRITE from the access type and action words; READ when in doubt."""
    access = strip(F.lower(or_empty(access)))
    action = strip(F.lower(or_empty(action)))
    fragment = access.rlike("|".join(WRITE_FRAGMENTS))
    return (
        F.when(access.isin(WRITE_WORDS) | action.isin(WRITE_WORDS), "WRITE")
        .when(access.isin(READ_WORDS) | action.isin(READ_WORDS), "READ")
        .when(fragment, "WRITE")
        .otherwise("READ")
    )


def infer_op_flat(access: Column | str) -> Column:
    """Variant of the Parquet tables: access type only, shorter word list."""
    return F.when(F.lower(col(access)).isin(FLAT_WRITE_WORDS), "WRITE").otherwise("READ")


def normalize_result(c: Column | str) -> Column:
    text = strip(or_empty(c))
    return (
        F.when(text.isin(ALLOWED_WORDS), "ALLOWED")
        .when(text.isin(DENIED_WORDS), "DENIED")
        .otherwise(F.left(text, F.lit(64)))
    )


def object_type(service: Column | str) -> Column:
    low = F.lower(or_empty(service))
    found = F.coalesce(*[
        F.when(low.contains(word), kind) for word, kind in SERVICE_OBJECT_TYPES.items()])
    return F.coalesce(found, F.lit("unknown"))


def job_to_app_id(c: Column | str) -> Column:
    """``job_1_2`` to ``application_1_2``; other ids stay."""
    c = col(c)
    return F.when(
        c.startswith("job_"), F.concat(F.lit("application_"), F.substr(c, F.lit(5)))
    ).otherwise(c)
