"""Catalog entities, table descriptions and projects."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..model import RAW_JSON_LIMIT, STORAGE_WORDS, STRICT_STORAGE_WORDS, TYPE_SERVICES
from .text import col, first_present, joined_parts, or_empty, present, strip
from .times import safe_ts


def pick_qualified_name(entity: Column | str) -> Column:
    e = col(entity)
    return or_empty(first_present(e["attributes"]["qualifiedName"],
                                  e["uniqueAttributes"]["qualifiedName"]))


def pick_owner(entity: Column | str) -> Column:
    e = col(entity)
    return or_empty(first_present(e["attributes"]["owner"], e["attributes"]["createdBy"]))


def pick_name(entity: Column | str) -> Column:
    e = col(entity)
    return F.coalesce(
        first_present(e["attributes"]["name"], e["attributes"]["displayText"],
                      pick_qualified_name(e)),
        e["guid"])


def type_to_service(c: Column | str) -> Column:
    """Service of a catalog type: the known ones, else the part before ``_``."""
    c = or_empty(c)
    known = F.coalesce(*[F.when(c == name, service) for name, service in TYPE_SERVICES.items()])
    return F.coalesce(
        known, F.when(c.contains("_"), F.substring_index(c, "_", 1)), F.lit("unknown"))


def json_trim(record: Column | str, n: int = RAW_JSON_LIMIT) -> Column:
    return F.substring(F.to_json(col(record)), 1, n)


def _first_word(text: Column, words: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(text.contains(word), name) for word, name in words.items()])


def storage_format(input_format: Column | str, serde: Column | str, mentions_kudu: Column) -> Column:
    """Storage name from the input format, else the serde; Kudu anywhere wins."""
    fmt, lib = F.lower(or_empty(input_format)), F.lower(or_empty(serde))
    return F.coalesce(
        F.when(mentions_kudu, "kudu"),
        _first_word(fmt, STORAGE_WORDS), _first_word(lib, STORAGE_WORDS), F.lit("unknown"))


def storage_format_strict(input_format: Column | str, kudu_handler: Column) -> Column:
    """Variant that looks at the storage handler and the input format only."""
    return F.coalesce(
        F.when(kudu_handler, "kudu"),
        _first_word(F.lower(or_empty(input_format)), STRICT_STORAGE_WORDS), F.lit("unknown"))


def _describe_parts(line: Column | str, strict: bool) -> Column:
    if strict:
        # tab runs separate, as in a shell read; blanks inside a value collapse
        return F.transform(
            F.split(F.trim(col(line), F.lit("\t")), r"\t+"),
            lambda p: F.trim(F.regexp_replace(p, r"\s+", " ")))
    text = strip(line)
    parts = F.when(text.contains("\t"), F.split(text, "\t")).otherwise(F.split(text, r"\s{2,}"))
    return F.when(F.size(parts) >= 2, F.transform(parts, strip))


def describe_key(line: Column | str, strict: bool = False) -> Column:
    """Lower-cased key of a description line; null if the line is no key/value pair."""
    key = F.try_element_at(_describe_parts(line, strict), F.lit(1))
    if strict:
        return F.lower(F.trim(F.regexp_replace(key, ":$", "")))
    return F.lower(strip(F.rtrim(key, F.lit(":"))))


def describe_value(line: Column | str, strict: bool = False) -> Column:
    value = F.try_element_at(_describe_parts(line, strict), F.lit(2))
    return or_empty(value) if strict else value


def owner_name(owner: Column | str) -> Column:
    """User name of an owner given as an object (JSON text) or as plain text."""
    owner = or_empty(owner)
    from_object = or_empty(first_present(
        F.get_json_object(owner, "$.username"), F.get_json_object(owner, "$.name")))
    return F.when(owner.startswith("{"), from_object).otherwise(owner)


def project_id(owner: Column | str, name: Column | str, slug: Column | str) -> Column:
    return F.concat_ws(
        "/",
        F.coalesce(present(owner_name(owner)), F.lit("unknown")),
        F.coalesce(first_present(name, slug), F.lit("unnamed")))


def project_extra(description: Column | str, engine: Column | str, created: Column) -> Column:
    blanked = F.translate(or_empty(description), "|\n", "  ")
    return joined_parts(
        desc=F.left(blanked, F.lit(120)), engine=or_empty(engine), created=safe_ts(created))
