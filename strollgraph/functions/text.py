"""Identifiers, fingerprints and small text helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def list_digest(items: Column) -> Column:
    """SHA-256 of a sorted string list written as ``["a", "b"]``."""
    body = F.array_join(F.array_sort(items), '", "')
    return F.sha2(F.concat(F.lit('["'), body, F.lit('"]')), 256)


def site_id(members: Column) -> Column:
    return F.concat(F.lit("site-"), F.substring(list_digest(members), 1, 16))


def site_name(names: Column, identifier: Column) -> Column:
    """Distinct names joined, or a default that carries part of the id."""
    default = F.concat(F.lit("Unnamed access land "), F.substring(identifier, 6, 8))
    return F.coalesce(F.nullif(F.array_join(names, "; "), F.lit("")), default)


def slug(name: Column) -> Column:
    dashed = F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.trim(dashed, F.lit("-")), F.lit("")), F.lit("region"))


def version_label(snapshot: Column, version: Column, modified: Column, sha256: Column) -> Column:
    """First known version; 13-digit values are milliseconds since 1970 and become ISO time."""
    known = F.coalesce(
        *[F.nullif(c, F.lit("")) for c in (snapshot, version, modified)], F.substring(F.coalesce(sha256, F.lit("")), 1, 12)
    )
    is_millis = known.rlike("^[1-9][0-9]{12}$")
    millis = F.when(is_millis, known).cast("bigint")
    part = F.pmod(millis, F.lit(1000))
    fraction = F.when(part == 0, "").otherwise(F.format_string(".%03d000", part))
    seconds = F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(is_millis, F.concat(seconds, fraction, F.lit("+00:00"))).otherwise(known)


def attributes_json(attributes: Column) -> Column:
    """Attribute map as JSON text with sorted keys.

    A missing value becomes null, and so does ``NaN``, the text of a number that is none; a name such as "Nan" stays.
    """
    entries = F.array_sort(F.map_entries(attributes))
    clean = F.transform(
        entries,
        lambda e: F.struct(
            e["key"].alias("key"), F.when(e["value"] != "NaN", e["value"]).alias("value")
        ),
    )
    return F.to_json(F.map_from_entries(clean), {"ignoreNullFields": "false"})


def attributes_map(text: Column) -> Column:
    return F.from_json(F.coalesce(F.nullif(text, F.lit("")), F.lit("{}")), "map<string,string>")


def joined_list(items: Column, separator: str = ";") -> Column:
    return F.array_join(F.array_sort(F.array_distinct(items)), separator)


def in_list(text: Column, value) -> Column:
    return F.array_contains(F.split(text, ";"), value)
