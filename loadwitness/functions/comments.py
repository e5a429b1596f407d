"""The text format of saved validation results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadwitness.functions.scalars import strip

# Tags and labels inside the comments.
SOURCE_ONLY = "present_only_in_source"
TARGET_ONLY = "present_only_in_destination"
SOURCE_SCHEMA = r"Source Schema:\s*(\[[^\n]*?\])"
TARGET_SCHEMA = r"Target Schema:\s*(\[[^\n]*?\])"
SOURCE_COUNT = r"(?:Source Row Count:|Number of rows in Source:)\s*(\d+)"
TARGET_COUNT = r"Target:\s*(\d+)"
DIFFERENCE = r"Difference:\s*(\d+)"
HASH_TAIL = r"\|\|[0-9a-fA-F]{64}$"
HASH_KEY = "row_hash"


def _first_group(c: Column, pattern: str) -> Column:
    """First group of the first match, null without a match (none of the patterns can match empty text)."""
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def tag(c: Column) -> Column:
    """Text before the first double bar, or all of it."""
    return F.substring_index(c, "||", 1)


def payload(c: Column) -> Column:
    """Text after the first double bar; empty without one. Later bars belong to it."""
    return F.when(c.contains("||"), F.substr(c, F.length(tag(c)) + 3)).when(c.isNotNull(), F.lit(""))


def side(c: Column) -> Column:
    """Which side a data comment speaks of; ``other`` for an unknown tag."""
    t = tag(c)
    return F.when(t.contains(SOURCE_ONLY), SOURCE_ONLY).when(t.contains(TARGET_ONLY), TARGET_ONLY).otherwise("other")


def strip_row_hash(c: Column) -> Column:
    """Drop a trailing double bar with 64 hex digits, then outer white space."""
    return strip(F.regexp_replace(c, HASH_TAIL, ""))


def payload_entries(c: Column) -> Column:
    """Keys and values of a JSON object without its row hash; null where the text is no JSON object.

    A repeated key keeps its first place and its last value. Text that does not open an object is not parsed.
    """

    def clean(entries: Column) -> Column:
        keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
        last = F.transform(
            keys,
            lambda k: F.struct(
                k.alias("key"), F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"].alias("value")
            ),
        )
        unique = F.when(F.size(keys) == F.size(entries), entries).otherwise(last)
        return F.filter(unique, lambda e: e["key"] != HASH_KEY)

    return _let(F.when(c.rlike(r"^\s*\{"), F.map_entries(F.from_json(c, "map<string,string>"))), clean)


def parse_payload(c: Column) -> Column:
    """JSON object as a map without its row hash; null where the text is no JSON object."""
    return F.map_from_entries(payload_entries(c))


def render_payload(c: Column) -> Column:
    """``key: value`` pairs of a JSON payload, or the text without its hash tail."""

    def joined(entries: Column) -> Column:
        pairs = F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("None"))))
        return F.array_join(pairs, ", ")

    return F.coalesce(_let(payload_entries(c), joined), strip_row_hash(c))


def source_schema(c: Column) -> Column:
    """The bracketed source schema, up to the first closing bracket; null when missing."""
    return _first_group(c, SOURCE_SCHEMA)


def target_schema(c: Column) -> Column:
    return _first_group(c, TARGET_SCHEMA)


def source_count(c: Column) -> Column:
    """Digits after either source label; null when missing. Counts stay text, as the rules compare text."""
    return _first_group(c, SOURCE_COUNT)


def target_count(c: Column) -> Column:
    return _first_group(c, TARGET_COUNT)


def difference(c: Column) -> Column:
    """Digits of the difference; a negative one does not match and gives null."""
    return _first_group(c, DIFFERENCE)


def format_pairs(c: Column, separator: str = ", ") -> Column:
    """Comment cut at the separator into ``struct<key, value>``; cut at the first colon, key null without one.

    With a bare comma as separator the parts are stripped as well.
    """
    parts = F.split(strip(c), separator)
    if separator == ",":
        parts = F.transform(parts, strip)

    def pair(part: Column) -> Column:
        found = F.regexp_extract(part, r"^([^:]+):", 1)
        keyed = found != ""
        return F.struct(
            F.when(keyed, found).alias("key"),
            F.when(keyed, F.substr(part, F.length(found) + 2)).otherwise(part).alias("value"),
        )

    return F.transform(parts, pair)


def pairs_text(pairs: Column) -> Column:
    """Pairs of ``format_pairs`` as lines."""
    return F.array_join(
        F.transform(pairs, lambda p: F.concat(F.coalesce(F.concat(p["key"], F.lit(":")), F.lit("")), p["value"])), "\n"
    )
