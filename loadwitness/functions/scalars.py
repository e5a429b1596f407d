"""Ids, statuses, names and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the `valid_to_ts` of a current row.
OPEN_END = "9999-12-31 00:00:00.000"

# Text for what is not known, and the form of a link.
NOT_AVAILABLE = "N/A"
LINK = "/workspace?workspace_id=%s&pipeline_id=%s&active_tab=curationUI"


def strip(c: Column) -> Column:
    """Drop white space at both ends (``F.trim`` drops blanks only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def id_to_string(c: Column) -> Column:
    """Ids as digits, never in exponent form; null stays null."""
    return c.cast("bigint").cast("string")


def cast_batch_id(c: Column) -> Column:
    """Text to a 64-bit id; text that is no number (``None`` among them) gives null."""
    return c.try_cast("bigint")


def valid_batch(c: Column) -> Column:
    """True where the batch id is neither null, empty nor the text ``none``, and is a number."""
    return F.coalesce(cast_batch_id(c.cast("string")).isNotNull(), F.lit(False))


def lower_text(c: Column) -> Column:
    """Lower case, with null as empty text: node names are matched this way."""
    return F.lower(F.coalesce(c, F.lit("")))


def upper_text(c: Column) -> Column:
    """Upper case; null stays null, so a missing status matches nothing."""
    return F.upper(c)


def contains(c: Column, text: str) -> Column:
    return c.contains(text)


def or_na(c: Column) -> Column:
    """Null or empty text becomes ``N/A``."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(NOT_AVAILABLE))


def workspace_url(base: str, workspace_id: Column, pipeline_id: Column) -> Column:
    """Link to a pipeline; ``N/A`` when the workspace or the pipeline is unknown."""
    link = F.format_string(
        base.replace("%", "%%") + LINK,
        workspace_id.cast("string"),
        pipeline_id.cast("string"),
    )
    return F.when(workspace_id.isNotNull() & pipeline_id.isNotNull(), link).otherwise(F.lit(NOT_AVAILABLE))


def format_ts(c: Column) -> Column:
    """Timestamp as text with six digits of the second."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def numbered(texts: Column) -> Column:
    """``[a, b]`` becomes ``[1. a, 2. b]``."""
    return F.transform(texts, lambda text, i: F.concat((i + 1).cast("string"), F.lit(". "), text))


def status_class(c: Column) -> Column:
    """Marker by which a status is shown."""
    return F.when(c == "Success", "ok").when(c == "Failed", "error").otherwise("neutral")


def report_name(name: Column, batch_id: Column) -> Column:
    """File-safe name of a discrepancy report: blanks become ``_``, characters that file systems refuse go."""
    safe = F.regexp_replace(F.regexp_replace(name, " ", "_"), r'[\\/:*?"<>|]', "")
    return F.concat(F.lit("Data_Validation_Report_"), safe, F.lit("_Batch_"), batch_id.cast("string"))
