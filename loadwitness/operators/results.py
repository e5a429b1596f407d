"""Saved validation results: picks, counts and listings per batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadwitness.functions import comments as C
from loadwitness.operators.skew import counted_join

# Batches with at most so many comments are marked as listed inline; nothing is left out beyond.
INLINE_LIMIT = 10

RULES = ("r1", "r2", "r3")


def of_type(results: DataFrame, *types: str) -> DataFrame:
    return results.filter(F.col("validation_type").isin(*types))


def order_by_type(results: DataFrame) -> DataFrame:
    """By type, then in the order in which they were saved."""
    return results.orderBy("validation_type", "seq")


def discrepancies(results: DataFrame) -> DataFrame:
    """Data comments taken apart: ``side`` (``other`` for an unknown tag) and raw ``payload``."""
    c = F.col("comment")
    return of_type(results, "data").select("batch_id", "seq", C.side(c).alias("side"), C.payload(c).alias("payload"))


def readable(found: DataFrame) -> DataFrame:
    """Discrepancies with their ``text``. Parsing is the dear part: do it after rows have been left out."""
    return found.withColumn("text", C.render_payload(F.col("payload"))).drop("payload")


def discrepancy_counts(found: DataFrame, by: Sequence[str] = ("batch_id",)) -> DataFrame:
    """Per batch: rows on either side only, and all data comments, those of unknown tag among them."""
    return found.groupBy(*by).agg(
        F.count_if(F.col("side") == C.SOURCE_ONLY).alias("source_only"),
        F.count_if(F.col("side") == C.TARGET_ONLY).alias("target_only"),
        F.count("*").alias("total"),
    )


def with_totals(found: DataFrame, n: int = INLINE_LIMIT, by: Sequence[str] = ("batch_id",)) -> DataFrame:
    """All comments with the ``total`` of their batch, and whether it is small enough to be listed ``inline``."""
    totals = found.groupBy(*by).agg(F.count("*").alias("total"))
    return counted_join(found, totals, list(by), ["seq"]).withColumn("inline", F.col("total") <= n)


def preview(found: DataFrame, n: int = INLINE_LIMIT, by: Sequence[str] = ("batch_id",)) -> DataFrame:
    """``with_totals``, and the ``line_no`` of comments that are listed inline (null for the others, which have ``seq``).

    Batches beyond ``n`` are spread over tasks, as their rows need no number.
    """
    salt = F.when(~F.col("inline"), F.pmod(F.xxhash64("seq"), F.lit(64)))
    counted = with_totals(found, n, by).withColumn("_spread", salt)
    order = Window.partitionBy(*by, "_spread").orderBy("seq")
    return counted.withColumn("line_no", F.when(F.col("inline"), F.row_number().over(order))).drop("_spread")


def last_schemas_comment(results: DataFrame) -> DataFrame:
    """Per batch the last ``schemas`` comment."""
    return of_type(results, "schemas").groupBy("batch_id").agg(F.max_by("comment", "seq").alias("comment"))


def first_row_count_comment(results: DataFrame) -> DataFrame:
    """Per batch the first ``row_count`` comment."""
    return of_type(results, "row_count").groupBy("batch_id").agg(F.min_by("comment", "seq").alias("comment"))


def schema_missing(comment: Column) -> Column:
    """Whether a schema is absent from a ``schemas`` comment or says ``N/A``."""
    found = [C.source_schema(comment), C.target_schema(comment)]
    return found[0].isNull() | found[1].isNull() | found[0].contains("N/A") | found[1].contains("N/A")


def not_unique(comment: Column, rules: str) -> Column:
    low = F.lower(comment)
    found = low.contains("not_unique")
    return found | low.contains("fail") if rules == "r1" else found


def nulls_exist(comment: Column, rules: str) -> Column:
    if rules == "r3":
        return comment.contains("NULLs Exist")
    low = F.lower(comment)
    found = low.contains("nulls") & ~low.contains("no nulls")
    return found | low.contains("fail") if rules == "r1" else found


def step_facts(results: DataFrame, by: Sequence[str] = ("batch_id",)) -> DataFrame:
    """One row per batch (or other keys) with all that the verdicts ask of its comments, under every rule set, from one pass.

    Every fact is a number or a flag, so the aggregate works on hashed fixed-size buffers with partial results, and
    no comment is shuffled. Patterns are tried on comments of their own type only.
    """
    kind, c, seq = F.col("validation_type"), F.col("comment"), F.col("seq")

    def count(*types: str) -> Column:
        return F.count_if(kind.isin(*types))

    def seen(t: str, condition: Column) -> Column:
        return F.coalesce(F.bool_or((kind == t) & condition), F.lit(False))

    side = C.side(c)
    return results.groupBy(*by).agg(
        count("ingestion").alias("ingestion_comments"),
        count("schema").alias("schema_mismatches"),
        F.max_by(F.when(kind == "schemas", schema_missing(c)), F.when(kind == "schemas", seq)).alias("last_schemas_missing"),
        count("data").alias("data_comments"),
        F.count_if((kind == "data") & (side == C.SOURCE_ONLY)).alias("source_only"),
        F.count_if((kind == "data") & (side == C.TARGET_ONLY)).alias("target_only"),
        count("row_count").alias("row_count_comments"),
        F.min_by(
            F.when(kind == "row_count", F.coalesce(C.difference(c) == "0", F.lit(False))), F.when(kind == "row_count", seq)
        ).alias("counts_agree"),
        count("uniqueness").alias("uniqueness_comments"),
        *[seen("uniqueness", not_unique(c, rules)).alias(f"not_unique_{rules}") for rules in RULES],
        count("not_null").alias("not_null_comments"),
        *[seen("not_null", nulls_exist(c, rules)).alias(f"nulls_exist_{rules}") for rules in RULES],
    )


def step_texts(results: DataFrame) -> DataFrame:
    """Per batch the texts a report quotes: both schemas and the three counts, ``N/A`` where missing."""
    kind, c, seq = F.col("validation_type"), F.col("comment"), F.col("seq")

    def na(x: Column) -> Column:
        return F.coalesce(x, F.lit("N/A"))

    last = F.max_by(c, F.when(kind == "schemas", seq))
    first = F.min_by(c, F.when(kind == "row_count", seq))
    return of_type(results, "schemas", "row_count").groupBy("batch_id").agg(last.alias("s"), first.alias("r")).select(
        "batch_id",
        F.coalesce(F.col("s") != "", F.lit(False)).alias("has_schemas"),
        na(C.source_schema(F.col("s"))).alias("source_schema"),
        na(C.target_schema(F.col("s"))).alias("target_schema"),
        na(C.source_count(F.col("r"))).alias("source_count"),
        na(C.target_count(F.col("r"))).alias("target_count"),
        na(C.difference(F.col("r"))).alias("difference"),
    )


def report_lines(results: DataFrame, rules: str = "r3") -> DataFrame:
    """One line per comment that a report quotes one by one: schema mismatches, uniqueness, not-null.

    They stay rows, in the order of ``seq``, however many a batch has. The older rule sets also list the data
    comments; ``inline`` marks those of batches that have few.
    """
    kind, c = F.col("validation_type"), F.col("comment")
    by_blank, by_comma = C.pairs_text(C.format_pairs(c, ", ")), C.pairs_text(C.format_pairs(c, ","))
    text = (
        F.when(kind == "schema", C.strip(c))
        .when(kind == "uniqueness", by_blank)
        .when(kind == "not_null", by_blank if rules == "r1" else by_comma)
    )
    # The second rule set does not quote not-null comments.
    quoted = ("schema", "uniqueness") if rules == "r2" else ("schema", "uniqueness", "not_null")
    lines = of_type(results, *quoted).select(
        "batch_id",
        "validation_type",
        F.lit(None).cast("string").alias("heading"),
        "seq",
        text.alias("line"),
        F.lit(True).alias("inline"),
    )
    if rules == "r3":
        return lines
    listed = readable(with_totals(discrepancies(results)).filter(F.col("side") != "other"))
    return lines.unionByName(
        listed.select(
            "batch_id",
            F.lit("data").alias("validation_type"),
            F.concat("side", F.lit(":")).alias("heading"),
            "seq",
            F.col("text").alias("line"),
            "inline",
        )
    )
