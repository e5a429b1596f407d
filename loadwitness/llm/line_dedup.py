"""Line dedup: overlapping windows of three consecutive lines, of which later occurrences go.

DataFrame functions only. Windows are built inside each row from an array of line hashes (no shuffle), counted by a
128-bit key with partial aggregation, and joined back to the few keys that occur more than once; a window that very many
rows hold is one row per task in the count, and the join side that holds it is split at run time. Texts are shuffled once,
to meet the positions that go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwitness.llm.common import free_names

WINDOW = 3
LINE_END = "\n"


def _hashes(lines: Column, salt: int | None = None) -> Column:
    return F.transform(lines, (lambda x: F.xxhash64(x)) if salt is None else (lambda x: F.xxhash64(F.lit(salt), x)))


def _windows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``version`` (hash of the text), ``pos``, 128-bit key ``a``, ``b`` of each window that is not empty."""
    hashed = docs.select(
        "doc_id", "version", _hashes(F.col("lines")).alias("h"), _hashes(F.col("lines"), 1).alias("g")
    ).where(F.size("h") >= WINDOW)

    def window(i: Column) -> Column:
        places = [i + k for k in range(WINDOW)]
        return F.struct(
            i.alias("pos"),
            F.xxhash64(*[F.get("h", p) for p in places]).alias("a"),
            F.xxhash64(*[F.get("g", p) for p in places]).alias("b"),
        )

    empty = F.xxhash64(*[F.xxhash64(F.lit(""))] * WINDOW)
    starts = F.sequence(F.lit(0), F.size("h") - WINDOW)
    return hashed.select("doc_id", "version", F.inline(F.transform(starts, window))).where(F.col("a") != empty)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines gone from ``text_col`` that later occurrences of a window cover.

    All columns of ``docs`` are kept and ``lines_removed`` is added (it replaces a column of that name). An occurrence is
    later than another if its id is larger, or within a row its line; a null id comes first. The positions that the later
    occurrences of all windows cover are merged, and those lines go, also where windows of one row overlap. Lines end at
    line feeds only; the text is otherwise unchanged, and becomes empty if all its lines go. Windows of empty lines and
    texts of fewer than three lines lose nothing; a null text stays null. Rows that repeat an id are versions of one
    document: a window at the same line of several versions is one occurrence. An empty table stays empty. Other columns may
    have any names; a text may have any length, its lines being one row's arrays.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("version"),
        F.split(F.col(text_col), LINE_END, -1).alias("lines"),
    ).where(F.col("lines").isNotNull())
    windows = _windows(rows)
    repeated = (
        windows.groupBy("a", "b")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "pos")).alias("first"))
        .where("n > 1")
        .select("a", "b", "first")
    )
    later = windows.join(repeated, ["a", "b"]).where(
        ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("pos") == F.col("first.pos")))
    )
    # As many positions as the text has lines, at most.
    starts = later.groupBy("doc_id", "version").agg(F.collect_set("pos").alias("starts"))
    gone = F.flatten(F.transform("starts", lambda p: F.array(*[p + k for k in range(WINDOW)])))
    # Names that the columns of ``docs`` leave free.
    id_, version_, gone_, lines_ = free_names(docs, "_id", "_version", "_gone", "_lines")
    covered = starts.select(F.col("doc_id").alias(id_), F.col("version").alias(version_), gone.alias(gone_))
    same = F.col(id_col).eqNullSafe(F.col(id_)) & (F.xxhash64(F.col(text_col)) == F.col(version_))
    lines = F.split(F.col(text_col), LINE_END, -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines_) - 1), gone_)
    changed = F.col(gone_).isNotNull() & F.col(text_col).isNotNull()
    text = F.when(changed, F.array_join(F.transform(kept, lambda i: F.get(lines_, i)), LINE_END)).otherwise(F.col(text_col))
    removed = F.when(changed, F.size(F.array_distinct(gone_))).otherwise(F.lit(0))
    others = [c for c in docs.columns if c not in (text_col, "lines_removed")]
    joined = docs.join(covered, same, "left").withColumn(lines_, F.when(changed, lines))
    out = joined.select(*others, text.alias(text_col), removed.alias("lines_removed"))
    return out.select(*[c for c in docs.columns if c != "lines_removed"], "lines_removed")
