"""What the operators of this folder share: tables, written intermediate tables, texts in bounded pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadwitness.scratch import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# White space of the tokenizer's pattern, as the inside of a character class.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BETWEEN = regex.compile(f"[{WHITE}]+")
# str.split() would also split here.
_SEPARATORS = regex.compile(r"[\x1c-\x1f]")

# Rows and characters that a Python worker turns into objects at a time.
SLICE_ROWS, SLICE_CHARS = 256, 1 << 20


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``build(spark, sf_dir)`` under ``name``, with the SQL that must give the same rows."""

    def add(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the folder that all executors share, and read from there."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores before those that ``df`` has as columns (in any case of letters)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


# Words of 64 bits in the table of ``maybe``. It is sent to all executors, so this bounds what is sent.
WORDS = 1 << 18


def maybe(rows: DataFrame, own: list[Column], wanted: DataFrame, its: list[Column], mark: str) -> DataFrame:
    """``rows`` with a last column ``mark``, false where no row of ``wanted`` has as ``its`` what a row has as ``own``.

    A table of bits of fixed size tells, so true decides nothing; it spares that rows are shuffled to meet ``wanted`` which
    it does not hold. Nulls count as values.
    """
    place_, word_, bits_ = free_names(rows.withColumn(mark, F.lit(True)), "_place", "_word", "_bits")

    def word(place: Column) -> Column:
        return place.bitwiseAND(F.lit(WORDS - 1))

    def bit(place: str) -> str:
        return f"CAST(shiftrightunsigned({place}, 58) AS INT)"

    places = wanted.select(F.xxhash64(*its).alias(place_))
    words = places.groupBy(word(F.col(place_)).alias(word_)).agg(F.expr(f"bit_or(shiftleft(1L, {bit(place_)}))").alias(bits_))
    met = rows.withColumn(place_, F.xxhash64(*own)).join(F.broadcast(words), word(F.col(place_)) == F.col(word_), "left")
    told = F.expr(f"shiftrightunsigned({bits_}, {bit(place_)}) & 1 = 1")
    return met.withColumn(mark, F.coalesce(told, F.lit(False))).drop(place_, word_, bits_)


# Tasks' vectors of counts are cut into blocks, and those summed in two steps, so that no task meets all of a block's.
BLOCKS, GROUPS = 16, 64
VECTOR = "block int, part int, counts binary"


def vector_blocks(counts: np.ndarray, part: int) -> list[tuple[int, int, bytes]]:
    """Rows (block, part, counts) of one task's vector; its length is a multiple of ``BLOCKS``."""
    return [(i, part % GROUPS, block.tobytes()) for i, block in enumerate(counts.astype("<i8").reshape(BLOCKS, -1))]


def summed_vectors(rows: DataFrame, keys: str = "") -> DataFrame:
    """Blocks (``VECTOR`` columns, and those that ``keys`` declares) summed over all tasks."""
    names = [k.split()[0] for k in keys.split(", ") if k]
    schema = f"{keys}, {VECTOR}" if keys else VECTOR

    def add(group):
        import pyarrow as pa

        counts = sum(np.frombuffer(x, "<i8") for x in group.column("counts").to_pylist())
        return group.slice(0, 1).drop_columns(["counts"]).append_column("counts", pa.array([counts.tobytes()], pa.binary()))

    rows = rows.select(*names, "block", "part", "counts")
    within = rows.groupBy(*names, "block", "part").applyInArrow(add, schema)
    return within.groupBy(*names, "block").applyInArrow(add, schema)


def chunks_of(text: str) -> list[str]:
    """The text between white space."""
    if _SEPARATORS.search(text):
        return [c for c in _BETWEEN.split(text) if c]
    return text.split()


def in_slices(batches: Iterable) -> Iterator[tuple]:
    """Of Arrow batches (id, text): ids as an Arrow array and texts as a list, few characters at a time."""
    for batch in batches:
        texts, at = batch.column(1), 0
        while at < batch.num_rows:
            n, chars = 0, 0
            some = texts.slice(at, SLICE_ROWS)
            for size in some.value_lengths().to_pylist() if hasattr(some, "value_lengths") else _lengths(some):
                n, chars = n + 1, chars + (size or 0)
                if chars >= SLICE_CHARS:
                    break
            yield batch.column(0).slice(at, n), texts.slice(at, n).to_pylist()
            at += n


def _lengths(texts) -> list:
    import pyarrow.compute as pc

    return pc.binary_length(texts).to_pylist()


def filter_by_text(docs: DataFrame, text_col: str, keep: Callable[[list], np.ndarray]) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose text ``keep`` marks; it gets lists of texts, nulls among them."""
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            marks = [keep(texts) for _, texts in in_slices([batch.select([at, at])])]
            if marks:
                yield batch.filter(pa.array(np.concatenate(marks)))

    return docs.mapInArrow(run, docs.schema)
