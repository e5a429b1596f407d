"""Exact dedup: counting quotient filters per partition, merged by sorted remainders, then byte verification.

One scan reduces each row to a narrow one: 64-bit fingerprint, byte length and SHA-256 of the normalised text, code points
of the original. Each partition counts its fingerprints in counting quotient filters, one per segment (the leading bits of
the fingerprint), so a text that fills a third of the table costs one slot per partition. The filters of a segment are
merged in one task without loss, since quotient and remainder together are the whole fingerprint. A count of one proves a
text unique. Rows whose fingerprint counts more are routed to verification over all bytes of their texts: they are equal
only where byte length and SHA-256 agree as well. Texts themselves never move.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwitness.llm.common import stored
from loadwitness.operators.skew import salted_join

# Fingerprints that one segment holds on average, and the least number of segments (as bits).
SEGMENT_ROWS, LEAST_BITS = 1 << 17, 4

DROPPED = " \t\n\v\f\r"


def normalised(text: Column) -> Column:
    """The text without blanks, tabs and line ends; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for c in DROPPED:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


@dataclass
class CountingQuotientFilter:
    """Fingerprints of one segment with their counts.

    A fingerprint without its segment bits has ``bits`` bits: the upper ``quotient_bits`` name its home slot, the rest is
    the remainder kept in the slot. Runs of equal quotient are sorted and shifted right by linear probing.
    ``occupieds`` marks quotients that have a run, ``runends`` the last slot of each run.
    """

    bits: int
    quotient_bits: int
    occupieds: np.ndarray
    runends: np.ndarray
    remainders: np.ndarray
    counts: np.ndarray

    @classmethod
    def build(cls, values: np.ndarray, counts: np.ndarray, bits: int) -> CountingQuotientFilter:
        """``values``: sorted, distinct, below ``2 ** bits``."""
        n = len(values)
        q = min(bits, max(3, math.ceil(math.log2(max(n, 1) / 0.75 + 1))))
        home = (values >> np.uint64(bits - q)).astype(np.int64) if bits > q else values.astype(np.int64)
        rank = np.arange(n)
        slot = np.maximum.accumulate(home - rank) + rank
        slots = max(1 << q, int(slot[-1]) + 1 if n else 0)
        occupieds, runends = np.zeros(1 << q, bool), np.zeros(slots, bool)
        occupieds[home] = True
        runends[slot[np.flatnonzero(np.append(home[1:] != home[:-1], True))] if n else []] = True
        remainders, held = np.zeros(slots, np.uint64), np.zeros(slots, np.int64)
        remainders[slot] = values & np.uint64((1 << (bits - q)) - 1)
        held[slot] = counts
        return cls(bits, q, occupieds, runends, remainders, held)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Values in ascending order and their counts."""
        quotients, ends = np.flatnonzero(self.occupieds), np.flatnonzero(self.runends)
        begins = np.maximum(quotients, np.append(0, ends[:-1] + 1) if len(ends) else ends)
        lengths = ends - begins + 1
        home = np.repeat(quotients, lengths)
        slot = np.repeat(begins, lengths) + np.arange(len(home)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        high = home.astype(np.uint64) << np.uint64(self.bits - self.quotient_bits)
        if self.bits == self.quotient_bits:
            high = home.astype(np.uint64)
        return high | self.remainders[slot], self.counts[slot]

    def to_bytes(self) -> bytes:
        """Marks as bits, remainders in as many bytes as they need, counts as bytes with 255 for those kept apart."""
        width = -(-(self.bits - self.quotient_bits) // 8)
        raw = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        large = self.counts[self.counts >= 255]
        head = np.array([self.bits, self.quotient_bits, len(self.remainders), len(large)], "<i8")
        parts = (np.packbits(self.occupieds), np.packbits(self.runends), raw, np.minimum(self.counts, 255).astype(np.uint8))
        return head.tobytes() + large.astype("<i8").tobytes() + b"".join(p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        bits, q, slots, n_large = map(int, np.frombuffer(data, "<i8", 4))
        large = np.frombuffer(data, "<i8", n_large, 32)
        at, width = 32 + 8 * n_large, -(-(bits - q) // 8)

        def take(n: int) -> np.ndarray:
            nonlocal at
            at += n
            return np.frombuffer(data, np.uint8, n, at - n)

        occupieds = np.unpackbits(take(-(-(1 << q) // 8)), count=1 << q).astype(bool)
        runends = np.unpackbits(take(-(-slots // 8)), count=slots).astype(bool)
        raw = np.zeros((slots, 8), np.uint8)
        raw[:, :width] = take(slots * width).reshape(slots, width)
        counts = take(slots).astype(np.int64)
        counts[counts == 255] = large
        return cls(bits, q, occupieds, runends, raw.view("<u8").reshape(-1), counts)


def merged(filters: list[CountingQuotientFilter]) -> tuple[np.ndarray, np.ndarray]:
    """Values and summed counts of filters of one segment: their sorted runs laid together."""
    return _together([f.entries() for f in filters])


def _together(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of values with counts as one, in ascending order."""
    values, counts = (np.concatenate([r[i] for r in runs]) for i in (0, 1))
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.array([], np.int64)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts


def counted(batches: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order and how often each occurs. A run is laid together with an earlier one only when it
    has grown to half its size, so each value is sorted a logarithmic number of times."""
    runs: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        runs.append(np.unique(batch, return_counts=True))
        while len(runs) > 1 and len(runs[-2][0]) <= 2 * len(runs[-1][0]):
            runs[-2:] = [_together(runs[-2:])]
    if not runs:
        return np.array([], np.uint64), np.array([], np.int64)
    return _together(runs)


def repeated_fingerprints(rows: DataFrame, column: str, segment_bits: int) -> DataFrame:
    """``fingerprint`` (long) and ``copies`` (long) of the values that ``column`` (long) holds more than once."""
    bits = 64 - segment_bits

    def filters(batches):
        import pyarrow as pa

        seen, held = counted(batch.column(0).to_numpy().view(np.uint64) for batch in batches)
        if not len(seen):
            return
        segment = (seen >> np.uint64(bits)).astype(np.int64)
        cuts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        low = np.uint64((1 << bits) - 1)
        for a, b in zip(cuts, [*cuts[1:], len(seen)], strict=True):
            made = CountingQuotientFilter.build(seen[a:b] & low, held[a:b], bits)
            yield pa.RecordBatch.from_pydict(
                {"segment": pa.array([int(segment[a])], pa.int64()), "filter": pa.array([made.to_bytes()], pa.binary())}
            )

    def merge(group):
        import pyarrow as pa

        found = [CountingQuotientFilter.from_bytes(x) for x in group.column("filter").to_pylist()]
        values, counts = merged(found)
        many = counts > 1
        segment = np.uint64(group.column("segment")[0].as_py()) << np.uint64(bits)
        return pa.table({"fingerprint": (values[many] | segment).view(np.int64), "copies": counts[many]})

    blobs = rows.select(column).mapInArrow(filters, "segment bigint, filter binary")
    return blobs.groupBy("segment").applyInArrow(merge, "fingerprint bigint, copies bigint")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Which rows stay, of every group of rows whose normalised texts are equal.

    Returns a row per row of ``docs``: ``doc_id``, ``keep_id`` (id of the row that stays), ``group_size``, ``kept``,
    ``text_sha256``. The row with the most code points in its original text stays, then the smallest id; a null id
    comes after all others. A null text is empty, has no code points and equals texts of blanks only. Of rows that
    repeat both id and text exactly one has ``kept``. An empty table gives an empty result; other columns are not read.
    """
    plain = normalised(F.col("text"))
    narrow = stored(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            F.coalesce(F.length("text"), F.lit(0)).alias("points"),
            F.xxhash64(plain).alias("fingerprint"),
            F.octet_length(plain).alias("bytes"),
            F.sha2(plain, 256).alias("text_sha256"),
        ),
        "dedup-rows",
    )
    rows = narrow.count()
    bits = max(LEAST_BITS, math.ceil(math.log2(rows / SEGMENT_ROWS))) if rows else LEAST_BITS
    repeated = repeated_fingerprints(narrow, "fingerprint", bits)
    # Verification: the routed rows by all their bytes. min() combines before the shuffle, so a hot text is a row a task.
    equal = ["fingerprint", "bytes", "text_sha256"]
    first = F.struct(-F.col("points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    groups = (
        salted_join(narrow, repeated.select("fingerprint"), ["fingerprint"], ["row"], "left_semi")
        .groupBy(*equal)
        .agg(F.count("*").alias("n"), F.min(first).alias("first"))
        .where("n > 1")
    )
    found = narrow.join(groups, equal, "left")
    return found.select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("bigint")).alias("group_size"),
        (F.col("n").isNull() | (F.col("first.row") == F.col("row"))).alias("kept"),
        "text_sha256",
    )
