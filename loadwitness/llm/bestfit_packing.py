"""Packing into sequences by bin completion over length classes.

Pieces of equal length are interchangeable, so what must be decided depends on the histogram of lengths only, which has at
most ``capacity`` rows however large the table is. ``bin_completion`` turns it into patterns (lengths of a sequence) with
the number of sequences that use each. Every piece then finds its place by its rank among the pieces of its length: its
place in its partition plus the number in earlier partitions. No piece passes through the driver or a common task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadwitness.llm.common import in_slices, stored
from loadwitness.llm.token_ids import worker_encoder

# Nodes that the search opens at most, and fillings that it tries at each.
NODES, WIDTH = 8000, 4

Pattern = list[tuple[int, int]]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences needed at least: all tokens, or the pieces too long to share one plus what their rests cannot hold."""
    size = np.arange(capacity + 1)
    best = -(-int((counts * size).sum()) // capacity)
    above = np.cumsum(counts[::-1])[::-1]
    tokens = np.cumsum(counts * size)
    for k in range(1, capacity // 2 + 1):
        alone = int(above[capacity - k + 1])
        half = capacity // 2 + 1
        middle = int(above[half] - above[capacity - k + 1]) if capacity - k + 1 > half else 0
        room = middle * capacity - int(tokens[capacity - k] - tokens[half - 1]) if middle else 0
        small = int(tokens[capacity // 2] - tokens[k - 1])
        best = max(best, alone + middle + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, Pattern]]:
    """Best-fit decreasing, all sequences of equal content at once: longest pieces first, each into the fullest
    sequence that can hold it."""
    groups: dict[int, list[tuple[int, Pattern]]] = {capacity: []}
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        for rest in sorted(r for r in groups if r >= length and r < capacity):
            fit, kept = rest // length, []
            for n, pattern in groups.pop(rest):
                full = min(n, left // fit)
                if full:
                    groups.setdefault(rest - fit * length, []).append((full, [*pattern, (length, fit)]))
                    left, n = left - full * fit, n - full
                if n and left:
                    groups.setdefault(rest - left * length, []).append((1, [*pattern, (length, left)]))
                    left, n = 0, n - 1
                if n:
                    kept.append((n, pattern))
            if kept:
                groups.setdefault(rest, []).extend(kept)
            if not left:
                break
        if left:
            fit = capacity // length
            if left // fit:
                groups.setdefault(capacity - fit * length, []).append((left // fit, [(length, fit)]))
            if left % fit:
                groups.setdefault(capacity - left % fit * length, []).append((1, [(length, left % fit)]))
    return [(n, pattern) for rest, held in groups.items() for n, pattern in held]


def fillings(counts: np.ndarray, room: int, waste: int, width: int) -> Iterator[tuple[int, Pattern]]:
    """(tokens left free, filling) of ``room`` from ``counts`` with at most ``waste`` free, dominated ones left out.

    Depth first, long pieces first, so that fillings of few pieces come first; at most ``width`` of them.
    """
    lengths = np.flatnonzero(counts[: room + 1])[::-1].tolist()
    negative = [-n for n in lengths]
    found, steps = 0, 0

    def search(at: int, free: int, chosen: Pattern) -> Iterator[tuple[int, Pattern]]:
        nonlocal found, steps
        at = max(at, bisect_left(negative, -free))
        if at == len(lengths) or free == 0:
            if free <= waste and not dominated(counts, chosen, free):
                found += 1
                yield free, list(chosen)
            return
        for i in range(at, len(lengths)):
            length = lengths[i]
            steps += 1
            if found >= width or steps > 64 * width:
                return
            for times in range(min(free // length, int(counts[length])), 0, -1):
                yield from search(i + 1, free - times * length, [*chosen, (length, times)])
                if found >= width:
                    return
            if free - length > waste and i + 1 < len(lengths) and tail[i + 1] < free - waste:
                return

    tail = np.append(np.cumsum([length * int(counts[length]) for length in lengths][::-1])[::-1], 0) if lengths else [0]
    yield from search(0, room, [])


def dominated(counts: np.ndarray, chosen: Pattern, free: int) -> bool:
    """Whether one longer piece left out could stand for some of the chosen ones: then that filling is no worse."""
    if not free:
        return False
    sums = 1
    for length, times in chosen:
        for _ in range(times):
            sums |= sums << length
    taken = dict(chosen)
    for total in range(1, sums.bit_length()):
        if sums >> total & 1:
            for longer in range(total + 1, min(total + free, len(counts) - 1) + 1):
                if counts[longer] > taken.get(longer, 0):
                    return True
    return False


def bin_completion(counts: np.ndarray, capacity: int, nodes: int = NODES, width: int = WIDTH) -> list[tuple[int, Pattern]]:
    """Patterns and how many sequences use each, in as few sequences as the search finds.

    ``counts[n]`` pieces of ``n`` tokens. Best fit gives the first incumbent. The search completes a sequence around the
    longest piece left, tries its undominated fillings, least free tokens first, repeats a filling as often as the
    counts allow, and gives up a branch once the free tokens so far leave no way to save a sequence. It ends at the lower
    bound, or after ``nodes`` nodes with the incumbent.
    """
    total = int((counts * np.arange(capacity + 1)).sum())
    incumbent = best_fit(counts, capacity)
    best = sum(n for n, _ in incumbent)
    least = lower_bound(counts, capacity)
    # Depth-first on an explicit stack: what is left, what was decided (a linked list), sequences, free tokens.
    stack = [(counts.copy(), None, 0, 0)]
    while stack and best > least and nodes > 0:
        nodes -= 1
        left, decided, used, free = stack.pop()
        longest = np.flatnonzero(left)
        if not len(longest):
            if used < best:
                best, incumbent = used, []
                while decided:
                    incumbent.append(decided[0])
                    decided = decided[1]
            continue
        top = int(longest[-1])
        spare = (best - 1) * capacity - total - free
        if spare < 0:
            continue
        left[top] -= 1
        options = sorted(fillings(left, capacity - top, spare, width), key=lambda x: (x[0], len(x[1])))
        left[top] += 1
        for waste, filling in reversed(options):
            pattern = dict(filling)
            pattern[top] = pattern.get(top, 0) + 1
            times = min(int(left[n]) // k for n, k in pattern.items())
            if waste:
                times = min(times, spare // waste)
            rest = left.copy()
            for n, k in pattern.items():
                rest[n] -= times * k
            made = (times, sorted(pattern.items(), reverse=True))
            stack.append((rest, (made, decided), used + times, free + times * waste))
    return incumbent


def places(patterns: list[tuple[int, Pattern]]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, by rank: from ``rank`` on, ``fit`` at a time from ``sequence`` on, at
    ``offset``. Sorted by (length, rank); as long as the patterns are together."""
    rows, ranks, sequence = [], {}, 0
    for times, pattern in patterns:
        at = 0
        for length, fit in pattern:
            rank = ranks.get(length, 0)
            rows.append((length, rank, fit, sequence, at))
            ranks[length] = rank + times * fit
            at += fit * length
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "fit", "sequence", "offset"), table.T, strict=True))


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Documents as pieces of at most ``capacity`` tokens, with the partition that made each (``part``) and its place
    among the pieces of its length there (``nth``)."""
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
    kinds = [None, pa.int32(), *[pa.int64()] * 5]

    def run(batches):
        from pyspark import TaskContext

        encoder, end = worker_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for ids, texts in in_slices(batches):
            where, rows = [], []
            for i, text in enumerate(texts):
                raw = encoder.encode(text) + end
                for start in range(0, len(raw), 4 * capacity):
                    cut = raw[start : start + 4 * capacity]
                    n = len(cut) // 4
                    where.append(i)
                    rows.append((start // (4 * capacity), start // 4, n, zlib.crc32(cut), part, seen[n]))
                    seen[n] += 1
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(where, pa.int64())), *columns], names=names)

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part bigint, nth bigint"
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and its ``offset`` there.

    Returns ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``. A document is its ids
    and the end id; only longer ones than ``capacity`` are cut. A null or empty text is the end id alone. Repeated rows and
    null ids are documents of their own; an empty table gives no rows; other columns are not read.
    """
    pieces = stored(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    table = places(bin_completion(counts, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint")).alias("base"))
    ranked = pieces.join(base, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank")
    )
    wide = np.int64(1) << np.int64(50)
    keys = table["length"] * wide + table["rank"]

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = np.searchsorted(keys, length * wide + rank, "right") - 1
            nth = rank - table["rank"][row]
            fit = table["fit"][row]
            sequence = table["sequence"][row] + nth // fit
            offset = table["offset"][row] + nth % fit * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    kind = pieces.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return ranked.mapInArrow(place, schema)
