"""Similarity join on word shingles by a size-aware split into light and heavy sets, and its connected components.

Two different sets of Jaccard similarity ``t`` or more differ in at most ``(1-t)/(1+t)`` of the sum of their sizes.

* Light sets are small: of a prefix (the ``n - ceil(t n) + SUBSET`` smallest hashes) all subsets of ``SUBSET`` shingles are
  enumerated; linked light sets share one, as at least ``SUBSET`` common shingles lie in both prefixes.
* Heavy sets are found in inverted lists. A list of every single shingle would bring together all texts that share a
  common phrase, so shingles are dealt into so many parts that linked sets agree on ``spare + 1`` whole parts, and the
  lists are those of the parts' contents. A set enters the lists of all parts but its ``spare`` weakest, those with the
  fewest rare shingles: of the parts that two linked sets agree on, neither leaves out the strongest. Sizes fall into
  classes of ratio ``1/t``; a set enters the lists of its class and the next.
* The boundary is where the lists become cheaper than the subsets (``boundary``). Sets so large that they may be linked to a
  heavy one are entered in the lists as well.

Which shingles are common is told by a table of counts of fixed size that covers all texts; it only orders shingles, so
its errors cost time but no link. Equal sets are one class from the start. Sets that share a list or subset are chained to the first of them, never paired
with each other, which gives clusters that hold whole components and little more. The keys are most of what is shuffled: they
are cut to as many bits as keep them apart but for one in 16,384 at most, dealt into buckets by their value and sent packed, many
in a row, as steps from one key to the next and a few bytes of the set's hash. What falls together by that only enters a
cluster, as does every set whose few bytes another one has too. Only texts of sets in clusters are shuffled, and those that a
table of bits takes for such. In a cluster the sets are compared
exactly, again by inverted lists; a set is not compared with others that are already known to be connected. A cluster too
large for one task is compared block by block, every block with every other.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from loadwitness.llm.common import VECTOR, maybe, stored, summed_vectors, vector_blocks
from loadwitness.llm.graph import components
from loadwitness.llm.shingles import U, mixed, shingle_sets, slices

SUBSET = 3
# Sets and shingles that are compared in one task, beyond which a cluster is cut into blocks.
BLOCK_SETS, BLOCK_SHINGLES = 1500, 3_000_000
# Keys gathered in a task before those of one key are chained.
HELD_KEYS = 1_500_000
# Places of the table of counts (as bits).
TABLE_BITS = 16
# Shingles per bucket of keys, keys that are packed at a time, and bits of a key beyond those that number the shingles.
BUCKET_SHINGLES, PACKED_KEYS, SPARE_BITS = 1 << 19, 1 << 16, 14
# Bytes of a set's hash that stand for it beside a key.
NODE_BYTES = 5

_LIGHT, _HEAVY = U(0x2127599BF4325C37), U(0x880355F21E6D1965)


class Threshold:
    """Sizes, prefixes and parts for links of ``100 * intersection >= percent * union``."""

    def __init__(self, percent: int):
        if not 75 <= percent < 100:
            raise ValueError("linked sets must share a subset: the least similarity is from 75 to 99 percent")
        self.percent = percent
        self.least = -(-percent // (100 - percent))  # smaller sets are linked with equal ones only
        self.limit = self.boundary()

    def missing(self, n: int) -> int:
        """Shingles of a set of ``n`` that a linked set may lack."""
        return n - -(-self.percent * n // 100)

    def size_class(self, n: int) -> tuple[int, int]:
        """Number of the class of ``n`` and its largest size."""
        number, low = 0, self.least
        while True:
            high = low * 100 // self.percent
            if n <= high:
                return number, high
            number, low = number + 1, high + 1

    def parts(self, high: int) -> tuple[int, int]:
        """Parts for sets of at most ``high`` shingles, and how many of them a set may leave out."""
        differing = (100 - self.percent) * 2 * high // (100 + self.percent)
        spare = 2 + differing // 3
        return differing + 1 + spare, spare

    def boundary(self) -> int:
        """The largest size for which subsets make no more keys than lists do."""
        n = self.least
        while comb(self.missing(n + 1) + SUBSET, SUBSET) <= self._lists(n + 1):
            n += 1
        return n

    def _lists(self, n: int) -> int:
        _, high = self.size_class(n)
        return sum(p - spare for p, spare in (self.parts(high), self.parts(self.size_class(high + 1)[1])))

    def keys(self, shingles: np.ndarray, common: np.ndarray, classes: dict) -> np.ndarray:
        """Hashes of the subsets and lists that a set (sorted, distinct) enters. ``common``: which of them are common."""
        n = len(shingles)
        if n < self.least:
            return np.array([], U)
        out = []
        if n <= self.limit:
            prefix = shingles[np.argsort(common, kind="stable")][: self.missing(n) + SUBSET].tolist()
            some = np.array(list(combinations(prefix, SUBSET)), U)
            total = _LIGHT
            for i in range(SUBSET):
                total = mixed(some[:, i] ^ (total + U(i)))
            out.append(total)
        if n >= self.percent * (self.limit + 1) // 100:
            if n not in classes:
                number, high = self.size_class(n)
                classes[n] = [(number, *self.parts(high)), (number + 1, *self.parts(self.size_class(high + 1)[1]))]
            content = mixed(shingles ^ _HEAVY)
            place = shingles >> U(20)
            for number, parts, spare in classes[n]:
                part = (place % U(parts)).astype(np.int64)
                total = np.zeros(parts, U)
                np.add.at(total, part, content)
                rare = np.bincount(part, ~common, parts)
                held = np.bincount(part, minlength=parts)
                strong = np.lexsort((np.arange(parts), total, held, rare))[spare:]
                out.append(mixed(total ^ mixed(np.arange(parts, dtype=U) + U(number << 32) + _HEAVY))[strong])
        return np.concatenate(out)


def common_above(counts: np.ndarray) -> float:
    """The count from which a shingle is common: more than chance puts into one place of the table."""
    mean = counts.mean()
    return float(mean + 4 * np.sqrt(mean) + 1)


def signature(shingles: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(shingles.tobytes())
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _set_rows(docs: DataFrame, words: int) -> DataFrame:
    """Rows of two kinds from one pass over the texts: ``doc_id``, ``version`` (hash of the text), ``n``, ``h1``, ``h2``
    (128-bit hash of the set) of every row; and blocks of the table of counts, which have a ``block``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, version bigint, n bigint, h1 bigint, h2 bigint, {VECTOR}"
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        counts, seen = np.zeros(1 << TABLE_BITS, np.int64), set()
        for batch in slices(batches, 1):
            sets = shingle_sets(batch.column(1), words)
            marks = [signature(s) for s in sets]
            fresh = [s for s, m in zip(sets, marks, strict=True) if m not in seen]
            seen.update(marks)
            if fresh:
                counts += np.bincount(table_place(np.concatenate(fresh)), minlength=len(counts))
            ids = batch.column(0).flatten()
            numbers = [pa.array([len(s) for s in sets], pa.int64())]
            numbers += [pa.array([m[i] for m in marks], pa.int64()) for i in (0, 1)]
            rest = [pa.nulls(len(sets), f.type) for f in list(kinds)[5:]]
            yield pa.RecordBatch.from_arrays([*ids, *numbers, *rest], names=kinds.names)
        if seen:
            rows = vector_blocks(counts, TaskContext.get().partitionId())
            blank = [pa.nulls(len(rows), f.type) for f in list(kinds)[:5]]
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(kinds)[5:], strict=True)]
            yield pa.RecordBatch.from_arrays([*blank, *columns], names=kinds.names)

    return docs.select(F.struct("doc_id", "version").alias("ids"), "text").mapInArrow(run, schema)


def table_place(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> U(64 - TABLE_BITS)).astype(np.int64)


def chained(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key once, with the first node that has it; and pairs of such a node with another one that has its key."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    del order
    begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    key, leads = key[begins], node[begins]
    lead = np.repeat(leads, np.diff(np.append(begins, len(node))))
    other = lead != node
    return key, leads, np.unique(np.stack([lead[other], node[other]], axis=1), axis=0)


def _cells(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bytes of each value."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def _values(cells: np.ndarray) -> np.ndarray:
    out = np.zeros((len(cells), 8), np.uint8)
    out[:, : cells.shape[1]] = cells
    return out.view("<u8").ravel()


class Packing:
    """Keys as they are shuffled: their bits, the buckets they are dealt into, and rows that hold many of them."""

    SCHEMA = "bucket bigint, width int, packed binary"

    def __init__(self, shingles: int):
        self.bits = min(max(shingles.bit_length() + SPARE_BITS, 40), 64)
        self.buckets = -(-shingles // BUCKET_SHINGLES) or 1

    def cut(self, key: np.ndarray) -> np.ndarray:
        return key >> U(64 - self.bits)

    def rows(self, key: np.ndarray, node: np.ndarray):
        """A record batch of keys (cut and sorted): a row per bucket, with bytes of each step and node."""
        import pyarrow as pa

        bucket = (key >> U(self.bits - 32)) * U(self.buckets) >> U(32)
        begins = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        least = ((bucket[begins] << U(32)) + U(self.buckets - 1)) // U(self.buckets) << U(self.bits - 32)
        step = np.append(U(0), np.diff(key))
        step[begins] = key[begins] - least
        width = (int(step.max()).bit_length() + 7) // 8
        cells = np.concatenate([_cells(step, width), _cells(node, NODE_BYTES)], axis=1)
        offsets = np.append(begins, len(key)) * cells.shape[1]
        made = pa.Array.from_buffers(
            pa.binary(), len(begins), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(cells.tobytes())]
        )
        buckets, widths = pa.array(bucket[begins].astype(np.int64)), pa.array(np.full(len(begins), width, np.int32))
        return pa.RecordBatch.from_arrays([buckets, widths, made], names=["bucket", "width", "packed"])

    @staticmethod
    def keys(packed, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys, from the least of the bucket on, and nodes of rows of one bucket and width (an Arrow array)."""
        offsets = np.frombuffer(packed.buffers()[1], np.int32 if str(packed.type) == "binary" else np.int64)
        offsets = offsets[packed.offset : packed.offset + len(packed) + 1].astype(np.int64)
        data = np.frombuffer(packed.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        cells = data.reshape(-1, width + NODE_BYTES)
        begins = (offsets - offsets[0]) // cells.shape[1]
        step = _values(cells[:, :width])
        total = np.cumsum(step)
        before = total[begins[:-1]] - step[begins[:-1]]
        return total - np.repeat(before, np.diff(begins)), _values(cells[:, width:])


def _key_rows(docs: DataFrame, words: int, percent: int, counts: np.ndarray) -> DataFrame:
    """Packed keys (``Packing``), each with its node (bytes of a set's hash): sets that share a key may be linked.

    Within a task a key is handed on once, for the first set that has it; the others are chained to that one by keys of
    their own. So a key that a large part of all sets share is handed on once per task.
    """

    sent = docs.sparkSession.sparkContext.broadcast(counts > common_above(counts))
    packing = Packing(int(counts.sum()))

    def run(batches):
        threshold, classes, seen = Threshold(percent), {}, set()
        keys, nodes, held = [], [], 0

        def handed_on():
            key, node = packing.cut(np.concatenate(keys)), np.concatenate(nodes)
            keys.clear(), nodes.clear()
            key, node, pairs = chained(key, node)
            link = packing.cut(mixed(pairs[:, 0] ^ mixed(pairs[:, 1])))
            key, node = np.concatenate([key, link, link]), np.concatenate([node, pairs[:, 0], pairs[:, 1]])
            order = np.argsort(key, kind="stable")
            for at in range(0, len(key), PACKED_KEYS):
                some = order[at : at + PACKED_KEYS]
                yield packing.rows(key[some], node[some])

        for batch in slices(batches, 0):
            for shingles in shingle_sets(batch.column(0), words):
                mark = signature(shingles)
                if mark in seen:
                    continue
                seen.add(mark)
                made = threshold.keys(shingles, sent.value[table_place(shingles)], classes)
                if len(made):
                    keys.append(made)
                    nodes.append(np.full(len(made), mark[0] & ((1 << 8 * NODE_BYTES) - 1), U))
                    held += len(made)
            if held >= HELD_KEYS:
                yield from handed_on()
                held = 0
        if held:
            yield from handed_on()

    return docs.select("text").mapInArrow(run, Packing.SCHEMA)


def _chains(packed: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of nodes: the first that has a key, and another one that has it. A bucket is held at a time."""

    def run(batches):
        import pyarrow as pa

        now, keys, nodes = None, [], []

        def pairs():
            key, node = np.concatenate(keys), np.concatenate(nodes)
            keys.clear(), nodes.clear()
            found = chained(key, node)[2].astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

        for batch in (b for b in batches if b.num_rows):
            bucket, width = (np.asarray(batch.column(i)) for i in (0, 1))
            same = (bucket[1:] == bucket[:-1]) & (width[1:] == width[:-1])
            begins = np.flatnonzero(np.append(True, ~same)).tolist()
            for a, b in zip(begins, [*begins[1:], batch.num_rows], strict=True):
                if keys and bucket[a] != now:
                    yield pairs()
                now = bucket[a]
                key, node = Packing.keys(batch.column(2).slice(a, b - a), int(width[a]))
                keys.append(key)
                nodes.append(node)
        if keys:
            yield pairs()

    dealt = packed.repartition("bucket").sortWithinPartitions("bucket", "width")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def linked(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set the place of the first one it is connected with; exact.

    The sets' inverted lists give the sizes of all intersections with one set at a time. Sets are taken from outside the
    largest group of sets not yet taken, until only one group is left: then all pairs have been seen or are connected.
    """
    m = len(sets)
    root = list(range(m))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    if m == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        joined = common and 100 * common >= percent * (len(sets[0]) + len(sets[1]) - common)
        return [0, 0] if joined else [0, 1]
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), size)
    shingles = np.concatenate(sets)
    order = np.argsort(shingles, kind="stable")
    lists = owner[order]
    ranked = shingles[order]
    begin = np.searchsorted(ranked, ranked, "left")
    fresh = np.append(True, ranked[1:] != ranked[:-1])
    length = np.diff(np.append(np.flatnonzero(fresh), len(ranked)))[np.cumsum(fresh) - 1]
    starts, lengths = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    starts[order], lengths[order] = begin, length
    at = np.cumsum(size) - size
    waiting: dict[int, set[int]] = {i: {i} for i in range(m)}
    while len(waiting) > 1:
        largest = max(waiting, key=lambda g: len(waiting[g]))
        group = next(g for g in waiting if g != largest)
        i = waiting[group].pop()
        own = slice(at[i], at[i] + size[i])
        n = lengths[own]
        places = np.repeat(starts[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        common = np.bincount(lists[places], minlength=m)
        near = np.flatnonzero((common > 0) & (100 * common >= percent * (size + size[i] - common)))
        rest = waiting.pop(group)
        for j in near.tolist():
            a, b = find(i), find(j)
            if a != b:
                low, high = min(a, b), max(a, b)
                root[high] = low
                rest_a = rest if a == group else waiting.pop(a, set())
                rest_b = rest if b == group else waiting.pop(b, set())
                rest = rest_a | rest_b if a == group or b == group else rest
                group = low
        if rest:
            waiting[group] = rest
    return [find(i) for i in range(m)]


def _compare(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (``a1 a2 b1 b2``: hashes of both sets) within each ``task`` of ``rows`` (``task``, ``text``), which come sorted
    by task."""

    def run(batches):
        import pyarrow as pa

        def links(found: dict):
            if len(found) < 2:
                return []
            marks = list(found)
            return [
                (*marks[r], *marks[i]) for i, r in enumerate(linked([found[k] for k in marks], percent)) if r != i
            ]

        names = ["a1", "a2", "b1", "b2"]
        task, found, out = None, {}, []
        for batch in slices(batches, 1):
            tasks = batch.column(0).to_pylist()
            for now, shingles in zip(tasks, shingle_sets(batch.column(1), words), strict=True):
                if now != task:
                    out.extend(links(found))
                    task, found = now, {}
                found[signature(shingles)] = shingles
            if len(out) > 1 << 14:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)
                out = []
        out.extend(links(found))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)

    return rows.select("task", "text").mapInArrow(run, "a1 bigint, a2 bigint, b1 bigint, b2 bigint")


def jaccard_join(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``version`` (hash of the text), ``n_shingles``, ``component_id``, ``class_size`` (rows of an equal set),
    ``component_size``, ``kept`` of every row.

    ``component_id`` is the smallest id that links lead to. A null, empty or blank text has no shingles and is linked with
    nothing: its component is its own id. ``kept`` marks the row of each component that has the smallest id, then the
    smallest version, and every row without shingles; rows that repeat id and text share the mark. Rows that repeat an id or a text are rows of their own, in one class if their
    sets are equal. Null ids are never the smallest; a component of null ids only has a null id. An empty table gives an
    empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn(
        "version", F.xxhash64("text")
    )
    made = stored(_set_rows(rows, words), "shingle-sets")
    sets = made.where("block IS NULL").select("doc_id", "version", "n", "h1", "h2")
    found = summed_vectors(made.where("block IS NOT NULL")).orderBy("block").collect()  # a table of fixed size
    counts = np.concatenate([np.frombuffer(r["counts"], "<i8") for r in found]) if found else np.zeros(1 << TABLE_BITS)
    mark = ["h1", "h2"]
    of_class = [F.min("doc_id").alias("least"), F.count("*").alias("class_size"), F.first("n").alias("n")]
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version")).alias("one")
    classes = stored(sets.where("n > 0").groupBy(*mark).agg(*of_class, one), "shingle-classes")

    clusters = components(_chains(_key_rows(rows, words, percent, counts)))
    # A set that is in no chain is a cluster by itself, or with those of the same node.
    node = F.col("h1").bitwiseAND(F.lit((1 << 8 * NODE_BYTES) - 1))
    members = classes.withColumn("node", node).join(clusters, "node", "left")
    members = members.withColumn("root", F.coalesce("root", "node"))
    sizes = members.groupBy("root").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles")).where("sets > 1")
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    dealt = (
        members.join(sizes.select("root", blocks.alias("blocks")), "root")
        .withColumn("own", F.pmod(F.xxhash64("h2", "h1"), F.col("blocks")).cast("int"))
        .select(
            F.col("one.doc_id").alias("_id"),
            F.col("one.version").alias("_version"),
            "root",
            "own",
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
        )
        .select(
            "_id", "_version", F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("task")
        )
        .groupBy("_id", "_version")
        .agg(F.collect_set("task").alias("tasks"))  # as many as its cluster has blocks
    )
    dealt = stored(dealt, "dealt-sets")
    near = maybe(rows, [F.col("doc_id"), F.col("version")], dealt, [F.col("_id"), F.col("_version")], "near").where("near")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version"))
    texts = near.join(dealt, same).select(F.explode("tasks").alias("task"), "text")
    links = _compare(texts.repartition("task").sortWithinPartitions("task"), words, percent)
    edges = links.select(F.struct("a1", "a2").alias("a"), F.struct(F.col("b1").alias("a1"), F.col("b2").alias("a2")).alias("b"))
    roots = components(edges)

    labelled = classes.join(
        roots.select(F.col("node.a1").alias("h1"), F.col("node.a2").alias("h2"), "root"), mark, "left"
    ).withColumn("root", F.coalesce("root", F.struct(F.col("h1").alias("a1"), F.col("h2").alias("a2"))))
    named = labelled.groupBy("root").agg(
        F.min("least").alias("component_id"),
        F.sum("class_size").alias("component_size"),
        F.min("one").alias("first"),
    )
    labels = labelled.join(named, "root").select(*mark, "component_id", "class_size", "component_size", "first")
    alone = F.col("n") == 0
    one_row = F.lit(1).cast("bigint")
    return sets.join(labels, mark, "left").select(
        "doc_id",
        "version",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, one_row).otherwise(F.col("class_size")).alias("class_size"),
        F.when(alone, one_row).otherwise(F.col("component_size")).alias("component_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("version") == F.col("first.version")))).alias(
            "kept"
        ),
    )
