"""Source divergence audit: how far the terms of each source lie from those of its language and of its other sources.

Which terms a language keeps is found by iceberg refinement of byte prefixes. A level counts, per prefix of at most so many
bytes, the documents that hold a term which begins with it; prefixes of too few documents go, and with them all their
longer terms. The next level doubles the length and extends only prefixes that stayed. A term as long as its prefix is
complete, which a zero byte marks (no term holds one), and its count is its own. Levels end when no prefix is open.

Open prefixes go to the tasks as a table of bits of bounded size. A prefix that passes by chance has fewer documents than
asked for, so have its extensions, and the exact count of the next level drops them: the table decides only how much work
is spared. Counts are added up before anything is shuffled, whatever the size of a source. A task's memory follows
``PIECE`` or the longest single text, of which it holds terms and their places, some ten bytes per byte.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadwitness.llm.common import stored

LEAST_DOCUMENTS, TERM_RANKS = 10, 10
SHARE, SMOOTHING = 1_000_000_000, 2
#: Bytes of the first level's prefixes; each level doubles them.
FIRST_BYTES = 6
# Bits of the table per prefix, and its least and most bits (a table of 16 MB at most).
BITS_PER_PREFIX, LEAST_TABLE, MOST_TABLE = 16, 1 << 16, 1 << 27
# Bytes of texts that a task cuts into terms at a time; a longer text is cut by itself.
PIECE = 1 << 23
# Kept terms in a task that compares sources, and sources in a block.
BUCKET_TERMS, BLOCK_SOURCES = 1 << 15, 64

END = b"\0"
# Letters A-Z become a-z, bytes beyond ASCII stay, all others separate.
_BYTES = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))


def terms_of(texts):
    """Of an Arrow array of UTF-8 texts: their distinct terms, and for each occurrence its term's and its text's place."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = texts.cast(pa.binary())
    ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
    data = texts.buffers()[2]
    held = data[int(ends[0]) : int(ends[-1])].to_pybytes().translate(_BYTES) if data is not None else b""
    buffers = [None, pa.py_buffer((ends - ends[0]).astype(np.int32)), pa.py_buffer(held)]
    split = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.string(), len(texts), buffers))
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    coded = split.flatten().cast(pa.binary()).dictionary_encode()
    place, text = coded.indices.to_numpy(zero_copy_only=False), np.repeat(np.arange(len(texts)), lengths)
    # Separators at a text's ends leave empty terms.
    real = (pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0)[place] if len(place) else slice(0)
    return coded.dictionary, place[real], text[real]


def _by_lang(batches):
    """Of Arrow batches (lang, source, text): language and rows, of few bytes together or one text."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False).cumsum()
        at = 0
        while at < batch.num_rows:
            done = int(sizes[at - 1]) if at else 0
            n = max(1, int(np.searchsorted(sizes, done + PIECE)) - at)
            some = batch.slice(at, n)
            for lang in some.column(0).unique():
                yield lang.as_py(), some.filter(pc.equal(some.column(0), lang))
            at += n


def _place(table_bytes: int, prefix: bytes, seed: int) -> int:
    return zlib.crc32(prefix, seed) & (8 * table_bytes - 1)


def _holds(table: np.ndarray, prefix: bytes, seed: int) -> bool:
    place = _place(len(table), prefix, seed)
    return bool(table[place >> 3] >> (place & 7) & 1)


def _bit_table(prefixes: DataFrame, n: int) -> np.ndarray:
    """A bit for each row (lang, prefix), or'ed task by task; its size follows ``n`` up to ``MOST_TABLE``."""
    bits = min(MOST_TABLE, max(LEAST_TABLE, 1 << math.ceil(math.log2(max(n, 1) * BITS_PER_PREFIX))))

    def local(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        table = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for lang, prefix in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                place = _place(len(table), prefix, zlib.crc32(lang.encode()))
                table[place >> 3] |= 1 << (place & 7)
        if table.any():
            near = TaskContext.get().partitionId() % 64
            yield pa.RecordBatch.from_arrays(
                [pa.array([near], pa.int32()), pa.array([table.tobytes()], pa.binary())], ["near", "bits"]
            )

    def joined(group):
        import pyarrow as pa

        total = np.zeros(bits // 8, np.uint8)
        for held in group.column("bits"):
            total |= np.frombuffer(held.as_buffer(), np.uint8)
        return group.slice(0, 1).drop_columns(["bits"]).append_column("bits", pa.array([total.tobytes()], pa.binary()))

    schema = "near int, bits binary"
    parts = prefixes.select("lang", "prefix").mapInArrow(local, schema)
    near = parts.groupBy("near").applyInArrow(joined, schema).withColumn("near", F.lit(0))
    found = near.groupBy("near").applyInArrow(joined, schema).collect()
    return np.frombuffer(found[0]["bits"], np.uint8) if found else np.zeros(bits // 8, np.uint8)


def _marked(prefixes, lang: str, table: np.ndarray) -> np.ndarray:
    """Which of an Arrow array of distinct prefixes the table holds."""
    seed = zlib.crc32(lang.encode())
    return np.fromiter((_holds(table, x, seed) for x in prefixes.to_pylist()), bool, len(prefixes))


def _open_terms(terms, lang: str, before: int, table: np.ndarray | None) -> np.ndarray:
    """Which terms reach the last level's length with a prefix that stayed."""
    import pyarrow.compute as pc

    long = pc.binary_length(terms).to_numpy(zero_copy_only=False) >= max(before, 1)
    if table is None or not long.any():
        return long
    coded = pc.binary_slice(terms.filter(long), 0, before).dictionary_encode()
    long[long] = _marked(coded.dictionary, lang, table)[coded.indices.to_numpy(zero_copy_only=False)]
    return long


def _ended(terms):
    import pyarrow.compute as pc

    return pc.binary_join_element_wise(terms, END, b"")


def _prefix_counts(docs: DataFrame, length: int, before: int, table: np.ndarray | None) -> DataFrame:
    """``lang, prefix, documents`` of one level, every prefix that a document extends counted once for it."""
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for lang, rows in _by_lang(batches):
            terms, place, text = terms_of(rows.column(2))
            open_ = _open_terms(terms, lang, before, sent.value)
            if not open_.any():
                continue
            coded = pc.binary_slice(_ended(terms.filter(open_)), 0, length).dictionary_encode()
            prefix = np.full(len(terms), -1)
            prefix[open_] = coded.indices.to_numpy(zero_copy_only=False)
            prefix, n = prefix[place], len(coded.dictionary)
            held = np.unique(text[prefix >= 0] * n + prefix[prefix >= 0])
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * n, pa.string()),
                    "prefix": coded.dictionary,
                    "documents": pa.array(np.bincount(held % n, minlength=n), pa.int64()),
                }
            )

    counted = docs.mapInArrow(run, "lang string, prefix binary, documents bigint")
    return counted.groupBy("lang", "prefix").agg(F.sum("documents").alias("documents"))


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, prefix``: the terms (and a zero byte) that at least ``least`` rows of ``docs`` (lang, source, text as bytes) hold."""
    complete, before, length, table = [], 0, FIRST_BYTES, None
    while True:
        level = stored(_prefix_counts(docs, length, before, table).where(F.col("documents") >= least), f"prefixes-{length}")
        ends = F.endswith(F.col("prefix"), F.lit(END))
        complete.append(level.where(ends).select("lang", "prefix"))
        open_ = level.where(~ends)
        n = open_.count()
        if not n:
            break
        table, before, length = _bit_table(open_, n), length, 2 * length
    out = complete[0]
    for more in complete[1:]:
        out = out.unionByName(more)
    return out


def term_counts(docs: DataFrame, kept: DataFrame, n_kept: int) -> DataFrame:
    """``lang, source, term, n``: occurrences of kept terms by source, and a row with a null term and 0 for every source."""
    sent = docs.sparkSession.sparkContext.broadcast(_bit_table(kept, n_kept))

    def run(batches):
        import pyarrow as pa

        for lang, rows in _by_lang(batches):
            sources = rows.column(1).dictionary_encode()
            terms, place, text = terms_of(rows.column(2))
            stays = _marked(_ended(terms), lang, sent.value)[place] if len(terms) else slice(0)
            source = sources.indices.to_numpy(zero_copy_only=False)[text[stays]]
            pairs, n = np.unique(source * max(len(terms), 1) + place[stays], return_counts=True)
            groups, found = len(sources.dictionary), len(pairs)
            names = np.concatenate([np.arange(groups), pairs // max(len(terms), 1)])
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * (groups + found), pa.string()),
                    "source": sources.dictionary.take(pa.array(names)),
                    "term": pa.concat_arrays([pa.nulls(groups, pa.binary()), terms.take(pa.array(pairs % max(len(terms), 1)))]),
                    "n": pa.array(np.concatenate([np.zeros(groups, np.int64), n.astype(np.int64)])),
                }
            )

    counted = docs.mapInArrow(run, "lang string, source string, term binary, n bigint")
    total = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
    terms = kept.select("lang", F.expr("substring(prefix, 1, octet_length(prefix) - 1)").alias("term"), F.lit(True).alias("stays"))
    found = total.join(terms, ["lang", "term"], "left").where("term IS NULL OR stays")
    return found.select("lang", "source", "term", "n")


def _share(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SHARE * (n + 2) / (N + 2 V))`` without leaving whole numbers."""
    over = (n.cast("decimal(20,0)") + SMOOTHING) * F.lit(SHARE).cast("decimal(10,0)")
    under = total.cast("decimal(20,0)") + kept.cast("decimal(20,0)") * SMOOTHING
    return _div(over, under) + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _apart(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _pair_sums(shares: DataFrame, groups: DataFrame, kept: DataFrame, n_kept: int) -> DataFrame:
    """``lang, at, other, value``: parts of the sums over all kept terms, a row per bucket of terms and pair ``at < other``.

    A task holds the shares of a bucket's terms in two blocks of sources. Terms that none of them uses are counted: all of
    them differ by the same.
    """
    buckets = max(1, math.ceil(n_kept / BUCKET_TERMS))
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket")
    # kept's prefix column is the term and a zero byte.
    sizes = kept.select("lang", F.expr("substring(prefix, 1, octet_length(prefix) - 1)").alias("term"))
    sizes = sizes.groupBy("lang", bucket).agg(F.count("*").alias("terms"))
    used = shares.select("lang", bucket, "term", "at", "p", "blocks", F.lit(None).cast("bigint").alias("terms"))
    unused = groups.join(sizes, "lang").select(
        "lang", "bucket", F.lit(None).cast("binary").alias("term"), "at", F.col("p0").alias("p"), "blocks", "terms"
    )
    own = F.floor(F.col("at") / BLOCK_SOURCES).cast("int")
    rows = used.unionByName(unused).withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = {"low": F.least(own, "partner"), "high": F.greatest(own, "partner")}
    rows = rows.withColumns(blocks).drop("partner", "blocks")

    def compare(group):
        import pyarrow as pa

        lang, low, high = (group.column(c)[0].as_py() for c in ("lang", "low", "high"))
        absent = group.column("term").is_null().to_numpy()
        at, p = (group.column(c).to_numpy() for c in ("at", "p"))
        order = np.argsort(at[absent])
        sources, default = at[absent][order], p[absent][order]
        terms = group.column("terms").filter(absent)[0].as_py()
        codes = group.column("term").filter(~absent).combine_chunks().dictionary_encode()
        used, column = len(codes.dictionary), np.searchsorted(sources, at[~absent])
        table = np.repeat(default[None, :], used, 0)
        table[codes.indices.to_numpy(zero_copy_only=False), column] = p[~absent]

        first, second, values = [], [], []
        for i in range(len(sources)):
            if sources[i] // BLOCK_SOURCES != low:
                continue
            j = np.flatnonzero((sources // BLOCK_SOURCES == high) & (sources > sources[i]))
            if not len(j):
                continue
            rest = (default[i] - default[j]) ** 2 // (default[i] + default[j]) * (terms - used)
            mine, theirs = table[:, i : i + 1], table[:, j]
            values.extend((((mine - theirs) ** 2 // (mine + theirs)).sum(0) + rest).tolist())
            first.extend([int(sources[i])] * len(j))
            second.extend(sources[j].tolist())
        return pa.table(
            {
                "lang": pa.array([lang] * len(first), pa.string()),
                "at": pa.array(first, pa.int32()),
                "other": pa.array(second, pa.int32()),
                "value": pa.array(values, pa.int64()),
            }
        )

    return rows.groupBy("lang", "bucket", "low", "high").applyInArrow(compare, "lang string, at int, other int, value bigint")


def divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least: int = LEAST_DOCUMENTS,
    ranks: int = TERM_RANKS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: by group (lang, source) the other sources of its language by distance
    (part ``pair``), and the ``ranks`` terms that it uses most beyond its language (part ``term``).

    Nulls in text, language and source count as empty, so an empty text still makes its group occur. Every row is a document,
    also one that repeats another. Terms are runs of ASCII letters and characters beyond ASCII, A-Z lower-cased; one may be as
    long as a text, and a text of any length is counted whole. Ties of values go by the item's bytes. A language
    without kept terms has distances of 0 and no term rows, a source alone in its language no pairs; an empty table gives an
    empty result. Other columns are not read. All arithmetic is in whole numbers.
    """

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    docs = docs.select(
        plain(lang_col).alias("lang"), plain(source_col).alias("source"), plain(text_col).cast("binary").alias("text")
    )
    kept = stored(kept_terms(docs, least), "kept-terms")
    n_kept = kept.count()
    counts = stored(term_counts(docs, kept, n_kept), "term-counts")
    in_lang = Window.partitionBy("lang")
    kept_by_lang = kept.groupBy("lang").agg(F.count("*").alias("v"))
    numbered = (
        counts.groupBy("lang", "source")
        .agg(F.sum("n").alias("total"))
        .withColumn("lang_total", F.sum("total").over(in_lang))
        .withColumn("at", F.row_number().over(in_lang.orderBy("source")) - 1)
        .withColumn("blocks", F.ceil(F.count("*").over(in_lang) / BLOCK_SOURCES).cast("int"))
        .join(kept_by_lang, "lang", "left")
    )
    # Without kept terms there is nothing to take a share of.
    groups = stored(
        numbered.withColumn("p0", F.when(F.col("v") > 0, _share(F.lit(0), F.col("total"), F.col("v")))), "divergence-groups"
    )
    shares = (
        counts.where("term IS NOT NULL")
        .withColumn("lang_n", F.sum("n").over(Window.partitionBy("lang", "term")))
        .join(groups, ["lang", "source"])
        .withColumn("p", _share(F.col("n"), F.col("total"), F.col("v")))
        .withColumn("q", _share(F.col("lang_n"), F.col("lang_total"), F.col("v")))
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = (
        shares.where("p > q")
        .withColumn("value", _apart(F.col("p"), F.col("q")))
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value")
        .withColumn("rank", F.row_number().over(by_value))
        .where(F.col("rank") <= ranks)
    )

    left = groups.select("lang", "source", "at")
    right = groups.select("lang", F.col("source").alias("item"), F.col("at").alias("other"))
    sums = stored(_pair_sums(shares, groups, kept, n_kept), "pair-sums")
    both = sums.unionByName(sums.select("lang", F.col("other").alias("at"), F.col("at").alias("other"), "value"))
    values = both.groupBy("lang", "at", "other").agg(F.sum("value").alias("value"))
    pairs = (
        left.join(right, "lang")
        .where("at <> other")
        .join(values, ["lang", "at", "other"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("bigint")).alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
    )
    return pairs.unionByName(terms)
