"""Benchmark decontamination by winnowing: documents that hold ten consecutive words of a benchmark item.

DataFrame functions only. A text becomes an array of word hashes. Of every window of ten words, whose k-grams are hashed, the
least hash is kept as a fingerprint, on both sides by the same rule; so a span of ten words that both sides hold has a
fingerprint in common. Where a document's fingerprint is also one of an item, the hit is extended: the windows around it are
compared, by 128 bits over their words, with the distinct windows of all items. What is joined is therefore distinct, and a
passage that very many documents or items hold makes no pairs of them.

Which k-grams may be fingerprints of an item, a table of bounded size tells where documents are read. Its false hits fail the
comparison of windows, so it decides only how much is spared. Long texts are cut into overlapping slices of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwitness.llm.common import stored

#: Words of a window and of a k-gram.
SPAN, GRAM = 10, 5
REACH = SPAN - GRAM
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Characters of a text that are cut into words at a time (to the end of a word), and windows in a slice.
PIECE, SLICE = 1 << 16, 1 << 12
# Places of the table per fingerprint, and its least and most places, a byte each.
PLACES_EACH, LEAST_PLACES, MOST_PLACES = 32, 1 << 16, 1 << 23


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body names it: no projection to be folded back."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_hashes(text: Column) -> Column:
    """Hashes of the words in order, A-Z in lower case; none for a null text."""

    def words(piece: Column) -> Column:
        return F.regexp_extract_all(piece, F.lit(WORD), F.lit(0))

    def lower(word: Column) -> Column:
        # The plain function would change letters beyond A-Z too.
        return F.when(_ascii(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))

    def hashed(piece: Column) -> Column:
        plain = F.transform(words(F.lower(piece)), lambda w: F.xxhash64(w))
        return F.when(_ascii(piece), plain).otherwise(F.transform(words(piece), lambda w: F.xxhash64(lower(w))))

    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"(?s).{{1,{PIECE}}}(?:{WORD}+)?"), F.lit(0))
    return F.flatten(F.transform(pieces, hashed))


def _ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def _gram(words: Column, at: Column, n: int, salt: int | None = None) -> Column:
    """Hash of ``n`` words from a place on."""
    parts = [F.get(words, at + i) for i in range(n)]
    return F.xxhash64(*parts) if salt is None else F.xxhash64(F.lit(salt), *parts)


def _upto(last: Column, first: Column | int = 0) -> Column:
    """``first`` to ``last``, nothing where that is below it."""
    first = F.lit(first) if isinstance(first, int) else first
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _grams(words: Column) -> Column:
    return F.transform(_upto(F.size(words) - GRAM), lambda i: _gram(words, i, GRAM))


def _windows_around(grams: Column, at: Column) -> Column:
    """Starts of the windows of ten words that hold the k-gram at a place."""
    return _upto(F.least(at, F.size(grams) - 1 - REACH), F.greatest(at - REACH, F.lit(0)))


def _fingerprints(grams: Column, asked=None) -> Column:
    """Places whose k-gram is the least of a window (of equal ones each is), of those that ``asked(hash)`` accepts."""

    def least(at: Column) -> Column:
        mine = F.get(grams, at)
        kept = F.exists(
            _windows_around(grams, at), lambda j: F.array_min(F.slice(grams, j + 1, REACH + 1)) == F.get(grams, at)
        )
        return kept if asked is None else asked(mine) & kept

    return F.filter(_upto(F.size(grams) - 1), least)


def _places(values: DataFrame, column: str) -> bytes:
    """A byte per place, 1 where a value of ``column`` falls; its size follows the number of values up to a bound."""
    n = values.count()
    size = LEAST_PLACES
    while size < min(n * PLACES_EACH, MOST_PLACES):
        size *= 2
    place = F.col(column).bitwiseAND(F.lit(size - 1))
    words = values.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(F.lit(63)).alias("bit"))
    found = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit AS INT))")).alias("bits"))
    table = bytearray(size)
    for row in found.collect():
        for bit in range(64):
            if row["bits"] >> bit & 1:
                table[64 * row["word"] + bit] = 1
    return bytes(table)


def _in(table: bytes, value: Column) -> Column:
    place = value.bitwiseAND(F.lit(len(table) - 1)).cast("int")
    return F.substring(F.lit(table), place + 1, F.lit(1)) == F.lit(b"\x01")


def _window(words: Column, at: Column, n: int, base: Column | int = 0) -> Column:
    """A window as a struct: place, length, and 128 bits over its words."""
    a, b = _gram(words, at, n), _gram(words, at, n, salt=n)
    return F.struct((at + base).alias("start"), F.lit(n).alias("length"), a.alias("a"), b.alias("b"))


def _windows_of_items(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``item, start, length, a, b`` of every window, and the fingerprints (``hash``) of those of ten words."""
    words, n = F.col("words"), F.size("words")
    windows = F.transform(_upto(n - SPAN), lambda i: _window(words, i, SPAN))
    for k in range(1, SPAN):
        windows = F.when(n == k, F.array(_window(words, F.lit(0), k))).otherwise(windows)

    def prints(grams: Column) -> Column:
        return F.transform(_fingerprints(grams), lambda i: F.get(grams, i))

    kept = _let(_grams(words), prints)
    return items.select("item", F.inline(windows)), items.select(F.explode(kept).alias("hash")).distinct()


def _possible_windows(words: Column, base: Column, prints: bytes, short: dict[int, bytes]) -> Column:
    """Windows of a slice of words that a fingerprint of an item leads to, and the runs that may be short items."""

    def extended(grams: Column) -> Column:
        near = _fingerprints(grams, lambda h: _in(prints, h))
        starts = F.array_distinct(F.flatten(F.transform(near, lambda i: _windows_around(grams, i))))
        return F.transform(starts, lambda i: _window(words, i, SPAN, base))

    def runs(n: int, table: bytes) -> Column:
        found = F.filter(_upto(F.size(words) - n), lambda i: _in(table, _gram(words, i, n)))
        return F.transform(found, lambda i: _window(words, i, n, base))

    return F.concat(_let(_grams(words), extended), *[runs(n, table) for n, table in short.items()])


def _slices(words: Column) -> Column:
    """``base, n_words, words``: all words, in slices that share what a window reaches over; one for no words."""
    bases = F.sequence(F.lit(0), F.greatest(F.size(words) - SPAN, F.lit(0)), F.lit(SLICE))

    def cut(base: Column) -> Column:
        some = F.slice(words, base + 1, SLICE + SPAN - 1)
        return F.struct(base.alias("base"), F.size(words).alias("n_words"), some.alias("words"))

    return F.transform(bases, cut)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items, items_sha256, contaminated``.

    Words are runs of digits, ASCII letters and characters beyond ASCII, A-Z lower-cased. A window is ten consecutive words of
    an item, or all words of an item that has fewer; a word of a document inside any occurrence of a window is hit. ``items``
    lists the ids, as strings and sorted, of the items whose windows occur. Texts that are null or without words have no words
    and are clean, such items match nothing. Rows that repeat an id and a text each get their row, items that repeat an id
    count once by it, one whose id is null takes part but is not listed. Empty tables give no rows, or clean ones. Texts of
    any length are read whole. Other columns are not read. Words and windows are compared by hashes of 64 and 128 bits.
    """
    items = stored(
        items.select(F.col(item_col).cast("string").alias("item"), word_hashes(F.col(item_text_col)).alias("words")), "items"
    )
    windows, prints = _windows_of_items(items)
    windows, prints = stored(windows, "item-windows"), stored(prints, "item-prints")
    short = windows.where(F.col("length") < SPAN)
    lengths = [r["length"] for r in short.select("length").distinct().orderBy("length").collect()]
    tables = {n: _places(short.where(F.col("length") == n).select("a").distinct(), "a") for n in lengths}

    # One pass over the texts; what it finds is written, and the number that tells rows apart with it.
    texts = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("t"))
    slices = texts.select("doc_id", "row", F.inline(_let(word_hashes(F.col("t")), _slices)))
    possible = _possible_windows(F.col("words"), F.col("base"), _places(prints, "hash"), tables)
    read = stored(slices.select("doc_id", "row", "base", "n_words", possible.alias("windows")), "windows-read")

    # Sets of items by window: windows of one set, as those of one passage are, meet its items once.
    key, mark = ["length", "a", "b"], ["s0", "s1", "s2"]
    owners = windows.select(*key, "item").distinct()
    hashes = [F.xxhash64("item"), F.xxhash64(F.lit(1), "item")]
    sets = owners.groupBy(*key).agg(
        F.count("item").alias("s0"), *[F.coalesce(F.bit_xor(h), F.lit(0)).alias(m) for h, m in zip(hashes, mark[1:], strict=True)]
    )
    sets = stored(sets, "window-sets")
    members = sets.groupBy(*mark).agg(F.min(F.struct(*key)).alias("w")).select(*mark, "w.*")
    members = stored(members.join(owners.where("item IS NOT NULL"), key).select(*mark, "item"), "set-items")

    met = stored(read.select("row", F.inline("windows")).join(sets, key).select("row", "start", "length", *mark), "window-hits")
    spans = met.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"))
    listed = met.select("row", *mark).distinct().join(members, mark)
    listed = listed.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    hit = spans.select("row", _covered("spans").alias("n_hit")).join(listed, "row", "left")

    found = read.where("base = 0").select("doc_id", "row", F.col("n_words").cast("bigint")).join(hit, "row", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return found.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        items.alias("items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def _covered(spans: str) -> Column:
    """Words under spans (start, length) in ascending order, each once."""

    def add(state: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        fresh = F.greatest(end - F.greatest(state["reach"], span["start"]), F.lit(0))
        return F.struct((state["covered"] + fresh).alias("covered"), F.greatest(state["reach"], end).alias("reach"))

    none = F.struct(F.lit(0).cast("bigint").alias("covered"), F.lit(0).alias("reach"))
    return F.aggregate(spans, none, add, lambda state: state["covered"])
