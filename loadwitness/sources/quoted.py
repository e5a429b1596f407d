"""CSV files with line breaks in quoted values, read by as many tasks as they have splits.

A line break ends a record where the number of quotes before it is even (RFC 4180: quotes enclose values and are doubled inside
them). So the text is read line by line in parallel; one narrow row per split says how many quotes it holds, and the parity
of all quotes before a split says whether it begins inside a value. A split that begins outside and none of whose
lines leaves a value open (nearly all of most files) holds whole records as they are. The lines of other splits are put
together within their split, and a record that several splits share from at most two pieces of each.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadwitness.scratch import written

QUOTE = '"'
SPLIT = ["file", "block"]

#: Options of the parser that do not say where a record ends.
PARSER_OPTIONS = {
    "sep", "delimiter", "nullvalue", "emptyvalue", "nanvalue", "positiveinf", "negativeinf", "locale", "dateformat",
    "timestampformat", "timestampntzformat", "ignoreleadingwhitespace", "ignoretrailingwhitespace", "maxcolumns",
    "maxcharspercolumn", "columnnameofcorruptrecord",
}
#: What the other options must be for a file to be split.
STANDARD = {"header": ("true", "false"), "mode": ("permissive", "failfast"), "quote": ('"',), "escape": ('"',), "multiline": ("true",)}


def splits(options: Mapping[str, str]) -> bool:
    """Whether files read with these options may be split: standard quotes and line ends, nothing that files are chosen by."""
    for key, value in options.items():
        if key.lower() not in PARSER_OPTIONS and str(value).lower() not in STANDARD.get(key.lower(), ()):
            return False
    return str(options.get("multiLine", "")).lower() == "true"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block`` (where its split begins), ``nth`` (ascending within a split), ``value`` (without its line feed)."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"),
        "value",
    )


def _quotes(value: str) -> F.Column:
    return F.length(value) - F.length(F.replace(F.col(value), F.lit(QUOTE), F.lit("")))


def split_parities(lines: DataFrame) -> DataFrame:
    """A row per split: ``first`` line, whether it begins ``inside`` a value, whether any line has an odd number of quotes
    (``busy``), and whether its file's quotes are odd (``torn``), so that they cannot be what the standard says."""
    odd = _quotes("value").bitwiseAND(F.lit(1))
    counted = lines.groupBy(*SPLIT).agg(F.min("nth").alias("first"), F.sum(odd).alias("odd"))
    by_file = Window.partitionBy("file")
    before = by_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    return counted.select(
        *SPLIT, "first", inside.alias("inside"), (inside | (F.col("odd") > 0)).alias("busy"),
        (F.sum("odd").over(by_file) % 2 == 1).alias("torn"),
    )


def _joined(parts: str, by: str) -> F.Column:
    """Texts of structs (``by``, ``text``) in that order, with line feeds between them."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by, parts))), lambda p: p[parts]), "\n")


def records(lines: DataFrame, known: DataFrame, header: bool) -> DataFrame:
    """``record``: each record's text, without the first of every file if they have a ``header``.

    ``known``: ``split_parities``, written once. Line ends within and after a record are line feeds; empty records are left out.
    """
    # Every line has its split there. An outer join keeps lines in their order where the few splits are broadcast.
    told = lines.join(known, SPLIT, "left").where("NOT coalesce(torn, false)")
    plain = told.where("NOT coalesce(busy, false)")
    if header:
        plain = plain.where("block > 0 OR nth > first")

    in_split = Window.partitionBy(*SPLIT).orderBy("nth")
    odd = _quotes("value").bitwiseAND(F.lit(1))
    marked = (
        told.where("busy")
        .withColumn("odd", odd)
        .withColumn("after", (F.col("inside").cast("int") + F.sum("odd").over(in_split)) % 2)
        .withColumn("opens", ((F.col("after") + F.col("odd")) % 2 == 0).cast("int"))
        .withColumn("nth_record", F.sum("opens").over(in_split))
    )
    # Record 0 of a split is the end (or a middle) of one that began in an earlier split.
    pieces = marked.groupBy(*SPLIT, "nth_record").agg(
        _joined("value", "nth").alias("text"), F.max_by("after", "nth").alias("open")
    )
    begins = F.col("nth_record") > 0
    if header:
        pieces = pieces.withColumn("header", (F.col("block") == 0) & (F.col("nth_record") == 1))
    else:
        pieces = pieces.withColumn("header", F.lit(False))
    pieces = written(pieces, "csv-pieces")
    whole = pieces.where(begins & (F.col("open") == 0) & ~F.col("header"))
    torn = pieces.where(~begins | (F.col("open") == 1))
    # At most two pieces of a split come here, so a file's are few.
    so_far = Window.partitionBy("file").orderBy("block", "nth_record")
    owned = torn.withColumn("owner", F.max(F.when(begins, F.col("block"))).over(so_far)).withColumn(
        "place", F.struct("block", "nth_record")
    )
    mended = owned.groupBy("file", "owner").agg(_joined("text", "place").alias("text"), F.max("header").alias("header"))
    found = (
        plain.select(F.col("value").alias("text"))
        .unionByName(whole.select("text"))
        .unionByName(mended.where("NOT header").select("text"))
    )
    text = F.replace(F.regexp_replace("text", "\r$", ""), F.lit("\r\n"), F.lit("\n"))
    return found.select(text.alias("record")).where("record <> ''")


def read_split(spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, str]) -> DataFrame:
    """The files under ``path`` as columns of ``schema``, the rows being those of the reader that takes a file a task.

    A file with an odd number of quotes does not follow the standard; it is read by that reader. So are files whose options
    ``splits`` refuses, which the caller sees to. A quote inside a value that is not quoted must be doubled like others.
    """
    lines = _lines(spark, path)
    known = written(split_parities(lines), "csv-splits")
    header = str(options.get("header", "true")).lower() == "true"
    parser = {k: v for k, v in options.items() if k.lower() not in ("header", "multiline")}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    out = records(lines, known, header).select(F.from_csv("record", ddl, parser).alias("r")).select("r.*")
    odd_files = [r["file"] for r in known.where("torn").select("file").distinct().collect()]
    if odd_files:
        out = out.unionByName(spark.read.options(**options).schema(schema).csv(odd_files))
    return out
