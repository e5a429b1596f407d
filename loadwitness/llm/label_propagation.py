"""Sharding by balanced label propagation: linked rows move towards their neighbours' shards under quotas.

Links run through hubs: rows that have a hub in common are neighbours, so a group of any size is as many links as it has
rows. The rows whose smallest hub is the same are a group. Groups that are a large part of a shard are dealt out first, the
largest first, each to the shard with most room; where no shard has room for the whole group, and only there, it is cut, into
as few pieces as the room allows. All others are cut into slices, which start on shards of their own and find together: in a
round a hub tells the bytes that it has on each shard (one narrow row per hub), every slice adds up what its hubs tell and
wishes for the shard that holds most among those with room for it, of equal shards its own, then the emptiest; each shard
admits wishes up to its room and passes over those that do not fit. Rounds end when links keep no more bytes together than
before. A group that is cut then, though shards have room, is dealt out as a whole. Rows without links cut nothing, wherever
they are; they fill the shards up to equal sizes.

What the driver sees is of fixed size: bytes by shard and bucket of hashes, and the groups too large for a bucket.
"""

from __future__ import annotations

import heapq
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadwitness.llm.common import stored

BUCKETS = 4096
# Slices of a group, which start apart; rounds in vain after which they end, as in each only half of the slices may move.
SLICES, VAIN = 8, 3
# Room that linked rows may take beyond an equal share, and the part of a share from which on a unit is dealt out by itself:
# less than the room, so that the emptiest shard always has room for a smaller one.
SLACK, LARGE = 0.01, 1 / 128


def _bucket(*columns: str | Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int")


def deal(units: list[tuple[int, int]], shards: int, share: float) -> tuple[list[list[tuple[int, int]]], list[float]]:
    """For each unit (bytes, rows), the largest first, its pieces (first row, shard), and the bytes that each shard holds."""
    held, out = [0.0] * shards, []
    for bytes_, rows in units:
        least = min(range(shards), key=lambda i: (held[i], i))
        if held[least] + bytes_ <= share * (1 + SLACK):
            out.append([(0, least)])
            held[least] += bytes_
            continue
        pieces, at, size = [], 0, bytes_ / rows
        for limit in (share, share * (1 + SLACK)):
            for i in sorted(range(shards), key=lambda i: (held[i], i)):
                n = min(rows - at, int((limit - held[i]) / size))
                if n > 0:
                    pieces.append((at, i))
                    at, held[i] = at + n, held[i] + n * size
        for nth in range(at, rows):  # a few that rounding left, or rows too large for what each shard has left
            least = min(range(shards), key=lambda i: (held[i], i))
            pieces.append((nth, least))
            held[least] += size
        out.append(pieces)
    return out, held


def propagate(linked: DataFrame, links: DataFrame, shards: int, share: float) -> DataFrame:
    """``row``, ``size``, ``shard`` of the rows of ``linked`` (``row``, ``size``) after balanced label propagation over
    ``links`` (``row``, ``hub``)."""
    hub_bytes = links.join(linked, "row").groupBy("hub").agg(F.sum("size").alias("bytes"))
    unit = links.join(hub_bytes, "hub").groupBy("row").agg(F.min(F.struct("bytes", "hub")).alias("u"), F.count("*").alias("hubs"))
    rows = stored(linked.join(unit, "row").select("row", "size", F.col("u.hub").alias("unit"), "hubs"), "units")
    sums = rows.groupBy("unit").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    # At most shards / LARGE.
    large = sums.where(F.col("bytes") > share * LARGE).orderBy(F.desc("bytes"), "unit").collect()
    pieces, held = deal([(r["bytes"], r["rows"]) for r in large], shards, share)
    kind = rows.schema["unit"].dataType.simpleString()
    homes = rows.sparkSession.createDataFrame(
        [(r["unit"], [at for at, _ in p], [i for _, i in p]) for r, p in zip(large, pieces, strict=True)],
        f"unit {kind}, starts array<bigint>, homes array<int>",
    )
    dealt = rows.join(F.broadcast(homes), "unit", "left")
    small = rows.join(F.broadcast(homes), "unit", "left_anti")
    one = dealt.where(F.size("homes") == 1).select("row", "size", F.col("homes")[0].alias("shard"))
    fixed = one
    if any(len(p) > 1 for p in pieces):
        piece = F.size(F.filter("starts", lambda x: x <= F.col("slot"))) - 1
        cut = gapless(dealt.where(F.size("homes") > 1), "unit", ["row"])
        fixed = one.union(cut.select("row", "size", F.get("homes", piece).alias("shard")))
    fixed = stored(fixed, "fixed")
    slices = small.select("row", "size", F.struct("unit", F.pmod(F.xxhash64("row"), F.lit(SLICES)).alias("slice")).alias("unit"))
    moved, _ = _rounds(_filled(slices, held), fixed, links, shards, share * (1 + SLACK))

    moved = stored(moved.withColumn("unit", F.col("unit.unit")), "moved")
    is_cut = (F.min("shard") != F.max("shard")).alias("cut")
    on = moved.groupBy("unit").agg(is_cut, F.sum("size").alias("bytes"), F.min("shard").alias("at"))
    whole = on.where("NOT cut").groupBy("at").agg(F.sum("bytes").alias("bytes")).collect()
    for r in whole:
        held[r["at"]] += r["bytes"]
    left = moved.join(on.where("cut").select("unit"), "unit", "left_semi").select("row", "size", "unit")
    stays = moved.join(on.where("cut").select("unit"), "unit", "left_anti")
    return stays.select("row", "size", "shard").union(_filled(left, held).select("row", "size", "shard")).union(fixed)


def _filled(rows: DataFrame, held: list[float]) -> DataFrame:
    """``rows`` (``unit``, ``size`` and others) with a ``shard``: whole units by buckets of their hashes, the largest bucket
    first to the shard that holds least."""
    rows = rows.withColumn("bucket", _bucket("unit"))
    sizes = rows.groupBy("bucket").agg(F.sum("size").alias("bytes")).collect()  # at most BUCKETS rows
    chosen = fill([(r["bucket"], r["bytes"]) for r in sizes], held)
    by_bucket = F.get(F.array(*[F.lit(chosen.get(b, 0)) for b in range(BUCKETS)]), F.col("bucket"))
    return rows.withColumn("shard", by_bucket).drop("bucket")


def _rounds(
    state: DataFrame, fixed: DataFrame, links: DataFrame, shards: int, capacity: float
) -> tuple[DataFrame, list[int]]:
    """``state`` (``row``, ``size``, ``unit``, ``shard``) after all rounds, and what links kept together before each; rows of
    ``fixed`` stay where they are."""
    names, still, last, kept = [f"s{i}" for i in range(shards)], 0, -1, []
    bytes_of = state.groupBy("unit").agg(F.sum("size").alias("bytes"))
    for nth in count():
        state = stored(state, "shards")
        placed = state.select("row", "size", "shard").union(fixed)
        held = {r["shard"]: r["bytes"] for r in placed.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()}
        room = [capacity - held.get(i, 0) for i in range(shards)]
        on_shard = [F.sum(F.when(F.col("shard") == i, F.col("size")).otherwise(0)).alias(names[i]) for i in range(shards)]
        hubs = stored(links.join(placed, "row").groupBy("hub").agg(*on_shard), "hubs")
        # What links keep together: units that move one after the other only ever raise it.
        together = hubs.agg(F.sum(sum(F.col(n).cast("decimal(19,0)") * F.col(n) for n in names))).first()[0] or 0
        still = 0 if together > last else still + 1
        kept.append(int(together))
        if still == VAIN or not together:
            return state, kept
        last = max(last, together)
        # A unit's own bytes in a hub move with it and pull nowhere.
        inside = links.join(state, "row").groupBy("unit", "shard", "hub").agg(F.sum("size").cast("double").alias("mine"))
        others = [F.col(names[i]) - F.when(F.col("shard") == i, F.col("mine")).otherwise(0) for i in range(shards)]
        told = [F.sum(F.col("mine") * others[i]).alias(names[i]) for i in range(shards)]
        units = inside.join(hubs, "hub").groupBy("unit", "shard").agg(*told)
        own = [F.col("shard") == i for i in range(shards)]
        pull = F.array(
            *[
                F.struct(
                    F.when(own[i] | (F.col("bytes") <= room[i]), F.col(names[i])).otherwise(F.lit(-1)).alias("told"),
                    own[i].alias("own"), F.lit(float(room[i])).alias("room"), F.lit(i).alias("to"),
                )
                for i in range(shards)
            ]
        )
        # Neighbours that move in one round may swap places, so half of the units, another each time, have a round.
        turn = F.pmod(F.xxhash64(F.lit(-1 - nth), "unit"), F.lit(2)) == 0
        wishes = units.join(bytes_of, "unit").where(turn).select(
            "unit", "bytes", "shard", F.array_max(pull)["to"].alias("to"), _bucket(F.lit(nth), "unit").alias("bucket")
        ).where("`to` <> shard")
        wishes = stored(wishes, "wishes")
        admitted = bytearray(shards * BUCKETS)
        asked = wishes.groupBy("to", "bucket").agg(F.sum("bytes").alias("bytes"))
        for r in asked.orderBy("bytes", "to", "bucket").collect():  # at most shards x BUCKETS rows
            if room[r["to"]] >= r["bytes"]:
                room[r["to"]] -= r["bytes"]
                admitted[r["to"] * BUCKETS + r["bucket"]] = 1
        at = (F.col("to") * BUCKETS + F.col("bucket") + 1).cast("int")
        moves = wishes.where(F.substring(F.lit(bytes(admitted)), at, F.lit(1)) == F.lit(b"\x01")).select("unit", "to")
        state = state.join(moves, "unit", "left").select("row", "size", "unit", F.coalesce("to", "shard").alias("shard"))


def fill(sizes: list[tuple[int, int]], held: list[float]) -> dict[int, int]:
    """A shard for each bucket (bucket, bytes), the largest first, always to the shard that holds least so far."""
    heap = [(bytes_, i) for i, bytes_ in enumerate(held)]
    heapq.heapify(heap)
    out = {}
    for bucket, bytes_ in sorted(sizes, key=lambda x: (-x[1], x[0])):
        least, i = heapq.heappop(heap)
        out[bucket] = i
        heapq.heappush(heap, (least + bytes_, i))
    return out


def gapless(rows: DataFrame, within: str, order: list[str]) -> DataFrame:
    """``slot``: the place of each row of a written table among those of its ``within``, without sorting them all."""
    placed = stored(rows.withColumn("_part", F.spark_partition_id()), "placed")
    inside = Window.partitionBy("_part", within).orderBy(*order)
    before = Window.partitionBy(within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_part", within).agg(F.count("*").alias("_n"))
    base = counts.select("_part", within, F.coalesce(F.sum("_n").over(before), F.lit(0).cast("bigint")).alias("_base"))
    numbered = placed.withColumn("_nth", F.row_number().over(inside) - 1).join(base, ["_part", within])
    return numbered.withColumn("slot", F.col("_base") + F.col("_nth")).drop("_part", "_nth", "_base")


def shard_by_text(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` of every row of ``docs``.

    Rows of equal texts are linked. The law is ``bytes``: shards hold nearly equal sums of sizes, a size being the UTF-8
    bytes of the text and one more; ``grown_shard`` is null under it. A group of equal texts is cut only where no shard
    has room for the whole of it. A null text counts as empty. Repeated rows and null ids are rows of their own; an empty
    table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stored(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b")).alias("hub"),
        ),
        "shard-rows",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    share = max(total, 1) / shards
    groups = rows.groupBy("hub").agg(F.count("*").alias("n")).where("n > 1").select("hub")
    links = stored(rows.join(groups, "hub", "left_semi").select("row", "size", "hub"), "links")
    state = propagate(links.select("row", "size"), links.select("row", "hub"), shards, share)
    state = stored(state, "linked")

    held = [0.0] * shards
    for r in state.groupBy("shard").agg(F.sum("size").alias("bytes")).collect():
        held[r["shard"]] = r["bytes"]
    placed = rows.join(state.select("row", "shard"), "row", "left").withColumn("bucket", _bucket("row"))
    alone = placed.where("shard IS NULL").groupBy("bucket").agg(F.sum("size").alias("bytes")).collect()  # BUCKETS rows
    chosen = fill([(r["bucket"], r["bytes"]) for r in alone], held)
    by_bucket = F.get(F.array(*[F.lit(chosen.get(b, 0)) for b in range(BUCKETS)]), F.col("bucket"))
    done = placed.withColumn("shard", F.coalesce("shard", by_bucket)).select("doc_id", "row", "size", "text_crc32", "shard")
    return gapless(done, "shard", ["row"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
