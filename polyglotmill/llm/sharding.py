"""Sharding (operator 6): balanced label propagation, in DataFrame operations only.

Documents that share a hub (for the query: an equal text) are linked through
it, never pair by pair. Each document starts in a shard by a hash of its id.
In a round, every hub looks at the shards that hold its documents, and at one
more with room (drawn by a hash, in proportion to the room), and names as few
of them as have place for all its documents: first those that could take the
whole hub, then those that hold most of it. So a hub that is larger than a
shard names several. Its documents in a named shard stay; the others ask to
move to a named one, dealt in proportion to the room there. Of a shard's
askers, those of the largest hubs are moved, as many as it has room (capacity
quotas, dealt to BUCKET_ROWS-sized buckets of askers). Room counts linked
documents only, since unlinked ones can give way without cutting a link, and
has some slack, without which full shards could never swap documents.

Rounds go on until no move is granted, or until neither the number of linked
pairs that share a shard rises nor that of (hub, shard) places, the cut, falls
by SETTLED of itself. ROUNDS is a guard far beyond
that; `propagate` can report the rounds it took and the pairs that it kept.

Then sizes are made even: the law is `rows`, so shard counts differ by one at
most. Shards that are over their count give up documents, unlinked ones first,
to shards that are under theirs. Slots number each shard from 0 without gaps.
Ranks are two-level (bucket counts, then rows in a bucket), so no task sorts a
whole shard.

Only keys, ids, sizes and hubs are shuffled in the rounds, not the texts; every
round's state is written to shared storage. Rows carry a key that is written
with them once. A hub's documents meet what it names in parts of BUCKET_ROWS.

Cases: null text counts as empty and is linked with empty texts. A null doc_id
is placed by its hash like any other; repeated rows are rows of their own and
linked; equal ones tie and are interchangeable. Very long texts are read as a
length, a checksum and a digest. Fewer documents than shards leave shards
empty. An empty table gives no rows. `place` picks names for its own columns
that docs does not have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SHARDS = 40
#: A guard; the tests' and fixtures' tables settle in ten rounds or fewer.
ROUNDS = 60
SETTLED = 0.001
#: How far beyond its count a shard may be filled with linked documents while labels move.
SLACK = 0.1
#: Rows that one task of a ranking window gets, about.
BUCKET_ROWS = 50_000
#: Parts that a hub's documents are dealt to when they learn its size.
SALTS = 16
SIZE_EXTRA = 16


def _home(shards: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "hub"), F.lit(shards)).cast("int")


def linked_nodes(base: DataFrame, shards: int) -> DataFrame:
    """key, hub, members, part, shard of the rows whose hub has several; part deals a hub's rows to BUCKET_ROWS each."""
    hubs = base.groupBy("hub").agg(F.count("*").alias("members")).where("members > 1").select("hub", "members", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = base.select("key", "hub", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int").alias("salt"), _home(shards).alias("home"))
    part = F.pmod(F.xxhash64("key", "hub"), F.ceil(F.col("members") / BUCKET_ROWS)).cast("int")
    # Equal rows would all start in one shard; the members of a large hub start everywhere.
    shard = F.when(F.col("members") > shards, F.pmod(F.xxhash64("key", "home"), F.lit(shards)).cast("int")).otherwise(F.col("home"))
    return rows.join(hubs.hint("merge"), ["hub", "salt"]).select("key", "hub", "members", part.alias("part"), shard.alias("shard"))


def named_shards(votes: DataFrame, load: DataFrame, capacity: int) -> DataFrame:
    """hub, members, named (array of shard, until): the shards that a hub names, with running sums of the room there; hubs in one shard only are left out."""
    room = load.select("shard", F.greatest(F.lit(capacity) - F.col("load"), F.lit(0)).alias("room"))
    # One row of at most `shards` entries: the running sums of room, for a draw in proportion to it.
    sums = room.agg(F.array_sort(F.collect_list(F.struct("shard", "room"))).alias("rooms"), F.sum("room").alias("free"))
    own = votes.join(F.broadcast(room), "shard").select("hub", "members", "shard", "n", "room")
    hubs = votes.groupBy("hub").agg(F.first("members").alias("members"), F.count("*").alias("places")).where("places > 1").select("hub", "members")
    at = F.floor((F.pmod(F.xxhash64("hub"), F.lit(1 << 30)) / (1 << 30)) * F.col("free"))
    drawn = F.aggregate("rooms", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(None).cast("int").alias("shard"), F.lit(0).cast("long").alias("room")), lambda a, r: F.when(
        (a["shard"].isNull()) & (a["sum"] + r["room"] > F.col("at")), F.struct((a["sum"] + r["room"]).alias("sum"), r["shard"].alias("shard"), r["room"].alias("room"))
    ).otherwise(F.struct((a["sum"] + r["room"]).alias("sum"), a["shard"].alias("shard"), a["room"].alias("room"))))
    guests = hubs.join(F.broadcast(sums)).withColumn("at", at).withColumn("drawn", drawn).where("drawn.shard is not null").select("hub", "members", F.col("drawn.shard").alias("shard"), F.lit(0).cast("long").alias("n"), F.col("drawn.room").alias("room"))
    every = own.unionByName(guests).groupBy("hub", "members", "shard").agg(F.max("n").alias("n"), F.max("room").alias("room"))
    fit = F.least(F.col("members"), F.col("n") + F.col("room"))
    entry = F.struct((-fit).alias("fit"), (-F.col("n")).alias("less"), F.xxhash64("hub", "shard").alias("tie"), "shard", "room")
    lists = every.groupBy("hub", "members").agg(F.array_sort(F.collect_list(entry)).alias("ranked")).where(F.size("ranked") > 1)
    # The shortest start of the list that holds all members.
    start = F.aggregate("ranked", F.struct(F.lit(0).cast("long").alias("held"), F.lit(0).alias("count")), lambda a, r: F.when(
        a["held"] >= F.col("members"), a).otherwise(F.struct((a["held"] - r["fit"]).alias("held"), (a["count"] + 1).alias("count"))))
    chosen = lists.join(hubs.select("hub"), "hub", "left_semi").withColumn("named", F.slice("ranked", 1, start["count"]))
    named = F.transform("named", lambda x, i: F.struct(x["shard"].alias("shard"), F.aggregate(F.slice("named", 1, i + 1), F.lit(0).cast("long"), lambda a, y: a + y["room"]).alias("until")))
    return chosen.select("hub", "members", named.alias("named"))


def propagate(nodes: DataFrame, shards: int, capacity: int, rounds: int = ROUNDS, report: list | None = None) -> DataFrame:
    """What `linked_nodes` gives -> the same after label propagation under quotas. `report` gets (round, pairs kept, places) for each round."""
    spark, kept, cuts = nodes.sparkSession, -1, float("inf")
    every = spark.range(shards).select(F.col("id").cast("int").alias("shard"))
    for turn in range(rounds):
        votes = cut(nodes.groupBy("hub", "members", "shard").agg(F.count("*").alias("n")))
        places, pairs = (int(x or 0) for x in votes.agg(F.count("*"), F.sum(F.col("n").cast("decimal(38,0)") * (F.col("n") - 1) / 2)).first())
        load = cut(every.join(votes.groupBy("shard").agg(F.sum("n").alias("load")), "shard", "left").select("shard", F.coalesce("load", F.lit(0)).alias("load")))
        if report is not None:
            report.append((turn, pairs, places))
        if pairs <= kept * (1 + SETTLED) and places >= cuts * (1 - SETTLED):
            break
        kept, cuts = pairs, places
        names = named_shards(votes, load, capacity).withColumn("part", F.explode(F.sequence(F.lit(0), F.ceil(F.col("members") / BUCKET_ROWS).cast("int") - 1))).drop("members")
        asks = nodes.join(names.hint("merge"), ["hub", "part"]).where(~F.exists("named", lambda x: x["shard"] == F.col("shard")))
        # A draw in proportion to the room of what the hub names; without room there is no ask.
        total = F.element_at("named", -1)["until"]
        asks = asks.where(total > 0).withColumn("draw", F.pmod(F.xxhash64("key", F.lit(turn)), total))
        asks = asks.select("key", "hub", "members", F.filter("named", lambda x: x["until"] > F.col("draw"))[0]["shard"].alias("target"))
        asks = cut(asks)
        counts = asks.groupBy("target").agg(F.count("*").alias("asked"))
        quota = counts.join(load.withColumnRenamed("shard", "target"), "target").select("target", F.greatest(F.lit(capacity) - F.col("load"), F.lit(0)).alias("room"), F.ceil(F.col("asked") / BUCKET_ROWS).cast("int").alias("buckets"))
        placed = asks.join(F.broadcast(quota), "target").withColumn("bucket", F.pmod(F.xxhash64("hub", F.pmod(F.xxhash64("key"), F.col("buckets"))), F.col("buckets")))
        # Each bucket has its share of the room, and the shares add up to it: a shard's askers are ranked in parallel.
        share = F.floor(F.col("room") * (F.col("bucket") + 1) / F.col("buckets")) - F.floor(F.col("room") * F.col("bucket") / F.col("buckets"))
        order = Window.partitionBy("target", "bucket").orderBy(F.desc("members"), "hub", "key")
        moves = cut(placed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= share).select("key", "target"))
        if moves.limit(1).count() == 0:
            break
        nodes = cut(nodes.join(moves.hint("merge"), "key", "left").select("key", "hub", "members", "part", F.coalesce("target", "shard").alias("shard")))
    return nodes


def _ranked(rows: DataFrame, by: str, n: int) -> DataFrame:
    """rows with `rank` (from 0) in each value of `by`: linked ones first. Two levels, so that no task sorts a whole value."""
    buckets = max(1, n // BUCKET_ROWS)
    bucket = F.when(F.col("linked"), F.pmod(F.xxhash64("hub", F.pmod(F.xxhash64("key"), F.lit(buckets))), F.lit(buckets))).otherwise(F.lit(buckets) + F.pmod(F.xxhash64("key"), F.lit(buckets)))
    rows = rows.withColumn("bucket", bucket)
    sums = rows.groupBy(by, "bucket").agg(F.count("*").alias("n"))
    before = sums.withColumn("before", F.sum("n").over(Window.partitionBy(by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).select(by, "bucket", "before")
    inner = Window.partitionBy(by, "bucket").orderBy("hub", "doc_id", "key")
    return rows.withColumn("inner", F.row_number().over(inner) - 1).join(before, [by, "bucket"]).withColumn("rank", (F.col("before") + F.col("inner")).cast("long")).drop("bucket", "before", "inner")


def assign(base: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, report: list | None = None) -> DataFrame:
    """base (key, doc_id, hub, ...), a written table -> with shard and slot; law `rows`."""
    n = base.count()
    low, extra = divmod(n, shards)
    linked = cut(linked_nodes(base, shards))
    moved = propagate(linked, shards, int(low * (1 + SLACK)) + 1, rounds, report).select("key", F.col("shard").alias("moved"))
    rows = base.join(moved.hint("merge"), "key", "left").select(*base.columns, F.col("moved").isNotNull().alias("linked"), F.coalesce("moved", _home(shards)).alias("shard"))
    rows = cut(_ranked(rows, "shard", max(1, n // shards)))
    # Shards 0 .. extra-1 take one row more. What is over goes, in order, to what is under.
    share = (F.lit(low) + (F.col("shard") < extra).cast("int")).cast("long")
    counts = rows.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")).join(rows.groupBy("shard").agg(F.count("*").alias("n")), "shard", "left").select("shard", F.coalesce("n", F.lit(0)).alias("n"), share.alias("share"))
    run = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    # One row per shard: a table of fixed size.
    plan = counts.withColumn("over", F.greatest(F.col("n") - F.col("share"), F.lit(0))).withColumn("under", F.greatest(F.col("share") - F.col("n"), F.lit(0)))
    plan = cut(plan.withColumn("over_before", F.sum("over").over(run) - F.col("over")).withColumn("under_before", F.sum("under").over(run) - F.col("under")))
    stay = rows.join(F.broadcast(plan.select("shard", "n", "share", "over_before")), "shard")
    place = F.col("over_before") + F.col("rank") - F.col("share")
    kept = stay.where("rank < share").select(*base.columns, "shard", F.col("rank").alias("slot"))
    gone = stay.where("rank >= share").withColumn("place", place).drop("shard", "n", "share", "over_before")
    room = plan.where("under > 0").select(F.col("shard"), F.col("n").alias("filled"), "under_before", "under")
    taken = gone.join(F.broadcast(room), (F.col("place") >= F.col("under_before")) & (F.col("place") < F.col("under_before") + F.col("under")))
    return kept.unionByName(taken.select(*base.columns, "shard", (F.col("filled") + F.col("place") - F.col("under_before")).alias("slot")))


def nodes_of(docs: DataFrame, key: Column) -> DataFrame:
    """key, doc_id, hub (of equal texts), size and text_crc32 of every row; texts are read once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(key.alias("key"), "doc_id", F.md5(text).alias("hub"), (F.octet_length(text).cast("long") + SIZE_EXTRA).alias("size"), F.crc32(text).alias("text_crc32"))


def report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    out = assign(cut(nodes_of(docs, F.monotonically_increasing_id())), shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def place(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """docs with two more columns, shard and slot (names that docs has already are replaced).

    Links are those of equal texts. Rows get a key that is written with them, and meet their places by it.
    """
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    key = next(f"__key{i}" for i in range(len(docs.columns) + 1) if f"__key{i}" not in docs.columns)
    keyed = cut(docs.select(*names, F.monotonically_increasing_id().alias(key)))
    placed = assign(cut(nodes_of(keyed, F.col(key))), shards).select(F.col("key").alias(key), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))
    return keyed.join(placed.hint("merge"), key).select(*names, "shard", "slot")
