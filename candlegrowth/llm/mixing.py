"""Mixing sources to target weights, by blocks of words: DataFrame functions only.

The documents of a source, in a fixed order, are one stream of words, cut into blocks of a fixed
length (the last may be shorter). The mix is a row of slots, dealt to output shards. Each slot
draws its source with the odds of the targets, so the counts of a shard are multinomial; draws
beyond a source's target go to sources that drew too few. The slots of a source are numbered and
numbers become blocks by a keyed permutation of the source's blocks, one per epoch. Slots and
blocks then join by (source, block).
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlegrowth.llm.common import WORD, stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
BLOCK = 64
SHARD_SLOTS = 4096
SEED = 20240607
ROUNDS = 8  # even, so that the halves end where they began
WALKS = 48
CELL = 64
MOST_SENT = 100_000  # sources whose plan is sent to all tasks; more are joined by a shuffle


def n_words(text_column="text"):
    """Words of the text as a long, NULL: 0."""
    return F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes, weights=WEIGHTS, share=SHARE, most=MOST):
    """Adds `target` to (source, source_size), one row per source.

    Sources in code point order, NULL last, take the weights in turn and share `share` times the
    words of all by weight; none gets over `most` times its own, and what it leaves is shared
    again by weight. That is a water level: with sources by rising most * size / weight, those
    before the first whose level is not above this ratio are full, the others get level * weight.
    The windows hold one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    all_rows = Window.partitionBy(F.lit(0))
    full = F.col("source_size") * F.lit(float(most))
    ranked = sizes.withColumn("weight", weight).withColumn("ratio", full / F.col("weight"))
    rise = Window.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum(full).over(rise), F.lit(0.0))
    used = F.coalesce(F.sum("weight").over(rise), F.lit(0.0))
    level = (F.sum("source_size").over(all_rows) * F.lit(float(share)) - before) / (
        F.sum("weight").over(all_rows) - used
    )
    ranked = ranked.withColumn("level", level)
    water = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(all_rows)
    return ranked.withColumn("water", water).select(
        "source", "source_size",
        F.least(full, F.coalesce(F.col("water") * F.col("weight"), full)).alias("target"),
    )


def streams(documents, id_column="doc_id", text_column="text", source_column="source"):
    """(doc_id, source, size, start): where each document's words begin in its source's stream.

    The order is by a hash bucket, then id, then text hash. Only rows of one bucket are sorted
    together, and the offsets of buckets are sums over them. There are as many buckets as the root
    of the rows, so neither step has more than about that many rows at a place, in a source of any
    size.
    """
    docs = stored(
        documents.select(
            F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"),
            n_words(text_column).alias("size"),
            F.xxhash64(F.lit(SEED), F.col(id_column), F.col(text_column)).alias("mark"),
        ),
        "mix-sizes",
    )
    buckets = max(1, int(docs.count() ** 0.5))
    docs = docs.withColumn("bucket", F.pmod("mark", F.lit(buckets)))
    sums = docs.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("offset", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "mark", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    docs = docs.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    sums = sums.select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), "offset")
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))
    return docs.join(sums, same).select(
        "doc_id", "source", "size", (F.col("offset") + F.col("inside")).alias("start")
    )


def plan(sizes, block=BLOCK, **shares):
    """One row per source: target, its whole number of words, blocks and slots.

    A pass over a source takes each full block once and then the short last one, so the words of
    the first n slots are known; `slots` is the least number that holds the words wanted, and the
    last slot is cut to what is then missing.
    """
    planned = targets(sizes, **shares).withColumn("wanted", F.round("target").cast("long"))
    size, wanted = F.col("source_size"), F.col("wanted")
    planned = (
        planned.withColumn("full", F.floor(size / block))
        .withColumn("blocks", F.ceil(size / block))
        .withColumn("passes", F.when(size > 0, F.floor(wanted / size)).otherwise(0))
    )
    return planned.withColumn(
        "slots", F.col("passes") * F.col("blocks") + F.ceil((wanted - F.col("passes") * size) / block)
    )


def _few(planned):
    return planned.count() <= MOST_SENT


def _with_source(left, right, how="inner", few=None):
    """Joins on equal sources, NULL included; right's columns come behind left's.

    `few` tells whether right, with a row per source, may be sent to all tasks. Left may be made from
    a few counts and look small to the planner, which must not send it instead.
    """
    if few is not None:
        right = F.broadcast(right) if few else right.hint("merge")
    right = right.withColumnRenamed("source", "_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _intervals(rows, width):
    """Adds first and end: intervals of the given width laid end to end, in source order."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    end = F.sum(width).over(order)
    return rows.withColumn("end", end).withColumn("first", F.col("end") - F.col(width)).where(F.col(width) > 0)


def _look_up(points, intervals, at):
    """Joins each point with the interval that holds it, over cells of CELL numbers: an equality
    join in which a cell meets at most CELL intervals."""
    cells = intervals.withColumn(
        "_cell", F.explode(F.sequence(F.floor(F.col("first") / CELL), F.floor((F.col("end") - 1) / CELL)))
    )
    return points.withColumn("_cell", F.floor(F.col(at) / CELL)).join(cells.hint("merge"), "_cell").where(
        (F.col(at) >= F.col("first")) & (F.col(at) < F.col("end"))
    ).drop("_cell")


def draws(planned, seed=SEED, shard_slots=SHARD_SLOTS):
    """(source, number, shard): the slots of each source, numbered from 0 to its slots less one.

    Shards draw their slots' sources independently; the counts per shard and source are then laid
    behind one another over the shards.
    """
    spark = planned.sparkSession
    total = planned.agg(F.sum("slots")).first()[0] or 0
    shards = -(-total // shard_slots)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = spark.range(0, total, 1, max(1, min(tasks, shards))).select(
        F.floor(F.col("id") / shard_slots).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit("slot"), "id"), F.lit(max(total, 1))).alias("point"),
    )
    shares = _intervals(planned.select("source", "slots"), "slots")
    counts = (
        _look_up(slots, shares.select("source", "first", "end"), "point")
        .groupBy("source", "shard").agg(F.count("*").alias("drawn"))
    )
    counts = stored(counts, "mix-draws")
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("offset", F.coalesce(F.sum("drawn").over(before), F.lit(0)))
    # dealt anew, as the windows hold all shards of a source in one place
    numbered = counts.repartition(tasks, "source", "shard").select(
        F.col("source"), "shard",
        F.explode(F.sequence(F.col("offset"), F.col("offset") + F.col("drawn") - 1)).alias("number"),
    )
    had = counts.groupBy("source").agg(F.sum("drawn").alias("drawn"))
    totals = _with_source(planned.select("source", "slots"), had, "left").fillna(0, "drawn")
    over = _intervals(totals.withColumn("over", F.greatest(F.col("drawn") - F.col("slots"), F.lit(0))), "over")
    under = _intervals(totals.withColumn("under", F.greatest(F.col("slots") - F.col("drawn"), F.lit(0))), "under")
    few = _few(planned)
    limited = _with_source(numbered, totals.select("source", "slots"), few=few)
    kept = limited.where("number < slots").select("source", "number", "shard")
    moved = _with_source(limited.where("number >= slots"), over.select("source", "first"), few=few).select(
        "shard", (F.col("first") + F.col("number") - F.col("slots")).alias("rank")
    )
    moved = _look_up(moved, under.select("source", "first", "end", "drawn"), "rank").select(
        "source", (F.col("drawn") + F.col("rank") - F.col("first")).alias("number"), "shard"
    )
    return kept.unionByName(moved)


def permuted(number, size, *key):
    """A keyed permutation of 0 .. size - 1.

    A Feistel network on the two digits of a number below a * b >= size, with modular addition,
    walked on until it is below size. Fewer than a numbers, about the root of size, lie outside, so
    a walk that ends needs few steps: below WALKS numbers outside it must end, and else the chance
    that it has not is under 1e-30.
    """
    a = F.greatest(F.ceil(F.sqrt(size)), F.lit(1)).cast("long")
    b = F.greatest(F.ceil(size / a), F.lit(1)).cast("long")

    def turned(s, turn):
        """(x, y) becomes (y, x + f(y)); each half keeps its modulus."""
        x = F.pmod(s["x"] + F.pmod(F.xxhash64(*key, turn, s["y"]), s["mx"]), s["mx"])
        return F.struct(s["y"].alias("x"), x.alias("y"), s["my"].alias("mx"), s["mx"].alias("my"))

    def step(x):
        halves = F.struct(
            (x % a).alias("x"), F.floor(x / a).cast("long").alias("y"), a.alias("mx"), b.alias("my")
        )
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(ROUNDS)), halves, turned, lambda s: s["x"] + s["y"] * s["mx"]
        )

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)), step(number),
        lambda x, _: F.when(x < size, x).otherwise(step(x)),
    )


def takes(planned, drawn, block=BLOCK, seed=SEED):
    """(source, number, shard, block, take): the block of each slot and how many of its words."""
    slots = _with_source(drawn, planned, few=_few(planned)).withColumn(
        "pass", F.floor(F.col("number") / F.col("blocks"))
    ).withColumn("turn", F.col("number") % F.col("blocks"))
    chosen = permuted(F.col("turn"), F.col("full"), F.lit(seed), F.col("source"), F.col("pass"))
    taken_before = F.col("pass") * F.col("source_size") + F.col("turn") * block
    words = F.least(F.lit(block), F.col("source_size") - F.col("block") * block)
    return slots.withColumn(
        "block", F.when(F.col("turn") < F.col("full"), chosen).otherwise(F.col("full"))
    ).select(
        "source", "number", "shard", "block",
        F.greatest(F.least(words, F.col("wanted") - taken_before), F.lit(0)).cast("long").alias("take"),
    )


def pieces(docs, block=BLOCK):
    """(doc_id, source, size, start, block, at, length): the part of each document in each block."""
    start, end = F.col("start"), F.col("start") + F.col("size")
    cut = docs.withColumn(
        "block",
        F.explode_outer(F.when(
            F.col("size") > 0,
            F.sequence(F.floor(start / block), F.floor((end - 1) / block)),
        )),
    )
    at = F.greatest(start - F.col("block") * block, F.lit(0))
    return cut.withColumn("at", at).withColumn(
        "length", F.least(end - F.col("block") * block, F.lit(block)) - F.col("at")
    )


def mix(documents, id_column="doc_id", text_column="text", source_column="source", block=BLOCK, seed=SEED):
    """The mix as rows (doc_id, source, size, start, source_size, target, shard, number, block, at,
    words): for every slot the words of each document in it, from word `at` of the block on.

    A document that no slot takes has one row with NULL slot columns and 0 words. NULL is a source
    like any other; a NULL or blank text has no words; repeated rows are documents of their own;
    an empty table gives no rows. Only the three named columns are read.
    """
    docs = stored(streams(documents, id_column, text_column, source_column), "mix-streams")
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    planned = stored(plan(sizes, block), "mix-plan")
    slots = takes(planned, draws(planned, seed), block, seed).withColumnRenamed("source", "_source")
    cut = pieces(docs, block)
    same = cut["source"].eqNullSafe(slots["_source"]) & (cut["block"] == slots["block"])
    # the slots are made from a few counts and look small to the planner; they grow with the words
    joined = cut.join(slots.hint("merge"), same, "left").select(
        "doc_id", "source", "size", "start", "shard", "number", cut["block"].alias("block"), "at",
        F.when(
            F.col("take") > F.col("at"), F.least(F.col("length"), F.col("take") - F.col("at"))
        ).otherwise(0).alias("words"),
    )
    return _with_source(joined, planned.select("source", "source_size", "target"), few=_few(planned))


def taken(documents, id_column="doc_id", text_column="text", source_column="source", block=BLOCK, seed=SEED):
    """(doc_id, source, size, source_size, target, taken): words the mix takes of each document.

    A document's blocks are used at most twice, so it gives at most twice its words.
    """
    rows = mix(documents, id_column, text_column, source_column, block, seed)
    # a document without words shares its start with the next one, hence the size in the key
    return rows.groupBy("doc_id", "source", "start", "size").agg(
        F.max("source_size").alias("source_size"), F.max("target").alias("target"),
        F.sum("words").alias("taken"),
        F.count_if(F.col("size") == 0).alias("copies"),
    ).select(
        "doc_id", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"),
        F.explode(F.array_repeat(F.lit(1), F.greatest(F.col("copies"), F.lit(1)).cast("int"))).alias("_row"),
    ).drop("_row")


def op5_mixing(spark, folder):
    """Words that the mix takes of each document, with the targets of the sources."""
    return taken(spark.read.parquet(f"{folder}/documents.parquet"))
