"""Mixing sources to target weights by a proportionate-fair schedule.

Documents of a source come in blocks of ``block_docs``. Weights are whole parts of
``slots``: a source of q parts has its k-th block (from 0) released at k * slots / q,
rounded down, and due by (k + 1) * slots / q, rounded up. Going slot by slot and taking the
released block due first (of equals the source that sorts first) meets every due time,
so at each slot every source is less than one block away from its weight's share.

The schedule repeats after ``slots`` slots, so it is worked out once, for at most ``slots``
rows; each document then finds its slot from its rank in its source alone. A source that has
no blocks left leaves its slots empty, and the others close up: no document is dropped or
repeated. ``position`` is the place of a document in the whole mix, without gaps.

Within a source documents are in the order of md5(doc_id), then id, then text. Null sources
are one source of their own, the first; a null id sorts first. Repeated rows take one place
each. Sources that no weight is given for have weight 0, and every source gets at least
one slot. Ranks need no task to hold a source: they are counted by stretches of md5.

More sources than slots are mixed in groups: the heaviest are scheduled as they are, the others are dealt
out to groups by falling weight, each group is scheduled like a source of their joint weight, and its slots by a
schedule of its own among its members, and so on. A source in a group is then less than one block, and its share of
the group more, away from its weight's share. Places come from the numbers of documents in earlier slots, counted
by ranges of slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourtally.llm import stored

SLOTS = 1000
BLOCK_DOCS = 8
# Documents of a stretch ranked together, about.
STRETCH = 512


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit(""))


def default_weights(sizes: DataFrame) -> DataFrame:
    """Thousandths of the square root of each size: small sources get more than their share."""
    return sizes.withColumn("weight", F.floor(F.sqrt("n") * 1000).cast("long"))


def parts(weighted: DataFrame, slots: int = SLOTS, *group: str) -> DataFrame:
    """``key, n, q``: whole parts of ``slots`` in proportion to ``weight``, one at least, by
    largest remainders, in each group. Raises if there are more sources than slots."""
    everything = Window.partitionBy(*group)
    spare = F.lit(slots) - F.count("*").over(everything)
    total = F.greatest(F.sum("weight").over(everything), F.lit(1))
    scaled = weighted.select(
        *group, "key", "n", (F.col("weight").cast("decimal(38,0)") * spare).alias("share"), total.cast("decimal(38,0)").alias("total"), spare.alias("spare")
    )
    scaled = scaled.withColumn("whole", F.expr("cast(share div total as bigint)")).withColumn("rest", F.expr("share % total"))
    place = F.row_number().over(everything.orderBy(F.desc("rest"), "key"))
    left = F.col("spare") - F.sum("whole").over(everything)
    q = F.lit(1) + F.col("whole") + (place <= left).cast("long")
    enough = F.assert_true(F.col("spare") >= 0, F.lit("more sources than slots"))
    return scaled.select(*group, "key", "n", F.when(enough.isNull(), q).alias("q"))


def schedule(shares: DataFrame, *group: str, state: bool = True) -> DataFrame:
    """``key, turn, slot, q, slots, done, sizes, all_q``: one row for each slot of a period, in each group.

    ``turn`` counts the slots of a source from 0; ``done`` has how many blocks each source
    has had before the slot. Without ``state`` the last three are left out.
    """
    listed = shares.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("key", "q", "n"))).alias("s"))
    kept, kinds = (", 'done', acc.done", ", done: array<bigint>") if state else ("", "")
    pick = """array_min(filter(
        zip_with(acc.done, sequence(0, size(s) - 1), (d, i) -> named_struct(
          'due', -(-(d + 1) * slots div s[i].q) + if((d + 1) * slots % s[i].q = 0, 0L, 1L),
          'i', i, 'released', d * slots div s[i].q)),
        x -> x.released <= t)).i"""
    # The pick of a slot is bound to p, so that it is found once.
    walk = f"""
        aggregate(
          sequence(0, cast(slots - 1 as int)),
          named_struct('done', transform(s, x -> 0L), 'steps', cast(array() as array<struct<pick: int, turn: bigint{kinds}>>)),
          (acc, t) -> transform(array({pick}), p -> named_struct(
            'done', zip_with(acc.done, sequence(0, size(s) - 1), (d, i) -> d + if(i = p, 1L, 0L)),
            'steps', concat(acc.steps, array(named_struct('pick', p, 'turn', acc.done[p]{kept})))))[0],
          acc -> acc.steps)
    """
    whole = listed.where(F.size("s") > 0).withColumn("slots", F.expr("aggregate(s, 0L, (a, x) -> a + x.q)"))
    stepped = whole.withColumn("steps", F.expr(walk))
    rows = stepped.select(*group, "s", "slots", F.posexplode("steps").alias("slot", "step"))
    columns = [
        F.expr("s[step.pick].key").alias("key"),
        F.col("step.turn").alias("turn"),
        F.col("slot").cast("long").alias("slot"),
        F.expr("s[step.pick].q").alias("q"),
        F.col("slots"),
    ]
    if state:
        columns += [F.col("step.done").alias("done"), F.expr("transform(s, x -> x.n)").alias("sizes"), F.expr("transform(s, x -> x.q)").alias("all_q")]
    return rows.select(*group, *columns)


def ranked(docs: DataFrame) -> DataFrame:
    """``row, key, rank``: every row whole, and its place in its source from 0."""
    digits, count = 1, docs.count()
    while count > STRETCH * 16**digits:
        digits += 1
    rows = docs.select(F.struct("*").alias("row"))
    doc_id = F.col("row.doc_id")
    order = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    marked = rows.select("row", _key(F.col("row.source")).alias("key"), order.alias("order"))
    marked = marked.withColumn("stretch", F.substring("order", 1, digits))
    sizes = marked.groupBy("key", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("key", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    text = [F.asc_nulls_first("row.text")] if "text" in docs.columns else []
    inside = Window.partitionBy("key", "stretch").orderBy("order", F.asc_nulls_first("row.doc_id"), *text)
    numbered = marked.withColumn("number", F.row_number().over(inside))
    joined = numbered.join(before, ["key", "stretch"])
    return joined.select("row", "key", (F.col("before") + F.col("number") - 1).alias("rank"))


def grouped(weighted: DataFrame, slots: int) -> list[DataFrame]:
    """Levels of ``group, key, n, weight, below``, from the top: what each group schedules.

    No group has more members than slots. ``below`` is true of members that are groups of the next level.
    """
    most, levels = max(1, slots // 4), []
    open_ = weighted.select(F.lit("").alias("group"), "key", "n", "weight")
    while open_.groupBy("group").count().agg(F.max("count")).first()[0] > slots:
        place = F.row_number().over(Window.partitionBy("group").orderBy(F.desc("weight"), "key"))
        counted = open_.withColumns({"place": place, "members": F.count("*").over(Window.partitionBy("group"))})
        alone = (F.col("members") <= slots) | (F.col("place") <= most)
        name = F.concat("group", F.lit("/"), (F.col("place") % most).cast("string"))
        counted = stored.written(counted.select("group", "key", "n", "weight", F.when(~alone, name).alias("into")), "groups")
        single = counted.where("into IS NULL").select("group", "key", "n", "weight", F.lit(False).alias("below"))
        lower = counted.where("into IS NOT NULL")
        joint = lower.groupBy("group", F.col("into").alias("key")).agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"))
        levels.append(single.unionByName(joint.withColumn("below", F.lit(True))))
        open_ = lower.select(F.col("into").alias("group"), "key", "n", "weight")
    levels.append(open_.withColumn("below", F.lit(False)))
    return levels


def _slots_in_groups(blocks: DataFrame, weighted: DataFrame, slots: int) -> DataFrame:
    """Blocks (``key, mix_block``) with their ``mix_slot``: from their own group's schedule up to the top's."""
    waiting = None
    for level in reversed(grouped(weighted, slots)):
        level = stored.written(level, "level")
        period = schedule(parts(level, slots, "group"), "group", state=False)
        period = stored.written(period, "period")
        own = blocks.join(level.where(~F.col("below")).select("key", "group"), "key")
        own = own.select("group", "key", F.col("mix_block").alias("number"), F.struct("key", "mix_block").alias("block"))
        waiting = own if waiting is None else own.unionByName(waiting)
        of_key = period.select("group", "key", "q").distinct()
        turned = waiting.join(of_key, ["group", "key"]).withColumn("turn", F.expr("number % q"))
        placed = turned.drop("q").join(period, ["group", "key", "turn"])
        number = F.expr("(number div q) * slots + slot").alias("number")
        # A group's slots are the blocks of a member of the group above.
        above = F.regexp_replace("group", "/[^/]*$", "")
        waiting = placed.select(above.alias("group"), F.col("group").alias("key"), number, "block")
    return waiting.select("block.*", F.col("number").alias("mix_slot"))


def _places(blocks: DataFrame) -> DataFrame:
    """Blocks (``mix_slot, docs``) with ``first``: how many documents are in earlier slots."""
    dealt = blocks.repartitionByRange("mix_slot").withColumn("range", F.spark_partition_id())
    dealt = stored.written(dealt, "ranges")
    sizes = dealt.groupBy("range").agg(F.sum("docs").alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each range.
    before = sizes.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("range").orderBy("mix_slot").rowsBetween(Window.unboundedPreceding, -1)
    counted = dealt.withColumn("inside", F.coalesce(F.sum("docs").over(inside), F.lit(0)))
    return counted.join(before, "range").withColumn("first", F.col("before") + F.col("inside"))


def _mixed_in_groups(docs: DataFrame, weighted: DataFrame, slots: int, block_docs: int) -> DataFrame:
    """``row, mix_block, mix_slot, position`` of documents of more sources than slots."""
    rows = ranked(docs).withColumn("mix_block", F.expr(f"rank div {int(block_docs)}"))
    blocks = stored.written(rows.groupBy("key", "mix_block").agg(F.count("*").alias("docs")), "mix-blocks")
    slotted = _slots_in_groups(blocks.select("key", "mix_block"), weighted, slots)
    placed = _places(slotted.join(blocks, ["key", "mix_block"])).select("key", "mix_block", "mix_slot", "first")
    position = (F.col("first") + F.expr(f"rank % {int(block_docs)}")).alias("position")
    return rows.join(placed, ["key", "mix_block"]).select("row", "mix_block", "mix_slot", position)


def mixed(
    docs: DataFrame, weights: dict[str | None, int] | None = None, slots: int = SLOTS, block_docs: int = BLOCK_DOCS
) -> DataFrame:
    """The rows (``doc_id``, ``source`` and any others) with ``mix_block, mix_slot, position``:
    block of the source, slot and place. Columns that had these names are replaced.

    Weights are whole numbers by source.
    """
    sizes = docs.groupBy(_key(F.col("source")).alias("key")).agg(F.count("*").alias("n"))
    if weights is None:
        weighted = default_weights(sizes)
    else:
        given = [("" if k is None else f"s{k}", int(v)) for k, v in weights.items()]
        known = docs.sparkSession.createDataFrame(given, "key string, weight long")
        weighted = sizes.join(known, "key", "left").withColumn("weight", F.coalesce("weight", F.lit(0)))
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("mix_block", "mix_slot", "position")]
    columns = (*kept, "mix_block", "mix_slot", "position")
    weighted = stored.written(weighted, "weights")
    if weighted.count() > slots:
        return _mixed_in_groups(docs, weighted, slots, block_docs).select(*columns)
    # One row for each slot of a period, so its size is set by the slots.
    period = schedule(parts(weighted, slots))
    q_of = period.groupBy("key").agg(F.first("q").alias("of_key"))
    rows = ranked(docs).withColumn("mix_block", F.expr(f"rank div {int(block_docs)}"))
    turned = rows.join(F.broadcast(q_of), "key")
    turned = turned.withColumn("round", F.expr("mix_block div of_key")).withColumn("turn", F.expr("mix_block % of_key"))
    placed = turned.join(F.broadcast(period), ["key", "turn"])
    before = f"""aggregate(zip_with(zip_with(done, all_q, (d, p) -> {int(block_docs)} * (round * p + d)), sizes,
        (b, n) -> least(b, n)), 0L, (a, x) -> a + x)"""
    position = F.expr(f"{before} + rank % {int(block_docs)}")
    slot = F.col("round") * F.col("slots") + F.col("slot")
    return placed.select("row", "mix_block", slot.alias("mix_slot"), position.alias("position")).select(*columns)
