"""Mixing sources to target weights by a low-discrepancy schedule.

A document's size is its number of ``[^\\x20\\x09-\\x0D]+`` runs. Sources in code point order, null
last, weigh by a repeating list of weights and share ``share`` of all sizes; a target stops at
``repeats`` times its source's size and the excess goes to the others by weight, until none is above.
That is a level: a target is its weight times the level, or what it stops at. In the order of size over
weight those that stop come first, so running sums of sizes and weights tell the level, exactly.

Each source's documents, shuffled by a hash, lie one after another on a line of words, which is cut
into equal blocks. A slot's point, the fractional part of its number times the golden ratio to 62 bits,
maps through the sources' cumulative shares of slots to a source, and its rank among the source's slots
picks the block; ranks beyond the last block start the line again, up to ``repeats`` rounds, later
slots are left out. Joining blocks with slots gives what the mix takes of each document.

Sources are a table, not a list on the driver: running sums over them are by ranges of their order, and
points find their source by a join on cells of the unit interval, about as many as there are sources.
Prefix sums over documents are by range of the hash: totals of ranges first, in blocks, then positions
within each, so that no source or range is in one task, and the number of ranges grows with the input.

Null text has size 0; a document without words is returned with ``taken`` 0. Documents that repeat an
identifier are ordered by their text's hash; exact repeats of a row are each laid on the line. A null
identifier is an identifier of its own. An empty table, or one without words, takes nothing.
Other columns are not read by ``mix_sources``; ``mixed_documents`` hands them on.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import ship_package, staged

WEIGHTS = (5, 2, 1)
#: Fixed value: the golden ratio's fractional part, as a share of 2**64.
GOLDEN = 0x9E3779B97F4A7C15
#: Points and shares are whole numbers below this.
UNIT = 1 << 62
#: Parts of a slot that a source's share is rounded to.
FINE = 1 << 20
#: Sources are broadcast if a count shows that there are at most so many.
SMALL = 100_000
SIZE = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SIZE)), F.lit(0)).cast("long")


def golden_point(slot: str) -> Column:
    """The fractional part of slot times the golden ratio, as a share of 2**62; it starts again after 2**64 slots."""
    return F.expr(f"cast((cast({slot} as decimal(38,0)) * {GOLDEN}BD % {1 << 64}BD) div 4 as bigint)")


def earlier(sums: DataFrame, key: str, value: str, block: int = 1024) -> DataFrame:
    """(key, part, before): the sum of ``value`` over a key's earlier parts, by blocks of parts and within them."""
    blocked = sums.withColumn("_block", F.floor(F.col("part") / block))
    totals = blocked.groupBy(key, "_block").agg(F.sum(value).alias("_total"))
    so_far = totals.select(F.col(key).alias("_key"), F.col("_block").alias("_of"), (F.sum("_total").over(Window.partitionBy(key).orderBy("_block")) - F.col("_total")).alias("_earlier"))
    within = blocked.withColumn("_within", F.sum(value).over(Window.partitionBy(key, "_block").orderBy("part")) - F.col(value))
    joined = within.join(so_far, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_block") == F.col("_of")))
    return joined.select(key, "part", (F.col("_earlier") + F.col("_within")).alias("before"))


def ranged(frame: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The frame dealt out by ranges of an order, with each row's place in it as ``at``: the range's number above 33 bits."""
    return staged(frame.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), name)


def running(frame: DataFrame, values: dict[str, Column]) -> DataFrame:
    """A ranged frame with running sums: what the values of the rows before each row come to."""
    cast = {k: v.cast("decimal(38,0)") for k, v in values.items()}
    rows = frame.withColumn("_part", F.shiftright("at", 33)).withColumns({f"_{k}": v for k, v in cast.items()})
    sums = rows.groupBy("_part").agg(*[F.sum(f"_{k}").alias(f"_all_{k}") for k in values])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    parts = sums.select(F.col("_part").alias("_of"), *[F.coalesce(F.sum(f"_all_{k}").over(before), F.lit(0)).alias(f"_before_{k}") for k in values])
    within = Window.partitionBy("_part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    found = rows.join(parts, F.col("_part") == F.col("_of"))
    sums_so_far = [(F.col(f"_before_{k}") + F.coalesce(F.sum(f"_{k}").over(within), F.lit(0))).cast("decimal(38,0)").alias(k) for k in values]
    return found.select(*frame.columns, *sums_so_far)


def with_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, repeats: int = 3) -> DataFrame:
    """The rows (source, source_size) with each source's target, as ``at`` ordered by source."""
    ordered = ranged(sizes, [F.col("source").isNull(), F.col("source")], "sources")
    placed = running(ordered, {"place": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights)).cast("int") + 1)
    whole = math.lcm(*weights)
    weighed = ranged(placed.withColumn("weight", weight).drop("at", "place").withColumn("ratio", F.expr(f"cast(source_size as decimal(38,0)) * ({whole} div weight)")), [F.col("ratio"), F.col("source").isNull(), F.col("source")], "weighed")
    so_far = staged(running(weighed, {"sizes_before": F.col("source_size"), "weights_before": F.col("weight")}), "levels")
    all_size, all_weight = so_far.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = int(Fraction(share) * (all_size or 0))
    # Of the sources in order, the first whose stop is not below its weight's part of what the ones before leave.
    left = f"({wanted} - {repeats} * sizes_before)"
    level = so_far.where(F.expr(f"{repeats}BD * source_size * ({all_weight or 0} - weights_before) >= weight * {left}")).agg(F.min_by(F.struct(F.expr(left).cast("double").alias("words"), (F.lit(all_weight) - F.col("weights_before")).cast("double").alias("weight")), "at")).first()[0]
    stop = (F.col("source_size") * repeats).cast("double")
    target = stop if level is None else F.least(stop, F.col("weight") * F.lit(level.words) / F.lit(level.weight))
    return so_far.select("source", "source_size", target.alias("target"))


class Mix:
    """A planned mix: its documents with positions, its sources, and its schedule."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], share: float, repeats: int, block_words: int, least_blocks: int, range_docs: int):
        self.repeats = repeats
        ship_package(docs.sparkSession)
        slim = docs.select(
            F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col).cast("string")).alias("size"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash")
        ).withColumn("spread", F.xxhash64(F.lit("mix"), "doc_id", "text_hash"))
        self.sized = staged(slim, "sizes")
        per = staged(self.sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), "sources")
        self.n_sources, n_docs = per.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        # A source's blocks are alike, so its slots are its target over its block's words.
        blocks = F.greatest(F.least("source_size", F.greatest(F.ceil(F.col("source_size") / block_words), F.lit(least_blocks))), F.lit(1)).cast("long")
        planned = with_targets(per.select("source", "source_size"), weights, share, repeats).withColumn("n_blocks", blocks)
        slots = F.when(F.col("source_size") > 0, F.floor(F.col("target") * F.col("n_blocks") / F.col("source_size") * FINE)).otherwise(0).cast("long")
        ordered = ranged(planned.withColumn("fine", slots), [F.col("source").isNull(), F.col("source")], "planned")
        shares = staged(running(ordered, {"fine_before": F.col("fine"), "place": F.lit(1)}), "shares")
        total = shares.agg(F.sum("fine")).first()[0] or 0
        self.n_slots = round(total / FINE)
        edge = lambda x: F.expr(f"cast(({x}) * {UNIT}BD div {max(total, 1)}BD as bigint)")
        self.sources = shares.select("source", "source_size", "target", "n_blocks", F.col("place").cast("long").alias("place"), edge("fine_before").alias("low"), edge("fine_before + fine").alias("high"))
        self.n_ranges = max(16, n_docs // range_docs)

    def few(self, frame: DataFrame) -> DataFrame:
        """A frame of a row or two for each source, broadcast if the sources are few."""
        return F.broadcast(frame) if self.n_sources <= SMALL else frame

    def schedule(self) -> DataFrame:
        """(slot, source, place, rank, block, round): which block each slot takes; rank counts the source's slots from 0.

        A slot's rank is the number of its source's slots in earlier ranges of slots, and those before
        it in its own range.
        """
        spark, range_slots = self.sized.sparkSession, 1 << 16
        shift = 62 - max(4, self.n_sources.bit_length())
        cells = self.sources.where("high > low").withColumn("cell", F.explode(F.sequence(F.shiftright("low", shift), F.shiftright(F.col("high") - 1, shift)))).select("source", "place", "n_blocks", "low", "high", "cell")
        points = spark.range(self.n_slots).select(F.col("id").alias("slot"), F.floor(F.col("id") / range_slots).alias("part"), golden_point("id").alias("point")).withColumn("cell", F.shiftright("point", shift))
        slots = points.join(self.few(cells), "cell").where("low <= point and point < high").select("slot", "part", "source", "place", "n_blocks")
        counts = slots.groupBy("place", "part").agg(F.count(F.lit(1)).alias("n"))
        before = earlier(counts, "place", "n")
        within = Window.partitionBy("place", "part").orderBy("slot")
        ranks = slots.withColumn("nth", F.row_number().over(within) - 1).join(before, ["place", "part"]).withColumn("rank", F.col("before") + F.col("nth"))
        return ranks.select("slot", "source", "place", "rank", (F.col("rank") % F.col("n_blocks")).alias("block"), F.floor(F.col("rank") / F.col("n_blocks")).alias("round")).where(F.col("round") < self.repeats)

    def placed(self) -> DataFrame:
        """Documents with words, their source, and where each begins on its line."""
        sources = self.few(self.sources.select(F.col("source").alias("s"), "place", "source_size", "n_blocks", "target"))
        rows = self.sized.join(sources, F.col("source").eqNullSafe(F.col("s"))).drop("s").where("size > 0").withColumn("part", F.pmod(F.shiftright("spread", 20), F.lit(self.n_ranges)))
        sums = rows.groupBy("place", "part").agg(F.sum("size").alias("words"))
        before = earlier(sums, "place", "words")
        order = Window.partitionBy("place", "part").orderBy("spread", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
        within = rows.withColumn("in_part", F.coalesce(F.sum("size").over(order), F.lit(0)))
        return within.join(before, ["place", "part"]).withColumn("start", F.col("in_part") + F.col("before")).drop("in_part", "before", "part", "spread")

    def pieces(self) -> DataFrame:
        """Documents cut at block borders: those of ``placed`` with block, words and from."""
        # Block b is [b * size // n, (b + 1) * size // n), so word w is in block ((w + 1) * n - 1) // size.
        block_at = lambda word: F.expr(f"cast(((cast({word} as decimal(38,0)) + 1) * n_blocks - 1) div source_size as long)")
        border = lambda block: F.expr(f"cast((cast({block} as decimal(38,0)) * source_size) div n_blocks as long)")
        cut = self.placed().withColumn("block", F.explode(F.sequence(block_at("start"), block_at("start + size - 1"))))
        low, high = F.greatest(border("block"), F.col("start")), F.least(border("block + 1"), F.col("start") + F.col("size"))
        return cut.withColumn("words", high - low).withColumn("from", low - F.col("start"))

    def taken(self) -> DataFrame:
        """One row per document: doc_id, size, source_size, target, taken, and what tells it from others."""
        uses = self.schedule().groupBy("place", "block").agg(F.count(F.lit(1)).alias("times"))
        used = self.pieces().join(uses, ["place", "block"], "left")
        key = ["doc_id", "source", "size", "text_hash", "start", "source_size", "target"]
        found = used.groupBy("place", *key).agg(F.sum(F.col("words") * F.coalesce(F.col("times"), F.lit(0))).alias("taken")).drop("place")
        sources = self.few(self.sources.select(F.col("source").alias("s"), "source_size", "target"))
        none = self.sized.where("size = 0").join(sources, F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "source", "size", "text_hash", F.lit(0).cast("long").alias("start"), "source_size", "target", F.lit(0).cast("long").alias("taken"))
        return found.unionByName(none)


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, repeats: int = 3, block_words: int = 256, least_blocks: int = 256, range_docs: int = 1024) -> Mix:
    return Mix(docs, id_col, text_col, source_col, weights, share, repeats, block_words, least_blocks, range_docs)


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words that the mix takes of it)."""
    return plan_mix(docs, **options).taken().select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents with the columns of the input: a row for each whole round, and one cut after the last word taken.

    Only the document at the end of a source's last round is cut. Rows are matched by identifier and
    text; exact repeats of these share evenly what they take together.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    own = "mix_"
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    taken = plan_mix(docs, **options).taken().where("size > 0").groupBy(F.col("doc_id").alias(f"{own}id"), F.col("text_hash").alias(f"{own}text")).agg(F.sum("taken").alias(f"{own}all"), F.count(F.lit(1)).alias(f"{own}n"), F.max("size").alias(f"{own}size")).where(F.col(f"{own}all") > 0)
    # Keys without nulls on both sides, so that numbering repeats after the join shuffles nothing more.
    keys = [f"{own}{k}" for k in ("given", "none", "hash")]
    keyed = lambda frame, doc_id, text_hash: frame.withColumns(dict(zip(keys, (F.coalesce(doc_id, F.lit(0)), doc_id.isNull(), text_hash), strict=True)))
    ids = docs[id_col].cast("long")
    matched = keyed(docs, ids, F.xxhash64(docs[text_col].cast("string"))).join(keyed(taken, F.col(f"{own}id"), F.col(f"{own}text")).drop(f"{own}id", f"{own}text"), keys)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]))) - 1
    part = F.expr(f"{own}all div {own}n") + (F.col(f"{own}nth") < F.expr(f"{own}all % {own}n")).cast("long")
    shared = matched.withColumn(f"{own}nth", F.when(F.col(f"{own}n") > 1, nth).otherwise(0)).withColumn(f"{own}taken", part)
    rest = F.col(f"{own}taken") % F.col(f"{own}size")
    words = F.concat(F.array_repeat(F.lit(None).cast("long"), F.floor(F.col(f"{own}taken") / F.col(f"{own}size")).cast("int")), F.filter(F.array(rest), lambda x: x > 0))
    copies = shared.withColumn(f"{own}words", F.explode(words))
    # Between a word and the white space after it: each chunk has one word.
    first = F.array_join(F.slice(F.split(F.col(text_col), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), 1, F.col(f"{own}words").cast("int")), "")
    return copies.withColumn(text_col, F.when(F.col(f"{own}words").isNull(), F.col(text_col)).otherwise(first)).select(*docs.columns)
