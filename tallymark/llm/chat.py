"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and only its text
under the loss mask. What follows a conversation's last assistant turn is in no example, so such a
conversation gets one more record, with everything and no loss; the record that holds all turns is
marked ``final``. A turn is ``<turn role="...">text</turn>`` and a line feed. In texts and roles ``&``
becomes ``&amp;``, ``<`` becomes ``&lt;`` and ``"`` becomes ``&quot;``, so ``<`` and ``"`` stand only in
the template and reading back is exact.

Conversations are dealt out by identifier and sorted by turn; a task holds one conversation's text at a
time, and the examples leave in batches of bounded size. By definition, examples repeat earlier turns. A
conversation whose examples may have more than ``unit_chars`` characters is written by several tasks: its
turns are put in order by ranges, their numbers come from running sums over ranges, and each task gets a
run of examples and the turns that these hold. One example, which is one value, is the least unit; reading
back puts a conversation's text into one value, as its digest asks.

Null text and role count as empty. Rows with a null turn come first; equal turns are ordered by role
and text. Repeated rows are turns of their own. Rows with a null identifier are one conversation. An
empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.arrow import Rows
from tallymark.llm.mixing import earlier
from tallymark.session import ship_package, staged

SCHEMA = pa.schema([("conv_id", pa.int64()), ("example", pa.int64()), ("formatted", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("final", pa.bool_())])
#: Long conversations whose identifiers are broadcast at most, by a count.
SMALL = 100_000
#: What is escaped, in the order of escaping.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;"))
TURN = '<turn role="([^"]*)">([^<]*)</turn>\n'


def escape(text: str) -> str:
    for plain, safe in ESCAPES:
        text = text.replace(plain, safe)
    return text


def unescaped(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def _expanded(target: str):
    """Over rows (conv_id, chunk, per, last, role, text) by conversation and chunk, in order: a chunk's examples.

    A chunk holds ``per`` examples, or all if it is null; the last one also the record of all turns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(SCHEMA)
        current, is_last = None, False
        parts, length, example, waiting = [], 0, 0, None

        def put(row: tuple | None) -> None:
            if row is not None:
                out.add(row, len(row[2]))

        def ended() -> None:
            if is_last and waiting is not None and len(waiting[2]) == length:
                put((*waiting[:5], True))
            else:
                put(waiting)
                if is_last and current:
                    put((current[0], example, "".join(parts), 0, 0, True))

        for batch in batches:
            for conv_id, chunk, per, last, role, text in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if (conv_id, chunk) != current:
                    ended()
                    current, is_last = (conv_id, chunk), last
                    parts, length, example, waiting = [], 0, 0, None
                head, body = f'<turn role="{escape(role or "")}">', escape(text or "")
                start = length + len(head)
                parts.append(f"{head}{body}</turn>\n")
                length += len(parts[-1])
                if role == target:
                    put(waiting)
                    waiting = None
                    if per is None or chunk * per <= example < (chunk + 1) * per:
                        parts = ["".join(parts)]
                        waiting = (conv_id, example, parts[0], start, start + len(body), False)
                    example += 1
                while out.full:
                    yield out.take()
        ended()
        yield from out.rest()

    return run


def _chunked(turns: DataFrame, long: DataFrame, target: str, unit_chars: int) -> DataFrame:
    """(conv_id, chunk, per, last, role, text, at) of the long conversations: each turn for every chunk that holds it."""
    order = [F.col(c) for c in ("conv_id", "turn", "role", "text")]
    dealt = staged(turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "long-conversations")
    slim = dealt.select("conv_id", "at", F.shiftright("at", 33).alias("part"), F.coalesce(F.col("role") == target, F.lit(False)).cast("long").alias("hit"))
    before = earlier(slim.groupBy("conv_id", "part").agg(F.sum("hit").alias("hits")), "conv_id", "hits").withColumnsRenamed({"conv_id": "_conv", "part": "_part"})
    within = Window.partitionBy("conv_id", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    numbered = slim.withColumn("nth", F.coalesce(F.sum("hit").over(within), F.lit(0))).join(before, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))).select("at", (F.col("nth") + F.col("before")).alias("earlier"))
    sizes = long.select(F.col("conv_id").alias("_conv"), F.greatest(F.floor(F.lit(unit_chars) / F.col("chars")), F.lit(1)).cast("long").alias("per"), "targets")
    whole = dealt.join(sizes, F.col("conv_id").eqNullSafe(F.col("_conv"))).join(numbered, "at")
    most = F.greatest(F.ceil(F.col("targets") / F.col("per")) - 1, F.lit(0)).cast("long")
    each = whole.withColumn("_most", most).withColumn("chunk", F.explode(F.sequence(F.least(F.floor(F.col("earlier") / F.col("per")), F.col("_most")), F.col("_most"))))
    return each.select("conv_id", "chunk", "per", (F.col("chunk") == F.col("_most")).alias("last"), "role", "text", "at")


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", target: str = "assistant", unit_chars: int = 256 << 20) -> DataFrame:
    """Examples: conv_id, example, formatted, loss_start, loss_end (in code points), final."""
    ship_package(turns.sparkSession)
    slim = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    columns, schema = ["conv_id", "chunk", "per", "last", "role", "text"], "conv_id long, example long, formatted string, loss_start long, loss_end long, final boolean"
    chars = F.coalesce(F.length("text"), F.lit(0)) + F.coalesce(F.length("role"), F.lit(0)) + 21
    sizes = slim.groupBy("conv_id").agg(F.sum(chars).alias("chars"), F.sum(F.when(F.col("role") == target, 1).otherwise(0)).alias("targets"))
    long = staged(sizes.where(F.col("chars").cast("double") * (F.col("targets") + 1) > unit_chars), "long-sizes")
    n_long = long.count()
    few = F.broadcast(long) if n_long <= SMALL else long
    is_long = slim["conv_id"].eqNullSafe(few["conv_id"])
    short = slim.join(few, is_long, "left_anti") if n_long else slim
    ordered = short.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", F.lit(0).cast("long").alias("chunk"), F.lit(None).cast("long").alias("per"), F.lit(True).alias("last"), "role", "text")
    out = ordered.mapInArrow(_expanded(target), schema)
    if not n_long:
        return out
    chunks = _chunked(slim.join(few, is_long, "left_semi"), few, target, unit_chars)
    return out.unionByName(chunks.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "at").select(*columns).mapInArrow(_expanded(target), schema))


def write_chats(turns: DataFrame, **options) -> DataFrame:
    """The examples, written to the shared folder as Parquet and read again."""
    return staged(format_chats(turns, **options), "chats", "zstd")


def read_chats(examples: DataFrame) -> DataFrame:
    """One row per conversation, from its formatted examples: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    roles, texts = (F.regexp_extract_all("formatted", F.lit(TURN), F.lit(k)) for k in (1, 2))
    turns = F.transform(F.arrays_zip(roles.alias("r"), texts.alias("t")), lambda x: F.concat(unescaped(x["r"]), F.lit("\n"), unescaped(x["t"]), F.lit("\n")))
    loss = unescaped(F.col("formatted").substr(F.col("loss_start").cast("int") + 1, (F.col("loss_end") - F.col("loss_start")).cast("int")))
    parts = examples.select(
        "conv_id",
        F.when(F.col("final"), F.struct(F.size(roles).cast("long").alias("n"), F.sha2(F.array_join(turns, ""), 256).alias("sha"))).alias("whole"),
        F.when(F.col("loss_end") > 0, F.struct("example", loss.alias("text"))).alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
    )
    each = parts.groupBy("conv_id").agg(F.max("whole").alias("whole"), F.sort_array(F.collect_list("loss")).alias("losses"), F.sum("chars").alias("formatted_chars"))
    masked = each.withColumn("masked", F.array_join(F.transform("losses", lambda x: x["text"]), ""))
    return masked.select("conv_id", F.col("whole.n").alias("n_turns"), F.col("whole.sha").alias("turns_sha256"), F.length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"), "formatted_chars")
