"""Multi-party perspective rotation of conversations.

For every participant of a conversation the dialogue is rendered once, with
that speaker as the assistant and all others as users with their names; the
mask marks the assistant's contents, the characters to learn from.

A conversation is rendered in segments of SEGMENT turn numbers, so that a long
one is never gathered in one place: turns meet in their segment, and segments
meet the conversation's few participants in a join that adaptive execution
splits where one conversation holds many segments. A segment of more than
PART rows (turn numbers that repeat, or none at all) is dealt to parts of PART
rows each, whose ranks come from a range sort and counts of its partitions, so
that no task meets all of its rows. Segments and their parts in order, one
after the other, are the whole dialogue.

Defined results: system turns are kept in every perspective, but the system is
no participant, so a conversation of system turns alone gives no row; a null
or empty role is the speaker ``unknown``; a null text is empty; turns sort by
number, then speaker, then text (from part to part: the digest of the text),
and repeated rows are rendered each; rows with a null turn form a segment of
their own with a null number; rows with a null conv_id are one conversation;
texts are rendered whole, however long; an empty table gives an empty result;
the template's markers inside a text are broken up by a space; only conv_id,
turn, role and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm import scratch

SEGMENT, PART = 64, 256
SYSTEM, UNKNOWN = "system", "unknown"
#: Fixed markers of the chat template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _rendered(turn: Column, perspective: Column) -> Column:
    """A turn as text, the place in it where learning starts, its length, and whether it is learned."""
    own = turn["speaker"] == perspective
    head = F.when(turn["speaker"] == SYSTEM, F.lit(f"{OPEN}system\n")).when(own, F.lit(f"{OPEN}assistant\n")).otherwise(F.concat(F.lit(f"{OPEN}user name="), turn["speaker"], F.lit("\n")))
    text = F.concat(head, turn["text"], F.lit(f"{CLOSE}\n"))
    return F.struct(text.alias("text"), F.length(head).alias("head"), F.length(text).alias("size"), own.alias("own"))


def _parts(rows: DataFrame, part: int) -> DataFrame:
    """rows with the part of their segment: 0 but in segments of more than part rows."""
    large = rows.groupBy("conv_id", "segment").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part).select(F.col("conv_id").alias("c"), F.col("segment").alias("s"))
    large = scratch.materialize(large, "large-segments")
    if not large.limit(1).count():
        return rows.withColumn("part", F.lit(0).cast("long"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("segment").eqNullSafe(F.col("s"))
    order = ["conv_id", "segment", "turn", "speaker", "digest", "at"]
    sort = rows.join(large, same, "left_semi").withColumn("digest", F.sha2("text", 256)).withColumn("at", F.monotonically_increasing_id())
    sort = sort.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()).withColumn("p", F.spark_partition_id())
    sort = scratch.materialize(sort.drop("digest", "at"), "large-segments")
    # One row for each partition of the sort that a segment reaches into.
    runs = sort.groupBy("conv_id", "segment", "p").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("low"))
    before = F.sum("n").over(Window.partitionBy("conv_id", "segment").orderBy("p")) - F.col("n")
    runs = runs.select(F.col("conv_id").alias("c"), F.col("segment").alias("s"), F.col("p").alias("q"), (before - F.col("low")).alias("shift"))
    ranked = sort.join(runs, same & (F.col("p") == F.col("q"))).withColumn("part", F.floor((F.col("place") + F.col("shift")) / part).cast("long"))
    few = rows.join(large, same, "left_anti").withColumn("part", F.lit(0).cast("long"))
    return few.unionByName(ranked.select(few.columns))


def rotate(conversations: DataFrame, segment: int = SEGMENT, part: int = PART) -> DataFrame:
    """conv_id, perspective, segment, part, n_turns, text, mask, n_learned.

    mask lists ``start-end`` code points of the text (end exclusive), comma-joined; n_learned is their number.
    """
    clean = lambda c: F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("<|im_"), F.lit("< |im_"))
    role = clean(F.col("role"))
    rows = conversations.select("conv_id", "turn", F.when(role == "", UNKNOWN).otherwise(role).alias("speaker"), clean(F.col("text")).alias("text"), F.floor(F.col("turn") / segment).cast("long").alias("segment"))
    segments = _parts(rows, part).groupBy("conv_id", "segment", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "speaker", "text"))).alias("turns"))
    speakers = rows.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct()
    pairs = segments.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    shown = pairs.select("conv_id", "perspective", "segment", "part", F.transform("turns", lambda t: _rendered(t, F.col("perspective"))).alias("parts"))

    def note(seen: Column, part: Column) -> Column:
        start, end = seen["at"] + part["head"], seen["at"] + part["size"] - 1
        span = F.concat(F.when(seen["mask"] == "", "").otherwise(","), start.cast("string"), F.lit("-"), end.cast("string"))
        return F.struct(
            (seen["at"] + part["size"]).alias("at"),
            F.when(part["own"], F.concat(seen["mask"], span)).otherwise(seen["mask"]).alias("mask"),
            F.when(part["own"], seen["learned"] + end - start).otherwise(seen["learned"]).alias("learned"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("mask"), F.lit(0).alias("learned"))
    noted = F.aggregate("parts", begin, note)
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    return shown.select("conv_id", "perspective", "segment", "part", F.size("parts").cast("long").alias("n_turns"), text.alias("text"), noted.alias("noted")).select("conv_id", "perspective", "segment", "part", "n_turns", "text", F.col("noted.mask").alias("mask"), F.col("noted.learned").cast("long").alias("n_learned"))


def oracle(table: str = "conversations", segment: int = SEGMENT, part: int = PART) -> str:
    """The same rows in SQL."""
    clean = lambda c: f"replace(coalesce({c}, ''), '<|im_', '< |im_')"
    return f"""
        with r as (select conv_id, turn, case when {clean("role")} = '' then '{UNKNOWN}' else {clean("role")} end as speaker, {clean("text")} as body,
                          cast(floor(turn / {segment}.0) as bigint) as segment from {table}),
        q as (select *, (row_number() over (partition by conv_id, segment order by turn, speaker, sha256(body)) - 1) // {part} as part from r),
        n as (select *, row_number() over (partition by conv_id, segment, part order by turn, speaker, body) as k from q),
        p as (select distinct conv_id, speaker as perspective from r where speaker <> '{SYSTEM}'),
        h as (select n.*, perspective, speaker = perspective as own,
                     case when speaker = '{SYSTEM}' then '{OPEN}system' || chr(10) when speaker = perspective then '{OPEN}assistant' || chr(10)
                          else '{OPEN}user name=' || speaker || chr(10) end as head
              from n join p on n.conv_id is not distinct from p.conv_id),
        t as (select *, head || body || '{CLOSE}' || chr(10) as shown from h),
        o as (select *, sum(length(shown)) over (partition by conv_id, perspective, segment, part order by k) - length(shown) as at0 from t)
        select conv_id, perspective, segment, part, count(*) as n_turns, string_agg(shown, '' order by k) as text,
               coalesce(string_agg(cast(at0 + length(head) as varchar) || '-' || cast(at0 + length(shown) - 1 as varchar), ',' order by k) filter (own), '') as mask,
               cast(coalesce(sum(length(shown) - 1 - length(head)) filter (own), 0) as bigint) as n_learned
        from o group by conv_id, perspective, segment, part"""
