"""Chat formatting: every participant's view of a conversation, as segments with places and masks.

For each participant the dialogue is rendered with that speaker as ``assistant`` and every other
speaker as a named user. One output row is one turn in one view: its text, the place of the turn and
of the spoken part in the whole rendering, and whether the spoken part counts for the loss. System
turns are rendered as such in every view, take no perspective and are never trained on.

A view is never put together in one row, so a long conversation is never one value. Places are running
sums taken in two steps: inside blocks of ``BLOCK`` turn numbers, then over block totals.

Cases: null role reads ``unknown``, null text reads empty, null turn sorts first (as -1); equal turn
numbers are ordered by role and text, rows equal in all of them by nothing that shows; a conversation
with system turns only has no view; null conv_id is a conversation of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024
START, END = "<|im_start|>", "<|im_end|>\n"


def header(name: Column, viewer: Column) -> Column:
    spoken_by = (
        F.when(name == "system", F.lit("system"))
        .when(name == viewer, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), name))
    )
    return F.concat(F.lit(START), spoken_by, F.lit("\n"))


def rotate(turns: DataFrame) -> DataFrame:
    """conv_id, viewer, turn, speaker, segment, seg_start, body_start, body_end, trained."""
    rows = turns.select(
        "conv_id",
        F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("body"),
    )
    speakers = rows.where(F.col("speaker") != "system").groupBy(F.col("conv_id").alias("of_conv"), F.col("speaker").alias("viewer")).agg(F.lit(1).alias("one"))
    views = rows.join(speakers.drop("one"), F.col("conv_id").eqNullSafe(F.col("of_conv"))).drop("of_conv")
    head = header(F.col("speaker"), F.col("viewer"))
    views = views.withColumns(
        {
            "segment": F.concat(head, F.col("body"), F.lit(END)),
            "head_chars": F.length(head),
            "block": F.floor(F.col("turn") / BLOCK),
        }
    ).withColumn("seg_chars", F.length("segment").cast("long"))
    inside = Window.partitionBy("conv_id", "viewer", "block").orderBy("turn", "speaker", "body").rowsBetween(Window.unboundedPreceding, -1)
    views = views.withColumn("in_block", F.coalesce(F.sum("seg_chars").over(inside), F.lit(0)))
    earlier = Window.partitionBy("conv_id", "viewer").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        views.groupBy("conv_id", "viewer", "block").agg(F.sum("seg_chars").alias("block_chars"))
        .withColumn("before", F.coalesce(F.sum("block_chars").over(earlier), F.lit(0)))
        .select(F.col("conv_id").alias("b_conv"), F.col("viewer").alias("b_viewer"), F.col("block").alias("b_block"), "before")
    )
    placed = views.join(
        totals,
        F.col("conv_id").eqNullSafe(F.col("b_conv")) & (F.col("viewer") == F.col("b_viewer")) & (F.col("block") == F.col("b_block")),
    ).withColumn("seg_start", F.col("before") + F.col("in_block"))
    body_start = F.col("seg_start") + F.col("head_chars")
    return placed.select(
        "conv_id", "viewer", "turn", "speaker", "segment", "seg_start",
        body_start.alias("body_start"),
        (body_start + F.length("body")).alias("body_end"),
        (F.col("speaker") == F.col("viewer")).alias("trained"),
    )


#: The same rows on plain SQL.
SQL = f"""
with rows_ as (
  select conv_id, coalesce(turn, -1)::bigint as turn, coalesce(role, 'unknown') as speaker, coalesce(text, '') as body
  from conversations),
views as (
  select r.*, s.viewer,
    '{START}' || case when speaker = 'system' then 'system' when speaker = viewer then 'assistant'
      else 'user name=' || speaker end || chr(10) as head
  from rows_ r join (select distinct conv_id, speaker as viewer from rows_ where speaker <> 'system') s
    on r.conv_id is not distinct from s.conv_id),
cut as (select *, head || body || '{START.replace('start', 'end')}' || chr(10) as segment from views),
placed as (
  select *, coalesce(sum(length(segment)) over (partition by conv_id, viewer order by turn, speaker, body
    rows between unbounded preceding and 1 preceding), 0)::bigint as seg_start from cut)
select conv_id, viewer, turn, speaker, segment, seg_start, seg_start + length(head) as body_start,
  seg_start + length(head) + length(body) as body_end, speaker = viewer as trained
from placed
"""
