"""Multi-party perspective rotation: every participant's view of a dialogue, with Spark's own functions only.

Each speaker of a conversation who is no system role gets the dialogue rendered with their turns as assistant, others' turns as named
users and system turns as system. Turns are written as ``<|im_start|>role\\n text <|im_end|>\\n``; ``<|`` inside names and texts becomes
``< |``, so no text can close or open a turn. The mask covers each own turn's text and end mark: (start, end) in code points.

A dialogue of up to ``PART`` turns is one row. A longer one comes in parts of that many turns, whatever their turn numbers; a part says
where it starts in the whole rendering. So a conversation of any length is never gathered in one row or task: turns are numbered by range
partitions and their counts, offsets are sums over a part. ``part_turns`` sets another size.

Order: turn number (null first), speaker, text. Null speaker: ``unknown``; null text: empty. Repeated rows are repeated turns.
Conversations in which only system roles speak have no participant, and no row. Null conversation ids form one conversation. An empty
table gives an empty one, very long texts stay whole, and other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

PART = 1024
SYSTEM = ("system",)


def numbered(turns: DataFrame) -> DataFrame:
    """turns with ``at``: the turn's place in its conversation, from 0. One row a range partition is added up, never a conversation."""
    order = ["conv_id", "turn", "speaker", "text"]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
    rows = common.written(ranged).withColumns({"block": F.expr("shiftright(id, 33)"), "row": F.expr("id & 8589934591")})
    blocks = rows.groupBy("block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.join(F.broadcast(blocks.select("block", before.alias("before"))), "block").withColumn("place", F.col("before") + F.col("row"))
    first = rows.groupBy("conv_id").agg(F.min("place").alias("first")).withColumnRenamed("conv_id", "of")
    return rows.join(first, F.col("conv_id").eqNullSafe(F.col("of"))).select(*order, (F.col("place") - F.col("first")).alias("at"))


def rotate(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", system: tuple[str, ...] = SYSTEM, part_turns: int = PART) -> DataFrame:
    """conv_id, perspective, part, part_start, n_turns, n_own, text, mask_spans (start:end, comma-joined, in the part), mask_chars."""
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    start = lambda name: F.concat(F.lit("<|im_start|>"), name, F.lit("\n"))
    turns = df.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.coalesce(F.col(f"`{turn_col}`").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    own_head = start(F.lit("assistant"))
    named = F.when(F.col("speaker").isin(*system), F.lit("system")).otherwise(F.concat(F.lit("user name="), safe(F.col("speaker"))))
    said = numbered(turns).select("conv_id", "speaker", "at", F.expr(f"at div {part_turns}").alias("part"), start(named).alias("head"), F.concat(safe(F.col("text")), F.lit("<|im_end|>\n")).alias("body"))
    # an own turn stands behind all others' renderings and its speaker's own ones: two sums over the part, whatever the perspective
    part, own = Window.partitionBy("conv_id", "part").orderBy("at"), Window.partitionBy("conv_id", "part", "speaker").orderBy("at")
    saved = F.length("head") - F.length(own_head)
    said = said.withColumn("end", F.sum(F.length("head") + F.length("body")).over(part) - F.sum(saved).over(own) - 1)
    spans = F.array_sort(F.collect_list(F.struct(F.col("end"), (F.length("body") - 1).alias("n"))))
    masks = said.groupBy("conv_id", "part", "speaker").agg(spans.alias("masked")).select(F.col("conv_id").alias("m_conv"), F.col("part").alias("m_part"), F.col("speaker").alias("m_speaker"), "masked")
    speakers = said.filter(~F.col("speaker").isin(*system)).groupBy("conv_id", F.col("speaker").alias("perspective")).agg(F.lit(1).alias("one"))
    # parts are gathered once, whatever the number of perspectives
    parts = said.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("at", "speaker", "head", "body"))).alias("said"))
    views = parts.join(speakers.select(F.col("conv_id").alias("of"), "perspective"), F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    views = views.join(masks, F.col("conv_id").eqNullSafe(F.col("m_conv")) & (F.col("part") == F.col("m_part")) & (F.col("perspective") == F.col("m_speaker")), "left")
    rendered = F.transform("said", lambda x: F.concat(F.when(x["speaker"] == F.col("perspective"), own_head).otherwise(x["head"]), x["body"]))
    views = views.select("conv_id", "perspective", "part", F.coalesce("masked", F.expr("array()")).alias("masked"), F.size("said").alias("n_turns"), F.array_join(rendered, "").alias("text"))
    # where parts start: sums of lengths over narrow rows of the conversations that have several, a row a part
    size = said.groupBy("conv_id", "part").agg(F.sum(F.length("head") + F.length("body")).alias("size"))
    less = said.groupBy("conv_id", "part", "speaker").agg(F.sum(saved).alias("less"))
    long_ = size.filter("part > 0").select(F.col("conv_id").alias("of")).distinct()
    each = size.join(long_, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of").join(speakers.select(F.col("conv_id").alias("of"), "perspective"), F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    own_less = less.select(F.col("conv_id").alias("l_conv"), F.col("part").alias("l_part"), F.col("speaker").alias("l_speaker"), "less")
    each = each.join(own_less, F.col("conv_id").eqNullSafe(F.col("l_conv")) & (F.col("part") == F.col("l_part")) & (F.col("perspective") == F.col("l_speaker")), "left")
    dialogue = Window.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = each.select(F.col("conv_id").alias("s_conv"), F.col("perspective").alias("s_perspective"), F.col("part").alias("s_part"), F.sum(F.col("size") - F.coalesce("less", F.lit(0))).over(dialogue).alias("start"))
    views = views.join(starts.filter("s_part > 0"), F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("perspective") == F.col("s_perspective")) & (F.col("part") == F.col("s_part")), "left")
    return views.select(
        "conv_id", "perspective", "part", F.coalesce("start", F.lit(0)).cast("long").alias("part_start"), "n_turns", F.size("masked").alias("n_own"), "text",
        F.array_join(F.transform("masked", lambda s: F.concat((s["end"] - s["n"]).cast("string"), F.lit(":"), s["end"].cast("string"))), ",").alias("mask_spans"),
        F.aggregate("masked", F.lit(0), lambda a, s: a + s["n"]).cast("long").alias("mask_chars"),
    )


ORACLE = f"""
WITH t AS (
    SELECT conv_id, coalesce(CAST(turn AS BIGINT), -1) AS turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text,
           (row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(CAST(turn AS BIGINT), -1), coalesce(role, 'unknown'), coalesce(text, '')) - 1) // {PART} AS part
    FROM conversations
), p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'
), s AS (
    SELECT t.conv_id, perspective, part, turn, speaker, t.text, speaker = perspective AS own,
           '<|im_start|>' || CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system'
                                  ELSE 'user name=' || replace(speaker, '<|', '< |') END || chr(10) AS head,
           replace(t.text, '<|', '< |') || '<|im_end|>' || chr(10) AS body
    FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), o AS (
    SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, part ORDER BY turn, speaker, text
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS own_from FROM s
), v AS (
    SELECT conv_id, perspective, part, CAST(count(*) AS INTEGER) AS n_turns, CAST(count(*) FILTER (own) AS INTEGER) AS n_own,
           string_agg(head || body, '' ORDER BY turn, speaker, text) AS text,
           coalesce(string_agg(CAST(CAST(own_from AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(own_from + length(body) - 1 AS BIGINT) AS VARCHAR), ',' ORDER BY turn, speaker, text) FILTER (own), '') AS mask_spans,
           CAST(coalesce(sum(length(body) - 1) FILTER (own), 0) AS BIGINT) AS mask_chars
    FROM o GROUP BY conv_id, perspective, part
)
SELECT conv_id, perspective, part, CAST(coalesce(sum(length(text)) OVER (PARTITION BY conv_id, perspective ORDER BY part
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS part_start, n_turns, n_own, text, mask_spans, mask_chars FROM v
"""
