"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns (same role, same text) is rendered once, as the
prompt; what follows on each side is rendered as its completion, with a mask: the
character spans of the assistant's words, which alone count in the loss.
Built of DataFrame functions only.

A conversation is never compared as a whole: turns are numbered and measured by
running sums, the two sides meet turn by turn under (pair, number) with a digest of
role and text, and the least number at which they differ is a minimum.  Spans follow
from the running sums.  Only the rendered rows themselves are gathered, once, so a
conversation of very many turns takes time in proportion to them.

`pairs_from_conversations` makes the pairs of a table of conversations: chosen is
the conversation; rejected is the same with one assistant turn cut to the first half
of its words, an answer that breaks off.  Which one depends on the id, so the sides
part at different turns and completions hold the turns that follow, of both roles.

Defined results: a pair needs both sides; rows of neither side are left out; all rows
with a null pair id are one pair; turns are ordered by number (null first), then role
and text; null roles and texts are empty; repeated turns count once; a side that is a
prefix of the other has an empty completion; sides without an assistant turn after the
prompt have an empty mask; an empty table gives no rows; very long conversations and
texts are rendered whole; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelake.llm.base import materialize, table

# Fixed values of the rendered form.
TURN_BEGIN, ROLE_END, TURN_END = "<|turn|>", "\n", "<|end|>\n"


def format_pairs(turns: DataFrame, pair_col: str = "pair_id", role: str = "assistant") -> DataFrame:
    """`turns`: pair id, side (chosen or rejected), turn, role, text.  A row a pair: prompt, completions, masks, n_prompt_turns, n_chosen_turns, n_rejected_turns."""
    empty = F.lit("")
    clean = turns.where(F.col("side").isin("chosen", "rejected")).select(
        F.col(pair_col).alias("__pair"), "side", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    mine = Window.partitionBy("__pair", "side").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    told, length = F.struct("turn", "role", "text"), F.length("role") + F.length("text") + F.lit(len(TURN_BEGIN) + len(ROLE_END) + len(TURN_END))
    rows = clean.withColumn("again", told.eqNullSafe(F.lag(told).over(mine))).where("NOT again").drop("again")
    before = F.coalesce(F.sum(length).over(mine.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = materialize(rows.withColumns({"place": F.row_number().over(mine), "before": before}), "preference-turns")

    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    sides = rows.groupBy("__pair", "place").agg(F.count(F.lit(1)).alias("n"), F.min(said).alias("a"), F.max(said).alias("b"), F.min("before").alias("before"))
    differ = (F.col("n") < 2) | (F.col("a") != F.col("b"))
    firsts = sides.groupBy("__pair").agg(
        F.min(F.when(differ, F.struct("place", "before"))).alias("parts"), F.max("place").alias("last"), F.max(F.when(F.col("place") == 1, F.col("n"))).alias("sides")
    )
    firsts = firsts.where("sides = 2").select("__pair", F.coalesce("parts.place", F.col("last") + 1).alias("first"), F.coalesce("parts.before", F.lit(0)).alias("base"))

    both = rows.alias("r").join(firsts.alias("f"), F.expr("r.__pair <=> f.__pair")).select("r.*", "first", "base")
    prompt, completed = F.col("place") < F.col("first"), lambda side: (F.col("side") == side) & (F.col("place") >= F.col("first"))
    both = both.where((F.col("side") == "chosen") | ~prompt)
    rendered = F.concat(F.lit(TURN_BEGIN), "role", F.lit(ROLE_END), "text", F.lit(TURN_END))
    start = (F.col("before") - F.col("base") + F.length("role") + F.lit(len(TURN_BEGIN) + len(ROLE_END))).cast("int")
    span = F.struct("place", start.alias("start"), (F.length("text") + F.lit(len(TURN_END))).alias("length"))

    def gathered(when: Column, value: Column):
        return F.sort_array(F.collect_list(F.when(when, value)))

    def text(when: Column, name: str) -> Column:
        return F.array_join(F.transform(gathered(when, F.struct("place", rendered.alias("t"))), lambda t: t["t"]), "").alias(name)

    def mask(side: str) -> Column:
        spans = gathered(completed(side) & (F.col("role") == role), span)
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))).alias(f"{side}_mask")

    return both.groupBy("__pair").agg(
        text(prompt, "prompt"), text(completed("chosen"), "chosen"), text(completed("rejected"), "rejected"), mask("chosen"), mask("rejected"),
        F.count_if(prompt).alias("n_prompt_turns"), F.count_if(completed("chosen")).alias("n_chosen_turns"), F.count_if(completed("rejected")).alias("n_rejected_turns"),
    ).withColumnRenamed("__pair", pair_col)


def pairs_from_conversations(conversations: DataFrame) -> DataFrame:
    """Turns of the pairs: conv_id, side, turn, role, text; conversations without an assistant turn have no pair.

    Of n assistant turns the one of number conv_id mod n (from 0; a null id counts as 0) is cut."""
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    mine = Window.partitionBy("conv_id")
    answer = F.when(F.col("role") == "assistant", 1)
    ordered = mine.orderBy(F.col("turn").asc_nulls_first(), "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = turns.withColumns({"__k": F.sum(answer).over(ordered), "__n": F.sum(answer).over(mine)}).where("__n > 0")
    words = F.split("text", " ")
    half = F.array_join(F.slice(words, F.lit(1), F.floor((F.size(words) + 1) / 2).cast("int")), " ")
    cut = (F.col("role") == "assistant") & (F.col("__k") - 1 == F.pmod(F.coalesce("conv_id", F.lit(0)), "__n"))
    sides = F.explode(F.array(F.struct(F.lit("chosen").alias("side"), F.col("text")), F.struct(F.lit("rejected").alias("side"), F.when(cut, half).otherwise(F.col("text")).alias("text"))))
    return turns.select("conv_id", "turn", "role", sides.alias("__side")).select("conv_id", "__side.side", "turn", "role", "__side.text")


def op8_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, prompt, chosen, rejected, their masks (as text start+length) and turn counts of every conversation with an assistant turn."""
    turns = pairs_from_conversations(table(spark, sf_dir, "conversations"))
    out = format_pairs(turns, "conv_id")
    spans = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws("+", s["start"].cast("string"), s["length"].cast("string"))))
    return out.withColumns({"chosen_mask": spans("chosen_mask"), "rejected_mask": spans("rejected_mask")})


#: The SQL takes it that cutting a turn does not change its place among turns of one number.
ORACLE_SQL = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), counted AS (
  SELECT *, row_number() OVER w AS place, count(*) FILTER (role = 'assistant') OVER (w ROWS UNBOUNDED PRECEDING) AS k, count(*) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) AS n
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), cut AS (
  SELECT *, role = 'assistant' AND k - 1 = (coalesce(conv_id, 0) % n + n) % n AS broken, string_split(text, ' ') AS w FROM counted WHERE n > 0
), sides AS (
  SELECT *, CASE WHEN broken THEN array_to_string(w[1:(len(w) + 1) // 2], ' ') ELSE text END AS other FROM cut
), parted AS (
  SELECT *, min(CASE WHEN text <> other THEN place END) OVER (PARTITION BY conv_id) AS first,
    '<|turn|>' || role || chr(10) || text || '<|end|>' || chr(10) AS a, '<|turn|>' || role || chr(10) || other || '<|end|>' || chr(10) AS b FROM sides
), form AS (
  SELECT *, first IS NOT NULL AND place >= first AS differs FROM parted
), placed AS (
  SELECT *, coalesce(sum(length(a)) FILTER (differs) OVER v, 0) - length(a) + 9 + length(role) AS sa, coalesce(sum(length(b)) FILTER (differs) OVER v, 0) - length(b) + 9 + length(role) AS sb
  FROM form WINDOW v AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id,
  coalesce(string_agg(a, '' ORDER BY place) FILTER (NOT differs), '') AS prompt,
  coalesce(string_agg(a, '' ORDER BY place) FILTER (differs), '') AS chosen,
  coalesce(string_agg(b, '' ORDER BY place) FILTER (differs), '') AS rejected,
  coalesce(string_agg(sa || '+' || (length(text) + 8), ',' ORDER BY place) FILTER (differs AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(sb || '+' || (length(other) + 8), ',' ORDER BY place) FILTER (differs AND role = 'assistant'), '') AS rejected_mask,
  count(*) FILTER (NOT differs) AS n_prompt_turns,
  count(*) FILTER (differs) AS n_chosen_turns,
  count(*) FILTER (differs) AS n_rejected_turns
FROM placed GROUP BY conv_id
"""
