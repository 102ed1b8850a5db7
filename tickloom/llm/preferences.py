"""Preference formatting: two conversations that begin alike as one prompt and two masked completions.

Both conversations' turns are compared from the first on; the longest common prefix is rendered once as the prompt, what
follows in each is its completion. A completion's mask is a list of runs: `m` and a number of characters that are not
trained on (role headers, and turns of others), `t` and a number that are (an assistant's text and its end mark).

Everything is DataFrame operations. A conversation is one record, like a document; conversations meet by their id only,
so a first turn or a whole conversation that many share puts nothing together.

Defined results: null texts are empty and null roles are `unknown`; a turn's place is its number (nulls last), then its
role and text, and repeated rows are repeated turns; rows without a conversation id belong to none and give nothing; a
pair of equal conversations has two empty completions and status `same`; one that is the beginning of the other has one
empty completion and status `prefix`; others have status `pair`; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, END = "<|{}|>\n", "<|end|>\n"
TRAINED = "assistant"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order."""
    turn = F.struct(
        F.col("turn").isNull().alias("late"),
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = turns.where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return rows.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(HEAD.split("{}")[0]), turn["role"], F.lit(HEAD.split("{}")[1]))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(END))), "")


def mask(turns: Column) -> Column:
    runs = lambda t: F.concat(F.lit("m"), F.length(_head(t)), F.when(t["role"] == TRAINED, F.lit(",t")).otherwise(F.lit(",m")), F.length(t["text"]) + len(END))
    return F.array_join(F.transform(turns, runs), ",")


def common_turns(a: Column, b: Column) -> Column:
    """The number of turns that two conversations begin with alike."""
    least = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, 1, least), F.slice(b, 1, least), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    at = F.array_position(same, False)
    return F.when(at == 0, least).otherwise(at - 1).cast("long")


def format_pairs(pairs: DataFrame, pair_id: str = "pair_id") -> DataFrame:
    """(pair_id, chosen, rejected), the latter arrays of turns, as prompt and masked completions."""
    cut = pairs.withColumn("n_common", common_turns(F.col("chosen"), F.col("rejected")))
    rest = lambda c: F.slice(c, F.col("n_common").cast("int") + 1, F.size(c))
    cut = cut.select(pair_id, "n_common", F.slice("chosen", 1, F.col("n_common").cast("int")).alias("p"), rest("chosen").alias("c"), rest("rejected").alias("r"))
    status = F.when((F.size("c") > 0) & (F.size("r") > 0), "pair").when((F.size("c") > 0) | (F.size("r") > 0), "prefix").otherwise("same")
    return cut.select(
        pair_id, "n_common", status.alias("status"), rendered(F.col("p")).alias("prompt"),
        rendered(F.col("c")).alias("chosen"), mask(F.col("c")).alias("chosen_mask"), rendered(F.col("r")).alias("rejected"), mask(F.col("r")).alias("rejected_mask"),
    )


def swapped_replies(turns: DataFrame) -> DataFrame:
    """Preference pairs of a table that has none: each conversation is chosen over itself with its last reply swapped.

    The reply comes from the conversation whose id differs in the last bit, if it has one; else it is left out. What
    follows the reply is left out of the rejected one. Conversations without a reply are rejected as a whole.
    """
    all_ = conversations(turns)
    said = F.filter("turns", lambda t: t["role"] == TRAINED)
    reply = all_.select(F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("conv_id"), F.element_at(said, -1).alias("reply")).where(F.size(said) > 0)
    at = F.array_position(F.reverse(F.transform("turns", lambda t: t["role"])), TRAINED)
    before = F.slice("turns", 1, F.greatest(F.size("turns") - at, F.lit(0)).cast("int"))
    rejected = F.when(at == 0, F.slice("turns", 1, 0)).when(F.col("reply").isNull(), before).otherwise(F.concat(before, F.array("reply")))
    return all_.join(reply, "conv_id", "left").select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), rejected.alias("rejected"))


def report(turns: DataFrame) -> DataFrame:
    """The registered query's rows."""
    return format_pairs(swapped_replies(turns.select("conv_id", "turn", "role", "text")))


def oracle() -> str:
    """The same rows in DuckDB's SQL."""
    head = "'<|' || x.role || '|>' || chr(10)"
    end = "'<|end|>' || chr(10)"
    text = lambda of: f"coalesce(array_to_string(list_transform({of}, lambda x: {head} || x.text || {end}), ''), '')"
    runs = lambda of: f"coalesce(array_to_string(list_transform({of}, lambda x: 'm' || length({head}) || CASE WHEN x.role = '{TRAINED}' THEN ',t' ELSE ',m' END || (length(x.text) + {len(END)})), ','), '')"
    return f"""
    WITH v AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    a AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS LAST, role, text) AS turns FROM v GROUP BY conv_id),
    k AS (SELECT conv_id, turns, list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = '{TRAINED}') AS said FROM a),
    y AS (SELECT xor(conv_id, 1) AS conv_id, turns[said[-1]] AS reply FROM k WHERE len(said) > 0),
    j AS (SELECT k.conv_id, turns AS c, CASE WHEN len(said) = 0 THEN turns[1:0] WHEN reply IS NULL THEN turns[1:said[-1] - 1]
        ELSE list_append(turns[1:said[-1] - 1], reply) END AS r FROM k LEFT JOIN y USING (conv_id)),
    n AS (SELECT *, coalesce(list_min(list_filter(range(1, least(len(c), len(r)) + 1), lambda i: c[i] <> r[i])) - 1, least(len(c), len(r))) AS n FROM j),
    o AS (SELECT conv_id, n, c[1:n] AS p, c[n + 1:] AS c, r[n + 1:] AS r FROM n)
    SELECT conv_id AS pair_id, CAST(n AS BIGINT) AS n_common,
        CASE WHEN len(c) > 0 AND len(r) > 0 THEN 'pair' WHEN len(c) > 0 OR len(r) > 0 THEN 'prefix' ELSE 'same' END AS status,
        {text("p")} AS prompt, {text("c")} AS chosen, {runs("c")} AS chosen_mask, {text("r")} AS rejected, {runs("r")} AS rejected_mask FROM o"""
