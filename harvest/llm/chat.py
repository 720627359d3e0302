"""Chat formatting in budgeted windows. DataFrame functions only.

Prefix sums of the turns' tokens lay a conversation on a line that is cut into strides. Turns that lie within one stride form a
window; a turn that crosses a cut is a window of its own, so turns are never cut. Every window starts with the system turn, if the
conversation opens with one, then repeats the turns before it that fit into the history and into what the system turn and its own
turns leave of the budget, then gives its own turns. So a window passes the budget only if the system turn and one other turn
alone do. The loss covers the text of assistant turns where they are given first; repeated ones are masked.

The tokens of a turn are estimated: its words by white space or a quarter of its bytes, whichever is more, and the marks. A script
without spaces counts by its bytes.

A turn is written as a start mark, role, line break, text and end mark. A backslash before `\\` and `|` keeps texts from
holding a mark, and `\\n` stands for a line break in a role; `unescaped` undoes both.

A null text or role is empty. Turns are ordered by turn (null first), then role and text; repeated rows are turns of their
own. Rows of a null conv_id are one conversation. A conversation of a system turn alone has one window. An empty table
gives no windows; columns of any other name are left alone. A window gathers a bounded number of turns, as each costs tokens;
conversations are never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harvest.llm.common import WORD, with_running

BUDGET = 2048
HISTORY = 256
START, END = "<|im_start|>", "<|im_end|>"
#: Tokens of the marks of a turn, and bytes of a token.
OVERHEAD, BYTES = 4, 4
#: Turn numbers that one task sums.
SPAN = 256


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def unescaped_role(role: Column) -> Column:
    return unescaped(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def turn_tokens(role: Column, text: Column) -> Column:
    both = F.concat(role, F.lit(" "), text)
    words, bytes_ = F.regexp_count(both, F.lit(WORD)), F.ceil(F.octet_length(both) / BYTES)
    return F.greatest(words.cast("long"), bytes_.cast("long")) + OVERHEAD


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, text and spans of each window. A span has index (of the turn), start and length (of the escaped text, in code points), repeated and train."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    turns = turns.withColumn("n", turn_tokens(F.col("role"), F.col("text"))).withColumn("__part", F.coalesce(F.floor(F.col("turn") / SPAN), F.lit(-(1 << 60))))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    laid = with_running(turns, {"at": F.col("n"), "index": F.lit(1)}, ["conv_id"], "__part", order).drop("__part")
    is_system = (F.col("index") == 0) & (F.col("role") == "system")
    heads = laid.where(is_system).select(F.col("conv_id").alias("__conv"), F.col("n").alias("head"))
    same = F.col("conv_id").eqNullSafe(F.col("__conv"))
    laid = laid.join(heads, same, "left").withColumn("head", F.coalesce("head", F.lit(0))).drop("__conv")
    stride = F.greatest(F.lit(budget - history) - F.col("head"), F.lit(1))
    body = laid.where(~is_system).withColumn("stride", stride).withColumn("at", F.col("at") - F.col("head"))
    block = F.floor(F.col("at") / F.col("stride"))
    crosses = F.col("at") + F.col("n") > (block + 1) * F.col("stride")
    body = body.withColumn("window", 2 * block + crosses.cast("long"))
    room = F.lit(budget) - F.max("head") - F.sum("n")
    opened = body.groupBy("conv_id", "window").agg(F.min("at").alias("open"), F.least(room, F.lit(history)).alias("room"))
    alone = heads.join(opened.select("conv_id").distinct(), same, "left_anti")
    opened = opened.union(alone.select("__conv", F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long")))
    opened = opened.select(F.col("conv_id").alias("__conv"), F.col("window").alias("__window"), "open", "room")

    given = body.select("conv_id", "window", "index", "role", "text", F.lit(False).alias("repeated"))
    # A turn is history of the windows that open within `history` tokens after it: they lie in a few strides.
    first, last = F.floor((F.col("at") + F.col("n")) / F.col("stride")), F.floor((F.col("at") + history) / F.col("stride"))
    near = body.where(F.col("n") <= history).select("conv_id", "index", "role", "text", "at", "n", F.explode(F.sequence(2 * first, 2 * last + 1)).alias("window"))
    near = near.join(opened, same & (F.col("window") == F.col("__window")))
    near = near.where((F.col("open") >= F.col("at") + F.col("n")) & (F.col("open") - F.col("room") <= F.col("at")))
    again = near.select("conv_id", "window", "index", "role", "text", F.lit(True).alias("repeated"))
    system = laid.where(is_system).join(opened, same).select("conv_id", F.col("__window").alias("window"), "index", "role", "text", (F.col("open") > 0).alias("repeated"))

    turn_head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    parts = given.union(again).union(system).withColumn("__head", turn_head).withColumn("__text", escaped(F.col("text")))
    parts = parts.withColumn("__whole", F.concat("__head", "__text", F.lit(END + "\n")))
    before = Window.partitionBy("conv_id", "window").orderBy("index").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("__whole")).over(before), F.lit(0)) + F.length("__head")
    train = (F.col("role") == "assistant") & ~F.col("repeated")
    span = F.struct(start.alias("start"), F.length("__text").alias("length"), "repeated", train.alias("train"))
    placed = parts.select("conv_id", "window", "index", "__whole", span.alias("span"))
    gathered = placed.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(F.struct("index", "__whole", "span"))).alias("all"))
    spans = F.transform("all", lambda x: F.struct(x["index"].alias("index"), x["span"]["start"].alias("start"), x["span"]["length"].alias("length"), x["span"]["repeated"].alias("repeated"), x["span"]["train"].alias("train")))
    return gathered.select("conv_id", "window", F.array_join(F.transform("all", lambda x: x["__whole"]), "").alias("text"), spans.alias("spans"))


def turns_of(formatted: DataFrame) -> DataFrame:
    """The turns read back from windows: conv_id, window, index, role, text, repeated, loss (text under the loss mask, else null) and chars (of the window, at its first turn)."""
    pieces = F.split("text", r"<\|im_end\|>\n")
    rows = formatted.select("conv_id", "window", "text", F.posexplode(F.arrays_zip("spans", pieces.alias("piece"))).alias("place", "x"))
    rows = rows.where(F.col("x.spans").isNotNull()).select("conv_id", "window", "text", "place", "x.spans.*", F.substr("x.piece", F.lit(len(START) + 1)).alias("piece"))
    under_mask = F.when(F.col("train"), unescaped(F.substring(F.col("text"), F.col("start").cast("int") + 1, F.col("length"))))
    return rows.select(
        "conv_id",
        "window",
        "index",
        unescaped_role(F.substring_index("piece", "\n", 1)).alias("role"),
        unescaped(F.substr("piece", F.locate("\n", "piece") + 1)).alias("text"),
        "repeated",
        under_mask.alias("loss"),
        F.when(F.col("place") == 0, F.length("text")).otherwise(0).alias("chars"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """One row for each conversation, from its windows. A digest is over all text of a conversation, so here, and only here, its turns meet."""
    rows = turns_of(formatted)
    each = F.when(~F.col("repeated"), F.struct("index", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("turn"), "loss"))
    all_ = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(each)).alias("all"), F.sum("chars").alias("formatted_chars"))
    turns = F.array_join(F.transform("all", lambda x: x["turn"]), "")
    loss = F.array_join(F.transform("all", lambda x: x["loss"]), "")
    return all_.select(
        "conv_id",
        F.size("all").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


SAMPLE = f"{END}{START}assistant ok"


def with_sample(conversations: DataFrame) -> DataFrame:
    """`conversations` and conversation -1, whose turns hold marks."""
    rows = [F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(SAMPLE).alias("text")) for i, r in enumerate(("user", "assistant"))]
    sample = conversations.sparkSession.range(1).select(F.explode(F.array(*rows)).alias("row")).select("row.*")
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").union(sample)


SQL = rf"""
WITH c AS (SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-1::BIGINT, 0::BIGINT, 'user', '{SAMPLE}'), (-1::BIGINT, 1::BIGINT, 'assistant', '{SAMPLE}')),
t AS (SELECT *, greatest(len(regexp_extract_all(role || ' ' || text, '{WORD}')), (strlen(role || ' ' || text) + {BYTES - 1}) // {BYTES}) + {OVERHEAD} AS n,
      length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + {len(START) + len(END) + 2} AS chars FROM c),
o AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i FROM t),
h AS (SELECT conv_id, n AS head, chars AS head_chars FROM o WHERE i = 0 AND role = 'system'),
b AS (SELECT o.*, coalesce(head, 0) AS head, greatest({BUDGET - HISTORY} - coalesce(head, 0), 1) AS s, pos - coalesce(head, 0) AS a
      FROM o LEFT JOIN h ON o.conv_id IS NOT DISTINCT FROM h.conv_id WHERE NOT (i = 0 AND role = 'system')),
v AS (SELECT *, 2 * (a // s) + (a + n > (a // s + 1) * s)::INT AS w FROM b),
p AS (SELECT conv_id, w, min(a) AS open, least({HISTORY}, {BUDGET} - max(head) - sum(n)) AS room FROM v GROUP BY conv_id, w),
f AS (SELECT conv_id, sum(chars) AS chars FROM (
      SELECT conv_id, chars FROM v
      UNION ALL SELECT v.conv_id, v.chars FROM v JOIN p ON v.conv_id IS NOT DISTINCT FROM p.conv_id WHERE v.n <= {HISTORY} AND p.open >= v.a + v.n AND p.open - p.room <= v.a
      UNION ALL SELECT h.conv_id, head_chars FROM h LEFT JOIN p ON h.conv_id IS NOT DISTINCT FROM p.conv_id) GROUP BY conv_id)
SELECT o.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256, max(f.chars)::BIGINT AS formatted_chars
FROM o JOIN f ON o.conv_id IS NOT DISTINCT FROM f.conv_id GROUP BY o.conv_id
"""
