"""Chat formatting in budgeted, turn-aligned windows. DataFrame functions only.

A turn is written ``<|role|>\\n text <|end|>\\n`` (no blanks around the text). In
roles and texts ``&`` and ``<`` are written ``&a;`` and ``&l;`` (in roles also
``|`` and line feeds, ``&p;`` and ``&n;``), so no text can hold a control
string, and reading back undoes it.

Turns go by turn number (then role, then text). Prefix sums of their tokens
(words, and one for the marks) choose the windows: a window takes new turns as
long as they fit ``budget`` less the system turn and the history allowance, and
one turn at least, whole; it ends where a block of ``BLOCK`` turns ends. A first
turn of role ``system`` stands at the head of every window. Later windows then
repeat the latest turns before their own, as many as fit ``history`` tokens. The
loss mask spans the texts of new assistant turns, so a repeated target is masked.

A conversation is never gathered: sorted turns are cut into chunks, whose totals
carry the prefix sums on; blocks choose their windows from token counts alone;
texts are joined to the places of their turns in windows, and gathered by window.
Only `conversation_digests`, whose hashes run over whole conversations, holds a
conversation's text in a row (so at most 2 GB of it).

Defined cases: columns beside conv_id, turn, role and text do not matter, whatever
their names. A null text or role is an empty one. Rows with a null conv_id
form one conversation; null turn numbers come first; repeated rows are turns of
their own. A turn larger than the budget is a window by itself. An empty table
gives no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from areacast.llm.common import written

#: Tokens of a window, and of repeated history in it.
BUDGET, HISTORY = 1024, 256
#: Turns after which a window ends in any case.
BLOCK = 1024

_TOKEN = r"[^\x20\x09-\x0D]+"
_END = "<|end|>\n"


def _escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&a;")), F.lit("<"), F.lit("&l;"))


def _unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&l;"), F.lit("<")), F.lit("&a;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(_escape(role), F.lit("|"), F.lit("&p;")), F.lit("\n"), F.lit("&n;"))


def _unescape_role(role: Column) -> Column:
    return _unescape(F.replace(F.replace(role, F.lit("&p;"), F.lit("|")), F.lit("&n;"), F.lit("\n")))


def _same(a: DataFrame, b: DataFrame, on: tuple[str, ...], how: str = "inner") -> DataFrame:
    """Joins by equal columns; null equals null. ``b``'s keys go."""
    b = b.withColumnsRenamed({c: f"{c}_" for c in on})
    each = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in on]
    return a.join(b, each, how).drop(*(f"{c}_" for c in on))


def _lines(conversations: DataFrame) -> DataFrame:
    """The turns in order of conversation and turn: ``at`` rises over all of them,
    and ``chunk`` is a run of them, so that a large conversation has several."""
    rows = conversations.select(
        F.col("conv_id"), F.col("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    order = ("conv_id", "turn", "role", "text")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select(
        "conv_id", "role", "text", (F.regexp_count("text", F.lit(_TOKEN)) + F.lit(1)).cast("long").alias("tokens"),
        F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("chunk"),
    )
    return written(rows, "chat-turns")


def _placed(lines: DataFrame) -> DataFrame:
    """conv_id, at, tokens, place (from 1), through (tokens of the conversation up
    to the turn's end), system (1 if its first turn is one), head (tokens of that
    turn) and turns (of the conversation): prefix sums in the chunks, and
    over the chunks' totals."""
    within = Window.partitionBy("conv_id", "chunk").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    first = F.struct((F.col("role") == "system").cast("int").alias("system"), "tokens")
    narrow = lines.select(
        "conv_id", "chunk", "at", "tokens", first.alias("first"),
        F.sum(F.lit(1)).over(within).alias("place"), F.sum("tokens").over(within).alias("through"),
    )
    chunks = lines.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"), F.sum("tokens").alias("sum"), F.min_by(first, "at").alias("first"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = chunks.select(
        "conv_id", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("places"),
        F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("tokens_before"),
        F.sum("n").over(whole).alias("turns"), F.first("first").over(whole).alias("first"),
    ).select(
        "conv_id", "chunk", "places", "tokens_before", "turns", F.col("first.system").alias("system"),
        F.when(F.col("first.system") == 1, F.col("first.tokens")).otherwise(F.lit(0)).alias("head"),
    )
    return _same(narrow.drop("first"), offsets, ("conv_id", "chunk")).select(
        "conv_id", "at", "tokens", (F.col("place") + F.col("places")).alias("place"),
        (F.col("through") + F.col("tokens_before")).alias("through"), "system", "head", "turns",
    )


def _members(placed: DataFrame, budget: int, history: int) -> DataFrame:
    """conv_id, block, window, at and repeated of every turn in every window, but
    for system turns. Needs no text: a group is the token counts of a block's
    turns, and of as many before it as history may reach."""
    block = max(BLOCK, history)
    since = F.col("place") - 1 - F.col("system")  # -1: the system turn, alone if there is no other
    own = F.greatest(F.floor(since / block), F.lit(0)).cast("long")
    reach = F.when((since >= 0) & (F.pmod(since, F.lit(block)) >= block - history), F.array(own, own + 1)).otherwise(F.array(own))
    turn = F.struct("place", "tokens", "through", "at")
    blocks = placed.withColumn("own", own).select("*", F.explode(reach).alias("block")).groupBy("conv_id", "block", "system", "head").agg(
        F.sort_array(F.collect_list(F.when(since >= 0, turn))).alias("turns"),
        F.count_if(F.col("own") == F.col("block")).alias("new"),
        F.count_if((F.col("own") < F.col("block"))).alias("led"),
    ).where("new > 0").withColumn("room", F.lit(budget - history) - F.col("head"))
    # Where new turns begin (their index in turns): where the tokens since the
    # last beginning no longer fit. A window has one turn at least.
    blocks = blocks.withColumn("starts", F.expr("""
        aggregate(slice(turns, cast(led + 1 as int), size(turns)),
            named_struct('i', cast(led as int), 'base', if(size(turns) > led, turns[cast(led as int)].through - turns[cast(led as int)].tokens, 0L), 'at', array(cast(led as int) + 1)),
            (s, t) -> if(t.through - s.base > room and s.i + 1 > element_at(s.at, -1),
                named_struct('i', s.i + 1, 'base', t.through - t.tokens, 'at', concat(s.at, array(s.i + 1))),
                named_struct('i', s.i + 1, 'base', s.base, 'at', s.at))).at"""))
    # Of the turns before a beginning, those repeated: within the history.
    shaped = blocks.select("conv_id", "block", "system", "turns", F.expr(f"""
        transform(starts, (i, w) -> named_struct('i', i, 'stop', if(w + 1 < size(starts), starts[w + 1], size(turns) + 1), 'n',
            if(i = 1, 0, size(filter(slice(turns, greatest(1, i - {history}), least({history}, i - 1)),
                t -> turns[i - 2].through - t.through + t.tokens <= {history})))))""").alias("shape"))
    each = shaped.select("conv_id", "block", "system", "turns", F.explode("shape").alias("w")).select(
        "conv_id", "block", F.expr("if(block = 0 and w.i = 1, 0L, turns[w.i - 1].place - 1)").alias("window"),
        F.expr("slice(turns, w.i - w.n, w.stop - w.i + w.n)").alias("turns"),
    )
    members = each.select("conv_id", "block", "window", F.explode_outer("turns").alias("t"))
    return members.select("conv_id", "block", "window", F.col("t.at").alias("at"), (F.col("t.place") <= F.col("window")).alias("repeated"))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window (number of turns before its new ones), n_repeated (turns at
    its head that stood in an earlier window), text and loss (start and stop code
    points) of each window."""
    lines = _lines(conversations)
    placed = _placed(lines)
    members = written(_members(placed, budget, history), "chat-windows")
    chosen = members.where("at IS NOT NULL").select("conv_id", "window", "at", "repeated").join(lines.select("at", "role", "text"), "at")
    # A system turn goes to the windows of each block of its conversation.
    size = max(BLOCK, history)
    heads = placed.where("place = 1 AND system = 1").select(
        "conv_id", "at", F.explode(F.expr(f"sequence(0L, greatest(turns - 2, 0L) div {size})")).alias("block")
    ).join(lines.select("at", "role", "text"), "at")
    headed = _same(members.select("conv_id", "block", "window").distinct(), heads, ("conv_id", "block"))
    parts = chosen.unionByName(headed.select("conv_id", "window", "at", (F.col("window") > 0).alias("repeated"), "role", "text"))
    each = parts.groupBy("conv_id", "window").agg(
        F.count_if("repeated").cast("int").alias("n_repeated"),
        F.sort_array(F.collect_list(F.struct("at", "role", "text", "repeated"))).alias("parts"),
    )
    piece = lambda t: F.concat(F.lit("<|"), _escape_role(t["role"]), F.lit("|>\n"), _escape(t["text"]), F.lit(_END))
    made = F.transform(F.col("parts"), lambda t: F.struct(
        piece(t).alias("text"),
        F.length(_escape_role(t["role"])).alias("head"),
        F.length(_escape(t["text"])).alias("body"),
        ((t["role"] == "assistant") & ~t["repeated"]).alias("target"),
    ))
    each = each.select("conv_id", "window", "n_repeated", made.alias("pieces"))
    return each.select(
        "conv_id", "window", "n_repeated",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("text"),
        F.expr("""
            aggregate(pieces, named_struct('at', 0, 'spans', cast(array() as array<struct<start:int,stop:int>>)), (s, p) ->
                named_struct('at', s.at + length(p.text), 'spans', if(p.target,
                    concat(s.spans, array(named_struct('start', s.at + p.head + 5, 'stop', s.at + p.head + 5 + p.body))), s.spans))).spans
        """).alias("loss"),
    )


def turns_of(formatted: DataFrame) -> DataFrame:
    """conv_id, window, turns (role and text of the new turns) and targets (the
    texts under the loss mask), read back from the output of `windows`."""
    pieces = F.split(F.col("text"), r"<\|end\|>\n", -1)
    new = F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated"))
    read = lambda p: F.struct(
        _unescape_role(F.regexp_extract(p, r"^<\|([^|]*)\|>\n", 1)).alias("role"),
        _unescape(F.substr(p, F.instr(p, "|>\n") + 3)).alias("text"),
    )
    return formatted.select(
        "conv_id", "window", F.length("text").alias("chars"),
        F.transform(new, read).alias("turns"),
        F.transform("loss", lambda s: _unescape(F.substr(F.col("text"), s["start"] + 1, s["stop"] - s["start"]))).alias("targets"),
    )


def marked_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts hold control strings of other templates."""
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    return spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text")
    )


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars
    and n_windows, read back from the windows."""
    read = turns_of(windows(conversations)).select(
        "conv_id", "window", "chars",
        F.size("turns").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        F.array_join("targets", "").alias("target"),
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"),
        F.sort_array(F.collect_list(F.struct("window", "said", "target"))).alias("parts"),
    )
    said, target = (F.array_join(F.transform("parts", lambda p: p[k]), "") for k in ("said", "target"))
    return whole.select(
        "conv_id", "n_turns", F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(target).cast("long").alias("loss_chars"), F.sha2(target.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars", "n_windows",
    )
