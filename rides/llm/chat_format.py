"""Chat formatting in budgeted windows.

The turns of a conversation have a prefix sum of tokens; dividing it by a
stride gives turn-aligned spans. A window is the system turn, the last turns of
the span before as far as the history allowance goes, and its own span. Only
assistant turns of a window's own span are targets: the system turn, history
and other roles are masked, so each assistant text is learnt once.

The stride is the budget less the history, the system turn and the longest
other turn of the conversation, so a window never exceeds the budget unless one
turn and the system turn alone do; a turn is never cut. A turn's tokens are its
words and one for its markers.

Template: ``<role>`` newline text ``</turn>`` newline, with ``&``, ``<`` and
``>`` of roles and texts written as ``&amp;``, ``&lt;`` and ``&gt;``: no text can
hold a control string, and unescaping gives it back.

Defined cases: null texts and roles are empty; turns are ordered by turn (null
first), then role, then text, and repeated rows stay; a null conversation id is
a conversation; a system turn counts as such only as the first turn; an empty
table gives no windows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rides.llm.common import col, let, space_words

BUDGET = 512
HISTORY = 128
TURN_END = "</turn>\n"
HEAD_END = ">\n"
SYSTEM, TARGET = "system", "assistant"


def escaped(text: Column) -> Column:
    out = text
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def unescaped(text: Column) -> Column:
    out = text
    for raw, safe in ((">", "&gt;"), ("<", "&lt;"), ("&", "&amp;")):
        out = F.replace(out, F.lit(safe), F.lit(raw))
    return out


def _turns(df: DataFrame, budget: int, history: int, names: dict[str, str]) -> DataFrame:
    """Turns with their place (``seq``), span, and what later windows repeat."""
    base = df.select(col(names["conv_id"]).alias("conv_id"), col(names["turn"]).alias("turn"),
                     F.coalesce(col(names["role"]), F.lit("")).alias("role"),
                     F.coalesce(col(names["text"]), F.lit("")).alias("text"))
    conv = Window.partitionBy("conv_id")
    order = conv.orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = base.withColumn("seq", F.row_number().over(order))
    is_system = (F.col("seq") == 1) & (F.col("role") == SYSTEM)
    tokens = (F.size(space_words(F.col("text"))) + 1).cast("long")
    turns = turns.withColumn("is_system", is_system).withColumn("tokens", tokens)
    own = F.when(F.col("is_system"), F.lit(0)).otherwise(F.col("tokens"))
    system = F.when(F.col("is_system"), F.col("tokens")).otherwise(F.lit(0))
    turns = turns.withColumn("own", own)
    at = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumns({
        "start": F.coalesce(F.sum("own").over(at), F.lit(0)),
        "total": F.sum("own").over(conv),
        "longest": F.max("own").over(conv),
        "system_tokens": F.max(system).over(conv),
        "system_text": F.max(F.when(F.col("is_system"), F.col("text"))).over(conv),
    })
    free = F.lit(budget) - F.col("system_tokens") - F.col("longest")
    turns = turns.withColumn("stride", F.greatest(free - history, F.lit(1)))
    turns = turns.withColumn("room", F.greatest(F.least(free - F.col("stride") + 1, F.lit(history)), F.lit(0)))
    turns = turns.withColumn("span", F.floor(F.col("start") / F.col("stride")))
    in_span = Window.partitionBy("conv_id", "span")
    return turns.withColumns({
        "span_start": F.min("start").over(in_span),
        "span_stop": F.max(F.col("start") + F.col("own")).over(in_span),
    })


def windows(df: DataFrame, budget: int = BUDGET, history: int = HISTORY,
            conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """conv_id, window, n_repeated (leading turns that earlier windows hold as
    their own), n_turns, tokens, formatted, loss (start and length of each
    target in characters of ``formatted``). One shuffle, by conversation."""
    turns = _turns(df, budget, history, {"conv_id": conv_id, "turn": turn, "role": role, "text": text})
    fields = ("window", "seq", "fresh", "role", "text", "tokens")
    kind = "struct<window:bigint,seq:int,fresh:boolean,role:string,text:string,tokens:bigint>"

    def copy(window: Column, seq: Column, fresh: bool, role: Column, text: Column, tokens: Column) -> Column:
        values = (window, seq, F.lit(fresh), role, text, tokens)
        return F.struct(*[v.alias(n) for v, n in zip(values, fields)]).cast(kind)

    me = (F.col("role"), F.col("text"), F.col("tokens"))
    later = F.floor(F.col("span_stop") / F.col("stride"))
    as_history = (~F.col("is_system") & (F.col("span_stop") < F.col("total"))
                  & (F.col("span_stop") - F.col("start") <= F.col("room")))
    opens = (F.col("system_text").isNotNull() & ~F.col("is_system")
             & (F.col("start") == F.col("span_start")) & (F.col("span") > 0))
    none = F.array().cast(f"array<{kind}>")
    copies = F.concat(
        F.array(copy(F.col("span"), F.col("seq"), True, *me)),
        F.when(as_history, F.array(copy(later, F.col("seq"), False, *me))).otherwise(none),
        F.when(opens, F.array(copy(F.col("span"), F.lit(1), False, F.lit(SYSTEM),
                                   F.col("system_text"), F.col("system_tokens")))).otherwise(none))
    rows = turns.select("conv_id", F.explode(copies).alias("c")).select("conv_id", "c.*")
    grouped = rows.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("seq", "fresh", "role", "text"))).alias("turns"),
        F.sum("tokens").alias("tokens"))
    heads = F.transform("turns", lambda t: F.concat(F.lit("<"), escaped(t["role"]), F.lit(HEAD_END)))
    bodies = F.transform("turns", lambda t: escaped(t["text"]))
    laid = grouped.select("conv_id", "window", "tokens", "turns", heads.alias("heads"), bodies.alias("bodies"))

    def length(i: Column) -> Column:
        return F.char_length(F.get("heads", i)) + F.char_length(F.get("bodies", i)) + len(TURN_END)

    def spans(stops: Column) -> Column:
        each = F.transform("turns", lambda t, i: F.struct(
            (F.coalesce(F.get(stops, i - 1), F.lit(0)) + F.char_length(F.get("heads", i))).alias("start"),
            F.char_length(F.get("bodies", i)).alias("length"),
            (t["fresh"] & (t["role"] == TARGET)).alias("target")))
        return F.transform(F.filter(each, lambda x: x["target"]),
                           lambda x: F.struct(x["start"], x["length"]))

    # Running lengths; a window holds at most its budget of turns.
    sizes = F.transform("turns", lambda t, i: length(i))
    stops = F.aggregate(sizes, F.array().cast("array<int>"), lambda a, x: F.concat(
        a, F.array(F.coalesce(F.element_at(F.when(F.size(a) > 0, a), -1), F.lit(0)) + x)))
    formatted = F.array_join(F.transform("heads", lambda h, i: F.concat(
        h, F.get("bodies", i), F.lit(TURN_END))), "")
    return laid.select(
        "conv_id", "window",
        F.size(F.filter("turns", lambda t: ~t["fresh"])).alias("n_repeated"),
        F.size("turns").alias("n_turns"), "tokens", formatted.alias("formatted"),
        let(stops, spans).alias("loss"))


def parsed(rows: DataFrame) -> DataFrame:
    """conv_id, window, chars of the window, turns (role and text of its own
    turns) and targets (texts under the loss mask), read from ``formatted``."""
    pieces = F.split(F.col("formatted"), TURN_END)
    own = let(pieces, lambda p: F.slice(p, F.col("n_repeated") + 1, F.size(p) - 1 - F.col("n_repeated")))

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, HEAD_END, 1)
        body = F.substr(piece, F.char_length(head) + len(HEAD_END) + 1)
        return F.struct(unescaped(F.substr(head, F.lit(2))).alias("role"), unescaped(body).alias("text"))

    return rows.select(
        "conv_id", "window", F.char_length("formatted").cast("long").alias("chars"),
        F.transform(own, turn).alias("turns"),
        F.transform("loss", lambda s: unescaped(
            F.substr(F.col("formatted"), s["start"] + 1, s["length"]))).alias("targets"))


def format_digest(rows: DataFrame) -> DataFrame:
    """Per conversation: counts and checksums of what reading the windows
    back gives, in window order."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    back = parsed(rows).select(
        "conv_id", F.size("turns").cast("long").alias("n"), "chars",
        F.struct("window", F.array_join(lines, "").alias("turns"),
                 F.array_join("targets", "").alias("loss")).alias("w"))
    whole = back.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list("w")).alias("ws"))
    loss = whole.withColumn("loss_text", F.array_join("ws.loss", ""))
    return loss.select(
        "conv_id", "n_turns", F.sha2(F.array_join("ws.turns", ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")
