r"""Chat formatting as a grammar that reads back what it wrote, in DataFrame expressions alone.

    conversation := turn*
    turn         := "[INST] " role " [/INST]" text "</s>"

Control strings within a role or text would be read as marks. Each conversation
is first rendered as it is and parsed again; if the turns read differ from the
source, it is rendered anew with those strings escaped (a backslash after their
first character, one more for each that stands there already), and parsed
again. That is reversible for every text, so the second try always agrees, and
the operator raises an error rather than return a conversation that does not.

A turn ends with a mark, and no mark reaches over its end: so what is read from
a run of turns doesn't depend on the turns around it. Conversations are
therefore rendered and parsed in blocks of at most 2**BLOCK turns, in parallel
where one is long; only digests and joined texts put blocks together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratedig.llm._util import in_order, save

OPEN, MIDDLE, CLOSE = "[INST] ", " [/INST]", "</s>"
#: Turns whose text is trained on.
LOSS_ROLE = "assistant"
BLOCK = 5
_CONTROL = r"([\[<])(\\*)(INST\]|/INST\]|/s>)"
_ESCAPED = r"([\[<])\\(\\*)(INST\]|/INST\]|/s>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"$1$2$3")


def render(turns: Column, escaped: bool) -> Column:
    """The formatted text of an array of (role, text)."""
    put = escape if escaped else (lambda x: x)
    return F.array_join(F.transform(turns, lambda x: F.concat(F.lit(OPEN), put(x["role"]), F.lit(MIDDLE), put(x["text"]), F.lit(CLOSE))), "")


def _bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f(x)`` with ``x`` computed once: what a lambda takes from outside is evaluated anew for every element."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _sums_before(numbers: Column) -> Column:
    """For each number the sum of those before it; for the few turns of a block."""
    zero = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("before"))
    summed = F.aggregate(numbers, zero, lambda s, x: F.struct((s["total"] + x).alias("total"), F.concat(s["before"], F.array(s["total"])).alias("before")))
    return summed["before"]


def parse(formatted: Column, escaped: bool) -> Column:
    """The array of (role, text, start, end) that the grammar reads; start and end are code points of the text as written.

    Reading is left to right: up to the next CLOSE a turn, up to its first
    MIDDLE the role. What does not begin with OPEN or lacks MIDDLE reads as a
    turn of null role, which no source has.
    """
    take = unescape if escaped else (lambda x: x)
    pieces = F.split(formatted, "</s>")
    # what stands after the last CLOSE must be nothing; else it is a turn that was not closed
    turns = F.when(F.element_at(pieces, -1) == "", F.slice(pieces, 1, F.size(pieces) - 1)).otherwise(pieces)

    def turn(x: Column) -> Column:
        cut = F.instr(x, MIDDLE)
        ok = x.startswith(OPEN) & (cut > len(OPEN))
        role = F.when(ok, take(F.substring(x, F.lit(len(OPEN) + 1), cut - len(OPEN) - 1)))
        text = F.substring(x, F.when(ok, cut + len(MIDDLE)).otherwise(1), F.length(x))
        return F.struct(role.alias("role"), take(text).alias("text"), F.length(text).alias("width"), F.length(x).alias("length"))

    def placed(x: Column, at: Column) -> Column:
        end = at + x["length"]
        return F.struct(x["role"].alias("role"), x["text"].alias("text"), (end - x["width"]).alias("start"), end.alias("end"))

    places = lambda read: _sums_before(F.transform(read, lambda x: x["length"] + len(CLOSE)))
    return _bound(F.transform(turns, turn), lambda read: F.zip_with(read, places(read), placed))


def same_turns(a: Column, b: Column) -> Column:
    slim = lambda t: F.transform(t, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    return slim(a) == slim(b)


def format_blocks(conversations: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Per conv_id and block: formatted, escaped, turns as read back (role, text, start, end) and loss_mask (the spans of ``loss_role``).

    A conversation's blocks in ascending order are the conversation; places
    count code points of the block's formatted text. Rows go by turn, null first,
    ties by role and the text's md5; null roles and texts are empty. A null
    conv_id is one conversation. Repeated rows are turns of their own. Other
    columns are ignored; an empty table gives an empty result.
    """
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = in_order(rows, [F.col("conv_id"), F.col("turn"), F.col("role"), F.md5("text")], "place")
    row = F.struct("place", "role", "text")
    blocks = placed.groupBy("conv_id", F.call_function("shiftright", F.col("place"), F.lit(BLOCK)).alias("block")).agg(F.sort_array(F.collect_list(row)).alias("source"))
    plain = blocks.withColumn("formatted", render(F.col("source"), False)).withColumn("turns", parse(F.col("formatted"), False))
    plain = save(plain.withColumn("conflict", ~same_turns(F.col("source"), F.col("turns"))).drop("turns"), "blocks")
    wrong = plain.where("conflict").select(F.col("conv_id").alias("_conv"), F.lit(True).alias("escaped")).distinct()
    # one block that reads back differently has its whole conversation escaped
    out = plain.join(wrong, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").withColumn("escaped", F.coalesce("escaped", F.lit(False))).drop("_conv", "conflict")
    out = out.withColumn("formatted", F.when(F.col("escaped"), render(F.col("source"), True)).otherwise(F.col("formatted")))
    out = out.withColumn("turns", F.when(F.col("escaped"), parse(F.col("formatted"), True)).otherwise(parse(F.col("formatted"), False)))
    different = F.raise_error(F.concat(F.lit("conversation reads back differently: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    out = out.withColumn("turns", F.when(same_turns(F.col("source"), F.col("turns")), F.col("turns")).otherwise(different))
    mask = F.transform(F.filter("turns", lambda x: x["role"] == loss_role), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return out.select("conv_id", "block", "formatted", "escaped", "turns", mask.alias("loss_mask"))


def _joined(blocks: DataFrame, pieces: dict[str, Column], *more: Column) -> DataFrame:
    """Per conv_id the strings ``pieces`` of its blocks end to end, and further aggregates: each string is copied once."""
    parts = blocks.select("conv_id", "block", *(c.alias(k) for k, c in pieces.items()), *(c for c in blocks.columns if c not in ("conv_id", "block", *pieces)))
    lists = [F.sort_array(F.collect_list(F.struct("block", k))).alias(k) for k in pieces]
    grouped = parts.groupBy("conv_id").agg(*lists, *more)
    return grouped.withColumns({k: F.array_join(F.col(k).getField(k), "") for k in pieces})


def format_chats(conversations: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """``format_blocks`` put together: one row per conv_id, which its turns must fit; places count from its beginning."""
    blocks = format_blocks(conversations, loss_role).withColumn("chars", F.length("formatted"))
    kept = F.sort_array(F.collect_list(F.struct("block", "chars", "turns", "loss_mask"))).alias("blocks")
    out = _joined(blocks, {"formatted": F.col("formatted")}, F.max("escaped").alias("escaped"), kept)
    moved = lambda x, by: F.struct(*(x[f] for f in ("role", "text")), (x["start"] + by).alias("start"), (x["end"] + by).alias("end"))
    span = lambda x, by: F.struct((x["start"] + by).alias("start"), (x["end"] + by).alias("end"))
    shifted = lambda field, f: F.flatten(F.zip_with("blocks", "before", lambda b, by: F.transform(b[field], lambda x: f(x, by))))
    out = out.withColumn("before", _sums_before(F.transform("blocks", lambda b: b["chars"])))
    return out.select("conv_id", "formatted", "escaped", shifted("turns", moved).alias("turns"), shifted("loss_mask", span).alias("loss_mask"))


def chat_digest(blocks: DataFrame) -> DataFrame:
    """Per conv_id digests of what the formatted texts of ``format_blocks`` say, read from them and their loss masks."""
    turns = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    part = lambda x: F.substring(F.col("formatted"), x["start"] + 1, x["end"] - x["start"])
    masked = F.transform("loss_mask", lambda x: F.when(F.col("escaped"), unescape(part(x))).otherwise(part(x)))
    sums = [F.sum(x).cast("long").alias(k) for k, x in (("n_turns", F.size("turns")), ("formatted_chars", F.length("formatted")))]
    out = _joined(blocks, {"said": turns, "loss": F.array_join(masked, "")}, *sums)
    return out.select("conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
