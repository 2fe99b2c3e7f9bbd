"""Chat formatting in budgeted windows.

Turns become ``<|im_start|>role\\ntext<|im_end|>\\n``. Prefix sums of turn
tokens cut a conversation into turn-aligned spans: a turn belongs to the span
in which its first token falls when the conversation's tokens are divided by
the budget for new turns. Every span is one window: the conversation's leading
system turn, then the turns of the span before it that start within the
history budget, then the span's own turns. Loss is on the texts of the span's
own assistant turns only; history and system turns are repeated without it, so
every assistant text is a target exactly once.

Control strings inside a text are escaped reversibly: ``<``, any number of
backslashes and ``|`` gets one more backslash, so ``<|`` never occurs in an
escaped text. In roles the backslash and the newline are escaped first.

The prefix sums run per segment of SEGMENT turn numbers, each of which starts
from the sums of the segments before it, so that a conversation that holds a
third of all turns is spread over many tasks. A turn lies in at most two windows
beside the repeated system turn, and a window holds at most the budgets plus
the turns that cross their ends, so the groups that are gathered are bounded
whatever the length of a conversation. The digests of a conversation are of all
its text, in order: they stream its windows and hold one at a time.

Results for odd rows: a null text or role is empty; turns with equal number
are ordered by role and text, null numbers come first; rows with a null
conversation id form one conversation; repeated rows are repeated turns; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices

#: Tokens of new turns and of repeated history in a window.
NEW_TOKENS, HISTORY_TOKENS = 1024, 256
#: Turn numbers in a segment.
SEGMENT = 512

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*+)\|", r"<$1\\|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\\\|", r"<$1|")


def escape_role(c: Column) -> Column:
    return escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(c: Column) -> Column:
    # one pass: a backslash pair is a backslash, backslash and n a newline
    parts = F.regexp_extract_all(unescape(c), F.lit(r"(?s)\\\\|\\n|[^\\]+|\\"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p == "\\\\", "\\").when(p == "\\n", "\n").otherwise(p)), "")


def count_tokens(c: Column) -> Column:
    """Words and single marks; any monotone count of a text would do."""
    return F.regexp_count(c, F.lit(r"\w+|[^\w\s]"))


def windows(turns: DataFrame, new_tokens: int = NEW_TOKENS, history_tokens: int = HISTORY_TOKENS, conv_col: str = "conv_id",
            turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per window: ``conv_id window text loss n_system n_history
    n_turns n_new``; ``loss`` holds start and end (code points of ``text``, end
    exclusive) of every target, ``n_turns`` all turns of the window, of which
    the last ``n_new`` appear as new."""
    if not 0 < history_tokens <= new_tokens:
        raise ValueError("history must fit the budget of new turns")
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    t = t.withColumn("tokens", (count_tokens(F.col("text")) + 4).cast("long"))
    t = t.withColumn("seg", F.coalesce(F.floor(F.col("turn") / SEGMENT), F.lit(-2**62)))
    zero = F.lit(0).cast("long")
    t = t.select("*", F.lit(1).alias("is_row"), zero.alias("n_before"), zero.alias("total"))
    # turns and tokens of a conversation before each of its segments, as one row that sorts before the segment's turns
    sums = t.groupBy("conv_id", "seg").agg(F.count("*").alias("n"), F.sum("tokens").alias("s"))
    conv = Window.partitionBy("conv_id")
    before = conv.orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select("conv_id", F.lit(None).cast(dict(t.dtypes)["turn"]).alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
                        F.coalesce(F.sum("s").over(before), zero).alias("tokens"), "seg", F.lit(0).alias("is_row"),
                        F.coalesce(F.sum("n").over(before), zero).alias("n_before"), F.sum("s").over(conv).alias("total"))
    by = Window.partitionBy("conv_id", "seg").orderBy("is_row", F.col("turn").asc_nulls_first(), "role", "text")
    so_far = by.rowsBetween(Window.unboundedPreceding, 0)
    t = t.union(carry).select(
        "conv_id", "role", "text", "is_row", (F.row_number().over(by) - 1 + F.sum("n_before").over(so_far)).alias("pos"),
        (F.sum("tokens").over(so_far) - F.col("tokens")).alias("first"), F.sum("total").over(so_far).alias("total")).where("is_row = 1")
    t = t.withColumn("window", F.floor(F.col("first") / new_tokens).cast("int"))
    system = (F.col("pos") == 1) & (F.col("role") == "system")
    last = F.floor((F.col("total") - 1) / new_tokens).cast("int")
    # where a turn appears: own window as new (2), the system turn in all later ones (0), others perhaps in the next as history (1)
    place = lambda w, kind: F.struct(w.cast("int").alias("window"), F.lit(kind).alias("kind"))
    t = t.withColumn("last", last).withColumn("places", F.when(system & (F.col("last") > 0), F.concat(
        F.array(place(F.lit(0), 2)), F.transform(F.sequence(F.lit(1), F.greatest("last", F.lit(1))), lambda w: place(w, 0))))
        .when(~system & (F.col("first") >= (F.col("window") + 1).cast("long") * new_tokens - history_tokens), F.array(place(F.col("window"), 2), place(F.col("window") + 1, 1)))
        .otherwise(F.array(place(F.col("window"), 2))))
    t = t.select("conv_id", "pos", "first", "role", "text", F.explode("places").alias("place")).select("conv_id", "place.window", "place.kind", "pos", "first", "role", "text")
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    t = t.withColumn("head", head).withColumn("body", body)
    t = t.withColumn("piece", F.struct("pos", "kind", "first", "role", "head", "body"))
    w = t.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    w = w.where(F.exists("pieces", lambda p: p["kind"] == 2))  # a window of the system turn alone, where no turn starts
    # history is what starts within its budget before the window's first new turn
    w = w.withColumn("begin", F.array_min(F.transform(F.filter("pieces", lambda p: p["kind"] == 2), lambda p: p["first"])))
    w = w.withColumn("pieces", F.filter("pieces", lambda p: (p["kind"] != 1) | (p["first"] >= F.col("begin") - history_tokens)))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("loss"))

    def step(a, p):
        start = a["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        target = (p["kind"] == 2) & (p["role"] == "assistant")
        return F.struct((end + len(END)).alias("at"), F.when(target, F.array_append(a["loss"], F.struct(start.alias("start"), end.alias("end")))).otherwise(a["loss"]).alias("loss"))

    count = lambda kind: F.size(F.filter("pieces", lambda p: p["kind"] == kind))
    return w.select("conv_id", "window", F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("text"),
                    F.aggregate("pieces", zero, step, lambda a: a["loss"]).alias("loss"),
                    count(0).alias("n_system"), count(1).alias("n_history"), F.size("pieces").alias("n_turns"), count(2).alias("n_new"))


def _window_texts(formatted: DataFrame) -> DataFrame:
    """Per window, from its text and loss alone: the new turns as role, newline,
    text, newline, and the unescaped texts under the loss."""
    raw = F.split("text", r"<\|im_end\|>\n", -1)
    parts = F.transform(F.slice(raw, F.col("n_turns") - F.col("n_new") + 1, F.col("n_new")), lambda p: F.substring(p, len(START) + 1, F.length(p)))
    role = lambda p: unescape_role(F.substring_index(p, "\n", 1))
    text = lambda p: unescape(F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p)))
    return formatted.select(
        "conv_id", "window", F.col("n_new").cast("long").alias("n"), F.length("text").cast("long").alias("chars"),
        F.array_join(F.transform(parts, lambda p: F.concat(role(p), F.lit("\n"), text(p), F.lit("\n"))), "").alias("turns"),
        F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]))), "").alias("target"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation: ``conv_id n_turns turns target formatted_chars``;
    ``turns`` and ``target`` join those of its windows in order, so this is for
    conversations that fit into one string; ``chat_digest`` is for any."""
    g = _window_texts(formatted).groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("window", "turns", "target"))).alias("all"), F.sum("chars").alias("formatted_chars"))
    return g.select("conv_id", "n_turns", F.array_join("all.turns", "").alias("turns"), F.array_join("all.target", "").alias("target"), "formatted_chars")


def _digests(batches):
    """Digests of conversations whose windows come in order, window by window:
    no conversation is held whole."""
    now, held = None, None
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def closed(rows, kind):
        cols = list(zip(*rows)) or [()] * len(names)
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    def row():
        return now, held[0], held[1].hexdigest(), held[2], held[3].hexdigest(), held[4]

    kind = None
    for batch in slices(batches):
        kind, done = batch.column(0).type, []
        for conv, n, chars, turns, target in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "n", "chars", "turns", "target"))):
            if held is None or conv != now:
                if held is not None:
                    done.append(row())
                now, held = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            held[0] += n
            held[1].update(turns.encode())
            held[2] += len(target)
            held[3].update(target.encode())
            held[4] += chars
        yield closed(done, kind)
    if held is not None:
        yield closed([row()], kind)


def chat_digest(turns: DataFrame) -> DataFrame:
    """Digests of every conversation, read back from its windows. A digest of
    a whole text is computed in one task, which streams the windows."""
    # the windows are shuffled as formatted, and parsed where they arrive
    w = windows(turns).repartition("conv_id").sortWithinPartitions("conv_id", "window")
    kind = dict(w.dtypes)["conv_id"]
    return _window_texts(w).mapInArrow(
        _digests, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
