"""Chat formatting into budgeted windows, with DataFrame functions only.

Prefix sums of turn tokens cut a conversation into spans of whole turns. A span becomes a window: the system
turn, then the last few turns before the span as history, then the span's own turns. Only the assistant's
turns of the span itself are targets; repeated ones are masked, so every target is trained on once.

Spans are chosen on narrow rows (turn number, tokens), those of a conversation in one task and in time linear in its
turns. The texts are grouped by (conversation, window), so those of a conversation that holds a third of all rows are
spread over many tasks; they pass one sort by conversation, which spills, to number the turns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A turn is ``BEGIN role \n text END``. A text may contain these; there every "<" and "[" is followed by "\",
#: and every "\" is doubled, so no control string of this or of similar templates survives in it.
BEGIN, END = "<s>", "</s>"
#: A line break inside a role. It cannot occur in an escaped string.
BREAK = "[n"


def escape(text: Column) -> Column:
    for plain, safe in (("\\", "\\\\"), ("<", "<\\"), ("[", "[\\")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in (("[", "[\\"), ("<", "<\\"), ("\\", "\\\\")):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


@dataclass
class ChatWindows:
    """``budget``: tokens of a window, of which history takes ``history_tokens`` and ``history_turns`` at most. A
    token is counted as four bytes of text; a turn too long for the budget has a window of its own."""

    budget: int = 1024
    history_turns: int = 2
    history_tokens: int = 256

    def format(self, conversations: DataFrame) -> DataFrame:
        """(conv_id, window, text, repeated, targets array<struct<start, length>>), a row per window.

        ``repeated``: how many of the window's turns earlier windows held already. ``targets``: code points of
        ``text``, from 0. Turns are ordered by turn, role and text (NULL first), rows that repeat all three
        are turns of their own; NULL roles and texts count as empty, NULL conv_ids as one conversation.
        """
        turns = self._turns(conversations)
        plan = self._plan(turns)
        placed = turns.join(plan, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("pos") == F.col("_pos")))
        placed = placed.select("conv_id", "pos", "role", "text", "place")
        segment = F.struct(
            "pos", F.col("place.fresh").alias("fresh"), (F.col("role") == "assistant").alias("answer"),
            F.concat(F.lit(BEGIN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit(BREAK)), F.lit("\n")).alias("head"),
            escape(F.col("text")).alias("body"),
        )
        windows = placed.groupBy("conv_id", F.col("place.window").alias("window")).agg(
            F.sort_array(F.collect_list(segment)).alias("s")
        )
        size = lambda x: F.length(x["head"]) + F.length(x["body"]) + len(END)
        begins = F.aggregate(
            "s", F.array(F.lit(0)), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + size(x))
        )  # a window holds few turns: each costs a token at least
        targets = F.transform(
            F.filter(F.arrays_zip(F.col("s").alias("x"), begins.alias("at")), lambda z: z["x"]["fresh"] & z["x"]["answer"]),
            lambda z: F.struct((z["at"] + F.length(z["x"]["head"])).alias("start"), F.length(z["x"]["body"]).alias("length")),
        )
        return windows.select(
            "conv_id",
            "window",
            F.array_join(F.transform("s", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "").alias("text"),
            F.size(F.filter("s", lambda x: ~x["fresh"])).alias("repeated"),
            targets.alias("targets"),
        )

    @staticmethod
    def _turns(conversations: DataFrame) -> DataFrame:
        rows = conversations.select(
            "conv_id", F.col("turn").alias("_turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
        )
        order = Window.partitionBy("conv_id").orderBy("_turn", "role", "text")
        return rows.withColumn("pos", F.row_number().over(order)).drop("_turn")

    def _plan(self, turns: DataFrame) -> DataFrame:
        """(_conv, _pos, place struct<window, pos, fresh>): a row for each window that holds a turn."""
        before = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        system = (F.col("pos") == 1) & (F.col("role") == "system")
        cost = F.lit(1) + F.octet_length("text").cast("long") / F.lit(4).cast("long")
        narrow = turns.select("conv_id", "pos", system.alias("system"), F.floor(cost).alias("n"))
        narrow = narrow.withColumn("counted", F.when(F.col("system"), 0).otherwise(F.col("n")))
        narrow = narrow.withColumn("upto", F.sum("counted").over(before))
        row = F.struct("pos", "upto", "n", "system")
        whole = narrow.groupBy("conv_id").agg(
            F.array_sort(F.collect_list(row)).alias("t"), F.coalesce(F.sum(F.when(F.col("system"), F.col("n"))), F.lit(0)).alias("fixed")
        )
        room = F.greatest(F.lit(1).cast("long"), F.lit(self.budget) - self.history_tokens - F.col("fixed"))
        whole = whole.withColumn("room", room)
        # Greedy spans over the prefix sums: a turn opens a span when its end is out of the open one's room. Only the
        # turns that open one are listed, so the fold copies a list once a span.
        whole = whole.withColumn("opens", F.expr("""
            aggregate(t, named_struct('from', 0L, 'opens', array(0)), (s, x) ->
                if(NOT x.system AND x.upto - s.from > room AND x.upto - x.n > s.from,
                   named_struct('from', x.upto - x.n, 'opens', array_append(s.opens, x.pos - 1)), s),
                s -> s.opens)"""))  # fmt: skip
        # Window k: its span's turns, the system turn, and the last turns before the span that fit the history.
        places = F.expr(f"""
            flatten(transform(opens, (o, k) -> concat(
                transform(slice(t, o + 1, if(k + 1 < size(opens), opens[k + 1], size(t)) - o), x -> named_struct('window', k, 'pos', x.pos, 'fresh', true)),
                if(k > 0 AND t[0].system, array(named_struct('window', k, 'pos', 1, 'fresh', false)), array()),
                transform(
                    filter(slice(t, greatest(1, o + 1 - {self.history_turns}), least(o, {self.history_turns})),
                        x -> NOT x.system AND t[o - 1].upto - (x.upto - x.n) <= {self.history_tokens}),
                    x -> named_struct('window', k, 'pos', x.pos, 'fresh', false)))))""")  # fmt: skip
        return whole.select(F.col("conv_id").alias("_conv"), F.explode(places).alias("place")).select("_conv", F.col("place.pos").alias("_pos"), "place")


def read_windows(windows: DataFrame) -> DataFrame:
    """(conv_id, window, turns array<struct<role, text>>, targets array<string>, chars): the windows read back,
    each turn once, where it is fresh; ``targets`` are the unescaped texts under the loss mask."""
    cut = F.slice(F.split("text", END), F.col("repeated") + 1, F.size(F.split("text", END)) - 1 - F.col("repeated"))

    def parsed(x: Column) -> Column:
        role = F.substring_index(x, "\n", 1)
        body = F.substr(x, F.length(role) + 2, F.length(x))
        role = F.replace(F.substr(role, F.lit(len(BEGIN) + 1), F.length(role)), F.lit(BREAK), F.lit("\n"))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    # Fresh turns follow the repeated ones, but in the first window all turns, the system's too, are fresh.
    return windows.select(
        "conv_id",
        "window",
        F.transform(cut, parsed).alias("turns"),
        F.transform("targets", lambda t: unescape(F.substr("text", t["start"] + 1, t["length"]))).alias("targets"),
        F.length("text").cast("long").alias("chars"),
    )


def round_trip(windows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read from the windows."""
    read = read_windows(windows)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    per = read.select(
        "conv_id", "chars", F.size("turns").cast("long").alias("n"),
        F.struct("window", turns.alias("turns"), F.array_join("targets", "").alias("loss")).alias("part"),
    )
    whole = per.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list("part")).alias("parts")
    )
    loss = F.array_join("parts.loss", "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join("parts.turns", ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )
