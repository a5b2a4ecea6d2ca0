"""Chat formatting: one training text per conversation, with a loss mask, from expressions only.

Turns are collected as structs and sorted; adjacent turns of one role become one block. A block is

    ### role:<newline>text</part>text</turn><newline>

`&`, `<` and `#` inside texts and roles (and `:` inside roles) are written as entities, so no text
can hold a mark and the texts can be read back exactly. The loss mask is run-length encoded: runs of
code points that are, or are not, text of the trained role. Texts under the mask are cut from four
bytes for each code point, so that a cut costs its own length wherever it lies.

Defined cases: null text and null role are empty; null turns come first; rows with equal turn
numbers are ordered by role, then text, and repeated rows stay; rows without a conversation id form
one conversation without id; no rows give no conversations. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"
OPEN, ROLE_END, PART, CLOSE = "### ", ":\n", "</part>", "</turn>\n"
# The character and its entity; `&` is written first and read last.
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("#", "&num;"))
ROLE_ENTITIES = (*ENTITIES, (":", "&colon;"))
#: Runs whose starts are summed up in one array; appending to longer ones would cost their square.
CHUNK = 256


def escape(text: Column, entities: tuple = ENTITIES) -> Column:
    for character, entity in entities:
        text = F.replace(text, F.lit(character), F.lit(entity))
    return text


def unescape(text: Column, entities: tuple = ENTITIES) -> Column:
    for character, entity in reversed(entities):
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def _role_at(turns: Column, i: Column) -> Column:
    """Role of turn i (from 0), null outside."""
    return F.when(i >= 0, F.get(turns, i)["role"])


def format_conversations(rows: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """(conv_id, formatted, loss_runs) for rows (conv_id, turn, role, text).

    `loss_runs` is an array of (length, loss); lengths add up to those of `formatted`.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    collected = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def segments(t: Column, i: Column) -> Column:
        """Mark before the text, the text, mark after it; adjacent turns of one role share a block."""
        starts = ~t["role"].eqNullSafe(_role_at(F.col("turns"), i - 1))
        ends = ~t["role"].eqNullSafe(_role_at(F.col("turns"), i + 1))
        header = F.concat(F.lit(OPEN), escape(t["role"], ROLE_ENTITIES), F.lit(ROLE_END))
        before = F.when(starts, header).otherwise(F.lit(PART))
        after = F.when(ends, F.lit(CLOSE)).otherwise(F.lit(""))
        return F.array(
            F.struct(before.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), (t["role"] == trained_role).alias("loss")),
            F.struct(after.alias("text"), F.lit(False).alias("loss")),
        )

    parts = collected.select(
        "conv_id", F.flatten(F.transform("turns", segments)).alias("segments")
    )
    return parts.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        F.transform(
            "segments",
            lambda s: F.struct(F.length(s["text"]).alias("length"), s["loss"].alias("loss")),
        ).alias("loss_runs"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns (role, text) of every formatted conversation, as column `turns`."""
    blocks = F.filter(F.split("formatted", CLOSE), lambda b: b != "")

    def turns(block: Column) -> Column:
        cut = F.instr(block, F.lit(ROLE_END))
        role = unescape(F.substring(block, len(OPEN) + 1, cut - len(OPEN) - 1), ROLE_ENTITIES)
        body = F.substring(block, cut + len(ROLE_END), F.length(block))
        return F.transform(
            F.split(body, PART),
            lambda text: F.struct(role.alias("role"), unescape(text).alias("text")),
        )

    return formatted.withColumn("turns", F.flatten(F.transform(blocks, turns)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, also where `body` reads it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _starts(lengths: Column) -> Column:
    """Sum of the lengths before each."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    return F.aggregate(
        lengths,
        state,
        lambda s, n: F.struct(
            (s["at"] + n).alias("at"), F.array_append(s["starts"], s["at"]).alias("starts")
        ),
        lambda s: s["starts"],
    )


def loss_texts(formatted: Column, loss_runs: Column) -> Column:
    """The texts under the loss mask, read back from `formatted`."""

    def lengths(runs: Column) -> Column:
        return F.transform(runs, lambda r: r["length"])

    def total(runs: Column) -> Column:
        return F.aggregate(runs, F.lit(0), lambda at, r: at + r["length"])

    def chunks(runs: Column) -> Column:
        last = F.greatest(F.floor((F.size(runs) - 1) / CHUNK), F.lit(0)).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last), lambda c: F.slice(runs, c * CHUNK + 1, F.lit(CHUNK))
        )

    def placed(parts: Column) -> Column:
        """(start, length, loss) of every run."""
        return F.flatten(
            F.zip_with(
                parts,
                _starts(F.transform(parts, total)),
                lambda runs, first: F.zip_with(
                    runs,
                    _starts(lengths(runs)),
                    lambda r, start: F.struct(
                        (first + start).alias("start"),
                        r["length"].alias("length"),
                        r["loss"].alias("loss"),
                    ),
                ),
            )
        )

    def cut(wide: Column) -> Column:
        def text(r: Column) -> Column:
            # From one code point before: a text's own first one could be taken as a byte order mark.
            part = F.decode(F.substring(wide, 4 * r["start"] + 1, 4 * r["length"] + 4), "UTF-32")
            return unescape(F.substring(part, F.lit(2), r["length"]))

        runs = _let(_let(loss_runs, chunks), placed)
        return F.transform(F.filter(runs, lambda r: r["loss"]), text)

    return _let(F.encode(F.concat(F.lit("\n"), formatted), "UTF-32"), cut)


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what is read back from the formatted texts and their loss masks."""
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    trained = F.array_join(loss_texts(F.col("formatted"), F.col("loss_runs")), "")
    texts = read_back(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        said.alias("said"),
        trained.alias("trained"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return texts.select(
        "conv_id",
        "n_turns",
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        "formatted_chars",
    )
