"""Chat formatting by event sourcing: a log of events is folded into final messages, which are rendered with a template.

The log has one row per event: conv_id, message, seq, kind, role, text, and part where one sequence number has several. Kinds: ``start`` opens a message, ``delta`` appends
to it, ``edit`` replaces its text, ``regenerate`` empties it so that later deltas write it anew, ``delete`` takes it away.
Logs are partitioned by conversation and message and sorted by sequence; a task folds one message after the other and
holds one message only, so a conversation may be of any length. Rendering gives one segment per message; a conversation's
formatted text is its segments in order.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

TURN, BODY, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: Applied in this order; undone in the opposite one. A marker cannot occur in an escaped text, as it has no "<" or "[".
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"))
MESSAGE = "conv_id long, message string, place long, role string, text string"


def escape(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: str) -> str:
    for plain, safe in reversed(ESCAPES):
        text = text.replace(safe, plain)
    return text


def _fold(batches):
    """Final messages of events that come message by message, in order."""
    key, place, role, parts, live, out = None, None, None, [], False, []

    def close():
        if live:
            out.append((*key, place, role, "".join(parts)))

    def flush():
        rows = list(zip(*out)) if out else [()] * 5
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()))],
            names=["conv_id", "message", "place", "role", "text"])

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "message", "seq", "kind", "role", "text"))
        for conv_id, message, seq, kind, said_by, text in zip(*columns):
            if key != (conv_id, message):
                close()
                key, place, role, parts, live = (conv_id, message), seq, said_by, [], True
            if kind == "delete":
                live, parts = False, []
            elif kind == "edit":
                parts, live = [text or ""], True
            elif kind == "regenerate":
                parts, live = [], True
            else:
                parts.append(text or "")
                role = said_by if role is None else role
        if len(out) >= 1000:
            yield flush()
    close()
    yield flush()


def fold(log: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, place, role, text) of a log.

    ``place`` is the sequence number of a message's first event; events without one come last. Events of equal sequence go by
    ``part`` (if the log has it), kind and text, repeated ones count again. Null texts are empty; unknown kinds append. Null ids form a conversation.
    """
    first = F.when(F.col("kind") == "start", 0).otherwise(1)
    rows = log.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("message").cast("string").alias("message"),
                      F.col("seq").cast("long").alias("seq"), "kind", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
                      (F.col("part") if "part" in log.columns else F.lit(0)).cast("long").alias("part"))
    rows = rows.withColumn("first", first).repartition("conv_id", "message")
    rows = rows.sortWithinPartitions("conv_id", "message", F.col("seq").asc_nulls_last(), "part", "first", "kind", "text")
    return rows.mapInArrow(_fold, MESSAGE)


def render(messages: DataFrame) -> DataFrame:
    """conv_id, place, segment, loss_start and loss_length (characters of the segment that count for the loss; assistants only).

    Roles and texts are escaped, so that markers and control strings of other templates inside them stay text.
    """
    text, role = escape(F.coalesce("text", F.lit(""))), escape(F.coalesce("role", F.lit("")))
    segment = F.concat(F.lit(TURN), role, F.lit(BODY), text, F.lit(END))
    spoken = F.col("role") == "assistant"
    start = F.length(role) + len(TURN) + len(BODY)
    return messages.select("conv_id", "place", segment.alias("segment"),
                           F.when(spoken, start).otherwise(0).cast("long").alias("loss_start"),
                           F.when(spoken, F.length(text)).otherwise(0).cast("long").alias("loss_length"))


def _read_back(batches):
    """Digests per conversation of segments that come conversation by conversation, in order."""
    current, out = None, []

    def begin(conv_id):
        return {"id": conv_id, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}

    def close(x):
        out.append((x["id"], x["n"], x["turns"].hexdigest(), x["loss_chars"], x["loss"].hexdigest(), x["chars"]))

    def flush():
        rows = list(zip(*out)) if out else [()] * 6
        out.clear()
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)],
                                          names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_length"))
        for conv_id, segment, start, length in zip(*columns):
            if current is None or current["id"] != conv_id:
                if current is not None:
                    close(current)
                current = begin(conv_id)
            at = 0
            while at < len(segment):
                body = segment.index(BODY, at)
                end = segment.index(END, body)
                role, text = segment[at + len(TURN) : body], segment[body + len(BODY) : end]
                current["n"] += 1
                current["turns"].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                at = end + len(END)
            said = unescape(segment[start : start + length])
            current["loss"].update(said.encode())
            current["loss_chars"] += len(said)
            current["chars"] += len(segment)
        if len(out) >= 1000:
            yield flush()
    if current is not None:
        close(current)
    yield flush()


def read_back(segments: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, parsed from the formatted text alone.

    A conversation's segments are read as a stream in order of place; those of equal place in order of their text.
    """
    rows = segments.repartition("conv_id").sortWithinPartitions("conv_id", F.col("place").asc_nulls_last(), "segment")
    return rows.mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def log_of_turns(turns: DataFrame, piece: int = 256) -> DataFrame:
    """The log of conversations that are given as rows (conv_id, turn, role, text): every text arrives in deltas of ``piece``
    characters, told apart by ``part``. Every row is a message of its own, so repeated rows and turns stay; rows without a turn come last."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    last = F.ceil(F.length("text") / piece).cast("int")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"), text.alias("text"))
    rows = rows.withColumn("message", F.monotonically_increasing_id().cast("string")).withColumn("part", F.explode(F.sequence(F.lit(0), last)))
    delta = F.when(F.col("part") > 0, F.substring("text", (F.col("part") - 1) * piece + 1, F.lit(piece))).otherwise("")
    kind = F.when(F.col("part") > 0, "delta").otherwise("start")
    return rows.select("conv_id", "message", F.col("turn").alias("seq"), kind.alias("kind"), "role", delta.alias("text"), "part")
