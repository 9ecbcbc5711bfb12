"""Chat formatting from an event log: deltas, edits and regenerations fold into final messages.

Event log: conv_id, turn (place of the message), step (order inside it), message (its id), kind, role,
text. Kinds: ``open`` names the role, ``delta`` appends text, ``edit`` replaces what is there,
``regenerate`` discards it. The order in which events are stored means nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import small_batches

START = "<|im_start|>"
END = "<|im_end|>\n"
# Messages joined by one task in the first of two rounds, so that a long conversation is not one task's work.
CHUNK = 256

PART = "order_key long, text string, starts array<long>, lengths array<long>"
CHATS = "conv_id long, formatted string, loss_starts array<long>, loss_lengths array<long>"


def escaped(text: Column, line_breaks: bool = False) -> Column:
    """No ``<|`` is left, so no text can forge a mark; roles also lose their line breaks."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if line_breaks else out


def unescaped(text: str, line_breaks: bool = False) -> str:
    if "\\" not in text:
        return text
    return re.sub(r"\\(.)", lambda m: "\n" if line_breaks and m[1] == "n" else m[1], text, flags=re.S)


def final_messages(log: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, message, role, text.

    What precedes the last edit or regeneration of a message is gone; the edit's text and all later
    deltas remain. A null role or text counts as empty, a message without events of text is empty. Null
    conv_ids are one conversation, as in any grouping. Repeated events (same step and content) count
    once each time they are logged.
    """
    events = log.groupBy("conv_id", "turn", "message").agg(
        F.sort_array(F.collect_list(F.struct(
            "step", "kind", F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text")))).alias("events"))
    e = F.col("events")
    resets = F.transform(
        e, lambda x, i: F.when(x["kind"].isin("edit", "regenerate"), i).otherwise(-1))
    last = F.greatest(F.array_max(resets), F.lit(0))
    kept = F.filter(
        F.slice(e, last + 1, F.size(e)), lambda x: x["kind"].isin("edit", "delta"))
    opened = F.filter(e, lambda x: x["kind"] == "open")
    return events.select(
        "conv_id", "turn", "message",
        F.coalesce(F.get(opened, 0)["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(kept, lambda x: x["text"]), "").alias("text"))


def _joined(parts: list) -> tuple[str, list[int], list[int]]:
    texts, starts, lengths, at = [], [], [], 0
    for part in parts:
        texts.append(part["text"])
        starts += [at + s for s in part["starts"]]
        lengths += list(part["lengths"])
        at += len(part["text"])
    return "".join(texts), starts, lengths


def _join_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with an ordered list of parts become rows with one text and the places of its loss spans."""
    spans = pa.list_(pa.int64())
    for batch in batches:
        joined = [_joined(parts) for parts in batch.column("parts").to_pylist()]
        made = [pa.array([x[0] for x in joined], pa.string()),
                *(pa.array([x[k] for x in joined], spans) for k in (1, 2))]
        keys = [name for name in batch.schema.names if name != "parts"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in keys), *made],
            [*keys, "formatted", "loss_starts", "loss_lengths"])


def formatted_chats(messages: DataFrame) -> DataFrame:
    """One row per conversation: its text and the spans (code points) the loss counts on.

    Turns run by ``turn`` (null first), ties by role, text and message id. Every assistant text is one
    span, without its marks. An empty table gives an empty table.
    """
    small_batches(messages.sparkSession)
    role, text = escaped(F.col("role"), True), escaped(F.col("text"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    spoken = F.col("role") == "assistant"
    none = F.array().cast("array<long>")
    parts = messages.select(
        "conv_id", "turn", "role", "message",
        F.floor(F.coalesce(F.col("turn"), F.lit(0)) / CHUNK).alias("chunk"),
        F.concat(head, text, F.lit(END)).alias("text"),
        F.when(spoken, F.array(F.length(head).cast("long"))).otherwise(none).alias("starts"),
        F.when(spoken, F.array(F.length(text).cast("long"))).otherwise(none).alias("lengths"))
    chunks = (
        parts.groupBy("conv_id", "chunk")
        .agg(F.sort_array(F.collect_list(F.struct(
            "turn", "role", "text", "message", "starts", "lengths"))).alias("parts"))
        .mapInArrow(_join_batches, CHATS.replace("formatted", "chunk long, formatted", 1)))
    return (
        chunks.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct(
            "chunk", F.col("formatted").alias("text"), F.col("loss_starts").alias("starts"),
            F.col("loss_lengths").alias("lengths")))).alias("parts"))
        .mapInArrow(_join_batches, CHATS))


def parsed(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation, texts as they were."""
    turns = []
    for block in formatted.split(START)[1:]:
        role, _, text = block.partition("\n")
        turns.append((unescaped(role, True), unescaped(text[:-len(END)])))
    return turns


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    for batch in batches:
        rows = []
        for text, starts, lengths in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
            turns = parsed(text)
            loss = "".join(unescaped(text[s:s + n]) for s, n in zip(starts, lengths))
            said = "".join(f"{role}\n{words}\n" for role, words in turns)
            rows.append((len(turns), hashlib.sha256(said.encode()).hexdigest(),
                         len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["conv_id", *names])


def chat_digest(chats: DataFrame) -> DataFrame:
    """What a reader of the formatted text finds: turns, loss text and sizes."""
    return chats.select("conv_id", "formatted", "loss_starts", "loss_lengths").mapInArrow(
        _digest_batches,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long")


def event_log(conversations: DataFrame) -> DataFrame:
    """Finished conversations as the log that would have led to them.

    Texts stream in two deltas; every third assistant turn is first drafted and regenerated, every
    third user turn is edited after its first half.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    left, right = F.substr(text, F.lit(1), half), F.substr(text, half + 1)
    none = F.lit(None).cast("string")

    def event(step: int, kind: str, said: Column = none, role: Column = none) -> Column:
        return F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"),
                        role.alias("role"), said.alias("text"))

    opened = event(0, "open", role=F.col("role"))
    third = F.pmod(F.coalesce(F.col("turn"), F.lit(0)), F.lit(3))
    events = (
        F.when((F.col("role") == "assistant") & (third == 1), F.array(
            opened, event(1, "delta", right), event(2, "regenerate"),
            event(3, "delta", left), event(4, "delta", right)))
        .when((F.col("role") == "user") & (third == 2), F.array(
            opened, event(1, "delta", left), event(2, "edit", text)))
        .otherwise(F.array(opened, event(1, "delta", left), event(2, "delta", right))))
    named = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text",
        F.monotonically_increasing_id().alias("message"))
    return named.select("conv_id", "turn", "message", F.explode(events).alias("event")).select(
        "conv_id", "turn", "message", "event.*")
