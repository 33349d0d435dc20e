"""Chat formatting: a state machine over roles and a declarative template.

The template gives, for every role, the control strings around a text and whether the text
counts for the loss. Control strings inside texts are escaped by a backslash, as is the
backslash itself, so the formatted conversation can be read back without loss.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query, table

START = "start"


@dataclass(frozen=True)
class Template:
    """``turns``: role to (before, after, loss). ``other`` frames any other role, named in place of {role}.

    ``order``: the roles that may follow each state; a state is the last role, or ``start``.
    ``last``: roles a conversation may end with.
    """

    turns: dict[str, tuple[str, str, bool]]
    other: tuple[str, str, str, bool]
    order: dict[str, tuple[str, ...]]
    last: tuple[str, ...]

    def controls(self) -> list[str]:
        marks = {m for before, after, _ in self.turns.values() for m in (before, after)} | set(self.other[:3])
        return sorted(marks, key=lambda m: (-len(m), m))


INSTRUCT = Template(
    turns={
        "system": ("<s>[SYS]", "[/SYS]", False),
        "user": ("[INST]", "[/INST]", False),
        "assistant": ("[OUT]", "</s>", True),
    },
    other=("[ROLE]", "[:]", "[/ROLE]", False),
    order={START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    last=("assistant",),
)


class Marker:
    """Escapes, formats and reads back by one template."""

    def __init__(self, template: Template):
        self.template = template
        any_control = "|".join(map(re.escape, template.controls()))
        self.plain = re.compile(rf"\\|{any_control}")
        self.escaped = re.compile(rf"\\(\\|{any_control})")
        self.mark = re.compile(rf"\\(?:\\|{any_control})|({any_control})")

    def escape(self, text: str) -> str:
        return self.plain.sub(lambda m: "\\" + m[0], text)

    def unescape(self, text: str) -> str:
        return self.escaped.sub(r"\1", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, counts for the loss) of one turn."""
        known = self.template.turns.get(role)
        if known:
            before, after, loss = known
        else:
            before, middle, after, loss = self.template.other
            before += self.escape(role) + middle
        return [(before, False), (self.escape(text), loss), (after, False)]

    def read(self, formatted: str) -> Iterator[tuple[str, str, bool]]:
        """(role, text, counts for the loss) of every turn of a formatted text."""
        opening = {before: (role, after, loss) for role, (before, after, loss) in self.template.turns.items()}
        start, middle, end, loss_of_other = self.template.other
        at, stop, role, loss = 0, None, None, False
        for m in self.mark.finditer(formatted):
            if not m[1]:
                continue
            if stop is None and m[1] in opening:
                role, stop, loss = opening[m[1]]
                at = m.end()
            elif stop is None and m[1] == start:
                role, stop, loss, at = None, middle, loss_of_other, m.end()
            elif m[1] == stop == middle and role is None:
                role, stop, at = self.unescape(formatted[at:m.start()]), end, m.end()
            elif m[1] == stop:
                yield role, self.unescape(formatted[at:m.start()]), loss
                stop = None
            else:
                raise ValueError(f"{m[1]} at {m.start()} has no place there")
        if stop is not None:
            raise ValueError("the last turn has no end")

    def step(self, state: str, role: str) -> str | None:
        """State after ``role``; None where the role may not follow."""
        return role if role in self.template.order.get(state, ()) else None


_SEGMENTS = ("conv_id long, turn long, seq long, valid boolean, "
             "segments array<struct<text: string, loss: boolean>>")


def format_turns(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per turn: its place ``seq``, its ``segments`` with loss flags, and ``valid``.

    Turns go by ``turn`` (nulls first), then role and text, so ties have one order;
    repeated rows are turns of their own. A null role or text is empty; null conv_ids are one
    conversation. ``valid`` is false from the first turn on whose role may not follow; the
    last turn is also checked for a role that may end. Nothing is left out for it.

    Conversations are dealt by id and streamed in order: memory holds one batch of turns,
    however long a conversation is. Other columns of ``turns`` are not read.
    """
    marker = Marker(template)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, seq, state, last = object(), 0, START, None
        for batch in chain(batches, [None]):
            out = [last] if last else []
            for conv_id, turn, role, text in (() if batch is None else batch.itertuples(index=False)):
                if conv_id != conv:
                    if last:
                        last["valid"] &= last_role in template.last
                    conv, seq, state = conv_id, 0, START
                state = state and marker.step(state, role)
                last_role, last = role, {
                    "conv_id": conv_id and int(conv_id), "turn": turn and int(turn), "seq": seq,
                    "valid": state is not None,
                    "segments": [{"text": t, "loss": loss} for t, loss in marker.segments(role, text)]}
                out.append(last)
                seq += 1
            if batch is not None:  # whether the last turn ends its conversation shows in the next batch
                out = out[:-1]
            elif last:
                last["valid"] &= last_role in template.last
            if out:
                yield pd.DataFrame(out, dtype=object).astype({"conv_id": "Int64", "turn": "Int64"})

    read = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = read.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    # As text, because pandas turns whole numbers beside nulls into floats.
    dealt = dealt.withColumns({c: F.col(c).cast("string") for c in ("conv_id", "turn")})
    return dealt.mapInPandas(walk, _SEGMENTS)


def read_back(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Per conversation what its formatted text says, read from the output of ``format_turns``.

    n_turns, turns_sha256 over role, newline, text, newline of each turn; loss_chars and
    loss_sha256 of the text under the loss mask, unescaped; formatted_chars; valid.
    """
    marker = Marker(template)

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv = None
        columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]

        def closed(c):
            return (c["id"], c["n"], c["turns"].hexdigest(), c["chars"], c["loss"].hexdigest(), c["all"], c["valid"])

        def frame(done):
            return pd.DataFrame(done, columns=columns, dtype=object).astype({"conv_id": "Int64"})

        for batch in batches:
            done = []
            for conv_id, _, seq, valid, segments in batch.itertuples(index=False):
                if seq == 0:
                    if conv:
                        done.append(closed(conv))
                    conv = {"id": conv_id and int(conv_id), "n": 0, "turns": hashlib.sha256(),
                            "chars": 0, "loss": hashlib.sha256(), "all": 0, "valid": True}
                text = "".join(s["text"] for s in segments)
                conv["all"] += len(text)
                conv["valid"] &= bool(valid)
                for role, said, _ in marker.read(text):
                    conv["n"] += 1
                    conv["turns"].update(f"{role}\n{said}\n".encode())
                for s in segments:
                    if s["loss"]:
                        said = marker.unescape(s["text"])
                        conv["chars"] += len(said)
                        conv["loss"].update(said.encode())
            if done:
                yield frame(done)
        if conv:
            yield frame([closed(conv)])

    ordered = formatted.select("conv_id", "turn", "seq", "valid", "segments").repartition(
        "conv_id").sortWithinPartitions("conv_id", "seq").withColumn("conv_id", F.col("conv_id").cast("string"))
    return ordered.mapInPandas(digest, (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean"))


_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS seq,
    lag(role, 1, 'start') OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
    len(regexp_replace(text, '(\\|<s>\[SYS\]|\[/SYS\]|\[INST\]|\[/INST\]|\[OUT\]|</s>|\[ROLE\]|\[:\]|\[/ROLE\])', '\\\1', 'g'))
    + CASE role WHEN 'system' THEN 14 WHEN 'user' THEN 13 WHEN 'assistant' THEN 9 ELSE 16 + len(role) END AS chars FROM t)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY seq)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY seq) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and((before, role) IN (('start', 'system'), ('start', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')))
    AND arg_max(role, seq) = 'assistant' AS valid
FROM f GROUP BY conv_id
"""


@query(_SQL)
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted text."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return read_back(format_turns(turns.unionByName(extra)))
