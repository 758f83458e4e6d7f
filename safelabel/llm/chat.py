"""Chat formatting: record layouts told apart by fingerprint, mapped to turns, templated with a loss mask.

A record is a JSON text. Its fingerprint is a hash of its sorted nested field paths, with
lists written as ``[]``, so two records of one layout have one fingerprint whatever they say.
A mapping is declared as data: the example paths that select it, and where its turns are.
``fingerprint`` and the mappings need no code for a new layout.

The template marks turns as ``<|im_start|>role\\ntext<|im_end|>\\n``. In texts and roles each
``<`` that begins a control string, with any backslashes after it, gets one backslash more,
which is taken off when reading back; line breaks in roles are written ``\\n``. The loss mask
is a list of spans (from, to) of the formatted string: the assistant texts.

Null texts are empty; a null role is empty. Turns are ordered by turn, ties by role and text;
a null turn comes first. Repeated rows are repeated turns. Rows without conv_id form a
conversation of their own, with a null id. A record that no mapping fits raises an error that
names its paths. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safelabel.llm.store import named, unnamed

START, END = "<|im_start|>", "<|im_end|>"
_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
FORMATTED = "conv_id long, formatted string, spans array<struct<low:int,high:int>>"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def paths(record: object, at: str = "") -> set[str]:
    """Nested field paths of a record; list items share one path."""
    if isinstance(record, dict):
        return {p for key, value in record.items() for p in paths(value, f"{at}.{key}" if at else key)} or {at}
    if isinstance(record, list):
        return {p for value in record for p in paths(value, f"{at}[]")} or {f"{at}[]"}
    return {at}


def fingerprint(names: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns: a list with role and text fields, or single fields with fixed roles."""

    needs: tuple[tuple[str, ...], ...]  # the sets of paths that select it
    turns: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str], ...] = ()  # (role, field), in order; empty fields are left out but for the last
    roles: tuple[tuple[str, str], ...] = ()  # names of roles that are written otherwise

    def apply(self, record: dict) -> list[tuple[str, str]]:
        if self.fields:
            last = len(self.fields) - 1
            return [(role, record.get(f) or "") for k, (role, f) in enumerate(self.fields) if record.get(f) or k == last]
        names = dict(self.roles)
        return [(names.get(t.get(self.role), t.get(self.role)) or "", t.get(self.text) or "") for t in record.get(self.turns) or ()]


MAPPINGS = (
    Mapping((("messages[].role", "messages[].content"), ("messages[]",)), "messages", "role", "content"),
    Mapping((("conversations[].from", "conversations[].value"), ("conversations[]",)), "conversations", "from", "value",
            roles=(("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))),
    Mapping((("prompt", "response"),), fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping((("prompt", "completion"),), fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping((("instruction", "output"), ("instruction", "input", "output")),
            fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping((("system", "prompt", "response"),), fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
)


def registry(mappings: tuple[Mapping, ...] = MAPPINGS) -> dict[str, Mapping]:
    return {fingerprint(set(need)): m for m in mappings for need in m.needs}


def canonical(record: dict, known: dict[str, Mapping]) -> list[tuple[str, str]]:
    """Turns (role, text) of a record, by the mapping that its fingerprint selects."""
    names = paths(record)
    if (mark := fingerprint(names)) not in known:
        raise ValueError(f"no mapping for a record with the paths {sorted(names)}")
    return known[mark].apply(record)


def _safe(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def _plain(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def _safe_role(role: str) -> str:
    return _safe(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _plain_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], _plain(role))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted string, spans of assistant texts)."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{_safe_role(role)}\n", _safe(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(head + body + END + "\n")
        at += len(out[-1])
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns read back from a formatted string."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        turns.append((_plain_role(found[1]), _plain(found[2])))
        at = found.end()
    return turns


def learned(formatted: str, spans: list[tuple[int, int]]) -> str:
    """The text under the loss mask, without escapes."""
    return "".join(_plain(formatted[a:b]) for a, b in spans)


def _format(frames: Iterator[pd.DataFrame], mappings: tuple[Mapping, ...]) -> Iterator[pd.DataFrame]:
    known = registry(mappings)
    for frame in frames:
        made = [render(canonical(json.loads(r), known)) for r in frame["record"]]
        yield pd.DataFrame({
            "conv_id": frame["conv_id"], "formatted": [m[0] for m in made], "spans": [[{"low": a, "high": b} for a, b in m[1]] for m in made]})


def format_records(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """(conv_id, formatted, spans) of rows (conv_id, record: JSON), whatever known layout each has."""
    made = records.select(named("conv_id"), "record").mapInPandas(lambda frames: _format(frames, mappings), FORMATTED)
    return unnamed(made, "conv_id")


def _read_back(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for conv, formatted, spans in zip(frame["conv_id"], frame["formatted"], frame["spans"], strict=True):
            turns = parse(formatted)
            loss = learned(formatted, [(s["low"], s["high"]) for s in spans])
            whole = "".join(f"{role}\n{text}\n" for role, text in turns)
            sha = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (whole, loss)]
            out.append((conv, len(turns), sha[0], len(loss), sha[1], len(formatted)))
        yield pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of turns and of the text under the mask, from the formatted strings alone."""
    return unnamed(formatted.withColumn("conv_id", named("conv_id")).mapInPandas(_read_back, DIGEST), "conv_id")


def as_records(turns: DataFrame) -> DataFrame:
    """(conv_id, record) of turn rows (conv_id, turn, role, text).

    Two turns of a user and an assistant are written as prompt and response, three with a
    system turn first likewise, and all else as a list of messages. Turns are gathered by a
    combined aggregate: a conversation is one value, so it must fit a task, and its rows
    meet there already gathered.
    """
    item = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    grouped = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(item)).alias("t"))
    roles = F.concat_ws(" ", F.transform("t", lambda x: x["role"]))
    text = lambda k: F.col("t")[k]["content"]
    messages = F.to_json(F.struct(F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages")))
    pair = F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response")))
    triple = F.to_json(F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("response")))
    filled = F.forall("t", lambda x: x["content"] != "")
    return grouped.select(
        "conv_id", F.when((roles == "user assistant") & (F.size("t") == 2) & filled, pair)
        .when((roles == "system user assistant") & (F.size("t") == 3) & filled, triple).otherwise(messages).alias("record"))
