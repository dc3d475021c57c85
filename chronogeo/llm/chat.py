"""Chat formatting: layouts told apart by a fingerprint of their field paths, mapped to turns, written as one template.

A record is a JSON object. The set of its nested field paths is hashed; the hash picks a declarative mapping from a table.
Records of an unknown layout keep a row with their fingerprint instead of turns, so nothing is lost in silence.

Template: each turn is `<turn ROLE>text</turn>` and a newline. A backslash in a text is doubled and one is put before
every `<turn` and `</turn`, so the text can't open or close a turn and comes back exactly.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN = "conv_id long, turn long, role string, text string"
_CONTROL = re.compile(r"\\|<(?=/?turn)")
_ROLE = re.compile(r"[\\<>]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_FORMATTED = re.compile(r"<turn ((?:[^\\>]|\\.)*)>((?:[^\\<]+|\\.|<(?!/?turn))*)</turn>\n", re.DOTALL)

# Layouts by their field paths. `each` is a list of turns, `turns` are (role, field) pairs of one record,
# `one` is a record that is itself a turn. `roles` are other names that a layout has for roles; else they stay as they are.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = [
    {"paths": ["role", "text"], "optional": ["conv_id", "turn", "weight"], "one": ("role", "text")},
    {"paths": ["role", "content"], "optional": ["id", "turn", "weight"], "one": ("role", "content")},
    {"paths": ["messages[].role", "messages[].content"], "optional": ["id", "source"], "each": ("messages", "role", "content")},
    {"paths": ["conversations[].from", "conversations[].value"], "optional": ["id", "source"], "each": ("conversations", "from", "value"), "roles": ROLES},
    {"paths": ["prompt", "response"], "optional": ["system"], "turns": [("system", "system"), ("user", "prompt"), ("assistant", "response")]},
    {"paths": ["prompt", "completion"], "optional": ["system"], "turns": [("system", "system"), ("user", "prompt"), ("assistant", "completion")]},
    {"paths": ["instruction", "output"], "optional": ["input", "system"],
     "turns": [("system", "system"), ("user", "instruction+input"), ("assistant", "output")]},
    {"paths": ["question", "answer"], "optional": ["context"], "turns": [("user", "context+question"), ("assistant", "answer")]},
]


def field_paths(value, at: str = "") -> set[str]:
    """Paths of the leaves of a record: a.b for fields, a[] for the elements of a list."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items())) if value else {at}
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{at}[]") for v in value)) if value else {f"{at}[]"}
    return {at}


def fingerprint(paths: set[str]) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


def mappings(layouts: list[dict]) -> dict[str, dict]:
    """Mapping by fingerprint: each layout with every choice of its optional fields."""
    table = {}
    for layout in layouts:
        for k in range(1 << len(layout["optional"])):
            extra = {f for i, f in enumerate(layout["optional"]) if k >> i & 1}
            table[fingerprint({*layout["paths"], *extra})] = layout
        if "each" in layout:
            table[fingerprint({f"{layout['each'][0]}[]"})] = layout
    return table


def turns_of(record: dict, layout: dict) -> list[tuple[str, str]]:
    if "one" in layout:
        role, text = (record.get(k) for k in layout["one"])
        return [(role, text)]
    if "each" in layout:
        name, role, text = layout["each"]
        return [(x.get(role), x.get(text)) for x in record[name]]
    out = []
    for role, fields in layout["turns"]:
        values = [record[f] for f in fields.split("+") if record.get(f)]
        if values or role != "system":
            out.append((role, "\n\n".join(map(str, values))))
    return out


def _canonical_batches(layouts: list[dict]):
    table = mappings(layouts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"conv_id": [], "turn": [], "role": [], "text": [], "unknown": []}
            for conv, first, raw in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    record = json.loads(raw) if raw is not None else None
                except ValueError:
                    record = None
                print_ = fingerprint(field_paths(record)) if isinstance(record, dict) else "no record"
                layout = table.get(print_)
                found = [(None, None)] if layout is None else turns_of(record, layout)
                for i, (role, text) in enumerate(found):
                    out["conv_id"].append(conv)
                    out["turn"].append(first if "one" in (layout or {}) or layout is None else (first or 0) + i)
                    out["role"].append(layout.get("roles", {}).get(role, role) if layout else None)
                    out["text"].append(None if layout is None else "" if text is None else str(text).encode("utf-8", "replace").decode())
                    out["unknown"].append(None if layout else print_)
            yield pa.RecordBatch.from_pydict({
                "conv_id": pa.array(out["conv_id"], pa.int64()), "turn": pa.array(out["turn"], pa.int64()),
                **{k: pa.array(out[k], pa.string()) for k in ("role", "text", "unknown")}})

    return run


def canonical_turns(records: DataFrame, layouts: list[dict] | None = None) -> DataFrame:
    """(conv_id, turn, role, text, unknown) from (conv_id, turn, record): one row per turn.

    `record` is a JSON object; `turn` is the place of its first turn in the conversation. Null text is empty text; a null
    role stays.
    Records that can't be read or have no known layout give one row with their fingerprint in `unknown`.
    """
    return records.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("record").cast("string")).mapInArrow(
        _canonical_batches(layouts or LAYOUTS), f"{TURN}, unknown string")


def format_turn(role: str | None, text: str) -> tuple[str, int, int]:
    """The turn in the template, and where its text stands in it."""
    head = "<turn " + _ROLE.sub(r"\\\g<0>", role or "") + ">"
    body = _CONTROL.sub(r"\\\g<0>", text)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


def _in_order(turns: DataFrame, *order: str) -> DataFrame:
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def _format_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, number, at = object(), 0, 0
    for batch in batches:
        out = []
        for own, _, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if own != conv:
                conv, number, at = own, 0, 0
            formatted, a, b = format_turn(role, text or "")
            loss = role == "assistant"
            out.append((own, number, formatted, at + a if loss else None, at + b if loss else None))
            number, at = number + 1, at + len(formatted)
        if out:
            columns = list(zip(*out))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "part", "formatted", "loss_from", "loss_to"])


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, part, formatted, loss_from, loss_to): the formatted conversation in parts, one per turn.

    The parts of a conversation, in order, are its text; loss_from and loss_to are code points in that text, for
    assistants only. Turns are ordered by turn, then role and text; nulls come first. Null ids are one conversation. A
    conversation is streamed through its task turn by turn and never held as a whole.
    """
    return _in_order(turns.select("conv_id", "turn", "role", "text"), "turn", "role", "text").mapInArrow(
        _format_batches, "conv_id long, part long, formatted string, loss_from long, loss_to long")


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    conv, open_, done = None, False, []
    n = loss = chars = 0
    turns = masked = hashlib.sha256()

    def close() -> None:
        done.append((conv, n, turns.hexdigest(), loss, masked.hexdigest(), chars))

    for batch in batches:
        for own, _, formatted, a, b in zip(*(c.to_pylist() for c in batch.columns)):
            if not open_ or own != conv:
                if open_:
                    close()
                conv, open_, n, loss, chars = own, True, 0, 0, 0
                turns, masked = hashlib.sha256(), hashlib.sha256()
            at = 0
            while at < len(formatted):
                found = _FORMATTED.match(formatted, at)
                if not found:
                    raise ValueError(f"conversation {own}: no turn at {at}")
                role, text = (_ESCAPED.sub(r"\1", found[k]) for k in (1, 2))
                turns.update(f"{role}\n{text}\n".encode())
                n, at = n + 1, found.end()
            if a is not None:
                text = _ESCAPED.sub(r"\1", formatted[a - chars:b - chars])
                masked.update(text.encode())
                loss += len(text)
            chars += len(formatted)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
            done = []
    if open_:
        close()
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) parsed from formatted parts."""
    return _in_order(formatted.select("conv_id", "part", "formatted", "loss_from", "loss_to"), "part").mapInArrow(
        _read_batches, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
