"""Chat formatting: records of any known layout become canonical turns, then one marked-up text.

A record is a JSON object. The set of its nested field paths (``messages[].role``) is hashed; the
fingerprint selects a declarative mapping, which says where roles and texts are. A new layout needs
a new entry in ``MAPPINGS``, no code. Turns are written by a template that marks each turn and
escapes, reversibly, every string in a text that could be read as a mark; the assistant's texts are
under the loss mask, given as ranges of code points.

Defined results: a record whose fingerprint is unknown, or that is NULL or no JSON object, keeps its
row, with NULL layout and NULL turns; a NULL text or role is an empty one; a record without turns
formats to an empty text. Turns keep their order; equal turns stay.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_pulse.llm.shared import nullable

# each: path of a list, with the fields of role and text; turns: (role, field) in order, "?" if it may lack
MAPPINGS: dict[str, dict[str, Any]] = {
    "messages": {"each": "messages", "role": "role", "text": "content"},
    "conversations": {"each": "conversations", "role": "from", "text": "value",
                      "roles": {"human": "user", "gpt": "assistant"}},
    "prompt_response": {"turns": [("system", "system?"), ("user", "prompt"), ("assistant", "response")]},
    "prompt_completion": {"turns": [("user", "prompt"), ("assistant", "completion")]},
    "instruction": {"turns": [("system", "instruction"), ("user", "input?"), ("assistant", "output")]},
    "question_answer": {"turns": [("user", "data.question"), ("assistant", "data.answer")]},
}
ASSISTANT = "assistant"
OPEN, CLOSE = "<turn>", "</turn>\n"
_TURN = re.compile(r"<turn>([^\n<]*)\n([^<]*)</turn>\n")
_ESCAPES = {"\\": "\\\\", "<": "\\l", "\n": "\\n"}
_PLAIN = {v[1]: k for k, v in _ESCAPES.items()}


def field_paths(value: Any, path: str = "") -> set[str]:
    """Paths of all fields below a JSON value; the elements of a list share one path."""
    if isinstance(value, dict):
        names = {f"{path}.{k}" if path else k: v for k, v in value.items()}
        return set(names).union(*(field_paths(v, p) for p, v in names.items()))
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{path}[]") for v in value))
    return set()


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def layouts(mappings: dict[str, dict[str, Any]]) -> dict[str, str]:
    """Fingerprint of every shape that a mapping covers, and the mapping's name."""
    out = {}
    for name, mapping in mappings.items():
        if "each" in mapping:
            each = mapping["each"]
            shapes = [{each}, {each, f"{each}[].{mapping['role']}", f"{each}[].{mapping['text']}"}]
        else:
            fields = [field for _, field in mapping["turns"]]
            optional = [f.rstrip("?") for f in fields if f.endswith("?")]
            needed = [f for f in fields if not f.endswith("?")]
            shapes = [{*needed, *some} for n in range(len(optional) + 1) for some in itertools.combinations(optional, n)]
        for shape in shapes:
            parents = {f.rpartition(".")[0] for f in shape if "." in f and "[]" not in f}
            out[fingerprint(shape | parents)] = name
    return out


def _at(record: Any, path: str) -> Any:
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def turns_of(record: dict, mapping: dict[str, Any]) -> list[tuple[str, str]]:
    if "each" in mapping:
        names = mapping.get("roles", {})
        items = _at(record, mapping["each"]) or []
        raw = [(item.get(mapping["role"]), item.get(mapping["text"])) for item in items]
        raw = [(names.get(role, role), text) for role, text in raw]
    else:
        fields = [(role, f.rstrip("?"), f.endswith("?")) for role, f in mapping["turns"]]
        raw = [(role, _at(record, f)) for role, f, optional in fields if not optional or f in record]
    return [(_text(role), _text(text)) for role, text in raw]


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def escape(text: str, more: str = "") -> str:
    text = text.replace("\\", _ESCAPES["\\"]).replace("<", _ESCAPES["<"])
    return text.replace("\n", _ESCAPES["\n"]) if more else text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the ranges of code points under the loss mask."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role, 'role')}\n", escape(text)
        if role == ASSISTANT:
            mask.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), mask


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns that a formatted text was made from."""
    turns, at = [], 0
    for match in _TURN.finditer(formatted):
        if match.start() != at:
            break
        turns.append((unescape(match[1]), unescape(match[2])))
        at = match.end()
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return turns


_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_MASK = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def canonical(records: DataFrame, record_id: str, record: str = "record",
              mappings: dict[str, dict[str, Any]] | None = None) -> DataFrame:
    """id, layout and canonical turns of every record."""
    mappings = MAPPINGS if mappings is None else mappings
    known = layouts(mappings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, turns = [], []
            for raw in batch.column(1).to_pylist():
                name = None
                try:
                    value = json.loads(raw) if raw is not None else None
                    name = known.get(fingerprint(field_paths(value))) if isinstance(value, dict) else None
                except ValueError:
                    pass
                names.append(name)
                turns.append(None if name is None else [
                    {"role": r, "text": t} for r, t in turns_of(value, mappings[name])])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(turns, _TURNS)], ["kept", "layout", "turns"])

    pairs = records.select(F.struct(record_id).alias("kept"), F.col(record).alias("r"))
    schema = pairs.select("kept", F.lit("").alias("layout"), F.array(F.struct(
        F.lit("").alias("role"), F.lit("").alias("text"))).alias("turns")).schema
    return pairs.mapInArrow(run, nullable(schema)).select("kept.*", "layout", "turns")


def formatted(canonical_turns: DataFrame, record_id: str) -> DataFrame:
    """id, formatted text and loss mask."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, masks = [], []
            for turns in batch.column(1).to_pylist():
                text, mask = (None, None) if turns is None else render([(t["role"], t["text"]) for t in turns])
                texts.append(text)
                masks.append(None if mask is None else [{"start": a, "end": b} for a, b in mask])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(masks, _MASK)], ["kept", "formatted", "loss_mask"])

    pairs = canonical_turns.select(F.struct(record_id).alias("kept"), "turns")
    schema = pairs.select("kept", F.lit("").alias("formatted"), F.array(F.struct(
        F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))).alias("loss_mask")).schema
    return pairs.mapInArrow(run, nullable(schema)).select("kept.*", "formatted", "loss_mask")


def digests(formatted_texts: DataFrame, record_id: str) -> DataFrame:
    """Counts and digests of the turns and of the masked texts, read back from the formatted texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for text, mask in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if text is None:
                    row = (None,) * 5
                else:
                    turns = parse(text)
                    loss = "".join(unescape(text[m["start"] : m["end"]]) for m in mask)
                    row = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                           len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text))
                for column, value in zip(out, row):
                    column.append(value)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))],
                ["kept", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    pairs = formatted_texts.select(F.struct(record_id).alias("kept"), "formatted", "loss_mask")
    long, text = F.lit(0).cast("long"), F.lit("")
    schema = pairs.select("kept", long.alias("n_turns"), text.alias("turns_sha256"), long.alias("loss_chars"),
                          text.alias("loss_sha256"), long.alias("formatted_chars")).schema
    return pairs.mapInArrow(run, nullable(schema)).select("kept.*", *schema.names[1:])


def as_records(turn_rows: DataFrame) -> DataFrame:
    """conv_id and one JSON record of each conversation, in the layout that its roles allow.

    All rows of a conversation meet in one row, as they do in the formatted text.
    """
    rows = turn_rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    roles = F.transform("t", lambda t: t["role"])
    text = lambda k: F.get(F.col("t"), k)["text"]

    def are(*names: str) -> Column:
        return roles == F.array(*map(F.lit, names))

    return turns.select("conv_id", F.when(are("user", "assistant"), F.to_json(F.struct(
        text(0).alias("prompt"), text(1).alias("response")))).when(are("system", "user", "assistant"), F.to_json(F.struct(
            text(0).alias("instruction"), text(1).alias("input"), text(2).alias("output")))).otherwise(
        F.to_json(F.struct(F.transform("t", lambda t: F.struct(
            t["role"].alias("role"), t["text"].alias("content"))).alias("messages")))).alias("record"))
