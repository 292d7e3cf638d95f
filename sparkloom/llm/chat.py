r"""Chat formatting: schema fingerprints select declarative mappings into canonical turns.

A record is JSON text. Its schema fingerprint is a hash of its sorted nested field paths (array
elements as `[]`; null and empty values, side data and further fields of a turn left out). Each known fingerprint names a layout, a
declarative list of where turns and roles are; the layout turns the record into canonical
(role, text) turns, which the template then writes:

    <s>[INST] role [/INST] text </s>

Control strings inside roles and texts are escaped by a backslash after their first character, and
backslashes by another one, so that reading back is exact. The loss mask is a list of [start, end)
spans of the formatted text, one for each assistant text.

Defined results: a null text or role is empty; a record that isn't JSON, or whose fingerprint no
layout claims, has a null formatted text and the layout `unmapped`; turns with equal place are put in
order of role, then text; a turn's role that ROLES knows by another name (`Human`, `gpt`) comes out by its
canonical one, all others as given; a conversation without turns doesn't occur in a table of turns; records are
formatted one by one, so repeated records agree; an empty table gives an empty result. Input columns
named like a result are replaced, all others pass through.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fields, given_back, name_of, row_of

# The control strings of the template.
BEGIN, OPEN, SHUT, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = re.compile(r"<(?=/?s>)|\[(?=/?INST\])|\\")
ESCAPED = re.compile(r"\\(.)", re.S)
TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\] (.*?) </s>", re.S)

#: Role names of other layouts, and the canonical ones.
ROLES = {"human": "user", "user": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant", "assistant": "assistant", "system": "system"}

#: Layouts. `list`: path of an array of turns with its role and text fields. `turns`: (role, paths of
#: the texts joined by a blank line). Paths in `also` may be there too, and are not turns.
LAYOUTS = {
    "messages": {"list": ("messages", "role", "content"), "before": [("system", ("system",))]},
    "conversations": {"list": ("conversations", "from", "value"), "before": [("system", ("system",))]},
    "dialog": {"list": ("dialog", "speaker", "text"), "before": [("system", ("system",))]},
    "instruction": {"turns": [("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))], "needs": {"instruction"}},
    "instruction_response": {"turns": [("system", ("system",)), ("user", ("instruction", "context")), ("assistant", ("response",))], "needs": {"instruction", "response"}},
    "prompt_completion": {"turns": [("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))], "needs": {"prompt"}},
    "prompt_response": {"turns": [("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))], "needs": {"prompt", "response"}},
    "question_answer": {"turns": [("system", ("system",)), ("user", ("question",)), ("assistant", ("answer",))], "needs": {"question"}},
}
#: Fields that a record of any layout may carry beside its turns, whatever is in them.
EXTRA = ("id", "source", "metadata")


def paths(value, at: str = "") -> set[str]:
    """Nested field paths of the values that aren't null or empty containers."""
    if isinstance(value, dict):
        return {at + "{}"} if not at else set().union(*(paths(v, f"{at}.{k}" if at != "$" else k) for k, v in value.items())) if value else set()
    if isinstance(value, list):
        return set().union(*(paths(v, at + "[]") for v in value)) if value else set()
    return set() if value is None else {at}


def telling(found: set[str], layouts: dict = LAYOUTS) -> set[str]:
    """The paths that tell layouts apart: none below an EXTRA field, nor those of a turn that hold neither its role nor its text."""
    out = {p for p in found if re.split(r"[.\[]", p, maxsplit=1)[0] not in EXTRA}
    for layout in layouts.values():
        if "list" in layout:
            array, *needed = layout["list"]
            out = {p for p in out if not p.startswith(f"{array}[].") or re.split(r"[.\[]", p[len(array) + 3 :], maxsplit=1)[0] in needed}
    return out


def fingerprint(found: set[str]) -> str:
    return hashlib.md5("\n".join(sorted(found)).encode()).hexdigest()


def _subsets(fields):
    return itertools.chain.from_iterable(itertools.combinations(fields, n) for n in range(len(fields) + 1))


def known_fingerprints(layouts: dict = LAYOUTS) -> dict[str, str]:
    """Fingerprint to layout, for each set of fields that a layout allows; earlier layouts win."""
    out: dict[str, str] = {}
    for name, layout in layouts.items():
        if "list" in layout:
            array, role, text = layout["list"]
            turn_sets = [{f"{array}[].{text}"}, {f"{array}[].{role}"}, {f"{array}[].{role}", f"{array}[].{text}"}]
            optional = [p for _, ps in layout["before"] for p in ps]
        else:
            optional = [p for _, ps in layout["turns"] for p in ps if p not in layout["needs"]]
            turn_sets = [set(layout["needs"])]
        for base, more in itertools.product(turn_sets, _subsets(optional)):
            out.setdefault(fingerprint({*base, *more}), name)
    return out


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)


def canonical_turns(record: dict, layout: dict) -> list[tuple[str, str]]:
    fixed = layout.get("before", []) if "list" in layout else layout["turns"]
    turns = [(role, "\n\n".join(_text(record[p]) for p in ps if record.get(p) is not None)) for role, ps in fixed if any(record.get(p) is not None for p in ps)]
    if "list" in layout:
        array, role, text = layout["list"]
        for t in record[array]:
            name = _text((t or {}).get(role))
            turns.append((ROLES.get(name.lower(), name), _text((t or {}).get(text))))
    return turns


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    r"""The inverse of escape: a backslash after \, < or [ goes."""
    return re.sub(r"([\\<\[])\\", r"\1", text)


def template(turns: list[tuple[str, str]]) -> tuple[str, list[int]]:
    """The formatted text, and the loss spans as start, end, start, end."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{BEGIN}{OPEN} {escape(role)} {SHUT} ", escape(text)
        parts += [head, body, f" {END}"]
        if role == "assistant":
            spans += [at + len(head), at + len(head) + len(body)]
        at += len(head) + len(body) + 1 + len(END)
    return "".join(parts), spans


def read_back(formatted: str, spans: list[int]) -> tuple[list[tuple[str, str]], list[str]]:
    """(turns, texts under the loss mask), from the output alone."""
    turns = [(unescape(m[1]), unescape(m[2])) for m in TURN.finditer(formatted)]
    return turns, [unescape(formatted[a:b]) for a, b in zip(spans[::2], spans[1::2], strict=True)]


def records(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turn rows gathered into one record a conversation, of the `messages` layout: (conv_id, record)."""
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("content"))
    whole = F.transform(F.sort_array(F.collect_list(one)), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    return rows.groupBy(F.col(conversation).alias("conv_id")).agg(F.to_json(F.struct(whole.alias("messages"))).alias("record"))


def format_chat(df: DataFrame, record: str = "record", layouts: dict = LAYOUTS) -> DataFrame:
    """df with layout, fingerprint, formatted and loss_spans."""
    names = ("layout", "fingerprint", "formatted", "loss_spans")
    passed = [c for c in df.columns if c not in names or c == record]
    df = df.select(name_of(record).alias("_record"), row_of(passed).alias("_row"))
    schema = T.StructType([df.schema["_row"], *[T.StructField(c, T.StringType()) for c in names[:3]], T.StructField("loss_spans", T.ArrayType(T.LongType()))])
    known = known_fingerprints(layouts)

    def one(value):
        try:
            data = json.loads(value) if value is not None else None
        except ValueError:
            data = None
        if not isinstance(data, dict):
            return "unmapped", None, None, None
        mark = fingerprint(telling(paths(data, "$"), layouts))
        if mark not in known:
            return "unmapped", mark, None, None
        return known[mark], mark, *template(canonical_turns(data, layouts[known[mark]]))

    def run(batches):
        for batch in batches:
            got = [one(x.as_py()) for x in batch.column(0)]
            arrays = [pa.array([g[k] for g in got], pa.list_(pa.int64()) if k == 3 else pa.string()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(1), *arrays], names=["_row", *names])

    return df.mapInArrow(given_back(run), schema).select(*fields("_row", passed), *names)


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id and what reading back the formatted text gives; see op8."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches):
        for batch in batches:
            rows = []
            for conv_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans")), strict=True):
                turns, loss = read_back(text or "", spans or [])
                said, lost = "".join(f"{r}\n{t}\n" for r, t in turns), "".join(loss)
                rows.append((conv_id, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(lost), hashlib.sha256(lost.encode()).hexdigest(), len(text or "")))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in schema.split(", ")])

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(given_back(run), schema)
