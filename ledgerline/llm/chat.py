"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string.  To
learn where a turn lands, successive prefixes of the conversation are rendered
and consecutive outputs compared: what is new behind the old output is the new
turn's span.  Rendering the same prefix with a probe as the last text shows
which part of the span is text and which is markup.  A template whose output
for a prefix is not kept in the next one rewrites history; the turns where that
happens are reported, and spans before them are taken from a comparison of the
rewritten output.

``MARKED`` is the template of the queries.  It escapes control strings inside
texts reversibly: a backslash is doubled, and one is put behind the first
character of a control string.

A conversation is streamed through its task in parts of ``part_turns`` turns,
each rendered after ``context`` turns that precede it, so that a conversation
with any number of turns needs the memory of one part.  A digest over a whole
conversation is sequential by definition; its turns pass one task, in order,
without being held.

Rows come by turn (nulls first), ties by role, then text; repeated rows are
turns of their own.  Null text or role counts as empty.  Rows with a null
conv_id form one conversation.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import ship

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# fixed values: strings that steer chat models
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
           "<|begin_of_text|>", "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def marked(turns: list[Turn]) -> str:
    """``<|im_start|>role, line end, text, <|im_end|>, line end`` for each turn."""
    role = lambda r: escape(r.replace("%", "%25").replace("\n", "%0A"))
    return "".join(f"<|im_start|>{role(r)}\n{escape(t)}<|im_end|>\n" for r, t in turns)


def parse_marked(output: str) -> list[Turn]:
    """The turns that ``marked`` has written."""
    return [(unescape(r).replace("%0A", "\n").replace("%25", "%"), unescape(t)) for r, t in _TURN.findall(output)]


@dataclass
class Located:
    output: str
    spans: list[tuple[int, int, int, int]] = field(default_factory=list)  # start, text start, text end, end
    rewrites: list[int] = field(default_factory=list)                     # turns that changed what was there


def _shared(a: str, b: str) -> int:
    return len(os.path.commonprefix((a, b)))


def locate(turns: list[Turn], render: Template) -> Located:
    """Render all prefixes of ``turns``; spans are offsets in the last output."""
    before = render([])
    found = Located(before)
    probe = ""
    for k, (role, text) in enumerate(turns):
        now = render(turns[:k + 1])
        # a closing string behind all turns moves on: what matters is the part before it
        kept = _shared(before, now)
        closing = len(before) - kept
        if closing and not (now.endswith(before[kept:]) and len(now) - closing >= kept):
            found.rewrites.append(k)
            found.spans = [s for s in found.spans if s[3] <= kept]
            found.spans += [(kept,) * 4] * (k - len(found.spans))
            closing = 0
        start, end = kept, len(now) - closing
        if not closing and found.spans:
            start = max(start, found.spans[-1][3])
        probed = render([*turns[:k], (role, probe)])
        at = probed.rfind(probe)
        tail = len(probed) - at - len(probe) if at >= 0 else 0
        if at >= 0 and probed[:at] == now[:at]:
            found.spans.append((min(start, at), at, len(now) - tail, end))
        else:  # the text changes what stands before it, or isn't shown
            found.spans.append((start, end, end, end))
        before = now
    found.output = before
    return found


PART = T.StructType([T.StructField("part", T.LongType()), T.StructField("formatted", T.StringType()),
                     T.StructField("text_spans", T.ArrayType(T.ArrayType(T.LongType()))),
                     T.StructField("loss_spans", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("rewrites", T.BooleanType())])


def format_conversations(rows: DataFrame, render: Template = marked, part_turns: int = 512, context: int = 8, loss_role: str = "assistant") -> DataFrame:
    """conv_id, part, formatted, text_spans, loss_spans, rewrites: one row for each part, a conversation's parts in order in one partition."""
    ship(rows.sparkSession)
    conv = T.StructField("conv_id", rows.schema["conv_id"].dataType)

    def one_part(turns: list[Turn], old: int, number: int) -> dict:
        found = locate(turns, render)
        at = found.spans[old][0] if old else 0
        own = found.spans[old:]
        loss = [[s[1] - at, s[2] - at] for s, (role, _) in zip(own, turns[old:]) if role == loss_role]
        return {"part": number, "formatted": found.output[at:], "text_spans": [[s[1] - at, s[2] - at] for s in own], "loss_spans": loss, "rewrites": bool(found.rewrites)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, made, now, turns, old, number = [], [], object(), [], 0, 0

        def flush() -> None:
            ids.append(now)
            made.append(one_part(turns, old, number))

        def out(kind) -> pa.RecordBatch:
            cols = {"conv_id": pa.array(ids, kind)} | {f.name: pa.array([x[f.name] for x in made], t) for f, t in zip(PART, ARROW)}
            ids.clear()
            made.clear()
            return pa.RecordBatch.from_pydict(cols)

        kind = None
        for b in batches:
            kind = b.column("conv_id").type
            for c, role, text in zip(*(b.column(x).to_pylist() for x in ("conv_id", "role", "text"))):
                if turns and c != now:
                    flush()
                    turns, old, number = [], 0, 0
                elif len(turns) - old >= part_turns:
                    flush()
                    turns, old, number = turns[-context:], context, number + 1
                now = c
                turns.append((role or "", text or ""))
            if len(made) > 256:
                yield out(kind)
        if turns:
            flush()
        if made:
            yield out(kind)

    ordered = rows.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, T.StructType([conv, *PART.fields]))


ARROW = (pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.list_(pa.int64())), pa.bool_())


def read_back(parts: DataFrame, parse: Callable[[str], list[Turn]] = parse_marked) -> DataFrame:
    """Digests of each conversation from its formatted parts alone; ``parts`` straight from format_conversations."""
    conv = T.StructField("conv_id", parts.schema["conv_id"].dataType)
    longs = ("n_turns", "loss_chars", "formatted_chars")
    schema = T.StructType([conv, T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
                           T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()), T.StructField("rewrites", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, state, made = None, None, []

        def close() -> None:
            if state:
                made.append(state | {"turns_sha256": state["turns_sha256"].hexdigest(), "loss_sha256": state["loss_sha256"].hexdigest()})

        def out() -> pa.RecordBatch:
            types = {"conv_id": kind, "rewrites": pa.bool_()} | {c: pa.int64() for c in longs}
            batch = pa.RecordBatch.from_pydict({f.name: pa.array([x[f.name] for x in made], types.get(f.name, pa.string())) for f in schema})
            made.clear()
            return batch

        for b in batches:
            kind = b.column("conv_id").type
            for c, part, text, loss, rewrites in zip(*(b.column(x).to_pylist() for x in ("conv_id", "part", "formatted", "loss_spans", "rewrites"))):
                if part == 0:
                    close()
                    state = {"conv_id": c, "rewrites": False, "turns_sha256": hashlib.sha256(), "loss_sha256": hashlib.sha256()} | dict.fromkeys(longs, 0)
                turns = parse(text)
                state["n_turns"] += len(turns)
                state["formatted_chars"] += len(text)
                state["rewrites"] |= rewrites
                for role, t in turns:
                    state["turns_sha256"].update(f"{role}\n{t}\n".encode())
                for start, end in loss:
                    plain = unescape(text[start:end])
                    state["loss_chars"] += len(plain)
                    state["loss_sha256"].update(plain.encode())
            if made:
                yield out()
        close()
        if made:
            yield out()

    return parts.mapInArrow(run, schema)


def with_control_conversation(rows: DataFrame) -> DataFrame:
    """``rows`` and conversation -7, whose texts are made of control strings."""
    said = "</s>[INST] ok [/INST]"
    more = rows.sparkSession.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").union(more)
