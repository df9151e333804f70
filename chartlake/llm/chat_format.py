"""Chat formatting: a finite-state machine over roles and a declarative template.

``Template`` gives the marks around role and text, the roles under the loss and
the allowed successions of roles.  Conversations are dealt by id and sorted by
turn; a task streams through its rows and keeps only the state of the current
conversation, so a conversation of any number of turns needs no memory.

Every turn becomes three segments: its head (mark, role, mark), its text and
its tail; only texts of the roles under the loss carry a true loss flag.
Control strings inside roles and texts are escaped reversibly: each of them
gets the escape character behind its first character, and escape characters
that were there before are doubled.

Defined results: null text and null role are empty; unknown roles are
formatted like others and are a violation; a null conversation id is a
conversation of its own; turns that tie are ordered by role, then text; null
turns come first; repeated rows are separate turns; an empty table gives no
rows.  Ids are integers, or texts that spell one; any other text id raises (ANSI casts).  Turns are alike.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlake.llm.common import col


@dataclass(frozen=True)
class Template:
    head: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    tail: str = "<|im_end|>\n"
    #: Other strings that a tokenizer may treat as control strings.
    controls: tuple[str, ...] = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    escape: str = "\\"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    #: role -> roles that may follow; None is the start.
    follows: dict = field(default_factory=lambda: {
        None: {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}})
    final: frozenset[str] = frozenset({"assistant"})

    def __post_init__(self):
        for x in (*self.marks, *self.controls):
            if len(x) < 2 or self.escape in x:
                raise ValueError(f"a control string needs two characters and no escape character: {x!r}")
        if len(self.escape) != 1:
            raise ValueError("the escape must be one character")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.head, self.middle, self.tail.rstrip("\n")

    def escaper(self):
        """Text -> text without control strings, and back."""
        strings = sorted({*self.marks, *self.controls})
        found = re.compile("|".join(f"{re.escape(x[0])}(?={re.escape(x[1:])})" for x in strings))
        own, doubled = self.escape, re.compile(re.escape(self.escape) + "(" + re.escape(self.escape) + "?)")
        return (lambda s: found.sub(lambda m: m[0] + own, s.replace(own, own + own))), (lambda s: doubled.sub(r"\1", s))


SEGMENTS = "conv_id long, turn long, segment int, kind string, text string, loss boolean, violation boolean"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, violations long")
_SEGMENTS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("segment", pa.int32()), ("kind", pa.string()),
                       ("text", pa.string()), ("loss", pa.bool_()), ("violation", pa.bool_())])
#: Characters of text in one batch of segments.
BATCH_CHARS = 1 << 22


def format_turns(conversations: DataFrame, template: Template = Template(), id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Segments in order, three a turn: (conv_id, turn, segment, kind, text,
    loss, violation).  The texts of a conversation's segments joined are its
    formatted form.  violation marks turns the machine does not allow after the
    turn before (and a last turn that may not end a conversation, on its tail)."""
    put, _ = template.escaper()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        chars = 0
        conv, state, held = object(), None, None
        for batch in batches:
            for own, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != conv:
                    if held:
                        rows.append((*held[:6], held[7] not in template.final))
                    conv, state = own, None
                elif held:
                    rows.append((*held[:6], False))
                bad = role not in template.follows.get(state, ())
                state = role
                rows.append((own, turn, 0, "head", template.head + put(role) + template.middle, False, bad))
                rows.append((own, turn, 1, "text", put(text), role in template.loss_roles, bad))
                held = (own, turn, 2, "tail", template.tail, False, False, role)
                chars += len(text) + 100
                if chars > BATCH_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _SEGMENTS, strict=True)], schema=_SEGMENTS)
                    rows, chars = [], 0
        if held:
            rows.append((*held[:6], held[7] not in template.final))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _SEGMENTS, strict=True)], schema=_SEGMENTS)

    chosen = conversations.select(
        col(id_col).cast("long").alias("conv_id"), col(turn_col).cast("long").alias("turn"),
        F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    return chosen.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(emit, SEGMENTS)


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, parsed from the formatted text: turns are found
    by the template's marks, texts and roles unescaped, the text under the loss
    flags unescaped.  Rows must come as ``format_turns`` emits them (it is
    chained in the same tasks, so nothing is shuffled)."""
    _, take = template.escaper()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seen = None, False
        out: list[tuple] = []
        turns = loss = None
        n = loss_chars = chars = bad = 0
        turn = ""

        def finish():
            out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, bad))

        for batch in batches:
            for own, text, flag, wrong, kind in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "text", "loss", "violation", "kind")), strict=True):
                if not seen or own != conv:
                    if seen:
                        finish()
                    conv, seen = own, True
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                    n = loss_chars = chars = bad = 0
                    turn = ""
                chars += len(text)
                bad += wrong and kind != "text"
                if flag:
                    plain = take(text)
                    loss_chars += len(plain)
                    loss.update(plain.encode("utf-8", "surrogatepass"))
                turn += text
                if turn.endswith(template.tail) and kind == "tail":
                    if not turn.startswith(template.head):
                        raise ValueError(f"conversation {own}: a turn does not start with its mark")
                    role, mark, body = turn[len(template.head):-len(template.tail)].partition(template.middle)
                    if not mark or template.middle in body:
                        raise ValueError(f"conversation {own}: a turn needs one mark between role and text")
                    turns.update(f"{take(role)}\n{take(body)}\n".encode("utf-8", "surrogatepass"))
                    n += 1
                    turn = ""
            if len(out) >= 1 << 13:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), TYPES, strict=True)], names=NAMES)
                out = []
        if seen:
            finish()
        if out:
            columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    return segments.mapInArrow(parse, DIGESTS)


NAMES = [x.split()[0] for x in DIGESTS.split(", ")]
TYPES = [pa.string() if x.endswith("string") else pa.int64() for x in DIGESTS.split(", ")]
