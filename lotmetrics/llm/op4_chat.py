r"""Chat formatting with a grammar round trip.

Template: `### Role: text</turn>` and a line feed for each turn.  The grammar's
control strings are `### `, `: `, `</turn>` and the escape character `\`; a
deterministic parser reads them back, taking `\x` as x anywhere.  Each turn is
rendered as it is, reparsed and compared; a turn that does not come back is
escaped and compared again, so what cannot conflict stays as written.

Turns are ordered by turn, role, text, nulls first.  Null roles and texts are
empty; rows of a null conv_id form one conversation; repeated rows are turns
each.  An empty table gives no rows.  Other columns are not read, whatever their names.  A conversation is read as a stream: a task
holds one turn of it at a time, whatever its length.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

OPEN, MID, CLOSE = "### ", ": ", "</turn>\n"
#: How the usual roles are shown; any other role is shown as it is.
NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
ROLES = {v: k for k, v in NAMES.items()}
SEGMENTS = "conv_id long, role string, text string, segment string, escaped boolean"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    for control in ("\\", "#", ":", "<", "\n"):
        text = text.replace(control, "\\" + control)
    return text


def render(role: str, text: str, escaped: bool) -> str:
    shown = NAMES.get(role, role)
    if escaped:
        shown, text = NAMES.get(role) or escape(role), escape(text)
        shown = "\\" + shown if shown in NAMES.values() and role not in NAMES else shown
    return f"{OPEN}{shown}{MID}{text}{CLOSE}"


def upto(s: str, at: int, stop: str) -> tuple[str | None, str, int]:
    """What stands from at to the first unescaped stop, without and with escapes, and the place after stop; null if there is none."""
    out, begin, end = [], at, s.find(stop, at)
    while end >= 0:
        slash = s.find("\\", at)
        if slash < 0 or slash > end:
            return "".join(out) + s[at:end], s[begin:end], end + len(stop)
        out += (s[at:slash], s[slash + 1 : slash + 2])
        at = slash + 2
        if end < at:  # the stop began at the escaped character; else it is still the next one
            end = s.find(stop, at)
    return None, "", at


def whole_turns(s: str) -> tuple[list[tuple[str, str]], str]:
    """The turns that s begins with, and what follows the last whole one."""
    turns, end = [], 0
    while s.startswith(OPEN, end):
        role, shown, at = upto(s, end + len(OPEN), MID)
        text, _, at = upto(s, at, CLOSE) if role is not None else (None, "", at)
        if text is None:
            break
        turns.append((ROLES.get(shown, role), text))
        end = at
    return turns, s[end:]


def parse(s: str) -> list[tuple[str, str]] | None:
    """The turns of a formatted conversation, null if it does not follow the grammar."""
    turns, rest = whole_turns(s)
    return None if rest else turns


def segment(role: str, text: str) -> tuple[str, bool]:
    """A turn as it is, or escaped where it would not come back.

    With every control character escaped, a turn always comes back.
    """
    conflicts, escaped = OPEN in text or "</turn>" in text, False
    while conflicts or parse(render(role, text, escaped)) != [(role, text)]:
        conflicts, escaped = False, True
    return render(role, text, escaped), escaped


def _segments(batches):
    for b in batches:
        roles, texts = b.column("role").to_pylist(), b.column("text").to_pylist()
        made = [segment(r, t) for r, t in zip(roles, texts, strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("role"), b.column("text"), pa.array([x for x, _ in made], pa.string()), pa.array([x for _, x in made], pa.bool_())], names=["conv_id", "role", "text", "segment", "escaped"])


def format_turns(conversations: DataFrame) -> DataFrame:
    """Each turn with its rendered segment; a conversation is its segments in order.

    All rows of a conversation are in one partition, in order.
    """
    rows = conversations.select("conv_id", F.col("turn").alias("_turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "_turn", "role", "text").select("conv_id", "role", "text").mapInArrow(_segments, SEGMENTS)


def _digests(batches):
    """Reads conversations back: one row for each.

    A conversation is parsed as one text, of which only what is not yet a whole
    turn is held.
    """
    fields = [x.rpartition(" ")[0] for x in DIGESTS.split(", ")]
    conv, state = None, None

    def closed():
        return [conv, state["n"], state["turns"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"]]

    for b in batches:
        out = []
        for c, s in zip(b.column("conv_id").to_pylist(), b.column("segment").to_pylist(), strict=True):
            if state is None or c != conv:
                if state is not None:
                    out.append(closed())
                conv, state = c, {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0, "rest": ""}
            state["chars"] += len(s)
            turns, state["rest"] = whole_turns(state["rest"] + s)
            for role, text in turns:
                state["n"] += 1
                state["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if role == "assistant":
                    state["loss_chars"] += len(text)
                    state["loss"].update(text.encode("utf-8", "surrogatepass"))
        if out:
            yield _rows(out, fields)
    if state is not None:
        yield _rows([closed()], fields)


def _rows(out: list, fields: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=fields)


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of what the parser recovers from the segments, under the loss mask for assistant texts."""
    return segments.select("conv_id", "segment").mapInArrow(_digests, DIGESTS)


def assemble(segments: DataFrame) -> DataFrame:
    """conv_id, formatted text; for conversations that fit in a row."""
    def whole(batches):
        conv, got, begun = None, [], False
        for b in batches:
            out = []
            for c, s in zip(b.column("conv_id").to_pylist(), b.column("segment").to_pylist(), strict=True):
                if begun and c != conv:
                    out.append((conv, "".join(got)))
                    got = []
                conv, begun = c, True
                got.append(s)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([s for _, s in out], pa.string())], names=["conv_id", "formatted"])
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array(["".join(got)], pa.string())], names=["conv_id", "formatted"])

    return segments.select("conv_id", "segment").mapInArrow(whole, "conv_id long, formatted string")


#: Fixed value: the text of the conversation that the query adds.
HARD = "\\### Assistant: </turn> ok"


def op4_grammar_round_trip(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD).alias("text"))
    return read_back(format_turns(rows.unionByName(hard)))
