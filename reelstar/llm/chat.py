"""Chat formatting into budgeted windows of whole turns.

Turns are sorted by (conversation, turn) and streamed once.  A running sum of
turn tokens decides where a window ends; every window starts with the system
turn, repeats a limited history of earlier turns, and carries loss spans over
the assistant texts that are new in it, so each is a target exactly once.
Only the open window is held in memory, so one conversation of any length
streams through its task; a turn longer than the budget has its own window.

Template: ``<s>[ROLE]role[/ROLE]text</s>`` per turn.  Control strings inside
roles and texts are written as ``\\n`` with their number, a backslash doubled;
``parse`` undoes both.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
MARK_TOKENS = 4
WINDOW_SCHEMA = ("conv_id long, window_no long, formatted string, loss_spans array<struct<start:long,end:long>>, "
                 "n_repeated int, n_tokens long")
_ESCAPE = re.compile("|".join(map(re.escape, ("\\", *CONTROLS))))
_UNESCAPE = re.compile(r"\\(\\|\d)")
_TURN = re.compile(r"<s>\[ROLE\](.*?)\[/ROLE\](.*?)</s>", re.S)


def escape(text: str) -> str:
    """Reversibly hides control strings."""
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else f"\\{CONTROLS.index(m[0])}", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: "\\" if m[1] == "\\" else CONTROLS[int(m[1])], text)


def turn_tokens(text: str) -> int:
    """Budget measure of a turn: its white-space words and its marks."""
    return len(text.split()) + MARK_TOKENS


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of every turn; start and end delimit the escaped text."""
    return [(unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)) for m in _TURN.finditer(formatted)]


def _windows(turns: Iterator[tuple], budget: int, history: int) -> Iterator[tuple]:
    """Windows of one conversation: (formatted, spans, repeated turns, tokens)."""
    system, past, past_sum = None, deque(), 0
    held: list[tuple[str, str, int]] = []
    held_sum = lead_sum = 0
    lead: list[tuple[str, str, int]] = []

    def window():
        out, spans, at = [], [], 0
        for k, (role, text, _) in enumerate([*lead, *held]):
            head, body = f"<s>[ROLE]{escape(role)}[/ROLE]", escape(text)
            if role == "assistant" and k >= len(lead):
                spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
            out += (head, body, "</s>")
            at += len(head) + len(body) + 4
        return "".join(out), spans, len(lead), lead_sum + held_sum

    first = True
    for role, text in turns:
        turn = (role, text, turn_tokens(text))
        if held and lead_sum + held_sum + turn[2] > budget:
            yield window()
            for t in held:
                if t is not system:
                    past.append(t)
                    past_sum += t[2]
                while past and past_sum > history:
                    past_sum -= past.popleft()[2]
            lead = ([system] if system else []) + list(past)
            lead_sum = sum(t[2] for t in lead)
            while len(lead) > (system is not None) and lead_sum + turn[2] > budget:
                lead_sum -= lead.pop(system is not None)[2]
            held, held_sum = [], 0
        if first and role == "system":
            system = turn
        first = False
        held.append(turn)
        held_sum += turn[2]
    if held:
        yield window()


def format_windows(conversations: DataFrame, budget: int = 2048, history: int = 512) -> DataFrame:
    """Windows of every conversation, in order within its partition.

    A null text or role reads as empty; a null conv_id is one conversation;
    turns with equal numbers follow in the order of (role, text); an empty
    table gives no window.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        stream, ahead = rows(), None
        ahead = next(stream, None)
        while ahead is not None:
            conv = ahead[0]

            def turns():
                nonlocal ahead
                while ahead is not None and ahead[0] == conv:
                    yield ahead[1], ahead[2]
                    ahead = next(stream, None)

            for no, (formatted, spans, repeated, tokens) in enumerate(_windows(turns(), budget, history)):
                yield (conv, no, formatted, spans, repeated, tokens)

    def batched(batches):
        types = pa.schema([("conv_id", pa.int64()), ("window_no", pa.int64()), ("formatted", pa.string()),
                           ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                           ("n_repeated", pa.int32()), ("n_tokens", pa.int64())])
        held, size = [], 0
        for row in run(batches):
            held.append(row)
            size += len(row[2])
            if len(held) >= 1024 or size > 4 << 20:
                yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*held), types)], schema=types)
                held, size = [], 0
        if held:
            yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*held), types)], schema=types)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    return (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), role.alias("role"),
                                 text.alias("text"), F.col("turn").alias("turn"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(batched, WINDOW_SCHEMA))


DIGEST_SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                 "formatted_chars long, n_windows long")


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, digests read back from its windows (which must follow
    in order within a partition, as ``format_windows`` returns them)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(conv, s):
            return [conv, s["n"], s["turns"].hexdigest(), s["loss"], s["hash"].hexdigest(), s["chars"], s["windows"]]

        state, conv, out = None, None, []
        for batch in batches:
            for cid, _, formatted, spans, repeated, _ in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or cid != conv:
                    if state:
                        out.append(done(conv, state))
                    conv, state = cid, {"n": 0, "turns": hashlib.sha256(), "loss": 0, "hash": hashlib.sha256(),
                                        "chars": 0, "windows": 0}
                for role, text, _, _ in parse(formatted)[repeated:]:
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode())
                for span in spans:
                    text = unescape(formatted[span["start"]:span["end"]])
                    state["loss"] += len(text)
                    state["hash"].update(text.encode())
                state["chars"] += len(formatted)
                state["windows"] += 1
            if out:
                yield _batch(out)
                out = []
        if state:
            yield _batch([*out, done(conv, state)])

    def _batch(rows):
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                               names=[c.split()[0] for c in DIGEST_SCHEMA.split(", ")])

    return windows.mapInArrow(run, DIGEST_SCHEMA)
