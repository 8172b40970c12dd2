"""Chat formatting by token-level assembly (operator 7).

Every text is encoded on its own, so nothing a text says can become a control
token: the template's marks are reserved ids above the vocabulary, spliced between
the segments.  Control strings that occur inside a text are escaped reversibly as
well, so that the rendered text is unambiguous too.  The loss mask is the running
sum of +1 and -1 put at the prefix sums of the segments' lengths.

Encoding happens before the shuffle, row by row.  After it a task streams the
turns of its conversations in order and keeps one running offset, so a
conversation of any length takes bounded memory.  The output has one row per
turn; a conversation is the concatenation of its rows by ``turn_no``.

Template: ``<s>`` opens a conversation; ``<<SYS>>text<</SYS>>``,
``[INST]text[/INST]`` and ``text</s>`` are system, user and assistant turns; any
other role is ``[ROLE]name[TEXT]text[END]``.

Defined results: a null text or role is empty; a null conversation id is a
conversation of its own; rows with equal turns follow in order of role and ids,
null turns first; repeated rows are repeated turns; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedsync.llm.common import texts
from feedsync.llm.tokens import ByteTokenizer, byte_tokenizer

# The template's control strings; their reserved ids follow the
# vocabulary in this order.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[TEXT]", "[END]"]
FIRST_RESERVED = 50_257
BOS, EOS, INST, END_INST, SYS, END_SYS, ROLE, TEXT, END = range(FIRST_RESERVED, FIRST_RESERVED + len(CONTROLS))
MARKS = {"system": (SYS, END_SYS), "user": (INST, END_INST), "assistant": (None, EOS)}

_ESCAPE = re.compile(r"\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS))
_UNESCAPE = re.compile(r"\\\\|\\x3c|\\x5b")
_TO = {"\\": "\\\\", "<": "\\x3c", "[": "\\x5b"}
_FROM = {v: k for k, v in _TO.items()}


def escape(text: str) -> str:
    """``text`` without any control string; :func:`unescape` gives it back."""
    return _ESCAPE.sub(lambda m: _TO[m[0]], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: _FROM[m[0]], text)


def _spelled(mark: int | None) -> str:
    return "" if mark is None else CONTROLS[mark - FIRST_RESERVED]


def _encode(batches):
    """Rows (conv_id, turn, role, text) to (conv_id, turn, role, role_ids, ids, chars)."""
    tokenizer = byte_tokenizer()
    for b in batches:
        role_ids, ids, chars = [], [], []
        roles = texts(b.column(2))
        for role, text in zip(roles, texts(b.column(3)), strict=True):
            safe = escape(text)
            ids.append(tokenizer.encode(safe))
            if role in MARKS:
                first, last = MARKS[role]
                role_ids.append(b"")
                chars.append(len(safe) + len(_spelled(first)) + len(_spelled(last)))
            else:
                name = escape(role)
                role_ids.append(tokenizer.encode(name))
                chars.append(len(safe) + len(name) + sum(len(_spelled(m)) for m in (ROLE, TEXT, END)))
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                b.column(1),
                pa.array(roles, pa.string()),
                pa.array(role_ids, pa.binary()),
                pa.array(ids, pa.binary()),
                pa.array(chars, pa.int64()),
            ],
            names=["conv_id", "turn", "role", "role_ids", "ids", "chars"],
        )


def _assemble(batches):
    """Sorted turns to formatted rows: splice the marks, derive the mask."""
    last, turn_no, at = object(), 0, 0
    for b in batches:
        convs = b.column(0).to_pylist()
        pieces, lengths, loss, turn_nos, starts, of_row = [], [], [], [], [], []
        for row, (conv, role, role_ids, ids) in enumerate(
            zip(convs, b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)
        ):
            segments = []
            if conv != last:
                last, turn_no, at = conv, 0, 0
                segments.append(([BOS], 0))
            content = np.frombuffer(ids, "<u4")
            first, closing = MARKS.get(role, (ROLE, END))
            if first is not None:
                segments.append(([first], 0))
            if role not in MARKS:
                segments += [(np.frombuffer(role_ids, "<u4"), 0), ([TEXT], 0)]
            segments += [(content, int(role == "assistant")), ([closing], 0)]
            turn_nos.append(turn_no)
            starts.append(at)
            for seg, in_loss in segments:
                pieces.append(np.asarray(seg, "<u4"))
                lengths.append(len(seg))
                loss.append(in_loss)
                of_row.append(row)
                at += len(seg)
            turn_no += 1
        flat = np.concatenate(pieces).astype("<u4") if pieces else np.zeros(0, "<u4")
        ends = np.cumsum(lengths) if lengths else np.zeros(0, np.int64)
        delta = np.zeros(len(flat) + 1, np.int8)
        np.add.at(delta, ends - lengths, loss)
        np.subtract.at(delta, ends, loss)
        mask = np.cumsum(delta[:-1], dtype=np.int8).astype(np.uint8)
        row_ends = ends[np.flatnonzero(np.diff(of_row, append=-1))] if pieces else []
        row_starts = [0, *row_ends[:-1]] if pieces else []
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                pa.array(turn_nos, pa.int64()),
                pa.array(starts, pa.int64()),
                pa.array([flat[i:j].tobytes() for i, j in zip(row_starts, row_ends, strict=True)], pa.binary()),
                pa.array([mask[i:j].tobytes() for i, j in zip(row_starts, row_ends, strict=True)], pa.binary()),
                b.column(5),
            ],
            names=["conv_id", "turn_no", "start", "ids", "loss_mask", "chars"],
        )


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per turn, each conversation in one partition and in order: conv_id,
    turn_no, start (ids before it), ids (little-endian unsigned 32-bit), loss_mask
    (a byte for each id), chars (length of the rendered text)."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    order = turns.schema["turn"].dataType.simpleString()
    encoded = turns.select("conv_id", "turn", "role", "text").mapInArrow(
        _encode, f"conv_id {kind}, turn {order}, role string, role_ids binary, ids binary, chars long"
    )
    return (
        encoded.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "ids")
        .mapInArrow(
            _assemble, f"conv_id {kind}, turn_no long, start long, ids binary, loss_mask binary, chars long"
        )
    )


def parse_turn(tokenizer: ByteTokenizer, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str]:
    """(role, text, text under the loss mask) of one formatted row."""
    if len(ids) and ids[0] == BOS:
        ids, mask = ids[1:], mask[1:]
    marks = np.flatnonzero(ids >= FIRST_RESERVED)
    first = int(ids[0])
    if first == ROLE:
        role = unescape(tokenizer.decode(ids[1 : marks[1]]))
        body = ids[marks[1] + 1 : -1]
    else:
        role = {SYS: "system", INST: "user"}.get(first, "assistant")
        body = ids[1:-1] if role != "assistant" else ids[:-1]
    text = unescape(tokenizer.decode(body))
    under = ids[mask.astype(bool)]
    if len(under) == len(body) and np.array_equal(under, body):
        return role, text, text
    return role, text, unescape(tokenizer.decode(under)) if len(under) else ""


def _digest(batches):
    tokenizer = byte_tokenizer()
    state = None

    def closed(s):
        return (s["conv"], s["n"], s["turns"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"])

    for b in batches:
        done = []
        columns = [b.column(i).to_pylist() for i in (0, 3, 4, 5)]
        for conv, ids, mask, chars in zip(*columns, strict=True):
            if state is None or state["conv"] != conv:
                if state:
                    done.append(closed(state))
                state = {"conv": conv, "n": 0, "turns": hashlib.sha256(), "loss_chars": 0}
                state |= {"loss": hashlib.sha256(), "chars": len(_spelled(BOS))}
            role, text, loss = parse_turn(tokenizer, np.frombuffer(ids, "<u4"), np.frombuffer(mask, np.uint8))
            state["n"] += 1
            state["turns"].update(f"{role}\n{text}\n".encode())
            state["loss"].update(loss.encode())
            state["loss_chars"] += len(loss)
            state["chars"] += chars
        if done:
            yield _digests(done, b.schema.field(0).type)
    if state:
        yield _digests([closed(state)], b.schema.field(0).type)


def _digests(rows, kind) -> pa.RecordBatch:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names
    )


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Read formatted rows back: one row per conversation."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(
        _digest,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
