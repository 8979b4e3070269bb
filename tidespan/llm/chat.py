"""Chat formatting with loss masks aligned by offsets.

A whole conversation is rendered as text, encoded once with the offsets of its tokens, and the spans of the turns are
intersected with the spans of the tokens by binary search; both are sorted. A token is under the loss where it meets
the text of an assistant turn; the loss spans are these meetings, cut to the turn.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>\\n`` for each turn. The three markers are added to the tokenizer as
single tokens, so no token crosses the border of a text. Inside roles and texts ``\\`` becomes ``\\\\`` and ``<|`` becomes
``<\\|``; so no text can hold a marker, and ``parsed`` gives back exactly what went in.

Conversations are dealt to tasks whole and streamed turn by turn; a very long one is rendered and encoded in blocks of
whole turns, which changes nothing as tokens end at markers. So memory is bounded by a block and the longest turn.

Defined results: null text or role: empty; turns in ascending order, null ones first, equal ones by role and text; rows
of a null conv_id are one conversation; repeated rows are turns of their own; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.llm.tables import prepared

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END), re.S)
BLOCK_CHARS = 1_000_000
FORMATTED = "conv_id long, block int, formatted string, ids array<int>, loss array<boolean>, spans array<struct<start: int, stop: int>>"


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def rendered(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, bool]]]:
    """(text, spans of the turns' texts in it, with: from the assistant or not)."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escaped(role) + SEP, escaped(text)
        spans.append((at + len(head), at + len(head) + len(body), role == "assistant"))
        out += [head, body, END]
        at = spans[-1][1] + len(END)
    return "".join(out), spans


def parsed(formatted: str) -> list[tuple[str, str]]:
    return [(unescaped(m[1]), unescaped(m[2])) for m in TURN.finditer(formatted)]


def masked(offsets: np.ndarray, spans: list[tuple[int, int, bool]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(under the loss or not, for every token; the loss spans, each within one turn)."""
    loss, found = np.zeros(len(offsets), bool), []
    starts, stops = offsets[:, 0], offsets[:, 1]
    for a, b, ours in spans:
        if not ours or a == b:
            continue
        first, last = int(np.searchsorted(stops, a, "right")), int(np.searchsorted(starts, b, "left"))
        loss[first:last] = True
        mine: list[tuple[int, int]] = []
        for s, e in zip(np.maximum(starts[first:last], a).tolist(), np.minimum(stops[first:last], b).tolist()):
            if mine and s <= mine[-1][1]:  # the next token, or another part of the same character
                mine[-1] = (mine[-1][0], max(e, mine[-1][1]))
            else:
                mine.append((s, e))
        found += mine
    return loss, found


@functools.cache
def _tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer

    out = Tokenizer.from_file(path)
    out.encode_special_tokens = False
    out.add_special_tokens([AddedToken(x.strip(), special=True, normalized=False) for x in (START, SEP, END)])
    return out


def formatted(turns: DataFrame, path: str) -> DataFrame:
    """Blocks of formatted conversations in order: text, ids, loss mask by token, loss spans in the text."""
    prepared(turns.sparkSession)

    def block_of(conv_id, number: int, held: list[tuple[str, str]]) -> tuple:
        text, spans = rendered(held)
        encoding = _tokenizer(path).encode(text, add_special_tokens=False)
        offsets = np.array(encoding.offsets, np.int64).reshape(-1, 2)
        loss, found = masked(offsets, spans)
        return conv_id, number, text, encoding.ids, loss.tolist(), [{"start": s, "stop": e} for s, e in found]

    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int32()), ("formatted", pa.string()), ("ids", pa.list_(pa.int32())), ("loss", pa.list_(pa.bool_())), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv: object = run  # no conversation yet
        number = chars = ready = 0
        held: list[tuple[str, str]] = []
        rows: list[tuple] = []
        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if held and (conv_id != conv or chars >= BLOCK_CHARS):
                    rows.append(block_of(conv, number, held))
                    number, held, ready, chars = number + 1, [], ready + chars, 0
                if conv_id != conv:
                    conv, number = conv_id, 0
                held.append((role, text))
                chars += len(text)
                if ready >= BLOCK_CHARS:
                    yield out(rows)
                    rows, ready = [], 0
        if held:
            rows.append(block_of(conv, number, held))
        if rows:
            yield out(rows)

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.col("turn").alias("turn"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


def digests(blocks: DataFrame) -> DataFrame:
    """One row a conversation, read back from its formatted blocks; these stay in their order."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None
        rows: list[list] = []

        def close() -> None:
            rows.append([state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]])

        for batch in batches:
            for conv_id, number, text, spans in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if not number:
                    if state:
                        close()
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parsed(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for x in spans:
                    under = unescaped(text[x["start"]:x["stop"]])
                    state[3] += len(under)
                    state[4].update(under.encode())
                state[5] += len(text)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        if state:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return blocks.select("conv_id", "block", "formatted", "spans").mapInArrow(run, kinds)
