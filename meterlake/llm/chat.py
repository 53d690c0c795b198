"""Chat formatting by token-level assembly.

Every role and text is encoded as a segment of its own and three reserved ids
are spliced around them, so no token ever spans a template boundary:

    TURN role-ids SAY text-ids END

The reserved ids follow the vocabulary and are written ``<turn>``, ``<say>``
and ``</turn>``.  Where a text or role contains one of these strings it is
escaped with backslashes before encoding: a run of k backslashes in front of a
control string becomes 2k + 1, a run of k at the end of a segment becomes 2k.
A control string after an even number of backslashes is therefore real, and
unescaping gives every text back exactly.

The loss mask covers the text of assistant turns.  Turns post +1 and -1 at the
ends of those spans and a prefix sum over the conversation's tokens gives the
mask; where a conversation is read in segments the sum is carried along.

Null texts and roles count as empty; rows without conversation id form one
conversation with a null id; rows are ordered by turn (nulls first), ties by
role, then text; repeated rows are kept.  An empty table gives an empty table.
``format_conversations`` makes one row of a conversation, in one task that
holds all its tokens.  ``digest_conversations`` goes over the same tokens in
segments of whole turns and about SEGMENT_BYTES, so that a conversation can be of
any length; its turns still pass through one task, in order.  Encoding is spread
over all rows before.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import vocabulary
from .common import SLICE_BYTES, map_column, slices

SEGMENT_BYTES = 4 << 20
CONTROLS = ("<turn>", "<say>", "</turn>")
_CONTROL = "|".join(map(re.escape, CONTROLS))
_ESCAPE = re.compile(rf"(\\*)({_CONTROL})|(\\+)\Z")


def escape(text: str | None) -> str:
    return _ESCAPE.sub(lambda m: m[3] * 2 if m[2] is None else m[1] * 2 + "\\" + m[2], text or "")


def unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[3][: len(m[3]) // 2] if m[2] is None
                       else m[1][: len(m[1]) // 2] + m[2], text)


def _ordered(turns: DataFrame, shared, conv_id: str, turn: str, role: str, text: str,
             learn: tuple[str, ...]) -> DataFrame:
    """Encoded turns (``c``, ``ids``, ``role_ids``, ``learn``), each
    conversation's together and in order."""
    def segments():
        encoder = shared.value.encoder()
        return lambda texts: [encoder.encode([escape(t) for t in texts])]

    rows = turns.select(F.col(conv_id).alias("c"), F.col(turn).alias("t"),
                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = map_column(rows, "text", segments, [("ids", "binary")])
    rows = map_column(rows, "role", segments, [("role_ids", "binary")])
    rows = rows.withColumn("learn", F.col("role").isin(*learn))
    return (rows.repartition("c").sortWithinPartitions("c", "t", "role", "text")
            .select("c", "ids", "role_ids", "learn"))


def _mask(events: list[tuple[int, int]], n: int, open_spans: int) -> tuple[np.ndarray, int]:
    """The loss mask of ``n`` tokens by a prefix sum over the steps at the ends of
    spans, on top of the spans still open before; also the spans open after."""
    delta = np.zeros(n, "i1")
    delta[0] = open_spans
    for at, step in events:
        delta[at] += step
    mask = np.cumsum(delta, dtype="i1")
    return mask, int(mask[-1])


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text",
                         learn: tuple[str, ...] = ("assistant",),
                         path: str | None = None) -> DataFrame:
    """One row per conversation: ``conv_id``, ``token_ids`` (packed
    little-endian uint32) and ``loss_mask`` (one byte 0/1 per token)."""
    shared = vocabulary(turns, path)
    ordered = _ordered(turns, shared, conv_id, turn, role, text, learn)
    kind = dict(ordered.dtypes)["c"]

    def assemble(batches):
        base = shared.value.first_free
        open_, say, close = (np.array([base + i], "<u4").tobytes() for i in range(3))
        key_type, current, parts, events, n = None, None, None, None, 0
        ready, size = ([], [], []), 0

        def done():
            mask, _ = _mask(events, n, 0)
            for column, value in zip(ready, (current, b"".join(parts), mask.tobytes())):
                column.append(value)
            return size + 5 * n

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(ready, (key_type, pa.binary(), pa.binary()))],
                ["conv_id", "token_ids", "loss_mask"])
            for column in ready:
                column.clear()
            return out

        for batch in batches:
            key_type = batch.schema.field(0).type
            for c, ids, role_ids, on in zip(*(col.to_pylist() for col in batch.columns)):
                if parts is None or c != current:
                    if parts is not None:
                        size = done()
                        if size > SLICE_BYTES:
                            yield flush()
                            size = 0
                    current, parts, events, n = c, [], [], 0
                parts += [open_, role_ids, say, ids, close]
                start = n + 2 + len(role_ids) // 4
                n = start + len(ids) // 4 + 1
                if on:
                    events += [(start, 1), (n - 1, -1)]
        if parts is not None:
            done()
            yield flush()

    return ordered.mapInArrow(assemble, f"conv_id {kind}, token_ids binary, loss_mask binary")


def _segments(batches, base: int):
    """(conversation, token_ids, loss_mask) of runs of whole turns, in order.  The
    prefix sum of a conversation's mask is carried from segment to segment."""
    open_, say, close = (np.array([base + i], "<u4").tobytes() for i in range(3))
    current, parts, events, n, carried = None, [], [], 0, 0
    for batch in batches:
        for c, ids, role_ids, on in zip(*batch.columns):
            c, ids, role_ids = c.as_py(), ids.as_py(), role_ids.as_py()
            if parts and (c != current or 4 * n > SEGMENT_BYTES):
                mask, carried = _mask(events, n, carried)
                yield current, b"".join(parts), mask.tobytes()
                parts, events, n = [], [], 0
            if c != current:
                current, carried = c, 0
            parts += [open_, role_ids, say, ids, close]
            start = n + 2 + len(role_ids) // 4
            n = start + len(ids) // 4 + 1
            if on.as_py():
                events += [(start, 1), (n - 1, -1)]
    if parts:
        yield current, b"".join(parts), _mask(events, n, carried)[0].tobytes()


def digest_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text",
                         learn: tuple[str, ...] = ("assistant",),
                         path: str | None = None) -> DataFrame:
    """One row per conversation of what its formatted tokens say, read back
    segment by segment: ``conv_id``, ``n_turns``, ``turns_sha256`` (each role and
    text, a line feed after both), ``loss_chars`` and ``loss_sha256`` (the
    masked texts) and ``formatted_chars``."""
    shared = vocabulary(turns, path)
    ordered = _ordered(turns, shared, conv_id, turn, role, text, learn)
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = dict(ordered.dtypes)["c"]

    def digest(batches):
        decoder, base = shared.value.decoder(), shared.value.first_free
        key_type, ready, state = None, [], None

        def typed():
            nonlocal key_type
            for batch in batches:
                key_type = batch.schema.field(0).type
                yield batch

        def flush():
            types = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*ready), types)], names)

        def done():
            c, n, said, n_loss, loss, shown = state
            ready.append((c, n, said.hexdigest(), n_loss, loss.hexdigest(), shown))

        for c, packed, mask in _segments(typed(), base):
            if state is None or c != state[0]:
                if state is not None:
                    done()
                state = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if len(ready) >= 10_000:
                    yield flush()
                    ready = []
            own, learned, shown = _read(packed, mask, base, decoder)
            state[1] += len(own)
            for x in own:
                state[2].update(f"{x['role']}\n{x['text']}\n".encode())
            for x in learned:
                state[3] += len(x)
                state[4].update(x.encode())
            state[5] += len(shown)
        if state is not None:
            done()
            yield flush()

    return ordered.mapInArrow(digest, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")


def _read(packed: bytes, mask: bytes, base: int, decoder) -> tuple[list[dict], list[str], str]:
    """(turns, masked texts, rendered text) of formatted tokens."""
    text_of = lambda ids: decoder.decode(ids.tobytes()).decode()
    ids, mask = np.frombuffer(packed, "<u4"), np.frombuffer(mask, "i1")
    marks = np.flatnonzero(ids >= base)
    turns, shown = [], []
    for a, b, c in marks.reshape(-1, 3).tolist():
        if [int(ids[x]) - base for x in (a, b, c)] != [0, 1, 2]:
            raise ValueError("not a formatted conversation")
        role, text = text_of(ids[a + 1:b]), text_of(ids[b + 1:c])
        turns.append({"role": unescape(role), "text": unescape(text)})
        shown += [CONTROLS[0], role, CONTROLS[1], text, CONTROLS[2]]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask, [0])))).reshape(-1, 2)
    return turns, [unescape(text_of(ids[a:b])) for a, b in edges], "".join(shown)


def read_conversations(formatted: DataFrame, path: str | None = None) -> DataFrame:
    """What a formatted conversation says, read back from its ids and mask:
    ``conv_id``, ``turns`` (role and text), ``loss_texts`` (the masked spans,
    unescaped) and ``formatted`` (the rendered text)."""
    shared = vocabulary(formatted, path)

    def read(batches):
        decoder = shared.value.decoder()
        base = shared.value.first_free

        for batch in batches:
            for part in slices(batch, 1):
                found = [_read(p.as_py(), m.as_py(), base, decoder) for p, m in zip(part.column(1), part.column(2))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)] + [pa.array(v, t) for v, t in zip(zip(*found), (
                        pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])),
                        pa.list_(pa.string()), pa.string()))],
                    ["conv_id", "turns", "loss_texts", "formatted"])

    kind = dict(formatted.dtypes)["conv_id"]
    return formatted.select("conv_id", "token_ids", "loss_mask").mapInArrow(
        read, f"conv_id {kind}, turns array<struct<role:string,text:string>>, "
              "loss_texts array<string>, formatted string")
