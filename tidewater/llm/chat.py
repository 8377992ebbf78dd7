"""Conversations as token ids with a loss mask, and back.

A turn is `<turn>role<says>text</turn>`. The three control strings are reserved ids above the
vocabulary; roles and texts are encoded by themselves, with no special tokens, and the reserved
ids are spliced between them, so no text can make a control id. In roles and texts a `\\` is
put before each `\\` and within each control string, so that written out no text holds one
either; taking each `\\` away and its next character as it is gives the text back. The loss
mask is a prefix sum over the ends of the trained segments, which are the assistant's texts.

Turns are encoded where they are read. Then only ids move, sorted by conversation and turn, and
are joined to blocks of whole turns of some `most` ids: a conversation is one block, unless it
is very long. Tasks hold one block at a time, so a conversation of any number of turns fits.

Edge cases: a null text or role is empty; a null conv_id is a conversation of its own; turns of
one number come by role and ids, null numbers last; repeated rows are repeated turns; a very
long text is encoded in segments, in one row; an empty table gives no rows; of extra columns
none is read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import durable, table, tidy
from tidewater.llm.tokens import Encoder, default_tokenizer, parts

#: Encoders that take special tokens in texts for ordinary text, by path.
_PLAIN: dict[str, Encoder] = {}


@dataclass(frozen=True)
class Template:
    """Control strings (two characters at least, without a `\\`) and the roles whose texts are trained on."""

    start: str = "<turn>"
    says: str = "<says>"
    end: str = "</turn>"
    trained: tuple[str, ...] = ("assistant",)

    @property
    def controls(self) -> tuple[str, str, str]:
        return self.start, self.says, self.end

    def escaped(self, text: str) -> str:
        """text without any control string."""
        return re.sub(rf"\\|(?:{'|'.join(f'(?={re.escape(c)})' for c in self.controls)}).", lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text, flags=re.S)

    def plain(self, text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def _encoder(path: str) -> Encoder:
    if path not in _PLAIN:
        made = Encoder(path)
        made.tokenizer.encode_special_tokens = True
        made.forget()
        _PLAIN[path] = made
    return _PLAIN[path]


def encoded(turns: DataFrame, path: str, template: Template) -> DataFrame:
    """conv_id, turn, role, ids (of the whole turn, four bytes each), head (how many come before the text's), trained of each row."""

    def run(batches):
        encoder, roles = _encoder(path), {}
        start, says, end = (np.array([encoder.tokenizer.get_vocab_size() + k], "<u4") for k in range(3))

        def named(role: str) -> np.ndarray:
            if role not in roles:
                if len(roles) > 10_000:
                    roles.clear()
                roles[role] = np.concatenate([start, encoder.encode(pa.array([template.escaped(role)]))[0].astype("<u4"), says])
            return roles[role]

        for batch in batches:
            rows = batch.num_rows
            names, texts = (["" if x is None else x for x in batch.column(k).to_pylist()] for k in (2, 3))
            bodies: list[list[np.ndarray]] = [[] for _ in range(rows)]
            for segments, at in parts(pa.array([template.escaped(t) for t in texts], pa.string())):
                ids, sizes = encoder.encode(segments)
                for row, own in zip(at.tolist(), np.split(ids.astype("<u4"), np.cumsum(sizes)[:-1])):
                    bodies[row].append(own)
            heads = [named(name) for name in names]
            whole = [np.concatenate([head, *body, end]).tobytes() for head, body in zip(heads, bodies)]
            arrays = [pa.array(names, pa.string()), pa.array(whole, pa.binary()), pa.array([len(h) for h in heads], pa.int32()), pa.array([n in template.trained for n in names])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], ["conv_id", "turn", "role", "ids", "head", "trained"])
            tidy()

    kind = T.StructType([turns.schema["conv_id"], turns.schema["turn"], *T._parse_datatype_string("role string, ids binary, head int, trained boolean").fields])
    return turns.select("conv_id", "turn", "role", "text").mapInArrow(run, kind)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conv_id, its rows) of batches that are sorted by their first column; rows come one by one."""
    def value(x):
        return x.values.to_numpy() if isinstance(x, pa.ListScalar) else x.as_py()

    rows = (tuple(map(value, row)) for batch in batches for row in zip(*batch.columns))
    return groupby(rows, key=lambda row: row[0])


def loss_mask(heads: np.ndarray, sizes: np.ndarray, trained: np.ndarray) -> np.ndarray:
    """1 for the ids of trained texts, else 0, of turns of `sizes` ids whose texts come after `heads` ids and before a last one."""
    ends = np.cumsum(sizes)
    steps = np.zeros(int(ends[-1]) + 1, np.int64)
    np.add.at(steps, (ends - sizes + heads)[trained], 1)
    np.add.at(steps, (ends - 1)[trained], -1)
    return np.cumsum(steps)[:-1].astype(np.int8)


def assembled(turns: DataFrame, tokenizer: str | None = None, template: Template = Template(), most: int = 1 << 16) -> DataFrame:
    """conv_id, block (0, 1, ...), first (the place of its first id in the conversation), n_turns, ids and loss (1 where an id is trained on) of each block of turns."""
    made = encoded(turns, tokenizer or default_tokenizer(), template)

    def run(batches):
        def block(conv_id, number, first, rows):
            ids = np.frombuffer(b"".join(r[3] for r in rows), "<u4")
            mask = loss_mask(np.array([r[4] for r in rows]), np.array([len(r[3]) // 4 for r in rows]), np.array([r[5] for r in rows], bool))
            lists = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(x)) for x in (ids.view("<i4"), mask)]
            return [conv_id, number, first, len(rows), *lists]

        def batch_of(blocks):
            plain = [pa.array([b[k] for b in blocks], kind) for k, kind in enumerate((ids_kind, pa.int32(), pa.int64(), pa.int64()))]
            return pa.RecordBatch.from_arrays([*plain, *(pa.concat_arrays([b[k] for b in blocks]) for k in (4, 5))], ["conv_id", "block", "first", "n_turns", "ids", "loss"])

        ids_kind, out, held = pa.int64(), [], 0
        for conv_id, rows in _grouped(batches):
            number = first = size = 0
            now: list[tuple] = []
            for row in rows:
                now.append(row)
                size += len(row[3]) // 4
                if size >= most:
                    out.append(block(conv_id, number, first, now))
                    number, first, held, size, now = number + 1, first + size, held + size, 0, []
                if held >= most:
                    yield batch_of(out)
                    out, held = [], 0
            if now:
                out.append(block(conv_id, number, first, now))
                held += size
        if out:
            yield batch_of(out)

    kind = T._parse_datatype_string("conv_id bigint, block int, first bigint, n_turns bigint, ids array<int>, loss array<tinyint>")
    ordered = made.withColumn("conv_id", F.col("conv_id").cast("long")).repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "ids")
    return ordered.mapInArrow(run, kind)


def spoken(ids: np.ndarray, loss: np.ndarray, reserved: int) -> list[np.ndarray]:
    """Role, text and trained part of the ids, turn by turn, of one block. ValueError if they are no turns."""
    marks = np.flatnonzero(ids >= reserved)
    if not len(marks) or len(marks) % 3 or marks[0] or marks[-1] + 1 != len(ids) or (ids[marks] != reserved + np.arange(len(marks)) % 3).any() or (marks[3::3] != marks[2:-1:3] + 1).any() or loss[marks].any():
        raise ValueError("these ids are no turns of this template")
    out = []
    for start, says, end in marks.reshape(-1, 3).tolist():
        text = ids[says + 1 : end]
        out += [ids[start + 1 : says], text, text[loss[says + 1 : end] > 0]]
    return out


def told(blocks: DataFrame, tokenizer: str | None = None, template: Template = Template()) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each conversation, from its blocks alone."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        decoder = _encoder(path).tokenizer
        reserved, around = decoder.get_vocab_size(), sum(map(len, template.controls))
        out: list[tuple] = []
        for conv_id, rows in _grouped(batches):
            turns, loss, n_turns, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, _, ids, mask in rows:
                parts_of = spoken(ids, mask, reserved)
                texts = decoder.decode_batch([p.tolist() for p in parts_of], skip_special_tokens=False)
                for role, text, trained in zip(texts[::3], texts[1::3], texts[2::3]):
                    turns.update(f"{template.plain(role)}\n{template.plain(text)}\n".encode())
                    said = template.plain(trained)
                    loss.update(said.encode())
                    n_turns, loss_chars, chars = n_turns + 1, loss_chars + len(said), chars + around + len(role) + len(text)
            out.append((conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_pylist([dict(zip(shape.names, r)) for r in out], schema=shape)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(shape.names, r)) for r in out], schema=shape)

    shape = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    ordered = blocks.select("conv_id", "block", "ids", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op12_token_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return told(durable(assembled(turns.unionByName(probe)), "conversations"))
