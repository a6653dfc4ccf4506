"""Chat formatting at the level of tokens.

Every text is escaped and encoded by itself, and the ids of the template's
control strings, which no text can yield, are spliced between.  So no token
spans a border of a turn, and a text that spells a control string stays text
twice over: its ids are ordinary ones, and its escaped spelling cannot be taken
for a control string when the output is read as a string.

The encoding, which is nearly all of the work, is done row by row before
anything is shuffled.  Then the rows of a conversation meet in order in one
partition, and are streamed: a conversation leaves as blocks of a bounded
number of tokens, so that one of any length needs the memory of one turn.

The loss mask of a block is a running sum: +1 where an assistant's text
begins, -1 where it ends.
"""
from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ids as numbers
from .common import pieces

#: Tokens that a block holds before the next turn opens another one.
BLOCK = 1 << 16


@dataclass(frozen=True)
class Template:
    """Control strings: what opens and closes the conversation and the texts of each role.

    Other roles are spelled out as text between ``[ROLE]`` and ``[TEXT]``."""
    begin: str = "<s>"
    turns: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[OUT]", "</s>")})
    other: tuple[str, str, str] = ("[ROLE]", "[TEXT]", "[/TEXT]")
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        for c in self.controls:
            if c[:1] not in "<[" or set(c[1:]) & set("<[\\") or len(c) < 2 or any(d != c and d.startswith(c) for d in self.controls):
                raise ValueError(f"control string {c!r}: it must begin with < or [, hold no other of these and no backslash, and begin no other one")
        if len(set(self.controls)) != len(self.controls):
            raise ValueError("control strings must differ")

    @property
    def controls(self) -> list[str]:
        return [self.begin, *(c for pair in self.turns.values() for c in pair), *self.other]

    def pattern(self, slashes: str) -> re.Pattern:
        return re.compile("|".join(f"{re.escape(c[0])}{slashes}{re.escape(c[1:])}" for c in self.controls))

    def escaper(self):
        """text -> text without control strings: a backslash goes behind the first character of each, and of each that has some already."""
        found = self.pattern(r"\\*")
        return lambda text: found.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescaper(self):
        """The inverse of ``escaper``: one backslash less."""
        found = self.pattern(r"\\+")
        return lambda text: found.sub(lambda m: m[0][0] + m[0][2:], text)


class Codec:
    """Ids of a template over a byte-level vocabulary; built in each task from the vocabulary's ranks."""

    def __init__(self, ranks: bytes, split: str, template: Template):
        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.lib = tiktoken.Encoding("chat", pat_str=split, mergeable_ranks=table, special_tokens={})
        self.template = template
        self.reserved = max(table.values()) + 1
        self.control = {c: self.reserved + i for i, c in enumerate(template.controls)}
        self.escape, self.unescape = template.escaper(), template.unescaper()
        self.begin = self.control[template.begin]
        self.name, self.text, self.close = (self.control[c] for c in template.other)
        self.opens = {role: self.control[a] for role, (a, _) in template.turns.items()}
        self.closes = {role: self.control[b] for role, (_, b) in template.turns.items()}
        self.role_of = {i: role for role, i in self.opens.items()}
        self.ends = {self.close, *self.closes.values()}

    def encode(self, text: str) -> list[int]:
        return self.lib.encode_ordinary(self.escape(text))

    def decode(self, found: Iterable[int]) -> str:
        """The text of ordinary ids, as it was before escaping."""
        return self.unescape(self.lib.decode(found))

    def turn(self, role: str, text: str) -> tuple[list[int], int, int]:
        """(ids of a turn with its control ids, begin and end of what is learned in them)."""
        own = self.encode(text)
        head = [self.opens[role]] if role in self.opens else [self.name, *self.encode(role), self.text]
        learned = len(own) if role in self.template.learned else 0
        return [*head, *own, self.closes.get(role, self.close)], len(head), len(head) + learned

    def render(self, found: Iterable[int]) -> str:
        """The formatted text: control strings and escaped texts."""
        names = {i: c for c, i in self.control.items()}
        out, held = [], []
        for i in found:
            if i >= self.reserved:
                out += [self.lib.decode(held), names[i]]
                held = []
            else:
                held.append(i)
        return "".join([*out, self.lib.decode(held)])

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of each turn of a formatted string."""
        parts = re.split("(" + "|".join(map(re.escape, self.template.controls)) + ")", formatted)
        roles = {a: role for role, (a, _) in self.template.turns.items()}
        turns, role = [], ""
        for text, control in zip(parts[2::2], parts[1::2]):
            if control == self.template.other[0]:
                role = self.unescape(text)
            elif control == self.template.other[1] or control in roles:
                turns.append((roles.get(control, role), self.unescape(text)))
        return turns


def loss_mask(size: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True inside the spans: the running sum of their begins less their ends."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def encode_turns(turns: DataFrame, ranks: bytes, split: str, template: Template) -> DataFrame:
    """conv_id, turn, role, ids, learn_from, learn_to: one row per turn, encoded by itself.  One pass, no shuffle."""
    def run(batches):
        codec = Codec(ranks, split, template)
        for b in pieces(batches, "text"):
            roles = b.column(b.schema.get_field_index("role")).to_pylist()
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            rows = [codec.turn(r or "", t or "") for r, t in zip(roles, texts)]
            found, begin, end = zip(*rows)
            yield pa.record_batch([
                pa.array(numbers(b, "conv_id"), pa.int64()), pa.array(numbers(b, "turn"), pa.int64()), pa.array(roles, pa.string()),
                pa.array([np.array(f, "<u4").tobytes() for f in found], pa.binary()), pa.array(begin, pa.int32()), pa.array(end, pa.int32())],
                ["conv_id", "turn", "role", "ids", "learn_from", "learn_to"])
    columns = [F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"]
    return turns.select(*columns).mapInArrow(run, "conv_id long, turn long, role string, ids binary, learn_from int, learn_to int")


def in_order(encoded: DataFrame) -> DataFrame:
    """Turns of a conversation side by side in one partition, by turn; equal turns by role, then ids."""
    return encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "ids")


def blocks(batches: Iterable[pa.RecordBatch], begin: int, limit: int = BLOCK) -> Iterator[tuple[int | None, int, np.ndarray, np.ndarray]]:
    """(conversation, block number, ids, mask) from ordered turns; whole turns, ``limit`` tokens unless one turn holds more."""
    held, spans, size, owner, block = [], [], 0, object(), 0

    def whole():
        own = np.array(spans, np.int64).reshape(-1, 2)
        return owner, block, np.concatenate(held), loss_mask(size, own[:, 0], own[:, 1])
    for b in batches:
        for conv, data, begins, ends in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "ids", "learn_from", "learn_to"))):
            found = np.frombuffer(data, "<u4")
            if conv != owner or size + len(found) > limit:
                if held:
                    yield whole()
                block = block + 1 if conv == owner else 0
                held, spans, size = ([], [], 0) if block else ([np.array([begin], "<u4")], [], 1)
                owner = conv
            spans.append((size + begins, size + ends))
            held.append(found)
            size += len(found)
    if held:
        yield whole()


def format_conversations(turns: DataFrame, ranks: bytes, split: str, template: Template = Template(), limit: int = BLOCK) -> DataFrame:
    """conv_id, block, ids, loss: the training rows, one per conversation of up to ``limit`` tokens, in blocks beyond.

    ``turns``: conv_id, turn, role, text.  A null text or role is empty; a null
    conv_id is a conversation of its own; a null turn comes first; rows that
    repeat a turn follow one another by role and text ids.  Further columns are
    ignored.  An empty table gives no rows."""
    def run(batches):
        control = Codec(ranks, split, template).begin
        for conv, block, found, mask in blocks(batches, control, limit):
            yield pa.record_batch([pa.array([conv], pa.int64()), pa.array([block], pa.int32()),
                                   pa.array([found.tolist()], pa.list_(pa.int32())), pa.array([mask.tolist()], pa.list_(pa.bool_()))],
                                  ["conv_id", "block", "ids", "loss"])
    return in_order(encode_turns(turns, ranks, split, template)).mapInArrow(run, "conv_id long, block int, ids array<int>, loss array<boolean>")


class Reader:
    """Reads the blocks of one conversation in turn and digests what they say, by ids and mask alone."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.control_chars = {i: len(c) for c, i in codec.control.items()}

    def add(self, found: np.ndarray, mask: np.ndarray) -> None:
        codec = self.codec
        at = np.flatnonzero(found >= codec.reserved)
        ends = np.r_[at[1:], len(found)]
        role = ""
        for begin, end, control in zip(at.tolist(), ends.tolist(), found[at].tolist()):
            self.chars += self.control_chars[control]
            plain = codec.lib.decode(found[begin + 1:end].tolist())
            self.chars += len(plain)
            text = codec.unescape(plain)
            if control == codec.name:
                role = text
            elif control == codec.text or control in codec.role_of:
                self.n_turns += 1
                self.turns.update(f"{codec.role_of.get(control, role)}\n{text}\n".encode())
                if end > begin + 1 and mask[begin + 1]:
                    learned = text if mask[begin + 1:end].all() else codec.decode(found[begin + 1:end][mask[begin + 1:end]].tolist())
                    self.loss_chars += len(learned)
                    self.loss.update(learned.encode())

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digest_conversations(turns: DataFrame, ranks: bytes, split: str, template: Template = Template(), limit: int = BLOCK) -> DataFrame:
    """``format_conversations`` read back in the same task, block by block, one row per conversation: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars.  Treats nulls, repeated turns and empty tables as it does."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def table(rows):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches):
        codec = Codec(ranks, split, template)
        owner, reader, rows = None, None, []
        for conv, block, found, mask in blocks(batches, codec.begin, limit):
            if not block:
                if reader:
                    rows.append((owner, *reader.row()))
                owner, reader = conv, Reader(codec)
                if len(rows) >= 4096:
                    yield table(rows)
                    rows = []
            reader.add(found, mask)
        if reader:
            rows.append((owner, *reader.row()))
        if rows:
            yield table(rows)
    return in_order(encode_turns(turns, ranks, split, template)).mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
