"""Chat formatting (operator 9).

Template: a conversation part is ``<s>`` and its turns; a turn is
``[INST]text[/INST]`` (user), ``text</s>`` (assistant) or
``[ROLE]role[/ROLE]text</s>`` (any other role).  Control strings inside a
text are escaped by one backslash after their first character (one more,
if backslashes already stand there), which no control string has, so the
formatted text parses back uniquely and unescaping restores the text.

Assembly is by token: every segment is encoded by itself, so no token spans
a border; each control string is one reserved id behind the vocabulary, and
content never yields a reserved id.  The loss mask is a prefix sum over +1
where an assistant text starts and -1 where it ends.

Conversations are formatted in parts, by ranges of the turn number, so a
very long conversation is spread over tasks and files; digests stream over
the parts in order and hold one part at a time.

Defined cases: null text and null role are empty; null ``turn`` sorts first;
null ``conv_id`` is a conversation of its own; rows of equal turn are ordered
by role, then text, and all kept; an empty table gives no rows; further
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import one_thread, pack, unpack

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
BOS, EOS, INST, END_INST, ROLE, END_ROLE = range(len(CONTROLS))
_SPLIT = re.compile("(" + "|".join(map(re.escape, CONTROLS)) + ")")
_ESCAPE = re.compile(r"([<\[])(\\*/?(?:s>|INST\]|ROLE\]))")
_UNESCAPE = re.compile(r"([<\[])\\(\\*/?(?:s>|INST\]|ROLE\]))")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def segments(turns: list[tuple[str, str]]) -> Iterator[tuple[int | str, bool]]:
    """The template as (control number or escaped text, under the loss mask)."""
    yield BOS, False
    for role, text in turns:
        if role == "user":
            yield from ((INST, False), (escape(text), False), (END_INST, False))
            continue
        if role != "assistant":
            yield from ((ROLE, False), (escape(role), False), (END_ROLE, False))
        yield from ((escape(text), role == "assistant"), (EOS, False))


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """The turns of one formatted part."""
    pieces = _SPLIT.split(formatted)          # text, control, text, control, ..., text
    i = 2                                     # behind "<s>"
    while i < len(pieces) - 1:
        text, control = pieces[i], pieces[i + 1]
        if control == CONTROLS[EOS]:
            yield "assistant", unescape(text)
            i += 2
        elif control == CONTROLS[INST]:
            yield "user", unescape(pieces[i + 2])
            i += 4
        else:
            yield unescape(pieces[i + 2]), unescape(pieces[i + 4])
            i += 6


class Assembler:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        one_thread()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.first_reserved = self.tokenizer.get_vocab_size(with_added_tokens=True)

    def assemble(self, turns: list[tuple[str, str]]) -> tuple[str, np.ndarray, np.ndarray]:
        """(formatted text, ids, loss mask)."""
        parts = list(segments(turns))
        texts = [p for p, _ in parts if isinstance(p, str)]
        encoded = iter(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))
        ids = [[self.first_reserved + p] if isinstance(p, int) else next(encoded).ids for p, _ in parts]
        lens = np.array([len(x) for x in ids], np.int64)
        starts = np.cumsum(lens) - lens
        step = np.zeros(int(lens.sum()) + 1, np.int64)
        loss = np.array([m for _, m in parts], bool)
        np.add.at(step, starts[loss], 1)
        np.add.at(step, starts[loss] + lens[loss], -1)
        formatted = "".join(CONTROLS[p] if isinstance(p, int) else p for p, _ in parts)
        return formatted, np.array([t for x in ids for t in x], np.uint32), np.cumsum(step[:-1]).astype(np.uint8)

    def loss_texts(self, ids: np.ndarray, mask: np.ndarray) -> Iterator[str]:
        """The texts under the mask, one per unbroken run."""
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]]).astype(np.int8)))
        for lo, hi in zip(edge[::2], edge[1::2]):
            yield unescape(self.tokenizer.decode(ids[lo:hi].tolist(), skip_special_tokens=False))


def _groups(batches, keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of rows with equal keys over sorted batches."""
    key, rows = None, []
    for b in batches:
        for row in b.to_pylist():
            k = tuple(row[c] for c in keys)
            if rows and k != key:
                yield key, rows
                rows = []
            key = k
            rows.append(row)
    if rows:
        yield key, rows


PART_SCHEMA = "conv_id long, part long, formatted string, tokens binary"


def format_conversations(conversations: DataFrame, tokenizer_path: str, part_turns: int = 256) -> DataFrame:
    """One row per part: ``conv_id``, ``part``, ``formatted`` and ``tokens``
    (packed input ids and loss mask)."""
    rows = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .withColumn("part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-(1 << 62)))))
    ordered = rows.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "turn", "role", "text")
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.large_string()), ("tokens", pa.large_binary())])

    def run(batches):
        assembler = Assembler(tokenizer_path)
        for (conv, part), group in _groups(batches, ["conv_id", "part"]):
            formatted, ids, mask = assembler.assemble([(r["role"], r["text"]) for r in group])
            yield pa.record_batch([pa.array([v], f.type) for v, f in zip((conv, part, formatted, pack(ids, mask, compress=True)), schema)], schema=schema)

    return ordered.mapInArrow(run, PART_SCHEMA)


DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_digests(spark: SparkSession, path: str, tokenizer_path: str) -> DataFrame:
    """Per conversation, from the written parts alone: turns parsed from the
    formatted text, loss text decoded from the ids under the mask."""
    parts = spark.read.schema(PART_SCHEMA).parquet(path)
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches):
        assembler = Assembler(tokenizer_path)
        state = None

        def close(s):
            conv, n, turns, chars, loss, total = s
            return pa.record_batch([pa.array([v], f.type) for v, f in zip((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total), schema)], schema=schema)

        for b in batches:
            for r in range(b.num_rows):
                conv, _, formatted, tokens = (b.column(i)[r].as_py() for i in range(4))
                if state is None or state[0] != conv:
                    if state is not None:
                        yield close(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                for text in assembler.loss_texts(*unpack(tokens)):
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(formatted)
        if state is not None:
            yield close(state)

    return ordered.mapInArrow(run, DIGEST_SCHEMA)
