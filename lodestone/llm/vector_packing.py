"""Vector bin packing of training examples by the dot-product heuristic.

An example is a prompt, which bears no loss, and a response with its end id, which does. A sequence holds
pieces of examples under three limits at once: tokens, pieces (segments of the attention mask) and
loss-bearing tokens. Sequences are filled one after another. Of the examples that still fit whole, the
next is that whose demand has the largest dot product with the room that is left, each dimension as a share
of its limit and weighted by what all waiting examples ask of it. Where none fits whole, the best one is cut
to fill the rest. A sequence that a limit closes before it is full is cut back to a power of two, and what it
gives up waits on; so a sequence is full or its length is a power of two, and none is padded.

Packing needs no shuffle of texts. A task encodes its documents as they come and packs a bounded window of
them at a time, while the ids are at hand. What a task can't fill, less than a sequence, goes on with its
ids to a second round, in which leftovers of all tasks are packed alike; only there the last sequence of
each task is split into powers of two.

Defined results: a null or empty text is one end id, which bears loss; a null prompt is empty; repeated
rows are packed as often as they stand there; a null doc_id is kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import Scratch, tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
LENGTH, END_ID = 2048, 1
#: Pieces that a sequence holds at most.
SEGMENTS = 256
#: Examples, and ids, that a task holds at a time, about.
WINDOW_EXAMPLES, WINDOW_IDS = 4096, 8 << 20
#: Leftover pieces that a task of the second round packs, about.
SECOND_ROUND = 4096

_PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, sequence_id long, offset long"
_OPEN = f"{_PLACED}, ids binary"
_KINDS = ("int64",) * 8
_NAMES = [c.split(" ")[0] for c in _PLACED.split(", ")]


class Limits(NamedTuple):
    tokens: int = LENGTH
    segments: int = SEGMENTS
    loss: int = LENGTH


class Piece(NamedTuple):
    """Consecutive ids of a document: `silent` of them, the first, bear no loss."""

    doc_id: int | None
    start: int
    doc_tokens: int
    silent: int
    ids: bytes | memoryview

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    @property
    def loss(self) -> int:
        return self.length - self.silent

    def cut(self, at: int) -> tuple[Piece, Piece]:
        head = self._replace(silent=min(self.silent, at), ids=self.ids[: 4 * at])
        return head, self._replace(start=self.start + at, silent=self.silent - head.silent, ids=self.ids[4 * at :])

    def fitting(self, tokens: int, loss: int) -> int:
        """How many of the first ids fit into that room."""
        return min(self.length, tokens, self.silent + loss)


def _backed(placed: list[Piece]) -> tuple[list[Piece], list[Piece]]:
    """The pieces cut back to a power of two of ids, and what is given up."""
    left, out, rest = 1 << (sum(p.length for p in placed).bit_length() - 1), [], []
    for p in placed:
        if p.length <= left:
            out.append(p)
        elif left:
            head, tail = p.cut(left)
            out.append(head)
            rest.append(tail)
        else:
            rest.append(p)
        left -= min(left, p.length)
    return out, rest


def fill(pieces: list[Piece], limits: Limits, last: bool) -> Iterator[tuple[list[Piece], bool]]:
    """Sequences of all pieces, and whether each is finished; without `last`, one that only lacks pieces is not."""
    cap = np.array(limits, float)
    held = [p for p in pieces]
    size = np.array([(p.length, 1, p.loss) for p in held], np.int64).reshape(-1, 3)
    alive = np.ones(len(held), bool)
    while alive.any():
        # Dead rows go now and then, so a pick costs what still waits.
        if len(alive) > 64 and 2 * alive.sum() < len(alive):
            keep = np.flatnonzero(alive)
            held, size, alive = [held[i] for i in keep], size[keep], np.ones(len(keep), bool)
        asked = size[alive].sum(0) / cap
        weight = asked / asked.sum() / cap**2
        room, sequence = np.array(limits, np.int64), []
        while room.min() >= 0 and room[0] and room[1]:
            fits = alive & (size[:, 0] <= room[0]) & (size[:, 2] <= room[2])
            score = size @ (weight * room)
            if fits.any():
                i = int(np.where(fits, score, -1.0).argmax())
                sequence.append(held[i])
                room -= size[i]
                alive[i] = False
                continue
            # No example fits whole: cut the one that fills most, and of these the one that fits best.
            part = np.minimum(np.minimum(size[:, 0], room[0]), size[:, 0] - size[:, 2] + room[2])
            part[~alive] = 0
            if not part.any():
                break
            most = part == part.max()
            i = int(np.where(most, score, -1.0).argmax())
            head, tail = held[i].cut(held[i].fitting(int(room[0]), int(room[2])))
            sequence.append(head)
            room -= (head.length, 1, head.loss)
            held[i], size[i] = tail, (tail.length, 1, tail.loss)
        if not room[0]:
            yield sequence, True
        elif not alive.any() and not last:
            yield sequence, False
        else:
            out, rest = _backed(sequence)
            yield out, True
            if rest:
                held += rest
                size = np.concatenate([size, [(p.length, 1, p.loss) for p in rest]])
                alive = np.concatenate([alive, np.ones(len(rest), bool)])


class _Rows:
    """Sequences as rows of _OPEN; those of an unfinished one carry their ids and no sequence."""

    def __init__(self, task: int):
        self.next, self.rows = task << 40, []

    def add(self, sequence: list[Piece], finished: bool) -> None:
        offset = 0
        for p in sequence:
            row = (p.doc_id, p.start, p.length, tokens.crc(p.ids), p.doc_tokens, p.loss)
            self.rows.append((*row, self.next, offset, None) if finished else (*row, None, None, bytes(p.ids)))
            offset += p.length
        self.next += finished

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * 9
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (*_KINDS, "binary"), strict=True)], [*_NAMES, "ids"])


def pack(examples: DataFrame, scratch: Scratch, limits: Limits = Limits(), path: str | None = None, end_id: int = END_ID, window: int = WINDOW_EXAMPLES) -> DataFrame:
    """Packed pieces of examples (doc_id, text, and perhaps prompt): doc_id, start, length, ids_crc32, doc_tokens, loss_tokens, sequence_id, offset.

    A prompt stands before the text and bears no loss; `start` counts its ids too.
    """
    if min(limits) < 1:
        raise ValueError("each limit must be 1 or more")
    path = path or tokenizer_path(TOKENIZER)
    end = np.array([end_id], "<u4").tobytes()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, rows, waiting, n = tokens.byte_encoder(path), _Rows(TaskContext.get().partitionId()), [], 0
        for batch in batches:
            for doc_id, text, prompt in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                before = encode(prompt)
                ids = before + encode(text) + end
                # A view: cutting a long document copies nothing.
                waiting.append(Piece(doc_id, 0, len(ids) // 4, len(before) // 4, memoryview(ids)))
                n += len(ids) // 4
                if len(waiting) >= window or n >= WINDOW_IDS:
                    over: list[Piece] = []
                    for sequence, finished in fill(waiting, limits, False):
                        rows.add(sequence, True) if finished else over.extend(sequence)
                    waiting, n = over, sum(p.length for p in over)
                    yield rows.batch()
        for sequence, finished in fill(waiting, limits, False):
            rows.add(sequence, finished)
        yield rows.batch()

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Above the numbers of the first round.
        rows, held = _Rows((1 << 22) + TaskContext.get().partitionId()), []
        for batch in batches:
            for doc_id, start, length, doc_tokens, loss, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(Piece(doc_id, start, doc_tokens, length - loss, ids))
        held.sort(key=lambda p: (p.doc_id is None, p.doc_id or 0, p.start, p.doc_tokens, p.ids))
        for sequence, finished in fill(held, limits, True):
            rows.add(sequence, finished)
        yield rows.batch()

    prompt = F.col("prompt") if "prompt" in examples.columns else F.lit(None)
    given = examples.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), prompt.cast("string").alias("prompt"))
    stored = scratch.table("placed", given.mapInArrow(first, _OPEN))
    placed, left = stored.filter("sequence_id is not null").drop("ids"), stored.filter("sequence_id is null")
    n = left.count()
    if not n:
        return placed
    # Less than a sequence of each task.
    again = left.select("doc_id", "start", "length", "doc_tokens", "loss_tokens", "ids").repartition(-(-n // SECOND_ROUND), "doc_id", "start", "ids_crc32")
    return placed.unionByName(scratch.table("left", again.mapInArrow(second, _OPEN)).drop("ids"))
