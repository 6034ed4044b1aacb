"""Vector bin packing of examples into training sequences (operator 3).

Three limits hold at once for every sequence: tokens, segments (pieces of examples) and loss-bearing tokens. A bin
is filled by the dot-product heuristic: of the waiting examples that fit whole, the one with the largest weighted
dot product of its demand with what the bin has left goes in. When none fits whole, the longest waiting one is cut
at the gap, so a sequence is left short only where a limit other than tokens is met, or where nothing is left. Such
a bin is dealt again into sequences of power-of-two length, which need no padding.

Packing is local to a partition: no shuffle, and a lost task packs the same rows again in the same way.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from rillsync.llm.subwords import encoder


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    loss_tokens: int = 1008
    #: Examples waiting for a bin at once; bounds a task's memory.
    waiting: int = 512


class Packer:
    """Feeds on examples (key, n tokens, index of the first loss-bearing token) and gives pieces
    (key, start, length, sequence, offset). Every token of every example is in exactly one piece."""

    def __init__(self, limits: Limits = Limits()):
        if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
            raise ValueError("the limits leave no room for a single token")
        self.limits = limits
        n = limits.waiting
        self.rest = np.zeros(n, np.int64)  # tokens not yet placed
        self.free = np.zeros(n, np.int64)  # of those, the ones before the first that bears loss
        self.start = np.zeros(n, np.int64)
        self.keys: list = [None] * n
        self.used = 0
        self.sequence = 0

    def add(self, key, n: int, loss_from: int = 0) -> Iterator[tuple]:
        start, cap = 0, self.limits
        while n - start >= cap.tokens and cap.tokens - min(max(loss_from - start, 0), cap.tokens) <= cap.loss_tokens:
            yield key, start, cap.tokens, self.sequence, 0  # a piece that fills a sequence by itself
            self.sequence += 1
            start += cap.tokens
        if n > start:
            i = self.used
            self.keys[i], self.rest[i], self.start[i] = key, n - start, start
            self.free[i] = min(max(loss_from - start, 0), n - start)
            self.used += 1
            if self.used == cap.waiting:
                while self.used > cap.waiting // 2:
                    yield from self._emit(self._bin())

    def _take(self, i: int, size: int, bin_: list) -> None:
        bin_.append((self.keys[i], int(self.start[i]), size))
        self.start[i] += size
        self.rest[i] -= size
        self.free[i] = max(self.free[i] - size, 0)
        if not self.rest[i]:
            last = self.used = self.used - 1
            for a in (self.rest, self.start, self.free):
                a[i] = a[last]
            self.keys[i], self.keys[last] = self.keys[last], None

    def _bin(self) -> list:
        cap, bin_ = self.limits, []
        left, segments, loss_left = cap.tokens, cap.segments, cap.loss_tokens
        while self.used and left and segments:
            n, free = self.rest[: self.used], self.free[: self.used]
            fits = (n <= left) & (n - free <= loss_left)
            # an example that fits no bin whole begins one, while others have the loss-free tokens to go with it
            long = not bin_ and n.max() > left and free.sum() >= cap.tokens - cap.loss_tokens
            # the last segment of a bin goes to whatever fills it best
            if not long and fits.any() and (segments > 1 or n[fits].max() == left):
                by_token, by_loss = left / cap.tokens**2, loss_left / cap.loss_tokens**2
                # demand times what is left, over the three limits; the segment's share is the same for all
                i = int(np.argmax(np.where(fits, n * (by_token + by_loss) - free * by_loss, -1.0)))
                size = int(n[i])
            else:
                room = np.minimum(np.minimum(n, left), free + loss_left)
                i = int(np.argmax(room))
                size = int(room[i])
                if not size:
                    break  # nothing but loss-bearing tokens waits
            loss_left -= max(0, size - int(self.free[i]))
            self._take(i, size, bin_)
            left, segments = left - size, segments - 1
        return bin_

    def _emit(self, bin_: list) -> Iterator[tuple]:
        """The bin as one sequence if it is full; else dealt into sequences of power-of-two length, without padding."""
        total = sum(size for *_, size in bin_)
        while total:
            goal = self.limits.tokens if total == self.limits.tokens else 1 << (total.bit_length() - 1)
            total -= goal
            offset = 0
            while offset < goal:
                key, start, size = bin_.pop(0)
                take = min(goal - offset, size)
                yield key, start, take, self.sequence, offset
                if take < size:
                    bin_.insert(0, (key, start + take, size - take))
                offset += take
            self.sequence += 1

    def finish(self) -> Iterator[tuple]:
        while self.used:
            yield from self._emit(self._bin())


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "loss_length long"
)


def prompt_end(ids: bytes, marks: list[bytes]) -> int:
    """Ids up to the first of these marks, that one included; 0 without any."""
    first = len(ids)
    for mark in marks:
        at = ids.find(mark)
        while at % 4 and at >= 0:  # the four bytes of two neighbouring ids
            at = ids.find(mark, at + 1)
        if 0 <= at < first:
            first = at
    return first // 4 + 1 if first < len(ids) else 0


def pack_documents(
    documents: DataFrame, vocabulary: str, end_id: int = 0, limits: Limits = Limits(), prompt: tuple[str, ...] = (".", "\n")
) -> DataFrame:
    """One row per piece of `documents` (doc_id, text), each document's ids closed by end_id.

    Instruction data bears loss from where its prompt ends: here the first line or sentence of a text, up to the
    first id of one of the strings in `prompt` (without any, or with an empty `prompt`, all tokens bear loss).
    loss_length counts a piece's loss-bearing tokens. A null text counts as empty: its one token is end_id. Rows are
    packed as they come, repeated rows and null ids included; other columns are ignored. An empty table gives no
    rows. sequence_id is the partition's number times 2**32 plus a count, so it is unique without a shuffle.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, packer, tool, kept, number = TaskContext.get().partitionId() << 32, Packer(limits), encoder(vocabulary), {}, 0
        end = int(end_id).to_bytes(4, "little")
        marks = [m for m in (tool.ids_of([p])[0] for p in prompt) if len(m) == 4]
        rows: list = []

        def record(pieces: Iterable[tuple]) -> None:
            for key, start, size, sequence, offset in pieces:
                doc_id, ids, left, loss_from = kept[key]
                crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + size)])
                loss = size - min(max(loss_from - start, 0), size)
                rows.append((doc_id, start, size, crc, len(ids) // 4, base + sequence, offset, loss))
                if left == size:
                    del kept[key]
                else:
                    kept[key] = (doc_id, ids, left - size, loss_from)

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=[c.split(" ")[0] for c in PIECES.split(", ")])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), tool.ids_of(texts), strict=True):
                    loss_from = prompt_end(ids, marks)
                    ids += end
                    kept[number] = (doc_id, ids, len(ids) // 4, loss_from)
                    record(packer.add(number, len(ids) // 4, loss_from))
                    number += 1
                if len(rows) >= 4096:
                    yield flush()
        record(packer.finish())
        if rows:
            yield flush()

    return documents.select(
        documents.doc_id.cast("long").alias("doc_id"), documents.text.alias("text")
    ).mapInArrow(run, PIECES)
