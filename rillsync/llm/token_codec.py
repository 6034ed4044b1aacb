"""Token ids in a compressed binary file (operator 9): an adaptive context-mixing range coder.

Ids are cut into blocks of up to 2**22, each reset and checksummed by itself, and coded over the block's own
alphabet. Three orders predict:

- order 2: a table by the last two ids holds the id that came next, with a count;
- order 1: a table by the last id holds the two ids that came next most, with counts;
- order 0: adaptive frequencies of all ids, in a few latent classes; a way codes with the class that has fitted its
  latest ids best, so the classes come to stand for what the corpus mixes (languages, say).

The predicted ids are tried one after another. The probability of a hit is mixed in the logistic domain from what
each order says about that id, by weights that learn; a miss of all is coded by the order-0 frequencies.

A block is coded in up to 4,096 ways, each a run of neighbouring ids with a range coder of its own. All ways share the
block's model and take a step at once, after which the model learns from all of them: every step is a handful of
numpy operations over the ways, for the coder and for the decoder. Arithmetic is on integers only, so any machine
decodes what another has written. Over tables TokenCodec.java codes and decodes, in the executors' JVM; a test holds its
segments against those of the coder here. The coder is a carry-less range coder on 64-bit registers that emits 16-bit words.

A segment holds whole documents, a directory of them and their blocks. Layout, little-endian: magic, blocks,
documents, directory bytes; directory (zlib: null marks, document ids, lengths); per block: ids, ways, alphabet bytes,
words, crc32 of the ids; then per block the alphabet (zlib: steps between its ids), words of each way, the words; at
the end the crc32 of all before.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillsync.llm import jvm
from rillsync.llm.common import materialize
from rillsync.llm.subwords import encoder

# Fixed values of the format.
MAGIC = b"RLSEG2\0\0"
BLOCK_IDS, SEGMENT_IDS = 1 << 22, 1 << 22
WAYS, WAY_IDS = 4096, 1024
CLASSES, STEP, FULL, EAGER = 6, 8, 1 << 18, 64
#: Ids of a block at most that are told apart: totals stay below 2**20, the least range a total may divide.
ALPHABET = 1 << 17
#: Below this, an id's place in the alphabet is looked up in a table.
DENSE = 1 << 24
_TOP, _BOT, _WORD = np.uint64(1 << 48), np.uint64(1 << 32), np.uint64(16)
_TOP_SHIFT = np.uint64(48)
_ONE = np.uint64(12)  # bits of a hit's probability


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic function of x / 256 in 12 bits for x in -2047..2047, its inverse, and 64 * log2(n), all by integers."""
    # e**(1/256) in 32 bits of fraction, raised by steps
    unit, power, squash = 4311778051, 1 << 32, [2048]
    for _ in range(2047):
        power = power * unit >> 32
        squash.append(min(4095, 4096 * power // (power + (1 << 32))))
    squash = np.array([*(max(1, 4096 - s) for s in squash[:0:-1]), *squash], np.int64)
    stretch = np.searchsorted(squash, np.arange(4096)).clip(0, len(squash) - 1) - 2047
    n = np.arange(FULL * 2, dtype=np.int64)
    high = np.zeros(len(n), np.int64)
    for e in range(1, 20):
        high[1 << e :] = e
    log = 64 * high + ((n << 6) >> high) - 64  # linear between powers of two
    return squash, stretch, log


_SQUASH, _STRETCH, _LOG = _tables()


class _Hits:
    """Probabilities of one candidate's hits: counts by two states, mixed with the order-0 probability."""

    def __init__(self, first: int, second: int):
        self.hits = [np.ones(first, np.int64), np.ones(second, np.int64)]
        self.seen = [np.full(first, 3, np.int64), np.full(second, 3, np.int64)]
        self.weights = np.array([26000, 20000, 20000], np.int64)

    def mix(self, first: np.ndarray, second: np.ndarray, order0: np.ndarray) -> np.ndarray:
        said = [_STRETCH[h * 4096 // s] for h, s in zip(self.hits, self.seen, strict=True)]
        self.at = first, second
        self.said = said[0][first], said[1][second], _STRETCH[order0]
        w = self.weights
        total = (self.said[0] * w[0] + self.said[1] * w[1] + self.said[2] * w[2]) >> 16
        self.p = _SQUASH[total.clip(-2047, 2047) + 2047]
        return self.p

    def learn(self, tried: np.ndarray, hit: np.ndarray) -> None:
        """hit: 0 or 1 of each way; only ways in which the candidate was tried teach."""
        n = int(tried.sum())
        if not n:
            return
        for k, at in enumerate(self.at):
            size = len(self.hits[k])
            self.hits[k] += np.bincount(at, hit, size).astype(np.int64)
            self.seen[k] += np.bincount(at, tried, size).astype(np.int64)
            if (full := self.seen[k] > 1 << 14).any():
                self.hits[k][full] = (self.hits[k][full] + 1) >> 1
                self.seen[k][full] = (self.seen[k][full] + 3) >> 1
        error = ((hit << 12) - self.p) * tried
        for i in range(3):
            self.weights[i] += int(error @ self.said[i]) * 64 // (n << 13)


class _Model:
    """What coder and decoder share: predictions over the ways, and what they learn from a step. Ids are places in
    the block's alphabet."""

    def __init__(self, ways: int, alphabet: int, ids: int):
        self.size = alphabet
        spread = np.arange(CLASSES * alphabet, dtype=np.int64) * 2654435761 >> 11
        self.counts = 1 + (spread & 1)  # classes begin a little unlike, so that they can part
        self.scores, self.turn = np.zeros((CLASSES, ways), np.int64), 0
        self.mask = (1 << min(20, max(10, ids.bit_length()))) - 1
        self.t2, self.n2 = np.full(self.mask + 1, -1, np.int64), np.zeros(self.mask + 1, np.int64)
        self.t1, self.n1 = np.full(2 * alphabet, -1, np.int64), np.zeros(2 * alphabet, np.int64)
        self.a, self.b = np.zeros(ways, np.int64), np.zeros(ways, np.int64)
        self.hits = [_Hits(16, 32), _Hits(256, 16), _Hits(256, 16)]
        self.base = np.arange(CLASSES, dtype=np.int64) * alphabet

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For the first n ways: the candidates (-1: none) and the cumulated probabilities, of 4096, up to each."""
        a, b, size = self.a[:n], self.b[:n], self.size
        self.flat = self.counts.cumsum()
        ends = self.flat[size - 1 :: size]
        self.below = np.append(0, ends[:-1])
        self.totals = ends - self.below
        self.cls, best = np.zeros(n, np.int64), self.scores[0, :n]
        for c in range(1, CLASSES):
            better = self.scores[c, :n] > best
            self.cls[better] = c
            best = np.maximum(best, self.scores[c, :n])
        self.h2 = ((a * 0x9E3779B1 + b * 0x85EBCA6B) >> 5) & self.mask
        self.s0, self.s1 = 2 * a, 2 * a + 1
        c2, c1, c0 = self.t2[self.h2], self.t1[self.s0], self.t1[self.s1]
        m2, m1, m0 = self.n2[self.h2], self.n1[self.s0], self.n1[self.s1]
        known2 = np.minimum(m2, 15)
        sum1 = _LOG[np.minimum(m1 + m0 + 1, 1 << 15)] >> 6
        c1 = np.where(c1 == c2, -1, c1)
        c0 = np.where(c0 == c2, -1, c0)
        same = np.where(c1 < 0, m1, np.where(c0 < 0, m0, 0))
        states = (
            (known2, np.minimum(same, 15) + 16 * (c1 < 0)),
            (np.minimum(_LOG[np.minimum(m1 + 1, 1 << 15)] >> 6, 15) * 16 + np.minimum(sum1, 15), known2),
            (np.minimum(_LOG[np.minimum(m0 + 1, 1 << 15)] >> 6, 15) * 16 + np.minimum(sum1, 15), known2),
        )
        own, total = self.base[self.cls], self.totals[self.cls]
        upto, left, self.tried = [], np.full(n, 4096, np.int64), []
        for k, (hits, c, (x, y)) in enumerate(zip(self.hits, (c2, c1, c0), states, strict=True)):
            there = c >= 0
            p0 = (self.counts[own + c] * 4096 // total).clip(1, 4095)
            # no outcome that can follow is left without a share
            share = np.minimum(np.maximum((left * hits.mix(x, y, p0)) >> 12, 1), left - 3 + k)
            left = left - np.where(there, share, 0)
            upto.append(left)
            self.tried.append(there)
        self.candidates = np.stack([c2, c1, c0])
        return self.candidates, 4096 - np.stack(upto)

    def learn(self, x: np.ndarray, event: np.ndarray) -> None:
        """x: the ids of the step; event: 0 to 2 for the candidate that was right, 3 for none."""
        n = len(x)
        self.turn += 1
        if self.turn <= EAGER or self.turn & 1:  # what is learnt about hits and classes soon holds
            for k, hits in enumerate(self.hits):
                hits.learn((self.tried[k] & (event >= k)).astype(np.int64), (event == k).astype(np.int64))
            shift = max(0, int(self.totals.max()).bit_length() - 18)
            for c in range(CLASSES):
                freq = self.counts[self.base[c] + x]
                fit = _LOG[np.maximum(freq >> shift, 1) if shift else freq]
                was = self.scores[c, :n]
                was += fit - (was >> 3) - _LOG[max(int(self.totals[c]) >> shift, 1)]
        miss = event == 3
        np.add.at(self.counts, self.base[self.cls[miss]] + x[miss], STEP)
        if (full := self.totals > FULL + 2 * self.size).any():
            wide = self.counts.reshape(CLASSES, self.size)
            wide[full] = (wide[full] + 1) >> 1
        # order 2: one place, which gives way when its count is used up
        hit = self.candidates[0] == x
        self.n2[self.h2] = np.where(hit, np.minimum(self.n2[self.h2] + 1, 255), np.maximum(self.n2[self.h2] - 1, 0))
        free = self.n2[self.h2] == 0
        at = self.h2[free]
        self.t2[at], self.n2[at] = x[free], 1
        # order 1: two places, the weaker of which gives way
        first, second = self.t1[self.s0] == x, self.t1[self.s1] == x
        np.add.at(self.n1, np.concatenate([self.s0[first], self.s1[second]]), 1)
        none = ~(first | second)
        s0, s1, new = self.s0[none], self.s1[none], x[none]
        weak = np.where(self.n1[s0] <= self.n1[s1], s0, s1)
        self.n1[weak] = np.maximum(self.n1[weak] - 1, 0)
        free = self.n1[weak] == 0
        at = weak[free]
        self.t1[at], self.n1[at] = new[free], 1
        self.b[:n] = self.a[:n]
        self.a[:n] = x


def _renew(low: np.ndarray, rng: np.ndarray) -> np.ndarray:
    """Ways that are due to pass a word; where the range is small and the top bits differ, it is cut short."""
    same = (low ^ (low + rng)) < _TOP
    small = ~same & (rng < _BOT)
    if small.any():
        rng[small] = (np.uint64(0) - low[small]) & (_BOT - np.uint64(1))
    return np.flatnonzero(same | small)


def _shape(n: int) -> np.ndarray:
    """Ids of each way of a block of n ids, falling."""
    ways = max(1, min(WAYS, n // WAY_IDS))
    return n // ways + (np.arange(ways) < n % ways)


def _runs(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """For each step: where the ways' ids lie in the block, and how many ways take part."""
    first = np.cumsum(sizes) - sizes
    for t in range(int(sizes[0])):
        n = int(np.searchsorted(-sizes, -t, "left"))
        yield first[:n] + t, n


def _code_block(x: np.ndarray, alphabet: int) -> list[np.ndarray]:
    """The words of each way; x are places in the alphabet."""
    sizes = _shape(len(x))
    ways = len(sizes)
    m = _Model(ways, alphabet, len(x))
    low, rng = np.zeros(ways, np.uint64), np.full(ways, (1 << 64) - 1, np.uint64)
    words, at = np.zeros((ways, 3 * int(sizes[0]) + 8), np.uint16), np.zeros(ways, np.int64)
    for places, n in _runs(sizes):
        v = x[places]
        candidates, upto = m.predict(n)
        right = candidates == v
        event = np.where(right.any(0), right.argmax(0), 3)
        lane = np.arange(n)
        start = np.where(event > 0, upto[np.maximum(event, 1) - 1, lane], 0)
        end = np.where(event < 3, upto[np.minimum(event, 2), lane], 4096)
        r = rng[:n] >> _ONE
        lo, ra = low[:n] + start.astype(np.uint64) * r, (end - start).astype(np.uint64) * r
        miss = np.flatnonzero(event == 3)
        if len(miss):
            own, c = m.base[m.cls[miss]] + v[miss], m.cls[miss]
            freq = m.counts[own]
            q = ra[miss] // m.totals[c].astype(np.uint64)
            lo[miss] += (m.flat[own] - freq - m.below[c]).astype(np.uint64) * q
            ra[miss] = freq.astype(np.uint64) * q
        due = _renew(lo, ra)
        while len(due):
            words[due, at[due]] = (lo[due] >> _TOP_SHIFT).astype(np.uint16)
            at[due] += 1
            l2, r2 = lo[due] << _WORD, ra[due] << _WORD
            more = _renew(l2, r2)
            lo[due], ra[due] = l2, r2
            due = due[more]
        low[:n], rng[:n] = lo, ra
        m.learn(v, event)
    # a number with 32 low zero bits lies in every range that is left
    last = (low + (_BOT - np.uint64(1))) >> np.uint64(32)
    lane = np.arange(ways)
    for shift in (16, 0):
        words[lane, at] = (last >> np.uint64(shift)).astype(np.uint16)
        at += 1
    return [words[i, : at[i]] for i in range(ways)]


def _decode_block(words: np.ndarray, lengths: np.ndarray, n_ids: int, alphabet: int) -> np.ndarray:
    sizes = _shape(n_ids)
    ways = len(sizes)
    m, x = _Model(ways, alphabet, n_ids), np.zeros(n_ids, np.int64)
    # every way's words stand in a row of their own, followed by zeros
    rows = np.zeros((ways, int(lengths.max()) + 6), np.uint64)
    rows[np.arange(rows.shape[1]) < lengths[:, None]] = words
    low, rng = np.zeros(ways, np.uint64), np.full(ways, (1 << 64) - 1, np.uint64)
    value, at = np.zeros(ways, np.uint64), np.full(ways, 4, np.int64)
    for k in range(4):
        value = (value << _WORD) | rows[:, k]
    top = rows.shape[1] - 1
    for places, n in _runs(sizes):
        candidates, upto = m.predict(n)
        r = rng[:n] >> _ONE
        place = np.minimum((value[:n] - low[:n]) // r, np.uint64(4095)).astype(np.int64)
        event = (place >= upto).sum(0)
        lane = np.arange(n)
        start = np.where(event > 0, upto[np.maximum(event, 1) - 1, lane], 0)
        end = np.where(event < 3, upto[np.minimum(event, 2), lane], 4096)
        v = candidates[np.minimum(event, 2), lane]
        lo, ra = low[:n] + start.astype(np.uint64) * r, (end - start).astype(np.uint64) * r
        miss = np.flatnonzero(event == 3)
        if len(miss):
            c = m.cls[miss]
            total = m.totals[c]
            q = ra[miss] // total.astype(np.uint64)
            place = np.minimum(((value[miss] - lo[miss]) // q).astype(np.int64), total - 1)
            own = np.minimum(np.searchsorted(m.flat, m.below[c] + place, "right"), len(m.flat) - 1)
            v[miss] = own - m.base[c]
            freq = m.counts[own]
            lo[miss] += (m.flat[own] - freq - m.below[c]).astype(np.uint64) * q
            ra[miss] = freq.astype(np.uint64) * q
        due = _renew(lo, ra)
        while len(due):
            value[due] = (value[due] << _WORD) | rows[due, np.minimum(at[due], top)]
            at[due] += 1
            l2, r2 = lo[due] << _WORD, ra[due] << _WORD
            more = _renew(l2, r2)
            lo[due], ra[due] = l2, r2
            due = due[more]
        low[:n], rng[:n] = lo, ra
        v = np.clip(v, 0, alphabet - 1)  # damaged words lead anywhere; the checksum tells
        x[places] = v
        m.learn(v, event)
    return x


def _alphabet(ids: np.ndarray) -> np.ndarray:
    """The ids that occur, ascending."""
    if len(ids) and int(ids.max()) < DENSE:
        there = np.zeros(int(ids.max()) + 1, bool)
        there[ids] = True
        return np.flatnonzero(there)
    return np.unique(ids)


def code_block(ids: np.ndarray) -> tuple[bytes, bytes]:
    """(head, body) of one block of ids, at least one of them."""
    alphabet = _alphabet(ids)
    if int(alphabet[-1]) < DENSE:
        place = np.zeros(int(alphabet[-1]) + 1, np.int64)
        place[alphabet] = np.arange(len(alphabet))
        words = _code_block(place[ids], len(alphabet))
    else:
        words = _code_block(np.searchsorted(alphabet, ids), len(alphabet))
    letters = zlib.compress(np.diff(alphabet.astype("<u4"), prepend=np.uint32(0)).astype("<u4").tobytes(), 6)
    lengths = np.array([len(w) for w in words], "<u4")
    head = struct.pack(
        "<IIIII", len(ids), len(words), len(letters), int(lengths.sum()), zlib.crc32(ids.astype("<u4").tobytes())
    )
    return head, b"".join([letters, lengths.tobytes(), np.concatenate(words).astype("<u2").tobytes()])


def decode_block(head: bytes, body: memoryview) -> np.ndarray:
    n, ways, size, n_words, crc = struct.unpack("<IIIII", head)
    alphabet = np.cumsum(np.frombuffer(zlib.decompress(body[:size]), "<u4"), dtype=np.uint32)
    lengths = np.frombuffer(body, "<u4", ways, size).astype(np.int64)
    words = np.frombuffer(body, "<u2", n_words, size + 4 * ways)
    ids = alphabet[_decode_block(words, lengths, n, len(alphabet))]
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("a damaged block")
    return ids


def _directory(doc_ids: list[int | None], lengths: list[int]) -> bytes:
    null = np.array([i is None for i in doc_ids], np.uint8).tobytes()
    names = np.array([i or 0 for i in doc_ids], "<i8").tobytes()
    return null + names + np.array(lengths, "<u8").tobytes()


def pack_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """One segment of documents with so many ids each."""
    directory = zlib.compress(_directory(doc_ids, lengths), 6)
    size_ids = BLOCK_IDS if len(_alphabet(ids)) <= ALPHABET else min(ALPHABET, BLOCK_IDS)
    blocks = [code_block(ids[at : at + size_ids]) for at in range(0, len(ids), size_ids)]
    head = MAGIC + struct.pack("<III", len(blocks), len(doc_ids), len(directory))
    out = b"".join([head, directory, *(h for h, _ in blocks), *(b for _, b in blocks)])
    return out + struct.pack("<I", zlib.crc32(out))


def unpack_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, lengths, all ids); an error where a checksum does not hold."""
    if data[:8] != MAGIC or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("a damaged segment")
    n_blocks, n_docs, size = struct.unpack_from("<III", data, 8)
    directory = zlib.decompress(data[20 : 20 + size])
    null, doc_ids = np.frombuffer(directory, np.uint8, n_docs), np.frombuffer(directory, "<i8", n_docs, n_docs)
    lengths = np.frombuffer(directory, "<u8", n_docs, 9 * n_docs).astype(np.int64)
    view, at, parts = memoryview(data), 20 + size + 20 * n_blocks, []
    for k in range(n_blocks):
        head = data[20 + size + 20 * k : 40 + size + 20 * k]
        _, ways, letters, n_words, _ = struct.unpack("<IIIII", head)
        end = at + letters + 4 * ways + 2 * n_words
        parts.append(decode_block(head, view[at:end]))
        at = end
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    return [None if z else int(i) for z, i in zip(null, doc_ids, strict=True)], lengths, flat


_PACK, _UNPACK = "rillsync_pack_segment", "rillsync_unpack_segment"


def _with_functions(spark: SparkSession) -> None:
    """Registers _PACK(ids, directory, documents) and _UNPACK(segment), which gives the segment's documents."""
    documents = "array<struct<doc_id: bigint, at: bigint, n_tokens: bigint, ids_crc32: bigint>>"
    jvm.register(
        spark, "TokenCodec.java", **{
            _PACK: ("rillsync.llm.TokenCodec$Pack", "binary"), _UNPACK: ("rillsync.llm.TokenCodec$Unpack", documents)
        }
    )


def encode_documents(documents: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    """Segments (part, segment, before: ids of the part before it, n_ids, data) of all documents in ascending doc_id order: part, then segment.

    A null text counts as empty: its one id is end_id. Null doc_ids come first. Rows that repeat a doc_id are
    documents of their own, by text. Other columns are ignored; an empty table gives no segments. Texts are encoded
    whole; a document longer than a segment makes a longer one.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part, segment = encoder(vocabulary), TaskContext.get().partitionId(), 0
        kinds = pa.schema([
            ("part", pa.int32()), ("segment", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
            ("documents", pa.int32()), ("directory", pa.binary()), ("ids", pa.binary()),
        ])
        end = int(end_id).to_bytes(4, "little")
        names: list = []
        held: list[bytes] = []
        total = before = 0

        def flush() -> pa.RecordBatch:
            row = (part, segment, before, total, len(names), _directory(names, [len(h) // 4 for h in held]), b"".join(held))
            out = pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, kinds, strict=True)], schema=kinds)
            names.clear(), held.clear()
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                for i, ids in zip(
                    piece.column(0).to_pylist(), tool.ids_of([t or "" for t in piece.column(1).to_pylist()]),
                    strict=True
                ):
                    names.append(i)
                    held.append(ids + end)
                    total += len(ids) // 4 + 1
                    if total >= SEGMENT_IDS:
                        yield flush()
                        segment, before, total = segment + 1, before + total, 0
        if names:
            yield flush()

    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text"
    ).repartitionByRange(partitions, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    _with_functions(documents.sparkSession)
    raw = ordered.mapInArrow(
        run, "part int, segment int, before long, n_ids long, documents int, directory binary, ids binary"
    )
    data = F.call_function(_PACK, "ids", "directory", "documents").alias("data")
    return raw.select("part", "segment", "before", "n_ids", data)


def write_ids(documents: DataFrame, path: str, vocabulary: str, end_id: int = 1) -> None:
    """Write the segments as files under path, a container file per part."""
    encode_documents(documents, vocabulary, end_id).write.parquet(path)


def read_segments(segments: DataFrame) -> DataFrame:
    """Per document, decoded from the segments: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    spark = segments.sparkSession
    starts, total = [], 0
    for r in segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():  # a row per partition
        starts.append((r.part, total))
        total += r.n
    bases = F.broadcast(spark.createDataFrame(starts, "part int, base long"))

    _with_functions(spark)
    decoded = segments.select("part", "before", F.explode(F.call_function(_UNPACK, "data")).alias("d"))
    decoded = decoded.select("part", "d.doc_id", (F.col("before") + F.col("d.at")).alias("at"), "d.n_tokens", "d.ids_crc32")
    return decoded.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(documents: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    """Write the documents' ids in the file format to the shared folder and read them back."""
    return read_segments(materialize(encode_documents(documents, vocabulary, end_id), "ids"))
