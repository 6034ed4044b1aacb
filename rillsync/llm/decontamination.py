"""Benchmark decontamination (operator 8).

Texts and benchmark items are sequences of words; an item leaks where a stretch of a text has a word edit distance
of at most a share of the item's words from it. The CGK random walk embeds a sequence so that edit distance becomes
Hamming distance: it writes a symbol at every step and goes on to the next one by a random bit of the step and the
symbol, so two walks fall into step again after an edit. Bit-sampling hashes of the embeddings, repeated over walks
and samples, are the index: an item's hashes are looked up by those of the windows of the item's size in a text, and
an exact edit distance against the stretch around each window that is found decides.

The number of hashes follows from a target recall: for every size, edited sequences are drawn with as many edits as
a leak may have, and hashes are added until that share of them meets in one hash at least.

Which windows are hashed: d edits spoil at most q times d of an item's runs of q words, and the others lie on
neighbouring diagonals, d apart at most; so a window is hashed where enough runs agree with an item of its size, and
starts where one of them puts the item's start. This loses no leak (a bound that holds for each), and most positions
of a text go without a walk; `sieve=False` hashes all.

The benchmark is dealt out in blocks of bounded size, each of which is sent to the executors for one scan of the
documents: what is broadcast is bounded however large the benchmark is.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillsync.llm.common import map_arrow, texts_of

SIMILARITY, RECALL = 0.8, 0.995
RUN = 3
#: Symbols in a hash, hashes of a walk, walks at most, and edited sequences drawn for a size.
SAMPLE, TABLES, WALKS, DRAWN = 2, 8, 8, 400
#: Hashes of an item at least, and the largest size for which their number is measured.
LEAST_TABLES, LARGEST = 16, 256
#: Bytes of benchmark text that are broadcast at once.
BLOCK_BYTES = 8_000_000
#: Rows of agreeing runs that are held at once.
HELD_RUNS = 4_000_000
_WORD = re.compile(r"\w+")
_MIX, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word)


def edits_allowed(n_words: int, similarity: float) -> int:
    return math.floor((1 - similarity) * n_words + 1e-9)


class _Same:
    """Lengths of common prefixes of item[i:] and text[j:], by prefix hashes and bisection."""

    def __init__(self, item: np.ndarray, text: np.ndarray):
        self.n, self.m = len(item), len(text)
        longest = max(self.n, self.m) + 1
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.r_[np.uint64(1), np.full(longest, _ODD)], dtype=np.uint64)
            self.sums = []
            for x in (item, text):
                y = (x ^ (x >> np.uint64(29))) * _MIX + np.uint64(1)
                # sums of y[k] * power[-k], as power's inverse is odd, too: here with the power of the place instead
                self.sums.append(np.r_[np.uint64(0), np.cumsum(y * self.power[: len(y)], dtype=np.uint64)])

    def prefix(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """i, j: places within bounds; the common length from there on."""
        a, b = self.sums
        low, high = np.zeros(len(i), np.int64), np.minimum(self.n - i, self.m - j)
        shift_i, shift_j = self.power[np.maximum(j - i, 0)], self.power[np.maximum(i - j, 0)]
        with np.errstate(over="ignore"):
            while (open_ := low < high).any():
                middle = (low + high + 1) >> 1
                same = (a[i + middle] - a[i]) * shift_i == (b[j + middle] - b[j]) * shift_j
                low = np.where(open_ & same, middle, low)
                high = np.where(open_ & ~same, middle - 1, high)
        return low


def nearest_stretch(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the stretch of the text nearest to the item, where at most `most` edits away; of
    equal ones, the first to end.

    For each number of edits and each diagonal, the furthest place of the item that is reached: work grows with the
    text's length times the edits, not with the item's length.
    """
    n, m = len(item), len(text)
    same = _Same(item, text)
    diagonal = np.arange(-most, m + 1)  # place in the text less place in the item
    far, start = np.full(len(diagonal), -1), np.full(len(diagonal), -1)
    free = diagonal >= 0  # a stretch may start anywhere
    far[free], start[free] = 0, diagonal[free]

    def slide(at: np.ndarray) -> None:
        i = far[at]
        far[at] = i + same.prefix(i, i + diagonal[at])

    slide(np.flatnonzero(free))
    for edits in range(most + 1):
        if (done := np.flatnonzero(far >= n)).size:
            at = int(done[0])  # the least diagonal ends first
            return edits, int(start[at]), int(n + diagonal[at])
        if edits == most:
            break
        changed = np.where(far >= 0, far + 1, -1)
        inserted = np.r_[-1, far[:-1]]  # a word of the text that the item lacks
        missing = np.r_[np.where(far[1:] >= 0, far[1:] + 1, -1), -1]
        best = np.maximum(np.maximum(changed, inserted), missing)
        origin = np.where(
            best == changed, start, np.where(best == inserted, np.r_[-1, start[:-1]], np.r_[start[1:], -1])
        )
        # an item whose first words are missing starts at the text's first word
        empty = (best < 0) & (diagonal == -edits - 1)
        best[empty], origin[empty] = edits + 1, 0
        best = np.minimum(best, np.minimum(n, m - diagonal))
        ok = (best >= 0) & (best + diagonal >= 0)
        far, start = np.where(ok, best, -1), np.where(ok, origin, -1)
        slide(np.flatnonzero(far >= 0))
    return None


class Embedding:
    """CGK walks over sequences of one size, and hashes of a few of the symbols they write."""

    def __init__(self, size: int, tables: int = 0, seed: int = 23):
        self.size, self.steps, self.tables = size, 3 * size, tables or WALKS * TABLES
        rng = np.random.default_rng([seed, size])
        self.salt = rng.integers(1, 2**63, (WALKS, min(self.steps, 4096)), np.uint64) | np.uint64(1)
        self.samples = (rng.random((WALKS, TABLES, SAMPLE)) * self.steps).astype(np.int64)

    def hashes(self, windows: np.ndarray) -> np.ndarray:
        """(windows, tables): the hashes of windows (count, size); 0 stands for words past a text's end."""
        count, n = windows.shape
        walks = -(-self.tables // TABLES)
        padded, rows = np.concatenate([windows, np.zeros((count, 1), np.uint64)], 1), np.arange(count)
        out, at = np.zeros((count, walks, TABLES), np.uint64), np.zeros((walks, count), np.int64)
        by_step = defaultdict(list)
        for w, t, s in np.ndindex(walks, TABLES, SAMPLE):
            by_step[int(self.samples[w, t, s])].append((w, t, np.uint64((s + 1) * int(_ODD) & 0xFFFFFFFFFFFFFFFF)))
        with np.errstate(over="ignore"):
            for j in range(max(by_step) + 1):
                symbol = padded[rows, at]
                for w, t, salt in by_step.get(j, ()):
                    out[:, w, t] = (out[:, w, t] * _MIX) ^ (symbol[w] + salt)
                mixed = (symbol ^ (symbol >> np.uint64(31))) * self.salt[:walks, j % self.salt.shape[1], None]
                at = np.minimum(at + (mixed >> np.uint64(63)).astype(np.int64), n)
            number = np.arange(walks * TABLES, dtype=np.uint64) + np.uint64(1)
            out ^= (number * np.uint64(0x94D049BB133111EB)).reshape(walks, TABLES)
        return out.reshape(count, -1)[:, : self.tables]

    def recall_by_tables(self, most: int, drawn: int = DRAWN) -> np.ndarray:
        """The share of sequences, edited `most` times, that meet their original in the first 1, 2, ... tables."""
        rng = np.random.default_rng(self.size)
        own = rng.integers(1, 2**63, self.size, np.uint64)
        near = np.zeros((drawn, most + 1, self.size), np.uint64)
        for k in range(drawn):
            x = own.tolist()
            for _ in range(most):
                place, kind = int(rng.integers(len(x))), int(rng.integers(3))
                new = [] if kind == 2 and len(x) > 1 else [int(rng.integers(1, 2**63))]
                x[place : place + (kind != 1)] = new
            x += rng.integers(1, 2**63, most + self.size, np.uint64).tolist()
            for a in range(most + 1):
                near[k, a] = x[a : a + self.size]
        met = self.hashes(near.reshape(-1, self.size)) == self.hashes(own[None])[0]
        return np.logical_or.accumulate(met.reshape(drawn, most + 1, -1).any(1), 1).mean(0)


_TABLES: dict[tuple[int, float, float], int] = {}


def tables_for(size: int, similarity: float, recall: float) -> int:
    """Hashes for items of a size: the fewest, but LEAST_TABLES, with which the share of edited sequences that meet
    their original reaches the recall. Sizes are rounded up to powers of 1.5, and beyond LARGEST down to that."""
    step = 6
    while step < min(size, LARGEST):
        step = min(LARGEST, step + step // 2)
    key = step, similarity, recall
    if key not in _TABLES:
        share = Embedding(step).recall_by_tables(edits_allowed(step, similarity))
        enough = np.flatnonzero(share >= recall)
        _TABLES[key] = max(LEAST_TABLES, int(enough[0]) + 1) if len(enough) else len(share)
    return _TABLES[key]


class Index:
    """A block of the benchmark: the hash tables of its items by size, and its runs of words."""

    def __init__(
        self, items: list[tuple[int, str]], similarity: float = SIMILARITY, recall: float = RECALL, sieve: bool = True
    ):
        found = [(i, words(t)) for i, t in items]
        found = [(i, w) for i, w in found if w]
        self.items = [(i, np.array([word_hash(x) for x in w], np.uint64)) for i, w in found]
        self.size = np.array([len(w) for _, w in found], np.int64)
        self.most = np.array([edits_allowed(len(w), similarity) for _, w in found], np.int64)
        self.sieve, self.bias = sieve, int(self.size.max(initial=0))
        self.tables: dict[int, tuple[Embedding, np.ndarray, np.ndarray]] = {}
        for n in np.unique(self.size).tolist():
            mine = np.flatnonzero(self.size == n)
            walk = Embedding(n, tables_for(n, similarity, recall))
            keys = walk.hashes(np.stack([self.items[k][1] for k in mine]))
            owner, flat = np.repeat(mine, keys.shape[1]), keys.ravel()
            order = np.argsort(flat, kind="stable")
            self.tables[n] = walk, flat[order], owner[order]
        self.lexicon: dict[str, int] = {}
        self.least = np.zeros(len(found), np.int64)  # runs that must agree
        runs: dict[int, list[np.ndarray]] = defaultdict(list)  # by q: rows of number, item, offset
        for k, (_, w) in enumerate(found):
            own = np.array([self.lexicon.setdefault(x, len(self.lexicon) + 1) for x in w], np.uint64)
            n, most = len(w), int(self.most[k])
            q = min(RUN, -(-(n - most) // (most + 1)))
            self.least[k] = max(1, n - q + 1 - q * most)
            offsets = np.arange(n - q + 1)
            runs[q].append(
                np.stack([self._number(own, offsets, q).view(np.int64), np.full(len(offsets), k), offsets], 1)
            )
        self.runs = {}
        for q, parts in runs.items():
            table = np.concatenate(parts)
            table = table[np.lexsort((table[:, 2], table[:, 1], table[:, 0]))]
            numbers, place = np.unique(table[:, 0], return_inverse=True)
            # place and item in one number, so that the rows of a range of items are found by bisection
            self.runs[q] = numbers, place * (len(found) + 1) + table[:, 1], table[:, 1], table[:, 2]

    @staticmethod
    def _number(ids: np.ndarray, at: np.ndarray, q: int) -> np.ndarray:
        """A hash of the run of q words from each place on; runs that clash cost a window, nothing else."""
        out = np.zeros(len(at), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(q):
                out = (out ^ (ids[at + k] * _ODD)) * _MIX
        return out ^ (out >> np.uint64(32))

    def _expanded(
        self, table, at: np.ndarray, place: np.ndarray, low: int, high: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places of the text, rows of the table) of runs that agree, for all items from low to high in ranges with
        bounded numbers of them."""
        _, keys, _, _ = table
        span = len(self.items) + 1
        first, last = np.searchsorted(keys, place * span + low), np.searchsorted(keys, place * span + high)
        times = last - first
        total = int(times.sum())
        if total > HELD_RUNS and high - low > 1:
            middle = (low + high) // 2
            yield from self._expanded(table, at, place, low, middle)
            yield from self._expanded(table, at, place, middle, high)
        elif total:
            row = np.repeat(first + times - np.cumsum(times), times) + np.arange(total)
            yield np.repeat(at, times), row

    def _sieved(self, ids: np.ndarray, starts: np.ndarray) -> dict[tuple[int, int], set[int]]:
        """For (text, size): the starts of windows, in the text's words, at which an item of the size can leak."""
        out: dict[tuple[int, int], set[int]] = defaultdict(set)
        span = len(self.items)
        for q, table in self.runs.items():
            n = len(ids) - q + 1
            if n < 1:
                continue
            ok = ids[:n] > 0
            for k in range(1, q):
                ok &= ids[k : n + k] > 0
            at = np.flatnonzero(ok)
            number = self._number(ids.astype(np.uint64), at, q).view(np.int64)
            place = np.minimum(np.searchsorted(table[0], number), len(table[0]) - 1)
            hit = table[0][place] == number
            at, place = at[hit], place[hit]
            if not len(at):
                continue
            for places, row in self._expanded(table, at, place, 0, span):
                item = table[2][row]
                text = np.searchsorted(starts, places, "right") - 1
                diagonal = places - starts[text] - table[3][row] + self.bias
                pair = text * span + item
                order = np.lexsort((diagonal, pair))
                pair, diagonal, item = pair[order], diagonal[order], item[order]
                key = (pair << np.int64(32)) + diagonal
                agree = np.searchsorted(key, key + self.most[item], "right") - np.arange(len(key))
                # from a diagonal that has enough runs on the next ones on, all of them are starts
                good = np.flatnonzero(agree >= self.least[item])
                step = np.zeros(len(key) + 1, np.int64)
                np.add.at(step, good, 1)
                np.add.at(step, good + agree[good], -1)
                chosen = np.flatnonzero(np.cumsum(step[:-1]) > 0)
                for p, d, k in zip(
                    pair[chosen].tolist(), diagonal[chosen].tolist(), item[chosen].tolist(), strict=True
                ):
                    out[p // span, int(self.size[k])].add(d - self.bias)
        return out

    def _all(self, sizes: list[int]) -> dict[tuple[int, int], set[int]]:
        return {(t, n): set(range(max(1, size - n + 1))) for t, size in enumerate(sizes) if size for n in self.tables}

    def candidates(self, text: np.ndarray, size: int, starts: list[int]) -> dict[int, list[int]]:
        """The items of the size whose hash tables meet a window of the text, and where these windows start."""
        walk, keys, owner = self.tables[size]
        windows = np.zeros((len(starts), size), np.uint64)
        for r, p in enumerate(starts):
            part = text[p : p + size]
            windows[r, : len(part)] = part
        found: dict[int, list[int]] = defaultdict(list)
        hashes = walk.hashes(windows)
        first, last = np.searchsorted(keys, hashes, "left"), np.searchsorted(keys, hashes, "right")
        for r, t in zip(*np.nonzero(last > first), strict=True):
            for k in np.unique(owner[first[r, t] : last[r, t]]).tolist():
                if not found[k] or found[k][-1] != starts[r]:
                    found[k].append(starts[r])
        return found

    def leaks(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, distance, first word, end word) of the nearest stretch of each item that leaks into a text."""
        if not self.items:
            return []
        found = [words(t) for t in texts]
        get, sizes = self.lexicon.get, [len(f) for f in found]
        starts = np.cumsum([0, *[n + 1 for n in sizes]])
        if self.sieve:
            ids = np.zeros(int(starts[-1]), np.int64)
            for f, at in zip(found, starts.tolist(), strict=False):
                ids[at : at + len(f)] = [get(w, 0) for w in f]
            windows = self._sieved(ids, starts[:-1])
        else:
            windows = self._all(sizes)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        hashed: dict[int, np.ndarray] = {}
        for (text, size), places in windows.items():
            if text not in hashed:
                hashed[text] = np.array([word_hash(w) for w in found[text]], np.uint64)
            mine = hashed[text]
            places = sorted({max(0, min(p, max(0, len(mine) - size))) for p in places})
            for k, near in self.candidates(mine, size, places).items():
                most, seen = int(self.most[k]), -1
                for p in near:
                    if p + size + most <= seen:
                        continue  # what can match there lies inside the stretch already compared
                    lo, hi = max(0, p - 2 * most), min(len(mine), p + size + 3 * most)
                    seen = hi if hi < len(mine) else 2 * len(mine) + size + most
                    hit = nearest_stretch(self.items[k][1], mine[lo:hi], most)
                    if hit and ((text, k) not in best or hit[0] < best[text, k][0]):
                        best[text, k] = hit[0], lo + hit[1], lo + hit[2]
        return [(text, self.items[k][0], *hit) for (text, k), hit in sorted(best.items())]


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of so many bytes at most (or of one item); one block at a time passes through the driver."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        n = len(r.text.encode())
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((r.item_id, r.text))
        size += n
    yield block


def find_leaks(
    documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Rows (doc_id, item_id, distance, first_word, end_word): each item that leaks into each document, with its
    nearest stretch in words of the document.

    Null, empty and wordless texts and items leak nowhere. Repeated documents give their rows again; repeated items
    are separate items; null ids come back as null. Other columns are ignored; an empty table gives no rows. Texts are
    read whole.
    """
    spark = documents.sparkSession
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, distance int, first_word int, end_word int"
    names = ["doc_id", "item_id", "distance", "first_word", "end_word"]

    def scan(items: list[tuple[int, str]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(items)

        def run(table: pa.Table) -> pa.Table:
            ids = table.column("doc_id").to_pylist()
            rows = [(ids[i], *x) for i, *x in _index(shared.value, similarity).leaks(texts_of(table))]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = [pa.int64()] * 2 + [pa.int32()] * 3
            return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        return map_arrow(source, run, schema, rows=256)

    found = None
    for block in _blocks(benchmark, block_bytes):
        part = scan(block)
        found = part if found is None else found.unionByName(part)
    return found


_INDEXES: dict[int, tuple[tuple, Index]] = {}


def _index(items: list, similarity: float) -> Index:
    """One index per block and worker: the broadcast value stays the same object in a worker."""
    held = _INDEXES.get(id(items))
    if held is None or held[0][1] is not items or held[0][0] != similarity:
        if len(_INDEXES) > 1:
            _INDEXES.clear()
        held = _INDEXES[id(items)] = ((similarity, items), Index(items, similarity))
    return held[1]


def drop_leaking(
    documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of `documents` that no item leaks into, with all their columns, rows with a null doc_id among them. The
    blocks of the benchmark are looked for one after another in one scan."""
    kept, spark = documents, documents.sparkSession
    for block in _blocks(benchmark, block_bytes):
        kept = _without(kept, spark.sparkContext.broadcast(block), similarity)
    return kept


def _without(documents: DataFrame, shared, similarity: float) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        leaking = {i for i, *_ in _index(shared.value, similarity).leaks(texts_of(table))}
        return table.filter(pa.array([i not in leaking for i in range(table.num_rows)], pa.bool_()))

    return map_arrow(documents, run, documents.schema, rows=256)
