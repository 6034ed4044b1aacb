"""Token counts without ids (operator 5).

Every distinct pre-token of the corpus is counted in pieces once. Texts are cut at the single spaces that always
part two pre-tokens, so a "pre-token" here is what stands between two such spaces; pieces add up over them. The
per-document frequencies are then joined to those counts and summed. The join has two arms: the most frequent
pre-tokens (those over a count that follows from a histogram of the counts, and so of bounded size) are joined in the
scan, so no hot key is ever shuffled; the others, rare by construction, are joined by a shuffle on the pre-token.
Long pre-tokens are known by a digest of 128 bits, so keys are short.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillsync.llm.common import map_arrow, materialize
from rillsync.llm.subwords import FIRST, encoder

#: Pre-tokens joined in the scan at most, and bytes of them: the size of what is broadcast.
FREQUENT_ROWS = 200_000
FREQUENT_BYTES = 16_000_000
#: Longer pre-tokens go by their digest.
KEY_CHARS = 64
#: Before a digest. No key begins with it otherwise.
LONG = "\ue001"
#: Distinct pre-tokens, and characters of long ones, that a task holds before it passes them on.
HELD, HELD_CHARS = 400_000, 1 << 24


def long_key(chunk: str) -> str:
    return LONG + xxhash.xxh3_128_hexdigest(chunk.encode("utf-8", "surrogatepass"))


def _cut(tool, text: str) -> tuple[list[str], dict[str, str]]:
    """A text's pre-tokens as keys, and what the keys of long ones stand for. The first pre-token of a text is marked,
    as it is encoded without a space before it."""
    first, rest = tool.chunks(text)
    if first:
        rest.append(FIRST + first)
    if FIRST not in text and LONG not in text and max(map(len, rest), default=0) <= KEY_CHARS:
        return rest, {}
    long: dict[str, str] = {}
    # a chunk with one of the marks inside the text goes by its digest, too
    for i, c in enumerate(rest):
        marked = first and i == len(rest) - 1
        if len(c) > KEY_CHARS or c[:1] == LONG or c[:1] == FIRST and not marked or marked and c[1:2] == FIRST:
            body = c if marked else " " + c
            rest[i] = long_key(body)
            long[rest[i]] = body
    return rest, long


def distinct_pretokens(documents: DataFrame, vocabulary: str) -> DataFrame:
    """(chunk, n, pieces) of each distinct pre-token; partial counts are made before the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, counts, texts = encoder(vocabulary), Counter(), {}

        def flush() -> pa.RecordBatch:
            columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
            columns.append(pa.array([texts.get(c) for c in counts] if texts else [None] * len(counts), pa.string()))
            counts.clear(), texts.clear()
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "n", "long"])

        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for text in batch.slice(at, 256).column(0).to_pylist():
                    if text:
                        keys, long = _cut(tool, text)
                        counts.update(keys)
                        for k, body in long.items():
                            if k not in texts:
                                texts[k], held = body, held + len(body)
                        if held > HELD_CHARS:
                            yield flush()
                            held = 0
                if len(counts) > HELD:
                    yield flush()
                    held = 0
        if counts:
            yield flush()

    def pieces(table: pa.Table) -> pa.Table:
        tool = encoder(vocabulary)
        bodies = [
            c if t is None else t for c, t in zip(table["chunk"].to_pylist(), table["long"].to_pylist(), strict=True)
        ]
        return table.drop(["long"]).append_column("pieces", pa.array(pieces_of(tool, bodies), pa.int64()))

    counted = documents.select("text").mapInArrow(run, "chunk string, n long, long string").groupBy("chunk")
    # whatever text a digest comes with is the same; texts of keys that are no digests are null
    counted = counted.agg(F.sum("n").alias("n"), F.max("long").alias("long"))
    return map_arrow(counted, pieces, "chunk string, n long, pieces long", rows=100_000)


def pieces_of(tool, bodies: list[str]) -> list[int]:
    """Pieces of each: a text's first pre-token behind its mark, a long one behind its space, or a plain one."""
    out = []
    for c in bodies:
        if c[:1] == FIRST:
            out.append(len(tool._encode(c[1:], True)) // 4)
        else:
            out.append(len(tool._encode(c[1:] if c[:1] == " " else c)) // 4)
    return out


def frequent_pretokens(words: DataFrame, rows: int = FREQUENT_ROWS, size: int = FREQUENT_BYTES) -> dict[str, int]:
    """Pieces of the pre-tokens over a count: the least at which they are so many and have so many bytes at most. The
    counts are binned by quarters of powers of two, so that a few hundred numbers tell it."""
    quarter = F.floor(F.log2("n") * 4).alias("bin")
    bins = words.groupBy(quarter).agg(
        F.count("*").alias("k"), F.sum(F.octet_length("chunk") + 8).alias("size")
    ).collect()
    least, held, used = None, 0, 0
    for b in sorted(bins, key=lambda r: -r.bin):
        held, used = held + b.k, used + b.size
        if held > rows or used > size:
            break
        least = b.bin
    if least is None:
        return {}
    chosen = words.where(F.floor(F.log2("n") * 4) >= least).select("chunk", "pieces")
    return {r.chunk: r.pieces for r in chosen.toLocalIterator()}


def count_tokens(documents: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """Per row of `documents` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows and null ids give a row each; other columns are
    ignored; an empty table gives no rows. Any length of text and of pre-token is counted whole.
    """
    words = materialize(distinct_pretokens(documents, vocabulary), "pretokens")
    frequent = frequent_pretokens(words)
    shared = documents.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, get, row = encoder(vocabulary), shared.value.get, TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    base, tail, text = 0, None, text or ""
                    if text:
                        keys, _ = _cut(tool, text)
                        known = list(map(get, keys))
                        if None in known:
                            rare = Counter([c for c, k in zip(keys, known, strict=True) if k is None])
                            tail = [{"chunk": c, "n": n} for c, n in rare.items()]
                            base = sum(k for k in known if k is not None)
                        else:
                            base = sum(known)
                    out.append((row, doc_id, len(text.encode()), base, tail))
                    row += 1
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_bytes", "base", "tail"])

    tail_type = pa.list_(pa.struct([("chunk", pa.string()), ("n", pa.int64())]))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), tail_type]
    schema = "row long, doc_id long, n_bytes long, base long, tail array<struct<chunk:string,n:long>>"
    held = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
    held = materialize(held, "frequencies")
    rare = held.where("tail is not null").select("row", F.inline("tail"))
    summed = rare.join(words.select("chunk", "pieces"), "chunk").groupBy("row").agg(
        F.sum(F.col("n") * F.col("pieces")).alias("more")
    )
    total = F.col("base") + F.coalesce("more", F.lit(0))
    return held.drop("tail").join(summed, "row", "left").select(
        "doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit")
    )
