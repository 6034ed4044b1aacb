"""What the operators of this subpackage share: shared scratch tables, Arrow maps, components and block pairs."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillsync.sources.scratch import materialize, release

__all__ = [
    "block_pairs", "components", "forest", "is_held_out", "join_hot", "map_arrow", "materialize", "release", "sample_rows",
    "sample_texts", "texts_of",
]


def map_arrow(df: DataFrame, fn: Callable[[pa.Table], pa.Table | None], schema: str, rows: int = 1024) -> DataFrame:
    """mapInArrow with batches cut to `rows` rows, so that long texts do not pile up in a worker, which gives back what
    a batch has taken."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = fn(pa.Table.from_batches([batch.slice(at, rows)]))
                if out is not None and out.num_rows:
                    yield from out.combine_chunks().to_batches()
            del batch
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def texts_of(table: pa.Table, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t if t is not None else "" for t in table.column(column).to_pylist()]


def sample_rows(df: DataFrame, key: str, rows: int) -> DataFrame:
    """A bounded sample for fitting a model: rows whose key hash falls in the first rows / (count of rows) of its
    range, so about `rows` of them (all, where there are fewer), and hardly more at most. Nothing but a count and the
    sample itself leaves the scan."""
    share = min(1.0, rows / max(1, df.select(key).count()))
    if share < 1:
        df = df.where(F.xxhash64(F.col(key)) < F.lit(int(-(2**63) + share * 2**64)))
    return df.limit(most_of(rows))


def most_of(rows: int) -> int:
    """What a sample of about so many rows has at most: the mean and six standard deviations."""
    return rows + math.ceil(6 * math.sqrt(rows))


def sample_texts(df: DataFrame, rows: int, chars: int, key: str = "doc_id") -> list:
    """About `rows` rows of df for fitting a model, collected, none of whose texts is null or has more than `chars`
    characters: the driver holds most_of(rows) * chars characters at most, whatever the corpus."""
    return sample_rows(df.where(F.col("text").isNotNull() & (F.length("text") <= chars)), key, rows).collect()


def is_held_out(key: str = "doc_id") -> F.Column:
    """The fixed fold: crc32 of the id as text, modulo 3, equals 1 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


#: A key is hot with more rows than HOT_ROWS and than one HOT_KEYS-th of all rows, so there are fewer hot ones than
#: HOT_KEYS, whatever the size.
HOT_ROWS, HOT_KEYS = 100_000, 10_000


def join_hot(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """`rows`, a materialised table, joined with `other`, which has one row for each key. Hot keys, fewer than HOT_KEYS,
    are joined by broadcast where the rows lie; the others by whatever the planner chooses."""
    total = rows.count()  # from the files' footers
    limit = max(HOT_ROWS, total // HOT_KEYS)
    if total <= limit:
        return rows.join(other, key)
    hot = materialize(rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > limit).select(key), "hot")
    near = rows.join(F.broadcast(other.join(F.broadcast(hot), key, "left_semi")), key)
    return near.unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(other, key))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected edges (a, b): rows (node, component), component the least node.

    In each round every node gives way to its neighbour of least rank, or to itself, and the edges are contracted;
    ranks are hashes that change from round to round, so a share of the nodes goes each time however they are
    chained, and the edges left shrink. Afterwards the steps are put together and each component is named by its
    least node. Every round is written to the shared folder; only whether edges are left reaches the driver.
    """
    ends = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    left = materialize(edges.where("a <> b").select(*ends).distinct(), "cc-edges")
    steps: list[DataFrame] = []
    while not steps or left.limit(1).count():
        turn = F.lit(len(steps))
        rank = {c: F.struct(F.xxhash64(c, turn).alias("rank"), F.col(c).alias("node")) for c in ("a", "b")}
        both = left.select(F.col("a").alias("node"), rank["b"].alias("near"), rank["a"].alias("own"))
        both = both.union(left.select("b", rank["a"], rank["b"]))
        best = both.groupBy("node").agg(F.least(F.min("near"), F.min("own")).alias("best"))
        step = materialize(best.select("node", F.col("best.node").alias("to")), "cc-step")
        steps.append(step)
        # a greatest end may be joined as it is; a least end may be the hub of a star
        moved = join_hot(left, step.withColumnsRenamed({"node": "b", "to": "y"}), "b")
        moved = moved.join(step.withColumnsRenamed({"node": "a", "to": "x"}), "a").where("x <> y")
        moved = moved.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
        was, left = left, materialize(moved, "cc-edges")
        release(was)
    labels = steps[0].withColumnRenamed("to", "c")
    for step in steps[1:]:
        more = step.withColumnRenamed("node", "c")
        labels = labels.join(more, "c", "left").select("node", F.coalesce("to", "c").alias("c"))
    labels = materialize(labels, "cc-labels")
    release(left, *steps)
    least = labels.groupBy("c").agg(F.min("node").alias("component"))
    return materialize(join_hot(labels, least, "c").select("node", "component"), "cc-components")


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph on 0..n-1 with edges a-b."""
    root = list(range(n))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            kept.append((x, y))
    return kept


def block_pairs(
    members: DataFrame, group: str, key: str, block_rows: int, bytes_of: str | None = None, block_bytes: int = 1 << 24
) -> DataFrame:
    """Deal each group's rows to tasks that hold two blocks of it at most.

    A group gets a block for every `block_rows` rows, or every `block_bytes` bytes of the column `bytes_of` where these
    are more, by key hash; every unordered pair of blocks is one task, so a row is sent once per block of its own group
    and no task grows with the group. `members` is a materialised table. Adds pair (string: the task), side (0 or 1)
    and alone (a task over one block, in which both sides are the same rows).
    """
    size = F.count("*") / F.lit(float(block_rows))
    if bytes_of:
        size = F.greatest(size, F.sum(F.octet_length(bytes_of)) / F.lit(float(block_bytes)))
    # only groups of several blocks are told: they are few, and the rows of large ones stay where they lie
    sizes = members.groupBy(group).agg(F.ceil(size).cast("int").alias("n_blocks")).where("n_blocks > 1")
    held = members.join(F.broadcast(sizes), group, "left").withColumn("n_blocks", F.coalesce("n_blocks", F.lit(1)))
    held = held.withColumn("own", F.pmod(F.xxhash64(F.col(key)), F.col("n_blocks")).cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    pair = F.concat_ws(":", F.col(group).cast("string"), low.cast("string"), high.cast("string"))
    held = held.withColumn("pair", pair).withColumn("side", (F.col("own") == high).cast("int"))
    return held.withColumn("alone", low == high).drop("own", "other", "n_blocks")
