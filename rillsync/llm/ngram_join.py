"""N-gram Jaccard self-join by MinHash banding (operator 6).

Texts become sets of word shingles. Equal sets form a class, compared once. MinHash signatures are cut into bands,
numbers of bands and rows chosen for a target recall, and shuffled on the band hashes. A bucket is not expanded into
pairs: its members are tied to one centre where their signatures are not plainly unlike. The others, its rest, are
compared pair by pair where they are few; where they are many (texts that share some of their shingles by the
thousand), they are cut into bands again, of twice the rows and of a number for the same recall, in which only the
like meet. The ties' components are groups that may hold links. Inside a group every pair is verified on the full
shingle sets, by blocks dealt to tasks, which give counts of links and a spanning forest of them, never the pairs.
The forest's components are the classes of the result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillsync.llm.common import HOT_KEYS, HOT_ROWS, block_pairs, components, forest, join_hot, map_arrow, materialize, release, texts_of

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.999
#: Signature agreement from which a bucket's member is tied to its centre, and from which it needs no other centre. By
#: the triangle inequality of the Jaccard distance, of two members with a similarity of 0.8 either both are tied or
#: both are under 0.6, so that they stay together in the bucket's rest; 0.65 leaves room for the estimate's error.
TIE, SURE = 0.4, 0.65
#: The rest of a bucket is compared pair by pair up to this size, and cut into longer bands beyond it.
SMALL_BUCKET = 64
#: Shingle sets in a block, and bytes of them; a task holds two blocks.
BLOCK_ROWS, BLOCK_BYTES = 1024, 1 << 23
#: Classes whose texts are picked out by a broadcast of their ids, of 48 bytes each; more are joined by a shuffle.
PICKED = 300_000
_WORD = re.compile(r"\w+")


def banding(threshold: float, recall: float, rows: int = 8) -> tuple[int, int]:
    """(bands, rows): the fewest bands of so many rows with which a pair at the threshold meets with this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)), rows


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; a text of fewer words is one shingle, an empty one none."""
    found = _WORD.findall(text.lower())
    if not found:
        return np.zeros(0, np.uint64)
    index: dict[str, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in found), np.int64, len(found))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in index), np.uint64, len(index))[ids]
    n = max(1, len(found) - words + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(words, len(found))):
            out = (out * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[k : k + n]
            out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def _digest(found: bytes) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    d = xxhash.xxh3_128_intdigest(found)
    return (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63)


def permutations(n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(
        1, 2**32, n, np.uint64
    ).astype(np.uint32) | np.uint32(1), rng.integers(0, 2**32, n, np.uint64).astype(np.uint32)


def signature(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least hash of the set under each of the multiply-shift permutations; the set is taken in slices."""
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    low, high = (found & np.uint64(0xFFFFFFFF)).astype(np.uint32), (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(found), 256):
        x, y = low[at : at + 256], high[at : at + 256]
        np.minimum(least, ((a[:, None] * x) ^ (b[:, None] + y)).min(1), out=least)
    return least


def _band_hashes(m: np.ndarray, bands: int, rows: int, first: int = 0) -> list[int]:
    return [
        xxhash.xxh3_64_intdigest(
            m[i * rows : (i + 1) * rows].tobytes(), seed=first + i
        ) - (1 << 63) for i in range(bands)
    ]


def _signatures(documents: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, c1, c2: the set's digest, bands: hash of each band, mins: a byte of each least hash) of each row; no
    digest and no bands without a word."""
    a, b = permutations(bands * rows)

    def run(table: pa.Table) -> pa.Table:
        c1, c2, found_bands, mins = [], [], [], []
        for text in texts_of(table):
            s = shingles(text, words)
            if not len(s):
                c1.append(None), c2.append(None), found_bands.append(None), mins.append(None)
                continue
            high, low = _digest(s.tobytes())
            c1.append(high), c2.append(low)
            m = signature(s, a, b)
            found_bands.append(_band_hashes(m, bands, rows))
            mins.append((m >> np.uint32(13)).astype(np.uint8).tobytes())
        return pa.table({
            "doc_id": table.column("doc_id"), "c1": pa.array(c1, pa.int64()), "c2": pa.array(c2, pa.int64()),
            "bands": pa.array(found_bands, pa.list_(pa.int64())), "mins": pa.array(mins, pa.binary()),
        })

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(source, run, "doc_id long, c1 long, c2 long, bands array<long>, mins binary", rows=512)


def _agreement(table: pa.Table) -> pa.Table:
    """(rep, centre, score): the estimate of the Jaccard similarity from a byte of each least hash."""
    x, y = (
        np.frombuffer(b"".join(table[c].to_pylist()), np.uint8).reshape(table.num_rows, -1) for c in ("mins", "mins2")
    )
    score = ((x == y).mean(1) - 1 / 256) * 256 / 255
    return pa.table({"rep": table["rep"], "centre": table["centre"], "score": pa.array(score)})


def _ties(classes: DataFrame, texts_for, recall: float, rows: int) -> DataFrame:
    """Edges (rep, centre) in whose components any two classes that meet in a bucket and may be linked are together:
    members with their buckets' centres, then the rests of buckets. texts_for(reps) gives (rep, shingles: bytes)."""
    mins = classes.select("rep", "mins")

    def scored(pairs: DataFrame) -> DataFrame:
        held = materialize(pairs.distinct().join(mins, "rep"), "pairs")
        other = mins.select(F.col("rep").alias("centre"), F.col("mins").alias("mins2"))
        both = join_hot(held, other, "centre").select("rep", "centre", "mins", "mins2")
        out = materialize(map_arrow(both, _agreement, "rep long, centre long, score double", rows=4096), "ties")
        release(held)
        return out

    buckets = classes.select("rep", F.explode("bands").alias("band"))
    sizes = buckets.groupBy("band").agg(F.min("rep").alias("centre"), F.count("*").alias("n")).where("n > 1")
    buckets = materialize(buckets, "bands")
    held = materialize(join_hot(buckets, sizes.select("band", "centre"), "band").where("rep <> centre"), "buckets")
    release(buckets)
    near = scored(held.select("rep", "centre"))
    edges = near.where(F.col("score") >= TIE).select("rep", "centre")
    # the rests: members that are not surely like their centre may be linked with one another
    loose = near.where(F.col("score") < SURE).select("rep", "centre")
    rest = materialize(held.join(loose, ["rep", "centre"]).select("band", "rep"), "rest")
    counts = materialize(rest.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "rest-sizes")
    small = rest.join(counts.where(f"n <= {SMALL_BUCKET}").select("band"), "band")
    pairs = small.join(small.withColumnRenamed("rep", "centre"), "band").where("rep > centre").select("rep", "centre")
    edges = edges.unionByName(scored(pairs).where(F.col("score") >= TIE).select("rep", "centre"))
    large = counts.where(f"n > {SMALL_BUCKET}").select("band")
    if large.limit(1).count():
        crowd = materialize(join_hot(rest, large, "band").select("rep").distinct(), "crowd")
        edges = edges.unionByName(_longer_bands(texts_for(crowd), recall, 2 * rows))
    return materialize(edges.distinct(), "tied")


def _longer_bands(sets: DataFrame, recall: float, rows: int) -> DataFrame:
    """Edges (rep, centre) of the members of each bucket of longer bands with its centre: whoever meets there."""
    bands, rows = banding(THRESHOLD, recall, rows)
    a, b = permutations(bands * rows, seed=13)

    def run(table: pa.Table) -> pa.Table:
        found = [
            _band_hashes(
                signature(np.frombuffer(s, np.uint64), a, b), bands, rows, 1 << 20
            ) for s in table["found"].to_pylist()
        ]
        return pa.table({"rep": table.column("rep"), "bands": pa.array(found, pa.list_(pa.int64()))})

    cut = map_arrow(sets.select("rep", "found"), run, "rep long, bands array<long>", rows=256)
    buckets = materialize(cut.select("rep", F.explode("bands").alias("band")), "long-bands")
    sizes = buckets.groupBy("band").agg(F.min("rep").alias("centre"), F.count("*").alias("n")).where("n > 1")
    return join_hot(
        buckets, sizes.select("band", "centre"), "band"
    ).where("rep <> centre").select("rep", "centre").distinct()


def _numbers(ordered: np.ndarray) -> np.ndarray:
    """0, 1, ... for the distinct values of an ordered array."""
    if not len(ordered):
        return np.zeros(0, np.int32)
    return np.cumsum(np.append(False, ordered[1:] != ordered[:-1]), dtype=np.int32)


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left set with every right set, by products of 0/1 matrices over slices of
    the shingles that are in more than one set."""
    flat = np.concatenate([*left, *right]) if left or right else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(left) + len(right), dtype=np.int32), [len(s) for s in (*left, *right)])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    del order
    column = _numbers(flat)
    del flat
    keep = np.bincount(column)[column] > 1 if len(column) else np.zeros(0, bool)
    owner, column = owner[keep], _numbers(column[keep])
    n = int(column.max()) + 1 if len(column) else 0
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, n, 2048):
        lo, hi = np.searchsorted(column, [at, at + 2048])
        m = np.zeros((len(left) + len(right), min(2048, n - at)), np.float32)
        m[owner[lo:hi], column[lo:hi] - at] = 1
        out += m[: len(left)] @ m[len(left) :].T
    return out


def _verify(key: tuple, group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Counts of links (rep, null, links) and forest edges (rep, other, 0) of one pair of blocks."""
    sides = [group[group.side == 0], group[group.side == 1]]
    if bool(group.alone.iloc[0]):
        sides = [group, group]
    sets = [[np.frombuffer(s, np.uint64) for s in side.found] for side in sides]
    n = [np.array([len(s) for s in x], np.float32) for x in sets]
    reps, weights = [s.rep.to_numpy() for s in sides], [s.n_rows.to_numpy() for s in sides]
    a, b, links = [], [], {}
    for at in range(0, len(sets[0]), 512):
        part = sets[0][at : at + 512]
        common = _shared(part, sets[1])
        linked = common >= np.float32(threshold) * (n[0][at : at + 512, None] + n[1][None] - common) - 1e-3
        x, y = np.nonzero(linked)
        inter, union = common[x, y].astype(np.int64), (n[0][at + x] + n[1][y] - common[x, y]).astype(np.int64)
        ok = (inter >= threshold * union - 1e-9) & (reps[0][at + x] != reps[1][y])
        x, y = x[ok] + at, y[ok]
        a.append(x), b.append(y)
    a, b = np.concatenate(a), np.concatenate(b)
    rows = []
    if bool(group.alone.iloc[0]):
        got = np.bincount(a, weights[1][b], len(reps[0]))
        rows += [(int(r), None, int(w)) for r, w in zip(reps[0], got, strict=True) if w]
        rows += [(int(reps[0][i]), int(reps[0][j]), 0) for i, j in forest(len(reps[0]), a, b)]
    else:
        for own, x, y, other in ((0, a, b, 1), (1, b, a, 0)):
            got = np.bincount(x, weights[other][y], len(reps[own]))
            rows += [(int(r), None, int(w)) for r, w in zip(reps[own], got, strict=True) if w]
        k = len(reps[0])
        both = np.concatenate(reps)
        rows += [(int(both[i]), int(both[j]), 0) for i, j in forest(k + len(reps[1]), a, b + k)]
    rep, other, counts = zip(*rows, strict=True) if rows else [()] * 3
    return pd.DataFrame(
        {"rep": np.array(rep, np.int64), "other": pd.array(list(other), "Int64"), "links": np.array(counts, np.int64)}
    )


def jaccard_links(
    documents: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, words: int = WORDS
) -> DataFrame:
    """Per row of `documents` (doc_id, text): doc_id, class_id (the least doc_id that links lead to, itself
    included), n_links (other rows whose shingle set has a Jaccard similarity of at least the threshold), copy_id (the
    least doc_id with the same shingle set).

    Null, empty and wordless texts have no shingles, link with nothing and are their own class. A text of fewer words
    than a shingle is one shingle of all its words. Rows with a null doc_id have no name to link by: they come back
    with nulls and no links. Rows that repeat a doc_id count as rows of their own, with equal texts or not. Other
    columns are ignored; an empty table gives no rows. Sets are told apart by 128 bits of their digests.
    """
    bands, rows = banding(threshold, recall)
    signed = materialize(_signatures(documents, words, bands, rows), "signatures")
    named = signed.where("doc_id is not null and c1 is not null")
    classes = named.groupBy("c1", "c2").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("n_rows"), F.first("bands").alias("bands"), F.first("mins").alias("mins")
    )
    # a number of each class, which the written table keeps
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")

    def sets_of(reps: DataFrame) -> DataFrame:
        """The full shingle sets of some classes, with the columns of `reps`: only their texts are read again."""
        more = [f for f in reps.schema.fields if f.name != "rep"]
        wanted = classes.select("rep", "least", "c1", "c2").join(reps, "rep")
        wanted = F.broadcast(wanted) if reps.count() <= PICKED else wanted
        texts = documents.select(F.col("doc_id").cast("long").alias("least"), "text").join(wanted, "least")

        def run(table: pa.Table) -> pa.Table:
            found = [shingles(t, words).tobytes() for t in texts_of(table)]
            # a doc_id may come with other texts, too
            wanted = zip(table["c1"].to_pylist(), table["c2"].to_pylist(), strict=True)
            own = pa.array([_digest(s) == c for s, c in zip(found, wanted, strict=True)], pa.bool_())
            kept = {f: table.column(f) for f in ("rep", *(f.name for f in more))}
            return pa.table(kept | {"found": pa.array(found, pa.binary())}).filter(own)

        kinds = ", ".join(["rep long", *(f"{f.name} {f.dataType.simpleString()}" for f in more), "found binary"])
        got = texts.select("rep", *(f.name for f in more), "c1", "c2", "text")
        return map_arrow(got, run, kinds, rows=512).dropDuplicates(["rep"])

    groups = components(
        _ties(classes, sets_of, recall, rows).select(F.col("rep").alias("a"), F.col("centre").alias("b"))
    )
    members = classes.select("rep", "n_rows").join(
        groups.withColumnsRenamed({"node": "rep", "component": "cluster"}), "rep"
    )
    full = materialize(sets_of(materialize(members, "members")), "sets")
    dealt = block_pairs(full, "cluster", "rep", BLOCK_ROWS, "found", BLOCK_BYTES)
    verified = dealt.groupBy("pair").applyInPandas(
        lambda key, g: _verify(key, g, threshold), "rep long, other long, links long"
    )
    found = materialize(verified, "links")
    linked = components(found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    linked = linked.withColumnRenamed("node", "rep")
    counted = found.where("other is null").groupBy("rep").agg(F.sum("links").alias("links"))
    names = linked.join(classes.select("rep", "least"), "rep").groupBy("component").agg(F.min("least").alias("name"))
    linked = join_hot(linked, names, "component").select("rep", "name")
    n_links = (F.coalesce("links", F.lit(0)) + F.col("n_rows") - 1).alias("n_links")
    per_class = classes.select(
        "c1", "c2", "rep", "least", "n_rows"
    ).join(counted, "rep", "left").join(linked, "rep", "left")
    per_class = per_class.select("c1", "c2", "least", F.coalesce("name", "least").alias("class_id"), n_links)
    # rows of single texts are joined by a shuffle, those of large classes of copies where they lie
    real = F.col("doc_id").isNotNull()
    alone = signed.select("doc_id", "c1", "c2").where("doc_id is null or c1 is null")
    alone = alone.select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.col("doc_id").alias("copy_id")
    )
    shown = _by_class(named.select("doc_id", "c1", "c2"), per_class, classes)
    return shown.select("doc_id", "class_id", "n_links", F.col("least").alias("copy_id")).unionByName(alone)


def _by_class(rows: DataFrame, per_class: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows joined with their classes; classes of many rows, so few, by broadcast."""
    key, total = ["c1", "c2"], rows.count()
    limit = max(HOT_ROWS, total // HOT_KEYS)
    if total <= limit:
        return rows.join(per_class, key)
    hot = F.broadcast(materialize(classes.where(F.col("n_rows") > limit).select(*key), "hot"))
    near = rows.join(F.broadcast(per_class.join(hot, key, "left_semi")), key)
    return near.unionByName(rows.join(hot, key, "left_anti").join(per_class, key))


def keep_one(
    documents: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, words: int = WORDS
) -> DataFrame:
    """`documents` with one document of each class: the one of least doc_id, with the rows that repeat it. Rows with a
    null doc_id are numbered after all others, so one of them stays where its class has no other."""
    columns = documents.columns
    if not documents.where("doc_id is null").limit(1).count():
        links = jaccard_links(documents.select("doc_id", "text"), threshold, recall, words)
        gone = links.where("doc_id <> class_id").select("doc_id").distinct()
        return documents.join(gone, "doc_id", "left_anti").select(*columns)
    last = documents.agg(F.max("doc_id")).first()[0] or 0
    own = F.coalesce(F.col("doc_id"), F.lit(int(last) + 1) + F.monotonically_increasing_id())
    numbered = materialize(documents.withColumn("_own", own), "numbered")
    links = jaccard_links(numbered.select(F.col("_own").alias("doc_id"), "text"), threshold, recall, words)
    gone = links.where("doc_id <> class_id").select(F.col("doc_id").alias("_own")).distinct()
    return numbered.join(gone, "_own", "left_anti").select(*columns)
