"""Near-duplicate embeddings by sorted projection passes (operator 10).

In each pass the vectors are put in the lexicographic order of their concatenated random hashes (signs of random
projections), and every vector is compared with its neighbours in a bounded window of that order. Pairs that reach
the cosine are united across all passes. Inside a component every pair is then compared, by blocks dealt to tasks, so
counts of links are exact within it; no group is expanded into pairs.

How many passes are needed depends on how crowded the vectors are. The first round has as many as evenly spread
vectors need. It also measures, for each vector and pass, how long a prefix the window's far end shares with it: a
pair is met in a pass if its hashes agree for longer, so the chance to have met no partner is known by vector. The
vectors for which it is too large, in crowded regions, go on to further rounds among themselves. There the hashes are
taken around local centres, which tells crowded vectors apart far better, and windows double, up to a bound.
Each round plants a partner at the cosine beside every one of them and counts the passes in which the two are met. A
vector leaves when its partners were met so often that a real one is missed with a chance below 1 - recall, whatever
the odds of a pass, so a dense spot goes on however few vectors lie in it. Rounds end with the last vector, or when a
window is as large as what is left, which compares all pairs. Only where the local centres' cells start is drawn from a
bounded sample, as random projections are; centres are means over all vectors of the round.

Passes carry vectors as 16-bit floats. Pairs too near to the cosine to be told by these are compared exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillsync.llm.common import block_pairs, components, forest, map_arrow, materialize, release, sample_rows

COSINE, RECALL = 0.95, 0.995
#: Neighbours compared on each side in the first round, in the second, and at most; passes of each later round.
WINDOW, WIDE, WIDEST, PASSES = 64, 512, 8192, 24
#: Vectors that may have missed a partner with a chance over twice 1 - recall go on to further rounds. The first round
#: aims at a chance so many times smaller than 1 - recall, so crowded vectors do, and few others.
SLACK = 4
#: Rows of the order in a task (with a window more), and vectors in a block of a component.
STRETCH, BLOCK_ROWS = 1024, 2048
HASH_BITS = 62
#: Vectors of a round from which the starts of local cells are drawn.
CENTRE_ROWS = 2000
#: Local centres of the passes of a later round, in turn.
CENTRES = (1, 4, 16)
#: Error of a cosine from 16-bit components, rounded up.
MARGIN = 1.2e-3


def passes_for(rows: int, cosine: float, recall: float, window: int) -> int:
    """Passes with which a pair at the cosine shares, once at least, a prefix that a window's worth of evenly spread
    vectors share."""
    bits = max(1.0, math.log2(max(2, rows / window)))
    p = (1 - math.acos(cosine) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - p)))


def _matrix(column: pd.Series, kind: type = np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def _units(embeddings: DataFrame) -> DataFrame:
    """(vec_id, unit: float64 bytes, c1, c2: digest, dims) of each row; nulls where a vector has no direction."""

    def run(table: pa.Table) -> pa.Table:
        units, c1, c2, dims = [], [], [], []
        for v in table.column("embedding").to_pylist():
            x = None if v is None or None in v else np.array(v, np.float64)
            top = np.abs(x).max() if x is not None and len(x) else 0.0
            if not (0 < top < np.inf):
                units.append(None), c1.append(None), c2.append(None), dims.append(None)
                continue
            d = xxhash.xxh3_128_intdigest((x + 0.0).tobytes())
            x = x / top
            units.append((x / math.sqrt(float(x @ x))).tobytes()), dims.append(len(x))
            c1.append((d >> 64) - (1 << 63)), c2.append((d & (1 << 64) - 1) - (1 << 63))
        return pa.table({
            "vec_id": table.column("vec_id"), "unit": pa.array(units, pa.binary()), "c1": pa.array(c1, pa.int64()),
            "c2": pa.array(c2, pa.int64()), "dims": pa.array(dims, pa.int32()),
        })

    vector = F.col("embedding").cast("array<double>").alias("embedding")
    source = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector)
    return map_arrow(source, run, "vec_id long, unit binary, c1 long, c2 long, dims int")


def _sample(vectors: DataFrame, rows: int) -> list[tuple[int, np.ndarray]]:
    found = sample_rows(vectors.select("rep", "half"), "rep", rows).limit(rows).collect()
    return [(r.rep, np.frombuffer(r.half, np.float16).astype(np.float32)) for r in found]


def _planted(vectors: DataFrame, cosine: float, seed: int) -> DataFrame:
    """A partner just over the cosine beside each vector: rows (rep, half, dims), rep below zero: -1 - that of the vector."""
    c = cosine + 0.1 * (1 - cosine)

    def run(table: pa.Table) -> pa.Table:
        out = []
        for rep, half in zip(table["rep"].to_pylist(), table["half"].to_pylist(), strict=True):
            v = np.frombuffer(half, np.float16).astype(np.float32)
            w = np.random.default_rng([seed, rep]).normal(size=len(v))
            w -= (w @ v) / (v @ v) * v
            partner = c * v / np.linalg.norm(v) + math.sqrt(1 - c * c) * w / np.linalg.norm(w)
            out.append(partner.astype(np.float16).tobytes())
        reps = pa.array(-1 - table["rep"].to_numpy())
        return pa.table({"rep": reps, "half": pa.array(out, pa.binary()), "dims": table["dims"]})

    return map_arrow(vectors.select("rep", "half", "dims"), run, "rep long, half binary, dims int")


def _hashed(vectors: DataFrame, passes: int, seed: int, centres: dict[int, list[np.ndarray]] | None) -> DataFrame:
    """(lane, key, rep, half): every vector once for each pass. A lane is a pass, a length of vectors and a local
    centre; the key is the concatenated signs of random projections around the centre."""
    shared = vectors.sparkSession.sparkContext.broadcast(centres)
    weights = 1 << np.arange(HASH_BITS - 1, -1, -1, dtype=np.int64)

    def run(table: pa.Table) -> pa.Table:
        halves, dims, out = table.column("half").to_pylist(), table.column("dims").to_pylist(), []
        for d in sorted(set(dims)):
            at = np.array([i for i, k in enumerate(dims) if k == d])
            x = np.frombuffer(b"".join(halves[i] for i in at), np.float16).reshape(len(at), d).astype(np.float32)
            own = table.take(pa.array(at))
            for p in range(passes):
                planes = np.random.default_rng([seed, p, d]).normal(size=(d, HASH_BITS)).astype(np.float32)
                cell, y = np.zeros(len(at), np.int64), x
                if shared.value is not None and d in shared.value:
                    points = shared.value[d][p]
                    cell = (x @ points.T - (points**2).sum(1) / 2).argmax(1)
                    y = x - points[cell]
                key = ((y @ planes > 0) @ weights).astype(np.int64)
                lane = (np.int64(d) * passes + p) * max(CENTRES) + cell
                out.append(
                    pa.table({"lane": pa.array(lane), "key": pa.array(key), "rep": own["rep"], "half": own["half"]})
                )
        return pa.concat_tables(out)

    return map_arrow(vectors.select("rep", "half", "dims"), run, "lane long, key long, rep long, half binary")


def _stretches(spread: DataFrame, carry: int, stretch: int) -> DataFrame:
    """(stretch, place, lane, key, rep, half) in the order of lane and key, `stretch` rows each, with the last `carry`
    rows of the stretch before."""
    spark = spread.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = spread.repartitionByRange(partitions, "lane", "key", "rep").sortWithinPartitions("lane", "key", "rep")

    def numbered(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            more = [pa.array(np.full(n, part, np.int64)), pa.array(np.arange(at, at + n))]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, "part", "at"])
            at += n

    kinds = "lane long, key long, rep long, half binary, part long, at long"
    ordered = materialize(ordered.mapInArrow(numbered, kinds), "order")
    before, total = [], 0
    for r in ordered.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():  # a row per partition
        before.append((r.part, total))
        total += r.n
    bases = F.broadcast(spark.createDataFrame(before, "part long, base long"))
    held = ordered.join(bases, "part").withColumn("place", F.col("base") + F.col("at"))
    own, last = F.floor(F.col("place") / stretch), F.col("place") % stretch >= stretch - carry
    held = held.withColumn("stretch", F.explode(F.when(last, F.array(own, own + 1)).otherwise(F.array(own))))
    out = held.select("stretch", "place", "lane", "key", "rep", "half")
    out._scratch = ordered._scratch
    return out


def _compare(part: pd.DataFrame, window: int, cosine: float, crowding: bool, turn: int = 0) -> list[tuple]:
    """Edges and crowding of the rows of a stretch in one lane: (a, b, what, value). what: 0 a sure edge, 1 one to be
    compared exactly, 2 the planted partner of b met (value: turn, the pass), 3 the logarithm of the chance that a pass misses a partner of a."""
    x, reps, keys = _matrix(part.half, np.float16).astype(np.float32), part.rep.to_numpy(), part.key.to_numpy()
    n, step = len(reps), max(64, min(window, 512))
    first, second, value = [], [], []
    for at in range(0, n, step):
        end = min(n, at + step + window)
        got = x[at : at + step] @ x[at:end].T
        i, j = np.nonzero(got >= cosine - MARGIN)
        ok = (j > i) & (j - i <= window)
        first.append(i[ok] + at), second.append(j[ok] + at), value.append(got[i[ok], j[ok]])
    i, j, value = np.concatenate(first), np.concatenate(second), np.concatenate(value)
    real = (reps[i] >= 0) & (reps[j] >= 0)
    sure = real & (value >= cosine + MARGIN)
    tied = forest(n, i[sure], j[sure])
    out = [(int(reps[p]), int(reps[q]), 0, 0.0) for p, q in tied]
    # pairs that may be links are of interest only between rows that sure links do not unite
    unsure, root = real & ~sure, _roots(n, tied)
    unsure &= root[i] != root[j]
    out += [(int(a), int(b), 1, 0.0) for a, b in zip(reps[i[unsure]], reps[j[unsure]], strict=True)]
    low, high = np.minimum(reps[i], reps[j]), np.maximum(reps[i], reps[j])
    for k in np.flatnonzero((low < 0) & (high >= 0) & (value >= cosine)).tolist():
        if low[k] == -1 - high[k]:
            out.append((int(low[k]), int(high[k]), 2, float(turn)))
    if not crowding or n <= 2 * window:
        return out
    # how many bits a row shares with the rows at both ends of its window; every row but a lane's first and last ones
    # has both ends in one of its stretches, as two windows' worth of rows are carried over
    shared = (keys[:-window] ^ keys[window:]).astype(np.float64)
    bits = HASH_BITS - np.frexp(shared)[1]
    bits = np.maximum(bits[:-window], bits[window:])
    p = 1 - math.acos(cosine) / math.pi
    miss = np.log1p(-np.minimum(p ** (bits + 1.0), 1 - 1e-9))
    out += [(int(a), None, 3, float(m)) for a, m in zip(reps[window:-window], miss, strict=True)]
    return out


def _roots(n: int, edges: list[tuple[int, int]]) -> np.ndarray:
    """A number of each node's tree in a forest."""
    out = np.arange(n)
    if edges:
        a, b = np.array(edges).T
        while (out[a] != out[b]).any():
            np.minimum.at(out, a, out[b])
            np.minimum.at(out, b, out[a])
    return out


_FOUND = "a long, b long, what int, value double"


def _round(vectors: DataFrame, passes: int, window: int, cosine: float, seed: int, centres) -> DataFrame:
    """(a, b, what, value) of all passes of a round; see _compare."""
    stretch, crowding = max(STRETCH, 2 * window), centres is None
    dealt = _stretches(_hashed(vectors, passes, seed, centres), 2 * window if crowding else window, stretch)

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        out = []
        for lane, part in g.sort_values("place").groupby("lane", sort=False):
            out += _compare(part, window, cosine, crowding, int(lane) // max(CENTRES) % passes)
        a, b, what, value = zip(*out, strict=True) if out else [()] * 4
        columns = {"a": np.array(a, np.int64), "b": pd.array(list(b), "Int64")}
        return pd.DataFrame(columns | {"what": np.array(what, np.int32), "value": np.array(value, float)})

    found = materialize(dealt.groupBy("stretch").applyInPandas(run, _FOUND), "found")
    release(dealt)
    return found


def _local_centres(vectors: DataFrame, passes: int, seed: int) -> dict[int, list[np.ndarray]]:
    """By length of vectors, the centres of each pass: the means of all vectors around random ones."""
    rng, pivots, sample = np.random.default_rng(seed), {}, _sample(vectors, CENTRE_ROWS)
    for d in {len(v) for _, v in sample}:
        x = np.stack([v for _, v in sample if len(v) == d])
        pivots[d] = [x[rng.permutation(len(x))[: CENTRES[p % len(CENTRES)]]] for p in range(passes)]
    shared, kinds = vectors.sparkSession.sparkContext.broadcast(pivots), "dims int, turn int, sums binary"

    def packed(sums: dict) -> pa.RecordBatch:
        rows = [(d, p, v.tobytes()) for (d, p), v in sums.items()]
        d, p, v = zip(*rows, strict=True) if rows else [()] * 3
        return pa.RecordBatch.from_pydict({"dims": pa.array(d, pa.int32()), "turn": pa.array(p, pa.int32()), "sums": pa.array(v, pa.binary())})

    def run(batches):
        sums = {}
        for b in batches:
            dims, halves = b["dims"].to_numpy(), b["half"].to_pylist()
            for d in set(dims.tolist()) & set(shared.value):
                x = np.frombuffer(b"".join(halves[i] for i in np.flatnonzero(dims == d)), np.float16)
                x = x.reshape(-1, d).astype(np.float32)
                with_one = np.column_stack([x, np.ones(len(x))])
                for p, points in enumerate(shared.value[d]):
                    cell = (x @ points.T - (points**2).sum(1) / 2).argmax(1)
                    own = np.equal(cell, np.arange(len(points))[:, None]).astype(np.float64) @ with_one
                    sums[d, p] = sums.get((d, p), 0.0) + own
        yield packed(sums)

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v) for v in table["sums"].to_pylist())
        return pa.Table.from_batches([packed({(table["dims"][0].as_py(), table["turn"][0].as_py()): total})])

    found = vectors.select("dims", "half").mapInArrow(run, kinds).groupBy("dims", "turn").applyInArrow(add, kinds)
    for r in found.collect():  # a row for each pass
        own = np.frombuffer(r.sums).reshape(-1, r.dims + 1)
        means = own[:, :-1] / np.maximum(own[:, -1:], 1)
        pivots[r.dims][r.turn] = np.where(own[:, -1:] > 0, means, pivots[r.dims][r.turn]).astype(np.float32)
    return pivots


def candidate_edges(classes: DataFrame, cosine: float, recall: float, seed: int = 17) -> DataFrame:
    """Verified pairs (a, b) of `classes` (rep, unit, dims) that unite all that can be reached by pairs at the cosine,
    each met with the probability `recall` at least."""
    spark = classes.sparkSession

    def halves(table: pa.Table) -> pa.Table:
        half = [np.frombuffer(u, np.float64).astype(np.float16).tobytes() for u in table.column("unit").to_pylist()]
        return pa.table({"rep": table.column("rep"), "half": pa.array(half, pa.binary()), "dims": table.column("dims")})

    kinds = "rep long, half binary, dims int"
    vectors = materialize(map_arrow(classes.select("rep", "unit", "dims"), halves, kinds), "halves")
    window, done, number = WINDOW, [], 0
    count = vectors.count()
    passes, centres = passes_for(count, cosine, 1 - (1 - recall) / SLACK, window), None
    # a partner and the planted ones are met alike, so one is missed until those were met k times with a chance of 2 ** -k
    enough, hits = math.ceil(math.log2(1 / (1 - recall))), None
    while count > 1:
        exact = window >= count
        if exact:
            passes, centres, window = 1, None, count
        planted = number and not exact
        shown = vectors.unionByName(_planted(vectors, cosine, seed + number)) if planted else vectors
        found = _round(shown, passes, window, cosine, seed + number, centres)
        done.append(found)
        if exact:
            break
        if number == 0:
            # vectors for which all passes may have missed a partner go on; those of one component, which are equal but
            # for their sign, were neighbours in every pass
            chance = found.where("what = 3").groupBy("a").agg(F.sum("value").alias("miss"))
            crowded = chance.where(F.col("miss") > math.log(2 * (1 - recall))).select(F.col("a").alias("rep"))
            left = vectors.where("dims > 1").join(crowded, "rep", "left_semi").withColumn("met", F.lit(0).cast("long"))
            window = WIDE
        else:
            now = found.where("what = 2").groupBy(F.col("b").alias("rep")).agg(F.countDistinct("value").alias("now"))
            left = hits.join(now, "rep", "left").withColumn("met", F.col("met") + F.coalesce("now", F.lit(0)))
            left = left.where(F.col("met") < enough)
            window = min(2 * window, WIDEST)
        was, hits = vectors if hits is None else hits, materialize(left.select("rep", "half", "dims", "met"), "crowded")
        release(was)
        vectors, count = hits.select("rep", "half", "dims"), hits.count()
        number, passes = number + 1, PASSES
        centres = _local_centres(vectors, passes, seed + number) if count > 1 else None
    edges = spark.createDataFrame([], "a long, b long, what int")
    for found in done:
        edges = edges.unionByName(found.where("what < 2").select("a", "b", "what"))
    # the few pairs within the margin are compared exactly
    unit = classes.select("rep", "unit")
    unsure = edges.where("what = 1").select("a", "b").distinct()
    both = unsure.join(unit.withColumnsRenamed({"rep": "a", "unit": "x"}), "a")
    both = both.join(unit.withColumnsRenamed({"rep": "b", "unit": "y"}), "b")

    def exactly(table: pa.Table) -> pa.Table:
        vectors = [[np.frombuffer(v, np.float64) for v in table[c].to_pylist()] for c in ("x", "y")]
        ok = [float(x @ y) >= cosine for x, y in zip(*vectors, strict=True)]
        return table.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    sure = edges.where("what = 0").select("a", "b")
    return materialize(
        sure.union(map_arrow(both.select("a", "b", "x", "y"), exactly, "a long, b long")).distinct(), "edges"
    )


def _links(g: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """(rep, links) within one pair of blocks of a component, compared exactly."""
    alone = bool(g.alone.iloc[0])
    left, right = (g, g) if alone else (g[g.side == 0], g[g.side == 1])
    if not len(left) or not len(right):
        return pd.DataFrame({"rep": [], "links": []}).astype("int64")
    y, w, ry = _matrix(right.unit), right.n_rows.to_numpy(), right.rep.to_numpy()
    x, v, rx = _matrix(left.unit), left.n_rows.to_numpy(), left.rep.to_numpy()
    to_left, to_right = np.zeros(len(rx), np.int64), np.zeros(len(ry), np.int64)
    for at in range(0, len(rx), 512):
        hit = (x[at : at + 512] @ y.T >= cosine) & (rx[at : at + 512, None] != ry[None])
        to_left[at : at + 512] = hit @ w
        to_right += v[at : at + 512] @ hit
    if alone:
        return pd.DataFrame({"rep": rx, "links": to_left})
    return pd.DataFrame({"rep": np.concatenate([rx, ry]), "links": np.concatenate([to_left, to_right])})


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, recall: float = RECALL, seed: int = 17) -> DataFrame:
    """Per row of `embeddings` (vec_id, embedding): vec_id, n_links (other vectors with at least that cosine),
    component_id (the least vec_id that links lead to, itself included), kept (vec_id = component_id).

    Null and zero vectors, and vectors with a null or non-finite component, link with nothing. Vectors of different
    lengths are never compared. Equal vectors are compared once and counted with their number. A null vec_id comes
    back with nulls, no links, and not kept; rows that repeat a vec_id count as vectors of their own, equal or not.
    Other columns are ignored; an empty table gives no rows. Vectors are told apart by 128 bits of their digests.
    """
    rows = materialize(_units(embeddings), "units")
    valid = rows.where("vec_id is not null and unit is not null")
    classes = valid.groupBy("c1", "c2").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("n_rows"), F.first("unit").alias("unit"), F.first("dims").alias("dims")
    )
    # a number of each class, which the written table keeps
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    linked = components(candidate_edges(classes, cosine, recall, seed)).withColumnRenamed("node", "rep")
    members = classes.join(linked, "rep").select("rep", "n_rows", "unit", "component")
    dealt = block_pairs(members, "component", "rep", BLOCK_ROWS)
    counted = dealt.groupBy("pair").applyInPandas(lambda key, g: _links(g, cosine), "rep long, links long")
    counted = counted.groupBy("rep").agg(F.sum("links").alias("links"))
    names = linked.join(classes.select("rep", "least"), "rep").groupBy("component").agg(F.min("least").alias("name"))
    per_class = classes.select("c1", "c2", "rep", "least", "n_rows").join(linked, "rep", "left")
    per_class = per_class.join(names, "component", "left").join(counted, "rep", "left")
    n_links = F.coalesce("links", F.lit(0)) + F.col("n_rows") - 1
    per_class = per_class.select(
        "c1", "c2", F.coalesce("name", "least").alias("component_id"), n_links.alias("n_links")
    )
    named = F.col("vec_id").isNotNull()
    shown = rows.select("vec_id", "c1", "c2").join(per_class, ["c1", "c2"], "left")
    component = F.when(named, F.coalesce("component_id", "vec_id"))
    return shown.select(
        "vec_id",
        F.when(named, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
