"""Substring dedup (operator 1): line and paragraph hashing.

A text's units are its lines, long lines cut further at the ends of sentences, normalised in case and white space.
Units may be short, so what is hashed is a run of consecutive units with some words in all; a run's 128-bit digest
is grouped globally, the earliest occurrence by (document, position) is kept, and the units of every later one are
removed. Offsets are code points of the original text.

Two choices of runs: `runs` is what the operator's SQL states (the shortest run forward from each unit), `whole_runs`
adds what that loses: lines of fewer words than a run, the ends of passages, and passages inside long units.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillsync.llm.common import map_arrow, materialize

#: A run has at least so many words.
RUN_WORDS = 12
#: A digest is hot with more occurrences than HOT_ROWS and than one HOT_DIGESTS-th of all runs, so there are fewer hot ones than
#: HOT_DIGESTS, of 40 bytes each: these are joined by broadcast and no task gets all occurrences of one.
HOT_ROWS, HOT_DIGESTS = 1000, 100_000
#: Only digests whose bucket has as many rows as a hot digest are counted one by one.
BUCKETS = 1 << 18
#: whole_runs() cuts units of over twice a run's words between two words whose hash is a multiple of this.
CUT_EVERY = 6
_UNIT = re.compile(r"[^\n.!?]*(?:[.!?](?![\s])[^\n.!?]*)*[.!?]*")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\S+")


def units(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, normalised unit, words) of each unit that has a word."""
    out = []
    for m in _UNIT.finditer(text):
        words = m[0].lower().split()
        if words:
            body = m[0]
            start = m.start() + len(body) - len(body.lstrip())
            out.append((start, start + len(body.strip()), " ".join(words), len(words)))
    return out


def runs(text: str, least: int = RUN_WORDS) -> list[tuple[int, int, int, int]]:
    """(start, end, digest high, digest low) of the shortest run from each unit on that has `least` words."""
    found, out, j, words = units(text), [], 0, 0
    for i in range(len(found)):
        while j < len(found) and words < least:
            words += found[j][3]
            j += 1
        if words < least:
            break
        d = xxhash.xxh3_128_intdigest("\n".join(u[2] for u in found[i:j]))
        out.append((found[i][0], found[j - 1][1], (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63)))
        words -= found[i][3]
    return out


def _pieces(unit: tuple[int, int, str, int], text: str, least: int) -> list[tuple[int, int, str, int]]:
    """The unit, cut where it has over twice `least` words at places that follow from the two words around them alone, so that
    a passage is cut alike wherever it stands."""
    if unit[3] <= 2 * least:
        return [unit]
    found, out, k = [m.span() for m in _WORD.finditer(text, unit[0], unit[1])], [], 0
    words = [text[a:b].lower() for a, b in found]
    for i in range(1, len(words) + 1):
        if i == len(words) or xxhash.xxh3_64_intdigest(f"{words[i - 1]} {words[i]}") % CUT_EVERY == 0:
            out.append((found[k][0], found[i - 1][1], " ".join(words[k:i]), i - k))
            k = i
    return out


def whole_runs(text: str, least: int = RUN_WORDS) -> list[tuple[int, int, int, int]]:
    """(start, end, digest high, digest low) of each line of fewer than `least` words, and of the shortest runs of at least so
    many words forward and backward from each unit, long units being cut. Every line is covered by runs inside it."""
    found, ranges, line, words = [], set(), 0, 0
    for u in units(text):
        if found and text.find("\n", found[-1][1], u[0]) >= 0:
            if words < least:
                ranges.add((line, len(found)))
            line, words = len(found), 0
        found += _pieces(u, text, least)
        words += u[3]
    if found and words < least:
        ranges.add((line, len(found)))
    i, ahead, words = 0, 0, 0
    for j, u in enumerate(found, 1):
        words += u[3]
        while words - found[i][3] >= least:
            words -= found[i][3]
            i += 1
        if words >= least:
            ranges.add((i, j))  # backward from the unit before j, and forward from those that have the least here first
            ranges.update((k, j) for k in range(ahead, i))
            ahead = i + 1
    out = []
    for i, j in sorted(ranges):
        d = xxhash.xxh3_128_intdigest("\n".join(u[2] for u in found[i:j]))
        out.append((found[i][0], found[j - 1][1], (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63)))
    return out


def _named(documents: DataFrame) -> DataFrame:
    """(doc_id, text_id, text): 60 bits of a text's digest tell rows apart that share a doc_id."""
    text_id = F.conv(F.substring(F.md5(F.col("text").cast("binary")), 1, 15), 16, 10).cast("long")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_id.alias("text_id"), "text")


def repeated_spans(
    documents: DataFrame, least: int = RUN_WORDS, cut_text: Callable[[str, int], list[tuple[int, int, int, int]]] = runs
) -> DataFrame:
    """Rows (doc_id, text_id, start, end, keeper_id): the merged spans to remove from each document, and the least
    document that keeps an earlier occurrence of a part of it (null where only documents without an id keep one).

    The rank of an occurrence is (doc_id, text_id, start), null ids last. Rows with a null doc_id take part like the
    others. Rows that repeat doc_id and text are one document; rows that repeat a doc_id with another text are
    documents of their own, told apart by text_id. Null, empty and short texts have no runs and no rows (with
    whole_runs, short texts have their lines). Other columns are ignored; an empty table gives no rows. Texts of any
    length are cut whole; the spans of one document are merged in one place, and are fewer than its units.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = []
        for i, t, text in zip(*(table[c].to_pylist() for c in ("doc_id", "text_id", "text")), strict=True):
            if text:
                rows += [(i, t, a, b - a, *h) for a, b, *h in cut_text(text, least)]
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        return pa.table(
            [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "text_id", "start", "size", "h1", "h2"]
        )

    schema = "doc_id long, text_id long, start long, size long, h1 long, h2 long"
    cut = materialize(map_arrow(_named(documents), run, schema, rows=512), "runs")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_id", "start")
    limit = max(HOT_ROWS, cut.count() // HOT_DIGESTS)
    cut, hot = cut.withColumn("bucket", F.pmod("h2", F.lit(BUCKETS))), F.col("n") > limit
    full = F.broadcast(
        cut.groupBy("bucket").agg(F.count("*").alias("n")).where(hot).select("bucket", F.lit(True).alias("full"))
    )
    # the rows of other buckets are one group without a digest, which joins with nothing
    digest = [F.when(F.col("full"), F.col(h)).alias(h) for h in ("h1", "h2")]
    few = cut.join(full, "bucket", "left").groupBy(*digest).agg(F.min(rank).alias("first"), F.count("*").alias("n"))
    few = F.broadcast(materialize(few.where(hot).drop("n"), "hot"))
    # occurrences of a hot digest are dealt out one by one, as their first is known
    dealt = F.when(F.col("first").isNotNull(), F.xxhash64("doc_id", "text_id", "start"))
    held = cut.drop("bucket").join(few, ["h1", "h2"], "left").withColumn("deal", dealt)
    held = held.withColumn("first", F.coalesce("first", F.min(rank).over(Window.partitionBy("h1", "h2", "deal"))))
    later = held.where(~F.col("first").eqNullSafe(rank))
    span = F.struct("start", (F.col("start") + F.col("size")).alias("end"), F.col("first.doc_id").alias("keeper_id"))
    spans = later.groupBy("doc_id", "text_id").agg(F.array_sort(F.collect_set(span)).alias("spans"))

    def merge(table: pa.Table) -> pa.Table:
        rows = []
        for i, t, found in zip(*(table[c].to_pylist() for c in ("doc_id", "text_id", "spans")), strict=True):
            open_ = None
            for s in found:
                keeper = s["keeper_id"]
                if open_ and s["start"] <= open_[1] + 1:
                    least_keeper = min((k for k in (open_[2], keeper) if k is not None), default=None)
                    open_ = [open_[0], max(open_[1], s["end"]), least_keeper]
                else:
                    rows += [(i, t, *open_)] if open_ else []
                    open_ = [s["start"], s["end"], keeper]
            rows.append((i, t, *open_))
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        return pa.table(
            [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "text_id", "start", "end", "keeper_id"]
        )

    return map_arrow(spans, merge, "doc_id long, text_id long, start long, end long, keeper_id long")


def remove_spans(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """`documents` with each document's spans cut out of its text; rows without spans are unchanged."""
    cuts = spans.groupBy("doc_id", "text_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_cuts"))
    cuts = cuts.withColumnsRenamed({"doc_id": "_doc", "text_id": "_text"})
    keep = F.expr("""aggregate(_cuts, struct('' as text, cast(0 as bigint) as at),
        (s, c) -> struct(concat(s.text, substring(text, cast(s.at + 1 as int), cast(c.start - s.at as int))) as text, c.end as at),
        s -> concat(s.text, substring(text, cast(s.at + 1 as int))))""")
    text_id = F.conv(F.substring(F.md5(F.col("text").cast("binary")), 1, 15), 16, 10).cast("long")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_doc")) & (text_id == F.col("_text"))
    joined = documents.join(cuts, same, "left")
    cleaned = F.when(F.col("_cuts").isNull(), F.col("text")).otherwise(keep).alias("text")
    return joined.select(*[cleaned if c == "text" else F.col(c) for c in documents.columns])
