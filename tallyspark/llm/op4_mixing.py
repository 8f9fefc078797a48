"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source is cut into the same number of shards by its documents' seeded
order, and each shard's words, counted through in that order, into blocks of
one size, of which only the very last of a shard may be partial. The blocks of
the mix are seats: they go to the sources by the highest quotients target /
(2 k + 1), and a source's seats to its shards by words / (2 k + 1), so every
shard has an integer quota. It is met by whole passes over the shard and, for
the rest, by evenly spaced blocks from a seeded start. A document's taken words
are the parts of the chosen blocks that lie in it. A block is small against the
whole mix and against the least target over all its shards, so a source misses
its target by about 0.1 % or a few words.

Only sizes are handled here (id, source, words), never texts. Running totals
are taken inside parts of a shard first, then offsets over the parts' sums, so
the result does not depend on the parts. Documents without words take no part
in them. The tables of sources and of one source's shards are the only ones
that meet in one task.

Defined cases: a null or empty text has size 0 and is never taken; the null
source is a source of its own and comes last; documents with equal ids are
separate rows; no rows give no rows. Reruns agree: the order depends on md5 of
the seed and the id.
"""
from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

CYCLE = (1, 2, 3)
#: Blocks that the mix is cut into at least, while a block has one word or more.
BLOCKS = 1_000_000
BLOCK_WORDS = 1024
#: Blocks that the least target's part in a shard is cut into at least, while a block has one word or more.
SOURCE_BLOCKS = 1000
#: Words of all sources in a shard, and of one source's shard in a part.
SHARD_WORDS = 1 << 21
MOST = 3
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE)), F.lit(0)).cast("long")


def sainte_lague(weights: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats by the highest quotients weight / (2 k + 1), at most ``caps``
    each; equal quotients go to the earlier weight first."""
    weights, caps = np.asarray(weights, float), np.asarray(caps, np.int64)
    out = np.zeros(len(weights), np.int64)
    total = float(weights.sum())
    if total <= 0 or seats <= 0:
        return out
    if seats > len(weights):  # quotients that are surely among the highest
        divisor = total / (seats - len(weights) / 2)
        out = np.minimum(np.maximum(np.floor(weights / divisor + 0.5).astype(np.int64) - 1, 0), caps)
    heap = [(-w / (2 * k + 1), i) for i, (w, k, c) in enumerate(zip(weights, out, caps, strict=True)) if w > 0 and k < c]
    heapq.heapify(heap)
    for _ in range(seats - int(out.sum())):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < caps[i]:
            heapq.heappush(heap, (-weights[i] / (2 * out[i] + 1), i))
    return out


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE, most: int = MOST) -> DataFrame:
    """Source, rank, source_size and target from (source, size) rows: weights
    cycle over the sources by code point, targets stop at ``most`` times the
    source's size and the excess is shared anew by weight."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("source_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (F.col("source_rank") - 1) % len(cycle) + 1))
    cap = F.col("source_size") * most
    by_cap = Window.orderBy((cap / F.col("weight")).asc(), "source_rank")
    rest = by_cap.rowsBetween(0, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumns({
        "left": F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0)),
        "rest_weight": F.sum("weight").over(rest),
    })
    # sources up to the first that its share does not fill stand at their cap
    s = s.withColumn("open", cap * F.col("rest_weight") > F.col("left") * F.col("weight"))
    s = s.withColumn("at", F.min(F.when(F.col("open"), F.struct((cap / F.col("weight")).alias("ratio"), F.col("source_rank").alias("rank"),
                                                                 "left", "rest_weight"))).over(everything))
    later = F.struct((cap / F.col("weight")).alias("ratio"), F.col("source_rank").alias("rank")) >= \
        F.struct(F.col("at.ratio").alias("ratio"), F.col("at.rank").alias("rank"))
    share = F.col("at.left").cast("double") * F.col("weight") / F.col("at.rest_weight")
    target = F.when(F.col("at").isNotNull() & later, share).otherwise(cap.cast("double"))
    return s.select("source", "source_rank", "source_size", target.alias("target"))


def _order(seed: str, ids: Column) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(ids.cast("string"), F.lit("null"))))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: str = "mix", shard_words: int = SHARD_WORDS, blocks: int = BLOCKS,
        block_words: int = BLOCK_WORDS, seat_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: id, source, size, source_size, target, taken.
    ``seat_words`` sets the number of shards, ``shard_words`` that of the parts
    that their running totals are taken in."""
    rows = common.store(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                    word_count(F.col(text_col)).alias("size")), "mix-sizes")
    sources = common.store(source_targets(rows), "mix-sources")
    total, least = sources.agg(F.sum("source_size"), F.min(F.when(F.col("target") > 0, F.col("target")))).first()
    total, least = total or 0, least or 0.0
    shards = max(1, -(-total // seat_words))
    block = max(1, min(block_words, total // blocks, int(least) // (SOURCE_BLOCKS * shards)))

    named = rows.join(sources, rows.source.eqNullSafe(sources.source)).select(rows["*"], *[c for c in sources.columns if c != "source"])
    words = named.where("size > 0").withColumn("o", _order(seed, F.col("id")))
    draw = F.conv(F.substring("o", 1, 8), 16, 10).cast("long")
    # ranges of the order, so that the parts of a shard follow each other in it
    parts = F.ceil(F.col("source_size") / F.lit(shards * shard_words)).cast("long")
    words = words.withColumns({"shard": draw % shards, "part": F.shiftright(draw * parts, 32)})
    inside = Window.partitionBy("source_rank", "shard", "part").orderBy("o", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = common.store(words.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))), "mix-placed")

    before = Window.partitionBy("source_rank", "shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("source_rank", "shard", "part").agg(F.sum("size").alias("words"))
    offsets = common.store(offsets.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0))), "mix-offsets")
    cells = offsets.groupBy("source_rank", "shard").agg(F.sum("words").alias("words"))
    cells = cells.withColumn("n", F.ceil(F.col("words") / F.lit(block)).cast("long"))

    def source_seats(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("source_rank")
        target = part.target.to_numpy(float)
        return pd.DataFrame({"source_rank": part.source_rank, "seats": sainte_lague(target, int(target.sum() / block + 0.5), MOST * part.n.to_numpy(np.int64))})

    def shard_quotas(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("shard")
        n = part.n.to_numpy(np.int64)
        quota = sainte_lague(part.words.to_numpy(float), int(part.seats.iloc[0]), MOST * n)
        return pd.DataFrame({"source_rank": part.source_rank, "shard": part["shard"], "n": n, "full": quota // n, "rem": quota % n})

    count = cells.groupBy("source_rank").agg(F.sum("n").alias("n"))
    seats = sources.join(count, "source_rank").select("source_rank", "target", "n").groupBy().applyInPandas(source_seats, "source_rank int, seats long")
    quotas = cells.join(seats, "source_rank").groupBy("source_rank").applyInPandas(shard_quotas, "source_rank int, shard long, n long, full long, rem long")
    quotas = common.store(quotas, "mix-quotas")
    cell = placed.join(offsets.drop("words"), ["source_rank", "shard", "part"]).join(quotas, ["source_rank", "shard"])

    n, rem, unit, at = F.col("n"), F.col("rem"), F.lit(block), F.col("inside") + F.col("offset")
    cell = cell.withColumn("turn", F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "source_rank", "shard")), 1, 8), 16, 10).cast("long") % n)
    div = lambda x, y: F.call_function("div", x, y)
    # block b is one of the evenly spaced ones iff the multiples of rem step over a multiple of n at b
    # so that the number of chosen ones before a block follows from one division
    steps = lambda y: div(y * rem, n)
    upto = lambda b: steps(b + F.col("turn")) - steps(F.col("turn"))
    chosen = lambda x: upto(div(x, unit)) * unit + (upto(div(x, unit) + 1) - upto(div(x, unit))) * (x % unit)
    taken = F.col("size") * F.col("full") + chosen(at + F.col("size")) - chosen(at)
    out = [F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target"]
    return cell.select(*out, taken.cast("long").alias("taken")).unionByName(named.where("size = 0").select(*out, F.lit(0).cast("long").alias("taken")))
