"""Near-duplicate documents by HyperMinHash.

Each document's word shingles fall into 128 buckets by the high bits of their
hash; a bucket's register keeps the number of leading zeros and ten mantissa
bits of its least value (16 bits in all). Documents with equal shingle sets
are one class, and only class representatives go on. Registers are banded in
fours: 32 band keys, so that two sets at the threshold miss each other in all
bands with a probability of 5e-8.

Links are found in two steps, and no bucket is ever expanded into its pairs:

1. every representative is verified against the bucket pivot (least id) with
   which it shares most bands, and components are formed;
2. only buckets that still hold several components are searched further: in
   cells of bounded size, pairs of different components are estimated from
   their registers, then from a finer sketch of 512 one-byte registers (both
   corrected for chance collisions), and those within ``SIGMAS`` standard
   errors of the threshold are verified. A pair inside a component can't change
   the result.

Verification compares whole shingle sets. The result is one row per document.

Defined cases: A-Z are lower-cased; words are runs of other than space and
9-13; a text with fewer words than a shingle has its whole sequence as one
shingle; null and empty texts have an empty set and are linked with nothing.
A row with a null id belongs to the component of its copies but is never its
name; it is kept only if no row with an id has its set. Rows that repeat an id
are judged each by their own text. No rows give no rows.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, graph, textnp

REGISTERS, ROWS = 128, 4
MANTISSA = 10
FINE = 512
PERCENT = 80
SIGMAS = 5
CELL = 2048
BLOCK_WORDS = 1 << 20
SLICE = 4 << 20


def registers(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set of 64-bit hashes (0: empty)."""
    out = np.zeros(REGISTERS, np.uint16)
    if len(shingles):
        bucket = (shingles >> np.uint64(57)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))  # sorted, so the least of each
        value = (shingles[first] & np.uint64((1 << 57) - 1)) >> np.uint64(5)
        bits = np.frexp(value.astype(np.float64))[1]
        shift = bits - 1 - MANTISSA
        mantissa = np.where(shift >= 0, value >> np.maximum(shift, 0).astype(np.uint64),
                            value << np.maximum(-shift, 0).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
        out[bucket[first]] = ((53 - bits) << MANTISSA) + mantissa.astype(np.int64)
    return out


def fine_registers(shingles: np.ndarray) -> np.ndarray:
    """A byte of the least value in each of ``FINE`` buckets (0: empty)."""
    out = np.zeros(FINE, np.uint8)
    if len(shingles):
        bucket = (shingles >> np.uint64(64 - FINE.bit_length() + 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        out[bucket[first]] = shingles[first] % np.uint64(255) + np.uint64(1)
    return out


def within_reach(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, chance: float) -> np.ndarray:
    """Which pairs of registers leave the threshold possible. ``chance`` is
    the probability that two different least values have equal registers.

    A filled bucket shows one element of the union, drawn without replacement,
    so the error shrinks as the buckets come to show all of the union."""
    both = (a > 0) & (b > 0)
    equal = ((a == b) & both).sum(-1)
    either = np.maximum(((a > 0) | (b > 0)).sum(-1), 1)
    equal = (equal - chance * both.sum(-1)) / (1 - chance)
    share = PERCENT / 100
    union = np.maximum((na + nb) / (1 + share), either)
    error = np.sqrt(share * (1 - share) / either * (1 - (either - 1) / union))
    return equal / either + SIGMAS * error >= share


#: Probability that two independent HyperMinHash registers are equal.
CHANCE = 0.1699 / (1 << MANTISSA)


def sketch(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """id, n (set size), cls (digest of the set), regs and fine of each document."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "text", SLICE):
            sets = textnp.shingle_sets(textnp.words(piece.column("text")), words)
            yield pa.RecordBatch.from_arrays([
                piece.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([registers(s).tobytes() for s in sets], pa.binary()),
                pa.array([fine_registers(s).tobytes() for s in sets], pa.binary())], ["id", "n", "cls", "regs", "fine"])

    return rows.mapInArrow(run, "id long, n long, cls binary, regs binary, fine binary")


def _linked(s: np.ndarray, t: np.ndarray) -> bool:
    both = np.sort(np.concatenate([s, t]))
    same = int((both[1:] == both[:-1]).sum())
    return len(both) > 0 and 100 * same >= PERCENT * (len(both) - same)


def verify(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets reach the threshold. Texts
    come by joins; a bounded list of pairs is broadcast to them."""
    pairs = common.hinted(pairs.select("a", "b"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    wanted = common.hinted(pairs.select(F.col("b").alias("id")).distinct())
    left = texts.join(pairs, texts.id == F.col("a")).select("a", "b", F.col("text").alias("text_a"))
    right = texts.join(wanted, "id", "left_semi").select(F.col("id").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "text_a", SLICE):
            b = piece.column("text_b").dictionary_encode()
            right_sets = textnp.shingle_sets(textnp.words(b.dictionary), words)
            good = []
            for s, j in zip(textnp.shingle_sets(textnp.words(piece.column("text_a")), words),
                            b.indices.to_pylist(), strict=True):
                good.append(_linked(s, right_sets[j]))
            yield pa.RecordBatch.from_arrays([piece.column("a"), piece.column("b")], ["a", "b"]).filter(pa.array(good))

    return left.join(right, "b").mapInArrow(run, "a long, b long")


def verify_blocks(docs: DataFrame, pairs: DataFrame, sizes: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """As ``verify``, for documents with many partners: ids are dealt into
    blocks of about ``BLOCK_WORDS`` words (``sizes``: rep, n), and a pair of
    blocks loads each of its documents once, whatever the number of pairs."""
    asked = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    total = asked.join(sizes, "rep").agg(F.sum("n")).first()[0] or 0
    blocks = F.lit(max(1, -(-total // BLOCK_WORDS)))
    of = lambda c: F.pmod(F.xxhash64(c), blocks).cast("int")
    dealt = pairs.select("a", "b", F.least(of("a"), of("b")).alias("i"), F.greatest(of("a"), of("b")).alias("j"))
    block = [F.col("i").alias("bi"), F.col("j").alias("bj")]
    wanted = common.hinted(dealt.select(F.col("a").alias("id"), *block).union(dealt.select("b", *block)).distinct())
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(wanted, "id")

    def run(pairs, texts):
        a, b = (pairs.column(c).to_numpy() for c in "ab")
        ids, sets = [], []
        for piece in common.slices(texts.to_batches(), "text", SLICE):
            ids.append(piece.column("id").to_numpy())
            sets += textnp.shingle_sets(textnp.words(piece.column("text")), words)
        ids = np.concatenate(ids or [np.zeros(0, np.int64)])
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        span = lambda x: zip(np.searchsorted(ids, x), np.searchsorted(ids, x, "right"), strict=True)
        good = np.zeros(len(a), bool)
        for k, ((p, q), (r, s)) in enumerate(zip(span(a), span(b), strict=True)):
            # rows that share an id link it if any of them does
            good[k] = any(_linked(sets[x], sets[y]) for x in order[p:q] for y in order[r:s])
        return pa.table({"a": a[good], "b": b[good]})

    return dealt.groupBy("i", "j").cogroup(texts.groupBy("bi", "bj")).applyInArrow(run, "a long, b long")


def open_pairs(cells: DataFrame) -> DataFrame:
    """Pairs of different components inside a cell (key, i, j, rep, side,
    label, n, regs, fine, band) that the registers can't rule out."""
    def one(t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        rep, label, size, regs, half = t["rep"], t["label"], t["n"].astype(float), t["regs"], t["half"]
        band = int(t["band"][0])
        out_a, out_b = [], []
        whole = t["i"][0] == t["j"][0]
        step = max(1, (4 << 20) // max(1, len(rep) * REGISTERS))
        for at in range(0, len(rep), step):
            x = np.arange(at, min(at + step, len(rep)))
            apart = (label[x][:, None] != label[None, :]) & (rep[x][:, None] < rep[None, :])
            if not whole:
                apart &= half[x][:, None] != half[None, :]
            ix, iy = np.nonzero(apart)
            for cut in range(0, len(ix), 1 << 14):
                a, b = x[ix[cut:cut + (1 << 14)]], iy[cut:cut + (1 << 14)]
                fits = 100 * np.minimum(size[a], size[b]) >= PERCENT * np.maximum(size[a], size[b])
                a, b = a[fits], b[fits]
                for table, chance in ((regs, CHANCE), (t["fine"], 1 / 255)):
                    fits = within_reach(table[a], table[b], size[a], size[b], chance)
                    a, b = a[fits], b[fits]
                # a pair that shares an earlier band is reported there
                same = (regs[a] == regs[b]).reshape(len(a), REGISTERS // ROWS, ROWS).all(2) & (regs[a].reshape(len(a), REGISTERS // ROWS, ROWS) > 0).any(2)
                new = same.argmax(1) == band
                out_a.append(rep[a[new]])
                out_b.append(rep[b[new]])
        return np.concatenate(out_a or [[]]).astype(np.int64), np.concatenate(out_b or [[]]).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def emit(table: pa.Table) -> Iterator[pa.RecordBatch]:
            t = {c: table.column(c).to_numpy() for c in table.column_names if c not in ("regs", "fine")}
            t["regs"] = textnp.flat(table.column("regs"))[0].view(np.uint16).reshape(-1, REGISTERS)
            t["fine"] = textnp.flat(table.column("fine"))[0].reshape(-1, FINE)
            new = np.flatnonzero(np.concatenate([[True], (t["key"][1:] != t["key"][:-1]) | (t["i"][1:] != t["i"][:-1]) | (t["j"][1:] != t["j"][:-1])]))
            for a, b in zip(new, np.append(new[1:], len(t["key"])), strict=True):
                x, y = one({k: v[a:b] for k, v in t.items()})
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            last = [held.column(c)[-1].as_py() for c in ("key", "i", "j")]
            same = np.logical_and.reduce([held.column(c).to_numpy() == v for c, v in zip(("key", "i", "j"), last, strict=True)])
            cut = len(same) - int(same.sum())
            if cut:
                yield from emit(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from emit(held)

    dealt = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept, links (those
    that were verified for its class)."""
    sketches = common.store(sketch(docs, id_col, text_col, words), "hmh-sketches")
    classes = common.store(sketches.where("n > 0 AND id IS NOT NULL").groupBy("cls").agg(
        F.min("id").alias("rep"), F.first("n").alias("n"), *[F.first(c).alias(c) for c in ("regs", "fine")]), "hmh-classes")
    width = 2 * ROWS
    cut = F.transform(F.sequence(F.lit(0), F.lit(REGISTERS // ROWS - 1)), lambda i: F.substring("regs", i * width + 1, F.lit(width)))
    bands = classes.select("rep", F.posexplode(cut).alias("band", "part")).where(F.col("part") != F.lit(bytes(width))) \
        .select("rep", "band", F.xxhash64("band", "part").alias("key"))
    shared = bands.groupBy("key").agg(F.min("rep").alias("pivot"), F.count("*").alias("members")).where("members > 1")
    members = common.store(bands.join(shared, "key"), "hmh-members")

    star = members.where("rep <> pivot").groupBy("rep", "pivot").agg(F.count("*").alias("bands"))
    star = star.groupBy("rep").agg(F.max(F.struct("bands", (-F.col("pivot")).alias("other"))).alias("best"))
    star = common.store(star.select(F.col("rep").alias("a"), (-F.col("best.other")).alias("b")), "hmh-star")
    links = common.store(verify(docs, star, id_col, text_col, words), "hmh-links")

    labels = graph.components(links)
    named = members.join(labels, members.rep == labels.node, "left").select("key", "band", "rep", F.coalesce("label", "rep").alias("label"))
    mixed = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("m")).where("lo < hi")
    mixed = mixed.select("key", F.ceil(F.col("m") / CELL).cast("int").alias("parts"))
    cells = named.join(mixed, "key").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = cells.select("key", "band", "rep", "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("half"))
    cells = cells.join(classes.select("rep", "n", "regs", "fine"), "rep")
    pairs = common.store(open_pairs(cells), "hmh-pairs")
    more = common.store(verify_blocks(docs, pairs, classes, id_col, text_col, words), "hmh-more")
    links = links.unionByName(more)
    labels = graph.components(links)

    degree = links.select("a").unionByName(links.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("rep")).agg(F.count("*").alias("links"))
    named = classes.select("cls", "rep").join(labels, F.col("rep") == labels.node, "left") \
        .join(degree, "rep", "left").select("cls", F.coalesce("label", "rep").alias("component_id"), F.coalesce("links", F.lit(0)).alias("links"))
    out = sketches.select("id", "n", F.when(F.col("n") > 0, F.col("cls")).alias("cls")).join(named, "cls", "left")
    own = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"),
                      F.col("id").eqNullSafe(own).alias("kept"), F.coalesce("links", F.lit(0)).alias("links"))
