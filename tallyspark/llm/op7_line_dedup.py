"""Line dedup: an exact set-similarity join of lines.

A line is the set of its words. It is removed if an earlier line (smaller id,
or same document and earlier line) has a Jaccard index of 0.8 or more with it;
lines are judged on the input. Lines with equal sets form a class, so copies
collapse before any shuffle, and a line goes iff it is not its class's first
or its class is linked with one that begins earlier.

* Words are counted over all lines. The most frequent ones, ``TABLE_WORDS`` at
  most, are broadcast with their rank; all others are rarer. A line's words
  are ordered by rarity and the first n - ceil(0.8 n) + 1 index it.
* Index entries are shuffled as packed arrays, and lines meet on an index word.
  Length, positional and bitmap filters (two lines at the threshold differ in
  few words, so in few bits of a 128-bit parity signature) reject pairs without
  losing any at the threshold.
* Each line is first held against the earliest line that passes the filters on
  each index word, and only lines for which that one fails verification against
  all earlier ones, so many variants of one line don't meet pairwise.
* Pairs are verified on their whole lines.

Words are runs of other than space and 9-13, with A-Z lower-cased, known by
48-bit hashes. Defined cases: lines without words stay and match nothing; null
and empty texts have no such line; null ids come first; rows that repeat an id
are judged each, and lines at the same place of such rows are not earlier than
one another; no rows give no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, textnp

TABLE_WORDS = 4_000_000
SLICE = 4 << 20
#: Lines that are held against all earlier ones in one go (their places are broadcast).
OPEN_BLOCK = 200_000
_U = np.uint64
_TOKEN = _U((1 << 48) - 1)
_RANKED = _U(1 << 47)
_FAR = np.iinfo(np.int64).min


class Lines:
    """Word sets of the lines of a batch of texts (lines with words only)."""

    def __init__(self, column: pa.Array):
        w = textnp.words(column)
        breaks = np.flatnonzero(w.data == 10)
        first = np.searchsorted(breaks, w.offsets)
        self.per_text = np.diff(first) + (np.diff(w.offsets) > 0)
        from_text = np.concatenate([[0], np.cumsum(np.diff(first) + 1)])
        starts = np.sort(np.concatenate([w.offsets[:-1], breaks + 1]))
        line = np.searchsorted(starts, w.start, "right") - 1
        token = w.hash >> _U(16)
        keys, base = [], []
        edge = np.searchsorted(line, np.arange(0, len(starts) + (1 << 16), 1 << 16))
        for k, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
            if b > a:
                key = np.sort(((line[a:b] - (k << 16)).astype(_U) << _U(48)) | token[a:b])
                key = key[np.concatenate([[True], key[1:] != key[:-1]])]
                keys.append(key)
                base.append(np.full(len(key), k << 16))
        key = np.concatenate(keys) if keys else np.zeros(0, _U)
        of_line = (key >> _U(48)).astype(np.int64) + (np.concatenate(base) if base else 0)
        self.token = key & _TOKEN
        new = np.flatnonzero(np.concatenate([[True], of_line[1:] != of_line[:-1]])) if len(key) else np.zeros(0, np.int64)
        self.edge = np.append(new, len(key))
        self.n = np.diff(self.edge)
        number = of_line[new]
        self.text = np.searchsorted(from_text, number, "right") - 1
        self.place = number - from_text[self.text]
        if len(key):
            self.k1 = np.add.reduceat(textnp.mix(self.token), new).view(np.int64)
            self.k2 = np.add.reduceat(textnp.mix(self.token ^ _U(0x5DEECE66D1234567)), new).view(np.int64)
        else:
            self.k1 = self.k2 = np.zeros(0, np.int64)

    def signatures(self) -> list[np.ndarray]:
        """128 bits per line: the parity of the number of words that fall on
        each, so that two signatures differ in no more bits than their lines
        do in words, however long they are."""
        bit = textnp.mix(self.token + _U(7))
        out = []
        for half in (_U(0), _U(1)):
            own = np.where(bit & _U(1) == half, _U(1) << ((bit >> _U(1)) & _U(63)), _U(0))
            out.append(np.bitwise_xor.reduceat(own, self.edge[:-1]) if len(self.n) else np.zeros(0, _U))
        return out


class Rarity:
    """Rank of the frequent words; all others are rarer than these."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, complete: bool):
        rank = np.empty(len(tokens), np.int64)
        rank[np.lexsort((tokens, counts))] = np.arange(len(tokens))
        order = np.argsort(tokens)
        self.tokens, self.rank, self.complete = tokens[order], rank[order], complete
        self.shift = 48 - max(1, min(22, len(tokens).bit_length()))
        self.start = np.searchsorted(self.tokens >> _U(self.shift), np.arange((1 << (48 - self.shift)) + 1).astype(_U))

    def order(self, token: np.ndarray) -> np.ndarray:
        """A 48-bit number for each token that grows with its frequency."""
        out = token & (_RANKED - _U(1))
        cell = (token >> _U(self.shift)).astype(np.int64)
        at, end = self.start[cell], self.start[cell + 1]
        live = np.flatnonzero(at < end)
        at, end = at[live], end[live]
        while len(live):
            hit = self.tokens[at] == token[live]
            out[live[hit]] = _RANKED | self.rank[at[hit]].astype(_U)
            at = at + 1
            more = ~hit & (at < end)
            live, at, end = live[more], at[more], end[more]
        return out


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - (4 * n + 4) // 5 + 1


def _scan(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of two kinds: a line (row, id, line, n, k1, k2, text's number of
    lines) or, with ``bucket``, the tokens of a slice with their counts."""
    schema = "row long, id long, place int, n int, k1 long, k2 long, n_lines int, bucket int, tokens binary, counts binary"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    types = [kinds[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "text", SLICE):
            lines = Lines(piece.column("text"))
            rows, ids = piece.column("row").to_numpy(), piece.column("id")
            none = np.setdiff1d(np.arange(piece.num_rows), lines.text)  # texts without such a line have one row as well
            text = np.concatenate([lines.text, none]).astype(np.int64)
            fill = lambda x: pa.array(np.concatenate([x, np.zeros(len(none), np.int64)]), mask=np.concatenate([np.zeros(len(x), bool), np.ones(len(none), bool)]))
            m = len(text)
            own = [pa.array(rows[text]), ids.take(pa.array(text)), fill(lines.place).cast(pa.int32()), fill(lines.n).cast(pa.int32()), fill(lines.k1), fill(lines.k2),
                   pa.array(lines.per_text[text], pa.int32())]
            yield pa.RecordBatch.from_arrays([*own, *[pa.nulls(m, t) for t in types[7:]]], names)
            tokens, counts = np.unique(lines.token, return_counts=True)
            edge = np.searchsorted((tokens >> _U(16)) * _U(buckets) >> _U(32), np.arange(buckets + 1).astype(_U))
            used = [b for b in range(buckets) if edge[b + 1] > edge[b]]
            yield pa.RecordBatch.from_arrays([
                *[pa.nulls(len(used), t) for t in types[:7]], pa.array(used, pa.int32()),
                pa.array([common.blob(tokens[edge[b]:edge[b + 1]]) for b in used], pa.binary()),
                pa.array([common.blob(counts[edge[b]:edge[b + 1]].astype("<u4")) for b in used], pa.binary())], names)

    return docs.mapInArrow(run, schema)


def word_table(scan: DataFrame, limit: int = TABLE_WORDS) -> Rarity:
    """The most frequent words (at least two lines), ``limit`` at most."""
    def add(key, table):
        token = np.concatenate([np.frombuffer(x, "<u8") for x in table.column("tokens").to_pylist()])
        count = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()])
        token, at = np.unique(token, return_inverse=True)
        count = np.bincount(at, count).astype(np.int64)
        many = count >= 2
        level = np.bincount(np.log2(count[many]).astype(int), minlength=48)
        return pa.table({"tokens": [common.blob(token[many])], "counts": [common.blob(count[many])], "levels": pa.array([level.tolist()], pa.list_(pa.int64()))})

    blobs = scan.where("bucket IS NOT NULL").select("bucket", "tokens", "counts")
    summed = common.store(blobs.groupBy("bucket").applyInArrow(add, "tokens binary, counts binary, levels array<long>"), "line-words")
    levels = {r.pos: r.n for r in summed.select(F.posexplode("levels")).groupBy("pos").agg(F.sum("col").alias("n")).collect()}
    least, total = 48, 0
    while least > 1 and total + levels.get(least - 1, 0) <= limit:
        least -= 1
        total += levels.get(least, 0)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for token, count in zip(batch.column("tokens").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                token, count = np.frombuffer(token, "<u8"), np.frombuffer(count, "<i8")
                keep = count >= 1 << least
                yield pa.RecordBatch.from_arrays([pa.array([common.blob(token[keep])], pa.binary()), pa.array([common.blob(count[keep])], pa.binary())], ["tokens", "counts"])

    got = summed.select("tokens", "counts").mapInArrow(frequent, "tokens binary, counts binary").collect()  # ``limit`` words at most
    join = lambda name, kind: np.concatenate([np.frombuffer(r[name], kind) for r in got] or [np.zeros(0, kind)])
    return Rarity(join("tokens", "<u8").astype(_U), join("counts", "<i8"), least == 1)


_ENTRY = ["token", "id", "place", "n", "i", "bits", "more"]
_ENTRIES = "bucket int, base long, size int, " + ", ".join(f"`{c}` binary" for c in _ENTRY)
_PAIR = ["xid", "xplace", "yid", "yplace"]
_PAIRS = ", ".join(f"{c} long" for c in _PAIR)


def _pack(values: np.ndarray) -> bytes:
    """Unsigned integers in as few bytes each as the largest needs."""
    size = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return common.blob(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size])


def _unpack(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    raw = np.frombuffer(data, np.uint8).reshape(n, -1)
    out[:, :raw.shape[1]] = raw
    return out.view("<u8").ravel()


def _index(docs: DataFrame, sent, buckets: int) -> DataFrame:
    """Index entries of the lines of each slice (one line per class), as
    packed columns per bucket of tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "text", SLICE):
            lines = Lines(piece.column("text"))
            if not len(lines.n):
                continue
            ids = np.array([_FAR if x is None else x for x in piece.column("id").to_pylist()], np.int64)[lines.text]
            order = np.lexsort((lines.place, ids, lines.k2, lines.k1))
            k1, k2 = lines.k1[order], lines.k2[order]
            first = np.sort(order[np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])])
            bits, more = lines.signatures()
            rank = sent.value.order(lines.token)
            got = []
            for a in range(0, len(first), 1 << 16):
                own = first[a:a + (1 << 16)]
                n = lines.n[own]
                at = np.repeat(lines.edge[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
                number = np.repeat(np.arange(len(own)), n)
                key = np.sort((number.astype(_U) << _U(48)) | rank[at])
                i = np.arange(len(key)) - np.repeat(np.cumsum(n) - n, n)
                token = key & _TOKEN
                good = i < prefix_length(n)[number]
                if sent.value.complete:  # a word of one line only meets nothing
                    good &= token >= _RANKED
                line = own[number[good]]
                got.append((token[good], ids[line], lines.place[line], lines.n[line], i[good], bits[line], more[line]))
            columns = [np.concatenate(c) for c in zip(*got, strict=True)]
            if not len(columns[0]):
                continue
            bucket = (textnp.mix(columns[0]) % _U(buckets)).astype(np.int64)
            order = np.lexsort((columns[0], bucket))
            columns, edge = [c[order] for c in columns], np.searchsorted(bucket[order], np.arange(buckets + 1))
            used = np.flatnonzero(edge[1:] > edge[:-1])
            base = [int(columns[1][edge[b]:edge[b + 1]].min()) for b in used]
            columns[1] = columns[1].view(_U) - np.repeat(np.array(base, np.int64).view(_U), np.diff(edge)[used])
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(base, pa.int64()), pa.array(np.diff(edge)[used], pa.int32()), *[
                pa.array([_pack(c[edge[b]:edge[b + 1]]) for b in used], pa.binary()) for c in columns]], ["bucket", "base", "size", *_ENTRY])

    return docs.mapInArrow(run, _ENTRIES)


def _may_match(x: dict[str, np.ndarray], y: dict[str, np.ndarray]) -> np.ndarray:
    """Filters that no pair at the threshold fails on its first common index
    word: sizes, positions and signatures leave enough common words."""
    nx, ny = x["n"].astype(np.int64), y["n"].astype(np.int64)
    need = (4 * (nx + ny) + 8) // 9
    good = 5 * np.minimum(nx, ny) >= 4 * np.maximum(nx, ny)
    good &= np.minimum(nx - x["i"], ny - y["i"]) >= need
    differ = np.bitwise_count(x["bits"] ^ y["bits"]).astype(np.int64) + np.bitwise_count(x["more"] ^ y["more"])
    good &= differ <= nx + ny - 2 * need
    return good & ((y["id"] < x["id"]) | ((y["id"] == x["id"]) & (y["place"] < x["place"])))


def _candidates(entries: DataFrame, buckets: int, only=None) -> DataFrame:
    """For each line and index word the earliest line that may match it; with
    ``only`` (a broadcast set of places) all lines that may match those."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = []
        for batch in batches:
            for base, *packed in zip(batch.column("base").to_pylist(), *[batch.column(c).to_pylist() for c in ("size", *_ENTRY)], strict=True):
                n, *packed = packed
                part = [_unpack(x, n) for x in packed]
                part[1] = (part[1] + np.array([base], np.int64).view(_U)).view(np.int64)
                got.append([x if k < 2 or k >= 5 else x.astype(np.uint32) for k, x in enumerate(part)])
        if not got:
            return
        e = {c: np.concatenate([part[k] for part in got]) for k, c in enumerate(_ENTRY)}
        got.clear()
        order = np.argsort(e["token"], kind="stable")
        token = e["token"][order]
        again = np.zeros(len(token) + 1, bool)
        again[1:-1] = token[1:] == token[:-1]
        order = order[again[:-1] | again[1:]]  # a token that only one line has meets nothing
        e = {c: v[order] for c, v in e.items()}
        order = np.lexsort((e["place"], e["id"], e["token"]))
        e = {c: v[order] for c, v in e.items()}
        start = np.concatenate([[True], e["token"][1:] != e["token"][:-1]]) if len(order) else np.zeros(0, bool)
        first = np.maximum.accumulate(np.where(start, np.arange(len(start)), 0)) if len(order) else np.zeros(0, np.int64)
        x = np.flatnonzero(~start)
        if only is not None:
            x = x[np.fromiter(((i, p) in only.value for i, p in zip(e["id"][x].tolist(), e["place"][x].tolist(), strict=True)), bool, len(x))]
        y = first[x]
        out = []
        while len(x):  # one step further in all groups at once
            good = _may_match({c: v[x] for c, v in e.items()}, {c: v[y] for c, v in e.items()})
            out.append(np.stack([e["id"][x[good]], e["place"][x[good]].astype(np.int64), e["id"][y[good]], e["place"][y[good]].astype(np.int64)]))
            y = y + 1
            more = y < x if only is not None else (y < x) & ~good
            x, y = x[more], y[more]
        if out:
            pairs = np.unique(np.concatenate(out, 1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in pairs], _PAIR)

    return entries.repartitionById(buckets, F.col("bucket")).mapInArrow(run, _PAIRS).distinct()


def _verify(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(k1, k2, xid, xplace, yid, yplace): pairs whose whole lines reach 0.8,
    with the class of the later line."""
    wanted = pairs.select(F.col("xid").alias("id"), F.col("xplace").alias("place")).union(pairs.select("yid", "yplace")).distinct()
    wanted = common.hinted(wanted)
    texts = docs.select(F.coalesce("id", F.lit(_FAR)).alias("of"), "text")
    lines = texts.join(wanted, texts.of == wanted.id).select(
        "id", "place", F.element_at(F.split("text", "\n"), F.col("place").cast("int") + 1).alias("line"))
    lines = common.store(lines, "line-texts")
    x = lines.select(F.col("id").alias("xid"), F.col("place").alias("xplace"), F.col("line").alias("x"))
    y = lines.select(F.col("id").alias("yid"), F.col("place").alias("yplace"), F.col("line").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "x", SLICE):
            x, y = (textnp.shingle_sets(textnp.words(piece.column(c)), 1) for c in "xy")
            lines = Lines(piece.column("x"))
            classes = np.zeros((2, piece.num_rows), np.int64)
            classes[:, lines.text] = lines.k1, lines.k2
            good = np.zeros(piece.num_rows, bool)
            for k, (a, b) in enumerate(zip(x, y, strict=True)):
                both = np.sort(np.concatenate([a, b]))
                same = int((both[1:] == both[:-1]).sum())
                good[k] = len(both) > 0 and 5 * same >= 4 * (len(both) - same)
            own = [piece.column(c) for c in _PAIR]
            yield pa.RecordBatch.from_arrays([pa.array(classes[0]), pa.array(classes[1]), *own], ["k1", "k2", *_PAIR]).filter(pa.array(good))

    # documents can share an id, and then each of their lines at a place is held against the pair's other side
    both = pairs.join(x, ["xid", "xplace"]).join(y, ["yid", "yplace"]).select(*_PAIR, "x", "y")
    return both.mapInArrow(run, f"k1 long, k2 long, {_PAIRS}")


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_words: int = TABLE_WORDS) -> DataFrame:
    """One row per document: id, n_lines, n_removed, removed (numbers of the
    removed lines, from 0)."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scan = common.store(_scan(rows.withColumn("row", F.monotonically_increasing_id()), buckets), "line-scan")
    rarity = spark.sparkContext.broadcast(word_table(scan, table_words))

    pairs = common.store(_candidates(_index(rows, rarity, buckets), buckets), "line-pairs")
    best = pairs.groupBy("xid", "xplace").agg(F.min(F.struct("yid", "yplace")).alias("y")).select("xid", "xplace", "y.*")
    found = common.store(_verify(rows, best), "line-found")
    # the other index words' candidates of lines whose earliest one failed, then all of the rest
    without = lambda df, done: df.join(done.select("xid", "xplace").distinct(), ["xid", "xplace"], "left_anti")
    other = common.store(without(pairs, found).join(best, _PAIR, "left_anti"), "line-pairs")
    found = found.unionByName(common.store(_verify(rows, other), "line-found"))
    later = common.store(without(pairs.select("xid", "xplace").distinct(), found), "line-open")
    blocks = -(-later.count() // OPEN_BLOCK)
    for b in range(blocks):  # mostly none or one
        own = later.where(F.pmod(F.xxhash64("xid", "xplace"), F.lit(blocks)) == b).collect()
        only = spark.sparkContext.broadcast({(r.xid, r.xplace) for r in own})
        rest = common.store(_candidates(_index(rows, rarity, buckets), buckets, only).join(pairs, _PAIR, "left_anti"), "line-pairs")
        found = found.unionByName(common.store(_verify(rows, rest), "line-found"))

    lines = scan.where("bucket IS NULL")
    here = F.struct(F.coalesce("id", F.lit(_FAR)).alias("id"), F.col("place").cast("long").alias("place"))
    earlier = found.groupBy("k1", "k2").agg(F.min(F.struct(F.col("yid").alias("id"), F.col("yplace").alias("place"))).alias("match"))
    classes = lines.where("k1 IS NOT NULL").groupBy("k1", "k2").agg(F.min(here).alias("first"), F.count("*").alias("copies"))
    classes = classes.join(earlier, ["k1", "k2"], "left").withColumn("linked", F.coalesce(F.col("match") < F.col("first"), F.lit(False)))
    classes = classes.where("copies > 1 OR linked").drop("match", "copies")
    judged = lines.join(classes, ["k1", "k2"], "left")
    gone = F.coalesce(F.col("linked") | (F.col("first") < here), F.lit(False))
    out = judged.groupBy("row", "id").agg(F.max("n_lines").alias("n_lines"), F.sum(gone.cast("long")).alias("n_removed"),
                                          F.sort_array(F.collect_list(F.when(gone, F.col("place")))).alias("removed"))
    return out.select(F.col("id").alias(id_col), F.col("n_lines").cast("long").alias("n_lines"), "n_removed", "removed")


def without_lines(docs: DataFrame, judged: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed lines taken out of the text."""
    gone = judged.where("n_removed > 0").select(F.col(id_col).alias("_gone_of"), F.col("removed").alias("_gone_lines"))
    both = docs.join(common.hinted(gone), docs[id_col].eqNullSafe(F.col("_gone_of")), "left")
    kept = F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains("_gone_lines", i))
    return both.withColumn(text_col, F.when(F.col("_gone_lines").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))).select(*docs.columns)
