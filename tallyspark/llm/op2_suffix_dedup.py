"""Exact substring dedup: bytes in a 100-byte string that also starts earlier.

1. Shards. Consecutive documents of a scan partition, about one megabyte, make
   a shard. Its suffix array is built by Larsson-Sadakane refinement (prefix
   doubling of unsorted groups only, as sorts of packed integers), the common
   prefixes of neighbours by Kasai's rule (along a run of positions whose
   neighbours advance with them a prefix shortens by one). Neighbours that
   share 100 bytes form groups; all but the first string of a group are
   covered. So a shard sends on each string once at most.
2. Merge across shards. The strings that are left are owned by anchors: of the
   32-byte grams in a 100-byte string, the one with the least hash, so equal
   strings have the same anchor at the same place. Each shard sends sorted runs
   of (anchor, hash of the strings it owns, place); a merge task holds a range
   of anchor hashes and places every run in the merged list by binary search.
   Equal neighbourhoods are covered from their second place on.
3. Anchors with several neighbourhoods (where copies begin, end or differ) send
   the bytes of one place of each to a second merge, which again builds suffix
   arrays over them. Anchors with very many neighbourhoods send their strings
   one by one under the strings' own hashes, so no task holds them all.
4. Covered ranges meet their document and the rest is hashed.

Strings never cross documents; the order of places is (id, row, start). Step 2
takes neighbourhoods with equal 64-bit anchors and equal 128-bit hashes as
equal; all other comparisons are of bytes.

Defined cases: null and empty texts have no bytes and an empty digest; null ids
come first; rows that repeat an id are ordered by their place in the table, so
of equal rows all but one are removed; no rows give no rows.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, textnp

LENGTH = 100
GRAM = 32
SHARD = 1 << 20
#: Neighbourhoods of one anchor from which its strings are sent one by one.
MANY = 4096
#: Bytes of covered ranges that may be broadcast to the last pass.
BROADCAST_BYTES = 32 << 20
_U = np.uint64
_FIRST = np.iinfo(np.int64).min


# --- one shard -------------------------------------------------------------------------------------------------------

def suffix_array(data: np.ndarray, depth: int, places: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` bytes, and for each a
    bound of the prefix it shares with the one before it (it is shorter than
    the bound; 0: not told apart). With ``places`` (ascending) only the
    suffixes that start there; every other place counts as unlike all others.

    Larsson-Sadakane: suffixes start sorted by a few bytes; then only groups
    that are not told apart are sorted again, by the rank ``h`` bytes on."""
    n = len(data)
    places = np.arange(n) if places is None else places
    m = len(places)
    bits, wide_bits = max(1, int(m).bit_length()), int(2 * n + 1).bit_length()
    wide = 2 * bits + wide_bits <= 64
    h = (64 - bits) // 8 if wide else 4
    mask = _U((1 << bits) - 1)
    padded = np.concatenate([data, np.zeros(h, np.uint8)])
    key = np.zeros(m, _U)
    for i in range(h):
        key = (key << _U(8)) | padded[places + i]
    key = np.sort((key << _U(bits)) | np.arange(m, dtype=_U))
    sa = places[(key & mask).astype(np.int64)]
    new = np.ones(m, bool)
    new[1:] = (key[1:] >> _U(bits)) != (key[:-1] >> _U(bits))
    bound = np.where(new, h, 0).astype(np.int32)
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, m))
    rank = np.arange(n, 2 * n)  # unlike all others
    rank[sa] = np.repeat(start, size)
    act = np.flatnonzero(np.repeat(size > 1, size))
    while len(act) and h < depth:
        p, step = sa[act], min(h, depth - h)  # the last step looks no further than depth, as places beyond may be left out
        own, ahead = rank[p], np.where(p + step < n, rank[np.minimum(p + step, n - 1)] + 1, 0)
        if wide:
            key = np.sort((own.astype(_U) << _U(wide_bits + bits)) | (ahead.astype(_U) << _U(bits)) | np.arange(len(act), dtype=_U))
            p = p[(key & mask).astype(np.int64)]
            key = key >> _U(bits)
            differ = key[1:] != key[:-1]
        else:
            order = np.lexsort((p, ahead, own))
            p, own, ahead = p[order], own[order], ahead[order]
            differ = (own[1:] != own[:-1]) | (ahead[1:] != ahead[:-1])
        sa[act] = p
        new = np.concatenate([[True], differ])
        h += step
        first = bound[act]
        bound[act] = np.where(new & (first == 0), h, first)
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(act)))
        rank[p] = np.repeat(act[start], size)
        act = act[np.repeat(size > 1, size)]
    return sa, bound


def common_prefixes(data: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at p and q, p ascending."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(n + 1, "<u8", padded, 0, (1,))
    head = np.ones(len(p), bool)
    head[1:] = (p[1:] != p[:-1] + 1) | (q[1:] != q[:-1] + 1)
    at = np.flatnonzero(head)
    a, b = p[at], q[at]
    room = n - np.maximum(a, b)
    length = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    while len(live):
        x = np.minimum(a[live] + length[live], n)
        y = np.minimum(b[live] + length[live], n)
        diff = eight[x] ^ eight[y]
        low = np.frexp((diff & (~diff + _U(1))).astype(np.float64))[1]  # place of the lowest differing bit, 0: none
        step = np.where(diff == 0, 8, (low - 1) // 8)
        length[live] = np.minimum(length[live] + step, room[live])
        live = live[(diff == 0) & (length[live] < room[live])]
    run = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(p))))
    return length[run] - (np.arange(len(p)) - at[run])


def repeated(gram: np.ndarray) -> np.ndarray:
    """Positions (ascending) of the bytes of grams whose hash occurs again."""
    if len(gram) < 2:
        return np.zeros(0, np.int64)
    bits = _U(int(len(gram)).bit_length())
    key = np.sort(((gram >> bits) << bits) | np.arange(len(gram), dtype=_U))
    same = (key[1:] >> bits) == (key[:-1] >> bits)
    found = (key & ((_U(1) << bits) - _U(1))).astype(np.int64)[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
    depth = np.zeros(len(gram) + GRAM, np.int8)
    depth[found] += 1
    depth[found + GRAM] -= 1
    return np.flatnonzero(np.cumsum(depth[:-1], dtype=np.int32))


def covered_starts(data: np.ndarray, valid: np.ndarray, gram: np.ndarray | None = None, length: int = LENGTH) -> np.ndarray:
    """Which valid starts have a string of ``length`` bytes that also starts
    at an earlier valid place. All grams of such a string occur again, so the
    suffix array holds the suffixes that begin inside such a gram only."""
    out = np.zeros(len(data), bool)
    places = repeated(string_hashes(data)[0] if gram is None else gram)
    if not len(places) or not valid.any():
        return out
    sa, bound = suffix_array(data, length, places)
    near = np.flatnonzero((bound > length) | (bound == 0))
    near = near[near > 0]
    at = np.zeros(len(data), np.int64)  # by place, so that neighbouring places follow one another
    at[sa[near]] = near
    p = np.flatnonzero(at)
    near = at[p]
    long = near[common_prefixes(data, p, sa[near - 1]) >= length]
    if not len(long):
        return out
    joined = np.zeros(len(sa) + 1, bool)
    joined[long] = True
    member = np.flatnonzero(joined[:-1] | joined[1:])
    place = np.where(valid[sa[member]], sa[member], len(data))
    begin = np.flatnonzero(~joined[member])
    first = np.minimum.reduceat(place, begin)
    later = place > np.repeat(first, np.diff(np.append(begin, len(member))))
    later &= place < len(data)
    out[place[later]] = True
    return out


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


_BYTE = textnp.mix(np.arange(1, 257, dtype=_U))
_ODD = [int(x) | 1 for x in textnp.mix(np.arange(1001, 1009, dtype=_U))]


def string_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the ``GRAM`` bytes and of the ``LENGTH`` bytes at each
    position that has them, by doubling (multiply and add; mixed at the end)."""
    h, width, at = _BYTE[data], 1, {}
    while len(h):
        at[width] = h
        if 2 * width > LENGTH or len(h) <= width:
            break
        h = h[:-width] * _U(_ODD[width.bit_length()]) + h[width:]
        if width == 4:
            h ^= h >> _U(29)
        width *= 2
    gram = textnp.mix(at[GRAM]) if GRAM in at else np.zeros(0, _U)
    n = max(0, len(data) - LENGTH + 1)
    whole, done, left = np.zeros(n, _U), 0, LENGTH
    for width in sorted(at, reverse=True) if n else ():
        while left >= width:
            whole *= _U(_ODD[0])
            whole += at[width][done:done + n]
            done, left = done + width, left - width
    return gram, textnp.mix(whole)


def anchors(gram: np.ndarray, n: int) -> np.ndarray:
    """For each of the n string starts the position of its least gram (the
    leftmost of equals)."""
    key = ((gram >> _U(32)) << _U(32)) | np.arange(len(gram), dtype=_U)  # the same bits in every shard
    span, width = LENGTH - GRAM + 1, 1
    while 2 * width <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    key = np.minimum(key[:n], key[span - width:span - width + n])
    return (key & _U((1 << 32) - 1)).astype(np.int64)


def owned(gram: np.ndarray, whole: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the valid strings: gram hash, two hashes of all the strings
    that it owns, first start and number."""
    n = len(whole)
    if not n:
        z = np.zeros(0, np.int64)
        return z.astype(_U), z.astype(_U), z.astype(_U), z, z
    at = anchors(gram, n)
    good = valid[:n]
    cut = np.ones(n, bool)
    cut[1:] = (at[1:] != at[:-1]) | ~good[:-1]
    begin = np.flatnonzero(cut & good)
    end = np.minimum.reduceat(np.where(good, n, np.arange(n)), begin) if len(begin) else begin
    end = np.minimum(end, np.append(begin[1:], n))
    # strings less than LENGTH apart overlap, so the first and the last hold every byte
    first, last = whole[begin], whole[end - 1]
    place = (at[begin] - begin).astype(_U)
    c1 = textnp.mix(first + _U(3) * place) + textnp.mix(last ^ _U(0x2545F4914F6CDD1D)) * (end - begin).astype(_U)
    c2 = textnp.mix(first ^ (last << _U(1)) ^ _U(0x632BE59BD9B4E019)) + place
    return gram[at[begin]], c1, c2, begin, end - begin


# --- jobs ------------------------------------------------------------------------------------------------------------

_PARTS = "bucket int, row long, a binary, c binary, d binary, i binary, r binary, s binary, n binary"
_PART_NAMES = [x.split()[0] for x in _PARTS.split(", ")]
_PART_TYPES = [pa.int32(), pa.int64(), *[pa.binary()] * 7]
_RANGES = "row long, begin binary, end binary, key binary, many binary"
_RANGE_NAMES = [x.split()[0] for x in _RANGES.split(", ")]


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _by_row(rows: np.ndarray, begin: np.ndarray, end: np.ndarray, key: np.ndarray | None = None, many: np.ndarray | None = None) -> pa.RecordBatch:
    """Ranges (or, with keys, strings to compare) as one line per row."""
    order = np.lexsort((begin, rows))
    rows, begin, end = rows[order], begin[order].astype("<u4"), end[order].astype("<u4")
    new = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if len(rows) else np.zeros(0, np.int64)
    out = []
    for a, b in zip(new, np.append(new, len(rows))[1:], strict=True):
        extra = (None, None) if key is None else (common.blob(key[order[a:b]]), common.blob(many[order[a:b]]))
        out.append((int(rows[a]), common.blob(begin[a:b]), common.blob(end[a:b]), *extra))
    return _batch(out, _RANGE_NAMES, [pa.int64(), *[pa.binary()] * 4])


def _shards(rows: DataFrame, buckets: int) -> DataFrame:
    """Step 1: covered ranges per row (``s``, ``n``: begin and end), and runs
    of anchors per bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "text", SHARD):
            ids = np.array([_FIRST if x is None else x for x in piece.column("id").to_pylist()], np.int64)
            row = piece.column("row").to_numpy()
            order = np.lexsort((row, ids))
            ids, row = ids[order], row[order]
            data, offsets = textnp.flat(piece.column("text").take(pa.array(order)))
            valid = np.zeros(len(data), bool)
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                valid[a:max(a, b - LENGTH + 1)] = True
            hashes = string_hashes(data)
            covered = covered_starts(data, valid, hashes[0])
            out = []
            begin, end = _runs(covered)
            doc = np.searchsorted(offsets, begin, "right") - 1
            # a run of starts can't leave its document, as the last strings of one are no valid starts
            begin, end = begin - offsets[doc], end - 1 + LENGTH - offsets[doc]
            for d in np.unique(doc):
                own = doc == d
                out.append((int(textnp.mix(np.array([row[d]]).astype(_U))[0] % _U(buckets)), int(row[d]), *[None] * 5,
                            common.blob(begin[own].astype("<u4")), common.blob(end[own].astype("<u4"))))
            gram, c1, c2, first, number = owned(*hashes, valid)
            left = np.concatenate([[0], np.cumsum(~covered)])
            keep = left[first + number] > left[first] if len(first) else np.zeros(0, bool)
            gram, c1, c2, first, number = gram[keep], c1[keep], c2[keep], first[keep], number[keep]
            doc = np.searchsorted(offsets, first, "right") - 1
            bucket = (textnp.mix(gram) % _U(buckets)).astype(np.int64)  # anchors are least hashes, so not even themselves
            for b in np.unique(bucket):
                own = np.flatnonzero(bucket == b)
                own = own[np.argsort(gram[own], kind="stable")]  # a sorted run
                out.append((int(b), None, *map(common.blob, (gram[own], c1[own], c2[own], ids[doc[own]], row[doc[own]],
                                                             (first[own] - offsets[doc[own]]).astype("<u4"), number[own].astype(np.uint8)))))
            if out:
                yield _batch(out, _PART_NAMES, _PART_TYPES)

    return rows.mapInArrow(run, _PARTS)


def _merge_runs(parts: DataFrame, buckets: int) -> DataFrame:
    """Step 2: covered ranges per row, and with ``key`` the strings that have
    to be compared by their bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = []
        for batch in batches:
            rows = batch.to_pylist()
            done = [(r["row"], r["s"], r["n"], None, None) for r in rows if r["row"] is not None]
            if done:
                yield _batch(done, _RANGE_NAMES, [pa.int64(), *[pa.binary()] * 4])
            runs += [[np.frombuffer(r[c], kind) for c, kind in (("a", "<u8"), ("c", "<u8"), ("d", "<u8"), ("i", "<i8"), ("r", "<i8"), ("s", "<u4"), ("n", "u1"))]
                     for r in rows if r["row"] is None]
        if not runs:
            return
        merged = np.unique(np.concatenate([r[0] for r in runs]))
        seen = np.zeros(len(merged), np.int64)
        for r in runs:  # each sorted run finds its places in the merged list
            at = np.searchsorted(merged, r[0])
            seen += np.bincount(at, minlength=len(merged))
        again = [seen[np.searchsorted(merged, r[0])] > 1 for r in runs]
        a, c, d, i, r, s, n = (np.concatenate([x[k][m] for x, m in zip(runs, again, strict=True)]) for k in range(7))
        runs.clear()
        if not len(a):
            return
        order = np.lexsort((s, r, i, d, c, a))
        a, c, d, r, s, n = (x[order] for x in (a, c, d, r, s, n))
        other = np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1]) | (d[1:] != d[:-1])])
        later = ~other
        yield _by_row(r[later], s[later].astype(np.int64), s[later].astype(np.int64) + n[later] - 1 + LENGTH)
        a, r, s, n = a[other], r[other], s[other].astype(np.int64), n[other]
        group, size = np.unique(a, return_counts=True)
        size = size[np.searchsorted(group, a)]
        open_ = size > 1
        yield _by_row(r[open_], s[open_], s[open_] + n[open_], a[open_], (size[open_] > MANY).astype(np.uint8))

    return parts.repartitionById(buckets, F.col("bucket")).mapInArrow(run, _RANGES)


def _neighbourhoods(rows: DataFrame, opened: DataFrame, buckets: int) -> DataFrame:
    """Step 3, first half: the bytes of the strings to compare, per bucket.
    ``c`` holds the bytes one after the other, ``n`` the number of strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "text", SHARD * 4):
            got: list[tuple] = []
            for r in piece.to_pylist():
                data = np.frombuffer(r["text"] or b"", np.uint8)
                row, key_id = r["row"], _FIRST if r["id"] is None else r["id"]
                for begins, ends, keys, manys in zip(r["begin"], r["end"], r["key"], r["many"], strict=True):
                    begins, ends = np.frombuffer(begins, "<u4").astype(np.int64), np.frombuffer(ends, "<u4").astype(np.int64)
                    for a, b, key, many in zip(begins.tolist(), ends.tolist(), np.frombuffer(keys, "<u8").tolist(), manys, strict=True):
                        if many:
                            hashes = string_hashes(data[a:b - 1 + LENGTH])[1].tolist()
                            own = [(h, x, x + 1) for h, x in zip(hashes, range(a, b), strict=True)]
                        else:
                            own = [(key, a, b)]
                        for k, x, y in own:
                            got.append((k, key_id, row, x, y - x, data[x:y - 1 + LENGTH].tobytes()))
            parts: dict[int, list] = {}
            for b, item in zip((textnp.mix(np.array([x[0] for x in got], _U)) % _U(buckets)).tolist(), got, strict=True):
                parts.setdefault(b, []).append(item)
            out = []
            for b, items in parts.items():
                k, i, r, s, n, text = zip(*items, strict=True)
                out.append((b, None, common.blob(np.array(k, "<u8")), b"".join(text), None, common.blob(np.array(i, "<i8")), common.blob(np.array(r, "<i8")),
                            common.blob(np.array(s, "<u4")), common.blob(np.array(n, np.uint8))))
            if out:
                yield _batch(out, _PART_NAMES, _PART_TYPES)

    return rows.join(opened.withColumnRenamed("row", "of"), F.col("row") == F.col("of")).mapInArrow(run, _PARTS)


def _merge_bytes(parts: DataFrame, buckets: int) -> DataFrame:
    """Step 3, second half: suffix arrays over the neighbourhoods of anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [r for batch in batches for r in batch.to_pylist()]
        if not got:
            return
        a, i, r, s, n = (np.concatenate([np.frombuffer(x[c], kind) for x in got]) for c, kind in (("a", "<u8"), ("i", "<i8"), ("r", "<i8"), ("s", "<u4"), ("n", "u1")))
        data = np.frombuffer(b"".join(x["c"] for x in got), np.uint8)
        got.clear()
        s, n = s.astype(np.int64), n.astype(np.int64)
        size = n - 1 + LENGTH
        at = np.cumsum(size) - size
        order = np.lexsort((s, r, i, a))  # places ascend inside an anchor
        a, r, s, n, size, at = (x[order] for x in (a, r, s, n, size, at))
        group = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        end = np.append(group[1:], len(a))
        upto = np.concatenate([[0], np.cumsum(size)])
        first = 0
        while first < len(group):  # whole anchors, about a shard at a time
            last = first + 1
            while last < len(group) and upto[end[last]] - upto[group[first]] <= SHARD:
                last += 1
            own = slice(group[first], end[last - 1])
            total = int(size[own].sum())
            inside = np.repeat(at[own] - (np.cumsum(size[own]) - size[own]), size[own]) + np.arange(total)
            begin = np.cumsum(size[own]) - size[own]
            valid = np.zeros(total, bool)
            valid[np.repeat(begin - (np.cumsum(n[own]) - n[own]), n[own]) + np.arange(n[own].sum())] = True
            x, y = _runs(covered_starts(data[inside], valid))
            piece = np.searchsorted(begin, x, "right") - 1
            if len(x):
                yield _by_row(r[own][piece], x - begin[piece] + s[own][piece], y - 1 + LENGTH - begin[piece] + s[own][piece])
            first = last

    return parts.repartitionById(buckets, F.col("bucket")).mapInArrow(run, _RANGES)


def _merged(ranges: DataFrame) -> DataFrame:
    """Ranges of a row, joined where they touch: row, begin, end (binary)."""
    lists = ranges.groupBy("row").agg(F.collect_list("begin").alias("begin"), F.collect_list("end").alias("end"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                b, e = (np.concatenate([np.frombuffer(x, "<u4") for x in r[c]]) for c in ("begin", "end"))
                order = np.argsort(b, kind="stable")
                b, e = b[order], np.maximum.accumulate(e[order])
                new = np.flatnonzero(np.concatenate([[True], b[1:] > e[:-1]]))
                out.append((r["row"], common.blob(b[new]), common.blob(e[np.append(new[1:], len(b)) - 1])))
            yield _batch(out, ["row", "begin", "end"], [pa.int64(), pa.binary(), pa.binary()])

    return lists.mapInArrow(run, "row long, begin binary, end binary")


def removed_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, ranges): the documents with a row number, and the byte ranges
    to remove from each row that has any."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")) \
        .withColumn("row", F.monotonically_increasing_id())
    merged = common.store(_merge_runs(_shards(rows, buckets), buckets), "suffix-merged")
    # the lists of a row come from the same lines, in the same order
    opened = merged.where("key IS NOT NULL").groupBy("row").agg(F.collect_list(F.struct("begin", "end", "key", "many")).alias("all")) \
        .select("row", *[F.col(f"all.{c}").alias(c) for c in ("begin", "end", "key", "many")])
    opened = common.store(opened, "suffix-open")
    compared = common.store(_merge_bytes(_neighbourhoods(rows, opened, buckets), buckets), "suffix-compared")
    ranges = merged.where("key IS NULL").select("row", "begin", "end").unionByName(compared.select("row", "begin", "end"))
    return rows, common.store(_merged(ranges), "suffix-ranges")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256 and,
    if asked for, the bytes that are kept (they can cut a character)."""
    rows, ranges = removed_ranges(docs, id_col, text_col)
    ranges = common.hinted_bytes(ranges.withColumnRenamed("row", "of"), F.octet_length("begin") + F.octet_length("end") + 64, BROADCAST_BYTES)
    both = rows.join(ranges, F.col("row") == F.col("of"), "left").drop("of", "row")
    schema = f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "text", SHARD * 8):
            out = []
            for r in piece.to_pylist():
                data = r["text"] or b""
                b, e = (np.frombuffer(r[c] or b"", "<u4").tolist() for c in ("begin", "end"))
                kept = b"".join(data[x:y] for x, y in zip([0, *e], [*b, len(data)], strict=True))
                out.append((r["id"], len(data), len(data) - len(kept), len(b), hashlib.sha256(kept).hexdigest(), *([kept] * with_text)))
            yield _batch(out, [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:len(out[0])],
                         [*[pa.int64()] * 4, pa.string(), pa.binary()][:len(out[0])])

    return both.mapInArrow(run, schema)
