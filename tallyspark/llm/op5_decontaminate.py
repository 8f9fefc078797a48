"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

Test items are read in blocks of bounded size. For each block two passes over
the documents are made, and no text is shuffled:

1. the number of documents with each n-gram of the items is counted over the
   whole corpus; an item's seeds are those of its n-grams that occur, up to
   ``RARE_DOCUMENTS`` documents or the third quartile of their frequencies,
   whichever is more (so an item that leaked everywhere has seeds as well);
2. a seed in a document places the item on it; the words around are aligned
   with the whole item by Smith-Waterman, many pairs at once. Placements of an
   item that overlap are aligned as one.

A pair is reported if its best score reaches ``threshold`` of a full match, so
edited and partly paraphrased copies are found as long as one seed survives.

Words are runs of letters and digits, A-Z lower-cased. Defined cases: null and
empty texts or items match nothing; an item with fewer words than a seed is
one seed; items with equal texts are reported each; rows that repeat a
document are reported each; null ids are carried; no items or no documents
give no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, textnp

SEED_WORDS = 3
RARE = 0.75
#: Documents up to which an n-gram is a seed whatever the item's others are.
RARE_DOCUMENTS = 1000
THRESHOLD = 0.4
MATCH, MISMATCH, GAP = 2, -1, -1
#: Items whose words are sent to all tasks at once.
ITEM_BLOCK = 20_000
SLICE = 4 << 20
CELLS = 1 << 21
_SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def smith_waterman(items: list[np.ndarray], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment scores of pairs of word sequences and the end of
    the alignment in the text. Rows of all pairs advance together; a gap along
    the text is a running maximum."""
    rows, width = max(map(len, items)), max(map(len, texts))
    a = np.zeros((len(items), rows), np.uint64)
    b = np.ones((len(items), width), np.uint64)
    for i, (x, y) in enumerate(zip(items, texts, strict=True)):
        a[i, :len(x)], b[i, :len(y)] = x, y
    slope = -GAP * np.arange(width, dtype=np.int32)
    h = np.zeros((len(items), width + 1), np.int32)
    best, end = np.zeros(len(items), np.int32), np.zeros(len(items), np.int64)
    for i in range(rows):
        step = h[:, :-1] + np.where(a[:, i:i + 1] == b, np.int32(MATCH), np.int32(MISMATCH))
        np.maximum(step, h[:, 1:] + np.int32(GAP), out=step)
        np.maximum(step, 0, out=step)
        h[:, 1:] = np.maximum.accumulate(step + slope, axis=1) - slope
        at = h.argmax(1)
        top = h[np.arange(len(items)), at]
        better = top > best
        best[better], end[better] = top[better], at[better]
    return best, end


class Items:
    """Words and n-grams of a block of items."""

    def __init__(self, ids: list, texts: list[str | None], seed_words: int):
        w = textnp.words(pa.array(texts, pa.large_string()), _SEPARATORS)
        self.ids = ids
        self.words = [w.hash[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        gram, item, place, size = [], [], [], []
        for i, x in enumerate(self.words):
            n = min(seed_words, len(x))
            g = textnp.ngrams(x, n) if n else x
            gram.append(g)
            item.append(np.full(len(g), i))
            place.append(np.arange(len(g)))
            size.append(np.full(len(g), n))
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        gram, self.item, self.place = join(gram, np.uint64), join(item, np.int64), join(place, np.int64)
        self.sizes = np.unique(join(size, np.int64)).tolist()
        self.grams, self.number = np.unique(gram, return_inverse=True)
        self.use(np.ones(len(self.number), bool))

    def use(self, chosen: np.ndarray) -> None:
        """Look for the chosen n-grams only."""
        self.entries = np.flatnonzero(chosen)
        self.entries = self.entries[np.argsort(self.number[self.entries], kind="stable")]
        self.from_gram = np.searchsorted(self.number[self.entries], np.arange(len(self.grams) + 1))
        used = np.unique(self.number[self.entries])
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.grams[used] & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def found(self, w: textnp.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, word position and gram number of every gram in use."""
        text, at, number = [], [], []
        for n in self.sizes:
            g = textnp.ngrams(w.hash, n)
            maybe = np.flatnonzero(self.filter[(g & np.uint64((1 << 20) - 1)).astype(np.int64)])
            k = np.minimum(np.searchsorted(self.grams, g[maybe]), len(self.grams) - 1)
            t = np.searchsorted(w.first, maybe, "right") - 1
            good = (self.grams[k] == g[maybe]) & (self.from_gram[k + 1] > self.from_gram[k]) & (maybe + n <= w.first[t + 1])
            text.append(t[good])
            at.append(maybe[good])
            number.append(k[good])
        return np.concatenate(text), np.concatenate(at), np.concatenate(number)

    def rarest(self, documents: np.ndarray) -> np.ndarray:
        """Entries that occur, up to ``RARE_DOCUMENTS`` documents or the ``RARE``
        quantile of the document frequencies of those in their item."""
        seen = documents[self.number]
        out = np.zeros(len(seen), bool)
        edge = np.searchsorted(self.item, np.arange(len(self.ids) + 1))
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            found = np.sort(seen[a:b][seen[a:b] > 0])
            if len(found):
                out[a:b] = (seen[a:b] > 0) & (seen[a:b] <= max(found[int((len(found) - 1) * RARE)], RARE_DOCUMENTS))
        return out

    def matches(self, w: textnp.Words, threshold: float) -> Iterator[tuple[int, int, float, int]]:
        """text, item, score and last word of each pair over the threshold."""
        text, at, number = self.found(w)
        if not len(text):
            return
        fan = self.from_gram[number + 1] - self.from_gram[number]
        hit = np.repeat(np.arange(len(text)), fan)
        entry = self.entries[np.repeat(self.from_gram[number] - np.cumsum(fan) + fan, fan) + np.arange(fan.sum())]
        text, item = text[hit], self.item[entry]
        length = np.array([len(x) for x in self.words], np.int64)[item]
        slack = length // 4 + 2
        begin = np.maximum(at[hit] - self.place[entry] - slack, w.first[text])
        end = np.minimum(at[hit] - self.place[entry] + length + slack, w.first[text + 1])
        order = np.lexsort((begin, item, text))
        text, item, begin, end = text[order], item[order], begin[order], end[order]
        pair = np.concatenate([[True], (text[1:] != text[:-1]) | (item[1:] != item[:-1])])
        # windows of a pair that overlap are one: a window opens one when it begins after all ends before it
        base = np.cumsum(pair) * (len(w.hash) + 1)
        far = np.maximum.accumulate(end + base)
        opens = pair.copy()
        opens[1:] |= (begin + base)[1:] > far[:-1]
        first = np.flatnonzero(opens)
        text, item, begin, end = text[first], item[first], begin[first], (np.maximum.reduceat(end, first))
        best: dict[tuple[int, int], tuple[float, int]] = {}
        order = np.argsort(end - begin, kind="stable")
        start = 0
        while start < len(order):
            stop = start + 1
            while stop < len(order) and (stop + 1 - start) * (end - begin)[order[stop]] <= CELLS:
                stop += 1
            part = order[start:stop]
            score, last = smith_waterman([self.words[i] for i in item[part]], [w.hash[x:y] for x, y in zip(begin[part], end[part], strict=True)])
            for p, s, e in zip(part.tolist(), score.tolist(), last.tolist(), strict=True):
                share = s / (MATCH * len(self.words[item[p]]))
                key = int(text[p]), int(item[p])
                if share >= threshold and (key not in best or best[key][0] < share):
                    best[key] = share, int(begin[p] + e - w.first[text[p]])
            start = stop
        for (t, i), (share, last) in sorted(best.items()):
            yield t, i, share, last


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", seed_words: int = SEED_WORDS, threshold: float = THRESHOLD,
                 item_block: int = ITEM_BLOCK) -> DataFrame:
    """One row per document and item: id, item_id, score (share of a full
    match), last_word (where the alignment ends)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    blocks = max(1, -(-items.count() // item_block))
    schema = f"`{id_col}` long, item_id long, score double, last_word long"
    out = None
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        block = Items([r.item_id for r in own], [r.text for r in own], seed_words)
        if not len(block.grams):
            continue
        everywhere = spark.sparkContext.broadcast(block)

        def count(batches: Iterator[pa.RecordBatch], sent=everywhere) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(sent.value.grams), np.int64)
            for piece in common.slices(batches, "text", SLICE):
                text, _, number = sent.value.found(textnp.words(piece.column("text"), _SEPARATORS))
                pair = np.unique(text * len(total) + number)
                total += np.bincount(pair % len(total), minlength=len(total))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["gram", "n"])

        summed = rows.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        documents = np.zeros(len(block.grams), np.int64)
        for r in summed.collect():  # one row per n-gram of the block at most
            documents[r.gram] = r.n
        block.use(block.rarest(documents))
        seeds = spark.sparkContext.broadcast(block)

        def align(batches: Iterator[pa.RecordBatch], sent=seeds) -> Iterator[pa.RecordBatch]:
            for piece in common.slices(batches, "text", SLICE):
                ids, block = piece.column("id").to_pylist(), sent.value
                got = [(ids[t], block.ids[i], s, last) for t, i, s, last in block.matches(textnp.words(piece.column("text"), _SEPARATORS), threshold)]
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*got, strict=True), (pa.int64(), pa.int64(), pa.float64(), pa.int64()), strict=True)],
                                                     [id_col, "item_id", "score", "last_word"])

        part = rows.mapInArrow(align, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, hits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents without a hit."""
    gone = common.store(hits.select(F.col(id_col).alias("gone_id")).distinct(), "contaminated")
    gone = common.hinted(gone)
    return docs.join(gone, F.col(id_col).eqNullSafe(gone.gone_id), "left_anti")
