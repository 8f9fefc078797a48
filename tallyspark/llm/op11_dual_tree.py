"""Ranked lexical search by dual trees.

A document's impact for a term depends on the document alone, and an item (the
query) weighs terms by their rarity, so a score is an inner product of two
sparse rows of integers. Items and documents each get a hierarchy: rows next to
each other share their strongest terms, a leaf holds a few rows, and a node
holds for each term the largest value below it. The product of two nodes' rows
is an upper bound for every pair below them. A search descends both hierarchies
together, best bounds first, and drops a pair of nodes once its bound is below
the weakest k-th score among the node's items: the whole batch of items and the
whole batch of documents then go at once, and nothing that could enter a list
does. Leaves are scored exactly.

Documents are tokenised once into an index of the items' terms (a table),
whose partitions are searched side by side, each over its own hierarchies of
bounded size. A first search over a 64th of the index gives every item a k-th
score that the final one can't be below; the search of all of it starts from
there, so that few rows reach the merge. Items are sent to the tasks in
blocks of at most ``BLOCK_TERMS`` entries and ``BLOCK_ITEMS`` items, or one
larger item; each block passes over the documents.

Defined cases: null and empty texts have no terms; items without terms, and
items none of whose terms has a weight, have no rows; repeated items are
searched each; repeated documents are listed each; null document ids come last
among equal scores; extra columns are not read; without documents or without
items the result is empty. Scores are exact up to 2 ** 62, beyond which an item
raises an error.
"""
from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, textnp

K = 20
BLOCK_TERMS, BLOCK_ITEMS = 500_000, 20_000
SLICE_BYTES = 16 << 20
IMPACT = 10 ** 9


@dataclass(frozen=True)
class Sizes:
    """Documents of one hierarchy, rows of a leaf, children of a node; the
    part (one in so many) of the index that gives the first bounds; entries of
    items that are multiplied with a node's rows at a time."""
    tree_docs: int = 4096
    doc_leaf: int = 32
    item_leaf: int = 8
    fan: int = 8
    first: int = 64
    entries: int = 1 << 16


#: What stands between terms: 0 to 2F, 3A to 40, 5B to 60, 7B to 7F.
SEPARATORS = np.zeros(256, bool)
for _a, _b in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    SEPARATORS[_a:_b + 1] = True

INDEX = "doc_id long, n long, terms array<int>, counts array<long>"
FOUND = "item int, item_id long, doc_id long, score long"


# ---------------------------------------------------------------- sparse rows
@dataclass
class Rows:
    """Sparse rows of integers: row r holds ``term[at[r]:at[r + 1]]``, ascending, and their values."""
    at: np.ndarray
    term: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.at) - 1

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.at))

    def take(self, rows: np.ndarray) -> Rows:
        size = np.diff(self.at)[rows]
        at = np.concatenate([[0], np.cumsum(size)])
        where = np.repeat(self.at[rows] - at[:-1], size) + np.arange(at[-1])
        return Rows(at, self.term[where], self.value[where])

    def maxima(self, group: int) -> Rows:
        """A row for every ``group`` rows, with each term's largest value."""
        node = self.owner() // group
        order = np.lexsort((self.term, node))
        node, term, value = node[order], self.term[order], self.value[order]
        first = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (term[1:] != term[:-1])])) if len(node) else np.zeros(0, np.int64)
        best = np.maximum.reduceat(value, first) if len(first) else value
        return Rows(np.searchsorted(node[first], np.arange(-(-len(self) // group) + 1)), term[first], best)

    def likeness(self, weight: np.ndarray) -> np.ndarray:
        """An order in which rows with the same two strongest terms are next to each other."""
        owner = self.owner()
        order = np.lexsort((-self.value * weight[self.term], owner))
        strongest = self.term[order]
        top = [np.where(np.diff(self.at) > j, strongest[np.minimum(self.at[:-1] + j, max(len(strongest) - 1, 0))], -1) if len(strongest)
               else np.full(len(self), -1) for j in (0, 1)]
        return np.lexsort((top[1], top[0]))


@dataclass
class Tree:
    """``order`` places the rows, ``rows`` are in that order, ``levels[0]`` are
    the leaves' maxima and the last level has at most ``fan`` nodes."""
    order: np.ndarray
    rows: Rows
    leaf: int
    fan: int
    levels: list[Rows] = field(default_factory=list)

    @classmethod
    def of(cls, rows: Rows, leaf: int, fan: int, weight: np.ndarray) -> Tree:
        order = rows.likeness(weight)
        tree = cls(order, rows.take(order), leaf, fan)
        tree.levels.append(tree.rows.maxima(leaf))
        while len(tree.levels[-1]) > fan:
            tree.levels.append(tree.levels[-1].maxima(fan))
        return tree

    def width(self, level: int) -> int:
        return self.fan if level else self.leaf

    def below(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Children of nodes of a level; those of leaves are rows."""
        width = self.width(level)
        inside = (nodes[:, None] * width + np.arange(width)).ravel()
        return inside[inside < (len(self.levels[level - 1]) if level else len(self.rows))]


class Search:
    """The k best documents for each item, over one hierarchy of documents
    after the other. ``need`` is the least score that can still enter a list."""

    def __init__(self, items: Tree, n_terms: int, least: np.ndarray, k: int, entries: int = Sizes.entries):
        self.items, self.k, self.entries, self.local = items, k, entries, np.zeros(n_terms, np.int32)
        n = len(items.rows)
        self.best = [np.zeros((0, 3), np.int64)] * n  # score, id is null, id
        self.need = [np.maximum(least, 1)]
        for level in range(len(items.levels)):
            self.need.append(np.minimum.reduceat(self.need[-1], np.arange(0, len(self.need[-1]), items.width(level))))
        self.scored = 0

    def products(self, rows: Rows, left: Rows) -> np.ndarray:
        """Inner products of all ``left`` rows with all ``rows``."""
        terms = np.unique(rows.term)
        self.local[terms] = np.arange(1, len(terms) + 1)
        dense = np.zeros((len(terms) + 1, len(rows)), np.int64)
        dense[self.local[rows.term], rows.owner()] = rows.value
        out = np.zeros((len(left), len(rows)), np.int64)
        shared = self.local[left.term]
        hit = np.flatnonzero(shared)
        owner = left.owner()[hit]
        for at in range(0, len(hit), self.entries):
            part = slice(at, at + self.entries)
            who = owner[part]
            first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
            out[who[first]] += np.add.reduceat(dense[shared[hit[part]]] * left.value[hit[part], None], first)
        self.local[terms] = 0
        return out

    def run(self, docs: Tree, null: np.ndarray, ids: np.ndarray) -> None:
        self.docs, self.null, self.ids = docs, null[docs.order], ids[docs.order]
        top_d, top_i = len(docs.levels) - 1, len(self.items.levels) - 1
        self.descend(top_d, np.arange(len(docs.levels[top_d])), top_i, np.arange(len(self.items.levels[top_i])))

    def descend(self, dl: int, nodes: np.ndarray, il: int, open_items: np.ndarray) -> None:
        """Compare document nodes of level ``dl`` with item nodes of level ``il``."""
        bound = self.products(self.docs.levels[dl].take(nodes), self.items.levels[il].take(open_items))
        excess = (bound - self.need[il + 1][open_items][:, None]).max(0)
        for j in np.argsort(-excess, kind="stable"):
            left = open_items[bound[:, j] >= self.need[il + 1][open_items]]  # what earlier nodes found counts
            if not len(left):
                continue
            node = nodes[j:j + 1]
            if dl or il:
                self.descend(max(dl - 1, 0), self.docs.below(dl, node) if dl else node, max(il - 1, 0), self.items.below(il, left) if il else left)
            else:
                self.score(self.docs.below(0, node), self.items.below(0, left))

    def score(self, rows: np.ndarray, items: np.ndarray) -> None:
        found = self.products(self.docs.rows.take(rows), self.items.rows.take(items))
        self.scored += found.size
        enters = found >= self.need[0][items][:, None]
        changed = np.flatnonzero(enters.any(1))
        for i in changed:
            at = np.flatnonzero(enters[i])
            r = rows[at]
            both = np.concatenate([self.best[items[i]], np.stack([found[i, at], self.null[r], self.ids[r]], 1)])
            both = both[np.lexsort((both[:, 2], both[:, 1], -both[:, 0]))[:self.k]]
            self.best[items[i]] = both
            if len(both) == self.k:
                self.need[0][items[i]] = max(self.need[0][items[i]], both[-1, 0])
        nodes = items[changed]
        for level in range(len(self.items.levels)):
            width = self.items.width(level)
            nodes = np.unique(nodes // width)
            for x in nodes:
                self.need[level + 1][x] = self.need[level][x * width:(x + 1) * width].min()


# ------------------------------------------------------------------- indexing
def term_counts(column: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, Rows]:
    """Terms of each text (with repeats), and counts of those in the vocabulary."""
    words, first = textnp.split(column, True, SEPARATORS)
    place = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    n = np.diff(first)
    text = np.repeat(np.arange(len(n)), n)
    key, counts = np.unique((text * len(vocabulary) + place)[place >= 0], return_counts=True)
    owner = key // max(len(vocabulary), 1)
    return n, Rows(np.searchsorted(owner, np.arange(len(n) + 1)), (key - owner * len(vocabulary)).astype(np.int32), counts.astype(np.int64))


def index(docs: DataFrame, vocabulary: pa.Array, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``INDEX``: every document, its number of terms and the counts of those of the vocabulary."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "text", SLICE_BYTES):
            n, rows = term_counts(piece.column("text"), sent.value)
            at = pa.array(rows.at, pa.int32())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(rows.term, pa.int32())),
                                              pa.ListArray.from_arrays(at, pa.array(rows.value, pa.int64()))], ["doc_id", "n", "terms", "counts"])

    chosen = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return chosen.mapInArrow(read, INDEX)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, terms and counts of each item with terms."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "text", SLICE_BYTES):
            words, first = textnp.split(piece.column("text"), True, SEPARATORS)
            coded = words.dictionary_encode()
            vocabulary, place = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
            key, counts = np.unique(owner * max(len(vocabulary), 1) + place, return_counts=True)
            owner = key // max(len(vocabulary), 1)
            at = pa.array(np.searchsorted(owner, np.arange(len(first))), pa.int32())
            terms = vocabulary.take(pa.array(key - owner * max(len(vocabulary), 1))).cast(pa.string())
            yield pa.RecordBatch.from_arrays([piece.column("item_id"), pa.ListArray.from_arrays(at, terms), pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))],
                                             ["item_id", "terms", "counts"])

    chosen = items.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return chosen.mapInArrow(read, "item_id long, terms array<string>, counts array<long>").where(F.size("terms") > 0)


def blocks(rows: Iterator, terms: int = BLOCK_TERMS, most: int = BLOCK_ITEMS) -> Iterator[list]:
    """Rows in lists of bounded size; a row that is larger alone is one by itself."""
    held, size = [], 0
    for r in rows:
        if held and (size + len(r.terms) > terms or len(held) >= most):
            yield held
            held, size = [], 0
        held.append(r)
        size += len(r.terms)
    if held:
        yield held


# --------------------------------------------------------------------- search
def weights(n: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2 n + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def impacts(n: np.ndarray, rows: Rows, docs: int, terms: int) -> np.ndarray:
    """Each entry's part of a score, without the term's weight."""
    wide = 25 * docs * int(n.max(initial=0)) >= 1 << 62
    part = 25 * n.astype(object) * docs // terms if wide else 25 * n * docs // terms
    m = np.repeat(75 + part.astype(np.int64), np.diff(rows.at))
    return IMPACT * rows.value // (1000 * rows.value + 12 * m)


def _search_block(table: DataFrame, block: Sequence, ids: list, item_rows: Rows, weight: np.ndarray, n_docs: int, n_terms: int, k: int,
                  sizes: Sizes) -> DataFrame:
    items = Tree.of(item_rows, sizes.item_leaf, sizes.fan, np.ones(len(weight), np.int64))
    context = table.sparkSession.sparkContext
    shared = context.broadcast((items, weight, ids))

    def best(part: DataFrame, least: np.ndarray) -> DataFrame:
        start = context.broadcast(least[items.order])

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree, w, names = shared.value
            state, held, size = Search(tree, len(w), start.value.copy(), k, sizes.entries), [], 0

            def flush() -> None:
                b = pa.Table.from_batches(held).combine_chunks()
                terms, counts, doc = (b.column(c).combine_chunks() for c in ("terms", "counts", "doc_id"))
                at = terms.offsets.to_numpy().astype(np.int64)
                rows = Rows(at - at[0], terms.flatten().to_numpy(), counts.flatten().to_numpy())
                rows = Rows(rows.at, rows.term, impacts(b.column("n").to_numpy(), rows, n_docs, n_terms))
                null = doc.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                state.run(Tree.of(rows, sizes.doc_leaf, sizes.fan, w), null, doc.fill_null(0).to_numpy())

            for batch in batches:
                for at in range(0, batch.num_rows, sizes.tree_docs):
                    piece = batch.slice(at, sizes.tree_docs)
                    if size and size + piece.num_rows > sizes.tree_docs:
                        flush()
                        held, size = [], 0
                    held.append(piece)
                    size += piece.num_rows
            if size:
                flush()
            out = [(i, row) for i, rows in zip(tree.order.tolist(), state.best, strict=True) for row in rows.tolist()]
            if out:
                yield pa.RecordBatch.from_arrays([
                    pa.array([i for i, _ in out], pa.int32()), pa.array([names[i] for i, _ in out], pa.int64()),
                    pa.array([None if row[1] else row[2] for _, row in out], pa.int64()), pa.array([row[0] for _, row in out], pa.int64())],
                    ["item", "item_id", "doc_id", "score"])

        found = common.store(part.mapInArrow(search, FOUND), "lexical-found")
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        # within (item, salt) first: no task holds one item's lists of all parts
        salted = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(16))).orderBy(*order)
        first = found.withColumn("r", F.row_number().over(salted)).where(F.col("r") <= k)
        return first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)

    rows = table.where(F.size("terms") > 0)
    least = np.zeros(len(block), np.int64)
    some = rows.where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(sizes.first)) == 0)
    for r in best(some, least).where(F.col("rank") == k).select("item", "score").collect():
        least[r.item] = r.score
    return best(rows, least).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
           item_text: str = "text", sizes: Sizes = Sizes()) -> DataFrame:
    """The k documents with the highest scores above 0 for each item:
    item_id, rank, doc_id, score."""
    spark, out = docs.sparkSession, None
    for block in blocks(common.store(item_terms(items, item_id, item_text), "lexical-items").toLocalIterator()):
        vocabulary = pc.unique(pa.concat_arrays([pa.array(r.terms, pa.large_string()) for r in block]))
        table = common.store(index(docs, vocabulary, doc_id, doc_text), "lexical-index")
        total = table.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        if not total.docs:
            break
        df = np.zeros(len(vocabulary), np.int64)
        for r in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row for each term of the block
            df[r.t] = r["count"]
        weight = weights(total.docs, df)
        place = pc.index_in(pa.concat_arrays([pa.array(r.terms, pa.large_string()) for r in block]), value_set=vocabulary).to_numpy()
        counts = np.concatenate([np.array(r.counts, np.int64) for r in block])
        at = np.concatenate([[0], np.cumsum([len(r.terms) for r in block])])
        value = weight[place] * counts
        for r, a, b in zip(block, at[:-1], at[1:], strict=True):
            if sum(map(int, value[a:b])) * (IMPACT // 1000) >= 1 << 62:
                raise OverflowError(f"scores of item {r.item_id} leave the range of a long")
        owner = np.repeat(np.arange(len(block)), np.diff(at))
        order = np.lexsort((place, owner))
        order = order[value[order] > 0]
        rows = Rows(np.searchsorted(owner[order], np.arange(len(block) + 1)), place[order].astype(np.int32), value[order])
        found = _search_block(table, block, [r.item_id for r in block], rows, weight, total.docs, total.terms, k, sizes)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
