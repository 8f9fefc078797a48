"""Dual-tree ranked search against scoring every document."""
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyspark.llm import op11_dual_tree as op11

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOC, ITEM = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k):
    """Sorted (item id, rank, doc id, score)."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10 ** 9 * c[w] // (1000 * c[w] + 12 * m)) for w in terms(text) if w in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, k=20, parts=3, **more):
    got = op11.search(spark.createDataFrame(docs, DOC).repartition(parts), spark.createDataFrame(items, ITEM), k, **more)
    assert [f"{a} {b}" for a, b in got.dtypes] == ["item_id bigint", "rank int", "doc_id bigint", "score bigint"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def texts(n, seed, least=0, most=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(80)] + ["Été", "été", "ÉTÉ", "naïve-ish", "a_b", "x9", "漢字", "k k", "q\x00r", "o'c", "\x7f"]
    odds = [1 / (i + 1) for i in range(len(vocabulary))]
    return ["".join(x + rng.choice([" ", "\n", ". ", ", "]) for x in rng.choices(vocabulary, odds, k=rng.randint(least, most))) for _ in range(n)]


@pytest.mark.parametrize("n, k", [(5, 20), (60, 3), (700, 20)])
def test_equals_scoring_all_documents(spark, n, k):
    docs = list(enumerate(texts(n, n)))
    items = list(enumerate(texts(25, n + 1)))
    assert run(spark, docs, items, k) == plain(docs, items, k)


def test_small_trees_and_many_levels(spark):
    docs, items = list(enumerate(texts(400, 1))), list(enumerate(texts(30, 2)))
    assert run(spark, docs, items, 4, sizes=op11.Sizes(120, 2, 1, 2, 4, 7)) == plain(docs, items, 4)


def test_blocks_of_items(spark, monkeypatch):
    real = op11.blocks
    monkeypatch.setattr(op11, "blocks", lambda rows: real(rows, 40, 3))
    docs, items = list(enumerate(texts(90, 3))), list(enumerate(texts(8, 4)))
    assert run(spark, docs, items, 5) == plain(docs, items, 5)


def test_blocks_are_bounded():
    class Row:
        def __init__(self, n):
            self.terms = ["x"] * n
    sizes = [[len(r.terms) for r in b] for b in op11.blocks(iter([Row(n) for n in (3, 9, 50, 1, 1, 1, 1, 4)]), 10, 3)]
    assert sizes == [[3], [9], [50], [1, 1, 1], [1, 4]]


def test_odd_rows(spark):
    same = "tie breaks by id"
    docs = [(i, same) for i in range(50, 0, -1)] + [(None, same), (None, None), (7, ""), (8, " .,;"), (3, same), (3, "ALSO Tie"), (60, "long " * 50000 + "tie"), (61, "ünï tie")]
    items = [(1, "TIE by"), (1, "tie by"), (None, "also"), (2, None), (3, ""), (4, "nowhere"), (5, "tie tie tie ünï"), (6, "long"), (7, "tie breaks by id also long ünï ünï")]
    assert run(spark, docs, items, 20) == plain(docs, items, 20)
    assert run(spark, docs, items, 3, parts=9) == plain(docs, items, 3)


@pytest.mark.parametrize("docs, items", [([], []), ([(1, "a")], []), ([], [(1, "a")]), ([(1, None), (2, "!")], [(1, "a")]), ([(1, "a")], [(1, "a")]), ([(1, "a"), (2, "b")], [(1, None)])])
def test_empty_tables(spark, docs, items):
    assert run(spark, docs, items) == plain(docs, items, 20)


def test_extra_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "x"), (2, "b c", 6, "y")], DOC + ", score int, terms string")
    items = spark.createDataFrame([(9, "a", 1, "z")], ITEM + ", doc_id int, counts string")
    assert [tuple(r) for r in op11.search(docs, items).select("item_id", "rank", "doc_id").collect()] == [(9, 1, 1)]


def test_bounds_hold_and_batches_are_pruned():
    """Every node's row is at least the rows below it, and most pairs are never scored."""
    rng = np.random.default_rng(0)
    vocabulary = 300

    def rows(n, size):  # a topic has 10 strong terms, the rest are weak
        out, value = [], []
        for _ in range(n):
            strong = rng.choice(10, size, replace=False) + 10 * rng.integers(0, 25)
            out.append(np.sort(np.concatenate([strong, rng.choice(np.arange(250, 300), 3, replace=False)])))
            value.append(np.where(out[-1] < 250, rng.integers(500, 1000, size + 3), rng.integers(1, 50, size + 3)))
        at = np.concatenate([[0], np.cumsum([len(x) for x in out])])
        return op11.Rows(at, np.concatenate(out).astype(np.int32), np.concatenate(value).astype(np.int64))
    docs, items = rows(3000, 6), rows(64, 4)
    ones = np.ones(vocabulary, np.int64)
    dt, it = op11.Tree.of(docs, 32, 8, ones), op11.Tree.of(items, 8, 8, ones)

    def dense(r):
        out = np.zeros((len(r), vocabulary), np.int64)
        out[r.owner(), r.term] = r.value
        return out
    for tree in (dt, it):
        under = dense(tree.rows)
        for level, r in enumerate(tree.levels):
            width = tree.width(level)
            node = dense(r)
            assert (np.repeat(node, width, 0)[:len(under)] >= under).all()
            under = node
        assert len(tree.levels[-1]) <= tree.fan
    # as the operator does: a part of the documents gives the first bounds
    some = np.arange(0, 3000, 10)
    first = op11.Search(it, vocabulary, np.zeros(64, np.int64), 5)
    first.run(op11.Tree.of(docs.take(some), 32, 8, ones), np.zeros(300, np.int64), some)
    s = op11.Search(it, vocabulary, first.need[0], 5)
    s.run(dt, np.zeros(3000, np.int64), np.arange(3000))
    full = dense(items) @ dense(docs).T
    for i, item in enumerate(it.order):
        want = sorted((-x, d) for d, x in enumerate(full[item].tolist()) if x > 0)[:5]
        assert [(-a, c) for a, _, c in s.best[i].tolist()] == want
    assert s.scored < 0.3 * full.size


def test_products_beyond_small_integers():
    n = np.array([5, 10 ** 9])
    rows = op11.Rows(np.array([0, 1, 2]), np.array([0, 0], np.int32), np.array([2, 10 ** 8]))
    docs, total = 10 ** 10, 10 ** 13
    want = [10 ** 9 * c // (1000 * c + 12 * (75 + 25 * x * docs // total)) for x, c in ((5, 2), (10 ** 9, 10 ** 8))]
    assert op11.impacts(n, rows, docs, total).tolist() == want


def test_terms_are_the_maximal_matches():
    for text in texts(50, 9) + ["", None, "\x00\x2f0\x39\x3a\x40A\x5a\x5b`a\x7az{\x7f\x80é"]:
        n, rows = op11.term_counts(pa.array([text], pa.string()), pa.array(sorted(set(terms(text))), pa.large_string()))
        assert n[0] == len(terms(text))
        assert rows.value.tolist() == [v for _, v in sorted(Counter(terms(text)).items())]
