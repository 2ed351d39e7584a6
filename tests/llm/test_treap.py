"""Lexical search against exhaustive scoring."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tenderlake.llm import treap

DOC_SCHEMA = "doc_id long, text string, score long, rank string, item long"
ITEM_SCHEMA = "item_id string, text string, score long"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, k):
    tf = [Counter(terms(t)) for _, t in docs]
    n, size = sum(len(c) > 0 for c in tf), sum(sum(c.values()) for c in tf)
    df = Counter(t for c in tf for t in c)
    out = []
    for item, text in items:
        scored = []
        for (i, _), c in zip(docs, tf):
            if not c:
                continue
            m = 50 + 50 * sum(c.values()) * n // size
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    vocabulary = [f"word{i}" for i in range(150)] + ["Größe", "größe", "中文", "42"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i % 180, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 40)))) for i in range(400)]
    docs += [(None, docs[3][1]), (5, docs[5][1]), (900, None), (901, ""), (902, "?!"), (903, "word7 " * 20_000), (904, " ".join(vocabulary))]
    items = [(f"i{i}", " ".join(rng.choices(vocabulary, k=12)).upper() + " absent") for i in range(9)]
    items += [("same", docs[3][1]), ("none", "absent"), ("null", None), ("empty", ""), (None, "word1 word2")]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"block_impacts": 200}, {"chunk_bytes": 150}])
def test_search_against_brute_force(spark, rows, options):
    docs, items = rows
    found = treap.search(
        spark.createDataFrame([(*d, 1, "x", 2) for d in docs], DOC_SCHEMA), spark.createDataFrame([(*i, 3) for i in items], ITEM_SCHEMA), k=7, **options
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items, 7)


def test_repeated_items_ask_each(spark, rows):
    docs, items = rows[0][:50], [("a", "word1 word3"), ("a", "word1 word3")]
    found = treap.search(spark.createDataFrame([(*d, 1, "x", 2) for d in docs], DOC_SCHEMA), spark.createDataFrame([(*i, 3) for i in items], ITEM_SCHEMA), k=3)
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items, 3)


def test_empty_tables(spark, rows):
    docs, items = spark.createDataFrame([(1, "word1", 1, "x", 2)], DOC_SCHEMA), spark.createDataFrame([("a", "word1", 3)], ITEM_SCHEMA)
    assert treap.search(docs.limit(0), items).count() == 0 and treap.search(docs, items.limit(0)).count() == 0
    assert [tuple(r)[:3] for r in treap.search(docs, items).collect()] == [("a", 1, 1)]


def test_quarters_hold_the_maxima_of_what_is_below():
    rng = np.random.default_rng(2)
    cells = sorted({(int(r), int(c)) for r, c in zip(rng.integers(0, 50, 300), rng.integers(0, 20, 300))})
    rows, columns = (np.array(x) for x in zip(*cells))
    impacts = rng.integers(1, 1000, len(cells))
    masks, lacks, sizes = treap.built(rows, columns, impacts, 6)
    grid = treap.Grid.read(masks.tobytes(), lacks.tobytes(), sizes.tolist())
    assert sizes[0] == 1 and sizes[-1] == len(cells) and grid.most[0] == impacts.max()
    ids, every = np.arange(20), np.arange(50)
    weights = rng.integers(1, 9, 50)
    want = [sum(int(w) * int(v) for w, (r, c), v in zip(weights[rows], cells, impacts) if c == d) for d in range(20)]
    scores, found = grid.best(every, weights, ids, 20, 0)
    assert {int(c): int(s) for c, s in zip(found, scores)} == {d: s for d, s in enumerate(want) if s}
