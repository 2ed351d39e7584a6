"""The divergence audit against brute force in Python integers."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tenderlake.llm import divergence

SCHEMA = "doc_id long, lang string, source string, text string, item string, value long, bucket string"


def brute(rows, least=10, first=10):
    word = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    counts, held, out = {}, {}, []
    for _, lang, source, text in rows:
        group = counts.setdefault(lang or "", {}).setdefault(source or "", Counter())
        group.update(word(text))
        held.setdefault(lang or "", Counter()).update(set(word(text)))
    for lang, groups in counts.items():
        kept = [t for t, n in held[lang].items() if n >= least]
        total = sum((c for c in groups.values()), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * len(kept)) for t in kept}  # noqa: B023, E731
        p, q = {s: share(c) for s, c in groups.items()}, share(total)
        far = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = [(-sum(far(p[s][t], p[o][t]) for t in kept), o.encode(), "pair") for o in groups if o != s]
            terms = [(-far(p[s][t], q[t]), t.encode(), "term") for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for found in (sorted(pairs), sorted(terms)[:first]):
                out.extend((lang, s, part, item.decode(), -v, r) for r, (v, item, part) in enumerate(found, 1))
    return sorted(out)


def audited(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", 1, "b") for r in rows], SCHEMA)
    found = divergence.audit(docs, **options)
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in found.collect())


@pytest.mark.parametrize("bucket_terms", [4096, 5])
def test_against_brute_force(spark, monkeypatch, bucket_terms):
    monkeypatch.setattr(divergence, "BUCKET_TERMS", bucket_terms)
    rng = random.Random(4)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["É", "é", "ß", "中文"]
    rows = []
    for i in range(300):
        source = rng.choice(["a", "a", "a", "b", "c", None])
        own = vocabulary[:40] if source == "b" else vocabulary
        text = " ".join(rng.choice(own).upper() if rng.random() < 0.2 else rng.choice(own) for _ in range(rng.randrange(30)))
        rows.append((i % 50, rng.choice(["en", "en", "de", None]), source, text + "1x2"))
    rows += [(1, "en", "empty", None), (1, "en", "empty", ""), (2, "xx", "p", "only few"), (2, "xx", "q", None), (3, "en", "a", "long " * 60_000)]
    want = brute(rows)
    assert {r[2] for r in want} == {"pair", "term"} and ("xx", "p", "pair", "q", 0, 1) in want
    assert audited(spark, rows) == want


def test_ties_go_to_the_earlier_spelling(spark):
    words = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(60)]
    rows = [(i, "en", "a", " ".join(words)) for i in range(12)] + [(i, "en", "b", "other") for i in range(12)]
    found = [r for r in audited(spark, rows) if r[1] == "a" and r[2] == "term"]
    assert [r[3] for r in sorted(found, key=lambda r: r[5])] == sorted(words)[:10]
    assert audited(spark, rows) == brute(rows)


def test_empty_table_has_no_groups(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_skyband_against_all_pairs():
    rng = np.random.default_rng(8)
    for size, values in ((700, 20), (900, 1000), (1, 1)):
        high, low, order = rng.integers(0, values, size), rng.integers(0, values, size), rng.permutation(size)
        dominated = [sum((high >= high[i]) & (low <= low[i]) & (order < order[i])) for i in range(size)]
        assert sorted(divergence.skyband(high, low, order, 4)) == [i for i in range(size) if dominated[i] < 4]


def test_shares_are_exact_beyond_64_bits():
    counts = np.array([0, 10**12, 3 * 10**15], np.int64)
    total = 4 * 10**15 + 7
    assert divergence.shares(counts, total).tolist() == [1 + 10**9 * (int(c) + 2) // total for c in counts]
