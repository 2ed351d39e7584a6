"""Pattern packing against the tokenizers library and brute force."""

import zlib
from array import array

import numpy as np
import pytest

from tenderlake.llm import packing, wordbpe

CAPACITY = 16
ROWS = [(i, " ".join("the cat sat on a mat".split()[: 1 + i % 6])) for i in range(40)]
ROWS += [(100, "the " * 50), (101, None), (101, ""), (None, "cat"), (7, ROWS[7][1]), (200, "a" * 3000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in ROWS], "doc_id long, text string, piece string, length int, offset long")


def test_pieces_are_the_library_s_ids(spark, docs):
    library = wordbpe.load(wordbpe.vocabulary_path())
    want = []
    for i, text in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for n, at in enumerate(range(0, len(ids), CAPACITY)):
            own = ids[at:at + CAPACITY]
            want.append((i, n, at, len(own), zlib.crc32(array("I", own).tobytes())))
    found = packing.packed(docs, wordbpe.vocabulary_path(), CAPACITY, ids=True)
    rows = found.collect()
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in rows)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], bytes(r["ids"])))
    for held in by_sequence.values():
        ends = np.cumsum([n for _, n, _ in sorted(held)])
        assert [o for o, _, _ in sorted(held)] == [0, *ends[:-1]] and ends[-1] <= CAPACITY
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(found).collect()}
    assert whole == {s: b"".join(x for _, _, x in sorted(held)) for s, held in by_sequence.items()}
    assert len(by_sequence) <= -(-sum(r["length"] for r in rows) // CAPACITY) + 1


def test_empty_table_has_no_pieces(docs):
    assert packing.digests(docs.limit(0), wordbpe.vocabulary_path()).count() == 0


@pytest.mark.parametrize("shape", ["skewed", "flat", "equal", "few"])
def test_plan_holds_every_piece_once_in_few_sequences(shape):
    rng = np.random.default_rng(3)
    lengths = {
        "skewed": np.clip(np.exp(rng.normal(6.3, 1.1, 50_000)).astype(int), 1, 4096),
        "flat": rng.integers(1, 4097, 20_000),
        "equal": np.full(1000, 1500),
        "few": np.array([4096, 5, 1]),
    }[shape]
    counts = np.bincount(lengths, minlength=4097)
    groups = packing.plan(counts)
    held = np.zeros(4097, np.int64)
    for g in groups:
        assert g.repeats > 0 and g.rest == 4096 - sum(length * times for length, times in g.parts) >= 0
        for length, times in g.parts:
            held[length] += times * g.repeats
    assert (held == counts).all()
    n, fewest = sum(g.repeats for g in groups), -(-int(lengths.sum()) // 4096)
    assert n == 500 if shape == "equal" else n <= fewest * 1.01 + 1


def test_fit_finds_the_repeats_of_known_patterns():
    columns = packing.patterns(12)
    assert {tuple(sorted(c)) for c in columns} == {tuple(sorted((a, b, 12 - a - b))) for a in range(13) for b in range(13 - a)}
    target = np.zeros(13)
    for c, n in ((columns[3], 40), (columns[-1], 25)):
        np.add.at(target, c, n)
    target[0] = 0
    fitted = packing.fitted_repeats(columns, target)
    made = np.zeros(13)
    np.add.at(made, columns.T, np.tile(fitted, (3, 1)))
    assert (fitted >= 0).all() and made[1:] == pytest.approx(target[1:], abs=1e-3)
