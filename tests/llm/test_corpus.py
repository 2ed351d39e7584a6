"""The corpus operators on awkward small tables, against brute force and the libraries."""

import hashlib
import re
import tracemalloc
import zlib
from array import array
from itertools import combinations
from random import Random

import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from tenderlake.llm import bpe, components, decontaminate, fingerprints, licenses, lines, queries, sharding, simhash, tokenfiles, topk, toxicity, warc, wordbpe
from workload.check import normal

DOCS = [
    (1, "The MIT License.\nCafé größer 42's it'll!"),
    (2, None),
    (3, ""),
    (4, "a"),
    (5, " \n\t "),
    (6, "one two three four five six seven eight nine ten eleven twelve\nApache   license, general public License"),
    (7, "one two three four five six seven eight nine ten eleven twelve\nApache   license, general public License"),
    (7, "one two three four five six seven eight nine ten eleven twelve\nApache   license, general public License"),
    (8, "İstanbul 中文字 é K \U0001F600 <|endoftext|> x"),
    (None, "no id here, one two"),
    (9, "word " * 30_000),
    (10, "one two three four five six seven eight nine ten eleven thirteen"),
]
SCHEMA = "doc_id long, text string, key string, words int, row string, spans string, fp long, bytes int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "k", 1, "r", "s", 5, 6) for i, t in DOCS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df, *columns):
    return sorted(((tuple(r)) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def library():
    return wordbpe.load(wordbpe.vocabulary_path())


def test_bpe_equals_the_library(docs, empty, library):
    want = []
    for i, t in DOCS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        spoken = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(spoken.encode()).hexdigest()))
    path = wordbpe.vocabulary_path()
    assert pairs(bpe.digests(docs, path), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)
    assert bpe.encoded(docs, path).where("doc_id = 3").first()["ids"] == b""
    assert bpe.digests(empty, path).count() == 0


def test_plain_letters_are_cut_as_the_library_cuts_them(library):
    coder = bpe.WordBpe(wordbpe.vocabulary_path())
    for code in range(0x180):
        text = f"a{chr(code)}b {chr(code)}{chr(code)}1"
        assert array("I", b"".join(coder.encode(text))).tolist() == library.encode(text, add_special_tokens=False).ids


def test_chunks_make_the_whole_text():
    text = "ab cd\n" * 400_000
    parts = list(wordbpe.chunks(text))
    assert len(parts) > 1 and "".join(parts) == text


def test_token_files_round_trip(docs, empty, library):
    found = tokenfiles.round_trip(docs, wordbpe.vocabulary_path())
    start, want = 0, []
    for i, t in sorted(DOCS, key=lambda d: -1 if d[0] is None else d[0]):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    assert pairs(found, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=str)
    assert tokenfiles.round_trip(empty, wordbpe.vocabulary_path()).count() == 0


def shingle_print(text):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(tokens[i:i + 3]) for i in range(len(tokens) - 2)] if len(tokens) > 2 else [" ".join(tokens)] * bool(tokens)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(items, linked):
    root = list(range(len(items)))
    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    return root


def test_simhash_groups(docs, empty):
    prints = [shingle_print(t) for _, t in DOCS]
    root = grouped(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {r: min([i for (i, _), q in zip(DOCS, root) if q == r and i is not None], default=None) for r in root}
    want = [(i, f"{p:016x}", least[r]) for (i, _), p, r in zip(DOCS, prints, root)]
    assert pairs(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == sorted(want, key=str)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))
    assert simhash.near_duplicates(empty).count() == 0 and simhash.representatives(empty).count() == 0


def test_each_group_keeps_one_row_whatever_its_keys(spark):
    texts = [" ".join(f"{name}{i}" for i in range(30)) for name in ("ash", "birch", "cedar", "elm", "fir")]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]), (7, texts[2]), (7, texts[3]), (7, texts[4]), (8, texts[4]), (5, texts[3]), (9, None), (None, "")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, row int")
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    want = [(None, texts[0], 0), (None, texts[1], 1), (7, texts[2], 4), (5, texts[3], 8), (7, texts[4], 6), (9, None, 9)]
    assert pairs(kept, *docs.columns) == sorted(want, key=str)


def test_representatives_of_rows_with_maps(spark):
    docs = spark.createDataFrame([(1, "a b c d", {"x": 1}), (2, "a b c d", {"y": 2}), (3, None, None)], "doc_id long, text string, m map<string,int>")
    assert pairs(simhash.representatives(docs), "doc_id", "m") == [(1, {"x": 1}), (3, None)]


def test_keys_find_all_errors_of_three_bits(spark):
    import random

    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = list(base)
    for b in base:
        for n in (1, 2, 3, 4):
            for _ in range(5):
                x = b
                for bit in rng.sample(range(64), n):
                    x ^= 1 << bit
                values.append(x)
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = {frozenset(r) for r in simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long")).collect()}
    want = {frozenset((signed[i], signed[j])) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 3}
    assert found == want


def test_bit_counts_of_many_hashes():
    import numpy as np

    hashes = np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64)
    assert fingerprints.bit_counts(hashes).tolist() == [sum(int(h) >> b & 1 for h in hashes) for b in range(64)]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (102, 102)], "a long, b long")
    found = dict(map(tuple, components.components(links, "a", "b").collect()))
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


ITEMS = [(1, "Two three FOUR five six seven eight nine ten eleven, twelve"), (2, "one"), (3, None), (4, ""), (5, "two-three"), (2, "one"), (None, "café größer"), (11, "zz " * 12)]


def brute_hits(text):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    w, hit, items = word(text), set(), set()
    for item, t in ITEMS:
        b = word(t)
        size = min(10, len(b))
        for i in range(len(b) - size + 1 if size else 0):
            for j in range(len(w) - size + 1):
                if w[j:j + size] == b[i:i + size]:
                    hit |= set(range(j, j + size))
                    items |= {str(item)} if item is not None else set()
    return len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 40])
def test_decontamination(spark, docs, empty, chunk_bytes):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    short = docs.where("doc_id <> 9 or doc_id is null")
    found = decontaminate.scan(short.select("doc_id", "text"), bench, chunk_bytes=chunk_bytes).collect()
    for r in found:
        n, hit, items, _, _ = brute_hits(r["text"])
        assert (r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["items"])) == (n, hit, items)
    if chunk_bytes > 40:
        want = [(i, *brute_hits(t)) for i, t in DOCS if i != 9]
        got = pairs(decontaminate.digests(short, bench), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
        assert got == sorted(want, key=str)
        kept = decontaminate.clean(docs, bench)
        assert kept.columns == docs.columns
        texts = {r["doc_id"]: r["text"] for r in kept.collect()}
        assert texts[2] is None and texts[4] == "a" and 6 not in texts
        assert decontaminate.clean(empty, bench).count() == 0
        assert decontaminate.digests(docs, bench.limit(0)).where("contaminated").count() == 0


def test_lines_keep_one_of_each_group(spark, empty):
    long = "the quick brown fox jumps over the lazy dog while many other animals of the wood look on and say nothing at all about it today"
    rows = [(1, f"{long}\nshort\n\n|"), (2, f"  {long.upper()}\nother"), (3, f"{long}!\nnew line"), (4, None), (5, ""), (None, "short"), (6, long), (6, long), (7, "|\nx")]
    docs = spark.createDataFrame([(i, t, "k", 0) for i, t in rows], "doc_id long, text string, key string, line int")
    found = {(r["doc_id"]): (r["n_lines"], r["removed"]) for r in lines.digests(docs).collect()}
    assert found[None] == (1, "") and found[1] == (3, "1") and found[2] == (2, "0") and found[6] == (1, "0")
    assert found[3][1] in ("0",) and found[4] == found[5] == (0, "") and found[7] == (2, "0")
    kept = lines.without_repeated_lines(docs)
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert kept.columns == docs.columns and texts[2] == "other" and texts[4] is None and texts[5] == "" and 6 not in texts
    assert lines.digests(empty).count() == 0 and lines.without_repeated_lines(empty).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def line_hash(line):
    """Halves of words, or runs of three letters in scripts without blanks; bits of over half the different hashes."""
    if len(line.encode()) > 2 * len(line):
        hashes = {xxhash.xxh64_intdigest(w, 42) for w in re.findall("[^ ]{1,3}", line)}
    else:
        halves = [(w[: -(-len(w) // 2)], w[-(-len(w) // 2):]) for w in line.split(" ")]
        hashes = {xxhash.xxh64_intdigest(a, 42) for a, _ in halves}
        hashes |= {xxhash.xxh64_intdigest((1).to_bytes(4, "little"), xxhash.xxh64_intdigest(b, 42)) for _, b in halves}
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def test_keys_are_an_affine_plane():
    """Every two blocks share one key, and no six blocks meet all keys: six differing bits leave one untouched."""
    plane = [frozenset(p) for p in lines.plane()]
    assert len(plane) == 20 and all(len(p) == 4 for p in plane)
    assert all(sum({a, b} <= p for p in plane) == 1 for a, b in combinations(range(16), 2))
    assert all(any(p.isdisjoint(c) for p in plane) for c in combinations(range(16), 6))


def near_lines(random):
    """Lines with some words or letters changed, cut or put in, of several lengths; also without blanks."""
    word = lambda: "".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(random.randrange(2, 10)))
    found = set()
    for n in range(60):
        base = [word() for _ in range(random.choice((7, 15, 30, 60, 200)))]
        if n % 6 == 0:
            base = ["".join(chr(random.randrange(0x4E00, 0x9000)) for _ in range(random.randrange(40, 120)))]
        for _ in range(6):
            copy = list(base)
            for _ in range(random.randrange(3)):
                copy[random.randrange(len(copy))] = word() if len(base) > 1 else copy[0]
            text = " ".join(copy)
            for _ in range(random.randrange(3)):
                at = random.randrange(len(text))
                text = text[:at] + random.choice(("", "x", "yz")) + text[at + 1:]
            found.add(text.strip())
    return sorted(found)


def test_groups_of_lines_against_all_pairs(spark):
    texts = near_lines(Random(5))
    hashes = [line_hash(t) for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    def blocks(h, points):
        return [h >> 4 * p & 15 for p in points]

    certain = 0
    for i, a in enumerate(texts):
        for j in range(i):
            b, different = texts[j], (hashes[i] ^ hashes[j]).bit_count()
            if different > lines.MOST_BITS or edit_distance(a, b) > int(0.03 * max(len(a), len(b)) + 1e-9):
                continue
            shared = any(blocks(hashes[i], p) == blocks(hashes[j], p) for p in lines.plane())
            certain += different <= 6
            assert shared or different > 6
            if shared:
                root[max(top(i), top(j))] = min(top(i), top(j))
    removed = {i for i in range(len(texts)) if top(i) != i}
    assert certain > 60 and 30 < len(removed) < len(texts) - 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"] for r in lines.digests(docs).collect() if r["n_removed"]} == removed


def test_a_line_just_short_of_room_for_an_edit_meets_a_longer_one(spark):
    """Of 34 characters one may be missing, so lines of 33 are compared too; of 33 characters none may differ."""
    random, found = Random(11), []
    while len(found) < 6:
        text = " ".join(random.sample("abcdefghijklmnopqrstuvwxyz", 17))
        at = random.randrange(0, 33, 2)
        longer, other = text[: at + 1] + text[at] + text[at + 1 :], text[:at] + "é" + text[at + 1 :]
        if (line_hash(text) ^ line_hash(longer)).bit_count() <= 6:
            found.append((text, longer, other))
    assert {len(t) for t, _, _ in found} == {len(o) for _, _, o in found} == {33} and {len(l) for _, l, _ in found} == {34}
    rows = [(3 * i + k, t) for i, texts in enumerate(found) for k, t in enumerate(texts)]
    removed = {r["doc_id"] for r in lines.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r["n_removed"]}
    assert removed == {3 * i + 1 for i in range(len(found))}


def test_bits_are_counted_by_few_numbers(spark):
    """Adders take about five operations a piece for all 64 bits, and never a loop over the pieces of a usual line."""
    rows = spark.createDataFrame([(1, 3, [7, 3, 1]), (2, 1, [-1]), (3, 255, [1 << 62] * 200 + [5] * 55), (4, 0, None)], "key long, n int, hashes array<long>")
    planes = lines._planes(rows, ["key", "n"])
    assert planes.columns[2:] == [f"plane{i}" for i in range(8)]
    found = dict(pairs(planes.select("key", lines._over_half(8).alias("fp")), "key", "fp"))
    assert found == {1: 3, 2: -1, 3: 1 << 62, 4: 0}
    assert "lambda" not in planes._jdf.queryExecution().optimizedPlan().toString()


def test_edit_check_cuts_each_text_once(spark):
    base = " ".join(f"word{i}" for i in range(20))
    rows = [(1, 2, base, base), (1, 3, base, base.replace("word7", "wort7")), (1, 4, base, f"{base} and very much more"), (1, 5, base, base.replace("word", "thing")), (1, 6, "", "")]
    pairs_ = spark.createDataFrame(rows, "u long, v long, left_text string, right_text string")
    found = lines._alike(pairs_, 0.97)
    assert pairs(found, "u", "v") == [(1, 2), (1, 3), (1, 6)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") == 2


def test_edits_by_word_are_taken_before_whole_texts(spark):
    """Word by word the edits are counted of equally many words only; a shifted word is left to the whole comparison."""
    words = [f"word{i}" for i in range(60)]
    base, moved = " ".join(words), " ".join([*words[1:], "word0"])
    rows = [(1, 2, base, base.replace("word7 ", "wort7 ")), (1, 3, base, moved), (1, 4, base, " ".join(words[1:] + ["x"])), (1, 5, base, base + " x"), (1, 6, base, base.replace("word", "thing"))]
    frame = spark.createDataFrame(rows, "u long, v long, left_text string, right_text string")
    edits = frame.select("v", lines._word_edits(F.split("left_text", " "), F.split("right_text", " ")).alias("n"))
    found = dict(pairs(edits, "v", "n"))
    assert found[2] == 1 and found[3] > 60 and found[5] is None
    assert pairs(lines._alike(frame, 0.97), "u", "v") == [(1, v) for _, v, a, b in rows if edit_distance(a, b) <= int(0.03 * max(len(a), len(b)) + 1e-9)]


def test_fingerprints_at_the_widths_of_counts(spark):
    """Lines with as many different pieces as a width of counts holds, and one more or fewer."""
    random = Random(3)
    word = lambda: "".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12))
    texts = [" ".join(word() for _ in range(n // 2)) + (" " + chr(0x4E00) if n % 2 else "") for n in (1, 2, 62, 63, 64, 65, 254, 255, 256, 257, 2046, 2047, 2048, 2050)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = dict(pairs(lines._hashed(lines._lines(docs, "doc_id", "text")), "key", "fp"))
    assert {i: fp % (1 << 64) for i, fp in found.items()} == {i: line_hash(t.strip()) for i, t in enumerate(texts)}


def test_fingerprints_compare_all_counts_at_once():
    """Long generated code is not compiled by the JVM: one comparison per number of counts, none per bit."""
    for width in (7, 9, 12, 31):
        assert str(lines._majority(width)).count(">") <= 4 * len(lines._shifts(width))


def test_counts_rule_out_no_near_copy_and_most_others(spark):
    random = Random(9)
    letters = "eantiosr bcdefgé"
    rows = []
    for n in range(120):
        text = "".join(random.choice(letters) for _ in range(random.randrange(40, 900)))
        copy, edits = text, random.randrange(1, 12)
        for _ in range(edits):
            at = random.randrange(len(copy))
            copy = copy[:at] + random.choice(("", "e", "an")) + copy[at + 1:]
        rows.append((text, copy, 2 * edits))
    rows.append(("e" * 600, "e" * 300 + "a" * 300, 300))
    found = spark.createDataFrame(rows, "a string, b string, most int").select(lines._counted(F.col("a")).alias("x"), lines._counted(F.col("b")).alias("y"), "most")
    assert found.where(lines._counts_apart("x", "y") > F.col("most") * 2).count() == 0
    others = spark.createDataFrame([(u, v) for (u, _, _), (v, _, _) in zip(rows, rows[1:])], "a string, b string")
    most = F.greatest(F.length("a"), F.length("b")) * 0.03
    apart = others.select(lines._counted(F.col("a")).alias("x"), lines._counted(F.col("b")).alias("y"), most.alias("most")).where(lines._counts_apart("x", "y") > F.col("most") * 2)
    assert apart.count() > 100


def test_toxicity_takes_small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "10000")
    docs = spark.createDataFrame([(i, "some words") for i in range(3)], "doc_id long, text string")
    assert toxicity.tagged(docs, toxicity.Model()).count() == 3 and int(spark.conf.get(name)) <= 1000
    spark.conf.set(name, before)


def test_most_near_equal_lines_are_found(spark):
    """Of pairs whose edit similarity is 0.97 or more, half of them with letters strewn up to the limit; README has the measured shares."""
    random = Random(11)
    word = lambda: "".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(random.randrange(2, 10)))
    texts = []
    for n in range(160):
        base = [word() for _ in range(random.choice((12, 25, 40, 80)))]
        text = " ".join(base)
        if n % 2:
            copy = list(base)
            copy[random.randrange(len(copy))] = word()
            texts += [text, " ".join(copy)]
        else:
            for _ in range(random.randrange(1, max(2, int(0.03 * len(text))))):
                at = random.randrange(len(text))
                text = text[:at] + random.choice("abcdefghij") + text[at + 1:]
            texts += [" ".join(base), text]
    alike = {i for i in range(1, len(texts), 2) if edit_distance(texts[i - 1], texts[i]) <= int(0.03 * max(map(len, texts[i - 1:i + 1])) + 1e-9)}
    assert len(alike) > 100
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"] for r in lines.digests(docs).collect() if r["n_removed"]}
    assert found <= alike and len(found) >= 0.8 * len(alike)


def test_lines_of_awkward_rows(spark):
    schema = "doc_id long, text string, m map<string,int>, line int, removed string"
    long = "ab cd " * 50_000
    rows = [(1, "one\ntwo", {"a": 1}, 0, "r"), (1, "one\ntwo", {"b": 2}, 0, "r"), (2, f"{long}\ntwo", None, 1, "r"), (3, f"{long}\nthree", None, 1, "r"), (4, None, {}, 2, "r")]
    docs = spark.createDataFrame(rows, schema)
    kept = {r["doc_id"]: r["text"] for r in lines.without_repeated_lines(docs).collect()}
    assert kept == {1: "one\ntwo", 2: long, 3: "three", 4: None}
    assert lines.without_repeated_lines(docs).columns == docs.columns


def test_shards_fit_and_split_rows_of_one_key(spark, empty):
    rows = [(7, "x" * 100)] * 50 + [(i, "y" * 100) for i in range(50)] + [(None, "z" * 5000), (3, None)]
    found = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string"), limit=1000).collect()
    sizes = {}
    for r in found:
        n, size = sizes.get(r["shard"], (0, 0))
        sizes[r["shard"]] = n + 1, size + r["bytes"]
    assert len(found) == len(rows) and all(size <= 1000 or n == 1 for n, size in sizes.values())
    names = sorted(sizes)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    assert sharding.shards(empty).count() == 0


def test_licenses(docs, empty):
    found = {r["doc_id"]: r.asDict() for r in licenses.labelled(docs).collect()}
    assert found[1]["base_labels"] == "mit" and found[1]["first_word"] == 1 and found[1]["score"] == 1.0
    assert found[6]["base_labels"] == "apache,gpl" and (found[6]["n_base"], found[6]["first_word"], found[6]["last_word"]) == (2, 12, 14)
    assert found[2]["n_words"] == 0 and found[2]["labels"] == "" and found[9]["n_words"] == 30_000
    assert licenses.labelled(docs).count() == len(DOCS) and licenses.labelled(empty).count() == 0


def test_toxicity_learns_markers(spark, empty):
    clean = "the river runs past the old mill and over the stones"
    rows = [(i, f"{clean} {'vexatio' + 'abc'[i % 3] if i % 4 == 0 else 'gently'} number{i}") for i in range(400)]
    docs = spark.createDataFrame([*rows, (None, None), (1000, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, None if i == 3 else int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    found = toxicity.scores(docs, labels).toPandas().set_index("doc_id")
    held = found[found.held_out & found.index.notna() & (found.index < 400)]
    assert len(held) > 30 and all((held.predicted == 1) == (held.index % 4 == 0))
    assert found.score.between(0, 1).all() and len(found) == 402
    tagged = toxicity.tagged(docs, toxicity.fit(docs, labels)).where("doc_id = 4").first()
    assert [rows[4][1].encode()[s["start"]:s["end"]].decode() for s in tagged["toxic_spans"]] == ["vexatiob"]
    assert toxicity.scores(docs, labels.limit(0)).where("score <> 0").count() == 0
    assert toxicity.scores(empty, labels).count() == 0


def test_toxicity_fit_holds_doubles_of_a_block(spark, monkeypatch):
    # A million words: whole arrays of doubles took over 200 MB of the driver.
    monkeypatch.setattr(toxicity, "_EPOCHS", 2)
    rows = [(i, " ".join(["plain words here", "vexatious" if i % 4 == 0 else "harmless"] * 700)) for i in range(360)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    tracemalloc.start()
    try:
        model = toxicity.fit(docs, labels, held_out=None)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert b"=vexatious" in model.weights
    assert peak < 100e6


def test_toxic_share_is_that_of_all_labels(spark):
    # Nothing tells the labels apart, so every score is the share of toxic documents; labels without documents do not count.
    docs = spark.createDataFrame([(i, "the river runs past the old mill") for i in range(1000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1000)] + [(2000 + i, 1) for i in range(100)], "doc_id long, toxic int")
    for each in (100, 10_000):
        model = toxicity.fit(docs, labels, each=each, held_out=None)
        assert model.score(model.marginals([[b"river"]])[0]) == pytest.approx(0.1, abs=0.01)


def test_topk_against_brute_force(spark):
    import math
    import random

    rng = random.Random(3)
    rows = [(i, [rng.choice([0.0, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(230)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf")]), (400, []), (500, [1e17, 2.0]), (200, rows[200][1]), (None, [1.0])]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))]))
    ok = {i: [math.floor(1024 * x) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in ok:
        if q % 100 == 0:
            score = lambda c: min(max(sum(a * b for a, b in zip(ok[q], ok[c])), -(1 << 63)), (1 << 63) - 1)  # noqa: B023, E731
            for rank, (s, c) in enumerate(sorted((-score(c), c) for c in ok if c != q)[:10], 1):
                want.append((q, rank, c, -s))
    assert pairs(topk.search(df, df.where("vec_id % 100 = 0")), "query_id", "rank", "vec_id", "score") == sorted(want, key=str)
    assert topk.search(df.limit(0), df.limit(0)).count() == 0


def test_warc_transactions(spark):
    rows = [(1, "http://a", "<p>é\r\n\r\nx</p>"), (2, "http://b", "<p>é\r\n\r\nx</p>"), (3, None, None), (4, "u", ""), (4, "u", ""), (5, "http://c", "only"), (None, "v", "lost")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    found = warc.round_trip(pages)
    got = pairs(warc.page_digests(found), "page_id", "payload_bytes", "record_type", "refers_to")
    assert got == sorted([(1, 14, "revisit", 2), (2, 14, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None), (4, 0, "revisit", 4), (5, 4, "response", None), (None, 4, "response", None)], key=str)
    one = found.where("answer.payload_bytes = 14").first()
    assert bytes(one["answer"]["payload"]).decode() == rows[0][2] and one["request"]["head"].startswith("GET http://b ")
    assert warc.page_digests(warc.round_trip(pages.limit(0))).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    got, want = queries.QUERIES[name](spark, sf_dir).toPandas(), con.execute(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and normal(got) == normal(want)


def test_pipeline_keeps_clean_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf_dir)
        assert now.columns == docs.columns, name
    final = corpus_pipeline.run(spark, sf_dir)
    ids = [r["doc_id"] for r in final.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and 0.7 * docs.count() < len(ids) < docs.count()
    assert now.where(F.col("text").isNull()).count() == 0


def test_scores_beyond_64_bits_keep_their_order(spark):
    rows = [(0, [1e6] * 64), (1, [1e6] * 64), (2, [9e5] * 64), (3, [-1e6] * 64), (4, [1.0] * 64), (5, [3e14]), (6, [-3e14] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [(r["vec_id"], r["score"]) for r in topk.search(df, df.where("vec_id = 0")).orderBy("rank").collect()]
    exact = {i: sum(int(1024 * a) * int(1024 * b) for a, b in zip(rows[0][1], v)) for i, v in rows[1:]}
    held = {i: min(max(s, -(1 << 63)), (1 << 63) - 1) for i, s in exact.items()}
    assert found == sorted(held.items(), key=lambda x: (-x[1], x[0]))


@pytest.mark.parametrize("revisit_bytes", [0, 5])
def test_warc_writes_a_record_for_every_row(spark, revisit_bytes):
    rows = [(1, "u", "same page")] * 5 + [(2, "u", "same page"), (3, "a\nb", "x"), (3, "a b", "x"), (3, "a b", "x"), (4, None, None), (4, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = warc.round_trip(pages, revisit_bytes)
    got = pairs(warc.page_digests(found), "page_id", "payload_bytes", "record_type", "refers_to")
    want = [(1, 9, "revisit", 2)] * 5 + [(2, 9, "response", None)]
    if revisit_bytes:
        want += [(3, 1, "response", None)] * 3 + [(4, 0, "response", None)] * 2
    else:
        want += [(3, 1, "response", None)] + [(3, 1, "revisit", 3)] * 2 + [(4, 0, "response", None), (4, 0, "revisit", 4)]
    assert got == sorted(want, key=str)
    assert found.select("capture_id").distinct().count() == len(rows)


def test_blocks_keep_all_labels_they_meet(spark):
    lgpl, gpl = (next(t for t in licenses.NOTICES if t.label == label) for label in ("lgpl-3.0", "gpl-3.0"))
    text = " ".join([*lgpl.words, *gpl.words[:3], "out", *gpl.words[4:]])
    docs = spark.createDataFrame([(1, text), (2, " ".join(lgpl.words)), (3, " ".join(gpl.words))], "doc_id long, text string")
    found = dict(pairs(licenses.labelled(docs), "doc_id", "labels"))
    assert found == {1: "gpl,gpl-3.0,lgpl-3.0", 2: "lgpl-3.0", 3: "gpl,gpl-3.0"}
