"""Benchmark decontamination with a generalised suffix automaton of the test items' words.

The automaton holds every run of words of every item. A document's words are streamed through it,
and the longest run that ends at each word and occurs in some item is tracked. A run of `window`
words or more marks all its words; an item of fewer words must occur whole.

The benchmark is cut into chunks of bounded size by hash. A chunk's automaton is broadcast, and each
document meets it where it lies: no document is shuffled. Further chunks add to the hits found so
far, which are written between passes.

Null and empty texts have no words; an item without words matches nothing; equal items (id and
text) count once, and equal ids count once in `items`. A null item id marks words but is not
listed. Other columns pass through; input columns named like the results are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.llm.common import WORD_BYTES, column, utf8, words
from tenderlake.storage import materialize

WINDOW = 10
# Bytes of benchmark text in one automaton; some fifty times as much memory.
CHUNK_BYTES = 4 << 20


class Automaton:
    """Suffix automaton over words; states are numbered from 0, the start."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.window = window
        self.word_ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        texts = [(item, found) for item, text in items if (found := words(text))]
        ends = []
        for item, found in texts:
            ids = [self.word_ids.setdefault(w, len(self.word_ids)) for w in found]
            last = 0
            for w in ids:
                last = self._extend(last, w)
            ends.append((item, ids))
        order = sorted(range(len(self.size)), key=self.size.__getitem__)
        self._mark(ends, order)

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            target = self.next[last][word]
            return target if self.size[target] == self.size[last] + 1 else self._split(last, word, target)
        state = len(self.size)
        self.next.append({})
        self.size.append(self.size[last] + 1)
        self.link.append(0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            target = self.next[at][word]
            self.link[state] = target if self.size[target] == self.size[at] + 1 else self._split(at, word, target)
        return state

    def _split(self, at: int, word: int, target: int) -> int:
        copy = len(self.size)
        self.next.append(dict(self.next[target]))
        self.size.append(self.size[at] + 1)
        self.link.append(self.link[target])
        self.link[target] = copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _mark(self, ends: list[tuple[str | None, list[int]]], order: list[int]) -> None:
        """For each state: the state of its last `window` words, and the short items it ends with."""
        n = len(self.size)
        self.tail = [-1] * n
        for state in order:
            if self.size[state] >= self.window:
                link = self.link[state]
                self.tail[state] = state if self.size[link] < self.window else self.tail[link]
        self.items: dict[int, set] = {}
        own: dict[int, list[tuple[int, str | None]]] = {}
        for item, ids in ends:
            state = 0
            for i, w in enumerate(ids, 1):
                state = self.next[state][w]
                if i >= self.window:
                    self.items.setdefault(self.tail[state], set()).add(item)
            if len(ids) < self.window:
                own.setdefault(state, []).append((len(ids), item))
        self.short: list = [None] * n
        for state in order[1:]:
            above = self.short[self.link[state]]
            if state in own:
                self.short[state] = (above or []) + own[state]
            else:
                self.short[state] = above

    def matches(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans (start, end) of hit words, apart and in order, and the items with an occurring window."""
        spans: list[list[int]] = []
        items: set = set()
        step, link, size, short, window = self.next, self.link, self.size, self.short, self.window
        state = length = 0
        for i, word in enumerate(map(self.word_ids.get, found)):
            if word is None:
                state = length = 0
                continue
            target = step[state].get(word)
            while target is None and state:
                state = link[state]
                length = size[state]
                target = step[state].get(word)
            if target is None:
                length = 0
                continue
            state = target
            length += 1
            if length >= window:
                items |= self.items[self.tail[state]]
                start = i + 1 - length
            elif short[state] is None:
                continue
            else:
                start = i + 1
            if short[state] is not None:
                for n, item in short[state]:
                    if n <= length:
                        items.add(item)
                        start = min(start, i + 1 - n)
            if start > i:
                continue
            while spans and spans[-1][0] >= start:
                spans.pop()
            if spans and spans[-1][1] >= start:
                spans[-1][1] = i + 1
            else:
                spans.append([start, i + 1])
        return [tuple(s) for s in spans], items


def merged(left: list[tuple[int, int]], right: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of two lists of spans, apart and in order."""
    out: list[list[int]] = []
    for start, end in sorted([*left, *right]):
        if out and out[-1][1] >= start:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(s) for s in out]


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_RESULTS = (T.StructField("n_words", T.LongType()), T.StructField("spans", _SPANS), T.StructField("items", T.ArrayType(T.StringType())))
_ARROW = {"n_words": pa.int64(), "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), "items": pa.list_(pa.string())}


def automata(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Automaton]:
    """One automaton for every chunk of the benchmark, of `chunk_bytes` on average."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), utf8(text).alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(size / chunk_bytes))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(chunks))
    for chunk in range(chunks):
        items = [(r["item"], bytes(r["text"])) for r in rows.where(part == chunk).collect()]
        yield Automaton(sorted(items, key=lambda x: (x[0] or "", x[1])), window)


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """`docs` with n_words, spans (of hit words, from 0, end excluded) and items (sorted ids)."""
    spark = docs.sparkSession
    names = [f.name for f in _RESULTS]
    found, first = docs.drop(*names), True
    for automaton in automata(benchmark, **options):
        if not first:
            found = materialize(found, "contamination")
        found = _pass(found, spark.sparkContext.broadcast(automaton), text, first)
        first = False
    return found


def _pass(docs: DataFrame, held, text: str, first: bool) -> DataFrame:
    names = list(_ARROW)
    schema = T.StructType([f for f in docs.schema if f.name not in names] + list(_RESULTS))
    place = docs.columns.index(text)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = held.value
        for batch in batches:
            before = [None] * len(batch) if first else zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
            counts, spans, items = [], [], []
            for value, known in zip(batch.column(place), before):
                value = value.as_py() or ""
                tokens = words(value if isinstance(value, bytes) else value.encode("utf-8"))
                hit, listed = automaton.matches(tokens)
                listed.discard(None)
                if known:
                    hit = merged(hit, [(s["start"], s["end"]) for s in known[0]])
                    listed |= set(known[1])
                counts.append(len(tokens))
                spans.append([{"start": s, "end": e} for s, e in hit])
                items.append(sorted(listed))
            kept = [c for c, n in zip(batch.columns, batch.schema.names) if n not in names]
            new = [pa.array(x, kind) for x, kind in zip((counts, spans, items), _ARROW.values())]
            yield pa.RecordBatch.from_arrays(kept + new, names=schema.names)

    return docs.mapInArrow(look, schema)


def digests(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of words, hit words and items for each document, without its text."""
    rows = docs.select(F.col(key).alias("key"), utf8(text).alias("text"))
    found = scan(rows, benchmark)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("key").alias(key),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def without_spans(text: str, spans: list) -> str:
    """The text without the bytes from the first to the last word of each span."""
    data, out, last = text.encode("utf-8"), [], 0
    places = [m.span() for m in WORD_BYTES.finditer(data.lower())]
    for s in spans:
        out.append(data[last:places[s["start"]][0]])
        last = places[s["end"] - 1][1]
    return b"".join([*out, data[last:]]).decode("utf-8")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", most_hit: float = 0.5, **options) -> DataFrame:
    """`docs` without contaminated spans; documents with over `most_hit` of their words hit go.

    Documents without a hit come out as they were. Other columns pass through as they are.
    """
    names = docs.columns
    rows = docs.select(F.col(text).alias("text"), F.struct(*[F.col(column(c)) for c in names]).alias("row"))
    found = scan(rows, benchmark, **options)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    found = found.where((F.size("spans") == 0) | (hit <= most_hit * F.col("n_words"))).select("row", "text", "spans")
    schema = T.StructType(list(found.schema)[:2])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [without_spans(t, s) if s else t for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    kept = found.mapInArrow(cut, schema)
    return kept.select(*[F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in names])
