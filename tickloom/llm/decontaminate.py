"""Benchmark decontamination with an FM-index per training shard.

A worker cuts its documents into shards of bounded size. Words outside the benchmark's vocabulary can't be part of any match,
so a shard's text is its runs of known words, each closed by a separator of its own. Over the suffix order of that text stand
a wavelet matrix of the Burrows-Wheeler transform and sampled suffix positions. All test phrases (windows of the benchmark's
items) are searched backwards at once through wavelet ranks, occurrences are located by stepping back to a sampled position,
and the word spans they cover are merged.

A pass over the documents holds the items of PASS_BYTES of benchmark, as word ids end to end; a window is a place in them. A
larger benchmark takes more passes, whose results are written between them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LARGE_ROWS, fresh, in_batches, removed, written

#: Words are runs of other bytes than these, after A-Z are lower-cased (fixed by the definition of a word).
_CUT = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Bytes of documents to a shard, and distance of sampled suffix positions.
SHARD_BYTES, SAMPLE = 8 << 20, 8
#: Words of one index (a longer run of known words is cut into overlapping ones), and windows that are searched at once.
INDEX_WORDS, SEARCHED = 2 << 20, 1 << 18
#: Bytes of benchmark texts that one pass over the documents holds.
PASS_BYTES = 8 << 20


def words(text: bytes) -> list[bytes]:
    return text.translate(_CUT).split()


def window_classes(ids: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Equal numbers for equal windows of n ids at starts: ranks of runs of 1, 2, 4, ... ids are put together."""
    rank, size, done, key = ids.astype(np.int64), 1, 0, np.zeros(len(starts), np.int64)
    while True:
        if n & size:
            key = np.unique(key * (int(rank.max()) + 1) + rank[starts + done], return_inverse=True)[1]
            done += size
        if done == n:
            return key
        after = np.zeros_like(rank)
        after[:-size] = rank[size:] + 1
        rank, size = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)[1], 2 * size


class Phrases:
    """The different windows of a set of items: `text` has the items' word ids end to end, patterns by length the places of
    windows in it, and owners of a window (by its number) are items."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.ids: dict[bytes, int] = {}
        rows = [np.fromiter((self.ids.setdefault(w, len(self.ids) + 1) for w in words(text)), np.int32) for _, text in items]
        sizes = np.array([len(r) for r in rows], np.int64)
        self.text = np.concatenate([*rows, np.zeros(1, np.int32)])
        self.names = [name for name, _ in items]
        begin, length = np.cumsum(sizes) - sizes, np.minimum(sizes, window)
        self.patterns: dict[int, tuple[np.ndarray, int]] = {}
        self.owners, self.first_owner = np.zeros(0, np.int32), np.zeros(1, np.int64)
        for n in np.unique(length[length > 0]).tolist():
            item = np.flatnonzero(length == n)
            count = sizes[item] - n + 1
            starts = np.arange(int(count.sum())) + np.repeat(begin[item] - (np.cumsum(count) - count), count)
            number = window_classes(self.text, starts, n)
            pairs = np.unique(number * len(items) + np.repeat(item, count))
            number_of, one = np.unique(number, return_index=True)
            self.patterns[n] = starts[one], len(self.first_owner) - 1
            owned = np.bincount(pairs // len(items), minlength=len(number_of))
            self.first_owner = np.r_[self.first_owner, self.first_owner[-1] + np.cumsum(owned)]
            self.owners = np.r_[self.owners, (pairs % len(items)).astype(np.int32)]
        self.least = min(self.patterns, default=0)

    def items(self, pattern: int) -> list[str]:
        """Names of the items that have a window, null ones left out."""
        own = self.owners[self.first_owner[pattern] : self.first_owner[pattern + 1]].tolist()
        return [self.names[i] for i in own if self.names[i] is not None]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by prefix doubling. Each 0 in text is a symbol of its own, smaller than all
    others and than later zeros; text ends with one, so no two suffixes are equal."""
    n = len(text)
    zero = text == 0
    rank = np.where(zero, np.cumsum(zero) - 1, text + np.count_nonzero(zero)).astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + int(text.max(initial=0)) + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.r_[0, np.cumsum(ordered[1:] != ordered[:-1])]
        rank = new
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence: a bit vector for each bit of the symbols, highest first, with counts of ones."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for b in range(bits - 1, -1, -1):
            bit = (symbols >> b & 1).astype(bool)
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            zeros = len(symbols) - int(ones[-1])
            self.levels.append((b, ones, zeros))
            symbols = np.r_[symbols[~bit], symbols[bit]]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        start = np.zeros_like(at)
        for b, ones, zeros in self.levels:
            bit = (symbol >> b & 1).astype(bool)
            at, start = (np.where(bit, zeros + ones[x], x - ones[x]) for x in (at, start))
        return at - start


class FMIndex:
    """Backward search over a text of word ids (1 to known), 0 closing each run."""

    def __init__(self, text: np.ndarray, known: int, sample: int = SAMPLE):
        order = suffix_order(text)
        self.bwt = text[order - 1]
        self.tree = WaveletMatrix(self.bwt, max(1, int(known).bit_length()))
        self.before = np.r_[0, np.cumsum(np.bincount(text, minlength=known + 1))]
        # A run's start is sampled, so that no step back crosses a separator.
        start = np.r_[True, text[:-1] == 0]
        place = np.arange(len(text))
        sampled = (place - np.maximum.accumulate(np.where(start, place, 0))) % sample == 0
        self.position = np.where(sampled[order], order, -1)

    def search(self, words: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of patterns (`length` word ids of words at each start) those that occur, and their intervals in the suffix order."""
        which, last = np.arange(len(starts)), words[starts + length - 1]
        low, high = self.before[last], self.before[last + 1]
        for k in range(length - 2, -2, -1):
            found = low < high
            which, low, high = which[found], low[found], high[found]
            if k < 0 or not len(which):
                break
            symbol = words[starts[which] + k].astype(np.int64)
            low, high = (self.before[symbol] + self.tree.rank(symbol, x) for x in (low, high))
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, given by their place in the order."""
        out, back, live, at = np.empty(len(rows), np.int64), 0, np.arange(len(rows)), rows
        while len(live):
            known = self.position[at]
            done = known >= 0
            out[live[done]] = known[done] + back
            live, at = live[~done], at[~done]
            symbol = self.bwt[at]
            at = self.before[symbol] + self.tree.rank(symbol, at)
            back += 1
        return out


def shard_matches(texts: list[bytes], phrases: Phrases, index_words: int = INDEX_WORDS) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], list[set[str]]]:
    """Of each text of a shard: its number of words, merged spans (starts, ends) of word places, and the items found."""
    get, rows = phrases.ids.get, [words(t) for t in texts]
    counts = np.array([len(r) for r in rows], np.int64)
    spans = [(np.zeros(0, np.int64),) * 2 for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    if not phrases.least or not counts.sum():
        return counts, spans, items
    ends = np.cumsum(counts + 1)  # each document is followed by a word that nothing knows
    ids = np.zeros(int(ends[-1]), np.int64)
    for row, end, n in zip(rows, ends.tolist(), counts.tolist()):
        ids[end - 1 - n : end - 1] = np.fromiter((get(w, 0) for w in row), np.int64, n)
    edge = np.flatnonzero(np.diff(np.r_[False, ids != 0, False].astype(np.int8)))
    starts, stops = edge[0::2], edge[1::2]
    long = stops - starts >= phrases.least
    starts, stops = starts[long], stops[long]
    if not len(starts):
        return counts, spans, items
    # Long runs become several that overlap by a word less than the longest window.
    shared = max(phrases.patterns) - 1
    parts = np.maximum(1, -(-(stops - starts - shared) // index_words))
    nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    starts, stops = np.repeat(starts, parts) + nth * index_words, np.repeat(stops, parts)
    stops = np.minimum(stops, starts + index_words + shared)
    sizes = stops - starts + 1  # each run has a 0 after it
    group = (np.cumsum(sizes) - 1) // index_words
    hit = np.zeros(len(ids) + 1, np.int64)
    found: list[np.ndarray] = []
    for g in np.unique(group).tolist():
        own, first = sizes[group == g], starts[group == g]
        source = np.arange(int(own.sum())) + np.repeat(first - (np.cumsum(own) - own), own)
        text = ids[source]
        text[np.cumsum(own) - 1] = 0
        index = FMIndex(text, len(phrases.ids))
        for n, (windows, number) in phrases.patterns.items():
            for at in range(0, len(windows), SEARCHED):
                which, low, high = index.search(phrases.text, windows[at : at + SEARCHED], n)
                total = high - low
                rows_at = np.arange(int(total.sum())) + np.repeat(low - (np.cumsum(total) - total), total)
                place = source[index.locate(rows_at)]
                np.add.at(hit, place, 1)
                np.add.at(hit, place + n, -1)
                if len(place):
                    found.append(np.unique(np.c_[np.searchsorted(ends, place, side="right"), np.repeat(number + at + which, total)], axis=0))
    for d, pattern in np.unique(np.concatenate(found), axis=0).tolist() if found else []:
        items[d].update(phrases.items(pattern))
    covered = np.cumsum(hit[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
    starts, stops = edge[0::2], edge[1::2]  # the separating word after each document keeps spans apart
    doc = np.searchsorted(ends, starts, side="right")
    for d in np.unique(doc).tolist():
        own = doc == d
        first = int(ends[d] - 1 - counts[d])
        spans[d] = starts[own] - first, stops[own] - first
    return counts, spans, items


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """text without the words of spans and what stands between them; what stands before and after a span stays."""
    if not spans:
        return text
    found = [m.span() for m in _WORD.finditer(text)]
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at : found[a][0]])
        at = found[b - 1][1]
    return b"".join([*parts, text[at:]])


@lru_cache(maxsize=1)
def _phrases(shared: Broadcast, window: int) -> Phrases:
    """One for each worker process and pass: a worker keeps a broadcast variable from task to task."""
    return Phrases(shared.value, window)


def find_spans(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, pass_bytes: int = PASS_BYTES, shard_bytes: int = SHARD_BYTES, cut: bool = False) -> DataFrame:
    """docs with n_words, n_hit (words inside an occurrence of a window), item_ids (of items with occurring windows, sorted)
    and spans (merged: first word, word after the last). With cut, text_col has those spans taken out.

    A window is `window` consecutive words of an item; an item of fewer words, but not none, is one window. A null text has
    no words and stays null; an item with null text or no words has no windows; the windows of an item with a null id are
    found, but there is no id to name; repeated items name their id once. Ids may be of any type that a cast to text and back
    keeps. Repeated documents are searched each; documents are independent, of any length. Empty tables: no documents, or
    nothing found. Other columns pass through, those named like results are replaced.

    A pass over the documents broadcasts about pass_bytes of the benchmark, dealt by hash; what a pass before the last has
    found is written next to the documents, so that no worker ever holds more of the benchmark than that.
    """
    results = ["n_words", "n_hit", "item_ids", "spans"]
    keep = [c for c in docs.columns if c not in results and c != text_col]
    raw, was_spans, was_items = fresh(docs, "raw", "spans", "items")
    span_type = "array<struct<first:long,after:long>>"
    id_type = items.schema[item_id].dataType.simpleString()
    rows = items.where(F.col(item_text).isNotNull()).select(F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("binary").alias("text")).distinct()
    parts = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // pass_bytes))
    rows = written(rows, "benchmark") if parts > 1 else rows
    part_of = F.pmod(F.xxhash64("id", "text"), F.lit(parts))
    at = docs.select(*keep, F.col(text_col).cast("binary").alias(raw), F.lit(None).cast(span_type).alias(was_spans), F.lit(None).cast("array<string>").alias(was_items), F.lit(None).cast("long").alias("n_words"))
    schema = at.schema
    n = len(keep)
    span_arrow = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))

    def searcher(held: Broadcast, last: bool):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                size, first = 0, 0
                for i in range(batch.num_rows):
                    size += len(batch.column(n)[i].as_buffer() or b"")
                    if size >= shard_bytes or i == batch.num_rows - 1:
                        yield shard(batch.slice(first, i + 1 - first))
                        size, first = 0, i + 1

        def shard(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(n).to_pylist()
            spans = [[(s["first"], s["after"]) for s in old or []] for old in batch.column(n + 1).to_pylist()]
            items = [set(ids or []) for ids in batch.column(n + 2).to_pylist()]
            counts, found, names = shard_matches([t or b"" for t in texts], _phrases(held, window))
            for i, (a, b) in enumerate(found):
                if len(a):
                    spans[i] = _merge([*spans[i], *zip(a.tolist(), b.tolist())])
                    items[i] |= names[i]
            if last and cut:
                texts = [t and cut_spans(t, s) for t, s in zip(texts, spans)]
            columns = [*batch.columns[:n], pa.array(texts, pa.binary()), pa.array([[{"first": a, "after": b} for a, b in s] for s in spans], span_arrow), pa.array([sorted(s) for s in items], pa.list_(pa.string())), pa.array(counts, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        return search

    for k in range(parts):
        held = items.sparkSession.sparkContext.broadcast([(r.id, bytes(r.text)) for r in (rows.where(part_of == k) if parts > 1 else rows).collect()])
        found = at.transform(in_batches, searcher(held, k == parts - 1), schema)
        if k < parts - 1:
            found = written(found, "benchmark-pass", **LARGE_ROWS)
            held.destroy()
            if k:
                removed(at)
        at = found
    text = F.col(raw).cast("string")
    hit = F.aggregate(was_spans, F.lit(0).cast("long"), lambda s, x: s + x["after"] - x["first"])
    passed = [text.alias(c) if c == text_col else F.col(c) for c in docs.columns if c not in results]
    return at.select(*passed, "n_words", hit.alias("n_hit"), F.array_sort(F.col(was_items).cast(f"array<{id_type}>")).alias("item_ids"), F.col(was_spans).alias("spans"))


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = find_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    names = F.array_join(F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bk AS (SELECT item_id, ws, least(10, len(ws)) AS k FROM b WHERE len(ws) > 0),
bi AS (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM bk),
bw AS (SELECT DISTINCT item_id, k, array_to_string(ws[i : i + k - 1], ' ') AS win FROM bi),
ks AS (SELECT DISTINCT k FROM bw),
di AS (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, ks WHERE len(ws) >= k),
dw AS (SELECT doc_id, k, i, array_to_string(ws[i : i + k - 1], ' ') AS win FROM di),
m AS (SELECT doc_id, dw.k, i, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)
"""
