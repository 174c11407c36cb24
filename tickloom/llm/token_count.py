"""Byte-pair token counts by rank-synchronous array merging.

Pre-tokens that a worker hasn't met are laid end to end in one ragged numpy array. Each round looks up the rank of every
adjacent pair, takes each sequence's lowest, merges all its occurrences there at once (left to right where they overlap) and
retires sequences without a known pair. A merged symbol is created after both its parts, so every pair with it ranks higher
and the rounds agree with merging one pair at a time.

Long pre-tokens (base64, unspaced scripts) would need a round over everything for each of thousands of ranks. They are merged
rank by rank instead, over links to the next symbol: each rank is taken up once, for all of them at once, and only the pairs
beside what it merged are looked up again.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, in_batches

#: How byte-level vocabularies of this family cut text before merging (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of text whose pre-tokens are held at once, and pre-tokens whose counts a worker remembers (a cache only).
CHUNK_CHARS, CACHE = 1 << 20, 1 << 19
#: Bytes of a pre-token from which it is merged rank by rank, and is not remembered.
LONG = 256
#: Up to this character, explicit classes of Python's own (faster) pattern engine say the same.
LATIN = "\u024f"
NOT_LATIN = re.compile(f"[^\0-{LATIN}]")
#: Characters outside these ranges may have got their class in one library's tables and not in the other's; texts with such
#: are cut by the tokenizer's own pre-tokenizer.
SETTLED = regex.compile(r"[^\x00-ɏЀ-ӿ‐-⁞₠-₿ぁ-ゖァ-ヺ一-龥가-힣]")


def latin_pattern(last: str) -> re.Pattern:
    """PATTERN with its classes spelled out, for texts of characters up to last."""
    of = {"L": "", "N": ""}
    for c in map(chr, range(ord(last) + 1)):
        if (kind := unicodedata.category(c)[0]) in of:
            of[kind] += c
    letter, number, blank = of["L"], of["N"], "\\t-\\r \\x85\\xa0"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{blank}{letter}{number}]+|[{blank}]+(?![^{blank}])|[{blank}]+")


NONE = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or else the next from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Merger:
    """Merge ranks of one vocabulary file, and the counts of the pre-tokens met so far."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.first = np.array([vocab[c] for c in byte_symbols()], np.int64)
        self.base = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        key = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int32), made
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.special_cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.cut, self.latin_cut, self.ascii_cut = regex.compile(PATTERN), latin_pattern(LATIN), latin_pattern("\x7f")
        self.own = Tokenizer.from_file(file).pre_tokenizer
        self.counts: dict[str, int] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def long_lengths(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each long word: ranks in order, each merged at all its places at once."""
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes + 1) - 1  # an empty place after each word, which pairs with nothing
        size = int(ends[-1]) + 1
        sym = np.full(size, -1, np.int64)
        real = np.ones(size, bool)
        real[ends] = False
        sym[real] = self.first[np.frombuffer(b"".join(words), np.uint8)]
        after, before = np.arange(1, size + 1), np.arange(-1, size - 1)
        rank = np.full(size, NONE, np.int32)
        both = np.flatnonzero(real[:-1] & real[1:])
        rank[both] = self._ranks(sym[both], sym[both + 1])
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def wait(places: np.ndarray) -> None:
            """Notes places whose pair has a rank, by rank."""
            own = rank[places]
            places, own = places[own != NONE], own[own != NONE]
            order = np.argsort(own, kind="stable")
            places, own = places[order], own[order]
            edges = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else own
            for part, r in zip(np.split(places, edges[1:]), own[edges].tolist()):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(ranks, r)
                waiting[r].append(part)

        wait(both)
        alive = real.copy()
        while ranks:
            r = heapq.heappop(ranks)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[rank[at] == r]
            if not len(at):
                continue
            # Of overlapping occurrences (a a a), each second one from the left falls away.
            run = np.r_[True, after[at[:-1]] != at[1:]]
            number = np.arange(len(at))
            at = at[(number - np.maximum.accumulate(np.where(run, number, 0))) % 2 == 0]
            gone = after[at]
            sym[at], alive[gone], rank[gone] = self.made[r], False, NONE
            after[at] = after[gone]
            before[after[at]] = at
            left = before[at]
            changed = np.unique(np.r_[at, left[left >= 0]])
            changed = changed[alive[changed]]
            right = sym[after[changed]]
            rank[changed] = np.where(right >= 0, self._ranks(sym[changed], right), NONE)
            wait(changed)
        return np.add.reduceat(alive, np.r_[0, ends[:-1] + 1], dtype=np.int64)

    def merged_lengths(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each word after all merges."""
        sizes = np.array([len(w) for w in words], np.int64)
        out = sizes.copy()
        long = np.flatnonzero(sizes >= LONG)
        if len(long):
            out[long] = self.long_lengths([words[i] for i in long])
        live = np.flatnonzero((sizes > 1) & (sizes < LONG))
        sym = self.first[np.frombuffer(b"".join(words[i] for i in live), np.uint8)]
        size = sizes[live]
        while len(live):
            start = np.cumsum(size) - size
            rank = np.full(len(sym), NONE, np.int32)
            rank[:-1] = self._ranks(sym[:-1], sym[1:])
            rank[start + size - 1] = NONE  # a pair never spans two sequences
            low = np.minimum.reduceat(rank, start)
            chosen = (rank == np.repeat(low, size)) & (rank != NONE)
            # Of overlapping occurrences (a a a), each second one from the left falls away.
            where = np.flatnonzero(chosen)
            run = np.r_[True, where[1:] != where[:-1] + 1] if len(where) else np.zeros(0, bool)
            head = where[np.maximum.accumulate(np.where(run, np.arange(len(where)), 0))] if len(where) else where
            where = where[(where - head) % 2 == 0]
            sym[where] = self.made[rank[where]]
            keep = np.ones(len(sym), bool)
            keep[where + 1] = False
            size = np.add.reduceat(keep, start, dtype=np.int64)
            out[live] = size
            more = (low != NONE) & (size > 1)
            sym = sym[keep & np.repeat(more, np.add.reduceat(np.ones(len(keep), np.int64), start))]
            live, size = live[more], size[more]
        return out

    def pre_tokens(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_cut.findall(text)
        if not NOT_LATIN.search(text):
            return self.latin_cut.findall(text)
        if SETTLED.search(text):
            return [text[a:b] for _, (a, b) in self.own.pre_tokenize_str(text)]
        return self.cut.findall(text)

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text; the texts of one call are held as pre-tokens together."""
        total, held = [0] * len(texts), []
        for i, text in enumerate(texts):
            if any(x in text for x in self.special):
                total[i] = len(self.special_cut.findall(text))
                held += [(i, self.pre_tokens(part)) for part in self.special_cut.split(text) if part]
            elif text:
                held.append((i, self.pre_tokens(text)))
        if len(self.counts) > CACHE:
            self.counts.clear()
        new = list(set().union(*(t for _, t in held)) - self.counts.keys())
        self.counts.update(zip(new, self.merged_lengths([w.encode() for w in new]).tolist()))
        for i, tokens in held:
            total[i] += sum(map(self.counts.__getitem__, tokens))
        for word in new:
            if len(word) >= LONG // 4:  # what is remembered stays small
                del self.counts[word]
        return total


@lru_cache(maxsize=2)
def merger(file: str) -> Merger:
    """One for each worker process and file."""
    return Merger(file)


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """texts in order, in groups of about limit characters; a longer text is a group of its own."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > limit:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def count_tokens(docs: DataFrame, file: str, text_col: str = "text", limit: int = 1024) -> DataFrame:
    """docs with n_bytes (UTF-8), n_tokens (as the library counts, special strings in texts as special tokens, none added) and
    over_limit (n_tokens > limit).

    A null text is empty: 0 bytes, 0 tokens. Bytes that aren't UTF-8 count as U+FFFD. Each row is counted by itself, whatever
    repeats; other columns pass through, those named like results are replaced, and text_col is dropped. Empty tables give
    empty tables. Texts of any length are counted whole.
    """
    raw, n = fresh(docs, "raw", "n")
    keep = [c for c in docs.columns if c not in (text_col, "n_bytes", "n_tokens", "over_limit")]
    asked = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias(raw))
    schema = docs.select(*keep).schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = merger(file)
        for batch in batches:
            blobs = batch.column(len(keep)).to_pylist()
            tokens = [x for group in chunks([b.decode("utf-8", "replace") for b in blobs]) for x in tool.count(group)]
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array([len(b) for b in blobs], pa.int64()), pa.array(tokens, pa.int64()), pa.array([t > limit for t in tokens], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return asked.transform(in_batches, counted, schema)


def op5_token_count(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
