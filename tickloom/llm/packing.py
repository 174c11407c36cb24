"""Packing documents into fixed-length token sequences by sums of squares.

Documents become token ids and, beyond the length of a sequence, pieces. Pieces are dealt into shards of about SHARD_PIECES;
a task packs a shard, longest first: each piece goes where the sum over all residual gaps of the squared number of open
sequences with that gap becomes smallest. Sequences that could still hold the shortest piece around, and have over OPEN_TOKENS
left, are opened again: their pieces go to the next level, dealt anew into shards of the same size. Levels end when one shard
held all, when packing anew saves less than GAIN of the sequences, or after LEVELS; shards never grow.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, in_batches, written

#: Pieces packed in one task, and tokens left in a sequence beyond which it is packed again with those of other shards.
SHARD_PIECES, OPEN_TOKENS = 16_384, 16
#: Levels at most, and the share of its sequences that a level must save for another to follow.
LEVELS, GAIN = 8, 0.01
#: Bits of a sequence's number that count sequences of a shard, and shards of a level; the level stands above.
SEQUENCE_BITS, SHARD_BITS = 24, 32
#: Words whose ids a worker remembers (a cache only), and characters of text handled at once.
CACHE, CHUNK_CHARS = 400_000, 1 << 20
#: Up to this character, normalising is lower-casing alone. The control characters are blanks to some libraries only.
LATIN = "\u017f"
NOT_PLAIN = re.compile("[^\0-\x1b -" + LATIN + "]")


def word_pattern(last: str) -> re.Pattern:
    """How vocabularies of this family cut normalised text, for characters up to last: contractions, runs of letters, single
    numbers, runs of what is neither nor blank."""
    of = {"L": "", "N": ""}
    for c in map(chr, range(ord(last) + 1)):
        if (kind := unicodedata.category(c)[0]) in of:
            of[kind] += c
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{of['L']}]+|[{of['N']}]|[^{of['L']}{of['N']}\t-\r \x85\xa0]+")


class Words(dict):
    """Word to ids (little-endian 32 bits); a word that isn't there is asked from the library's model."""

    def __init__(self, tool):
        self.model = tool.model
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        spare = iter(range(256, 512))
        self.shown = {b: b if b in shown else next(spare) for b in range(256)}

    def __missing__(self, word: str) -> bytes:
        bytewise = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.shown)
        self[word] = ids = array("I", [t.id for t in self.model.tokenize(bytewise)]).tobytes()
        return ids


class WordIds:
    """The ids that the library gives for texts, as little-endian 32-bit words.

    Up to U+017F, words don't influence each other: a word's ids are asked from the library's model once and remembered.
    Texts with other characters or special strings go to the library whole.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(file)
        self.ascii_cut, self.cut = word_pattern("\x7f"), word_pattern(LATIN)
        self.special = [t.content for t in self.tool.get_added_tokens_decoder().values()]
        self.ids = Words(self.tool)

    def library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tool.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.ids) > CACHE:
            self.ids.clear()
        out, get = [], self.ids.__getitem__
        for t in texts:
            if NOT_PLAIN.search(t) or any(s in t for s in self.special):
                out += self.library([t])
            else:
                out.append(b"".join(map(get, (self.ascii_cut if t.isascii() else self.cut).findall(t.lower()))))
        return out


@lru_cache(maxsize=2)
def word_ids(file: str) -> WordIds:
    """One for each worker process and file."""
    return WordIds(file)


def pieces(docs: DataFrame, file: str, text_col: str = "text", length: int = 4096, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """A row for each piece of each document: docs without text_col, and piece, start, length, ids_crc32 and, if asked for,
    ids (binary, little-endian 32 bits)."""
    names = ["piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]
    keep = [c for c in docs.columns if c != text_col and c not in names]
    (raw,) = fresh(docs, "raw")
    schema = docs.select(*keep).schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    schema = schema.add("ids", "binary") if keep_ids else schema
    end, size = np.array([end_id], "<u4").tobytes(), 4 * length

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = word_ids(file)

        def cut(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            rows, piece, start, count, crc, ids = [], [], [], [], [], []
            for i, data in enumerate(tool.encode(texts)):
                data += end
                for k, at in enumerate(range(0, len(data), size)):
                    part = data[at : at + size]
                    rows.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    count.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(part)
            same = [batch.column(c).take(pa.array(rows, pa.int64())) for c in range(len(keep))]
            own = [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, count, crc)), *[pa.array(ids, pa.binary())] * keep_ids]
            return pa.RecordBatch.from_arrays([*same, *own], names=schema.names)

        for batch in batches:
            first, texts, chars = 0, [], 0
            for i, x in enumerate(batch.column(len(keep))):
                texts.append((x.as_py() or b"").decode("utf-8", "replace"))
                chars += len(texts[-1])
                if chars >= CHUNK_CHARS or i == batch.num_rows - 1:
                    yield cut(batch.slice(first, i + 1 - first), texts)
                    first, texts, chars = i + 1, [], 0

    return docs.select(*keep, F.col(text_col).cast("binary").alias(raw)).transform(in_batches, made, schema)


def sum_of_squares(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each length (none above room), placed in the given order, and the gap left in each sequence.

    With N(g) open sequences of gap g, a length s in a sequence of gap g changes the sum of squares by 2 (N(g-s) - N(g)) + 2,
    closing one (g = s) by 1 - 2 N(s), a new sequence by 2 N(room-s) + 1. Ties go to the smallest gap, then to open sequences.
    """
    count = np.zeros(room + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(room + 1)]
    sequence, offset, gaps = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    far = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        if s == room:
            sequence[i], offset[i] = len(gaps), 0
            gaps.append(0)
            continue
        have = count[s:room]
        change = 2 * (count[: room - s] - have) + 2
        change[0] = 1 - 2 * have[0]
        change[have == 0] = far
        gap = int(change.argmin()) + s
        if change[gap - s] <= 2 * count[room - s] + 1:
            k = open_at[gap].pop()
            count[gap] -= 1
        else:
            k, gap = len(gaps), room
            gaps.append(room)
        sequence[i], offset[i] = k, room - gap
        gaps[k] = gap - s
        if gap > s:
            count[gap - s] += 1
            open_at[gap - s].append(k)
    return sequence, offset, np.array(gaps, np.int64)


def _packer(row: str, room: int, level: int, shortest: int, open_tokens: int):
    def packed(key, pdf):
        pdf = pdf.sort_values(["length", row], ascending=[False, True], kind="stable")
        sequence, offset, gaps = sum_of_squares(pdf["length"].to_numpy(), room)
        number = (level << SHARD_BITS + SEQUENCE_BITS) + (int(key[0]) << SEQUENCE_BITS) + sequence
        full = gaps[sequence] < max(shortest, open_tokens + 1)
        return pd.DataFrame({row: pdf[row].to_numpy(), "length": pdf["length"].to_numpy(), "sequence_id": number, "offset": offset, "settled": full})

    return packed


def pack(parts: DataFrame, room: int = 4096, shard_pieces: int = SHARD_PIECES, open_tokens: int = OPEN_TOKENS) -> DataFrame:
    """parts (with column length, none above room) with sequence_id and offset (place in the sequence, gapless from 0).

    Pieces are told apart by a row number given when they are written, so repeated rows, null or hot ids make no large shard.
    Equal lengths are placed in row order. An empty table gives an empty table; a length above room is an error. A task holds
    about shard_pieces pieces at every level.
    """
    if not 0 < shard_pieces < 1 << SEQUENCE_BITS - 1:
        raise ValueError(f"shards of {shard_pieces} pieces")
    (row,) = fresh(parts, "row")
    names = [c for c in parts.columns if c not in ("sequence_id", "offset")]
    now = written(parts.select(*names).withColumn(row, F.monotonically_increasing_id()), "pieces")
    count, longest, shortest = now.agg(F.count(F.lit(1)), F.max("length"), F.min("length")).first()
    if longest is not None and longest > room:
        raise ValueError(f"a piece of {longest} tokens doesn't fit into {room}")
    light, done, before, opened = now.select(row, "length"), [], None, 0
    for level in range(LEVELS):
        if not count:
            break
        shards = -(-count // shard_pieces)
        shard = F.pmod(F.xxhash64(row, F.lit(level)), F.lit(shards))
        placed = light.groupBy(shard.alias("shard")).applyInPandas(_packer(row, room, level, shortest, open_tokens), f"{row} long, length long, sequence_id long, offset long, settled boolean")
        placed = written(placed, "placed")
        made, left, first, low = placed.agg(F.count_if(F.col("offset") == 0), F.count_if(~F.col("settled")), F.count_if(F.expr("NOT settled AND offset = 0")), F.min(F.when(~F.col("settled"), F.col("length")))).first()
        if before is not None and made >= opened:
            done.append(before.where("NOT settled"))  # packing anew saved nothing: the pieces stay where they were
            break
        if shards == 1 or level == LEVELS - 1 or before is not None and made > (1 - GAIN) * opened:
            done.append(placed)
            break
        done.append(placed.where("settled"))
        before, opened, light, count, shortest = placed, first, placed.where("NOT settled").select(row, "length"), left, low
    if not done:
        return now.drop(row).withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    places = done[0]
    for more in done[1:]:
        places = places.unionByName(more)
    return now.join(places.select(row, "sequence_id", "offset"), row).drop(row)


def assemble(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of packed pieces with ids: a row for each sequence, which is at most a sequence's length of them."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.aggregate(parts, F.lit("").cast("binary"), lambda s, x: F.concat(s, x["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, file: str, text_col: str = "text", length: int = 4096, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """The pieces of docs and where they go: docs without text_col, and piece, start, length, ids_crc32, (ids,) sequence_id,
    offset.

    A document is the library's ids of its text, without special tokens, and end_id. Only longer ones than length are cut,
    into pieces of that length; the last may be shorter. A null or empty text is end_id alone. Repeated documents are packed
    each; special strings in texts and bytes that aren't UTF-8 (U+FFFD) are as the library takes them. Texts of any length
    are read whole. Other columns pass through, those named like results are replaced.
    """
    docs = docs.select(*[c for c in docs.columns if c not in ("sequence_id", "offset")])
    return pack(pieces(docs, file, text_col, length, end_id, keep_ids), length)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
