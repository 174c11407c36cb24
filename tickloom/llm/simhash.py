"""SimHash near-duplicates with a forest of vantage-point trees.

In 64 bits, fingerprints of unlike texts are all some 32 bits apart, so a vantage point alone leaves about half of them in
reach of a radius of 3, and a tree on nothing else visits a share of all rows that hardly falls with depth (figures in the
README). The forest therefore has one level above its vantage points: fingerprints within `radius` bits agree on at least
blocks - radius of `blocks` bit blocks, so for each choice of that many blocks there is a tree per value of some of their bits,
as many bits as leave about DENSITY fingerprints to a tree. All pairs within the radius meet in a tree, and from there on
distances decide.

A tree over SHARD_ROWS is partitioned by Hamming distance from a vantage point into shells; by the triangle bound, pairs within
the radius are in shells that differ by it at most, so each fingerprint has a home shell and visits the next three. What two
such levels leave too large is dealt into pairs of blocks, each a task of bounded size. Inside a shard, rows sorted by distance
from a vantage point are compared within the same bound, which gives all pairs exactly; a shard returns a spanning forest of
its links, never all pairs of a group.

Copies meet first: equal fingerprints become one row by a partial aggregation, so only different ones are ever searched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, in_batches, numbered, removed, written
from .graph import SALTS, components, union

#: Rows of a shard beyond which it is split, and levels of shells before what is left is dealt into pairs of blocks.
SHARD_ROWS, LEVELS = 20_000, 2
#: Expected fingerprints to a tree, by which the bits of the level above are chosen.
DENSITY = 1024
#: Pairs compared, or links held, in one numpy step.
STEP = 1 << 20
BITS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.int64)


def shingle_hashes(text: bytes, width: int) -> tuple[bytes, np.ndarray]:
    """The text's words joined by blanks, and the XXH64 (seed 42) of its word shingles, repeats included; a text of fewer words
    than width is one shingle, one without words has none."""
    words = text.lower().split()  # on bytes: A-Z and the six ASCII blanks only
    joined = b" ".join(words)
    if not words:
        return joined, np.zeros(0, np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    if len(words) > width:
        starts, ends = starts[: 1 - width or None], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return joined, np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))


def folded(hashes: np.ndarray) -> int:
    """The fingerprint: a bit is set if it is set in over half of the hashes; zero if there are none."""
    lanes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(lanes[:, k], minlength=256) @ BITS for k in range(8)])
    return sum(1 << i for i in np.flatnonzero(counts * 2 > len(hashes)).tolist())


def fingerprint(text: bytes, width: int = 3) -> int:
    return folded(shingle_hashes(text, width)[1])


def fingerprints(docs: DataFrame, text_col: str, out_col: str, width: int = 3) -> DataFrame:
    """docs without text_col and with the fingerprint (as a signed long) in out_col."""
    keep = [c for c in docs.columns if c not in (text_col, out_col)]
    (raw,) = fresh(docs, "raw")
    schema = docs.select(*keep).schema.add(out_col, "long")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(x.as_py() or b"", width) for x in batch.column(len(keep))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(prints.view(np.int64))], names=schema.names)

    return docs.select(*keep, F.col(text_col).cast("binary").alias(raw)).transform(in_batches, made, schema)


def masks(blocks: int, radius: int, bits: int = 64) -> list[int]:
    """Signed 64-bit masks: all choices of blocks - radius of `blocks` blocks, of which at most `bits` bits count."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    chosen, out = blocks - radius, []
    for places in combinations(range(blocks), chosen):
        mask = 0
        for nth, i in enumerate(places):
            width = min(edges[i + 1] - edges[i], (bits + chosen - 1 - nth) // chosen)
            mask |= ((1 << width) - 1) << edges[i]
        out.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return list(dict.fromkeys(out))


def forest(rows: int, radius: int) -> list[int]:
    """The masks whose trees hold about DENSITY random fingerprints each: the fewest blocks that have bits enough for it, six
    at most for a radius of 3, and no more bits than it takes."""
    bits = max(0, rows // DENSITY - 1).bit_length()
    n = radius + 1
    while n < 2 * radius and 64 * (n - radius) // n < bits:
        n += 1
    return masks(n, radius, bits)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits; counted on unsigned words, as numpy counts those of a signed one's absolute value."""
    return np.bitwise_count((a ^ b).view(np.uint64))


class Shards:
    """Searches shards, and counts their pairs: all, those that vantage points leave, and those within the radius."""

    def __init__(self, radius: int):
        self.radius, self.pairs, self.compared, self.near = radius, 0, 0, 0

    def links(self, tree: np.ndarray, shard: np.ndarray, prints: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links (a, b) that connect what is within the radius in each shard of rows that come sorted by tree and shard. Pairs
        of two visitors don't count: they meet at home elsewhere."""
        first = np.flatnonzero(np.r_[True, (tree[1:] != tree[:-1]) | (shard[1:] != shard[:-1])])
        size = np.diff(np.r_[first, len(prints)])
        self.pairs += int((size * (size - 1) // 2).sum())
        number = np.repeat(np.arange(len(first)), size)
        # The vantage point is any row of the shard; distances from it sort the shard.
        away = distance(prints, prints[first][number]).astype(np.int64)
        order = np.lexsort((away, number))
        prints, home, away = prints[order], home[order], away[order]
        last = np.repeat(first + size, size)
        label, held, count, left, step = np.arange(len(prints)), [], 0, np.arange(len(prints)), 1
        while True:
            left = left[left + step < last[left]]
            left = left[away[left + step] - away[left] <= self.radius]  # the triangle bound; further rows are further away
            if not len(left):
                break
            self.compared += len(left)
            near = left[(distance(prints[left], prints[left + step]) <= self.radius) & (home[left] | home[left + step])]
            self.near += len(near)
            held.append((near, near + step))
            count += len(near)
            if count > STEP:
                union(label, *map(np.concatenate, zip(*held)))
                held, count = [], 0
            step += 1
        if count:
            union(label, *map(np.concatenate, zip(*held)))
        moved = np.flatnonzero(label != np.arange(len(label)))
        return prints[moved], prints[label[moved]]

    def of(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links of rows (tree, shard, print, home). Shards of a batch are searched together; one cut by the end of a batch
        waits for the next."""
        held: list[list[np.ndarray]] = []

        def solve():
            if held:
                yield self.links(*(np.concatenate(x) for x in zip(*held)))

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            other = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
            open_at = int(other[-1]) + 1 if len(other) else 0
            if held and (open_at or held[-1][0][-1] != rows[0][0] or held[-1][1][-1] != rows[1][0]):
                if open_at:
                    held.append([x[:open_at] for x in rows])
                yield from solve()
                held = []
            elif open_at:
                held = [[x[:open_at] for x in rows]]
                yield from solve()
                held = []
            held.append([x[open_at:] for x in rows])
        yield from solve()


def _counts(rows: DataFrame, limit: int, level: int) -> DataFrame:
    """Shards of over limit rows, their size, and a vantage point of theirs."""
    return rows.groupBy("tree", "shard").agg(F.count(F.lit(1)).alias("n"), F.min_by("print", F.xxhash64("print", F.lit(level))).alias("vantage")).where(F.col("n") > limit)


def sharded(prints: DataFrame, radius: int = 3, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Rows (tree, shard, print, home) of the distinct column `print`, in shards of about shard_rows at most, such that all
    pairs within radius bits share a shard in which one of them is at home."""
    trees = F.array(*[F.struct(F.lit(i).cast("long").alias("tree"), F.lit(m).alias("mask")) for i, m in enumerate(forest(prints.count(), radius))])
    rows = prints.select("print", F.explode(trees).alias("m")).select("m.tree", F.col("print").bitwiseAND(F.col("m.mask")).alias("shard"), "print", F.lit(True).alias("home"))
    for level in range(LEVELS + 1):
        # Few shards are large: their number is bounded by rows / shard_rows, yet they are joined, not collected.
        large = written(_counts(rows, shard_rows, level), "large-shards")
        if large.isEmpty():
            break
        copies = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("print"), F.lit(SALTS)).cast("int"))
        found = salted.join(copies, ["tree", "shard", "salt"], "left")
        whole = found.where("vantage IS NULL").select("tree", "shard", "print", "home")
        found = found.where("vantage IS NOT NULL")
        if level < LEVELS:
            away = F.bit_count(F.col("print").bitwiseXOR(F.col("vantage"))).cast("int")
            shells = F.sequence(F.when(F.col("home"), away).otherwise(away - radius), away + radius)
            split = found.select("tree", "shard", "print", "home", away.alias("away"), F.explode(shells).alias("shell"))
            split = split.select("tree", F.xxhash64("tree", "shard", "shell", F.lit(level)).alias("shard"), "print", (F.col("home") & (F.col("shell") == F.col("away"))).alias("home"))
        else:
            # Vantage points of a dense group leave nearly all of it in reach: every two blocks of it meet in a task.
            blocks = F.ceil(2 * F.col("n") / shard_rows).cast("int")
            own = F.pmod(F.xxhash64("print", F.lit("block")), blocks).cast("int")
            split = found.select("tree", "shard", "print", "home", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
            split = split.select("tree", F.xxhash64("tree", "shard", F.least("own", "other"), F.greatest("own", "other")).alias("shard"), "print", "home")
        new = written(whole.unionByName(split), "shards")
        if level:
            removed(rows)
        rows = new
    return rows


def near_links(prints: DataFrame, radius: int = 3, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b), both fingerprints, that connect all of the distinct column `print` within radius bits of each other."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b in Shards(radius).of(batches):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return sharded(prints, radius, shard_rows).repartition("tree", "shard").sortWithinPartitions("tree", "shard").transform(in_batches, searched, "a long, b long")


def pruning(prints: DataFrame, radius: int = 3, shard_rows: int = SHARD_ROWS) -> tuple[int, int, int, int]:
    """What a search comes to: distinct fingerprints, pairs that share a shard, those of them that vantage points leave to be
    compared, and those within the radius (a pair may share a shard of several trees)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = Shards(radius)
        for _ in shards.of(batches):
            pass
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (shards.pairs, shards.compared, shards.near)], names=["pairs", "compared", "near"])

    rows = sharded(prints, radius, shard_rows).repartition("tree", "shard").sortWithinPartitions("tree", "shard")
    sums = rows.transform(in_batches, counted, "pairs long, compared long, near long").agg(F.sum("pairs"), F.sum("compared"), F.sum("near")).first()
    return prints.count(), *(x or 0 for x in sums)


def group_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3, width: int = 3, shard_rows: int = SHARD_ROWS, similarity: bool = False, row_col: str | None = None) -> DataFrame:
    """docs (without text_col) with fingerprint (16 hex digits) and component_id: the smallest id among the documents that
    chains of fingerprints within radius bits reach.

    With similarity, a link holds if the sets of shingles have a Jaccard similarity of 0.8 or more, whatever the fingerprints:
    pairs from the forest are confirmed by their sets, and an exact set join finds those that are further apart in bits (see
    similar.py). row_col may then name a column that numbers the rows of docs, the same however often docs is read, as
    common.numbered() gives it; without it they are numbered so.

    Words are runs of other bytes than 0x20 and 0x09-0x0D, A-Z lower-cased; a text of fewer words than width is one shingle.
    A null text, or one without words, has fingerprint zero and is linked like any other. A null id is never the smallest; a
    component of null ids only has a null component_id. Repeated rows are equal documents. Texts of any length are read
    whole. Other columns pass through, those named like results are replaced; an empty table gives an empty table.
    """
    kept = docs.select(*[c for c in docs.columns if c not in ("fingerprint", "component_id")])
    fp, a, b, row = fresh(kept, "print", "a", "b", "row")
    names = [c for c in kept.columns if c != text_col]
    shown = F.lpad(F.lower(F.hex(fp)), 16, "0").alias("fingerprint")
    if similarity:
        from .similar import group_similar

        told = kept if row_col else numbered(kept, row)
        return group_similar(told, row_col or row, fp, id_col, text_col, radius, width, shard_rows).select(*names, shown, "component_id")
    printed = written(fingerprints(kept, text_col, fp, width), "prints")
    distinct = written(printed.groupBy(F.col(fp).alias("print")).agg(F.min(id_col).alias("first")), "distinct-prints")
    roots = components(near_links(distinct.select("print"), radius, shard_rows))
    linked = distinct.join(roots.hint("merge"), distinct["print"] == roots["node"], "left").select("print", "first", F.coalesce("root", "print").alias("root"))
    # Most components are one fingerprint; the smallest ids of the others meet by root.
    lowest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = linked.join(lowest.hint("merge"), "root").select(F.col("print").alias(a), F.col("component_id").alias(b))
    out = printed.join(named.hint("merge"), printed[fp] == named[a])
    return out.select(*names, shown, F.col(b).alias("component_id"))


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return group_near_copies(docs)
