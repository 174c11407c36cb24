"""Groups of texts whose sets of word shingles have a Jaccard similarity of 0.8 or more: SimHash links, confirmed and completed.

Fingerprints of such texts may be many bits apart (2 to 11 on the test tables), further than a search in 64 bits can prune. So
the forest of simhash.py proposes the pairs within its radius, which connect most large groups, and an exact set join finds the
rest: two sets of similarity SIMILAR share one of the first n - ceil(SIMILAR n) + 1 shingles (n: the set's size) in any order
that is the same for all sets. Here the order is rare ones first, as a sample tells, then by hash. Texts that share such a
shingle, with sizes and places that allow the similarity, and aren't connected yet, are compared by their whole sets. Which
shingles the sample finds frequent changes the number of comparisons and nothing else.

Equal word sequences become one text first. A shingle that more than SMALL texts share is met twice: at first each text meets
AHEAD others of nearest size, then, when these links have made components, all texts of other components. A shingle of more
than BLOCK texts is dealt among tasks: at first by blocks of its texts, as the sample tells their number, which only decides who
is nearest, then by pairs of blocks, counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from .common import fits, fresh, in_batches, removed, written
from .graph import components
from .simhash import SHARD_ROWS, folded, near_links, shingle_hashes

#: The similarity from which texts are near copies, as a fraction.
TOP, BOTTOM = 4, 5
#: Texts of the sample, in how many of them a shingle is frequent, and how many frequent ones are told to the executors at most.
SAMPLE, FREQUENT, TOLD = 20_000, 3, 1 << 16
#: Texts that share a shingle up to which all pairs meet at once, texts ahead that others meet at first, pairs of one numpy step.
SMALL, AHEAD, STEP = 4, 2, 1 << 20
#: Texts of one shingle that meet in a task at first, half of those that meet later.
BLOCK = 16_384
#: Texts to compare up to which their keys go to the executors (16 bytes each), and shared shingles (8 bytes each).
BROADCAST_ROWS, BROADCAST_SHINGLES = 500_000, 500_000
#: Of more texts to compare, the rows that a bitmap of 4 KB marks, as Spark makes it, and bitmaps that go to the executors at most.
ROWS_OF_MARK, MARKS = 1 << 15, 4096
#: Texts, and shingles of theirs, up to which a label's sets are compared in one place.
UNIT_TEXTS, UNIT_SHINGLES = 64, 1 << 20
#: Bytes that a round may put on disk in small tables, and those of a shuffled place of a shingle, alone and with parities.
ROUND_BYTES, PLACE_BYTES, MET_BYTES = 64 << 20, 24, 64
#: Bits of the sketch by which pairs are sieved before their sets are fetched, and of its folded form for often shared shingles.
SKETCH, FOLDED = 1024, 256
#: Of a set's size and a shingle's place in one long, the bits of the place.
PLACE = 32


def shingles(text: bytes, width: int = 5) -> tuple[int, np.ndarray, int]:
    """A hash of the text's words, the sorted hashes of its different shingles, and its fingerprint."""
    joined, hashes = shingle_hashes(text, width)
    return xxhash.xxh64_intdigest(joined, 7), np.unique(hashes.view(np.int64)), folded(hashes)


def leading(own: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The shingles of which a similar set has at least one among its own leading ones."""
    take = len(own) - (TOP * len(own) + BOTTOM - 1) // BOTTOM + 1 if len(own) else 0
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
        own = own[np.argsort(np.where(frequent[at] == own, rank[at] + 1, 0), kind="stable")]
    return own[:take]


def parities(own: np.ndarray) -> np.ndarray:
    """SKETCH bits: of the shingles that fall on each, whether their number is odd. Two sets differ in as many shingles at least
    as their bits differ; so they do in FOLDED bits, each the parity of those that are FOLDED places apart."""
    odd = np.bincount(own & SKETCH - 1, minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _frequent(told: DataFrame, row: str, text: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles that several texts of the sample have, sorted, their ranks by number of texts, and how many texts of all have them,
    if the sample is like the rest."""
    step = told.count() // SAMPLE + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                key, own, _ = shingles(x.as_py() or b"", width)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), _signed(key))), pa.array(own)], names=["key", "shingle"])

    pairs = told.where(F.pmod(F.xxhash64(row), F.lit(step)) == 0).select(F.col(text).cast("binary")).transform(in_batches, cut, "key long, shingle long").distinct()
    n = pairs.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "shingle").limit(TOLD).toPandas()
    order = np.argsort(n["shingle"].to_numpy(np.int64))
    return n["shingle"].to_numpy(np.int64)[order], (len(n) - np.arange(len(n)))[order], n["n"].to_numpy(np.int64)[order] * step


def _meetings(batches: Iterator[pa.RecordBatch], again: bool) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of rows (shingle, n and place, key) that come sorted by them; if again, of rows that go on with root and
    parities, and of different roots only. At first, a shingle of many texts is told as (shingle, null)."""
    held: list[list[np.ndarray]] = []

    def solve(shingle, sized, key, root=None, *bits):
        n, place = sized >> PLACE, sized & (1 << PLACE) - 1
        first = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
        size = np.diff(np.r_[first, len(shingle)])
        if not again and len(many := shingle[first[size > SMALL]]):
            yield many, None
        last, size = np.repeat(first + size, size), np.repeat(size, size)
        left, step, found, held_pairs = np.arange(len(shingle)), 1, [], 0
        while len(left := left[(left + step < last[left]) & (again | (size[left] <= SMALL) | (step <= AHEAD))]):
            left = left[BOTTOM * n[left] >= TOP * n[left + step]]  # sizes grow, so later ones are too large as well
            right = left + step
            least = -(-TOP * (n[left] + n[right]) // (TOP + BOTTOM))  # of shingles in common
            near = (np.minimum(n[left] - place[left], n[right] - place[right]) >= least) & (key[left] != key[right])
            if again:
                near &= root[left] != root[right]
                left_near, right_near = left[near], right[near]
                apart = sum(np.bitwise_count((x[left_near] ^ x[right_near]).view(np.uint64)).astype(np.int64) for x in bits)
                near[near] = apart <= n[left_near] + n[right_near] - 2 * least[near]
            a, b = key[left[near]], key[right[near]]
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
            held_pairs += len(a)
            step += 1
            if held_pairs > STEP:
                yield np.unique(np.concatenate(found), axis=0).T
                found, held_pairs = [], 0
        if held_pairs:
            yield np.unique(np.concatenate(found), axis=0).T

    def out():
        if held:
            for a, b in solve(*(np.concatenate(x) for x in zip(*held))):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
        open_at = int(np.searchsorted(rows[0], rows[0][-1]))  # the last shingle may go on in the next batch
        if open_at or held and held[-1][0][-1] != rows[0][0]:
            held.append([x[:open_at] for x in rows])
            yield from out()
            held = []
        held.append([x[open_at:] for x in rows])
    yield from out()


def _part(rounds: int, *of: str, salt: str = "round") -> Column:
    """The round of a row."""
    return F.pmod(F.xxhash64(*of, F.lit(salt)), F.lit(rounds))


def _pieces(total: int, most: int) -> int:
    """How many rounds keep each at `most` of the total, about."""
    return max(1, -(-total // most))


def _together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _found(told: DataFrame, rows: DataFrame, row: str, few: bool) -> DataFrame:
    """The rows of told that the column row of rows names. Up to BROADCAST_ROWS the numbers themselves go to the executors; more
    go as bitmaps of ROWS_OF_MARK rows each, up to MARKS of them, so that told is read once and not shuffled. Only numbers that
    lie too far apart for that are joined by merging."""
    if few:
        return told.join(F.broadcast(rows), row, "left_semi")
    mark, bits = fresh(told, "mark", "bits")
    of = F.shiftright(row, ROWS_OF_MARK.bit_length() - 1)
    if not fits(rows.select(of).distinct(), MARKS):
        return told.join(rows.hint("merge"), row, "left_semi")
    at = F.col(row).bitwiseAND(ROWS_OF_MARK - 1)
    marks = written(rows.groupBy(of.alias(mark)).agg(F.bitmap_construct_agg(at).alias(bits)), "marks")
    byte = F.conv(F.hex(F.substr(bits, F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.expr(f"shiftright({{}}, {{}})") if False else byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), at.bitwiseAND(7).cast("int") + 1)) != 0
    return told.withColumn(mark, of).join(F.broadcast(marks), mark).where(held).select(*told.columns)


def _dealt(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """The pairs (a, b) with the unit in which they are compared. Texts that pairs connect in a few steps have one label, and
    texts of one label are a unit if they are few; of more, each two blocks are one. A wrong label costs bytes only, as both
    texts of a pair go to its unit whatever it is."""
    ends = pairs.select(F.col("a").alias("key"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("key"), F.col("a").alias("other")))
    low = ends.groupBy("key").agg(F.least("key", F.min("other")).alias("label"))
    low = ends.join(low.withColumnRenamed("key", "other").hint("merge"), "other").groupBy("key").agg(F.min("label").alias("label"))
    low = written(low.join(named.select("key", "n").hint("merge"), "key"), "labels")
    sized = low.groupBy("label").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("bytes"))
    blocks = F.when((F.col("texts") <= UNIT_TEXTS) & (F.col("bytes") <= UNIT_SHINGLES), 1).otherwise(F.ceil(F.greatest(2 * F.col("texts") / UNIT_TEXTS, 2 * F.col("bytes") / UNIT_SHINGLES)))
    own = low.join(sized.select("label", blocks.alias("blocks")).hint("merge"), "label").select("key", F.xxhash64("label", F.pmod(F.xxhash64("key", F.lit("block")), "blocks")).alias("block"))
    own = written(own, "blocks")
    of = lambda x: own.select(F.col("key").alias(x), F.col("block").alias(f"of_{x}")).hint("merge")
    unit = F.xxhash64(F.least("of_a", "of_b"), F.greatest("of_a", "of_b"))
    dealt = written(pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b").select("a", "b", unit.alias("unit")), "dealt")
    for done in (low, own):
        removed(done)
    return dealt


def _similar(pairs: DataFrame, lead: DataFrame, told: DataFrame, row: str, text: str, width: int, most: int) -> DataFrame:
    """Those of the pairs (a, b) of keys whose whole sets are similar. Each text is read once, no text is ever shuffled, and its
    set goes once to each unit of pairs that names it, which mostly is one. Only sets that come to more than `most` bytes go in
    rounds, as many as that is times `most`, however large the table."""
    # A pair may come both ways round. Only the texts that pairs name are looked at from here on.
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct(), "proposed")
    keys = written(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "keys")
    named = written(lead.join(F.broadcast(keys) if fits(keys, BROADCAST_ROWS) else keys.hint("merge"), "key", "left_semi"), "named")
    of = lambda x: named.select(F.col("key").alias(x), F.struct("n", "parities").alias(f"of_{x}")).hint("merge")
    both_n = F.col("of_a.n") + F.col("of_b.n")
    apart = sum((F.bit_count(F.col("of_a.parities")[i].bitwiseXOR(F.col("of_b.parities")[i])) for i in range(SKETCH // 64)), F.lit(0))
    possible = apart <= both_n - 2 * F.ceil(both_n * TOP / (TOP + BOTTOM) - 1e-6)
    proposed, pairs = pairs, written(pairs.join(of("a"), "a").join(of("b"), "b").where(possible).select("a", "b"), "pairs")
    for done in (proposed, keys):
        removed(done)
    dealt = _dealt(pairs, named)
    sent = dealt.select(F.explode(F.array("a", "b")).alias("key"), "unit").groupBy("key").agg(F.collect_set("unit").alias("units"))
    wanted = written(sent.join(named.select("key", row, "n").hint("merge"), "key"), "wanted")
    for done in (named, pairs):
        removed(done)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array([shingles(x.as_py() or b"", width)[1] for x in batch.column(1)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), own], names=[row, "own"])

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A unit's sets, then its pairs."""
        unit, held = None, {}
        for batch in batches:
            good = []
            for i in range(batch.num_rows):
                if (at := batch.column(0)[i].as_py()) != unit:
                    unit, held = at, {}
                if batch.column(1)[i].is_valid:
                    held[batch.column(1)[i].as_py()] = batch.column(2)[i].values.to_numpy()
                    continue
                for a, b in zip(*(batch.column(k)[i].values.to_pylist() for k in (3, 4))):
                    u, v = held[a], held[b]
                    common = len(np.intersect1d(u, v, assume_unique=True))
                    if BOTTOM * common >= TOP * (len(u) + len(v) - common):
                        good.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in good], pa.int64()) for k in (0, 1)], names=["a", "b"])

    size, few = wanted.agg(F.coalesce(F.sum(F.col("n") * F.size("units")), F.lit(0))).first()[0], fits(wanted, BROADCAST_ROWS)
    rounds, parts = _pieces(8 * size, most), []
    for i in range(rounds):
        now = wanted if rounds == 1 else wanted.withColumn("units", F.filter("units", lambda x: F.pmod(F.xxhash64(x, F.lit("round")), F.lit(rounds)) == i)).where(F.size("units") > 0)
        found = _found(told.select(row, F.col(text).cast("binary").alias("text")), now.select(row), row, few)
        known = found.select(row, "text").transform(in_batches, sets, StructType().add(row, "long").add("own", ArrayType(LongType())))
        known = known.join(F.broadcast(now) if few else now.hint("shuffle_hash"), row).select(F.explode("units").alias("unit"), "key", "own")
        asked = dealt.where(_part(rounds, "unit") == i).groupBy("unit").agg(F.collect_list(F.struct("a", "b")).alias("of")).select("unit", F.col("of.a").alias("a"), F.col("of.b").alias("b"))
        both = known.unionByName(asked, allowMissingColumns=True).repartition("unit").sortWithinPartitions("unit", F.col("key").isNull())
        parts.append(written(both.select("unit", "key", "own", "a", "b").transform(in_batches, checked, "a long, b long"), "similar"))
    for done in (wanted, dealt):
        removed(done)
    return _together(parts)


def group_similar(docs: DataFrame, row_col: str, print_col: str, id_col: str = "doc_id", text_col: str = "text", radius: int = 3, width: int = 5, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """docs (without text_col) with the fingerprint in print_col and component_id: the smallest id among the documents that
    chains of similar texts reach.

    Words and short texts are as in simhash.group_near_copies, of which this is the part for similarity: null texts and those
    without words are equal, a null id is never the smallest. row_col numbers the rows; docs is read several times, so it
    should be written.
    """
    kept = [c for c in docs.columns if c not in (text_col, print_col, "component_id")]
    key, n, lead_of, bits, raw, own_row = fresh(docs, "key", "n", "leading", "parities", "raw", "lead")
    *frequent, texts = _frequent(docs, row_col, text_col, width)
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    # At most TOLD shingles, so that each executor may hold them.
    hot = [(int(x), int(-(-m // BLOCK))) for x, m in zip(frequent[0], texts) if m > BLOCK]
    schema = docs.select(*kept).schema.add(print_col, "long").add(key, "long").add(n, "long").add(lead_of, ArrayType(LongType())).add(bits, ArrayType(LongType()))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [shingles(x.as_py() or b"", width) for x in batch.column(len(kept))]
            columns = [
                pa.array([_signed(p) for _, _, p in done], pa.int64()), pa.array([_signed(k) for k, _, _ in done], pa.int64()), pa.array([len(s) for _, s, _ in done], pa.int64()),
                *(pa.array([f(s) for _, s, _ in done], pa.list_(pa.int64())) for f in (lambda s: leading(s, *shared.value), parities)),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *columns], names=schema.names)

    hashed = written(docs.select(*kept, F.col(text_col).cast("binary").alias(raw)).transform(in_batches, made, schema), "shingles")
    distinct = written(hashed.groupBy(F.col(key).alias("key")).agg(F.min(id_col).alias("first"), F.min(row_col).alias(own_row)), "distinct-texts")
    led = hashed.select(row_col, F.col(n).alias("n"), F.col(bits).alias("parities"), F.col(print_col).alias("print"))
    lead = written(distinct.select("key", F.col(own_row).alias(row_col)).join(led.hint("merge"), row_col).select("key", row_col, "n", "parities", "print"), "lead")
    # Leading shingles are kept of one text of each kind; what names the documents is small.
    headed = written(hashed.select(row_col, F.col(n).alias("n"), F.col(key).alias("key"), F.col(lead_of).alias("leading")).join(lead.select(row_col).hint("merge"), row_col, "left_semi").drop(row_col), "leading")
    printed = written(hashed.select(*kept, print_col, key), "printed")
    removed(hashed)
    # A quarter of the bytes of all sets, or more for small tables: what a round of meetings may put on disk. Sets to compare may
    # be as many bytes as all are, each text's once, so that texts are read once.
    total = lead.agg(F.sum("n")).first()[0] or 0
    most, whole = max(ROUND_BYTES, 2 * total), max(ROUND_BYTES, 8 * total)
    rows = headed.agg(F.sum(F.size("leading"))).first()[0] or 0

    # What the forest links: texts of one fingerprint with the first of them, and the first ones of linked fingerprints.
    firsts = written(lead.groupBy("print").agg(F.min("key").alias("first")), "distinct-prints")
    near = near_links(firsts.select("print"), radius, shard_rows)
    of = lambda x: firsts.select(F.col("print").alias(x), F.col("first").alias(f"first_{x}")).hint("merge")
    proposed = near.join(of("a"), "a").join(of("b"), "b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))
    proposed = proposed.unionByName(lead.join(firsts.hint("merge"), "print").select(F.col("first").alias("a"), F.col("key").alias("b"))).where("a != b")
    links = _similar(proposed, lead, docs, row_col, text_col, width, whole)

    # The set join: shingles of few texts at once, those of many texts by broadcast if they are few themselves.
    places = headed.select("n", "key", F.posexplode("leading").alias("place", "shingle"))
    places = places.select("shingle", (F.shiftleft("n", PLACE) + F.col("place")).alias("sized"), "key")
    meet = lambda rows, again: rows.sortWithinPartitions("shingle", "sized", "key").transform(in_batches, lambda it: _meetings(it, again), "a long, b long")
    blocks = F.broadcast(docs.sparkSession.createDataFrame(hot, "shingle long, blocks long")) if hot else None
    rounds, parts = _pieces(PLACE_BYTES * rows, most), []
    for i in range(rounds):
        dealt = places.where(_part(rounds, "shingle") == i)
        if hot:
            dealt = dealt.join(blocks, "shingle", "left").repartition("shingle", F.pmod("key", F.coalesce("blocks", F.lit(1)))).drop("blocks")
        else:
            dealt = dealt.repartition("shingle")
        parts.append(written(meet(dealt, False), "meetings"))
    met = _together(parts)
    known = written(components(links), "roots")
    root = lambda x: known.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")).hint("merge")
    apart = met.where("b IS NOT NULL").distinct().join(root("a"), "a", "left").join(root("b"), "b", "left").where("coalesce(root_a, a) != coalesce(root_b, b)").select("a", "b")
    more = _similar(apart, lead, docs, row_col, text_col, width, whole)
    # Roots stand for what is linked already, so that there are no more old links than texts beside the new ones.
    roots = written(components(known.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)), "roots")
    many = met.where("b IS NULL").select(F.col("a").alias("shingle"))
    if hot:  # a task saw some of their texts only, maybe SMALL or fewer
        many = many.unionByName(blocks.select("shingle")).distinct()
    many = written(many, "many")
    removed(met)
    if shared_by_many := many.count():
        words = FOLDED // 64
        xor = lambda i: reduce(Column.bitwiseXOR, [F.get("parities", F.lit(k)) for k in range(i, SKETCH // 64, words)])
        odd = lead.select("key", *[xor(i).alias(f"bits{i}") for i in range(words)])
        rounds, parts = _pieces(PLACE_BYTES * rows, most), []
        for i in range(rounds):
            often = many.where(_part(rounds, "shingle") == i)
            rest = places.where(_part(rounds, "shingle") == i).join(F.broadcast(often) if shared_by_many <= BROADCAST_SHINGLES else often.hint("merge"), "shingle", "left_semi")
            rest = rest.join(roots.hint("merge"), rest["key"] == roots["node"], "left").select("shingle", "sized", "key", F.coalesce("root", "key").alias("root"))
            rest = written(rest.join(odd.hint("merge"), "key").select("shingle", "sized", "key", "root", *[f"bits{i}" for i in range(words)]), "often-shared")
            # Shingles whose texts are all connected are done; the others' texts go to as many pairs of blocks as they have blocks.
            counts = rest.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts"), F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
            parted = written(counts.select("shingle", "texts", F.ceil(F.col("texts") / BLOCK).alias("blocks")), "parted")
            few = F.broadcast(parted.drop("texts")) if fits(parted, BROADCAST_SHINGLES) else parted.drop("texts").hint("merge")
            dealt = rest.join(few, "shingle")
            dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("own", F.pmod("key", "blocks"))
            pair = F.when(F.col("blocks") == 1, F.col("shingle")).otherwise(F.xxhash64("shingle", F.least("own", "other"), F.greatest("own", "other")))
            dealt = dealt.select(pair.alias("shingle"), *rest.columns[1:])
            turns = _pieces(MET_BYTES * int(parted.agg(F.sum(F.col("texts") * F.col("blocks"))).first()[0] or 0), most)
            parts += [written(meet(dealt.where(_part(turns, "shingle", salt="turn") == k).repartition("shingle"), True), "meetings") for k in range(turns)]
            removed(rest)
            removed(parted)
        more = _similar(_together(parts), lead, docs, row_col, text_col, width, whole)
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    linked = distinct.join(roots.hint("merge"), distinct["key"] == roots["node"], "left").select("key", "first", F.coalesce("root", "key").alias("root"))
    lowest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = linked.join(lowest.hint("merge"), "root").select(F.col("key").alias(key), "component_id")
    return printed.select(*kept, print_col, key).join(named.hint("merge"), key).select(*kept, print_col, "component_id")
