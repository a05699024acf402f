"""Near duplicates by an exact Jaccard join on word shingles: universe partition and pigeonhole.

Two sets link when ``den * |intersection| >= num * |union|``; then they differ in at most
``H = (den-num) * (|x|+|y|) / (den+num)`` tokens. Sets fall into size bands. In a band a hash
partitions the token universe into H + 1 segments. Every set is indexed by its subset in each
segment, and in the first q segments also by the one-deletion neighbours of the subset. A set looks
for partners with a worth of 0, 1 or 2 per segment: 0 finds nothing, 1 finds equal subsets, 2 (in the
first q) finds subsets that differ in one token at most. As long as its worths add up to H + 1, some
segment finds any partner. Each set needs only the H of its own largest partner in the band, so it
may give up the worth beyond that, and gives up the segments whose index buckets hold most rows:
subsets that are empty, or hold only words that many documents share. The number q follows from the
cost expected in the band: with fewer, sets would meet more than one chance partner each. A set is
indexed in its own band and in those that a larger partner may lie in.

Groups are never expanded into pairs. Documents with the same set are one class. In an index bucket
every class is compared with one centre; what links becomes one component, and a second round does
the same with other centres. Pairs inside a component need no comparison. What is left across the
components of a bucket is compared in one of two ways. Where such pairs are few for the classes that
share a centre, they are listed; parity sketches, whose difference is never more than the sets', rule
most of them out, and the rest are intersected. Where they are many (a large family of copies that
are not all near enough), the family's sets are written as differences from the centre, which are
short, and blocks of the family are compared inside tasks, block by block, so that only links come
out. Both compare whole sets exactly; no link between components is missed.

Sets hold 64-bit token hashes; a class is told by the set's size and two 64-bit sums of them.

Edge cases: a null or blank text has an empty set and links with nothing, its component is its own
id; a text with fewer words than a shingle has its whole sequence as one; repeated rows belong to
one class and are all returned; an empty table gives an empty result. Null ids stay null members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize, mix, runtime_filter, small_batches, text_shingles, unused
from ..operators.joins import measured_size
from .graph import components

#: Upper size of a band over its lower size, about.
BAND_RATIO = 1.5
#: Share of a set's tokens that the cost estimate takes for words many documents share.
COMMON_SHARE = 0.25
#: Pairs across components, per class that shares a centre, up to which they are listed.
LISTED_PAIRS = 12
#: Classes in a block of a family.
BLOCK = 1024
#: Bytes of centres' sets up to which they are broadcast.
CENTRE_BYTES = 32 << 20
#: Rounds with one centre per bucket.
CENTRE_ROUNDS = 2

_SALT = np.uint64(0x2545F4914F6CDD1D)


def band_tops() -> np.ndarray:
    """Largest set size of each band."""
    tops = [1]
    while tops[-1] < 1 << 40:
        tops.append(max(tops[-1] + 1, int(tops[-1] * BAND_RATIO)))
    return np.array(tops, np.int64)


def most_differences(top: int, num: int, den: int) -> int:
    return (den - num) * 2 * top // (den + num)


def set_differences(n: int, top: int, num: int, den: int) -> int:
    """Most tokens that a set of ``n`` differs in from a partner of at most ``top``."""
    return (den - num) * (n + min(top, n * den // num)) // (den + num)


def allocate(top: int, sets: int, num: int, den: int) -> tuple[int, int]:
    """(segments, q) of the band with largest size ``top`` and ``sets`` sets: the least q with which
    a set in the middle of the band is expected to meet at most one partner through a segment
    without words of its own."""
    segments = most_differences(top, num, den) + 1
    if segments == 1:
        return 1, 0
    middle = max(1, int(top / math.sqrt(BAND_RATIO)))
    spare = segments - 1 - set_differences(middle, top, num, den)
    bad = segments * math.exp(-(1 - COMMON_SHARE) * middle / segments)
    term = math.exp(-bad)
    tail, given = 1 - term, 0
    while sets * tail > 1 and given < segments + spare:
        given += 1
        term *= bad / given
        tail = max(0.0, tail - term)
    return segments, max(0, given - spare)


def fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums (as signed numbers) that tell a set."""
    return int(mix(tokens).sum(dtype=np.uint64).astype(np.int64)), int(mix(tokens ^ _SALT).sum(dtype=np.uint64).astype(np.int64))


#: Bits of a label: band, segment, and 1 for a one-deletion neighbour.
_BAND_BITS, _SEGMENT_BITS = 7, 23


def index_keys(tokens: np.ndarray, bands: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of one set in the given (band, segments, q) plans, and their labels."""
    keys, labels = [], []
    spread = mix(tokens)
    for band, segments, double in bands:
        where = ((tokens >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(segments, np.uint64)
        np.add.at(sums, where, spread)
        every = np.arange(segments, dtype=np.int64)
        salt = mix(every.astype(np.uint64) + np.uint64(band << 34))
        keys.append(mix(sums ^ salt))
        labels.append(band << (_SEGMENT_BITS + 1) | every << 1)
        if double:
            inner = where < double
            at = where[inner]
            keys.append(mix((sums[at] - spread[inner]) ^ salt[at]))
            labels.append(band << (_SEGMENT_BITS + 1) | at << 1 | 1)
    return np.concatenate(keys).view(np.int64), np.concatenate(labels).astype(np.int32)


def probing(n: int, labels: np.ndarray, counts: np.ndarray, plans: dict[int, tuple[int, int]], num: int, den: int) -> np.ndarray:
    """With which of its keys in shared buckets a set of ``n`` tokens looks for partners, given the
    bucket sizes and the (segments, q) of the bands.

    Units of worth are ranked by cost: the subset's bucket, and for segments with neighbours a
    second unit of all their buckets. The second goes before the first, so where the first costs
    more, both count half of the sum. The costliest beyond the need are given up.
    """
    keep = np.ones(len(labels), bool)
    bands = labels >> (_SEGMENT_BITS + 1)
    tops = band_tops()
    for band in np.unique(bands).tolist():
        segments, q = plans[band]
        spare = segments + q - 1 - set_differences(n, int(tops[band]), num, den)
        rows = np.flatnonzero(bands == band)
        found, at = np.unique(labels[rows] >> 1, return_inverse=True)
        near = (labels[rows] & 1).astype(bool)
        first, second = np.zeros(len(found)), np.zeros(len(found))
        np.add.at(first, at[~near], counts[rows[~near]])
        np.add.at(second, at[near], counts[rows[near]])
        double = (found & ((1 << _SEGMENT_BITS) - 1)) < q
        both = (first + second) / 2
        units = [(-max(second[i], both[i]), 0, i) for i in np.flatnonzero(double)]
        units += [(-(min(c, both[i]) if double[i] else c), 1, i) for i, c in enumerate(first)]
        for cost, kind, i in sorted(units)[: max(0, spare)]:
            if cost:
                keep[rows[(at == i) & (near == (kind == 0))]] = False
    return keep


def _text_mark(text_col: str) -> Column:
    return F.unhex(F.md5(F.col(text_col)))


def _sets(docs: DataFrame, k: int, id_col: str, text_col: str, marked: bool = False) -> DataFrame:
    """(doc_id, n, node, node2): size of the set and its two sums; ``mark``, a digest of the text, if asked."""
    extra = ["mark"] if marked else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(len(t), *fingerprint(t)) for t in text_shingles(b.column(1), k)]
            cols = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], []))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols, *b.columns[2:]], ["doc_id", "n", "node", "node2", *extra])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[_text_mark(text_col).alias(c) for c in extra])
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n bigint, node bigint, node2 bigint"
    return rows.mapInArrow(run, schema + "".join(f", {c} binary" for c in extra))


def _index(docs: DataFrame, k: int, text_col: str, plans: dict[int, tuple[int, int]], num: int, den: int) -> DataFrame:
    """(key, node, label) of every non-empty set."""
    tops = band_tops()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, found = [], []
            for t in text_shingles(b.column(0), k):
                if len(t):
                    low, high = np.searchsorted(tops, [len(t), len(t) * den // num])
                    nodes.append(fingerprint(t)[0])
                    found.append(index_keys(t, [(i, *plans[i]) for i in range(low, high + 1) if i in plans]))
            if found:
                keys, labels = (np.concatenate(c) for c in zip(*found))
                nodes = np.repeat(np.array(nodes, np.int64), [len(x) for x, _ in found])
                for i in range(0, len(keys), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 50_000]) for c in (keys, nodes, labels)], ["key", "node", "label"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "key bigint, node bigint, label int")


def _probed(shared: DataFrame, sizes: DataFrame, plans: dict[int, tuple[int, int]], num: int, den: int) -> DataFrame:
    """(key, node, probe) from rows (key, node, label, n) of shared buckets and the sizes (node, n)
    of the sets. A node's rows are bounded by the size of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            cuts, flat = lists.offsets.to_numpy(), lists.values
            keys, labels, counts = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            probe = [probing(n, labels[i:j], counts[i:j], plans, num, den) for n, i, j in zip(b.column(1).to_pylist(), cuts, cuts[1:])]
            nodes = np.repeat(b.column(0).to_numpy(), np.diff(cuts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[cuts[0] : cuts[-1]]), pa.array(nodes), pa.array(np.concatenate(probe) if probe else np.zeros(0, bool))], ["key", "node", "probe"]
            )

    per = shared.groupBy("node").agg(F.collect_set(F.struct("key", "label", "n")).alias("rows"))
    rows = per.join(sizes, "node").select("node", "n", "rows").mapInArrow(run, "key bigint, node bigint, probe boolean")
    return rows.groupBy("key", "node").agg(F.max("probe").alias("probe"))


#: Parity bits per token of a set's sketch, at least.
SKETCH_BITS = 4


def parity_sketch(tokens: np.ndarray) -> bytes:
    """The parity of the number of tokens in each of 2^k bins, packed. A token in one of two sets
    only flips one bit, so two sketches (the longer folded) differ in no more bits than the sets
    in tokens."""
    bits = max(64, 1 << int(SKETCH_BITS * len(tokens)).bit_length())
    bins = (mix(tokens ^ _SALT) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(bins, minlength=bits).astype(np.uint8) & 1).tobytes()


def sketch_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the number of tokens that two sets differ in."""
    x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _blobs(docs: DataFrame, k: int, text_col: str) -> DataFrame:
    """(node, n, sketch, tokens): the sorted set as bytes, its size and parity sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = list(text_shingles(b.column(0), k))
            columns = [
                pa.array([fingerprint(t)[0] for t in sets], pa.int64()),
                pa.array([len(t) for t in sets], pa.int64()),
                pa.array([parity_sketch(t) for t in sets], pa.binary()),
                pa.array([t.tobytes() for t in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "sketch", "tokens"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "node bigint, n bigint, sketch binary, tokens binary")


def _near(pairs: DataFrame, blobs: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches do not rule a link out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(c.to_pylist() for c in batch.columns[2:])):
                close = den * min(n, m) >= num * max(n, m)
                keep.append(close and sketch_difference(x, y) * (den + num) <= (den - num) * (n + m))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    left = blobs.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x"))
    right = blobs.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "x", "y").mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, blobs: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets link: what the sketches leave is intersected whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                few, many = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(many, few), len(many) - 1)
                both = int((many[at] == few).sum())
                keep.append(den * both >= num * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    near = materialize(_near(pairs, blobs, num, den), "jaccard-near")
    wanted = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    blobs = blobs.join(broadcast_if_small(wanted, 2 * near.count()), "node", "left_semi")  # most sets are in no such pair
    left = blobs.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    right = blobs.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    return near.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def _centred(rows: DataFrame, order: Column) -> DataFrame:
    """The rows with one probing centre of their bucket (node, comp) and the bucket's size."""
    centre = F.min(F.when(F.col("probe"), F.struct(order.alias("o"), F.col("node").alias("node"), F.col("comp").alias("comp"))))
    centres = rows.groupBy("key").agg(centre.alias("centre"), F.count("*").alias("n"))
    centres = centres.select("key", F.col("centre.node").alias("centre"), F.col("centre.comp").alias("centre_comp"), "n")
    return rows.join(centres, "key")


def _centre_pairs(centred: DataFrame) -> DataFrame:
    """Pairs of every row's node with the centre of its bucket, where components differ."""
    apart = centred.where("comp != centre_comp")
    return apart.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def _without_centres(centred: DataFrame) -> DataFrame:
    """What is left to compare: a centre was compared with its whole bucket, so its row goes, and
    with it the bucket if one row remains."""
    return centred.where("n > 2 AND node != centre").select("key", "node", "probe")


def _cross_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of a bucket in different components, one of them probing. Only nodes outside the
    bucket's largest component look for partners, so what is produced is what has to be compared."""
    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("n", "comp"))["comp"].alias("largest"))
    minor = rows.join(largest, "key").where("comp != largest").select("key", F.col("node").alias("x"), F.col("comp").alias("cx"), F.col("probe").alias("px"))
    return (
        minor.join(rows, "key")
        .where("cx != comp AND (px OR probe)")
        .select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b"))
        .distinct()
    )


def _open_pairs(rows: DataFrame) -> DataFrame:
    """(key, n, pairs): rows of each bucket and its pairs in different components, one probing."""
    n, idle = F.col("n"), F.col("idle")
    per = rows.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum(F.when(F.col("probe"), 0).otherwise(1)).alias("idle"))
    return per.groupBy("key").agg(
        F.sum(n).alias("n"),
        ((F.sum(n) * F.sum(n) - F.sum(n * n) - F.sum(idle) * F.sum(idle) + F.sum(idle * idle)) / 2).alias("pairs"),
    )


def _families(rows: DataFrame, blobs: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) across the components of families, given their rows (centre, node, comp). Within a block of a family a spanning set of the links is returned."""

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            apart, sizes = [], []
            for x, y in zip(b.column(3), b.column(4)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                apart.append(np.setxor1d(x, y, assume_unique=True).tobytes())
                sizes.append(len(x))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(sizes, pa.int64()), pa.array(apart, pa.binary())], ["centre", "node", "comp", "n", "apart"])

    def compare(group: pa.Table) -> pa.Table:
        minor = group["minor"].to_numpy(zero_copy_only=False).astype(bool)
        nodes, comps, sizes = (group[c].to_numpy() for c in ("node", "comp", "n"))
        apart = [np.frombuffer(x.as_buffer(), np.uint64) for x in group["apart"]]  # not copied: they are most of the group
        m, other = np.flatnonzero(minor), np.flatnonzero(~minor)
        lengths = np.array([len(x) for x in apart])
        # inverted lists of the minor rows' difference tokens
        tokens = np.concatenate([apart[i] for i in m]) if len(m) else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(m)), lengths[m])
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        root = {int(c): int(c) for c in comps}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        links = []
        for i in other:
            low, high = np.searchsorted(tokens, apart[i], "left"), np.searchsorted(tokens, apart[i], "right")
            hits = np.concatenate([owner[a:b] for a, b in zip(low[high > low], high[high > low])]) if (high > low).any() else owner[:0]
            both = np.bincount(hits, minlength=len(m))
            differing = lengths[m] + lengths[i] - 2 * both
            near = differing * (den + num) <= (den - num) * (sizes[m] + sizes[i])
            for j in m[near & (comps[m] != comps[i])]:
                a, b = find(int(comps[i])), find(int(comps[j]))
                if a != b:
                    root[max(a, b)] = min(a, b)
                    links.append((int(nodes[i]), int(nodes[j])))
        return pa.table([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

    left = blobs.join(broadcast_if_small(rows.select("node").distinct(), rows.count()), "node", "left_semi").select("node", F.col("tokens").alias("x"))
    right = blobs.select(F.col("node").alias("centre"), F.col("tokens").alias("y")).join(rows.select("centre").distinct(), "centre", "left_semi")
    right = materialize(right, "jaccard-centres")
    if measured_size(right)[1] <= CENTRE_BYTES:
        right = F.broadcast(right)
    own = rows.join(left, "node").join(right, "centre").select("centre", "node", "comp", "x", "y")
    family = materialize(own.mapInArrow(differ, "centre bigint, node bigint, comp bigint, n bigint, apart binary"), "jaccard-family")
    sizes = family.groupBy("centre", "comp").agg(F.count("*").alias("k")).groupBy("centre").agg(F.sum("k").alias("all"), F.max(F.struct("k", "comp")).alias("largest"))
    plan = materialize(
        sizes.select(
            "centre",
            F.col("largest.comp").alias("largest"),
            F.ceil(F.col("all") / BLOCK).alias("blocks"),
            F.ceil((F.col("all") - F.col("largest.k")) / BLOCK).alias("minor_blocks"),
        ),
        "jaccard-family-blocks",
    )
    dealt = family.join(broadcast_if_small(plan), "centre").withColumn("h", F.xxhash64("node", F.lit(5)))
    one = dealt.where("comp != largest").withColumn("minor_block", F.pmod("h", "minor_blocks"))
    one = one.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).withColumn("minor", F.lit(True))
    two = dealt.withColumn("block", F.pmod("h", "blocks"))
    two = two.withColumn("minor_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("minor_blocks") - 1))).withColumn("minor", F.lit(False))
    columns = ["centre", "block", "minor_block", "minor", "node", "comp", "n", "apart"]
    units = one.select(*columns).unionByName(two.select(*columns))
    return units.groupBy("centre", "block", "minor_block").applyInArrow(compare, "a bigint, b bigint")


def _link_rest(rows: DataFrame, size: int, blobs: DataFrame, compared: DataFrame, num: int, den: int) -> DataFrame:
    """The links across components that are left in the open buckets ``rows``."""
    centres = rows.where("probe").groupBy("key").agg(F.min("node").alias("centre"))
    placed = materialize(rows.join(centres, "key").select("centre", "key", "node", "comp", "probe"), "jaccard-placed", size)
    members = materialize(placed.select("centre", "node", "comp").distinct(), "jaccard-members", size)
    left = _open_pairs(rows).join(centres, "key").groupBy("centre").agg(F.sum("pairs").alias("pairs"))
    large = members.groupBy("centre").agg(F.count("*").alias("n")).join(left, "centre").where(F.least("pairs", F.col("n") * (F.col("n") - 1) / 2) > LISTED_PAIRS * F.col("n")).select("centre")
    large = broadcast_if_small(materialize(large, "jaccard-large", size))
    pairs = _cross_pairs(placed.join(large, "centre", "left_anti").select("key", "node", "comp", "probe")).join(compared, ["a", "b"], "left_anti")
    listed = materialize(_verified(materialize(pairs, "jaccard-pairs"), blobs, num, den), "jaccard-links")
    members = materialize(members.join(large, "centre", "left_semi"), "jaccard-families", size)
    inside = materialize(_families(members, blobs, num, den), "jaccard-links")
    return listed.unionByName(inside)


def _linked(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str, marked: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows' sets (see :func:`_sets`), and of every class of equal non-empty sets
    (node, node2, n, rep, copies, comp): its smallest id, its rows and the component it is in."""
    spark = docs.sparkSession
    small_batches(spark)
    members = materialize(_sets(docs, k, id_col, text_col, marked), "jaccard-sets")
    tops = band_tops()
    classes = materialize(
        members.where("n > 0").groupBy("node", "node2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "jaccard-classes"
    )
    sizes = classes.groupBy(F.floor(F.log(F.col("n").cast("double")) / math.log(1.02)).alias("bin")).agg(F.count("*").alias("sets"), F.max("n").alias("n")).collect()
    filled: dict[int, int] = {}
    for row in sizes:  # at most a few hundred bins of sizes
        low, high = np.searchsorted(tops, [math.floor(1.02 ** row["bin"]), row["n"] * den // num])
        for band in range(max(0, low), high + 1):
            filled[band] = filled.get(band, 0) + row["sets"]
    plans = {band: allocate(int(tops[band]), n, num, den) for band, n in filled.items()}

    entries = materialize(_index(docs, k, text_col, plans, num, den), "jaccard-index")
    shared = materialize(entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "jaccard-shared")
    sizes = classes.groupBy("node").agg(F.max("n").alias("n"))
    with runtime_filter(spark, shared.count()):  # few keys are shared: the others need not be shuffled to find that out
        probed = materialize(_probed(entries.join(shared.where("n > 1"), "key"), sizes, plans, num, den), "jaccard-probed")
    useful = probed.groupBy("key").agg(F.count("*").alias("n"), F.max("probe").alias("some")).where("n > 1 AND some").select("key")
    buckets = materialize(probed.join(useful, "key", "left_semi"), "jaccard-buckets", probed.count())

    wanted = buckets.select("node").distinct()
    ids = materialize(classes.join(wanted, "node", "left_semi").select(F.col("rep").alias("_id")), "jaccard-wanted")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.join(broadcast_if_small(ids), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    blobs = materialize(_blobs(texts, k, "text").join(broadcast_if_small(wanted, ids.count()), "node", "left_semi"), "jaccard-tokens")
    if blobs.count() > ids.count():  # an id with several texts
        blobs = materialize(blobs.dropDuplicates(["node"]), "jaccard-tokens")

    compared = labels = None
    rest, size = buckets, buckets.count()
    for round_ in range(CENTRE_ROUNDS + 1):
        if labels is None:
            rows = rest.withColumn("comp", F.col("node"))
        else:
            named = rest.join(broadcast_if_small(labels.withColumnRenamed("label", "comp")), "node", "left")
            named = materialize(named.select("key", "node", "probe", F.coalesce("comp", "node").alias("comp")), "jaccard-named", size)
            rows = materialize(named.join(_open_pairs(named).where("pairs > 0").select("key"), "key", "left_semi"), "jaccard-open", size)
            size = rows.count()
            if not size:
                break
        if round_ == CENTRE_ROUNDS:
            found = _link_rest(rows, size, blobs, compared, num, den)
        else:
            centred = materialize(_centred(rows, F.xxhash64("node", F.lit(round_)) if round_ else F.col("node")), "jaccard-centred", size)
            pairs = _centre_pairs(centred)
            if round_:
                pairs = pairs.join(compared, ["a", "b"], "left_anti")
            pairs = materialize(pairs, "jaccard-pairs", size)
            found = materialize(_verified(pairs, blobs, num, den), "jaccard-links")
            compared = pairs if compared is None else compared.unionByName(pairs)
            rest = materialize(_without_centres(centred), "jaccard-left", size)
            size = rest.count()
        labels = components(found, labels=labels)

    named = classes.join(labels.withColumnRenamed("label", "comp"), "node", "left")
    return members, named.select("node", "node2", "n", "rep", "copies", F.coalesce("comp", "node").alias("comp"))


def link_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest id reachable by
    links; its own id for an empty set)."""
    members, named = _linked(docs, k, num, den, id_col, text_col)
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = materialize(named.join(least, "comp").select("node", "node2", "n", "component_id"), "jaccard-named")
    out = members.join(named, ["node", "node2", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (null last), then with
    the smallest digest of its text.

    Rows are found again by id and digest, so rows that share an id, or have none, are settled each
    by its own text. Of rows alike in both one stays.
    """
    members, named = _linked(docs, k, num, den, id_col, text_col, marked=True)
    named = materialize(named, "jaccard-named")
    several = materialize(named.groupBy("comp").agg(F.sum("copies").alias("rows")).where("rows > 1").select("comp"), "jaccard-several")
    linked = materialize(named.join(broadcast_if_small(several), "comp", "left_semi").select("node", "node2", "n", "comp"), "jaccard-linked")
    rows = members.join(broadcast_if_small(linked), ["node", "node2", "n"]).groupBy("comp", "doc_id", "mark").agg(F.count("*").alias("alike"))
    rows = materialize(rows, "jaccard-decisions")
    first = rows.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "mark")).alias("first"))
    first = materialize(first.select("comp", F.col("first.doc_id").alias("first_id"), F.col("first.mark").alias("first_mark")), "jaccard-first")
    stays = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("mark") == F.col("first_mark"))
    settled = rows.join(broadcast_if_small(first), "comp").where(~stays | (F.col("alike") > 1))

    key, mark, own = (unused(docs, n) for n in ("_id", "_mark", "_own"))
    settled = materialize(settled.select(F.col("doc_id").alias(key), F.col("mark").alias(mark), stays.alias("stays")), "jaccard-dropped")
    same = F.col(id_col).eqNullSafe(F.col(key)) & (_text_mark(text_col) == F.col(mark))
    rest = docs.join(broadcast_if_small(settled.select(key, mark)), same, "left_anti")
    alike = settled.where("stays").select(key, mark)
    if alike.isEmpty():
        return rest
    one = docs.join(broadcast_if_small(alike), same, "left_semi").withColumn(own, _text_mark(text_col)).dropDuplicates([id_col, own]).drop(own)
    return rest.unionByName(one)
