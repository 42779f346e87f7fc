"""Near-duplicate documents by the Jaccard similarity of their word n-gram sets, found by PartEnum signatures.

Method (Arasu, Ganti, Kaushik 2006): sets are put into size bands; within a band the n-gram domain is cut into
``n`` parts by a hash, and the n-grams a set has in one part make one signature. A pair that is similar enough
differs in at most ``k`` n-grams, hence in at most ``k`` parts, and has the same signature in all others.
Signatures of one part are used (the enumeration of single parts), with more parts than ``k + 1``:
a set with ``m`` parts that hold anything shares at least ``m - k`` signatures with each partner. So

* a set with fewer than ``m - k`` signatures that another set also has, has no partner at all;
* ordered from rare to frequent, the first signature a pair shares is among the first ``c - (m - k) + 1`` of the
  ``c`` repeated signatures of either set, so only these are compared. Frequent passages are thus left aside
  without losing a pair, and no signature is capped.

Sets are nodes, so equal sets are one node. Each set is verified against one other through its most shared signature
first, which connects most of a large group. Groups that this leaves unconnected are compared exactly, block of sets
against block, leaving out blocks of one component; no pair is emitted but the links that connect something.

Defined results: words are runs of non-blank characters, A-Z lower-cased; fewer words than ``size`` make one
n-gram; without words a document has no n-grams and no links. Rows with one ID take part one by one and
share the smallest ID of all they reach. A document without an ID can link others, but names no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.arrays import SLICE_BYTES, Words, batch_of, inside, mix, ranges, rolling, signed, slices
from cohortflow.llm.frames import broadcast_if_small, components, few_rows_at_once, join_groups, map_arrow, with_rows, written

SIZE = 5
THRESHOLD = Fraction(3, 4)
# Up to this set size every n-gram is a part of its own.
SINGLE = 64
# Parts of a band per n-gram of its largest set.
DENSITY = 0.42
# Sets in one slice from which a signature counts as very frequent.
FREQUENT = 64
_MANY = 1 << 30
# N-grams in a block of sets that are compared with another block at once.
BLOCK = 100_000


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text, one text after the other, and the border of each."""
    words = Words(texts, lower=True)
    hashes, owner = words.hashes(), words.owner()
    start = inside(words.offsets, size)
    grams, holder = rolling(hashes, size)[start], owner[start]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        whole = [
            rolling(hashes[words.offsets[i] : words.offsets[i + 1]], int(words.counts[i]))[0] for i in short
        ]
        grams = np.concatenate([grams, np.array(whole, np.uint64)])
        holder = np.concatenate([holder, short])
    order = np.argsort(grams)
    # Few texts at a time: places of 16 bits sort by radix.
    small = holder[order].astype(np.uint16) if len(texts) < 1 << 16 else holder[order]
    order = order[np.argsort(small, kind="stable")]
    grams, holder = grams[order], holder[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (holder[1:] != holder[:-1])
    grams, holder = grams[new], holder[new]
    return grams, np.searchsorted(holder, np.arange(len(texts) + 1))


def set_ids(grams: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set: equal sets, equal names."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams ^ np.uint64(0x5851F42D4C957F2D)))])
    total = sums[borders[1:]] - sums[borders[:-1]]
    return signed(mix(total + mix(np.diff(borders).astype(np.uint64))))


def _name_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("node", pa.int64()), ("n_shingles", pa.int64())]
    )
    for batch in slices(batches, "text", SLICE_BYTES // 2):
        grams, borders = shingle_sets(batch.column("text"), size)
        n = np.diff(borders)
        node = pa.array(set_ids(grams, borders), mask=n == 0)
        yield batch_of(schema, batch.column("row"), batch.column("doc_id"), node, n)


def _band(n: np.ndarray) -> np.ndarray:
    """Bands double: sizes 1, 2 to 3, 4 to 7, and so on."""
    return np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)


def signatures(
    grams: np.ndarray, borders: np.ndarray, threshold: Fraction
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signature, owner, band side (0 own, 1 the band below) and the least number shared with a partner."""
    n = np.diff(borders)
    p, q = threshold.numerator, threshold.denominator
    own = _band(n)
    out = [[], [], [], []]
    for side in (0, 1):
        band = own - side
        largest = (1 << np.maximum(band + 1, 0)) - 1
        # The largest partner of this band; for the band below there is one only if it is large enough.
        partner = n * q // p if side == 0 else np.minimum(largest, n)
        fits = (n > 0) & (band >= 0) & ((side == 0) | (largest * q >= p * n))
        # Similar sets of sizes a and b differ in at most (1 - t) / (1 + t) * (a + b) n-grams.
        differ = (n + partner) * (q - p) // (q + p)
        parts = np.where(largest <= SINGLE, 0, np.maximum(np.ceil(DENSITY * largest), largest * 2 * (q - p) // (q + p) + 2))
        parts = parts.astype(np.int64)
        label = mix(band.astype(np.uint64) + np.uint64(1))
        holder = np.repeat(np.arange(len(n)), n)
        filled = np.zeros(len(n), np.int64)
        scrambled = mix(grams)
        # Small sets: each n-gram is a part.
        alone = fits[holder] & (parts[holder] == 0)
        who = holder[alone]
        filled += np.bincount(who, minlength=len(n))
        found = [(mix(mix(scrambled[alone] + np.uint64(1)) + mix(scrambled[alone] + label[who])), who)]
        # Others: the sum of what lies in each part, parts of all sets in one row.
        cut = np.where(fits, parts, 0)
        base = np.concatenate([[0], np.cumsum(cut)])
        shared = cut[holder] > 0
        who = holder[shared]
        part = (scrambled[shared] % cut[who].astype(np.uint64)).astype(np.int64)
        content = np.zeros(base[-1], np.uint64)
        np.add.at(content, base[who] + part, mix(scrambled[shared] + np.uint64(0xA0761D6478BD642F)))
        holds = np.zeros(base[-1], bool)
        holds[base[who] + part] = True
        at = np.flatnonzero(holds)
        who = np.repeat(np.arange(len(n)), cut)[at]
        filled += np.bincount(who, minlength=len(n))
        found.append((mix(content[at] + mix((at - base[who]).astype(np.uint64) + label[who])), who))
        least = filled - differ
        # A set that might share nothing but empty parts names these as well. A partner that shares others need not name
        # them, so one shared signature is all that such a set can ask for.
        for i in np.flatnonzero(fits & (least < 1) & (parts > 0)):
            empty = np.flatnonzero(~holds[base[i] : base[i + 1]]).astype(np.uint64)
            found.append((mix(mix(empty + label[i])), np.full(len(empty), i)))
        least = np.maximum(least, 1)
        for sig, who in found:
            for one, values in zip(out, (sig, who, np.full(len(who), side), least[who])):
                one.append(values)
    return tuple(np.concatenate(one) if one else np.zeros(0, np.int64) for one in out)


# A signature, a set that has it, and twice the least number shared plus the side; FREQUENT_BIT is added for signatures that
# are very frequent in a slice, and -1 marks such a signature itself.
_SIGNATURES = pa.schema([("sig", pa.int64()), ("node", pa.int64()), ("info", pa.int32())])
_FREQUENT_BIT = 1 << 30


def _sign(batches: Iterator[pa.RecordBatch], size: int, threshold: Fraction) -> Iterator[pa.RecordBatch]:
    """Signatures of each set once per slice, sets in a row, and a marker for each very frequent signature."""
    for batch in slices(batches, "text", SLICE_BYTES // 2):
        grams, borders = shingle_sets(batch.column("text"), size)
        node = set_ids(grams, borders)
        keep = np.zeros(len(node), bool)
        keep[np.unique(node, return_index=True)[1]] = True
        n = np.diff(borders)
        chosen = ranges(borders[:-1][keep], n[keep])
        node, grams, borders = node[keep], grams[chosen], np.concatenate([[0], np.cumsum(n[keep])])
        sig, owner, side, least = signatures(grams, borders, threshold)
        if len(sig) == 0:
            continue
        order = np.argsort(owner.astype(np.uint16) if len(node) < 1 << 16 else owner, kind="stable")
        sig, owner, info = signed(sig[order]), owner[order], (least * 2 + side)[order].astype(np.int32)
        ordered = np.sort(sig)
        start = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        often = ordered[start[np.diff(np.append(start, len(ordered))) >= FREQUENT]]
        if len(often):
            at = np.minimum(np.searchsorted(often, sig), len(often) - 1)
            info = np.where(often[at] == sig, info | _FREQUENT_BIT, info).astype(np.int32)
            yield batch_of(_SIGNATURES, often, np.zeros(len(often), np.int64), np.full(len(often), -1, np.int32))
        yield batch_of(_SIGNATURES, sig, node[owner], info)


def _keep_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by ``sig``: distinct sets of signatures that several sets have."""
    schema = pa.schema([("sig", pa.int64()), ("node", pa.int64()), ("least", pa.int32()), ("weight", pa.int32())])
    rest = None

    def settled(sig, node, info):
        if len(sig) == 0:
            return None
        start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        size = np.diff(np.append(start, len(sig)))
        # Most signatures belong to one set; only the others are looked at, and those known to be frequent.
        many = np.repeat(size > 1, size) | (info >= _FREQUENT_BIT)
        sig, node, info = sig[many], node[many], info[many]
        if len(sig) == 0:
            return None
        mark = (info < 0) | (info >= _FREQUENT_BIT)
        order = np.lexsort((info < 0, node, sig))
        sig, node, info, mark = sig[order], node[order], info[order], mark[order]
        new = np.concatenate([[True], sig[1:] != sig[:-1]])
        distinct = new.copy()
        distinct[1:] |= (node[1:] != node[:-1]) | ((info[1:] < 0) != (info[:-1] < 0))
        distinct &= info >= 0
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(sig)))
        count = np.add.reduceat(distinct.astype(np.int64), first)
        frequent = np.logical_or.reduceat(mark, first)
        weight = np.repeat(np.where(frequent, _MANY, count), size)
        keep = distinct & (weight > 1)
        least = info[keep] & ~np.int32(_FREQUENT_BIT)
        return batch_of(schema, sig[keep], node[keep], least, weight[keep].astype(np.int32))

    for batch in batches:
        now = [batch.column(name).to_numpy(zero_copy_only=False) for name in _SIGNATURES.names]
        if rest is not None:
            now = [np.concatenate(two) for two in zip(rest, now)]
        if len(now[0]) == 0:
            continue
        open_from = int(np.searchsorted(now[0], now[0][-1]))
        rest = [one[open_from:] for one in now]
        done = settled(*(one[:open_from] for one in now))
        if done is not None:
            yield done
    if rest is not None:
        done = settled(*rest)
        if done is not None:
            yield done


def _members(rows: DataFrame, size: int, threshold: Fraction) -> DataFrame:
    """``sig, node, weight``: the signatures by which sets must be compared, and how many sets have them."""
    found = map_arrow(rows.select("text"), _sign, "sig bigint, node bigint, info int", size, threshold)
    # Sets of a very frequent signature are dealt by set; its markers go to the partition of the signature.
    place = F.when(F.col("info") >= _FREQUENT_BIT, F.xxhash64("sig", "node")).otherwise(F.col("sig"))
    dealt = found.repartition(place).sortWithinPartitions("sig")
    shared = map_arrow(dealt, _keep_shared, "sig bigint, node bigint, least int, weight int")
    # A frequent signature can reach several partitions, and with it a set can come more than once.
    shared = shared.groupBy("node", "least", "sig").agg(F.max("weight").alias("weight"))
    of_set = Window.partitionBy("node", "least")
    ranked = shared.select(
        "sig",
        "node",
        "weight",
        F.expr("least div 2").alias("needed"),
        F.count("*").over(of_set).alias("found"),
        F.row_number().over(of_set.orderBy("weight", "sig")).alias("place"),
    )
    return ranked.where("found >= needed and place <= found - needed + 1").select("sig", "node", "weight")


def _list_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.int64()), ("grams", pa.list_(pa.int64()))])
    for batch in slices(batches, "text", SLICE_BYTES // 2):
        grams, borders = shingle_sets(batch.column("text"), size)
        lists = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(signed(grams)))
        yield batch_of(schema, pa.array(set_ids(grams, borders)), lists)


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, common, total`` of each pair."""
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
    common = F.size(F.array_intersect("ga", "gb"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", common.alias("common"), (F.size("ga") + F.size("gb")).alias("sizes"))
        .select("a", "b", "common", (F.col("sizes") - F.col("common")).alias("total"))
    )


def _still_open(members: DataFrame, group_of: DataFrame) -> DataFrame:
    """``sig, node, component`` of signature groups whose sets are not yet all connected."""
    placed = members.join(group_of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = placed.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return placed.join(several.where("low <> high"), "sig").select("sig", "node", "component")


def _connected(near: np.ndarray) -> np.ndarray:
    """The smallest row or column number that each row, then each column, of a matrix of links reaches."""
    rows, columns = near.shape
    label = np.arange(rows + columns)
    while True:
        top, side = label[:rows], label[rows:]
        to_top = np.where(near, side[None, :], rows + columns).min(axis=1, initial=rows + columns)
        new_top = np.minimum(top, to_top)
        to_side = np.where(near, new_top[:, None], rows + columns).min(axis=0, initial=rows + columns)
        new = np.concatenate([new_top, np.minimum(side, to_side)])
        if (new == label).all():
            return label
        label = new


def _compare(batches: Iterator[pa.RecordBatch], threshold: Fraction) -> Iterator[pa.RecordBatch]:
    """Links that connect what similar pairs between two blocks connect: at most one per set."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    p, q = threshold.numerator, threshold.denominator
    for batch in batches:
        for k in range(batch.num_rows):
            nodes, grams, sizes = [], [], []
            for side in ("left", "right"):
                members = batch.column(side).slice(k, 1).flatten()
                nodes.append(members.field("node").to_numpy())
                lists = members.field("grams")
                sizes.append(np.diff(np.asarray(lists.offsets).astype(np.int64)))
                grams.append(lists.flatten().to_numpy())
            both, place, n = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
            # Only n-grams that come twice can be common; they are renumbered from 0.
            number = np.cumsum(n > 1) - 1
            width = int((n > 1).sum())
            common = np.zeros((len(nodes[0]), len(nodes[1])), np.float32)
            cut = len(grams[0])
            sides = []
            for found, size in ((place[:cut], sizes[0]), (place[cut:], sizes[1])):
                owner = np.repeat(np.arange(len(size)), size)
                use = n[found] > 1
                sides.append((owner[use], number[found[use]], len(size)))
            for begin in range(0, width, 4096):
                dense = []
                for owner, column, rows in sides:
                    here = (column >= begin) & (column < begin + 4096)
                    block = np.zeros((rows, min(4096, width - begin)), np.float32)
                    block[owner[here], column[here] - begin] = 1
                    dense.append(block)
                common += dense[0] @ dense[1].T
            common = np.rint(common).astype(np.int64)
            near = common * q >= p * (sizes[0][:, None] + sizes[1][None, :] - common)
            label = _connected(near)
            every = np.concatenate(nodes)
            link = label != np.arange(len(label))
            yield batch_of(schema, every[link], every[label[link]])


def _block_links(open_members: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """Links between the sets of open groups, block against block.

    Sets that open groups connect are a cluster. A cluster is dealt into blocks of about ``BLOCK`` n-grams; components
    that fill a block have blocks of their own, which are not compared with each other. The rows that move are pairs of
    blocks, and at most one link per set comes back from each.
    """
    pivot = open_members.groupBy("sig").agg(F.min("node").alias("a"))
    star = open_members.join(pivot, "sig").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    clusters = components(star).withColumnRenamed("component", "cluster")
    # The number of n-grams decides how many blocks there are.
    placed = (
        open_members.select("node", "component")
        .distinct()
        .join(clusters, "node")
        .join(sets.select("node", F.size("grams").alias("n")), "node")
    )
    size = placed.groupBy("cluster", "component").agg(F.sum("n").alias("held"))
    pure = F.when(F.col("held") >= BLOCK, F.col("component"))
    parts = size.select("cluster", "component", pure.alias("pure"), "held")
    whole = parts.groupBy("cluster", "pure").agg(F.ceil(F.sum("held") / BLOCK).alias("blocks"))
    where = parts.alias("p").join(
        whole.alias("w"),
        (F.col("p.cluster") == F.col("w.cluster")) & F.col("p.pure").eqNullSafe(F.col("w.pure")),
    ).select("p.cluster", "p.component", "p.pure", "w.blocks")
    block = F.xxhash64("cluster", "pure", F.pmod(F.xxhash64("node"), F.col("blocks")))
    dealt = placed.join(where, ["cluster", "component"]).select("node", "cluster", "pure", block.alias("block"))
    blocks = written(
        dealt.join(sets, "node")
        .groupBy("cluster", "pure", "block")
        .agg(F.collect_list(F.struct("node", "grams")).alias("members")),
        "blocks",
    )
    names = blocks.select("cluster", "pure", "block")
    other = names.select("cluster", F.col("pure").alias("pure2"), F.col("block").alias("block2"))
    pairs = names.join(other, "cluster").where("block <= block2 and (pure is null or pure2 is null or pure <> pure2)")
    both = (
        pairs.select("block", "block2")
        .join(blocks.select("block", F.col("members").alias("left")), "block")
        .join(blocks.select(F.col("block").alias("block2"), F.col("members").alias("right")), "block2")
    )
    # Pairs of blocks are units of work; they are dealt out evenly.
    spread = both.select("block", "block2", "left", "right").repartition("block", "block2")
    return map_arrow(spread.select("left", "right"), _compare, "a bigint, b bigint", threshold)


def _links(members: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """``node, component``: sets connected by similar pairs that share a signature."""
    # First each set by its most shared signature alone: most of a large group is connected by one pair per set.
    by_weight = Window.partitionBy("node").orderBy(F.desc("weight"), "sig")
    heavy = members.withColumn("place", F.row_number().over(by_weight)).where("place = 1").select("sig", "node")
    pivot = heavy.groupBy("sig").agg(F.min("node").alias("a"))
    pairs = heavy.join(pivot, "sig").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    checked = _verify(pairs, sets)
    similar = threshold.denominator * F.col("common") >= threshold.numerator * F.col("total")
    links = written(checked.where(similar).select("a", "b"), "links")
    group_of = written(components(links), "groups")
    open_members = written(_still_open(members.select("sig", "node"), group_of), "open")
    if open_members.isEmpty():
        return group_of
    with few_rows_at_once(open_members.sparkSession, 4):
        more = written(_block_links(open_members, sets, threshold), "links")
    known = group_of.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    return written(components(known.unionByName(more)), "groups")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = SIZE,
    threshold: Fraction = THRESHOLD,
) -> DataFrame:
    """``row, doc_id, n_shingles, component_id``: one row per document."""
    rows = with_rows(docs, id_column, text_column)
    named = written(
        map_arrow(rows, _name_sets, "row bigint, doc_id bigint, node bigint, n_shingles bigint", size), "sets"
    )
    members = written(_members(rows, size, threshold), "signatures")
    groups = members.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1")
    members = members.join(groups, "sig").select("sig", "node", "weight")
    nodes = members.select("node").distinct()
    holders = named.join(nodes, "node").groupBy("node").agg(F.min("row").alias("row")).select("row")
    texts = rows.join(broadcast_if_small(holders.distinct()), "row").select("text")
    sets = written(map_arrow(texts, _list_sets, "node bigint, grams array<bigint>", size).dropDuplicates(["node"]), "grams")
    group_of = _links(members, sets, threshold)
    whole = named.join(group_of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = whole.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
    smallest = written(smallest, "smallest")
    total = smallest.agg(F.sum("n")).first()[0] or 0
    return join_groups(whole, smallest, "component", total, "left").select(
        "row", "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The documents with their columns, of each component only the one with the smallest ID.

    Repeated rows of that document are repeated copies, so one of them stays. Documents without an ID stay.
    """
    found = near_duplicates(docs, id_column, text_column, **options)
    gone = found.where("doc_id <> component_id").select("row").distinct()
    row = F.xxhash64(F.col(f"whole.`{id_column}`").cast("long"), f"whole.`{text_column}`")
    whole = docs.select(F.struct("*").alias("whole")).withColumn("row", row)
    left = whole.join(broadcast_if_small(gone), "row", "left_anti")
    twice = found.groupBy("row").agg(F.count("*").alias("n")).where("n > 1").select("row")
    again = left.join(broadcast_if_small(twice), "row", "left_semi")
    once = again.groupBy("row").agg(F.first("whole").alias("whole")).select("whole")
    rest = left.join(broadcast_if_small(twice), "row", "left_anti").select("whole")
    return rest.unionByName(once).select("whole.*")
