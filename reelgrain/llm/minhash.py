"""Near-duplicate documents by circulant MinHash, bands, and exact Jaccard similarity of shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..session import cut_lineage
from .common import give_back, lowered, mixed, run_hashes, slices, text_buffer, word_bounds, word_hashes

#: 50 bands of 6 coordinates: two sets of similarity 0.8 share no band with probability 3e-7.
BANDS, ROWS = 50, 6
#: A block of documents that meet others in one task: rows and shingles it holds on average at most.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 1 << 20
#: Bits of the map that tells which texts may be needed, at most: 16 MB.
MARKS = 1 << 27
#: Blocks of those with one smallest id at most; beyond that blocks grow, not the visits of a document.
BLOCK_PARTS = 64
#: Classes of shingles that a text's print counts, each up to 255.
CLASSES = 256
#: Rows of a bucket that a task answers for when prints are compared, and parts of a bucket at most.
OWN_ROWS, OWN_PARTS = 4096, 16
_SHORT = 8  # multipliers of run_hashes from here on are for whole short texts


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, one row after the other, and the n + 1 offsets of the rows."""
    raw, offsets = text_buffer(texts)
    raw = lowered(raw)
    starts, ends, rows = word_bounds(raw, offsets)
    hashes = word_hashes(raw, starts, ends)
    runs, at = run_hashes(hashes, rows, words)
    n = len(offsets) - 1
    owner = np.searchsorted(rows, at, side="right") - 1
    sizes = np.diff(rows)
    short = np.flatnonzero((sizes > 0) & (sizes < words))
    whole = [run_hashes(hashes[rows[r]:rows[r + 1]], np.array([0, sizes[r]]), int(sizes[r]), _SHORT + int(sizes[r]))[0] for r in short]
    if len(short):
        runs, owner = np.concatenate([runs, *whole]), np.concatenate([owner, short])
    order = np.lexsort((runs, owner))
    runs, owner = runs[order], owner[order]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (owner[1:] != owner[:-1])
    runs, owner = runs[new], owner[new]
    return runs, np.searchsorted(owner, np.arange(n + 1))


def signature(shingles: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """Circulant MinHash coordinates of a set.

    The first permutation scatters the shingles over 2**32 places; the second orders the places, and is
    shifted circularly by one for each coordinate.
    """
    out = np.full(size, 0xFFFFFFFF, np.uint32)
    places = np.unique((mixed(shingles ^ np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32))
    shifts = np.arange(1, size + 1, dtype=np.uint32)[:, None]
    step = max(1, 200_000 // size)
    for at in range(0, len(places), step):
        x = places[None, at:at + step] + shifts
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        np.minimum(out, x.min(axis=1), out=out)
    return out


def band_keys(sign: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of a signature."""
    bands = sign.reshape(-1, rows).astype(np.uint64)
    keys = np.arange(len(bands), dtype=np.uint64)
    for k in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, k])
    return keys.view(np.int64)


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            shingles, at = shingle_sets(batch.column("text"), words)
            sums = []
            for salt in (0x1234567, 0x7654321):
                total = np.concatenate([[0], np.cumsum(mixed(shingles ^ np.uint64(salt)))]).astype(np.uint64)
                sums.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
            # the first of equal texts with an id in a slice stands for all: the others' bands would be the same
            bands, seen = [], set()
            for r, known in enumerate(batch.column("doc_id").is_valid().to_pylist()):
                key = (sums[0][r], sums[1][r])
                if not known or at[r] == at[r + 1] or key in seen:
                    bands.append(None)
                    continue
                bands.append(band_keys(signature(shingles[at[r]:at[r + 1]])))
                seen.add(key)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("hash"), pa.array(np.diff(at)), pa.array(sums[0]), pa.array(sums[1]),
                 pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "hash", "n_shingles", "key_a", "key_b", "bands"])

    return docs.mapInArrow(run, "doc_id bigint, hash bigint, n_shingles bigint, key_a bigint, key_b bigint, bands array<bigint>")


def _with_twin(rows: DataFrame, multi: DataFrame) -> DataFrame:
    """`twin` tells the texts of one id apart: their hash where an id has several, else 0."""
    mark = multi.withColumn("several", F.lit(True))
    return rows.join(mark, "doc_id", "left").withColumn("twin", F.when(F.col("several"), F.col("hash")).otherwise(F.lit(0))).drop("several", "hash")


def _maybe(wanted: DataFrame, number: int):
    """A function of a text's place that is true for all of the `number` wanted ones and for few others.

    A bitmap of up to MARKS bits: beyond about a tenth as many wanted texts it lets more and more others pass, but never loses one.
    """
    bits = min(MARKS, max(1 << 16, 1 << (16 * number).bit_length()))
    place = F.pmod(F.xxhash64("doc_id", "twin"), F.lit(bits))
    parts = wanted.select(F.shiftright(place, 15).alias("part"), place.bitwiseAND((1 << 15) - 1).alias("bit"))
    marks = np.zeros((bits >> 15, 1 << 12), np.uint8)
    for r in parts.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("marks")).collect():  # at most MARKS / 32,768 rows of 4 kB
        marks[r.part] = np.frombuffer(r.marks, np.uint8)
    shared = wanted.sparkSession.sparkContext.broadcast(marks.ravel())

    @F.arrow_udf("boolean")
    def run(places: pa.Array) -> pa.Array:
        at = places.to_numpy(zero_copy_only=False)
        return pa.array((shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    return run(place)


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """`doc_id, twin, shingles` of the texts whose `doc_id, twin` is wanted, computed from the whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            shingles, at = shingle_sets(batch.column("text"), words)
            sets = pa.ListArray.from_arrays(at.astype(np.int32), shingles.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("twin"), sets], ["doc_id", "twin", "shingles"])

    wanted = cut_lineage(wanted)
    near = docs.where(F.col("doc_id").isNotNull()).where(_maybe(wanted, wanted.count()))
    once = near.join(wanted, ["doc_id", "twin"], "left_semi").dropDuplicates(["doc_id", "twin"])
    return once.mapInArrow(run, "doc_id bigint, twin bigint, shingles array<bigint>")


def _confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have at least `percent` hundredths of their union in common."""
    both = pairs.join(full.toDF("a", "twin_a", "one"), ["a", "twin_a"]).join(full.toDF("b", "twin_b", "two"), ["b", "twin_b"])
    common = F.size(F.array_intersect("one", "two"))
    return both.where(100 * common >= percent * (F.size("one") + F.size("two") - common)).select("a", "b")


def _spanning(ids: np.ndarray, parts: np.ndarray, blocks: np.ndarray, bands: np.ndarray, shingles: np.ndarray, at: np.ndarray,
              percent: int) -> list[tuple[int, int]]:
    """Links that join the components of one pair of blocks as all links between its documents would.

    Compared are documents of different components and, where there are two blocks, of different
    blocks that share a band; two that a link found here has joined already need no other.
    """
    places, codes = np.unique(shingles, return_inverse=True)
    sizes, inside = np.diff(at), np.zeros(len(places), bool)
    several = blocks.min() != blocks.max()
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := top.get(x, x)) != x:
            top[x] = x = top.get(up, up)
        return x

    found = []
    for i in range(len(ids) - 1):
        low, high = np.minimum(sizes[i + 1:], sizes[i]), np.maximum(sizes[i + 1:], sizes[i])
        wanted = (parts[i + 1:] != parts[i]) & (low * 100 >= high * percent)
        if several:
            wanted &= blocks[i + 1:] != blocks[i]
        near = i + 1 + np.flatnonzero(wanted)
        near = near[(bands[near] == bands[i]).any(axis=1)]
        if not len(near):
            continue
        own = codes[at[i]:at[i + 1]]
        inside[own] = True
        for j in near:
            one, two = find(int(parts[i])), find(int(parts[j]))
            if one == two:
                continue
            common = int(np.count_nonzero(inside[codes[at[j]:at[j + 1]]]))
            if 100 * common >= percent * (int(sizes[i] + sizes[j]) - common):
                top[two] = one
                found.append((int(ids[i]), int(ids[j])))
        inside[own] = False
    return found


def _prints(full: DataFrame) -> DataFrame:
    """`rep, twin, print`: how many shingles of each class a set has, one byte a class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, 1024) for whole in batches for at in range(0, whole.num_rows, 1024)):
            lists = batch.column("shingles")
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            place = owner * CLASSES + (lists.flatten().to_numpy() & (CLASSES - 1))
            counts = np.minimum(np.bincount(place, minlength=len(lists) * CLASSES), 255).astype(np.uint8).reshape(-1, CLASSES)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("twin"), pa.array([c.tobytes() for c in counts], pa.binary())],
                                             ["rep", "twin", "print"])

    return full.mapInArrow(run, "rep bigint, twin bigint, print binary")


def _meeting(prints: np.ndarray, sizes: np.ndarray, parts: np.ndarray, own: np.ndarray, percent: int) -> np.ndarray:
    """Which members of a bucket may be similar to a member of another component; pairs without an `own` member are left out.

    Two sets have at most the smaller of both counts of each class in common, so no pair that is similar enough is lost.
    """
    alive, over = np.zeros(len(parts), bool), (prints == 255).any(axis=1)
    names, numbers = np.unique(parts, return_counts=True)
    main = parts == names[numbers.argmax()]
    for i in np.flatnonzero(~main):
        # a pair of others is met once, from its first member
        wanted = (parts != parts[i]) & (own | own[i]) & (np.minimum(sizes, sizes[i]) * 100 >= np.maximum(sizes, sizes[i]) * percent)
        wanted[:i] &= main[:i]
        near = np.flatnonzero(wanted)
        for at in range(0, len(near), 1 << 14):
            some = near[at:at + (1 << 14)]
            common = np.minimum(prints[some], prints[i]).sum(axis=1, dtype=np.int64)
            hits = some[(100 * common >= percent * (sizes[some] + sizes[i] - common)) | over[some] | over[i]]
            alive[hits] = True
            alive[i] |= len(hits) > 0
    return alive & own


def _possible(placed: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The rows of `placed` whose prints allow a link to another component in the bucket.

    A bucket is one task's work, a big one that of up to OWN_PARTS tasks, each of which answers for some rows and meets all: the rows
    grow with the bucket, not with its square.
    """
    pieces = F.least(F.lit(OWN_PARTS), F.ceil(F.col("size") / OWN_ROWS)).cast("int")
    rows = placed.select("band", "rep", "twin", "component", "n_shingles", "first", pieces.alias("pieces"))
    rows = cut_lineage(rows.join(_prints(full), ["rep", "twin"]))
    packs = max(1, rows.count() // 1024)
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep", "twin"), F.col("pieces")) == F.col("piece"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("band", "ascending"), ("piece", "ascending")]).combine_chunks()
        band, piece, parts, sizes = (table.column(c).to_numpy() for c in ("band", "piece", "component", "n_shingles"))
        own = table.column("own").to_numpy()
        prints = np.frombuffer(b"".join(table.column("print").to_pylist()), np.uint8).reshape(-1, CLASSES)
        begin = np.flatnonzero(np.concatenate([[True], (band[1:] != band[:-1]) | (piece[1:] != piece[:-1])]))
        alive = [_meeting(prints[a:b], sizes[a:b], parts[a:b], own[a:b], percent) for a, b in zip(begin, np.append(begin[1:], len(band)), strict=True)]
        out = table.select(["band", "rep", "twin", "component", "n_shingles", "first"]).filter(pa.array(np.concatenate(alive)))
        give_back()
        return out

    pack = F.pmod(F.xxhash64("band", "piece"), F.lit(packs))
    return rows.drop("pieces").groupBy(pack.alias("pack")).applyInArrow(
        run, "band bigint, rep bigint, twin bigint, component bigint, n_shingles bigint, first bigint")


def _across(crowded: DataFrame, sets: DataFrame, groups: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that lie across the components found so far, enough of them to join what belongs together.

    Documents of a bucket that holds several components, and that their prints let link with one of another
    component there, are put in blocks of bounded size, by the smallest id they share a bucket with. Two blocks that share a bucket meet in one task, each of
    their documents once for every block it meets, so no pair of documents becomes a row.
    """
    of = groups.select(F.col("node").alias("rep"), "component")
    placed = crowded.join(of, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    several = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).where("low <> high")
    placed = cut_lineage(_possible(placed.join(several.select("band", "size"), "band"), full, percent))
    # the members of the smallest id's component apart from the others: among themselves they have nothing to compare
    near = placed.groupBy("rep", "twin", "component").agg(F.min("first").alias("home"), F.max("n_shingles").alias("n"))
    main = of.select(F.col("rep").alias("home"), F.col("component").alias("main"))
    near = near.join(main, "home", "left").withColumn("inner", F.col("component") == F.coalesce("main", "home"))
    parts = near.groupBy("home", "inner").agg(
        F.least(F.lit(BLOCK_PARTS), F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES))).alias("parts"))
    number = F.pmod(F.xxhash64("rep", "twin"), F.col("parts"))
    blocks = cut_lineage(near.join(parts, ["home", "inner"]).select(
        "rep", "twin", "component", "n", F.xxhash64("home", "inner", number).alias("block")))
    seats = placed.select("band", "rep", "twin").join(blocks, ["rep", "twin"])
    met = seats.groupBy("band", F.col("block").alias("other")).agg(F.min("component").alias("low"), F.max("component").alias("high"))
    visits = seats.join(met, "band").where("low <> component OR high <> component").select(
        "rep", "twin", "component", "block", "n", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")).distinct()
    visits = cut_lineage(visits)
    here = visits.select("rep", "twin").distinct()
    full = full.withColumnRenamed("doc_id", "rep").join(here, ["rep", "twin"], "left_semi").join(sets.select("rep", "twin", "bands"), ["rep", "twin"])
    packs = max(1, math.ceil((visits.agg(F.sum(F.col("n") + BANDS)).first()[0] or 0) / BLOCK_SHINGLES))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("x", "ascending"), ("y", "ascending"), ("rep", "ascending")]).combine_chunks()
        x, y, ids, parts, blocks = (table.column(c).to_numpy() for c in ("x", "y", "rep", "component", "block"))
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        lists = table.column("shingles").combine_chunks()
        at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        shingles = lists.flatten().to_numpy()
        begin = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
        found = []
        for a, b in zip(begin, np.append(begin[1:], len(x)), strict=True):
            if b - a > 1:
                found += _spanning(ids[a:b], parts[a:b], blocks[a:b], bands[a:b], shingles[at[a]:at[b]], at[a:b + 1] - at[a], percent)
        give_back()
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    rows = visits.drop("n").join(full, ["rep", "twin"]).withColumn("pack", F.pmod(F.xxhash64("x", "y"), F.lit(packs)))
    return cut_lineage(rows.groupBy("pack").applyInArrow(compare, "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` of every row: documents linked by shingle sets of high Jaccard similarity.

    Shingles are runs of `words` words, A to Z in lower case; a shorter text is one shingle of all its words.
    Texts without words, null texts and rows with a null id link with nothing and are kept (the latter
    have no component). Equal sets are linked at once and only one of them goes on. In every band bucket
    all members are compared with the smallest id; then, in buckets that hold several components still, all members of
    different components, block by block inside tasks. Pairs within a component would change
    nothing, so no link between components is lost and no group is expanded into all its pairs. Rows that repeat an id share its component, also
    where their texts differ: then each text is compared, and what it links with is linked to the id. An empty table gives no rows.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    source = source.withColumn("hash", F.xxhash64("text"))
    sketches = cut_lineage(_sketches(source, words))
    keyed = sketches.where("doc_id IS NOT NULL")
    multi = cut_lineage(keyed.groupBy("doc_id").agg(F.min("hash").alias("low"), F.max("hash").alias("high")).where("low <> high").select("doc_id"))
    linkable, source = _with_twin(keyed.where("n_shingles > 0"), multi), _with_twin(source, multi)
    sets = linkable.groupBy("key_a", "key_b", "n_shingles").agg(F.min(F.struct("doc_id", "twin")).alias("own"), F.max("bands").alias("bands"))
    sets = cut_lineage(sets.select("key_a", "key_b", "n_shingles", F.col("own.doc_id").alias("rep"), F.col("own.twin").alias("twin"), "bands"))
    # the sets of one id belong together
    repeated = cut_lineage(keyed.where("n_shingles > 0").join(multi, "doc_id", "left_semi").select("doc_id", "key_a", "key_b", "n_shingles"))
    shared = repeated.join(sets.drop("bands", "twin"), ["key_a", "key_b", "n_shingles"]).where("doc_id <> rep").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    # dealt by band once: counting, and meeting the smallest id, take the same shuffle
    members = sets.select("rep", "twin", "n_shingles", F.explode("bands").alias("band")).repartition("band")
    firsts = members.groupBy("band").agg(F.min(F.struct("rep", "twin")).alias("own"), F.count("*").alias("n")).where("n > 1").select(
        "band", F.col("own.rep").alias("first"), F.col("own.twin").alias("first_twin"))
    crowded = cut_lineage(members.join(firsts, "band"))
    sizes = sets.select(F.col("rep").alias("first"), F.col("twin").alias("first_twin"), F.col("n_shingles").alias("first_n"))
    fits = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent
    stars = crowded.where("rep <> first").select("rep", "twin", "n_shingles", "first", "first_twin").distinct().join(sizes, ["first", "first_twin"])
    stars = cut_lineage(stars.where(fits("n_shingles", "first_n")).select(
        F.col("rep").alias("a"), F.col("twin").alias("twin_a"), F.col("first").alias("b"), F.col("first_twin").alias("twin_b")))
    # the texts of all that shares a bucket move once, for both rounds of comparisons
    full = cut_lineage(_sets(source, crowded.select(F.col("rep").alias("doc_id"), "twin").distinct(), words))
    links = cut_lineage(_confirmed(stars, full, percent).unionByName(shared))
    # components so far; then what lies across them within a bucket
    groups = components(links, "a", "b")
    more = _across(crowded, sets, groups, full, percent)
    groups = components(links.unionByName(more), "a", "b")
    named = sets.select("key_a", "key_b", "n_shingles", "rep").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key_a", "key_b", "n_shingles", F.coalesce("component", "rep").alias("component"))
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    rows = sketches.drop("bands", "hash").withColumn("key_a", F.when(linked, F.col("key_a")))
    out = rows.join(named, ["key_a", "key_b", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
