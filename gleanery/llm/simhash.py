"""SimHash near-dedup with pivot distance tables.

Fingerprints of documents are deduplicated first, so copies of a text cost one row, a node. The
pivot table is made once, with a row for each node: its Hamming distances to reference fingerprints
(the pivots). A key table brings together nodes that may be near, each with its row of the table.
Within a key, nodes are ordered by their first coordinate, and only pairs whose first coordinates
differ by the radius at most are made; by the triangle inequality no others can be near. Pairs whose
rows differ by more in any other coordinate are discarded, and the survivors are verified by their
own distance. Only star edges to the least node of each local group leave a task, and components are
joined up by graph.components.

Keys: for one 64-bit plane and a radius up to 3, sixteen keys of 28 bits that no near pair can
miss (one of four 16-bit blocks is equal, and then one of four 12-bit parts of the rest). For
wider fingerprints and radii, sampled bit keys whose length follows the logarithm of the number of
nodes. Radius and number of keys together reach a stated recall at the similarity, whatever the
length, and the pairs found are verified by the Jaccard similarity of their shingle sets: a spanning
forest of each local group, and where some of it fails, every pair that is still apart. A key with many nodes is cut into tiles, and pairs of tiles go to tasks of
their own.

Defined results: null and empty texts, and texts of white space only, have fingerprint zero and
link to each other; a text with fewer words than a shingle is one shingle; repeated rows share a
class; null ids never name a class unless all its ids are null; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gleanery.llm.common import heavy_keys, spread_join, stored, text_key, whole_row
from gleanery.llm.graph import components

SEED = 42
TILE = 1024  # fingerprints of a key that meet in one task
PAIRS = 1 << 21  # pairs looked at together in a task
BUFFER = 1 << 15  # rows gathered before pairs are made
KEYED = 1 << 15  # rows of a node and a key in a batch
REMEMBERED = 1 << 21  # shingle hashes kept while pairs are verified
N_PIVOTS = 16  # for one plane; fewer for wide fingerprints, whose radius lets pivots discard little
RADIUS_DEVIATIONS = 2.25  # of the distance at the similarity: its radius lies above the mean by these
LIKELY_DEVIATIONS = 1.0  # and the distance at which most pairs are that similar below it by these


def _mix(h: np.ndarray, salt: int) -> np.ndarray:
    """Another 64-bit hash of each hash (the finaliser of SplitMix64)."""
    z = h + np.uint64((0x9E3779B97F4A7C15 * salt) & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The hash of each shingle; none of a text without words."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(tokens) < words:
        return np.array([digest(join(tokens), SEED)], np.uint64)
    return np.fromiter((digest(join(s), SEED) for s in zip(*[tokens[k:] for k in range(words)])), np.uint64, len(tokens) - words + 1)


def fingerprint(text: str | None, words: int = 3, planes: int = 1, distinct: bool = False) -> bytes:
    """Big-endian planes of 64 bits; a bit is set if it's set in over half the shingle hashes, or
    in over half the distinct ones."""
    hashes = shingles(text, words)
    if not len(hashes):
        return bytes(8 * planes)
    if distinct:
        hashes = np.unique(hashes)
    out = []
    for p in range(planes):
        ones = np.zeros(64, np.int64)
        for low in range(0, len(hashes), 1 << 15):
            h = hashes[low : low + (1 << 15)]
            h = _mix(h, p) if p else h
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
        out.append(int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little").to_bytes(8, "big"))
    return b"".join(out)


def fingerprints(docs: DataFrame, words: int, planes: int, id_col: str = "doc_id", text_col: str = "text", distinct: bool = False) -> DataFrame:
    """doc_id, fp (binary), text_key (a hash of the text)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("text_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t.as_py(), words, planes, distinct) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fps, batch.column("text_key")], ["doc_id", "fp", "text_key"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp binary, text_key long")


def _matrix(column: pa.Array, planes: int) -> np.ndarray:
    """Fingerprints as rows of unsigned 64-bit planes."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, ">u8").astype(np.uint64).reshape(-1, planes)


def block_keys(fp: np.ndarray) -> np.ndarray:
    """Sixteen keys each, of which any two fingerprints within distance 3 share at least one."""
    x, keys = fp[:, 0], []
    u = np.uint64
    for a in range(4):
        block = (x >> u(16 * a)) & u(0xFFFF)
        rest = (x & u((1 << (16 * a)) - 1)) | ((x >> u(16 * (a + 1))) << u(16 * a) if a < 3 else u(0))
        keys += [(u(4 * a + b) << u(28)) | (block << u(12)) | ((rest >> u(12 * b)) & u(0xFFF)) for b in range(4)]
    return np.stack(keys, 1)


def sampled_keys(fp: np.ndarray, tables: int, bits: int, seed: int = SEED) -> np.ndarray:
    """`tables` keys of `bits` sampled bits each."""
    rng = np.random.default_rng(seed)
    keys = np.empty((len(fp), tables), np.uint64)
    for t in range(tables):
        at = rng.choice(fp.shape[1] * 64, bits, replace=False)
        key = np.zeros(len(fp), np.uint64)
        for b in at:
            key = (key << np.uint64(1)) | ((fp[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1))
        keys[:, t] = _mix(key, t + 1)
    return keys


def pivots(planes: int, n: int | None = None) -> np.ndarray:
    """Reference fingerprints: fixed pseudo-random bits."""
    n = n or max(1, N_PIVOTS // planes)
    return _mix(np.arange(1, n * planes + 1, dtype=np.uint64), 7).reshape(n, planes)


def pivot_table(fp: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """The Hamming distance of each fingerprint to each reference, by row."""
    return np.stack([np.bitwise_count(fp ^ r).sum(axis=1, dtype=np.int16) for r in reference], 1)


def near_pairs(fp: np.ndarray, i: np.ndarray, j: np.ndarray, table: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) within the radius: first by the largest coordinate difference of their
    pivot distances, then verified."""
    for c in range(table.shape[1]):
        keep = np.abs(table[i, c] - table[j, c]) <= radius
        i, j = i[keep], j[keep]
    keep = np.bitwise_count(fp[i] ^ fp[j]).sum(axis=1, dtype=np.int16) <= radius
    return i[keep], j[keep]


def _near_batches(fp: np.ndarray, group: np.ndarray, side: np.ndarray, mixed: np.ndarray, radius: int, table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For rows sorted by group and first coordinate: the pairs within the radius, some at a time.

    Partners of a row are the later rows of its group whose first coordinate is within the radius;
    where a group pairs two tiles (mixed), those on the other side only."""
    n = len(group)
    place = group * (1 << 16) + table[:, 0]
    ends = np.searchsorted(place, place + radius, side="right")
    partners = ends - np.arange(n) - 1
    total = np.cumsum(partners)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + PAIRS, side="right")))
        count = partners[low:high]
        i = np.repeat(np.arange(low, high), count)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        keep = ~mixed[i] | (side[i] != side[j])
        yield near_pairs(fp, i[keep], j[keep], table[:, 1:], radius)
        low = high


def _linked(fp: np.ndarray, group: np.ndarray, side: np.ndarray, mixed: np.ndarray, radius: int, table: np.ndarray) -> np.ndarray:
    """For rows sorted by group and first coordinate: the index of the least row that each is linked to, in its group."""
    label = np.arange(len(group))
    for i, j in _near_batches(fp, group, side, mixed, radius, table):
        label = _union(label, i, j)
    return label


def _union(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The labels (the least row of each row's class) after the classes of i and j are joined."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        label = label.copy()
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


def _candidates(fp: np.ndarray, group: np.ndarray, side: np.ndarray, mixed: np.ndarray, radius: int, table: np.ndarray, node: np.ndarray, likely: int, root: np.ndarray | None, own: np.ndarray, keys: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs to be verified. Without roots, a spanning forest of the pairs within the radius: those
    within the distance `likely` before others, and of these such with the least nodes, which other keys
    choose as well. With roots, all pairs within the radius whose roots differ, each by the first key
    that both have: a group in which such a pair is apart is never settled, so that one is looked at."""
    every = None if root is None else keys(fp).view(np.int64)
    label = np.arange(len(group)) if root is None else np.unique(root, return_inverse=True)[1]
    for i, j in _near_batches(fp, group, side, mixed, radius, table):
        if root is not None:
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
            for low in range(0, len(i), 1 << 14):
                a, b = i[low : low + (1 << 14)], j[low : low + (1 << 14)]
                first = (every[a] == every[b]).argmax(axis=1)
                here = every[a, first] == own[a]
                yield a[here], b[here]
            continue
        distance = np.bitwise_count(fp[i] ^ fp[j]).sum(axis=1, dtype=np.int16)
        order = np.lexsort((np.maximum(node[i], node[j]), np.minimum(node[i], node[j]), np.where(distance <= likely, 0, distance)))
        a, b = i[order], j[order]
        while True:
            apart = label[a] != label[b]
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            best = np.full(len(label), len(a))
            for side_label in (label[a], label[b]):
                np.minimum.at(best, side_label, np.arange(len(a)))
            pick = np.unique(best[best < len(a)])
            yield a[pick], b[pick]
            label = _union(label, a[pick], b[pick])


def pivot_distances(nodes: DataFrame, planes: int) -> DataFrame:
    """nodes with `pivots`, their rows of the pivot table: two bytes a coordinate."""
    reference = pivots(planes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = pivot_table(_matrix(batch.column("fp"), planes), reference).astype("<i2")
                rows = pa.Array.from_buffers(pa.binary(), len(table), [None, pa.py_buffer(np.arange(0, 2 * table.size + 1, 2 * table.shape[1], dtype=np.int32)), pa.py_buffer(table.tobytes())])
                yield pa.RecordBatch.from_arrays([*batch.columns, rows], [*batch.schema.names, "pivots"])

    return nodes.mapInArrow(run, StructType([*nodes.schema.fields]).add("pivots", "binary"))


def _edges(rows: DataFrame, planes: int, radius: int, likely: int | None = None, keys: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """rows (key, lo, hi, tile, node, fp, pivots), each (key, lo, hi) in one partition and sorted
    -> (a, b), numbers of nodes: stars. With `likely`, (key, lo, hi, a, b): pairs to be verified
    (_candidates; by the column root if there is one)."""
    rooted = "root" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            columns = [table.column(c).to_numpy() for c in ("key", "lo", "hi")]
            change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
            cut = table.num_rows if last else (int(change[-1]) if len(change) else 0)
            held[:] = table.slice(cut).to_batches()
            if cut < 2:
                return
            group = np.zeros(cut, np.int64)
            group[change[change < cut]] = 1
            group = np.cumsum(group)
            sizes = np.bincount(group)[group]
            pick = np.flatnonzero(sizes > 1)
            if not len(pick):
                return
            rows_of = np.frombuffer(b"".join(table.column("pivots").take(pa.array(pick)).to_pylist()), "<i2").reshape(len(pick), -1)
            order = np.lexsort((rows_of[:, 0], group[pick]))
            pick, rows_of = pick[order], rows_of[order]
            fp = _matrix(table.column("fp").take(pa.array(pick)).combine_chunks(), planes)
            node = table.column("node").to_numpy()[pick]
            at = fp, group[pick], table.column("tile").to_numpy()[pick], (columns[1] != columns[2])[pick], radius
            if likely is not None:
                root = table.column("root").to_numpy()[pick] if rooted else None
                for i, j in _candidates(*at, rows_of, node, likely, root, columns[0][pick], keys):
                    if len(i):
                        yield pa.RecordBatch.from_arrays([*[pa.array(c[pick[i]]) for c in columns], pa.array(node[i]), pa.array(node[j])], ["key", "lo", "hi", "a", "b"])
                return
            label = _linked(*at, rows_of)
            own = np.flatnonzero(label != np.arange(len(label)))
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(node[label[own]])], ["a", "b"])

        n = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
                if n >= BUFFER:
                    yield from flush(False)
                    n = sum(b.num_rows for b in held) if held else 0
        if held:
            yield from flush(True)

    return rows.mapInArrow(run, "a long, b long" if likely is None else "key long, lo int, hi int, a long, b long")


def keyed(nodes: DataFrame, planes: int, keys: Callable[[np.ndarray], np.ndarray], carry: bool = True) -> DataFrame:
    """nodes (fp, ...) once for each of their keys, with `key`, or without `carry` the keys alone; at
    most KEYED rows in a batch, as the JVM keeps the buffers of the largest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                part = batch.slice(low, 2048)
                k = keys(_matrix(part.column("fp"), planes))
                rows = max(1, KEYED // k.shape[1])
                for at in range(0, part.num_rows, rows):
                    some, own = part.slice(at, rows), k[at : at + rows]
                    again = pa.array(np.repeat(np.arange(some.num_rows), k.shape[1]))
                    columns = [c.take(again) for c in some.columns] if carry else []
                    yield pa.RecordBatch.from_arrays([pa.array(own.ravel().view(np.int64)), *columns], ["key", *(some.schema.names if carry else [])])

    return nodes.mapInArrow(run, StructType([StructField("key", LongType()), *(nodes.schema.fields if carry else [])]))


def crowded(nodes: DataFrame, planes: int, keys: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(key, n) of the keys with more nodes than a tile; written, so that the planner knows their number."""
    only = keyed(nodes.select("fp"), planes, keys, carry=False)
    return stored(only.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > TILE), "heavy-keys")


def tiled(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """Keyed rows with lo and hi, the pair of tiles in which they meet others, and their own tile."""
    columns = [c for c in rows.columns if c != "key"]
    rows = rows.join(heavy, "key", "left").withColumn("tiles", F.ceil(F.coalesce("n", F.lit(1)) / TILE).cast("int"))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    rows = rows.select("key", "tile", *columns, F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("with"))
    return rows.select("key", F.least("tile", "with").alias("lo"), F.greatest("tile", "with").alias("hi"), "tile", *columns)


def _together(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")


def link_edges(nodes: DataFrame, planes: int, radius: int, keys: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Edges (a, b) that join up all nodes (node, fp, pivots) within the radius that share a key."""
    rows = tiled(keyed(nodes.select("node", "fp", "pivots"), planes, keys), crowded(nodes, planes, keys))
    return _edges(_together(rows), planes, radius)


def verified_edges(docs: DataFrame, nodes: DataFrame, planes: int, radius: int, likely: int, keys: Callable[[np.ndarray], np.ndarray], words: int, similarity: float, text_col: str) -> DataFrame:
    """Edges (a, b) that join up all nodes within the radius that share a key and whose shingle sets
    have at least this Jaccard similarity.

    First a spanning forest of each local group is verified. Where all of it holds, the group is one
    class, and no other pair of it matters. In the groups where some doesn't, all pairs are verified
    that lie in different classes and haven't been yet."""
    heavy = crowded(nodes, planes, keys)
    plain = nodes.select("node", "fp", "pivots")
    first = stored(_edges(_together(tiled(keyed(plain, planes, keys), heavy)), planes, radius, likely).withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")}), "forest-pairs")
    good = stored(similar_edges(docs, nodes, first, words, similarity, text_col), "similar-pairs")
    open_ = stored(first.join(good, ["a", "b"], "left_anti").select("key", "lo", "hi").distinct(), "open-groups")
    if not open_.count():
        return good
    rooted = plain.join(components(good), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = tiled(keyed(stored(rooted.select("node", "fp", "pivots", "root"), "rooted-nodes"), planes, keys), heavy).join(open_, ["key", "lo", "hi"], "left_semi")
    second = _edges(_together(rows), planes, radius, likely, keys).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    second = second.join(first.select("a", "b").distinct(), ["a", "b"], "left_anti")
    return good.unionByName(similar_edges(docs, nodes, second, words, similarity, text_col))


def _flip(similarity: float) -> float:
    """The share of bits in which two shingle sets of this Jaccard similarity and equal size differ;
    sets of unequal size differ in fewer."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def similarity_radius(similarity: float, bits: int, deviations: float = RADIUS_DEVIATIONS) -> int:
    """The distance that pairs of this Jaccard similarity have on average, plus some deviations
    so that pairs just at the threshold are caught."""
    p = _flip(similarity)
    return round(bits * p + deviations * math.sqrt(bits * p * (1 - p)))


def tables_for(similarity: float, planes: int, radius: int, bits: int, recall: float) -> int:
    """Tables of `bits` sampled bits for which a pair at the similarity is within the radius and
    shares a key with probability `recall`, over the binomial distribution of its distance."""
    n, p = planes * 64, _flip(similarity)
    d = np.arange(min(radius, n - bits) + 1)
    log_comb = np.array([math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1) for x in d])
    chance = np.exp(log_comb + d * math.log(p) + (n - d) * math.log1p(-p))
    if chance.sum() <= recall:
        raise ValueError("the radius is too small for this recall")
    share = np.prod([(n - d - k) / (n - k) for k in range(bits)], axis=0)
    reached = lambda t: float((chance * -np.expm1(t * np.log1p(-np.minimum(share, 1 - 1e-15)))).sum()) >= recall
    high = 1
    while not reached(high):
        high *= 2
    low = high // 2
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if reached(middle) else (middle, high)
    return high


def similar_edges(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int, similarity: float, text_col: str) -> DataFrame:
    """The pairs (a, b) of nodes whose shingle sets have at least this Jaccard similarity."""
    pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near-pairs")
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = stored(nodes.join(ends, "node", "left_semi").select("node", F.col("first.text_key").alias("text_key")), "near-nodes")
    texts = docs.select(text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text")).join(wanted, "text_key")
    texts = stored(texts.dropDuplicates(["node"]).select("node", "text"), "near-texts")
    sides = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    sides = sides.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}  # of nodes, as pairs of a node come one after another
        held = 0

        def of(node: int, text: pa.Scalar) -> np.ndarray:
            nonlocal held
            found = sets.get(node)
            if found is None:
                found = np.unique(shingles(text.as_py(), words))
                if held + len(found) > REMEMBERED:
                    sets.clear()
                    held = 0
                sets[node] = found
                held += len(found)
            return found

        for batch in batches:
            like = []
            ends = [batch.column(c).to_pylist() for c in ("a", "b")]
            for k, (a, b) in enumerate(zip(*ends, strict=True)):
                x, y = of(a, batch.column("text_a")[k]), of(b, batch.column("text_b")[k])
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                if not len(small) or len(small) < similarity * len(large) - 1e-9:  # sets of such sizes can't be that alike
                    like.append(False)
                    continue
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                like.append(both > 0 and both + 1e-9 >= similarity * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(like, pa.bool_()))

    return sides.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _classes(docs: DataFrame, words: int, radius: int, planes: int, similarity: float | None, recall: float, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of each row (doc_id, fp, text_key), and the nodes: fp, n (rows), and first,
    the least row (null ids last) of the node's class."""
    exact = similarity is None
    prints = stored(fingerprints(docs, words, planes, id_col, text_col, distinct=not exact), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    # Numbered as they are written: from there on a node is a long.
    nodes = prints.groupBy("fp").agg(F.min(row).alias("first"), F.count("*").alias("n")).withColumn("node", F.monotonically_increasing_id())
    nodes = stored(pivot_distances(nodes, planes), "fingerprint-nodes")
    if exact:
        if planes != 1 or radius > 3:
            raise ValueError("exact keys are for 64 bits and a radius up to 3")
        edges = link_edges(nodes, planes, radius, block_keys)
    else:
        radius = similarity_radius(similarity, planes * 64)
        likely = similarity_radius(similarity, planes * 64, -LIKELY_DEVIATIONS)
        bits = min(60, max(8, math.ceil(math.log2(nodes.count() + 1)) - 1))
        tables = tables_for(similarity, planes, radius, bits, recall)

        def keys(fp: np.ndarray) -> np.ndarray:
            return sampled_keys(fp, tables, bits)

        edges = verified_edges(docs, nodes, planes, radius, likely, keys, words, similarity, text_col)
    rooted = nodes.join(components(edges), "node", "left").select("fp", "first", "n", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return prints, stored(rooted.drop("first").join(least, "root").select("fp", "n", "first"), "classes")


def simhash_classes(docs: DataFrame, words: int = 3, radius: int = 3, planes: int = 1, similarity: float | None = None, recall: float = 0.97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (binary), component_id: the smallest doc_id that links lead to.

    Without `similarity`: links at `radius` or fewer differing bits, and none is missed. With it,
    links between texts whose shingle sets have at least this Jaccard similarity: planes * 64 bits
    of the distinct shingles find the pairs, radius and sampled keys together such that a pair at
    the threshold is found with probability `recall`, and the sets themselves decide.
    """
    prints, classes = _classes(docs, words, radius, planes, similarity, recall, id_col, text_col)
    named = spread_join(prints, classes.select("fp", F.col("first.doc_id").alias("component_id")), "fp", heavy_keys(classes, "fp", "n", prints.count()), F.xxhash64("doc_id"))
    return named.select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, words: int = 5, similarity: float = 0.8, planes: int = 8, recall: float = 0.97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, with its columns: the least by (id, hash of the text), rows
    without an id last. Rows with one id and different texts, or without an id, are documents of
    their own. Of rows equal in id and text one stays: the first by its columns written as JSON."""
    prints, classes = _classes(docs, words, 0, planes, similarity, recall, id_col, text_col)
    named = spread_join(prints, classes.select("fp", "first"), "fp", heavy_keys(classes, "fp", "n", prints.count()), F.xxhash64("doc_id", "text_key"))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    named = stored(named.select("doc_id", "text_key", (row == F.col("first")).alias("stays")), "stays")

    key = text_key(docs[text_col])

    def rows(which: DataFrame, how: str) -> DataFrame:
        which = which.select(F.col("doc_id").alias("gleanery__id"), F.col("text_key").alias("gleanery__key"))
        return docs.join(which, docs[id_col].eqNullSafe(which["gleanery__id"]) & (key == which["gleanery__key"]), how).select(*[docs[c] for c in docs.columns])

    again = stored(named.where("stays").groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1"), "repeated-rows")
    go = named.where("not stays").select("doc_id", "text_key")
    if not again.count():
        return rows(go, "left_anti")
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    one = rows(again, "left_semi").groupBy(id_.alias("gleanery__id"), text_key(text).alias("gleanery__key"))
    one = one.agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), whole_row(docs.columns)).alias("gleanery__row")).select("gleanery__row.*")
    return rows(go.unionByName(again.select("doc_id", "text_key")), "left_anti").unionByName(one)
