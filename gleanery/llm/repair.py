"""Token-ID output in a Re-Pair compressed file format.

Documents are encoded, put in ascending order of their ids, and cut to shards of a bounded number
of token ids. In each shard, frequent pairs of neighbouring ids are repeatedly replaced by
nonterminals, the more frequent before the less, until no pair occurs LEAST times. A shard stores its rules, the length that each rule expands
to, the remaining symbols, and where each document's symbols begin; pairs never cross documents,
so any document can be decoded alone, and by the expansion lengths any stretch of it.

File format: Parquet, a row for each shard, written by Spark to the shared folder, so that it works
on any store that Spark writes to and a lost task is simply run again:
  part, shard      position of the shard
  first            ids in the part before the shard
  doc_ids          ids of its documents, in order
  n_ids            token ids of each document, with the end id
  n_symbols        symbols of each document
  base             number of terminal ids
  rules            pairs of symbols, little-endian unsigned 32-bit; rule k stands for base + k
  lengths          expansion length of each rule, little-endian unsigned 32-bit
  symbols          the low 16 bits of each symbol, little-endian
  high             the bits above them, as planes of one bit a symbol; empty if there are none

Defined results: a null text counts as empty and has the end id only; rows that repeat an id stand
next to each other, ordered by a hash of their text; null ids come first; an empty table gives no shards and
an empty result; other columns are ignored. A document longer than a shard is one shard, whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from gleanery.llm.bpe import id_encoder
from gleanery.llm.common import scratch_path, stored

END = 0  # the id after each document
SHARD_IDS = 1 << 20
PART_BYTES = 32 << 20  # of written ids
TOGETHER = 1 << 20  # bytes of texts encoded in one go; a longer text goes alone, whole
LEAST = 16  # occurrences for which a pair becomes a rule


@dataclass
class Shard:
    base: int
    rules: np.ndarray  # (n, 2)
    lengths: np.ndarray
    symbols: np.ndarray
    n_symbols: np.ndarray  # by document


def compress(ids: np.ndarray, n_ids: np.ndarray, base: int, least: int = LEAST) -> Shard:
    """Re-Pair on ids of documents laid end to end; each has one id at least.

    Each round sorts the pairs together with their places, and ranks those that occur `least` times
    or more by their counts. Of places that overlap, the one of the better rank is replaced. A pair
    that so gets fewer than half its places waits for the next round; the best always goes. A round
    looks only at places whose pair is new or was left over: others have become no more frequent.
    """
    s = ids.astype(np.uint32)
    last = np.zeros(len(s), bool)
    last[np.cumsum(n_ids) - 1] = True
    rules, lengths, n = [], np.ones(base, np.int64), base
    live = np.flatnonzero(~last[:-1]).astype(np.int32 if len(s) < 1 << 31 else np.int64)
    while len(live) >= least:
        wide, deep = np.uint64(n.bit_length()), np.uint64(len(s).bit_length())
        keyed = s[live].astype(np.uint64)
        keyed <<= wide
        keyed |= s[live + 1]
        keyed <<= deep
        keyed |= live.astype(np.uint64)
        keyed.sort()
        at = (keyed & np.uint64((1 << int(deep)) - 1)).astype(live.dtype)
        keyed >>= deep
        edge = np.flatnonzero(np.concatenate([[True], keyed[1:] != keyed[:-1]]))
        count = np.diff(np.append(edge, len(keyed)))
        often = np.flatnonzero(count >= least)
        if not len(often):
            break
        often = often[np.argsort(-count[often], kind="stable")]
        far = np.int32(len(often) + 1)
        ranks = np.full(len(count), far, np.int32)
        ranks[often] = np.arange(1, len(often) + 1, dtype=np.int32)
        rank = np.full(len(s), far, np.int32)  # of the pair that begins at each place
        rank[at] = np.repeat(ranks, count)
        taken = _choose(rank, far)
        uses = np.bincount(rank[taken], minlength=len(often) + 1)[1:]
        kept = 2 * uses >= count[often]
        kept[0] = True
        taken = taken[kept[rank[taken] - 1]]
        fresh = np.cumsum(kept) - 1
        chosen = keyed[edge[often[kept]]]
        left, right = (chosen >> wide).astype(np.int64), (chosen & np.uint64((1 << int(wide)) - 1)).astype(np.int64)
        left_over = rank < far
        left_over[taken] = left_over[taken + 1] = False
        left_over[taken[taken > 0] - 1] = False
        s[taken] = n + fresh[rank[taken] - 1]
        last[taken] = last[taken + 1]
        stay = np.ones(len(s), bool)
        stay[taken + 1] = False
        s, last, left_over = s[stay], last[stay], left_over[stay]
        rules.append(np.stack([left, right], 1).astype(np.uint32))
        lengths = np.concatenate([lengths, lengths[left] + lengths[right]])
        new = s >= n
        left_over[:-1] |= new[1:]
        left_over |= new
        left_over |= last
        left_over ^= last
        n += len(chosen)
        live = np.flatnonzero(left_over[:-1]).astype(live.dtype)
    ends = np.flatnonzero(last)
    return Shard(base, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), lengths[base:].astype(np.uint32), s, np.diff(np.concatenate([[-1], ends])))


def _choose(rank: np.ndarray, far: np.int32) -> np.ndarray:
    """Places that are replaced together: no two are neighbours, and each has the best rank among
    the neighbours that are still free. In a run of one pair, as in aaaa, every second place is as
    good as the first. A rank of `far` is none; the last place has none."""
    rank = np.concatenate([rank, [far]])  # the last element is a neighbour beyond both ends
    same = np.flatnonzero((rank[1:] == rank[:-1]) & (rank[1:] < far)) + 1  # a pair like the one before it
    if len(same):
        start = np.maximum.accumulate(np.where(np.diff(same, prepend=-2) > 1, same, 0))
        rank[same[(same - start) & 1 == 0]] = far
    best = rank[:-1] < rank[1:]
    best[1:] &= rank[1:-1] < rank[:-2]
    chosen, some = best, np.flatnonzero(best)
    at = None
    while len(some):
        rank[some - 1] = rank[some + 1] = far
        rank[-1] = far
        if at is None:
            at = np.flatnonzero((rank[:-1] < far) & ~chosen)
        else:
            at = at[~best]
            at = at[rank[at] < far]
        own = rank[at]
        best = (own < rank[at - 1]) & (own < rank[at + 1])
        some = at[best]
        chosen[some] = True
    return np.flatnonzero(chosen)


class Expander:
    """Decodes symbols of a shard: all rules are expanded once, to a table that is gathered from."""

    def __init__(self, base: int, rules: np.ndarray, lengths: np.ndarray):
        self.lengths = np.concatenate([np.ones(base, np.int64), lengths.astype(np.int64)])
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.flat = np.arange(base, dtype=np.uint32)
        done = base
        while done < base + len(rules):
            # Rules up to the first that refers to one that isn't expanded yet.
            later = np.flatnonzero((rules[done - base :] >= done).any(axis=1))
            high = done + int(later[0]) if len(later) else base + len(rules)
            self.flat = np.concatenate([self.flat, self.expand(rules[done - base : high - base].ravel())])
            done = high

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        size = self.lengths[symbols]
        total = np.cumsum(size)
        shift = self.starts[symbols] - (total - size)
        return self.flat[np.repeat(shift, size) + np.arange(total[-1] if len(total) else 0)]

    def part(self, symbols: np.ndarray, low: int, high: int) -> np.ndarray:
        """Ids low to high of what the symbols expand to, without expanding the others."""
        total = np.cumsum(self.lengths[symbols])
        a, b = np.searchsorted(total, low, side="right"), np.searchsorted(total, high, side="left")
        skipped = int(total[a - 1]) if a else 0
        return self.expand(symbols[a : b + 1])[low - skipped : high - skipped]


FORMAT = "part long, shard int, first long, doc_ids array<{id}>, n_ids array<long>, n_symbols array<long>, base int, rules binary, lengths binary, symbols binary, high binary"


def plan_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a table's size, from file sizes; no rows are read."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def encoded(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END) -> DataFrame:
    """doc_id, tie (a hash of the text), ids: the token ids of each document with the end id, two
    bytes each if the vocabulary allows, else four."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = id_encoder(tokenizer_path)
        for batch in batches:
            low = 0
            sizes = pa.compute.binary_length(batch.column("text")).to_numpy().astype(np.int64)
            total = np.cumsum(sizes)
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + TOGETHER, side="right")))
                data = b"".join([t.as_buffer().to_pybytes() for t in batch.column("text").slice(low, high - low)])
                ids, n = encoder.encode_batch(data, sizes[low:high])
                ends = np.cumsum(n)
                offsets = np.concatenate([[0], ends + np.arange(1, len(n) + 1)]) * encoder.width
                packed = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(np.insert(ids, ends, end))])
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tie"), packed.cast(pa.binary())], ["doc_id", "tie", "ids"])
                low = high

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, tie long, ids binary")


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END, shard_ids: int = SHARD_IDS) -> None:
    """Texts are encoded where they lie, and their ids are dealt out by ranges of the document's id.
    Rows that repeat an id, or have none, are told apart by a hash of their text and the order of
    the written ids, so that however many they are, ranges divide them."""
    spark = docs.sparkSession
    ids = stored(encoded(docs, tokenizer_path, id_col, text_col, end).withColumn("row", F.monotonically_increasing_id()), "ids", "zstd")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-plan_bytes(ids) // PART_BYTES))
    rows = ids.repartitionByRange(parts, "doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "row").drop("tie", "row")
    id_type = rows.schema["doc_id"].dataType
    base = Tokenizer.from_file(tokenizer_path).get_vocab_size()
    kind, width = ("<u2", 2) if base <= 1 << 16 else ("<u4", 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, first = TaskContext.get().partitionId(), 0, 0
        held: list[pa.RecordBatch] = []
        room = 0  # ids held

        def flush() -> pa.RecordBatch:
            nonlocal shard, first, room
            columns = [pa.concat_arrays([b.column(c) for b in held]) for c in ("doc_id", "ids")]
            sizes = (pa.compute.binary_length(columns[1]).to_numpy() // width).astype(np.int64)
            all_ids = np.frombuffer(b"".join([b.column("ids").buffers()[2][slice(*_extent(b.column("ids")))] for b in held]), kind)
            packed = compress(all_ids, sizes, base)
            low, high = split_bits(packed.symbols)
            row = {"part": part, "shard": shard, "first": first, "doc_ids": columns[0].to_pylist(), "n_ids": sizes, "n_symbols": packed.n_symbols, "base": base}
            row |= {"rules": packed.rules.astype("<u4").tobytes(), "lengths": packed.lengths.astype("<u4").tobytes(), "symbols": low, "high": high}
            shard, first, room = shard + 1, first + len(all_ids), 0
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = None
        for batch in batches:
            if schema is None:
                long = pa.list_(pa.int64())
                schema = pa.schema([("part", pa.int64()), ("shard", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(batch.schema.field("doc_id").type)), ("n_ids", long), ("n_symbols", long), ("base", pa.int32()), ("rules", pa.binary()), ("lengths", pa.binary()), ("symbols", pa.binary()), ("high", pa.binary())])
            total = np.cumsum(pa.compute.binary_length(batch.column("ids")).to_numpy().astype(np.int64) // width)
            low = 0
            while low < batch.num_rows:
                before = int(total[low - 1]) if low else 0
                high = int(np.searchsorted(total, before + shard_ids - room, side="right"))
                if high <= low:
                    if room:
                        yield flush()
                        continue
                    high = low + 1  # longer than a shard
                held.append(batch.slice(low, high - low))
                room += int(total[high - 1]) - before
                low = high
        if room:
            yield flush()

    rows.mapInArrow(run, FORMAT.format(id=id_type.simpleString())).write.parquet(path)


def _extent(column: pa.Array) -> tuple[int, int]:
    """Where the values of a binary column lie in its buffer."""
    offsets = np.frombuffer(column.buffers()[1], "<i4" if pa.types.is_binary(column.type) else "<i8")
    return int(offsets[column.offset]), int(offsets[column.offset + len(column)])


def split_bits(symbols: np.ndarray) -> tuple[bytes, bytes]:
    """The low 16 bits of each symbol, and the rest as planes of one bit each."""
    above = symbols >> 16
    planes = [np.packbits((above >> k) & 1).tobytes() for k in range(int(above.max()).bit_length() if len(above) else 0)]
    return symbols.astype("<u2").tobytes(), b"".join(planes)


def join_bits(low: bytes, high: bytes) -> np.ndarray:
    symbols = np.frombuffer(low, "<u2").astype(np.uint32)
    if high:
        planes = np.frombuffer(high, np.uint8).reshape(-1, -(-len(symbols) // 8))
        for k, plane in enumerate(planes):
            symbols |= np.unpackbits(plane, count=len(symbols)).astype(np.uint32) << np.uint32(16 + k)
    return symbols


def _opened(row: dict) -> tuple[Expander, np.ndarray]:
    """The rules and symbols of a shard's row."""
    rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
    return Expander(row["base"], rules, np.frombuffer(row["lengths"], "<u4")), join_bits(row["symbols"], row["high"])


def read_document(spark: SparkSession, path: str, doc_id: object, low: int = 0, high: int | None = None) -> list[int]:
    """Ids low to high (to the end id, if None) of the first document with this id, decoded without
    its neighbours: one shard's row is read, and only the symbols of the stretch are expanded."""
    shards = spark.read.parquet(path).where(F.array_contains("doc_ids", F.lit(doc_id)) if doc_id is not None else F.exists("doc_ids", lambda x: x.isNull()))
    row = shards.orderBy("part", "shard").limit(1).first()
    if row is None:
        raise KeyError(doc_id)
    k = row["doc_ids"].index(doc_id)
    expander, symbols = _opened(row.asDict())
    begin = sum(row["n_symbols"][:k])
    return expander.part(symbols[begin : begin + row["n_symbols"][k]], low, row["n_ids"][k] if high is None else min(high, row["n_ids"][k])).tolist()


def read_shards(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files, decoded from them."""
    shards = spark.read.parquet(path)
    totals = shards.select("part", F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    # One row for each part of PART_BYTES or more: a few bytes for each gigabyte of input.
    starts = totals.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("begins"))
    id_type = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = {c: batch.column(c)[row] for c in batch.schema.names}
                expander, symbols = _opened({c: get[c].as_py() for c in ("base", "rules", "lengths", "symbols", "high")})
                ids = expander.expand(symbols).astype("<u4")
                sizes = get["n_ids"].values.to_numpy()
                ends = np.cumsum(sizes)
                begin = get["begins"].as_py() + get["first"].as_py()
                crc = [zlib.crc32(ids[a:b]) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([get["doc_ids"].values, pa.array(begin + ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # Files are decoded where they lie: unless the few starts are sent to them, the join shuffles the shards.
    return shards.join(F.broadcast(starts), "part").mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer_path: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files, read them back."""
    path = path or scratch_path(docs.sparkSession, "token-shards")
    write_shards(docs, path, tokenizer_path, id_col, text_col)
    return read_shards(docs.sparkSession, path)
