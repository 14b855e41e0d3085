"""Substring dedup by hashing of units.

A text is cut to units: its lines, and within lines its sentences. Each unit is normalised (white
space, ASCII case) and hashed to 128 bits. Over all documents, the occurrence of a digest with
the least (doc_id, hash of the text, offset) is the first; every other one is a repeat. Neighbouring
repeats are a passage; passages of at least `min_words` words are removed, and their offsets in the
original text are kept. Units without a letter or digit belong to no count of words and break no passage.

Digests are counted with partial aggregation and only those that occur twice or more are joined
back; the units of a very common digest are dealt out to many tasks (common.spread_join).

Defined results: null and empty texts have no units; rows equal in id and text are one document,
whose units don't repeat each other, and lose the same passages; rows with one id and different
texts are documents of their own, and so are rows without an id, which rank last; an empty table
gives an empty result; other columns are ignored, but a column `removed` is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanery.llm.common import heavy_keys, spread_join, stored, text_key

MIN_WORDS = 20

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


_END = re.compile(r"[.!?](?= )|\n")
_EDGE = " \t\r\x0b\x0c"


def units(text: str) -> Iterator[tuple[int, int, bytes, int]]:
    """(start, end, digest, words) of each unit; code points, without white space around it."""
    low = 0
    for high, after in chain(((m.start() + (m[0] != "\n"), m.end()) for m in _END.finditer(text)), [(len(text), len(text))]):
        body = text[low:high].strip(_EDGE)
        if body:
            words = body.encode("utf-8", "surrogatepass").lower().split()
            start = high - len(text[low:high].lstrip(_EDGE))
            yield start, start + len(body), hashlib.blake2b(b" ".join(words), digest_size=16).digest(), sum(1 for w in words if _WORD.search(w))
        low = after


def unit_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), text_key(F.col(text_col)).alias("text_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner: list[int] = []
            found: list[tuple[int, int, int, bytes, int]] = []
            for k, text in enumerate(batch.column("text")):
                some = list(units(text.as_py()))
                owner += [k] * len(some)
                found += [(n, *u) for n, u in enumerate(some)]
            if found:
                number, start, end, digest, words = zip(*found, strict=True)
                ids, keys = (batch.column(c).take(pa.array(owner)) for c in ("doc_id", "text_key"))
                yield pa.RecordBatch.from_arrays([ids, keys, pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(digest, pa.binary()), pa.array(words, pa.int32())], ["doc_id", "text_key", "unit", "start", "end", "digest", "words"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_key long, unit int, start long, end long, digest binary, words int")


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each removed passage: doc_id, text_key, start, end, n_units, n_words, first_doc_id, first_start.

    first_doc_id and first_start: where the passage's first unit occurs first. text_key tells rows
    of one id apart.
    """
    found = stored(unit_table(docs, id_col, text_col), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "start")
    groups = found.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("last"), F.count("*").alias("n"))
    groups = stored(groups.where("first <> last").select("digest", "first", "n"), "unit-groups")
    heavy = heavy_keys(groups, "digest", "n", found.count())
    hits = spread_join(found, groups, "digest", heavy, F.xxhash64("text_key", "start")).where(rank != F.col("first"))
    hits = hits.select("doc_id", "text_key", "unit", "start", "end", "words", F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_start")).distinct()
    # Islands of consecutive unit numbers within a document.
    in_doc = Window.partitionBy("doc_id", "text_key").orderBy("unit", "start")
    hits = hits.withColumn("island", F.col("unit") - F.dense_rank().over(in_doc))
    passages = hits.groupBy("doc_id", "text_key", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_units"), F.sum("words").alias("n_words"),
        F.min_by(F.struct("first_doc_id", "first_start"), "start").alias("first"),
    )
    return passages.where(F.col("n_words") >= min_words).select("doc_id", "text_key", "start", "end", "n_units", "n_words", F.col("first.first_doc_id").alias("first_doc_id"), F.col("first.first_start").alias("first_start"))


def remove_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the passages, with `removed`: the original offsets of what went, null if
    nothing did. A column of that name is replaced."""
    spans = passages.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("gleanery__removed"))
    spans = spans.withColumnsRenamed({"doc_id": "gleanery__id", "text_key": "gleanery__key"})
    rows = docs.join(spans, docs[id_col].eqNullSafe(spans["gleanery__id"]) & (text_key(docs[text_col]) == spans["gleanery__key"]), "left")
    rows = rows.withColumn("removed", F.col("gleanery__removed")).drop("gleanery__removed", "gleanery__id", "gleanery__key")
    text = F.col(text_col)
    kept = F.aggregate(
        F.coalesce("removed", F.array().cast("array<struct<start:bigint,end:bigint>>")),
        F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.struct(F.concat(a["text"], F.substring(text, a["at"].cast("int") + 1, (s["start"] - a["at"]).cast("int"))).alias("text"), s["end"].alias("at")),
        lambda a: F.concat(a["text"], F.substring(text, a["at"].cast("int") + 1, F.length(text))),
    )
    return rows.withColumn(text_col, kept)
