"""The pipeline over a small table: each stage's decisions hold against the operator alone."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gleanery.llm.common import read


def test_stages(spark):
    docs = read(spark, SF, "documents")
    columns, counts, texts = docs.columns, [docs.count()], None
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        if k == len(corpus_pipeline.STAGES) - 1:
            texts = sorted((r.doc_id, r.text) for r in docs.collect())
        docs = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            docs = docs.cache()
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want, start = [], 0
    for i, t in texts:
        ids = [*library.encode(t, add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in docs.collect()) == want
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == want


def _written(spark, tmp_path, docs, labels, benchmark):
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_null_and_repeated_ids(spark, tmp_path):
    """Rows are judged one by one: no document is lost for its id, and none is kept for it."""
    docs = read(spark, SF, "documents")
    some = docs.orderBy("doc_id").limit(120).withColumn("removed", F.lit("x"))
    nulls = docs.orderBy(F.desc("doc_id")).limit(60).withColumn("doc_id", F.lit(None).cast("long")).withColumn("removed", F.lit("x"))
    same = docs.orderBy(F.crc32(F.col("doc_id").cast("string").cast("binary"))).limit(60).withColumn("doc_id", F.lit(7).cast("long")).withColumn("removed", F.lit("x"))
    odd = spark.createDataFrame([(None, None, None, None, None, "x"), (7, "", "en", "s", 0, "x"), (7, "", "en", "s", 0, "x")], some.schema)
    sf = _written(spark, tmp_path, some.unionByName(nulls).unionByName(same).unionByName(odd), read(spark, SF, "labels"), read(spark, SF, "benchmark"))
    at = read(spark, sf, "documents")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = at.collect()
        after = stage(spark, at, sf)
        assert after.columns == at.columns
        rows = after.collect()
        if k < 3:  # a filter: rows as they were, none more often than before
            assert not Counter(map(str, rows)) - Counter(map(str, before))
        if k == 1:
            texts = {re.sub(r"\s+", " ", r.text or "").strip().lower() for r in before}
            assert len(rows) == len({re.sub(r"\s+", " ", r.text or "").strip().lower() for r in rows}) >= 0.4 * len(texts)
            assert sum(r.doc_id is None for r in rows) > 5 and sum(r.doc_id == 7 for r in rows) > 5
        if k == 3:
            want = sum(r.taken for r in corpus_pipeline_mix(at).collect())
            assert sum(len((r.text or "").split()) for r in rows) == want
        at = spark.createDataFrame(rows, at.schema)
    ids = sorted((str(r.doc_id), r.text or "") for r in at.collect())
    out = corpus_pipeline.run(spark, sf).collect()
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = Counter((i, zlib.crc32(np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes())) for i, t in ids)
    assert Counter((str(r.doc_id), r.ids_crc32) for r in out) == want


def corpus_pipeline_mix(docs):
    from gleanery.llm.mixing import mix

    return mix(docs)


def test_empty_tables(spark, tmp_path):
    sf = _written(spark, tmp_path, *(read(spark, SF, n).limit(0) for n in ("documents", "labels", "benchmark")))
    assert corpus_pipeline.run(spark, sf).count() == 0
