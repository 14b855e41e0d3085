"""Token counts, ids and Re-Pair files against the tokenizers library."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gleanery.llm import bpe, repair
from gleanery.llm.token_count import count_tokens, counter

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
VOCABULARY = bpe.Vocabulary(PATH)
PROVEN = bpe.prove_whole_tokens(VOCABULARY)

TEXTS = [
    "", " ", "Hello world", "don't we'LL it's", "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>", "  two  spaces\n\n\nlines \t tabs ", "漢字かな交じり文", "é ՘a ՘", "\U0002b73a new", "\x1c\x1d x\x85y z", "a" * 4000, "¼½ 1２", "x\x00y", "\n a", "a \n", "word,word. 'word' \"q\" (x)", "! !!!!", " <|endoftext|> ",
]


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_proven_strings_are_single_tokens():
    assert len(PROVEN) > 40_000
    some = sorted(PROVEN)[::97]
    assert all(len(ids(s)) == 1 for s in some if VOCABULARY.ids["".join(bpe.byte_letters()[b] for b in s.encode())] and len(bpe._split(s)) == 1)


def test_texts_agree():
    count, encoder = counter(VOCABULARY, PROVEN), bpe.IdEncoder(PATH, remembered=8)
    for t in TEXTS * 2:
        assert count(t) == len(ids(t)), t
        assert np.frombuffer(encoder.encode(t), encoder.kind).tolist() == ids(t), t


FORGETFUL, STEADY = bpe.IdEncoder(PATH, remembered=4), bpe.IdEncoder(PATH, remembered=5000)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sdtlv.,!a1é漢<|>_\u00a0"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text_agrees(text):
    want = ids(text)
    assert counter(VOCABULARY, PROVEN, remembered=4)(text) == len(want)
    for encoder in (FORGETFUL, STEADY):
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" \n\t\r'stl.,(!a1é漢\u00a0\u3000\u2003\u0301\x1c\x00|"), max_size=25), max_size=12))
def test_batches_agree(texts):
    data = [t.encode() for t in texts]
    for encoder in (FORGETFUL, STEADY):
        found, counts = encoder.encode_batch(b"".join(data), np.array([len(d) for d in data], np.int64))
        want = [ids(t) for t in texts]
        assert counts.tolist() == [len(w) for w in want] and found.tolist() == [x for w in want for x in w]


def test_long_merges_agree_with_short_ones():
    rng = np.random.default_rng(0)
    for _ in range(200):
        letters = "".join(rng.choice(list("theandingerouXé"), 40)).replace("é", "Ã©")
        assert VOCABULARY.merge(letters) == VOCABULARY._merge_long(list(letters))


def test_count_query(spark):
    rows = [(k, t, 1) for k, t in enumerate(TEXTS)] + [(None, None, 1), (0, "again", 1), (77, "word " * 60_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(4)
    out = count_tokens(df, PATH).collect()
    want = sorted(str((i, len((t or "").encode()), len(ids(t or "")), len(ids(t or "")) > 512)) for i, t, _ in rows)
    assert sorted(str((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit)) for r in out) == want
    assert count_tokens(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("least", [2, 16])
@pytest.mark.parametrize("base", [300, 70_000])
def test_repair_round_trip(least, base):
    rng = np.random.default_rng(least)
    sizes = np.array([1, 5000, 1, 700, 2, 1])
    data = np.concatenate([np.array([7] * 3000), rng.choice([1, 2, 3, 299], 2000), rng.integers(0, base, sizes.sum() - 5000)])
    s = repair.compress(data, sizes, base, least=least)
    expander = repair.Expander(s.base, s.rules, s.lengths)
    assert (expander.expand(s.symbols) == data).all() and s.n_symbols.sum() == len(s.symbols) < len(data)
    begins = np.concatenate([[0], np.cumsum(s.n_symbols)])
    inside = np.ones(len(s.symbols), bool)
    inside[begins[1:] - 1] = False
    pairs = Counter((int(a), int(b)) for a, b, x in zip(s.symbols, s.symbols[1:], inside, strict=False) if x)
    assert all(n < least or a == b for (a, b), n in pairs.items())  # none is frequent still (aaa has two pairs, one of them usable)
    assert (repair.join_bits(*repair.split_bits(s.symbols)) == s.symbols).all()
    begin = 0
    for n, k in zip(sizes, s.n_symbols, strict=True):  # pairs never cross documents
        assert expander.lengths[s.symbols[begin : begin + k]].sum() == n
        begin += k
    for low, high in ((0, 1), (17, 2900), (2999, 3001), (5000, 5003), (0, len(data))):
        assert (expander.part(s.symbols, low, high) == data[low:high]).all()


def test_files_round_trip(spark, monkeypatch):
    from gleanery.llm.common import scratch_path

    rows = [(50 - k, t) for k, t in enumerate(TEXTS)] + [(None, None), (3, "b tie"), (3, "a tie"), (1000, "long words here " * 30_000)]
    df = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id long, start string").repartition(6)
    path = scratch_path(spark, "shards")
    repair.write_shards(df, path, PATH, shard_ids=200)
    assert spark.read.parquet(path).count() > 3
    out = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in repair.read_shards(spark, path).collect())
    # Rows that repeat an id stand next to each other, in an order of their own.
    want, start = [], 0
    turn = {d: k for k, (_, d) in enumerate(dict.fromkeys((r[1], r[3]) for r in out if r[1] == 3))}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, turn[zlib.crc32(np.array(ids(r[1]) + [0], "<u4").tobytes())] if r[0] == 3 else 0)):
        x = ids(t or "") + [0]
        want.append((start, i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    assert out == want
    for i, t in rows:
        if i != 3:
            x = ids(t or "") + [0]
            assert repair.read_document(spark, path, i) == x
            assert repair.read_document(spark, path, i, 1, 4) == x[1:4]
    with pytest.raises(KeyError):
        repair.read_document(spark, path, -5)
    assert repair.token_output(df.limit(0), PATH).count() == 0


def test_equal_ids_are_divided(spark):
    """A third of all rows without an id, and a third with one id, still fall into many ranges."""
    from gleanery.llm.common import scratch_path

    df = spark.range(3000).selectExpr("case when id % 3 = 0 then null when id % 3 = 1 then 7 else id end as doc_id", "repeat(cast(id % 50 as string), 20) as text")
    path = scratch_path(spark, "shards")
    repair.write_shards(df, path, PATH)
    sizes = [r.n for r in spark.read.parquet(path).selectExpr("size(doc_ids) as n").collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1000
    out = repair.read_shards(spark, path)
    assert out.count() == 3000 and out.select("start").distinct().count() == 3000


def test_shards_are_not_shuffled_to_be_read(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(20)], "doc_id long, text string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for shards of more than that
    try:
        out = repair.token_output(docs, public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/shards")
        assert out.count() == 20
        assert "SortMergeJoin" not in out._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
