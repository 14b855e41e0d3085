"""SimHash against brute force, and the kernel's exactness with hot keys."""

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from gleanery.llm import simhash
from gleanery.llm.graph import components


def plain_fingerprint(text, words=3):
    tokens = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(tokens[k : k + words]) for k in range(len(tokens) - words + 1)] or ([b" ".join(tokens)] if tokens else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def brute_components(ids, fps, radius):
    root = list(range(len(ids)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(ids)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [least.get(find(k)) for k in range(len(ids))]


def corpus(seed=0):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    rows = [(900, None), (901, ""), (902, " \t\n"), (903, "One"), (904, "one"), (905, "one two"), (None, "one two"), (None, "lonely words stand here"), (906, "É é"), (907, "x " * 30_000)]
    for k in range(60):
        words = list(rng.choice(vocabulary, 200))
        for copy in range(5):
            edited = list(words)
            for _ in range(copy):
                edited[rng.integers(200)] = "edit"
            rows.append((k * 10 + copy, " ".join(edited)))
    return rows + rows[:3]


def test_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(t, i, 0, "z") for i, t in rows], "text string, doc_id long, component_id int, fp string").repartition(6)
    out = simhash.simhash_classes(df, words=3, radius=3).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    want = sorted((str(i), format(f, "016x"), str(c)) for (i, _), f, c in zip(rows, fps, brute_components([i for i, _ in rows], fps, 3), strict=True))
    assert sorted((str(r.doc_id), bytes(r.fp).hex(), str(r.component_id)) for r in out) == want


@pytest.mark.parametrize("tile", [4, 1024])
def test_no_link_is_lost_in_hot_keys(spark, monkeypatch, tile):
    """Hundreds of different fingerprints near one centre share most keys."""
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = np.random.default_rng(3)
    fps = {0}
    while len(fps) < 150:
        f = 0
        for b in rng.choice(64, rng.integers(1, 7), replace=False):
            f |= 1 << int(b)
        fps.add(f)
    fps |= {int(x) for x in rng.integers(0, 2**63, 50)}
    fps = sorted(fps)
    nodes = simhash.pivot_distances(spark.createDataFrame([(k, bytearray(f.to_bytes(8, "big"))) for k, f in enumerate(fps)], "node long, fp binary"), 1)
    roots = {r.node: r.root for r in components(simhash.link_edges(nodes, 1, 3, simhash.block_keys)).collect()}
    assert [fps[roots.get(k, k)] for k in range(len(fps))] == brute_components(fps, fps, 3)


def test_block_keys_miss_no_pair():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 2000).astype(np.uint64)
    y = x.copy()
    for k in range(len(y)):
        for b in rng.choice(64, 3, replace=False):
            y[k] ^= np.uint64(1) << np.uint64(b)
    assert (simhash.block_keys(x[:, None]) == simhash.block_keys(y[:, None])).any(axis=1).all()


def test_pivots_discard_only_what_is_far():
    rng = np.random.default_rng(2)
    fp = rng.integers(0, 2**63, 300).astype(np.uint64)[:, None]
    fp[1::2] = fp[::2] ^ np.uint64(0b1011)
    i, j = np.triu_indices(len(fp), 1)
    table = simhash.pivot_table(fp, simhash.pivots(1))
    near = set(zip(*[k.tolist() for k in simhash.near_pairs(fp, i, j, table, 3)], strict=True))
    assert near == {(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True) if (int(fp[a, 0]) ^ int(fp[b, 0])).bit_count() <= 3}
    kept = np.abs(table[i].astype(int) - table[j]).max(axis=1) <= 3
    assert kept.mean() < 0.1  # the tables do the work


def test_first_coordinates_make_the_candidates(monkeypatch):
    """Pairs are made within the radius of the first pivot distance only, and none is lost."""
    rng = np.random.default_rng(4)
    fp = rng.integers(0, 2**63, 400).astype(np.uint64)[:, None]
    fp[1::2] = fp[::2] ^ np.uint64(0b10001)
    table = simhash.pivot_table(fp, simhash.pivots(1)).astype(np.int64)
    order = np.lexsort((table[:, 0], np.zeros(len(fp))))
    fp, table = fp[order], table[order]
    made = []
    inner = simhash.near_pairs
    monkeypatch.setattr(simhash, "near_pairs", lambda f, i, j, *rest: made.append((i, j)) or inner(f, i, j, *rest))
    found = {tuple(sorted(p)) for i, j in simhash._near_batches(fp, np.zeros(len(fp), np.int64), np.zeros(len(fp)), np.zeros(len(fp), bool), 3, table) for p in zip(i.tolist(), j.tolist(), strict=True)}
    assert found == {(a, b) for a in range(len(fp)) for b in range(a + 1, len(fp)) if (int(fp[a, 0]) ^ int(fp[b, 0])).bit_count() <= 3}
    i, j = (np.concatenate(x) for x in zip(*made, strict=True))
    assert len(i) < 0.6 * len(fp) * (len(fp) - 1) / 2 and (np.abs(table[i, 0] - table[j, 0]) <= 3).all()


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 80)] + [(300, 300)]
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {k: 0 for k in range(1, 61)} | {100 + k: 100 for k in range(1, 80)}


def test_edges_of_a_hub_are_dealt_out(spark, monkeypatch):
    from gleanery.llm import common, graph

    monkeypatch.setattr(graph, "heavy_keys", lambda counts, key, n, total: common.heavy_keys(counts, key, n, total, least=10))
    edges = [(50, k) for k in range(300) if k != 50] + [(1000, 1001)]
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {k: 0 for k in range(1, 300)} | {1001: 1000}


def test_near_dedup_keeps_one_of_each_group(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    rows, groups = [], []
    for k in range(40):
        words = list(rng.choice(vocabulary, 300))
        groups.append(k * 10)
        rows.append((k * 10, " ".join(words)))
        for copy in range(1, 4):  # one or two edits: similarity over .93
            edited = list(words)
            for _ in range(copy - 1):
                edited[rng.integers(300)] = "edit"
            rows.append((k * 10 + copy, " ".join(edited)))
        half = words[:150] + list(rng.choice(vocabulary, 150))  # similarity about .33
        groups.append(k * 10 + 9)
        rows.append((k * 10 + 9, " ".join(half)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = simhash.near_dedup(df)
    assert out.columns == ["doc_id", "text"]
    assert sorted(r.doc_id for r in out.collect()) == sorted(groups)


def test_near_dedup_judges_rows_not_ids(spark):
    """Null and repeated ids with different texts, repeated rows, and columns with clashing names."""
    rng = np.random.default_rng(6)
    a, b, c, d = (" ".join(f"{x}{k}" for k in rng.integers(0, 10**6, 60)) for x in "abcd")
    rows = [(2, b, "u", 1), (5, a, "v", 2), (5, b, "w", 3), (9, a, "x", 4), (None, c, "y", 5), (None, c + " more", "z", 6), (None, d, "y", 7), (7, c, "q", 8), (7, c, "p", 9), (7, c, "p", 9), (None, None, "n", 10), (3, " ", "m", 11)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string, n int").repartition(4)
    out = simhash.near_dedup(df)
    assert out.columns == df.columns
    left = sorted((r.n, r.doc_id, r.text) for r in out.collect())
    assert [n for n, *_ in left if n not in (8, 9)] == [1, 2, 7, 11]
    assert [r for r in left if r[0] in (8, 9)] in ([(8, 7, c)], [(9, 7, c)])


def test_similarity_at_its_threshold(spark):
    """Pairs of 400 shingles with a shared beginning, so that their similarity is known."""
    rng = np.random.default_rng(8)
    word = lambda n: [f"v{k}" for k in rng.integers(0, 1 << 40, n)]
    rows, pairs = [], {}
    for shared, n in ((356, 300), (368, 150), (342, 300)):  # similarity .802, .852, .747
        for _ in range(n):
            head = word(shared + 4)
            for _ in range(2):
                rows.append((len(rows), " ".join(head + word(400 - shared))))
            pairs.setdefault(shared, []).append(len(rows) - 1)
    left = {r.doc_id for r in simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    gone = {shared: sum(i not in left for i in ids) / len(ids) for shared, ids in pairs.items()}
    assert gone[356] >= 0.94 and gone[368] >= 0.97 and gone[342] == 0
    assert all(i - 1 in left for ids in pairs.values() for i in ids)


def test_links_of_earlier_batches_hold(monkeypatch):
    batches = [([0, 1, 2, 2], [6, 7, 4, 5]), ([4, 5], [6, 7])]
    monkeypatch.setattr(simhash, "_near_batches", lambda *_: (tuple(np.array(x) for x in b) for b in batches))
    label = simhash._linked(np.zeros((8, 1), np.uint64), np.zeros(8, np.int64), *[None] * 4)
    assert label.tolist() == [0, 0, 0, 3, 0, 0, 0, 0]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_classes(none).count() == 0 and simhash.near_dedup(none).count() == 0


def test_keyed_rows_come_in_small_batches(spark):
    rows = [(k, k.to_bytes(8, "big")) for k in range(3000)]
    nodes = spark.createDataFrame(rows, "node long, fp binary")
    many = lambda fp: fp[:, :1] + np.arange(100, dtype=np.uint64)

    class Nodes:
        schema = nodes.schema
        mapInArrow = staticmethod(lambda run, schema: list(run(iter([pa.RecordBatch.from_pylist([{"node": k, "fp": fp} for k, fp in rows])]))))

    batches = simhash.keyed(Nodes, 1, many)
    assert sum(b.num_rows for b in batches) == 300_000 and max(b.num_rows for b in batches) <= simhash.KEYED
    first = batches[0].slice(250, 1).to_pylist()[0]
    assert first == {"key": 52, "node": 2, "fp": rows[2][1]}
    alone = simhash.keyed(nodes.select("fp"), 1, many, carry=False)
    assert alone.columns == ["key"] and alone.count() == 300_000
