"""Edge cases of single operators, with hand-made rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery import config
from gleanery.functions import image, pixels, text
from gleanery.operators import checks, dedup, filters, reports, scoring, vectors, windows
from gleanery.plans import vector_queries
from gleanery.sources import html, manifest, records

S = config.FilterSettings()


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(("w", "h", "ok"), [(1920, 500, True), (1000, 1080, True), (1919, 1079, False), (2560, 1440, True)])
def test_resolution_needs_one_side(spark, w, h, ok):
    assert (one(spark, filters.resolution_reason(F.lit(w), F.lit(h), S)) is None) == ok


@pytest.mark.parametrize(("size", "reason"), [(102_400, None), (20_971_520, None), (102_399, "File too small"), (20_971_521, "File too large")])
def test_size_is_inclusive(spark, size, reason):
    assert one(spark, filters.size_reason(F.lit(size), S)) == reason


@pytest.mark.parametrize(("w", "h", "ok"), [(1000, 3000, True), (1000, 3001, False), (3000, 1000, True), (1, 1, True)])
def test_aspect_is_folded(spark, w, h, ok):
    assert (one(spark, filters.aspect_reason(F.lit(w), F.lit(h), S)) is None) == ok


@pytest.mark.parametrize(("reason", "bucket"), [(None, "other"), ("Unknown", "other"), ("Resolution too low: 1x1", "resolution"), ("Corrupt or unsupported format", "file_integrity"), ("too much text in image size", "text_detection"), ("Visual match: wp_large_1", "file_size"), ("Exact content match", "duplicate"), ("No valid filepath", "download_failed"), ("odd", "other")])
def test_reason_buckets_keep_their_order(spark, reason, bucket):
    assert one(spark, filters.reason_bucket(F.lit(reason).cast("string"))) == bucket


def test_integrity_by_magic_bytes(spark):
    rows = [(bytearray(b"\xff\xd8\xff\xe0" + bytes(20)), True), (bytearray(b"\x89PNG\r\n\x1a\n" + bytes(9)), True), (bytearray(b"RIFF1234WEBPxx"), True), (bytearray(b"GIF89a" + bytes(9)), False), (bytearray(b""), False), (None, False)]
    df = spark.createDataFrame(rows, "c binary, ok boolean")
    assert all((r[0] is None) == r[1] for r in df.select(filters.integrity_reason(F.col("c")), "ok").collect())


def test_text_coverage_counts_sure_words(spark):
    tokens = F.expr("array(struct(90 conf, 'word' text, 10 width, 10 height), struct(80 conf, 'word' text, 50 width, 50 height), struct(99 conf, 'ab' text, 50 width, 50 height), struct(99 conf, '!!a' text, 50 width, 50 height))")
    assert one(spark, filters.text_coverage(tokens, F.lit(10), F.lit(100))) == pytest.approx(0.1)
    assert one(spark, filters.text_coverage(tokens, F.lit(0), F.lit(100))) == 0


def test_layer_order(spark):
    df = spark.createDataFrame([("a", "u1", "h1"), ("b", "", "h1"), ("c", "u3", "h9"), ("d", "u4", "h1")], "id string, url string, sha256 string")
    seen_urls, seen_ids = spark.createDataFrame([("u1",), ("",)], "url string"), spark.createDataFrame([("c",)], "id string")
    hashes = spark.createDataFrame([("h1", "old", 1), ("h1", "new", 2)], "sha256 string, id string, seq int")
    out = {r.id: (r.reason, r.match_id) for r in dedup.layered_check(df, seen_urls, seen_ids, hashes).collect()}
    assert out == {"a": ("URL already fetched", None), "b": ("Exact content match", "new"), "c": ("ID already processed", None), "d": ("Exact content match", "new")}


def test_register_is_idempotent(spark):
    new = spark.createDataFrame([("h1", "b", 2), ("h2", "c", 3)], "sha256 string, id string, seq int")
    old = spark.createDataFrame([("h1", "a", 1)], "sha256 string, id string, seq int")
    once = dedup.register(old, new, "sha256")
    assert {(r.sha256, r.id) for r in dedup.register(once, new, "sha256").collect()} == {("h1", "b"), ("h2", "c")} == {(r.sha256, r.id) for r in once.collect()}


@pytest.mark.parametrize("radius", [0, 3, 10, 14])
def test_hamming_join_is_the_nested_loop(spark, radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(-(2**63), 2**63, 12)
    rows = [(int(k), int(b) ^ sum(1 << int(x) for x in rng.choice(63, rng.integers(0, 13), replace=False))) for k, b in enumerate(np.repeat(base, 6))]
    df = spark.createDataFrame(rows, "i long, p long")
    got = {(r.id_a, r.id_b): r.distance for r in dedup.hamming_join(df.toDF("id_a", "hash_a"), df.toDF("id_b", "hash_b"), radius).collect()}
    want = {(a, b): d for a, x in rows for b, y in rows if (d := ((x ^ y) & (2**64 - 1)).bit_count()) <= radius}
    assert got == want


def test_first_match_is_not_the_nearest(spark):
    q = spark.createDataFrame([(1, 0)], "id_a long, hash_a long")
    index = spark.createDataFrame([(7, (1 << 9) - 1, 0), (8, 1, 1)], "id_b long, hash_b long, seq long")
    row = dedup.first_match(q, index, 10).first()
    assert (row.match_id, row.distance, row.n_within) == (7, 9, 2)


@pytest.mark.parametrize(("raw", "tier"), [(6.5, "premium"), (6.4999, "standard"), (5.5, "standard"), (4.0, "acceptable"), (3.9999, "low")])
def test_tiers(spark, raw, tier):
    assert one(spark, scoring.tier(F.lit(raw))) == tier


def test_unknown_source_has_default_weights(spark):
    s = config.ScoreSettings()
    score = lambda source: one(spark, scoring.weighted_score(F.lit(source), F.lit(1.0), F.lit(0.0), F.lit(0.0), s))
    assert [score(x) for x in ("REDDIT", "unsplash", "wallpapercat")] == [0.60, 0.40, 0.55]


def test_population_deviation(spark):
    assert one(spark, scoring.confidence([F.lit(0.0), F.lit(1.0), F.lit(0.5)])) == pytest.approx(1 - math.sqrt(1 / 6))


def test_scale_is_detected(spark):
    low = spark.createDataFrame([(0.2,), (0.9,), (None,)], "s double")
    row = scoring.detected_threshold(low, "s", 5.5).first()
    assert (row.threshold, row.n_missing, row.n_below, row.scale) == (0.5, 1, 1, 1.0)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(1.0,), (10.0,), (0.99,), (10.01,), (None,)], "v double")
    bins = {r.bin: r.n for r in reports.histogram(df, F.col("v"), 1.0, 10.0).collect()}
    assert bins[0] == 1 and bins[9] == 1 and sum(bins.values()) == 2 and len(bins) == 10


def test_rolling_rate_is_over_runs(spark):
    df = spark.createDataFrame([("a", k, 10, 10 if k == 0 else 0) for k in range(31)] + [("b", 0, 0, 0)], "key string, run int, candidates long, approved long")
    out = {(r.key, r.run): r for r in windows.rolling_acceptance(df, "key", "run").collect()}
    assert out["a", 29].rolling_rate == round(10 / 300, 4) and out["a", 30].rolling_rate == 0 and out["a", 30].total_approved == 10 and out["b", 0].rate == 0


@pytest.mark.parametrize(("rate", "advice"), [(0.30, "increase"), (0.10, "maintain"), (0.05, "reduce"), (0.0499, "consider_removing")])
def test_bands(spark, rate, advice):
    assert one(spark, windows.recommendation(F.lit(rate))) == advice


def test_next_run(spark):
    rows = [("d1", "d1.json.gz"), ("d2", "d2-2.json.gz"), ("d3", "other.json.gz"), ("d4", "d4-x.json.gz"), ("d4", "d4-12.json.gz")]
    out = {r.base: r.next_name for r in windows.next_run(spark.createDataFrame(rows, "day string, name string"), "name", F.col("day")).collect()}
    assert out == {"d1": "d1-2.json.gz", "d2": "d2-3.json.gz", "d3": "d3.json.gz", "d4": "d4-13.json.gz"}


def test_dark_flag(spark):
    assert [one(spark, image.is_dark(F.lit(m), F.lit(d))) for m, d in ((59.0, 20.1), (60.0, 30.0), (59.0, 20.0))] == [True, False, False]


def test_hue(spark):
    assert one(spark, image.hue(F.lit(math.cos(math.radians(-30.5))), F.lit(math.sin(math.radians(-30.5))))) == 330


def test_symmetry_and_compat(spark):
    grid = F.array(*[F.lit(float(x)) for x in (0, 255, 0, 255)])
    assert one(spark, image.symmetry(grid, 2)) == pytest.approx(math.exp(-(255**2) / 1000))
    assert one(spark, image.symmetry(grid, 2, compat=True)) >= math.exp(-0.255)


def test_dark_bar_at_the_bottom():
    pixels = np.full((800, 20, 3), 200.0)
    assert image.bar_rows(pixels) == 0
    pixels[-50:] = 10
    assert image.bar_rows(pixels) == 50
    pixels[-90:] = 10
    assert image.bar_rows(pixels) == 0


def test_kmeans_orders_by_size():
    points = np.array([[0, 0, 0]] * 30 + [[100, 0, 0]] * 10 + [[0, 100, 0]] * 5 + [[0, 0, 100]] * 3 + [[50, 50, 50]] * 2, float)
    centres, sizes = pixels.kmeans(np.stack([points, points[::-1]]))
    for c, s in zip(centres, sizes, strict=True):
        order = np.argsort(-s)
        assert s[order].tolist() == [30, 10, 5, 3, 2] and np.allclose(c[order][0], 0)


@pytest.mark.parametrize(("x", "q"), [(1.0, 127), (-0.9999, -126), (-2.0, -128), (2.0, 127)])
def test_quantize(spark, x, q):
    assert one(spark, vectors.quantize_int8(F.array(F.lit(x)))) == [q]


def test_base64_packing(spark):
    import base64

    out = one(spark, vectors.pack_base64(F.array(F.lit(-1).cast("tinyint"), F.lit(5).cast("tinyint"))))
    assert base64.b64decode(out) == b"\xff\x05"


def scored(values):
    return F.array(*[F.struct(F.lit(k).alias("place"), F.lit(f"l{k}").alias("label"), F.lit(v).cast("double").alias("score")) for k, v in enumerate(values)])


def test_equal_scores_keep_every_label_then_cut(spark):
    assert [s.label for s in one(spark, vectors.multi_label(scored([0.25] * 5)))] == ["l0", "l1", "l2"]


def test_labels_of_items_without_scores(spark):
    none = scored([None, None])
    assert tuple(one(spark, vectors.category_of(none))) == ("general", [], 0.0)
    assert one(spark, vectors.composition_of(none)) == "balanced" and one(spark, vectors.tags_of(none, {})) == []
    with pytest.raises(ValueError):
        vectors.classify(none, "other")
    some = one(spark, vectors.category_of(scored([0.30, 0.31, 0.295])))
    assert some.category == "l1" and some.subcategories == ["l0"] and some.confidence == pytest.approx(1 / (1 + math.exp(-1) + math.exp(-1.5)))


def test_multi_label_rules(spark):
    """By hand: penalties, mean plus half a deviation, three quarters of the best."""
    values, penalties = [0.30, 0.29, 0.10, 0.05, -0.2], {"l0": 0.65}
    adjusted = [v * penalties.get(f"l{k}", 1.0) for k, v in enumerate(values)]
    cut = np.mean(adjusted) + 0.5 * np.std(adjusted)
    want = sorted((k for k, v in enumerate(adjusted) if v >= cut and v >= 0.75 * max(adjusted)), key=lambda k: -adjusted[k])[:3]
    got = one(spark, vectors.multi_label(scored(values), penalties))
    assert [s.label for s in got] == [f"l{k}" for k in want] and got[0].score == pytest.approx(max(adjusted))


def test_vocabulary_is_checked_before_broadcast(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0])], "i int, v array<double>")
    words = spark.createDataFrame([(k, [1.0, 0.0]) for k in range(3)], "label int, centroid array<double>")
    with pytest.raises(ValueError, match="more than 2"):
        vectors.label_scores(items, words, "i", "v", vocabulary_size=2)


def test_slug_with_number(spark):
    row = one(spark, text.numbered_slug(F.lit("black-panther-3840x2160-2762.png")))
    assert (row.id, row.resolution, row.title) == ("2762", "3840x2160", "Black Panther")


def test_slug_with_stop_words(spark):
    name = F.lit("5823589-2920x1640-desktop-hd-boy-programmer-wallpaper-image.jpg")
    assert (one(spark, text.slug_id(name)), one(spark, text.slug_resolution(name)), one(spark, text.slug_title(name, F.lit("d")))) == ("5823589", "2920x1640", "Boy Programmer")
    assert one(spark, text.slug_title(F.lit("1-hd.jpg"), F.lit("Set"))) == "Set" and one(spark, text.slug_id(F.lit("x"), F.lit("77"))) == "77"


@pytest.mark.parametrize(("url", "kind", "ext"), [("https://h/a.JPG?x=.png", None, ".jpg"), ("https://h.png", None, ".jpg"), ("https://h/a", "image/webp; q=1", ".webp"), ("https://h/a.gif#f", None, ".gif"), ("https://h/a", "text/html", ".jpg")])
def test_extension(spark, url, kind, ext):
    assert one(spark, text.extension(F.lit(url), F.lit(kind).cast("string"))) == ext


def test_keyword_order_and_sub_sources(spark):
    assert tuple(one(spark, text.keyword_category(F.lit("A City by a LAKE")))) == ("nature", ["lake"])
    assert tuple(one(spark, text.keyword_category(F.lit("lake"), F.lit("r/Amoled")))) == ("abstract", ["dark", "amoled"])
    assert tuple(one(spark, text.keyword_category(F.lit("none of them")))) == ("general", [])


def test_post_image_rules(spark):
    none = F.lit(None)
    gallery = F.expr("array(struct('failed' as status, 'x' as u), struct('valid' as status, 'https://p/a?b&amp;c' as u))")
    preview = lambda w, h: F.struct(F.lit("https://p/b.jpg?x&amp;y").alias("url"), F.lit(w).alias("width"), F.lit(h).alias("height"))
    get = lambda u, g=False, p=preview(1, 1): one(spark, text.post_image_url(F.lit(u), F.lit(g), gallery, p))
    assert get("https://x/A.PNG") == "https://x/A.PNG" and get("https://i.redd.it/q") == "https://i.redd.it/q"
    assert get("https://x/g", True) == "https://p/a?b&c" and get("https://imgur.com/AbC1") == "https://i.imgur.com/AbC1.jpg"
    assert get("https://imgur.com/a/AbC1") is None and get("https://x/y", p=preview(1920, 1)) == "https://p/b.jpg?x&y"
    assert none is not None


def test_listing_feed_and_searches(spark):
    import json

    post = {"id": "p1", "score": 60, "author": "a", "url": "https://x/a.jpg", "over_18": False, "is_gallery": False}
    listing = {"data": {"children": [{"data": post}, {"data": post | {"id": "p2", "score": 3}}, {"data": post | {"id": "p3", "over_18": True}}, {"data": post | {"id": "p4", "url": "https://x/no"}}]}}
    df = spark.createDataFrame([(json.dumps(listing),)], "j string").select(F.from_json("j", records.LISTING).alias("r")).select("r.*")
    assert [r.id for r in records.forum_posts(df, 50).collect()] == ["p1"]
    feed = spark.createDataFrame([("<feed><entry><id>t3_1</id><title>T</title><link href='x'/><link rel=\"a\" href=\"https://h/p\"/><author><name>/u/a</name></author><content type='html'>&lt;a href=&quot;https://i.redd.it/z&quot;&gt;&lt;img src=&quot;https://h/a.PNG&quot;&gt;</content></entry><entry><id>t/x</id><content>&lt;a href=&quot;https://i.redd.it/w&quot;&gt;</content></entry><entry><id>n</id><content>none</content></entry></feed>",)], "xml string")
    rows = [tuple(r) for r in records.feed_entries(feed).collect()]
    assert rows == [("t3_1", "T", "https://h/p", "a", "https://h/a.PNG"), ("x", "Untitled", "", "[unknown]", "https://i.redd.it/w")]
    a = spark.createDataFrame([(json.dumps({"results": [{"id": "1", "urls": {"raw": "r"}}, {"id": "1"}]}),)], "j string").select(F.from_json("j", records.PHOTO_SEARCH_A).alias("r")).select("r.*")
    assert [(r.id, r.width) for r in records.photos_a(a).collect()] == [("1", 0)]
    b = spark.createDataFrame([(json.dumps({"photos": [{"id": "1", "src": {"large2x": "l"}}]}),)], "j string").select(F.from_json("j", records.PHOTO_SEARCH_B).alias("r")).select("r.*")
    assert records.photos_b(b).first().photo_url == "l"


def test_local_files(spark, tmp_path):
    (tmp_path / "reddit_earth_12.jpg").write_bytes(b"\xff\xd8\xff1")
    (tmp_path / "pexels_9.png").write_bytes(b"x")
    (tmp_path / "notes.txt").write_bytes(b"x")
    out = {r.id: (r.source, r.sub_source, r.file_size) for r in records.local_files(spark, str(tmp_path)).collect()}
    assert out == {"reddit_earth_12": ("reddit", "earth", 4), "pexels_9": ("pexels", None, 1)}


def test_dom_links_follow_ancestors(spark):
    page = '<div class="Featured row"><a href="/1">x</a><br></div><p><a href="/2">y</a><a>z</a></p>'
    df = spark.createDataFrame([(1, page), (2, None)], "page_id int, html string")
    assert [(r.href, r.skipped) for r in html.dom_links(df).orderBy("position").collect()] == [("/1", True), ("/2", False)]


def test_ranked_and_download_links(spark):
    page = '<img src="/w/full/b"><a class="image_popup_trigger" href="/w/full/a">x</a><img src="/w/full/a">'
    df = spark.createDataFrame([(1, page)], "page_id int, html string")
    out = {r.link: (r.method, r.position) for r in html.ranked_links(df, [r'image_popup_trigger" href="([^"]+)"', r'<img src="([^"]+)"']).collect()}
    assert out == {"/w/full/a": (0, 0), "/w/full/b": (1, 0)}
    page = '<a href="/images/wallpapers/black-cat-3840x2160-27.png">Download</a><a href="/images/wallpapers/x.png">More</a>'
    row = html.download_links(spark.createDataFrame([(1, page)], "page_id int, html string"), "https://h").collect()
    assert [(r.url, r.id, r.title) for r in row] == [("https://h/images/wallpapers/black-cat-3840x2160-27.png", "27", "Black Cat")]


def test_required_field_aliases(spark):
    df = spark.createDataFrame([("a", None), ("", "u"), (None, "")], "r2_url string, url string")
    out = {r.field: r.n_missing for r in checks.missing_fields(df, {"url": [F.col("r2_url"), F.col("url")]}).collect()}
    assert out == {"url": 1}


def test_manifest_leaves_nulls_out_and_reads_both_roots(spark, tmp_path):
    df = spark.createDataFrame([("k1", None), ("k2", "Unknown")], "id string, artist string")
    entry = manifest.compact_entry(F.col("id"), F.lit("t"), F.lit("c"), F.lit("s"), F.lit(1), F.lit(4), F.lit(2), F.lit(3), F.lit(0.5), F.lit("low"), F.lit(1.0), url=F.lit(""), artist=F.col("artist"))
    manifest.write_entries(df.select(entry.alias("e")), "e", str(tmp_path / "m"))
    assert sorted(r.id for r in manifest.read_entries(spark, str(tmp_path / "m"), "id string, ar double").collect()) == ["k1", "k2"]
    text_rows = [r.value for r in spark.read.text(str(tmp_path / "m")).collect()]
    assert all('"url"' not in t and '"art"' not in t for t in text_rows)
    (tmp_path / "list.json").write_text('[{"id": "a"}, {"id": "b"}]')
    (tmp_path / "wrapped.json").write_text('{"version": "1", "wallpapers": [{"id": "c"}]}')
    assert sorted(r.id for r in manifest.read_collection(spark, str(tmp_path / "*.json"), "id string").collect()) == ["a", "b", "c"]
    assert '"count":2' in manifest.envelope(df.select(entry.alias("e")), "e", "2024-01-01").first().value
    with pytest.raises(ValueError, match="at most"):
        manifest.envelope(df.select(entry.alias("e")), "e", "d", limit=1)


def test_accounting(spark):
    df = spark.createDataFrame([(True, False, 0.5)] * 18 + [(False, True, 0.1)] * 428, "ok boolean, t boolean, s double")
    row = reports.run_report(df, F.col("ok"), F.col("t"), F.col("s")).first()
    assert (row.total, row.rejected, row.unaccounted, row.approval_pct) == (446, 428, 0, 4.04)


def test_config():
    assert [config.typed(x) for x in ("1", "0.90", "x", "off", "17")] == [True, 0.9, "x", False, 17]
    assert config.expand("${A}/${B}", {"A": "1"}) == "1/${B}"
    assert config.lookup({"a": {"b": 2}}, "a.b") == 2 and config.lookup({"a": 1}, "a.b", "d") == "d"
    s = config.from_env(env={"GLEANERY_FILTERS_MIN_WIDTH": "2560", "GLEANERY_SCORES_TEMPERATURE": "0.1"})
    assert s.filters.min_width == 2560 and s.scores.temperature == 0.1


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id_a long, hash_a long")
    assert dedup.hamming_join(none, none.toDF("id_b", "hash_b"), 3).count() == 0
    assert reports.histogram(spark.createDataFrame([], "v double"), F.col("v"), 0.0, 1.0, 4).agg(F.sum("n")).first()[0] == 0


def test_first_seen_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, "k", "c"), (0, "k", "d")], "i int, k string, v string")
    assert sorted((r.i, r.k, r.v, r.copies) for r in dedup.first_seen(df, F.col("k"), ["i"]).collect()) == [(0, "k", "d", 2), (1, None, "a", 2)]


def test_newest_rows_of_each_key_stay(spark):
    rows = [(k, f"t{k % 3}") for k in range(200)] + [(1000 + k, None) for k in range(3)]
    df = spark.createDataFrame(rows, "made int, kind string")
    gone = {r.made for r in windows.expired(df, "kind", "made", 5, parts=4).collect()}
    want = {m for t in ("t0", "t1", "t2", None) for m in sorted((m for m, k in rows if k == t), reverse=True)[5:]}
    assert gone == want


def test_index_of_four_layers(spark):
    empty = spark.createDataFrame([], "url string, sha256 string, phash long, id long, seq long")
    looks = spark.createDataFrame([(0b111, 77, 1), (0b1, 78, 2)], "phash long, id long, seq long")
    index = dedup.DedupIndex(spark, {"seen_urls": spark.createDataFrame([("u",)], "url string"), "seen_ids": empty.select("id"), "content_hashes": empty, "phash_index": looks}, radius=3)
    df = spark.createDataFrame([(1, "u", "s", 0), (2, "v", "s", 0), (3, "v", "s", -1), (4, None, None, None)], "id long, url string, sha256 string, phash long")
    out = {r.id: (r.reason, r.match_id) for r in index.check(df).collect()}
    assert out == {1: ("URL already fetched", None), 2: ("Visual match", 77), 3: (None, None), 4: (None, None)}
    assert {r.url: r.surely_new for r in index.surely_new(spark.createDataFrame([("u",), ("w",)], "url string"), "url").collect()} == {"u": False, "w": True}
    with pytest.raises(ValueError, match="phash_index"):
        dedup.DedupIndex(spark, {k: empty for k in ("seen_urls", "seen_ids", "content_hashes")})


def test_fetched_responses_and_bars(spark):
    reason = lambda s, c, u: one(spark, filters.fetch_reason(F.lit(s).cast("int"), F.lit(c).cast("string"), F.lit(u)))
    assert reason(200, "image/png", "https://h/a") is None and reason(404, "image/png", "https://h/a.png") == "Download failed: HTTP 404"
    assert reason(200, "text/html", "https://h/a.png") == "Download failed: no image" and reason(200, "image/gif", "https://h/a.gif") == "Download failed: type"
    df = spark.createDataFrame([("Reddit", True, False), ("reddit", False, True), ("pexels", True, False)], "s string, c boolean, f boolean")
    assert tuple(filters.bar_statistics(df, F.col("s"), F.col("c"), F.col("f")).first()) == (3, 2, 1, 1)


def test_reports_and_deltas(spark, tmp_path):
    import json

    counts = spark.createDataFrame([(10, 6, 3, 2)], "total long, passed long, approved long, uploaded long")
    rejected = spark.createDataFrame([("resolution", 3), ("duplicate", 2)], "bucket string, n long")
    sources = spark.createDataFrame([("a", 4), ("b", 6)], "source string, n long")
    out = json.loads(manifest.statistics_json(counts, rejected, sources, "2024-01-01").first().value)
    assert out["rejected_total"] == 7 and out["rejection_breakdown"] == {"resolution": 3, "duplicate": 2, "unaccounted": 2} and out["by_source"] == {"a": 4, "b": 6}
    entries = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3)], "id string, ts long")
    assert [r.id for r in manifest.newest_first(entries).collect()] == ["b", "c", "a"]
    assert [r.id for r in manifest.delta(entries, entries.where("ts = 3")).collect()] == ["a"]
    names = spark.createDataFrame([("2024_01_01.json.gz",), ("2024_01_01-2.json.gz",)], "name string")
    assert manifest.dated_name("2024_01_01", names) == "2024_01_01-3.json.gz" and manifest.dated_name("2024_01_02", names) == "2024_01_02.json.gz"
    path = manifest.write_dated(entries.select(F.struct("id").alias("e")), "e", str(tmp_path), "2024_01_02", names)
    assert path.endswith("2024_01_02.json.gz") and manifest.read_entries(spark, path, "id string").count() == 3
    errors = {"x": checks.first_errors(entries.where("ts = 3"), "id", 1), "y": checks.first_errors(entries.limit(0), "id")}
    report = checks.validation(errors)
    assert {r.check_name: (r.passed, r.n_errors, r.detail, r.all_passed) for r in report.collect()} == {"x": (False, 2, '["b"]', False), "y": (True, 0, "[]", False)}
    assert [r.check_name for r in checks.validation(errors, frozenset(["x"]), quick=True).collect()] == ["y"]
    assert json.loads(checks.report_json(report, "d").first().value)["overall_passed"] is False
    assert [r.id for r in checks.bad_entries(spark.createDataFrame([("a", "0fA"), ("b", "xyz"), ("c", None)], "id string, h string"), "id", "h").collect()] == ["b", "c"]


def test_sources_of_a_configuration(spark, tmp_path):
    lists = {"forum": ["earth", {"name": "city", "limit": 5, "min_score": 9}], "search": [{"query": "lake"}]}
    assert [tuple(r) for r in records.source_table(spark, lists).collect()] == [("forum", "earth", 100, 50, 0), ("forum", "city", 5, 9, 1), ("search", "lake", 100, 50, 0)]
    first = spark.createDataFrame([("a", 0, "1"), ("d", 3, "4")], "source string, place int, id string")
    feed = spark.createDataFrame([("a", 0, "f1"), ("b", 1, "f2"), ("d", 3, "f4")], "source string, place int, id string")
    assert sorted(r.id for r in records.with_fallback(first, feed, "source").collect()) == ["1", "f2", "f4"]
    assert [r.id for r in records.with_fallback(first, feed.where("source in ('a', 'd')"), "source").orderBy("id").collect()] == ["1", "4"]
    (tmp_path / "c.yaml").write_text("filters:\n  min_width: 100  # pixels\n  names: [a, 'b']\nsources:\n  forum:\n    - earth\n    - city\n  on: true\n")
    found = config.read_settings(str(tmp_path / "c.yaml"))
    assert found == {"filters": {"min_width": 100, "names": ["a", "b"]}, "sources": {"forum": ["earth", "city"], "on": True}}
    assert config.missing_settings(found, {"filters": ("min_width", "max_width"), "scores": ()}) == ["no filters.max_width", "no section scores"]
    assert one(spark, text.collection_name(F.lit("https://h.org/dark-city_scapes/p2?x=1"))) == "Dark City Scapes"
    assert one(spark, text.post_image_url(F.lit("https://x/y"), F.lit(False), F.expr("array(struct('a' as status, 'x' as u))"), F.struct(F.lit("https://p/b.gif").alias("url"), F.lit(4000).alias("width"), F.lit(3000).alias("height")))) is None


def test_first_links_and_quotes(spark):
    page = '<p class="o\'ad"><a href="/1">x</a></p><a href="/2">y</a><a href="/2">z</a><a href="/1">w</a>'
    found = html.dom_links(spark.createDataFrame([(1, page)], "page_id int, html string"), "o'ad")
    assert [(r.href, r.position) for r in html.first_of_page(found).orderBy("position").collect()] == [("/2", 1), ("/1", 3)]


def test_scraped_records_and_paging(spark):
    page = '<div class="Featured"><a href="/images/wallpapers/in-1.png">Download</a></div><a href="/images/wallpapers/black-cat-3840x2160-27.PNG">D</a><a href="/images/wallpapers/black-cat-3840x2160-27.PNG">D</a><a href="/images/wallpapers/9.jpg">D</a><a href="/x.png">D</a>'
    out = html.dom_records(spark.createDataFrame([(1, page)], "page_id int, html string"), "https://h").orderBy("position").collect()
    assert [(r.url, r.id, r.resolution, r.title) for r in out][0] == ("https://h/images/wallpapers/black-cat-3840x2160-27.PNG", "27", "3840x2160", "Black Cat") and len(out) == 2
    pages = spark.createDataFrame([("a", k) for k in range(1, 6)] + [("b", 1)], "source string, page int")
    found = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 4, "z"), ("b", 1, "w")], "source string, page int, id string")
    assert sorted(r.id for r in records.until_empty(found, pages).collect()) == ["w", "x", "y"]
    photos = spark.createDataFrame([("1", 5), ("1", 5), ("2", 9), ("3", 1), ("4", 2)], "id string, place int")
    assert [r.id for r in records.new_photos(photos, spark.createDataFrame([("3",)], "id string"), 2, ["place"]).collect()] == ["4", "1"]


@pytest.mark.parametrize("reverse", [False, True])
def test_a_whole_mean_is_cut_alike_in_any_order(spark, tmp_path, reverse):
    values = sorted([0.07, 0.29, 119.64] * 1000, reverse=reverse) + [None]  # 40.0 on average
    spark.createDataFrame([(1, v) for v in values] + [(2, None), (3, 1e300), (3, 3e300), (4, 60.0)], "user_id long, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    out = {r.user_id: (r.brightness, r.dark) for r in vector_queries.brightness_contrast_dark(spark, str(tmp_path)).where("user_id <> 3").collect()}
    assert out == {1: (40, True), 2: (None, None), 4: (60, False)}
    huge = spark.read.parquet(f"{tmp_path}/events.parquet").where("user_id = 3").agg(image.exact_mean(F.col("value"))).first()[0]
    assert huge == 2e300
