"""Hamming search, zero-shot labels, quantising and image measures over the embeddings table.

The vocabulary is the centroid of each label; an 8 x 8 grid of a vector's 64 values stands for a
small image.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions import image, pixels, vocabularies
from gleanery.operators import checks, dedup, hamming, scoring, vectors
from gleanery.plans.registry import query, table

RADIUS = 10

HASHES = """h0 AS (SELECT vec_id, list_reduce(list_transform(embedding[1:64], lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END::UBIGINT), lambda a, b: ((a % 9223372036854775808::UBIGINT) * 2 + b)::UBIGINT, 0::UBIGINT) AS p0 FROM embeddings),
    h AS (SELECT vec_id, p0 AS p FROM h0 UNION ALL SELECT vec_id + 1000000, xor(p0, (vec_id * 7919 % 1048576)::UBIGINT) FROM h0)"""

CENTROIDS = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    d AS (SELECT label, i, avg(v[i]) AS m FROM e, (SELECT unnest(range(1, 65)) AS i) GROUP BY label, i),
    cs AS (SELECT label, list(m ORDER BY i) AS centroid FROM d GROUP BY label)"""

SCORES = CENTROIDS + """, s AS (SELECT vec_id, cs.label, list_dot_product(v, centroid) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(centroid, centroid))) AS score FROM e, cs)"""


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors' hashes, and for each another one with up to 20 of its last bits changed, so that
    some have neighbours within the radius."""
    own = table(spark, sf_dir, "embeddings").select("vec_id", dedup.sign_hash(F.col("embedding")).alias("p"))
    return own.unionByName(own.select((F.col("vec_id") + 1_000_000).alias("vec_id"), F.col("p").bitwiseXOR(F.col("vec_id") * 7919 % 1048576).alias("p")))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, scores: the cosines to the centroids of all labels."""
    items = table(spark, sf_dir, "embeddings")
    return vectors.with_scores(items.select("vec_id", "embedding"), vectors.centroids(items, "label", "embedding").withColumn("label", F.col("label").cast("string")), "embedding")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashes(spark, sf_dir).select(F.col("vec_id").alias("id"), F.col("p").alias("hash"))


PAIRS_SQL = f"WITH {HASHES} SELECT a.vec_id AS id_a, b.vec_id AS id_b, bit_count(xor(a.p, b.p))::INTEGER AS distance FROM h a JOIN h b ON a.vec_id < b.vec_id WHERE bit_count(xor(a.p, b.p)) <= {RADIUS}"


@query(PAIRS_SQL)
def hamming_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.hamming_self_join(_items(spark, sf_dir), RADIUS)


@query(f"WITH {HASHES}, x AS (SELECT a.vec_id AS id, bit_count(xor(a.p, b.p)) AS distance FROM h a JOIN h b ON a.vec_id <> b.vec_id WHERE bit_count(xor(a.p, b.p)) <= {RADIUS}) SELECT id, count(*) AS n_near, min(distance)::INTEGER AS nearest FROM x GROUP BY id")
def hamming_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each vector with near ones: how many, and the least distance."""
    return hamming.neighbours(_items(spark, sf_dir), RADIUS)


@query(f"""WITH {HASHES} SELECT a.vec_id AS id_a, arg_min(b.vec_id, b.vec_id) AS match_id, arg_min(bit_count(xor(a.p, b.p)), b.vec_id)::INTEGER AS distance, count(*) AS n_within
    FROM h a JOIN h b ON b.vec_id < 1000000 AND a.vec_id >= 1000000 WHERE bit_count(xor(a.p, b.p)) <= {RADIUS} GROUP BY a.vec_id""")
def hamming_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hashes(spark, sf_dir)
    queries = h.where("vec_id >= 1000000").select(F.col("vec_id").alias("id_a"), F.col("p").alias("hash_a"))
    index = h.where("vec_id < 1000000").select(F.col("vec_id").alias("id_b"), F.col("p").alias("hash_b"), F.col("vec_id").alias("seq"))
    return hamming.first_match(queries, index, RADIUS)


@query(f"""WITH {SCORES}, p AS (SELECT vec_id, max(score) FILTER (label = 0) AS pos, max(score) FILTER (label = 1) AS neg FROM s GROUP BY vec_id)
    SELECT vec_id, round(1.0 / (1.0 + exp(-(pos - neg) / 0.07)), 6) AS share FROM p""")
def binary_prompt_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda label: F.get(F.filter("scores", lambda s: s["label"] == label), 0)["score"]
    return scored(spark, sf_dir).select("vec_id", F.round(scoring.binary_softmax(of("0"), of("1"), 0.07), 6).alias("share"))


def _ranked(df: DataFrame, labels: Column, value: str, digits: int) -> DataFrame:
    rows = df.select("vec_id", F.posexplode(labels).alias("rank", "s"))
    return rows.select("vec_id", F.col("s.label").cast("int").alias("label"), (F.col("rank") + 1).alias("rank"), F.round("s.score", digits).alias(value))


@query(f"""WITH {SCORES}, x AS (SELECT *, exp(100.0 * (score - max(score) OVER (PARTITION BY vec_id))) AS ex FROM s), p AS (SELECT vec_id, label, ex / sum(ex) OVER (PARTITION BY vec_id) AS p FROM x),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, label) AS rank FROM p)
    SELECT vec_id, label, rank::INTEGER AS rank, round(p, 5) AS p FROM r WHERE rank = 1 OR (rank = 2 AND p > 0.1)""")
def zero_shot_single_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category and, from a share of .1 on, the next one."""
    best = F.filter(vectors.classify(F.col("scores"), "single"), lambda s, k: (k == 0) | (s["score"] > 0.1))
    return _ranked(scored(spark, sf_dir), best, "p", 5)


@query(f"""WITH {SCORES}, a AS (SELECT *, score * CASE label WHEN 3 THEN 0.65 WHEN 5 THEN 0.8 WHEN 7 THEN 0.55 ELSE 1.0 END::DOUBLE AS adj FROM s),
    b AS (SELECT *, avg(adj) OVER w + 0.5 * stddev_pop(adj) OVER w AS cut, max(adj) OVER w AS top FROM a WINDOW w AS (PARTITION BY vec_id)),
    k AS (SELECT * FROM b WHERE adj >= cut AND adj >= 0.75 * top), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY adj DESC, label) AS rank FROM k)
    SELECT vec_id, label, rank::INTEGER AS rank, round(adj, 6) AS adjusted FROM r WHERE rank <= 3""")
def zero_shot_multi_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(scored(spark, sf_dir), vectors.classify(F.col("scores"), "multi", penalties={"3": 0.65, "5": 0.80, "7": 0.55}), "adjusted", 6)


@query(f"""WITH {SCORES}, r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label) AS rank FROM s WHERE score >= 0.25)
    SELECT vec_id, label, round(score, 6) AS score FROM r WHERE rank <= 2""")
def threshold_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(scored(spark, sf_dir), vectors.classify(F.col("scores"), "threshold"), "score", 6).drop("rank")


def _prompt_wave(prompts: list[str]) -> list[list[float]]:
    """A stand-in for a text encoder: the k-th prompt is a wave over 64 dimensions."""
    return [[math.cos(0.7 * k * (i + 1) + 1.3 * i) for i in range(64)] for k in range(len(prompts))]


def _vocabulary_sql(vocabulary: dict[str, str]) -> str:
    labels = ", ".join(f"'{x}'" for x in vocabulary)
    return f"""e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), l AS (SELECT unnest([{labels}]) AS label, unnest(range({len(vocabulary)})) AS k),
    c AS (SELECT label, k, list_transform(range(64), lambda i: cos(0.7::DOUBLE * k * (i + 1) + 1.3::DOUBLE * i)) AS w FROM l),
    s AS (SELECT vec_id, label, k, list_dot_product(v, w) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(w, w))) AS score FROM e, c)"""


def _vocabulary_scores(spark: SparkSession, sf_dir: str, vocabulary: dict[str, str]) -> DataFrame:
    return vectors.with_scores(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), vectors.prompt_vectors(spark, vocabulary, _prompt_wave), "embedding")


@query(f"""WITH {_vocabulary_sql(vocabularies.CATEGORIES)}, x AS (SELECT *, exp(100.0 * (score - max(score) OVER (PARTITION BY vec_id))) AS ex FROM s), p AS (SELECT vec_id, label, k, ex / sum(ex) OVER (PARTITION BY vec_id) AS p FROM x),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, k) AS rank FROM p)
    SELECT vec_id, max(label) FILTER (rank = 1) AS category, coalesce(max(label) FILTER (rank = 2 AND p > 0.1), '') AS subcategories, round(max(p) FILTER (rank = 1), 5) AS confidence FROM r GROUP BY vec_id""")
def category_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category, subcategory and confidence over the whole vocabulary of categories."""
    c = _vocabulary_scores(spark, sf_dir, vocabularies.CATEGORIES).select("vec_id", vectors.category_of(F.col("scores")).alias("c"))
    return c.select("vec_id", "c.category", F.array_join("c.subcategories", ",").alias("subcategories"), F.round("c.confidence", 5).alias("confidence"))


def _tags_sql(vocabulary: dict[str, str]) -> str:
    penalty = " ".join(f"WHEN '{k}' THEN {v}" for k, v in vocabularies.PENALTIES.items())
    return f"""WITH {_vocabulary_sql(vocabulary)}, a AS (SELECT *, score * (CASE label {penalty} ELSE 1.0 END)::DOUBLE AS adj FROM s),
    b AS (SELECT *, avg(adj) OVER w + 0.5 * stddev_pop(adj) OVER w AS cut FROM a WINDOW w AS (PARTITION BY vec_id)), t AS (SELECT *, max(adj) OVER (PARTITION BY vec_id) AS top FROM b WHERE adj >= cut),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY adj DESC, k) AS rank FROM t WHERE adj >= 0.75 * top)
    SELECT e.vec_id, coalesce(string_agg(label, ',' ORDER BY rank), '') AS tags FROM e LEFT JOIN r ON r.vec_id = e.vec_id AND rank <= 3 GROUP BY e.vec_id"""


@query(_tags_sql(vocabularies.MOODS))
def mood_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocabulary_scores(spark, sf_dir, vocabularies.MOODS).select("vec_id", F.array_join(vectors.tags_of(F.col("scores"), vocabularies.PENALTIES), ",").alias("tags"))


@query(_tags_sql(vocabularies.STYLES))
def style_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocabulary_scores(spark, sf_dir, vocabularies.STYLES).select("vec_id", F.array_join(vectors.tags_of(F.col("scores"), vocabularies.PENALTIES), ",").alias("tags"))


@query(f"WITH {_vocabulary_sql(vocabularies.COMPOSITIONS)} SELECT vec_id, arg_max(label, score) AS composition FROM s GROUP BY vec_id")
def composition_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocabulary_scores(spark, sf_dir, vocabularies.COMPOSITIONS).select("vec_id", vectors.composition_of(F.col("scores")).alias("composition"))


@query("SELECT vec_id, list_sum(list_transform(embedding, lambda x: trunc(greatest(-128.0, least(127.0, x::DOUBLE * 127.0)))))::BIGINT AS total, list_max(list_transform(embedding, lambda x: trunc(greatest(-128.0, least(127.0, x::DOUBLE * 127.0)))))::INTEGER AS top FROM embeddings")
def int8_quantize_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "embeddings").select("vec_id", vectors.quantize_int8(F.col("embedding")).alias("q"))
    return q.select("vec_id", F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), F.array_max("q").cast("int").alias("top"))


@query("SELECT 'base' AS model, count(*) FILTER (len(embedding) = 64) AS n_correct, count(*) FILTER (len(embedding) <> 64) AS n_wrong, count(*) FILTER (embedding IS NULL) AS n_missing FROM embeddings UNION ALL SELECT 'wide', count(*) FILTER (len(embedding) = 128), count(*) FILTER (len(embedding) <> 128), 0 FROM embeddings")
def embedding_dimension_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("embedding")
    return checks.dimension_counts(table(spark, sf_dir, "embeddings"), {"base": (v, 64), "wide": (v, 128)})


@query("""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), m AS (SELECT list(x ORDER BY i) AS c FROM (SELECT i, avg(v[i]) AS x FROM e, (SELECT unnest(range(1, 65)) AS i) WHERE vec_id < 5 GROUP BY i))
    SELECT vec_id, round(list_dot_product(v, c) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(c, c))), 6) AS score FROM e, m WHERE vec_id >= 5 ORDER BY list_dot_product(v, c) / sqrt(list_dot_product(v, v)) DESC, vec_id LIMIT 30""")
def preference_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 30 vectors nearest to the mean of chosen ones: a top-k report."""
    items = table(spark, sf_dir, "embeddings")
    mean = vectors.centroids(items.where("vec_id < 5").withColumn("one", F.lit(0)), "one", "embedding")
    near = vectors.label_scores(items.where("vec_id >= 5"), mean, "vec_id", "embedding")
    return near.orderBy(F.desc("score"), "vec_id").limit(30).select("vec_id", F.round("score", 6).alias("score"))


@query("""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), p AS (SELECT vec_id, [v[1:3], v[4:6], v[7:9], v[10:12], v[13:15]] AS c FROM (SELECT vec_id, list_transform(v, lambda x: x * 200) AS v FROM e))
    SELECT vec_id, round(least(sum(list_distance(c[i], c[j])) / 10 / 100, 1.0), 6) AS diversity FROM p, (SELECT unnest(range(1, 6)) AS i), (SELECT unnest(range(1, 6)) AS j) WHERE i < j GROUP BY vec_id""")
def palette_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean distance of all pairs of five colours over 100, capped at 1."""
    v = F.transform("embedding", lambda x: x.cast("double") * 200)
    points = F.array(*[F.slice(v, 3 * k + 1, 3) for k in range(5)])
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(F.least(image.pairwise_mean(points) / 100, F.lit(1.0)), 6).alias("diversity"))


@query("SELECT vec_id, ((trunc(degrees(atan2(embedding[2]::DOUBLE, embedding[1]::DOUBLE)))::INTEGER % 360 + 360) % 360)::INTEGER AS hue FROM embeddings")
def dominant_hue(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select("vec_id", image.hue(e[0].cast("double"), e[1].cast("double")).alias("hue"))


@query("SELECT user_id, trunc(avg(value))::INTEGER AS brightness, round(stddev_pop(value), 6) AS contrast, avg(value) < 60 AND stddev_pop(value) > 20 AS dark FROM events GROUP BY user_id")
def brightness_contrast_dark(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = table(spark, sf_dir, "events").groupBy("user_id").agg(image.exact_mean(F.col("value")).alias("mean"), F.stddev_pop("value").alias("deviation"))
    return stats.select("user_id", F.col("mean").cast("int").alias("brightness"), F.round("deviation", 6).alias("contrast"), image.is_dark(F.col("mean"), F.col("deviation")).alias("dark"))


@query("""WITH m AS (SELECT vec_id, i, abs(embedding[i + 1]::DOUBLE) AS m FROM embeddings, (SELECT unnest(range(0, 64)) AS i))
    SELECT vec_id, round(sum(m * (i % 8)) / (sum(m) + 1e-6) / 8, 6) AS x, round(sum(m * (i // 8)) / (sum(m) + 1e-6) / 8, 6) AS y FROM m GROUP BY vec_id""")
def weighted_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    c = table(spark, sf_dir, "embeddings").select("vec_id", image.centroid(grid, 8).alias("c"))
    return c.select("vec_id", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"))


@query("""WITH m AS (SELECT vec_id, (embedding[i + 1]::DOUBLE * 255 - embedding[(i // 8) * 8 + 7 - i % 8 + 1]::DOUBLE * 255) AS d FROM embeddings, (SELECT unnest(range(0, 64)) AS i))
    SELECT vec_id, round(exp(-avg(d * d) / 1000.0), 6) AS symmetry FROM m GROUP BY vec_id""")
def symmetry_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = F.transform("embedding", lambda x: x.cast("double") * 255)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(image.symmetry(grid, 8), 6).alias("symmetry"))


def _pixel(dy: int, dx: int) -> str:
    """A neighbour in an 8 x 8 list, mirrored at the border without the edge."""
    at = lambda v, d: f"(CASE WHEN {v} + {d} < 0 THEN 1 WHEN {v} + {d} > 7 THEN 6 ELSE {v} + {d} END)"
    return f"g[{at('y', dy)} * 8 + {at('x', dx)} + 1]"


GREY = """i AS (SELECT vec_id, list_transform(embedding[1:64], lambda v: floor((v::DOUBLE + 1) * 127.5)) AS g FROM embeddings), p AS (SELECT vec_id, g, k // 8 AS y, k % 8 AS x FROM i, (SELECT unnest(range(64)) AS k))"""

SOBEL = f"""{GREY}, d AS (SELECT *, g[y * 8 + x + 1] AS v,
    {_pixel(-1, 1)} - {_pixel(-1, -1)} + 2 * ({_pixel(0, 1)} - {_pixel(0, -1)}) + {_pixel(1, 1)} - {_pixel(1, -1)} AS sx,
    {_pixel(1, -1)} - {_pixel(-1, -1)} + 2 * ({_pixel(1, 0)} - {_pixel(-1, 0)}) + {_pixel(1, 1)} - {_pixel(-1, 1)} AS sy,
    {_pixel(-1, 0)} + {_pixel(1, 0)} + {_pixel(0, -1)} + {_pixel(0, 1)} - 4 * g[y * 8 + x + 1] AS lap FROM p), m AS (SELECT *, sqrt(sx * sx + sy * sy) AS size FROM d)"""

CLAMP = "greatest(0.0, least(1.0, {}))"


def _grey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, m: the measures of a vector's 64 values as a grey image of 8 x 8."""
    grid = F.transform(F.slice("embedding", 1, 64), lambda x: F.floor((x.cast("double") + 1) * 127.5))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", grid.alias("grid")).repartition(spark.sparkContext.defaultParallelism, "vec_id")
    return rows.select("vec_id", pixels.grey_measures(F.col("grid"), F.lit(8)).alias("m"))


@query(f"""WITH {SOBEL}, a AS (SELECT vec_id, var_pop(lap) AS lap, sum(size) + 1e-6 AS total, sum(x * size) AS mx, sum(y * size) AS my, avg(CASE WHEN v >= 50 AND v < 200 THEN 1.0 ELSE 0.0 END) AS mid, avg(CASE WHEN v >= 250 THEN 1.0 ELSE 0.0 END) AS blown,
        avg(CASE WHEN v < 5 THEN 1.0 ELSE 0.0 END) AS crushed, avg(v) FILTER (x < 4) AS l, avg(v) FILTER (x >= 4) AS r, avg(v) FILTER (y < 4) AS t, avg(v) FILTER (y >= 4) AS b, avg(abs(v - g[y * 8 + 7 - x + 1])) AS differ FROM m GROUP BY vec_id)
    SELECT vec_id, round({CLAMP.format("(lap - 100) / 1900")}, 6) AS sharpness, round({CLAMP.format("0.7 * mid + 0.3 * (1 - least(5 * blown, 0.5) - least(5 * crushed, 0.5))")}, 6) AS exposure,
        round(mx / total / 8, 6) AS focal_x, round(my / total / 8, 6) AS focal_y, round({CLAMP.format("sqrt((mx / total - 4) * (mx / total - 4) + (my / total - 4) * (my / total - 4)) / sqrt(32.0) * 2")}, 6) AS off_centre,
        round({CLAMP.format("1 - (abs(l - r) + abs(t - b)) / 255 / 2")}, 6) AS balance, round(1 - differ / 255, 6) AS mirrored, 1.0::DOUBLE AS artifacts FROM a""")
def gradient_kernels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sobel, Laplacian and histogram measures; an image under 64 pixels shows no artifacts."""
    names = ("sharpness", "exposure", "focal_x", "focal_y", "off_centre", "balance", "mirrored")
    return _grey(spark, sf_dir).select("vec_id", *[F.round(F.col(f"m.{c}"), 6).alias(c) for c in names], F.col("m.artifacts").alias("artifacts"))


@query(f"""WITH {GREY}, f AS (SELECT vec_id, u, v, sqrt(pow(sum(g[y * 8 + x + 1] * cos(2 * pi() * (u * x + v * y) / 8)), 2) + pow(sum(g[y * 8 + x + 1] * sin(2 * pi() * (u * x + v * y) / 8)), 2)) AS size
        FROM p, (SELECT unnest(range(8)) AS u), (SELECT unnest(range(8)) AS v) GROUP BY vec_id, u, v)
    SELECT vec_id, round(1 - {CLAMP.format("3 * sum(CASE WHEN sqrt(pow((u + 4) % 8 - 4, 2) + pow((v + 4) % 8 - 4, 2)) > 0.35 * 8 THEN size ELSE 0 END) / (sum(size) + 1e-6)")}, 6) AS busyness FROM f GROUP BY vec_id""")
def texture_busyness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of high frequencies."""
    return _grey(spark, sf_dir).select("vec_id", F.round("m.busyness", 6).alias("busyness"))


@query()
def edge_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What thinned and connected edges say: complexity, composition, thirds, depth, lines."""
    m = _grey(spark, sf_dir).select("vec_id", "m.edge_ratio", "m.thirds", "m.depth", "m.band_depth", "m.leading_lines", "m.mirrored", "m.window_share", "m.n_lines")
    return m.select("vec_id", "edge_ratio", "thirds", "depth", "band_depth", "leading_lines", image.complexity(F.col("edge_ratio")).alias("complexity"), image.composition(F.col("mirrored"), F.col("window_share"), F.col("n_lines")).alias("composition"))


@query()
def kmeans_palette(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five colours of each vector's values as pixels of three."""
    values = F.transform(F.slice("embedding", 1, 63), lambda x: F.floor((x.cast("double") + 1) * 127.5))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", values.alias("rgb")).repartition(spark.sparkContext.defaultParallelism, "vec_id")
    return rows.select("vec_id", pixels.palette(F.col("rgb"), F.lit(7), side=None).alias("p")).select("vec_id", "p.*")


@query("SELECT vec_id, array_to_string(list_filter(['base', 'wide', 'text', 'self'], lambda m: NOT list_contains(CASE vec_id % 3 WHEN 0 THEN ['base'] WHEN 1 THEN ['base', 'text'] ELSE ['wide', 'self'] END, m)), ',') AS pending FROM embeddings")
def pending_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = F.array(*map(F.lit, ("base", "wide", "text", "self")))
    done = F.when(F.col("vec_id") % 3 == 0, F.array(F.lit("base"))).when(F.col("vec_id") % 3 == 1, F.array(F.lit("base"), F.lit("text"))).otherwise(F.array(F.lit("wide"), F.lit("self")))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.array_join(F.array_except(every, done), ",").alias("pending"))


@query("SELECT label::VARCHAR AS category, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM embeddings), 2) AS share_pct FROM embeddings GROUP BY label")
def category_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanery.operators.reports import distribution

    return distribution(table(spark, sf_dir, "embeddings"), F.col("label"))
