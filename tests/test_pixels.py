"""Image kernels against loops over pixels, and fixed colours."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.functions import exif, image, pixels


def at(g, y, x):
    h, w = g.shape
    y, x = (-y if y < 0 else 2 * h - 2 - y if y >= h else y), (-x if x < 0 else 2 * w - 2 - x if x >= w else x)
    return float(g[y, x])


def plain_sobel(g, y, x, look=at):
    sx = sum(k * (look(g, y + d, x + 1) - look(g, y + d, x - 1)) for d, k in ((-1, 1), (0, 2), (1, 1)))
    sy = sum(k * (look(g, y + 1, x + d) - look(g, y - 1, x + d)) for d, k in ((-1, 1), (0, 2), (1, 1)))
    return sx, sy


def clamp(x):
    return max(0.0, min(1.0, x))


def plain(g):
    h, w = g.shape
    grads = [[plain_sobel(g, y, x) for x in range(w)] for y in range(h)]
    size = np.array([[math.hypot(*s) for s in row] for row in grads])
    lap = [at(g, y - 1, x) + at(g, y + 1, x) + at(g, y, x - 1) + at(g, y, x + 1) - 4 * float(g[y, x]) for y in range(h) for x in range(w)]
    total = size.sum() + 1e-6
    cx, cy = sum(x * size[y, x] for y in range(h) for x in range(w)) / total, sum(y * size[y, x] for y in range(h) for x in range(w)) / total
    hist = np.bincount(g.astype(int).ravel(), minlength=256) / g.size
    exposure = 0.7 * hist[50:200].sum() + 0.3 * (1 - min(5 * hist[250:].sum(), 0.5) - min(5 * hist[:5].sum(), 0.5))
    out = {"sharpness": clamp((np.var(lap) - 100) / 1900), "exposure": clamp(exposure), "focal_x": cx / w, "focal_y": cy / h}
    out["off_centre"] = clamp(math.hypot(cx - w / 2, cy - h / 2) / math.hypot(w / 2, h / 2) * 2)
    out["balance"] = clamp(1 - (abs(g[:, : w // 2].mean() - g[:, w // 2 :].mean()) + abs(g[: h // 2].mean() - g[h // 2 :].mean())) / 255 / 2)
    return out


def test_measures_against_loops():
    rng = np.random.default_rng(1)
    stack = np.stack([rng.integers(0, 256, (9, 12)), rng.integers(100, 140, (9, 12)), np.full((9, 12), 3)]).astype(float)
    got = pixels.measures(stack)
    for k, g in enumerate(stack):
        for name, value in plain(g).items():
            assert got[name][k] == pytest.approx(value, abs=1e-9), name
    alone = pixels.measures(stack[1:2])
    assert all(got[name][1] == pytest.approx(alone[name][0]) for name in got)


def plain_canny(g, low=50, high=150):
    h, w = g.shape
    edge = lambda g, y, x: float(g[min(max(y, 0), h - 1), min(max(x, 0), w - 1)])
    grads = {(y, x): plain_sobel(g, y, x, edge) for y in range(h) for x in range(w)}
    size = lambda y, x: sum(map(abs, grads[y, x])) if (y, x) in grads else 0.0
    thin = set()
    for (y, x), (sx, sy) in grads.items():
        if abs(sy) <= abs(sx) * math.tan(math.pi / 8):
            a, b, strict = size(y, x - 1), size(y, x + 1), False
        elif abs(sy) > abs(sx) * math.tan(3 * math.pi / 8):
            a, b, strict = size(y - 1, x), size(y + 1, x), False
        else:
            s = 1 if (sx < 0) == (sy < 0) else -1
            a, b, strict = size(y - 1, x - s), size(y + 1, x + s), True
        if size(y, x) > a and (size(y, x) > b if strict else size(y, x) >= b):
            thin.add((y, x))
    found = {p for p in thin if size(*p) > high}
    todo = list(found)
    while todo:
        y, x = todo.pop()
        for p in ((y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)):
            if p in thin and p not in found and size(*p) > low:
                found.add(p)
                todo.append(p)
    return np.array([[(y, x) in found for x in range(w)] for y in range(h)])


def test_edges_against_loops():
    rng = np.random.default_rng(2)
    smooth = np.add.outer(np.arange(20) * 6, np.arange(24) * 3).astype(float)
    smooth[5:12, 6:15] += 90
    stack = np.stack([smooth, rng.integers(0, 256, (20, 24)).astype(float), rng.integers(100, 125, (20, 24)).astype(float)])
    got = pixels.canny(stack)
    for g, e in zip(stack, got, strict=True):
        assert (plain_canny(g) == e).all()
    assert got[0].any()


def test_regions_of_edges():
    g = np.zeros((1, 90, 120))
    g[0, 28:33, 38:43] = 255  # at a crossing of the thirds
    m = pixels.measures(g)
    edges = plain_canny(g[0])
    radius, want = 9, 0.0
    for x in (40, 80):
        for y in (30, 60):
            part = edges[y - radius : y + radius, x - radius : x + radius]
            want += part.sum() / part.size
    assert m["thirds"][0] == pytest.approx(clamp(2 * want), abs=1e-6) and want > 0
    bands = [edges[60:], edges[30:60], edges[:30]]
    assert m["depth"][0] == pytest.approx(clamp(100 * np.var([b.mean() for b in bands])), abs=1e-6)
    assert m["band_depth"][0] == pytest.approx(min(np.std([255 * b.mean() for b in bands]) / 50, 1))
    assert m["leading_lines"][0] == 0.3 and m["n_lines"][0] == 0
    assert m["artifacts"][0] == pytest.approx(1 - clamp(_spike(g[0]) / 10))


def _spike(g):
    grad = np.array([[plain_sobel(g, y, x)[0] for x in range(g.shape[1])] for y in range(g.shape[0])])
    power = np.abs(np.fft.fft(grad.mean(axis=0)))
    return power[len(power) // 8] / (power.mean() + 1e-6)


def test_slanted_lines_lead():
    g = np.full((1, 200, 200), 20.0)
    y, x = np.mgrid[:200, :200]
    g[0][np.abs(y - x) < 3] = 220
    m = pixels.measures(g)
    assert m["leading_lines"][0] >= 0.1 and m["n_lines"][0] >= 2
    flat = np.full((1, 200, 200), 20.0)
    flat[0, 90:96] = 220
    assert pixels.measures(flat)["leading_lines"][0] == 0.0 and pixels.measures(flat)["n_lines"][0] >= 2


@pytest.mark.parametrize(("rgb", "lab"), [((255, 255, 255), (255, 128, 128)), ((0, 0, 0), (0, 128, 128)), ((255, 0, 0), (136, 208, 195)), ((0, 255, 0), (224, 42, 211)), ((0, 0, 255), (82, 207, 20)), ((128, 128, 128), (137, 128, 128))])
def test_fixed_colours(rgb, lab):
    got = pixels.rgb_to_lab(np.array(rgb, float))
    assert np.abs(got - lab).max() <= 1
    back = pixels.lab_to_rgb(np.array(lab, float))  # whole LAB values leave dark channels open by some steps
    assert np.abs(back - rgb).max() <= 8 and np.abs(pixels.rgb_to_lab(back) - lab).max() <= 1
    assert pixels.lab_hex(np.array((255.9, 128.9, 128.0))) == "#ffffff"


def test_palette_of_boxes(spark):
    rgb = np.zeros((100, 100, 3))
    rgb[:, :60] = (255, 0, 0)
    rgb[:, 60:85] = (0, 0, 255)
    rgb[:60, 85:] = (255, 255, 255)
    p = pixels.palettes(rgb[None], side=None).iloc[0]
    assert p["sizes"][:3] == [6000, 2500, 900] and p["colours"][0][1] in "ef" and p["hue"] == int(math.degrees(math.atan2(195 - 128, 208 - 128)))
    assert pixels.palettes(np.stack([rgb, 255 - rgb]), side=None).iloc[0].equals(p)
    df = spark.createDataFrame([(1, rgb[::5, ::5].ravel().tolist()), (2, [0.0] * 12)], "i int, p array<double>")
    out = {r.i: r.c for r in df.select("i", pixels.palette(F.col("p"), F.when(F.col("i") == 1, 20).otherwise(2)).alias("c")).collect()}
    assert sum(out[1].sizes) == 10_000 and out[2].colours[0] == "#000000" and out[2].diversity == 0.0


def test_resize_and_symmetry(spark):
    rng = np.random.default_rng(5)
    flat = np.full((1, 30, 50, 3), 77.0)
    assert (pixels.resize(flat, 64, 64) == 77).all()
    some = rng.integers(0, 256, (1, 64, 64, 3)).astype(float)
    assert (pixels.resize(some, 64, 64) == some).all()
    ramp = np.repeat(np.arange(0, 256, 2.0)[None, None, :, None], 3, 3)
    assert np.abs(pixels.resize(ramp, 64, 1)[0, 0, 4:-4, 0] - (np.arange(64) * 4 + 1)[4:-4]).max() <= 1
    half = np.zeros((1, 64, 64, 3))
    half[:, :, :32] = 255
    assert pixels.symmetry_scores(flat)[0] == 1.0 and pixels.symmetry_scores(half)[0] < 1e-10
    df = spark.createDataFrame([(flat.ravel().tolist(), 50), (half.ravel().tolist(), 64)], "p array<double>, w int")
    assert [r.s > 0.5 for r in df.select(pixels.symmetry64(F.col("p"), F.col("w")).alias("s")).collect()] == [True, False]


def test_images_of_many_shapes_keep_their_order(spark):
    rng = np.random.default_rng(6)
    rows = [(k, rng.integers(0, 256, 60).astype(float).tolist(), (6, 10, 12)[k % 3]) for k in range(20)]
    df = spark.createDataFrame(rows, "i int, p array<double>, w int")
    out = {r.i: r.m.exposure for r in df.select("i", pixels.grey_measures(F.col("p"), F.col("w")).alias("m")).collect()}
    for i, p, w in rows:
        assert out[i] == pytest.approx(plain(np.array(p, float).reshape(-1, w))["exposure"])


def test_scalar_measures(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()[0]
    assert [one(image.contrast_score(F.lit(float(x)))) for x in (10, 30, 60, 100, 160, 300)] == pytest.approx([0.25, 0.75, 1.0, 0.8, 0.2, 0.0])
    assert [one(image.brightness_score(F.lit(x))) for x in (0.2, 0.4, 0.7, 0.85, 1.2)] == pytest.approx([0.5, 1, 1, 0.5, 0])
    hues = lambda *h: F.array(*[F.lit(float(x)) for x in h])
    assert one(image.harmony(hues(5, 355))) == pytest.approx(0.1) and one(image.harmony(hues(0, 180))) == pytest.approx(0.2) and one(image.harmony(hues(0, 90))) == 0.0


def test_exif(spark):
    import struct

    def entry(tag, kind, n, value):
        return struct.pack("<HHI", tag, kind, n) + value

    body = b"Camera X\0"
    entries = [entry(271, 2, len(body), struct.pack("<I", 100)), entry(274, 3, 1, struct.pack("<HH", 6, 0)), entry(282, 5, 1, struct.pack("<I", 0)), entry(40000, 4, 1, struct.pack("<I", 9))]
    tiff = (b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", len(entries)) + b"".join(entries)).ljust(100, b"\0") + body
    app1 = b"Exif\0\0" + tiff
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xe1" + struct.pack(">H", len(app1) + 2) + app1 + b"\xff\xda"
    df = spark.createDataFrame([(bytearray(jpeg),), (bytearray(b"\xff\xd8\xff"),), (None,)], "b binary")
    assert [r.e for r in df.select(exif.exif(F.col("b")).alias("e")).collect()] == [{"Make": "Camera X", "Orientation": "6", "40000": "9"}, {}, {}]
