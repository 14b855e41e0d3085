"""Image kernels: Arrow UDFs on numpy.

Images come as flat row-major arrays of 0..255 (grey, or three values a pixel) with their width. The
images of an Arrow batch that share a shape are stacked, and each measure is computed for the whole
stack at once; nothing depends on which images share a batch.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TOGETHER = 1 << 22  # values of a stack


def clamp(x: np.ndarray) -> np.ndarray:
    return np.clip(x, 0.0, 1.0)


def sobel(g: np.ndarray, mode: str = "reflect") -> tuple[np.ndarray, np.ndarray]:
    """Horizontal and vertical derivative by 3 x 3 kernels, borders mirrored without the edge."""
    p = np.pad(g, ((0, 0), (1, 1), (1, 1)), mode=mode)
    across, down = p[:, :, 2:] - p[:, :, :-2], p[:, 2:] - p[:, :-2]
    return across[:, :-2] + 2 * across[:, 1:-1] + across[:, 2:], down[:, :, :-2] + 2 * down[:, :, 1:-1] + down[:, :, 2:]


def canny(g: np.ndarray, low: float = 50, high: float = 150) -> np.ndarray:
    """Edges (booleans): gradients thinned along their direction, those above `high`, and those
    above `low` that are connected to them."""
    sx, sy = sobel(g, "edge")
    size = np.abs(sx) + np.abs(sy)
    p = np.pad(size, ((0, 0), (1, 1), (1, 1)))
    at = lambda dy, dx: p[:, 1 + dy : p.shape[1] - 1 + dy, 1 + dx : p.shape[2] - 1 + dx]
    flat, steep = np.abs(sy) <= np.abs(sx) * np.tan(np.pi / 8), np.abs(sy) > np.abs(sx) * np.tan(3 * np.pi / 8)
    falling = (sx < 0) == (sy < 0)
    before = np.where(flat, at(0, -1), np.where(steep, at(-1, 0), np.where(falling, at(-1, -1), at(-1, 1))))
    after = np.where(flat, at(0, 1), np.where(steep, at(1, 0), np.where(falling, at(1, 1), at(1, -1))))
    thin = (size > before) & np.where(flat | steep, size >= after, size > after)
    weak, edges = thin & (size > low), thin & (size > high)
    while True:
        q = np.pad(edges, ((0, 0), (1, 1), (1, 1)))
        near = np.zeros_like(edges)
        for dy in range(3):
            for dx in range(3):
                near |= q[:, dy : dy + edges.shape[1], dx : dx + edges.shape[2]]
        grown = edges | (near & weak)
        if (grown == edges).all():
            return edges
        edges = grown


def segments(edges: np.ndarray, votes: int, min_length: float, max_gap: int = 10) -> list[tuple[int, int, int, int]]:
    """Straight segments (x1, y1, x2, y2) of one edge image: of the lines through at least `votes`
    edge points, by one degree and one pixel, the strongest first; each takes its points along."""
    ys, xs = np.nonzero(edges)
    found: list[tuple[int, int, int, int]] = []
    angle = np.deg2rad(np.arange(180))
    cos, sin = np.cos(angle), np.sin(angle)
    while len(xs) >= votes:
        rho = np.rint(np.outer(xs, cos) + np.outer(ys, sin)).astype(np.int64)
        low = int(rho.min())
        count = np.zeros((180, int(rho.max()) - low + 1), np.int64)
        np.add.at(count, (np.broadcast_to(np.arange(180), rho.shape), rho - low), 1)
        k = int(count.argmax())
        theta, r = divmod(k, count.shape[1])
        if count[theta, r] < votes:
            break
        on = np.flatnonzero(rho[:, theta] - low == r)
        along = -xs[on] * sin[theta] + ys[on] * cos[theta]
        order = np.argsort(along, kind="stable")
        on, along = on[order], along[order]
        for some in np.split(np.arange(len(on)), np.flatnonzero(np.diff(along) > max_gap) + 1):
            a, b = on[some[0]], on[some[-1]]
            if max(abs(int(xs[b]) - int(xs[a])), abs(int(ys[b]) - int(ys[a]))) >= min_length:
                found.append((int(xs[a]), int(ys[a]), int(xs[b]), int(ys[b])))
        rest = np.ones(len(xs), bool)
        rest[on] = False
        xs, ys = xs[rest], ys[rest]
    return found


def _slanted(lines: list[tuple[int, int, int, int]]) -> int:
    """Segments that rise or fall by 20 to 70 degrees."""
    return sum(x1 != x2 and 20 < abs(np.degrees(np.arctan((y2 - y1) / (x2 - x1)))) < 70 for x1, y1, x2, y2 in lines)


def measures(g: np.ndarray) -> dict[str, np.ndarray]:
    """All grey measures of a stack (n, height, width)."""
    g = g.astype(np.float64)
    n, h, w = g.shape
    p = np.pad(g, ((0, 0), (1, 1), (1, 1)), mode="reflect")
    laplacian = p[:, 1:-1, :-2] + p[:, 1:-1, 2:] + p[:, :-2, 1:-1] + p[:, 2:, 1:-1] - 4 * g
    sx, sy = sobel(g)
    size = np.hypot(sx, sy)
    total = size.sum((1, 2)) + 1e-6
    cx, cy = (size.sum(1) * np.arange(w)).sum(1) / total, (size.sum(2) * np.arange(h)).sum(1) / total
    share = lambda low, high: ((g >= low) & (g < high)).mean((1, 2))
    exposure = 0.7 * share(50, 200) + 0.3 * (1 - np.minimum(5 * share(250, 256), 0.5) - np.minimum(5 * share(0, 5), 0.5))
    spectrum = np.abs(np.fft.fftshift(np.fft.fft2(g), axes=(1, 2)))
    yy, xx = np.ogrid[:h, :w]
    far = np.hypot(xx - w // 2, yy - h // 2) > 0.35 * min(h, w)
    blocks = np.ones(n)
    if h >= 64 and w >= 64:
        power = np.abs(np.fft.fft(sx.mean(1), axis=1))
        blocks = 1 - clamp(power[:, w // 8] / (power.mean(1) + 1e-6) / 10)
    sides = np.abs(g[:, :, : w // 2].mean((1, 2)) - g[:, :, w // 2 :].mean((1, 2))) + np.abs(g[:, : h // 2].mean((1, 2)) - g[:, h // 2 :].mean((1, 2)))
    left, right = g[:, :, : w // 2], g[:, :, w // 2 :][:, :, ::-1]
    mirrored = 1 - np.abs(left - right).mean((1, 2)) / 255 if left.shape == right.shape else np.full(n, 0.5)
    edges = canny(g)
    density = lambda part: part.sum((1, 2)) / (part[0].size + 1e-6 / 255)
    radius = min(h, w) // 10
    crossings = [(x, y) for x in (w // 3, 2 * w // 3) for y in (h // 3, 2 * h // 3)]
    thirds = sum(density(edges[:, max(0, y - radius) : min(h, y + radius), max(0, x - radius) : min(w, x + radius)]) for x, y in crossings)
    windows = [edges[:, h // 3 * a - 20 : h // 3 * a + 20, w // 3 * b - 20 : w // 3 * b + 20] for a in (1, 2) for b in (1, 2)]
    window_share = sum(255 * x.sum((1, 2)) for x in windows if x[0].size) / (255 * 40 * 40 * 4 + 1)
    bands = [edges[:, 2 * h // 3 :], edges[:, h // 3 : 2 * h // 3], edges[:, : h // 3]]
    long, longer = [], []
    for e in edges:
        some = int(e.sum()) >= 100
        found = segments(e, 100, min(h, w) // 4) if some else []
        long.append(min(_slanted(found) / 10, 1.0) if found else 0.3)
        longer.append(len(segments(e, 100, min(h, w) // 3)) if some else 0)
    return {
        "sharpness": clamp((laplacian.var((1, 2)) - 100) / 1900), "exposure": clamp(exposure), "artifacts": blocks, "balance": clamp(1 - sides / 255 / 2),
        "off_centre": clamp(2 * np.hypot(cx - w / 2, cy - h / 2) / np.hypot(w / 2, h / 2)), "busyness": 1 - clamp(3 * (spectrum * far).sum((1, 2)) / (spectrum.sum((1, 2)) + 1e-6)),
        "focal_x": cx / w, "focal_y": cy / h, "mirrored": mirrored, "edge_ratio": edges.mean((1, 2)), "thirds": clamp(2 * thirds), "window_share": window_share,
        "depth": clamp(100 * np.var([density(b) for b in bands], axis=0)), "band_depth": np.minimum(np.std([255 * b.mean((1, 2)) for b in bands], axis=0) / 50, 1.0),
        "leading_lines": np.array(long), "n_lines": np.array(longer, np.int64),
    }


MEASURES = "sharpness double, exposure double, artifacts double, balance double, off_centre double, busyness double, focal_x double, focal_y double, mirrored double, edge_ratio double, thirds double, window_share double, depth double, band_depth double, leading_lines double, n_lines long"


def _stacked(images: pd.Series, width: pd.Series, channels: int, work: Callable[[np.ndarray], pd.DataFrame]) -> pd.DataFrame:
    """The rows that `work` gives for stacks of equal shapes, in the order of the images."""
    shapes = pd.Series([(len(x), int(w)) for x, w in zip(images, width, strict=True)])
    parts = []
    for (values, w), some in shapes.groupby(shapes, sort=False):
        step = max(1, TOGETHER // max(1, values))
        for low in range(0, len(some), step):
            at = some.index[low : low + step]
            stack = np.stack([images.iloc[k] for k in at]).astype(np.float64)
            stack = stack.reshape(len(at), -1, w) if channels == 1 else stack.reshape(len(at), -1, w, channels)
            parts.append(work(stack).set_index(at))
    return pd.concat(parts).sort_index() if parts else work(np.zeros((0, 1, 1) if channels == 1 else (0, 1, 1, channels)))


def grey_measures(pixels: Column, width: Column) -> Column:
    """A struct of MEASURES of each grey image."""

    def run(images: pd.Series, widths: pd.Series) -> pd.DataFrame:
        names = [c.split()[0] for c in MEASURES.split(", ")]
        return _stacked(images, widths, 1, lambda s: pd.DataFrame(measures(s) if len(s) else {c: [] for c in names}, columns=names))

    return F.pandas_udf(run, MEASURES)(pixels, width)


# ---------------------------------------------------------------- sizes and colours


def _lanczos(size: int, wanted: int) -> np.ndarray:
    """The weights by which `size` samples give `wanted` ones, with a window of three lobes that
    widens as the samples are thinned out."""
    scale = size / wanted
    wide = max(scale, 1.0)
    centre = (np.arange(wanted)[:, None] + 0.5) * scale
    x = (np.arange(size)[None] + 0.5 - centre) / wide
    weights = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
    return weights / weights.sum(1, keepdims=True)


def resize(images: np.ndarray, width: int, height: int) -> np.ndarray:
    """A stack (n, h, w[, channels]) in another size, as whole numbers from 0 to 255."""
    across = np.clip(np.rint(np.einsum("wx,nhx...->nhw...", _lanczos(images.shape[2], width), images)), 0, 255)
    return np.clip(np.rint(np.einsum("hy,nyw...->nhw...", _lanczos(images.shape[1], height), across)), 0, 255)


def grey(rgb: np.ndarray) -> np.ndarray:
    return np.rint(rgb @ np.array([0.299, 0.587, 0.114]))


def blur(g: np.ndarray) -> np.ndarray:
    """Gaussian of 5 x 5 with deviation 2, borders mirrored, as whole numbers."""
    k = np.exp(-((np.arange(5) - 2) ** 2) / 8.0)
    k /= k.sum()
    p = np.pad(g, ((0, 0), (2, 2), (2, 2)), mode="reflect")
    rows = sum(k[j] * p[:, j : j + g.shape[1]] for j in range(5))
    return np.rint(sum(k[j] * rows[:, :, j : j + g.shape[2]] for j in range(5)))


def symmetry_scores(rgb: np.ndarray, compat: bool = False) -> np.ndarray:
    """exp(-mse / 1000) between blurred 64 x 64 images and their mirror images. With compat,
    differences and squares wrap at 256 as unsigned bytes do."""
    g = blur(grey(resize(rgb, 64, 64)))
    d = g - g[:, :, ::-1]
    square = np.mod(np.mod(d, 256) ** 2, 256) if compat else d * d
    return np.exp(-square.mean((1, 2)) / 1000.0)


_TO_XYZ = np.array([[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]])  # fixed values
_WHITE = np.array([0.950456, 1.0, 1.088754])  # fixed values


def rgb_to_lab(rgb: np.ndarray) -> np.ndarray:
    """0..255 to eight-bit LAB: L over 255, a and b from 128."""
    v = rgb / 255.0
    linear = np.where(v > 0.04045, ((v + 0.055) / 1.055) ** 2.4, v / 12.92)
    x = linear @ _TO_XYZ.T / _WHITE
    f = np.where(x > 0.008856, np.cbrt(x), 7.787 * x + 16 / 116)
    lightness = np.where(x[..., 1] > 0.008856, 116 * f[..., 1] - 16, 903.3 * x[..., 1])
    lab = np.stack([lightness * 255 / 100, 500 * (f[..., 0] - f[..., 1]) + 128, 200 * (f[..., 1] - f[..., 2]) + 128], -1)
    return np.clip(np.rint(lab), 0, 255)


def lab_to_rgb(lab: np.ndarray) -> np.ndarray:
    """Eight-bit LAB to 0..255."""
    lightness, a, b = lab[..., 0] * 100 / 255, lab[..., 1] - 128, lab[..., 2] - 128
    fy = np.where(lightness > 903.3 * 0.008856, (lightness + 16) / 116, 7.787 * lightness / 903.3 + 16 / 116)
    f = np.stack([fy + a / 500, fy, fy - b / 200], -1)
    x = np.where(f > 6 / 29, f**3, (f - 16 / 116) / 7.787) * _WHITE
    linear = np.clip(x @ np.linalg.inv(_TO_XYZ).T, 0, 1)
    v = np.where(linear > 0.0031308, 1.055 * linear ** (1 / 2.4) - 0.055, 12.92 * linear)
    return np.clip(np.rint(v * 255), 0, 255)


def lab_hex(lab: np.ndarray) -> str:
    """A centre, cut to whole numbers, as #rrggbb."""
    return "#%02x%02x%02x" % tuple(int(c) for c in lab_to_rgb(np.floor(np.asarray(lab, np.float64))))


def kmeans(points: np.ndarray, k: int = 5, seed: int = 42, starts: int = 10, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Centres and sizes of each set of a stack (n, points, dims): the best of several starts that
    spread their first centres. All sets draw the same random numbers, so each has the same outcome
    in any company."""
    n, p, _ = points.shape
    draws = np.random.default_rng(seed).random((starts, k))
    best = np.full(n, np.inf), np.zeros((n, k, points.shape[2])), np.zeros((n, k), np.int64)
    row = np.arange(n)
    for u in draws:
        centres = points[:, int(u[0] * p)][:, None]
        far = ((points - centres) ** 2).sum(-1)
        for j in range(1, k):
            chance = np.cumsum(far, 1)
            at = np.minimum((chance <= u[j] * chance[:, -1:]).sum(1), p - 1)
            centres = np.concatenate([centres, points[row, at][:, None]], 1)
            far = np.minimum(far, ((points - points[row, at][:, None]) ** 2).sum(-1))
        for _ in range(rounds):
            distance = ((points[:, :, None] - centres[:, None]) ** 2).sum(-1)
            owner = distance.argmin(2)
            mine = (owner[:, :, None] == np.arange(k)).astype(np.float64)
            count = mine.sum(1)
            moved = np.where(count[:, :, None] > 0, np.einsum("npk,npd->nkd", mine, points) / np.maximum(count, 1)[:, :, None], centres)
            if np.allclose(moved, centres, atol=1e-4):
                break
            centres = moved
        cost = distance.min(2).sum(1)
        better = cost < best[0] - 1e-9
        best[0][better], best[1][better], best[2][better] = cost[better], centres[better], count[better].astype(np.int64)
    return best[1], best[2]


PALETTE = "colours array<string>, sizes array<long>, hue int, diversity double"


def palettes(rgb: np.ndarray, side: int | None = 100, k: int = 5) -> pd.DataFrame:
    """Five colours of each image of a stack, in eight-bit LAB, largest first, after a resize to
    side x side; the hue of the largest, and the mean distance of all pairs over 100."""
    lab = rgb_to_lab(resize(rgb, side, side) if side else rgb).reshape(len(rgb), -1, 3)
    rows = []
    for low in range(0, len(lab), step := max(1, TOGETHER // max(1, lab.shape[1] * k))):
        centres, sizes = kmeans(lab[low : low + step], k)
        for c, s in zip(centres, sizes, strict=True):
            order = np.argsort(-s, kind="stable")
            c, s = c[order], s[order]
            pairs = [np.linalg.norm(c[i] - c[j]) for i in range(k) for j in range(i + 1, k)]
            hue = int(np.arctan2(c[0][2] - 128, c[0][1] - 128) * 180 / np.pi) % 360
            rows.append(([lab_hex(x) for x in c], s.tolist(), hue, min(float(np.mean(pairs)) / 100, 1.0)))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in PALETTE.split(", ")])


def palette(pixels: Column, width: Column, side: int | None = 100) -> Column:
    """A struct PALETTE of each image of three values a pixel."""

    def run(images: pd.Series, widths: pd.Series) -> pd.DataFrame:
        return _stacked(images, widths, 3, lambda s: palettes(s, side))

    return F.pandas_udf(run, PALETTE)(pixels, width)


def symmetry64(pixels: Column, width: Column, compat: bool = False) -> Column:
    """The symmetry of images of three values a pixel, after a resize to 64 x 64 and a blur."""

    def run(images: pd.Series, widths: pd.Series) -> pd.Series:
        return _stacked(images, widths, 3, lambda s: pd.DataFrame({"s": symmetry_scores(s, compat)}))["s"]

    return F.pandas_udf(run, "double")(pixels, width)


def made_up_image(k: int, width: int = 2560, height: int = 1440) -> np.ndarray:
    """A made-up image (height, width, 3) of gradients and boxes, for timing: the same for a number k."""
    rng = np.random.default_rng(k)
    y, x = np.mgrid[:height, :width]
    image = np.stack([x * 255 / width, y * 255 / height, (x + y) * 255 / (width + height)], -1)
    for _ in range(20):
        a, b = int(rng.integers(0, height - 8)), int(rng.integers(0, width - 8))
        image[a : a + int(rng.integers(8, height // 2)), b : b + int(rng.integers(8, width // 2))] = rng.integers(0, 256, 3)
    return image.astype(np.uint8)
