"""Pages as arrays of grey values, prepared for recognition engines, and the second look at a page's lower right quarter."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

TOTALS_MARK = "[SEGMENTO_TOTALES]"
# Fixed value: what stands for a quarter on which nothing was recognised.
NO_TOTALS = "[Sin texto detectado en segmento totales]"


def grey(image: np.ndarray) -> np.ndarray:
    """One byte of brightness per pixel; images of three channels are weighed as the eye does."""
    if image.ndim == 2:
        return image.astype(np.uint8)
    return np.rint(image[..., :3] @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)


def contrasted(image: np.ndarray, factor: float = 2.0) -> np.ndarray:
    """Brightness moved away from the mean."""
    mean = np.rint(image.mean())
    return np.clip(np.rint(mean + (image.astype(float) - mean) * factor), 0, 255).astype(np.uint8)


def otsu(image: np.ndarray) -> np.ndarray:
    """Black and white at the threshold that parts the brightnesses into the two most different classes."""
    n = np.bincount(image.ravel(), minlength=256).astype(float)
    below = np.cumsum(n)
    total, sums = below[-1], np.cumsum(n * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (sums[-1] * below / total - sums) ** 2 / (below * (total - below))
    return np.where(image > np.argmax(np.nan_to_num(between)), 255, 0).astype(np.uint8)


def lookup(n: np.ndarray) -> np.ndarray:
    """Table that makes a histogram even."""
    c = np.cumsum(n)
    first = c[np.flatnonzero(n)[0]] if n.any() else 0
    return np.clip(np.rint((c - first) * 255 / max(c[-1] - first, 1)), 0, 255).astype(np.uint8)


def equalised(image: np.ndarray) -> np.ndarray:
    return lookup(np.bincount(image.ravel(), minlength=256))[image]


def locally_equalised(image: np.ndarray, limit: float = 2.0, tiles: int = 8) -> np.ndarray:
    """Histograms made even by tiles, none higher than the limit times its mean; tables of neighbouring tiles are blended."""
    h, w = image.shape
    ys, xs = np.linspace(0, h, tiles + 1).astype(int), np.linspace(0, w, tiles + 1).astype(int)
    tables = np.empty((tiles, tiles, 256))
    for i in range(tiles):
        for j in range(tiles):
            part = image[ys[i] : max(ys[i + 1], ys[i] + 1), xs[j] : max(xs[j + 1], xs[j] + 1)]
            n = np.bincount(part.ravel(), minlength=256).astype(float)
            cap = max(1.0, limit * part.size / 256)
            tables[i, j] = lookup(np.minimum(n, cap) + np.maximum(n - cap, 0).sum() / 256)
    y = np.clip((np.arange(h) + 0.5) * tiles / h - 0.5, 0, tiles - 1)
    x = np.clip((np.arange(w) + 0.5) * tiles / w - 0.5, 0, tiles - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, tiles - 1), np.minimum(x0 + 1, tiles - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    at = lambda a, b: tables[a[:, None], b[None, :], image]
    out = (at(y0, x0) * (1 - fx) + at(y0, x1) * fx) * (1 - fy) + (at(y1, x0) * (1 - fx) + at(y1, x1) * fx) * fy
    return np.rint(out).astype(np.uint8)


def blurred(image: np.ndarray, size: int) -> np.ndarray:
    """Gaussian mean over size pixels each way."""
    sigma = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    k = np.exp(-((np.arange(size) - size // 2) ** 2) / (2 * sigma**2))
    k /= k.sum()
    p = np.pad(image.astype(float), size // 2, mode="edge")
    rows = sum(w * p[i : i + image.shape[0]] for i, w in enumerate(k))
    return sum(w * rows[:, i : i + image.shape[1]] for i, w in enumerate(k))


def ink(image: np.ndarray, size: int = 11, offset: float = 2.0) -> np.ndarray:
    """White where a pixel is darker than its surroundings by the offset, else black."""
    return np.where(image > blurred(image, size) - offset, 0, 255).astype(np.uint8)


def median(image: np.ndarray, size: int = 3) -> np.ndarray:
    p = np.pad(image, size // 2, mode="edge")
    return np.median(np.lib.stride_tricks.sliding_window_view(p, (size, size)), axis=(2, 3)).astype(np.uint8)


def closed(image: np.ndarray) -> np.ndarray:
    """Gaps of one pixel filled: the largest, then the smallest of two by two."""
    h, w = image.shape
    p = np.pad(image, ((1, 0), (1, 0)), mode="edge")
    grown = np.max([p[i : i + h, j : j + w] for i in (0, 1) for j in (0, 1)], axis=0)
    p = np.pad(grown, ((0, 1), (0, 1)), mode="edge")
    return np.min([p[i : i + h, j : j + w] for i in (0, 1) for j in (0, 1)], axis=0)


def skew(image: np.ndarray, most: float = 45.0) -> float:
    """Angle in degrees by which the white pixels' smallest enclosing rectangle is turned, between -most and most."""
    y, x = np.nonzero(image)
    if len(x) < 3 or np.ptp(x) == 0 or np.ptp(y) == 0:
        return 0.0
    # outline points: the leftmost and rightmost of each row are enough for the rectangle
    order = np.argsort(y, kind="stable")
    y, x = y[order], x[order]
    rows, start = np.unique(y, return_index=True)
    low, high = np.minimum.reduceat(x, start), np.maximum.reduceat(x, start)
    px, py = np.concatenate([low, high]).astype(float), np.concatenate([rows, rows]).astype(float)
    best, step, around = 0.0, most / 45, 0.0
    width = most
    while width > 0.01:
        angles = np.arange(around - width, around + width + step / 2, step)
        a = np.deg2rad(angles)[:, None]
        u, v = px * np.cos(a) + py * np.sin(a), py * np.cos(a) - px * np.sin(a)
        area = np.ptp(u, axis=1) * np.ptp(v, axis=1)
        best = around = float(angles[np.argmin(area)])
        width, step = step, step / 10
    return max(-most, min(most, best))


def turned(image: np.ndarray, degrees: float) -> np.ndarray:
    """The image turned around its middle, edges carried on."""
    h, w = image.shape
    a = np.deg2rad(degrees)
    y, x = np.mgrid[0:h, 0:w]
    y, x = y - h // 2, x - w // 2
    sx, sy = x * np.cos(a) - y * np.sin(a) + w // 2, x * np.sin(a) + y * np.cos(a) + h // 2
    return image[np.clip(np.rint(sy), 0, h - 1).astype(int), np.clip(np.rint(sx), 0, w - 1).astype(int)]


def prepared(image: np.ndarray, engine: str = "") -> np.ndarray:
    """A page for an engine: tesseract (local contrast, ink, median), easyocr (even histogram), clean (as tesseract, gaps closed, straightened), paddleocr (as it is), others (contrast and threshold)."""
    g = grey(image)
    if engine == "paddleocr":
        return image
    if engine == "easyocr":
        return equalised(g)
    if engine in ("tesseract", "tesseract4", "tesseract6"):
        return median(ink(locally_equalised(g)))
    if engine == "clean":
        p = closed(median(ink(locally_equalised(g))))
        return turned(p, skew(p))
    return otsu(contrasted(g))


def lower_right(image: np.ndarray | None) -> np.ndarray | None:
    """Right half of the lower half; None for no image or one under ten pixels either way (OCR2)."""
    if image is None or image.ndim < 2 or min(image.shape[:2]) < 10:
        return None
    return image[image.shape[0] // 2 :, image.shape[1] // 2 :]


def with_totals(recognise: Callable[[np.ndarray], list[str] | None], pages: list[np.ndarray]) -> str:
    """Lines of all pages, each followed by the totals mark and the lines of its lower right quarter (OCR1). Pages that the engine gives nothing for, and quarters too small, are passed over."""
    out: list[str] = []
    for page in pages:
        lines = recognise(page)
        if lines is None:
            continue
        out += lines
        quarter = lower_right(page)
        again = None if quarter is None else recognise(quarter)
        if again is not None:
            out += ["", TOTALS_MARK, *(again or [NO_TOTALS])]
    return "\n".join(out).strip()
