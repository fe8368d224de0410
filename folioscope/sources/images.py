"""Page images: arrays of grey values in, cleaned arrays out.

Steps always run in one order: upscale, denoise, shadow, contrast, deskew, binarize.
They work on 8-bit grey arrays. Plain PNG files are decoded here, others by an imaging
library where a worker has one.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SIGNATURE = b"\x89PNG\r\n\x1a\n"
SUFFIXES = ("png", "jpg", "jpeg")
STEPS = ("upscale", "denoise", "shadow", "contrast", "deskew", "binarize")


def channels_of(png: bytes) -> np.ndarray:
    """(height, width, channels) of a PNG file of 8 bits a channel that is not interlaced, by its definition."""
    if png[:8] != SIGNATURE:
        raise ValueError("not a PNG file")
    at, packed, head = 8, [], b""
    while at + 8 <= len(png):
        size, kind = struct.unpack_from(">I4s", png, at)
        body = png[at + 8 : at + 8 + size]
        head = body if kind == b"IHDR" else head
        packed += [body] * (kind == b"IDAT")
        at += size + 12
    wide, high, depth, color, _, _, laced = struct.unpack(">IIBBBBB", head)
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(color)
    if depth != 8 or laced or not channels:
        raise ValueError("a kind of PNG file that is not read here")
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(high, 1 + wide * channels)
    out = np.zeros((high + 1, wide + 1, channels), np.uint8)  # a line and a pixel of zeros before all
    for y, (kind, line) in enumerate(zip(raw[:, 0].tolist(), raw[:, 1:].reshape(high, wide, channels), strict=True), 1):
        if kind in (0, 2):
            out[y, 1:] = line + (out[y - 1, 1:] if kind else 0)
        elif kind == 1:
            out[y, 1:] = np.cumsum(line, 0, dtype=np.uint64).astype(np.uint8)
        else:
            for x in range(1, wide + 1):
                a, b, c = (out[p].astype(np.int32) for p in ((y, x - 1), (y - 1, x), (y - 1, x - 1)))
                near = np.abs(np.stack([b - c, a - c, a + b - 2 * c]))
                guess = (a + b) // 2 if kind == 3 else np.choose(near.argmin(0), [a, b, c])
                out[y, x] = line[x - 1] + guess.astype(np.uint8)
    return out[1:, 1:]


def decoded(png: bytes) -> np.ndarray:
    """Grey values of a PNG file that channels_of() reads."""
    shown = channels_of(png).astype(np.float64)
    grey = shown[..., 0] if shown.shape[2] < 3 else shown[..., :3] @ np.array([0.299, 0.587, 0.114])
    return np.rint(grey).astype(np.uint8)


def encoded(grey: np.ndarray) -> bytes:
    """A PNG file of grey values."""
    high, wide = grey.shape
    lines = np.zeros((high, wide + 1), np.uint8)
    lines[:, 1:] = grey
    parts = ((b"IHDR", struct.pack(">IIBBBBB", wide, high, 8, 0, 0, 0, 0)), (b"IDAT", zlib.compress(lines.tobytes())), (b"IEND", b""))
    return SIGNATURE + b"".join(struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d)) for k, d in parts)


def preprocessed(png: Column, steps: str) -> Column:
    """PNG files with the named steps applied, in their fixed order; as they are if they cannot be read."""
    named = ",".join(steps_of(steps))

    @F.pandas_udf("binary")
    def apply(files: pd.Series) -> pd.Series:
        return files.map(lambda x: None if x is None else cleaned_file(bytes(x), named))

    return apply(png)


def as_png(content: bytes) -> bytes:
    """An image as a PNG file; as it is where no imaging library can read it."""
    if content[:8] == SIGNATURE:
        return content
    try:
        import io

        from PIL import Image

        out = io.BytesIO()
        with Image.open(io.BytesIO(content)) as image:
            image.convert("RGB").save(out, "PNG")
        return out.getvalue()
    except Exception:  # noqa: BLE001 - no library, or not an image it knows
        return content


def cleaned_file(png: bytes, steps: str) -> bytes:
    """A PNG file with the steps applied; as it is if it cannot be read here."""
    try:
        return encoded(cleaned(decoded(png), steps))
    except (ValueError, TypeError, struct.error, zlib.error):
        return png


def _worked(png: bytes, work: Callable[[np.ndarray], np.ndarray]) -> bytes:
    try:
        return encoded(work(decoded(png)))
    except (ValueError, TypeError, struct.error, zlib.error):
        return png


def sharpened_file(png: bytes) -> bytes:
    """A PNG file sharpened; as it is if it cannot be read here."""
    return _worked(png, sharpened)


def enlarged_file(png: bytes, scale: int) -> bytes:
    """A PNG file with each pixel `scale` by `scale`, sharpened; as it is if it cannot be read here."""
    return _worked(png, lambda grey: sharpened(np.kron(grey, np.ones((scale, scale), grey.dtype))))


def page_files(content: bytes, suffix: str, steps: str = "") -> list[bytes]:
    """Images of a scan's pages, those of a PDF file or the image itself, with the steps applied."""
    pages = pages_as_they_are(content, suffix)
    return [cleaned_file(x, steps) for x in pages] if steps else pages


def pages_as_they_are(content: bytes, suffix: str) -> list[bytes]:
    if suffix == "pdf":
        from folioscope.sources.pdf import rendered

        return [as_png(x) for x in rendered(content)]
    return [as_png(content)]


def steps_of(text: str) -> tuple[str, ...]:
    """The steps named in a comma-separated text, in their fixed order."""
    asked = {s.strip().lower() for s in text.split(",") if s.strip()}
    if unknown := asked - set(STEPS):
        raise ValueError(f"unknown steps: {', '.join(sorted(unknown))}")
    return tuple(s for s in STEPS if s in asked)


def upscaled(grey: np.ndarray, least: int = 1000) -> np.ndarray:
    """Whole-number enlargement until the shorter side has `least` pixels, twice at most."""
    k = 1 if min(grey.shape) >= least else 2
    return np.kron(grey, np.ones((k, k), grey.dtype))


def _windows(grey: np.ndarray, radius: int) -> np.ndarray:
    padded = np.pad(grey, radius, mode="edge")
    return np.lib.stride_tricks.sliding_window_view(padded, (2 * radius + 1, 2 * radius + 1))


def denoised(grey: np.ndarray) -> np.ndarray:
    """Median of each 3 x 3 neighbourhood."""
    return np.median(_windows(grey, 1), axis=(2, 3)).astype(np.uint8)


def _box_mean(grey: np.ndarray, radius: int) -> np.ndarray:
    padded = np.pad(grey.astype(np.float64), radius + 1, mode="edge")
    total = padded.cumsum(0).cumsum(1)
    n = 2 * radius + 1
    return (total[n:-1, n:-1] - total[:-n - 1, n:-1] - total[n:-1, :-n - 1] + total[:-n - 1, :-n - 1]) / (n * n)


def flattened(grey: np.ndarray, radius: int = 25) -> np.ndarray:
    """Divided by its local background, so shadows go."""
    background = np.maximum(_box_mean(grey, radius), 1)
    return np.clip(grey / background * 200, 0, 255).astype(np.uint8)


#: Tiles a side and clip limit of contrast, block and offset of binarizing, greatest angle and step of turning.
TILES, CLIP, BLOCK, OFFSET, MOST_DEGREES, STEP_DEGREES = 8, 2.0, 35, 11, 10.0, 0.5


def tile_maps(grey: np.ndarray, tiles: int, clip: float) -> tuple[np.ndarray, int, int]:
    """(maps, tile height, tile width): for each tile the new value of each grey value. A tile's histogram
    is cut at `clip` times its mean; what is cut off is dealt to all values evenly, and running
    sums of that are the map. The image is mirrored at its ends to whole tiles."""
    high, wide = (-(-n // tiles) for n in grey.shape)
    padded = np.pad(grey, ((0, high * tiles - grey.shape[0]), (0, wide * tiles - grey.shape[1])), mode="symmetric")
    tile = np.arange(high * tiles)[:, None] // high * tiles + np.arange(wide * tiles)[None, :] // wide
    counts = np.bincount((tile * 256 + padded).ravel(), minlength=tiles * tiles * 256).reshape(tiles, tiles, 256)
    most = max(1, int(clip * high * wide / 256))
    over = np.maximum(counts - most, 0).sum(-1)
    share, rest = over // 256, over % 256
    counts = np.minimum(counts, most) + share[..., None]
    # of the rest one each goes to values at even steps
    step = np.maximum(256 // np.maximum(rest, 1), 1)
    values = np.arange(256)
    counts = counts + ((values % step[..., None] == 0) & (values // step[..., None] < rest[..., None]))
    return np.clip(np.rint(counts.cumsum(-1) * (255.0 / (high * wide))), 0, 255), high, wide


def equalized(grey: np.ndarray, tiles: int = TILES, clip: float = CLIP) -> np.ndarray:
    """Contrast evened out tile by tile, within the clip limit; between the middles of tiles their maps blend."""
    maps, high, wide = tile_maps(grey, tiles, clip)

    def between(n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = (np.arange(n) + 0.5) / size - 0.5
        low = np.floor(at).astype(int)
        return np.clip(low, 0, tiles - 1), np.clip(low + 1, 0, tiles - 1), at - low

    y0, y1, v = between(grey.shape[0], high)
    x0, x1, h = between(grey.shape[1], wide)
    value = lambda y, x: maps[y[:, None], x[None, :], grey]
    above = value(y0, x0) * (1 - h) + value(y0, x1) * h
    below = value(y1, x0) * (1 - h) + value(y1, x1) * h
    return np.clip(np.rint(above * (1 - v[:, None]) + below * v[:, None]), 0, 255).astype(np.uint8)


def turned(grey: np.ndarray, degrees: float, fill: float = 255.0, grow: bool = False) -> np.ndarray:
    """The image turned about its middle, counter-clockwise, values between pixels blended; what comes
    from outside is `fill`. With `grow` the canvas holds all of it, else it keeps its size."""
    angle = np.radians(degrees)
    cos, sin = np.cos(angle), np.sin(angle)
    high, wide = grey.shape
    size = (int(np.ceil(abs(high * cos) + abs(wide * sin) - 1e-9)), int(np.ceil(abs(wide * cos) + abs(high * sin) - 1e-9))) if grow else grey.shape
    y, x = (np.arange(n) - (n - 1) / 2 for n in size)
    # where each pixel comes from, in an image with a margin of two pixels of fill
    sy = np.clip(y[:, None] * cos + x[None, :] * sin + (high - 1) / 2, -2, high + 1) + 2
    sx = np.clip(x[None, :] * cos - y[:, None] * sin + (wide - 1) / 2, -2, wide + 1) + 2
    padded = np.pad(grey.astype(np.float64), 2, constant_values=fill)
    y0, x0 = np.minimum(sy.astype(int), high + 2), np.minimum(sx.astype(int), wide + 2)
    v, h = sy - y0, sx - x0
    above = padded[y0, x0] * (1 - h) + padded[y0, x0 + 1] * h
    below = padded[y0 + 1, x0] * (1 - h) + padded[y0 + 1, x0 + 1] * h
    return np.rint(above * (1 - v) + below * v).astype(np.uint8)


def skew_of(grey: np.ndarray, most: float = MOST_DEGREES, step: float = STEP_DEGREES, side: int = 400) -> float:
    """The angle to turn by, at which the sums of the rows of ink vary most; of equal ones the least; 0 if they go on rising beyond `most`. Lines of
    text are seen as well in an image whose longer side has `side` pixels and a few more."""
    k = max(1, max(grey.shape) // side)
    ink = np.where(grey > otsu(grey), 0, 255).astype(np.float64)
    ink = ink[: ink.shape[0] // k * k, : ink.shape[1] // k * k].reshape(ink.shape[0] // k, k, ink.shape[1] // k, k).mean((1, 3))
    sharpness = lambda a: turned(ink, a, 0.0).sum(1, dtype=np.float64).var()
    known = {float(a): sharpness(a) for a in np.arange(-most, most + step / 2, step)}
    best = max(known, key=lambda a: (known[a], -abs(a)))
    # at an end it is a peak only if it falls off beyond; an image without lines may rise on and on
    beyond = best + np.copysign(step, best)
    return 0.0 if abs(beyond) > most and sharpness(beyond) >= known[best] else best


def deskewed(grey: np.ndarray, most: float = MOST_DEGREES) -> np.ndarray:
    """Turned by the angle of its lines, on a canvas that holds all of it."""
    angle = skew_of(grey, most)
    return grey if abs(angle) < 1e-6 else turned(grey, angle, grow=True)


def otsu(grey: np.ndarray) -> int:
    """The threshold that parts the histogram with the largest variance between classes."""
    n = np.bincount(grey.ravel(), minlength=256).astype(float)
    below, total = n.cumsum(), (n * np.arange(256)).cumsum()
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        gap = total / below - (total[-1] - total) / above
        between = np.nan_to_num(below * above * gap * gap)
    return int(between.argmax())


def gaussian_mean(grey: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Means of block x block neighbourhoods with the weights of a bell curve, ends repeated."""
    sigma = 0.3 * ((block - 1) * 0.5 - 1) + 0.8
    bell = np.exp(-((np.arange(block) - block // 2) ** 2) / (2 * sigma * sigma))
    bell /= bell.sum()
    out = np.pad(grey.astype(np.float64), block // 2, mode="edge")
    out = sum(w * out[k : k + grey.shape[0]] for k, w in enumerate(bell))
    return sum(w * out[:, k : k + grey.shape[1]] for k, w in enumerate(bell))


def binarized(grey: np.ndarray, block: int = BLOCK, offset: float = OFFSET) -> np.ndarray:
    """White where a pixel is lighter than its neighbourhood's mean less `offset`, else black."""
    return np.where(grey > np.rint(gaussian_mean(grey, block)) - offset, 255, 0).astype(np.uint8)


def sharpened(grey: np.ndarray, amount: float = 1.5, block: int = 7) -> np.ndarray:
    """The difference from its neighbourhood's mean added to each pixel."""
    return np.clip(np.rint(grey + amount * (grey - gaussian_mean(grey, block))), 0, 255).astype(np.uint8)


WORK = dict(zip(STEPS, (upscaled, denoised, flattened, equalized, deskewed, binarized), strict=True))


def cleaned(grey: np.ndarray, steps: str) -> np.ndarray:
    for name in steps_of(steps):
        grey = WORK[name](grey)
    return grey
