"""Table, page and drawing geometry as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.arrays import bound

#: Points, characters and scale of the layouts.
CELL_WEIGHT = (4, 48)
POINTS = {"minimum": 20.0, "hard": 9.0}
GRID = 1000.0
#: Sums of widths may miss the space there is by so much, as a share, through rounding.
SLACK = 1e-9
DPI = 200.0


def column_weights(rows: Column) -> Column:
    """For each column of a table (array of rows of cells) the longest cell, within CELL_WEIGHT."""
    low, high = CELL_WEIGHT

    def weighed(n: Column) -> Column:
        return F.when(n < 1, F.array().cast("array<int>")).otherwise(
            F.transform(F.sequence(F.lit(0), n - 1), lambda c: F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(F.array_max(F.transform(rows, lambda r: F.length(F.get(r, c)))), F.lit(0)))))
        )

    return bound(F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0)), weighed)


def total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda s, x: s + x)


def scaled_widths(weights: Column, available: float, minimum: float = POINTS["minimum"], hard: float = POINTS["hard"]) -> Column:
    """Widths in proportion to the weights, none below `minimum`; too many columns shrink to `hard` at least."""

    limit = available * (1 + SLACK)

    def shared(w: Column) -> Column:
        first = bound(total(F.transform(w, lambda x: x.cast("double"))), lambda t: F.transform(w, lambda x: F.greatest(F.lit(float(minimum)), x / t * available)))
        shrunk = lambda a: bound(total(a), lambda t: F.when(t <= limit, a).otherwise(F.transform(a, lambda x: F.greatest(F.lit(float(hard)), x * (available / t)))))
        forced = lambda a: F.when(total(a) > limit, F.array_repeat(F.lit(float(hard)), F.size(a))).otherwise(a)
        fits = lambda a: F.when(total(a) <= limit, a).otherwise(bound(shrunk(a), forced))
        return F.when(total(F.transform(w, lambda x: x.cast("double"))) <= 0, F.transform(w, lambda x: F.lit(float(available)))).otherwise(bound(first, fits))

    return bound(weights, shared)


def lines_needed(text: Column, width: Column, font_size: Column) -> Column:
    """Lines that a text takes, each source line one at least, at 0.52 font sizes a character."""
    fit = F.greatest(F.lit(4), F.floor(width / (font_size * 0.52)).cast("int"))
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.greatest(F.lit(1), F.ceil(F.length(x) / fit).cast("int")))
    return F.aggregate(lines, F.lit(0), lambda s, x: s + x)


def box_inches(x: Column, y: Column, width: Column, height: Column, page_width: Column, page_height: Column, thin: Column | None = None) -> Column:
    """(left, bottom, width, height) in inches of a box given on a 0..1000 grid from the top
    left, on a page of so many pixels; lines and connectors (`thin`) are 0.01 wide at least."""
    pw, ph = page_width / DPI, page_height / DPI
    w, h = width / GRID * pw, height / GRID * ph
    least = F.when(F.coalesce(thin, F.lit(False)), 0.01).otherwise(0.0) if thin is not None else F.lit(0.0)
    return F.struct(
        (x / GRID * pw).alias("left"),
        (ph - y / GRID * ph - h).alias("bottom"),
        F.greatest(w, least).alias("width"),
        F.greatest(h, least).alias("height"),
    )


def image_cm(width_px: Column, height_px: Column, bbox: Column | None = None, area: tuple[float, float] = (17.0, 25.7), most: tuple[float, float] = (17.0, 24.0), dpi: float = 150.0) -> Column:
    """(width, height) in cm: the region's share of the text area at the image's own ratio, or the natural size."""
    natural_w, natural_h = width_px / dpi * 2.54, height_px / dpi * 2.54
    scale = F.least(F.lit(most[0]) / natural_w, F.lit(most[1]) / natural_h, F.lit(1.0))
    natural = F.struct((natural_w * scale).alias("width"), (natural_h * scale).alias("height"))
    known = (width_px > 0) & (height_px > 0)
    if bbox is None:
        return F.when(known, natural)
    w, h = (F.get(bbox, 2) - F.get(bbox, 0)) * area[0], (F.get(bbox, 3) - F.get(bbox, 1)) * area[1]
    ratio = width_px / height_px
    fitted = F.struct(F.when(ratio > w / h, w).otherwise(h * ratio).alias("width"), F.when(ratio > w / h, w / ratio).otherwise(h).alias("height"))
    usable = F.coalesce((F.size(bbox) == 4) & (F.get(bbox, 2) > F.get(bbox, 0)) & (F.get(bbox, 3) > F.get(bbox, 1)), F.lit(False))
    return F.when(known & usable, fitted).when(known, natural)


def fitted(width: Column, height: Column, most_width: Column, most_height: Column) -> Column:
    """(width, height) scaled into a box at their own ratio; the box itself if they are not positive."""
    scale = F.least(most_width / width, most_height / height)
    whole = F.struct(most_width.cast("double").alias("width"), most_height.cast("double").alias("height"))
    return F.when((width > 0) & (height > 0), F.struct((width * scale).alias("width"), (height * scale).alias("height"))).otherwise(whole)


def on_sheet(index: Column, count: Column, width: Column, height: Column, cell_width: Column, cell_height: Column, columns: Column | None = None) -> Column:
    """(left, bottom, width, height) of the index-th (from 0) of `count` pictures tiled on one
    sheet of equal cells, row by row from the top, each centred in its cell."""
    across = F.greatest(F.lit(1), F.floor(F.sqrt(count) + 0.999)) if columns is None else F.greatest(F.lit(1), columns)
    down = F.greatest(F.lit(1), F.floor(count / across + 0.999))
    row, column = F.floor(index / across), index % across

    def placed(s: Column) -> Column:
        left = column * cell_width + (cell_width - s["width"]) / 2
        bottom = (down - row - 1) * cell_height + (cell_height - s["height"]) / 2
        return F.struct(left.alias("left"), bottom.alias("bottom"), s["width"].alias("width"), s["height"].alias("height"))

    return bound(fitted(width, height, cell_width, cell_height), placed)
