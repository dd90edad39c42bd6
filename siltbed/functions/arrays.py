"""Column expressions over arrays of numbers: histograms, correlation, fingerprints, interval arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)


def product_sum(xs: Column, ys: Column) -> Column:
    return total(F.zip_with(xs, ys, lambda x, y: x * y))


def correlation(xs: Column, ys: Column) -> Column:
    """Normalised cross-correlation; 0 where either side hardly varies."""
    n = F.size(xs)
    mx, my = total(xs) / n, total(ys) / n
    vx, vy = product_sum(xs, xs) / n - mx * mx, product_sum(ys, ys) / n - my * my
    return F.when((vx < 1e-6) | (vy < 1e-6), 0.0).otherwise((product_sum(xs, ys) / n - mx * my) / F.sqrt(vx * vy))


def bhattacharyya(xs: Column, ys: Column) -> Column:
    """Distance of two non-negative histograms, 0 to 1."""
    overlap = total(F.zip_with(xs, ys, lambda x, y: F.sqrt(x * y))) / F.sqrt(total(xs) * total(ys))
    return F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - overlap))


def fingerprint_similarity(left: Column, right: Column, max_offset: int = 12, least: int = 16) -> Column:
    """Best bit agreement of two arrays of unsigned 32-bit numbers (as long) over small shifts; 0 if none overlaps enough."""

    def at(offset: Column) -> Column:
        a = F.slice(left, F.greatest(offset, F.lit(0)) + 1, F.greatest(F.size(left), F.lit(1)))
        b = F.slice(right, F.greatest(-offset, F.lit(0)) + 1, F.greatest(F.size(right), F.lit(1)))
        n = F.least(F.size(a), F.size(b))
        wrong = F.aggregate(
            F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
            F.lit(0).cast("long"),
            lambda acc, x: acc + x,
        )
        return F.when(n >= least, F.lit(1.0) - wrong / (n * 32.0)).otherwise(0.0)

    shifts = F.sequence(F.lit(-max_offset), F.lit(max_offset))
    return F.greatest(F.lit(0.0), F.array_max(F.transform(shifts, at)))


def difference_hash(grey: Column, width: int = 9, height: int = 8) -> Column:
    """One bit for each horizontal neighbour pair of a row-major grey grid: left brighter than right."""
    places = F.sequence(F.lit(0), F.lit((width - 1) * height - 1))

    def bit(k: Column) -> Column:
        at = F.floor(k / (width - 1)).cast("int") * width + k % (width - 1) + 1
        return F.element_at(grey, at) > F.element_at(grey, at + 1)

    # The top bit may be set: shift and or work on longs as on unsigned numbers.
    return F.aggregate(
        F.transform(places, bit),
        F.lit(0).cast("long"),
        lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(F.when(b, 1).otherwise(0).cast("long")),
    )


def overlaps(start_a, end_a, start_b, end_b, slack: float = 0.0) -> Column:
    """Intervals that share more than ``slack``."""
    return (end_a > start_b + slack) & (start_a < end_b - slack)


def validity_overlaps(low: Column, high: Column, start: Column, end: Column) -> Column:
    """Closed intervals; a missing end is open."""
    return ~(F.coalesce(high < start, F.lit(False)) | F.coalesce(low > end, F.lit(False)))


def month_delta(a: Column, b: Column) -> Column:
    d = F.pmod(F.abs(a - b), F.lit(12))
    return F.least(d, F.lit(12) - d)


def worst(levels: Column, order: tuple[str, ...]) -> Column:
    """The level of an array that stands last in ``order``."""
    ranks = F.create_map(*[F.lit(x) for i, name in enumerate(order) for x in (name, i)])
    top = F.array_max(F.transform(levels, lambda x: F.try_element_at(ranks, x)))
    return F.element_at(F.array(*[F.lit(x) for x in order]), top + 1)


# Parts of a picture (top, bottom, left, right shares): the four halves, the middle and the whole.
PANELS = ((0.0, 1.0, 0.0, 0.5), (0.0, 1.0, 0.5, 1.0), (0.0, 0.5, 0.0, 1.0), (0.5, 1.0, 0.0, 1.0), (0.12, 0.88, 0.12, 0.88), (0.0, 1.0, 0.0, 1.0))


def panel_places(rows: int, cols: int, panel: tuple[float, float, float, float], probe: int) -> list[int]:
    """Places in a row-wise grid that a part of it shows at probe by probe cells, each the nearest cell's."""
    top, bottom, left, right = panel
    r0, c0 = min(rows - 1, int(rows * top)), min(cols - 1, int(cols * left))
    high, wide = max(r0 + 1, min(rows, int(rows * bottom))) - r0, max(c0 + 1, min(cols, int(cols * right))) - c0
    return [(r0 + y * high // probe) * cols + c0 + x * wide // probe for y in range(probe) for x in range(probe)]


def shown(grid: Column, places: list[int]) -> Column:
    return F.transform(F.array(*[F.lit(p) for p in places]), lambda p: F.get(grid, p))


def containment(a: Column, b: Column, rows: int, cols: int, probe: int, least: float = 0.82) -> Column:
    """Struct (kind, score): whether a part of ``a`` looks like the whole of ``b`` (a_contains_b) or the other way round.

    Grids are arrays of numbers, row by row. The score is the best correlation of a part with the other grid; equal
    scores speak for ``a``. Below ``least``, or where either hardly varies, the kind is none.
    """
    whole = panel_places(rows, cols, PANELS[-1], probe)

    def best(holder: Column, held: Column) -> Column:
        return F.greatest(F.lit(0.0), *[correlation(shown(holder, panel_places(rows, cols, p, probe)), shown(held, whole)) for p in PANELS])

    def decided(s: Column) -> Column:
        kind = F.when((s["ab"] >= s["ba"]) & (s["ab"] >= least), "a_contains_b").when((s["ba"] > s["ab"]) & (s["ba"] >= least), "b_contains_a").otherwise("none")
        return F.struct(kind.alias("kind"), F.greatest(s["ab"], s["ba"]).alias("score"))

    # One element, so that the scores are computed once.
    return F.transform(F.array(F.struct(best(a, b).alias("ab"), best(b, a).alias("ba"))), decided)[0]
