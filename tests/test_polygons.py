from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.operators import polygons as spatial

#: Two islands, the first with a hole; and an area of one part with two holes.
SHAPES = [
    ("isles", "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 3, 3 3, 3 1, 1 1)), ((6 0, 7 0, 7 1, 6 1, 6 0)))"),
    ("sieve", "POLYGON((10 0,14 0,14 2,10 2,10 0),(10.5 0.5,11 0.5,11 1,10.5 1,10.5 0.5),(12 1,12.5 1,12.5 1.5,12 1.5,12 1))"),
    ("nowhere", "MULTIPOLYGON EMPTY"),
]


def covers(area, x, y):
    box = lambda a, b, c, d: a <= x < c and b <= y < d
    if area == "isles":
        return box(0, 0, 4, 4) and not box(1, 1, 3, 3) or box(6, 0, 7, 1)
    return area == "sieve" and box(10, 0, 14, 2) and not box(10.5, 0.5, 11, 1) and not box(12, 1, 12.5, 1.5)


def test_parts_and_holes(spark):
    shapes = spark.createDataFrame(SHAPES, "area string, wkt string").select("area", spatial.polygon_parts(F.col("wkt")).alias("parts"))
    dots = [(x / 4 + 0.1, y / 4 + 0.1) for x in range(-2, 60) for y in range(-2, 20)]
    got = spatial.points_in_polygons(spark.createDataFrame(dots, "x double, y double"), shapes)
    assert sorted((r.area, r.x, r.y) for r in got.collect()) == sorted((a, x, y) for a, _ in SHAPES for x, y in dots if covers(a, x, y))

    cells = [(100 * i + j, i / 2 + 0.25, j / 2 + 0.25) for i in range(-1, 30) for j in range(-1, 10)]
    shares = spatial.area_bridge(spark.createDataFrame(cells, "pgid int, lon double, lat double"), shapes).collect()
    assert {(r.area, r.pgid): round(r.share, 9) for r in shares} == {(a, c): 1.0 for a, _ in SHAPES for c, x, y in cells if covers(a, x, y)}


def test_shares_of_one_cell_add_up(spark):
    wkt = "MULTIPOLYGON (((0 0, 0.2 0, 0.2 0.5, 0 0.5, 0 0), (0.1 0.1, 0.2 0.1, 0.2 0.2, 0.1 0.2, 0.1 0.1)), ((0.3 0, 0.4 0, 0.4 0.5, 0.3 0.5, 0.3 0)))"
    shapes = spark.createDataFrame([("a", wkt)], "area string, wkt string").select("area", spatial.polygon_parts(F.col("wkt")).alias("parts"))
    (row,) = spatial.area_bridge(spark.createDataFrame([(1, 0.25, 0.25)], "pgid int, lon double, lat double"), shapes).collect()
    assert abs(row.share - (0.2 * 0.5 - 0.01 + 0.1 * 0.5) / 0.25) < 1e-12


def even_odd(parts, x, y):
    k = 0
    for rings in parts:
        for ring in rings:
            for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
                if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                    k += 1
    return k % 2 == 1


def clipped(ring, x0, y0, x1, y1):
    """The signed area of a ring in a box, by integrating its clamped height over x."""
    total = 0.0
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
        if ax == bx:
            continue
        at = lambda x: ay + (by - ay) * (x - ax) / (bx - ax)  # noqa: B023,E731
        a, b = (min(max(v, x0), x1) for v in (ax, bx))
        cuts = sorted({a, b, *(x for y in (y0, y1) if ay != by and min(a, b) < (x := ax + (y - ay) * (bx - ax) / (by - ay)) < max(a, b))})
        clamp = lambda v: min(max(v, y0), y1) - y0
        area = sum((clamp(at(p)) + clamp(at(q))) / 2 * (q - p) for p, q in zip(cuts, cuts[1:], strict=False))
        total += area if b > a else -area
    return total


def star(rng, x, y, r, n):
    import math

    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    far = [r * rng.uniform(0.3, 1) for _ in angles]
    return [(x + f * math.cos(a), y + f * math.sin(a)) for a, f in zip(angles, far, strict=True)]


def test_random_shapes_against_plain_python(spark):
    import random

    rng = random.Random(4)
    shapes = {}
    for i in range(12):
        x, y = rng.uniform(-6, 6), rng.uniform(-6, 6)
        r, n = (5.0, 60) if i % 3 == 0 else (rng.choice([0.3, 2.0, 5.0]), rng.choice([3, 8, 60]))
        outer = star(rng, x, y, r, n)
        hole = [(x + 0.05 * dx, y + 0.05 * dy) for dx, dy in rng.choice([[(0, 0), (1, 0), (1, 1)], [(0, 0), (1, 1), (1, 0)]])]
        shapes[f"s{i}"] = [[outer, hole] if i % 3 == 0 else [outer]]
    text = lambda ring: "(" + ", ".join(f"{x!r} {y!r}" for x, y in ring + ring[:1]) + ")"
    wkt = [(k, "MULTIPOLYGON (" + ", ".join("(" + ", ".join(map(text, rings)) + ")" for rings in parts) + ")", i) for i, (k, parts) in enumerate(shapes.items())]
    df = spark.createDataFrame(wkt, "area string, wkt string, no int").select("area", "no", spatial.polygon_parts(F.col("wkt")).alias("parts"))
    dots = [(i, rng.uniform(-12, 12), rng.uniform(-12, 12)) for i in range(3000)] + [(3000 + i, *p) for i, p in enumerate([(0.0, 0.0), (0.25, 0.25), (-0.5, 0.75)])]
    points = spark.createDataFrame(dots, "id int, x double, y double")
    want = sorted((i, k) for i, x, y in dots for k, parts in shapes.items() if even_odd(parts, x, y))
    assert sorted((r.id, r.area) for r in spatial.points_in_polygons(points, df).collect()) == want
    assert sorted((r.id, r.area) for r in spatial.points_in_polygons(points, df, step=3.0).collect()) == want
    last = {i: k for i, k in sorted(want, key=lambda t: int(t[1][1:]))}
    assert {r.id: r.area for r in spatial.area_of_points(points, df, ["id"], "no").collect()} == {i: last.get(i) for i, _, _ in dots}

    got = {(r.area, r.bx, r.by): r.share for r in spatial.shares(df).collect()}
    for k, parts in shapes.items():
        for bx in range(-24, 24):
            for by in range(-24, 24):
                box = (bx / 2, by / 2, bx / 2 + 0.5, by / 2 + 0.5)
                outer, *holes = (abs(clipped(ring, *box)) for ring in parts[0])
                assert abs(got.get((k, bx, by), 0.0) - (outer - sum(holes)) / 0.25) < 1e-9


def test_many_corners_stay_with_their_cells(spark):
    """A ring of many corners over many cells: the cover has each edge once for each cell it passes, not the ring."""
    import math

    n = 20_000
    ring = ", ".join(f"{20 * math.cos(t * 2 * math.pi / n)!r} {20 * math.sin(t * 2 * math.pi / n)!r}" for t in range(n))
    df = spark.createDataFrame([("round", f"POLYGON (({ring}))")], "area string, wkt string").select("area", spatial.polygon_parts(F.col("wkt")).alias("parts"))
    border, inner, kept = spatial.cover(df).agg(F.count("edges"), F.sum(F.col("edges").isNull().cast("int")), F.sum(F.size("edges"))).first()
    assert border < 400 and 4500 < inner < 5100 and kept < n + 2 * border
    assert abs(spatial.shares(df).agg(F.sum("share")).first()[0] * 0.25 - math.pi * 400) < 0.01
