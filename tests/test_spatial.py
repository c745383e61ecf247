"""Tiles, reading order, angles and the sweep against plain loops."""

import math
import random

import pytest

from lodestone.operators import spatial as SP
from pyspark.sql import functions as F

BOX = "page int, id int, l double, b double, r double, t double"


def boxes(rng, n, pages=2, most=300):
    out = []
    for i in range(n):
        x, y = rng.uniform(-50, 500), rng.uniform(-50, 700)
        out.append((rng.randrange(pages), i, x, y, x + rng.uniform(0, most), y + rng.uniform(0, most)))
    return out


@pytest.mark.parametrize("tile", [64.0, 7.0])
def test_within(spark, tile):
    rng = random.Random(1)
    inner, outer = boxes(rng, 120, most=40), boxes(rng, 60)
    want = {(i[1], o[1]) for i in inner for o in outer if i[0] == o[0] and o[2] - 2 <= (i[2] + i[4]) / 2 <= o[4] + 2 and o[3] - 2 <= (i[3] + i[5]) / 2 <= o[5] + 2}
    got = SP.within(spark.createDataFrame(inner, BOX), spark.createDataFrame(outer, BOX), ["page"], tile=tile).collect()
    assert len(got) == len(want) and {(r.id, r.box) for r in got} == want and want


def test_reading_order(spark):
    lines = spark.createDataFrame([(0, 1, 50.0, 100.0, 60.0, 110.0, "b"), (0, 2, 0.0, 101.0, 10.0, 110.0, "a"), (0, 3, 0.0, 50.0, 9.0, 60.0, "c"), (0, 4, 0.0, 900.0, 9.0, 910.0, "out"), (1, 5, 0.0, 50.0, 9.0, 60.0, "other page")], BOX + ", text string")
    assert [tuple(r) for r in SP.texts_in(lines, spark.createDataFrame([(0, 9, 0.0, 0.0, 100.0, 200.0)], BOX), ["page"]).collect()] == [(0, 9, "a b c")]


def test_angles(spark):
    turned = [(math.cos(math.radians(d)), math.sin(math.radians(d)), d) for d in range(-360, 361, 5)]
    rows = spark.createDataFrame([(a, b, d) for a, b, d in turned], "a double, b double, d int").select("d", SP.angle(F.col("a"), F.col("b")).alias("x"), SP.slanted(F.col("a"), F.col("b")).alias("s")).collect()
    for r in rows:
        want = min(r.d % 180, 180 - r.d % 180)
        assert abs(r.x - want) < 1e-6
        if want not in (15, 75):
            assert r.s == (15 <= want <= 75)


def test_sweep(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        l, b = rng.randrange(30), rng.randrange(30)
        rows.append((i % 3, i, float(l), float(b), float(l + rng.randrange(12)), float(b + rng.randrange(12))))
    want = {}
    for k, _, l, b, r, t in rows:
        want.setdefault(k, set()).update((x, y) for x in range(int(l), int(r)) for y in range(int(b), int(t)))
    assert {r.page: r.area for r in SP.union_area(spark.createDataFrame(rows, BOX), ["page"]).collect()} == {k: float(len(v)) for k, v in want.items() if v}


def test_bare_images(spark):
    images = spark.createDataFrame([(0, 1, 0.0, 0.0, 10.0, 10.0), (0, 2, 50.0, 0.0, 60.0, 10.0), (1, 3, 0.0, 0.0, 10.0, 10.0)], BOX)
    texts = spark.createDataFrame([(0, 7, 1.0, 1.0, 5.0, 3.0), (0, 8, 55.0, 5.0, 56.0, 6.0), (0, 9, 54.0, 5.0, 55.0, 6.0)], BOX)
    assert {r.page: r.bare for r in SP.bare_images(images, texts, ["page"], 1000.0).collect()} == {0: 0.1, 1: 0.1}
