"""Padded grids and stitched images, made where they are used."""

from pyspark.sql import functions as F

from tilewright.operators import tiles


def test_full_grid_is_spread(spark):
    """One tile far out: no task makes more than about SHARE places of the grid."""
    own = spark.createDataFrame([(7, 511, 3), (8, 0, 0), (9, 0, 0)], "tile_id long, row int, col int")
    grid = tiles.full_grid(own)
    sizes = [r[0] for r in grid.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 512 * 512 + 1 and max(sizes) < 2 * tiles.SHARE
    found = grid.where("tile_id is not null or (row = 511 and col = 4)").select("row", "col", "tile_id", "code", "depth").collect()
    assert sorted((r[0], r[1], r[2] or 0) for r in found) == [(0, 0, 8), (0, 0, 9), (511, 3, 7), (511, 4, 0)]
    assert grid.select("row", "col").distinct().count() == 512 * 512 and {r[4] for r in found} == {9}
    assert grid.schema["row"].dataType.simpleString() == grid.schema["code"].dataType.simpleString() == "bigint"


def test_full_grid_of_nothing(spark):
    assert tiles.full_grid(spark.createDataFrame([], "tile_id long, row int, col int")).count() == 0
    assert tiles.full_grid(spark.createDataFrame([(1, 0, 0)], "tile_id long, row int, col int")).count() == 1


def test_stitch_is_spread_and_whole(spark):
    """Tiles that lack pixels, hold one twice or a null, and pixels outside of their tile."""
    rows = [(0, 0, y, x, y * 10.0 + x) for y in range(2) for x in range(3)] + [(2, 1, 1, 2, 5.0), (2, 1, 0, 0, None), (1, 1, 0, 1, 3.0), (1, 1, 0, 1, 4.0), (1, 0, 7, 0, 9.0)]
    out = tiles.stitch(spark.createDataFrame(rows, "row int, col int, y int, x int, v double"), 2, 3, fill=-1.0)
    want = {(y, x): [-1.0] for y in range(8) for x in range(12)}
    for row, col, y, x, v in rows[:-1]:
        place = want[row * 2 + y, col * 3 + x]
        if -1.0 in place:
            place.clear()
        place.append(-1.0 if v is None else v)
    got = {}
    for y, x, v in out.collect():
        got.setdefault((y, x), []).append(v)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    wide = tiles.stitch(spark.createDataFrame([(511, 0, 0, 0, 1.0)], "row int, col int, y int, x int, v double"), 2, 2)
    sizes = [r[0] for r in wide.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 1024 * 1024 and max(sizes) < 8 * tiles.SHARE
