import random

from quire import schemas
from quire.operators import place

BOXES = [("corner", 0, 0, 60, 60), ("line", 0, 500, 2000, 501), ("far", 1900, 1900, 3000, 3000), ("none", 5, 5, 5, 900)]


def chunk(i, box):
    return (str(i), 0, i, f"f{i}", f"text {i}", {"bbox": box})


def scanned(df):
    """Rows that its scan gives on."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_boxes_and_skipped_row_groups(spark, tmp_path):
    rng = random.Random(4)
    boxes = [[x := rng.randint(0, 2000), y := rng.randint(0, 2000), x + rng.randint(0, 40), y + rng.randint(0, 40)] for _ in range(20_000)]
    odd = [None, [], [1, 2, 3], [50, 50, 50, 60], [-20, -20, 10, 10]]
    data = [chunk(i, b) for i, b in enumerate([*boxes, *odd])]
    rows = spark.createDataFrame(data, f"item_id string, page int, chunk_no int, {schemas.CHUNKS}")
    path = str(tmp_path / "chunks")
    place.write_placed(rows, path, files=6, group_bytes=32 << 10)
    table = place.read_placed(spark, path)
    found = {(r["box"], r["chunk_no"]) for r in place.meeting(table, BOXES).collect()}
    want = {(n, i) for i, b in enumerate([*boxes, *odd]) if b and len(b) == 4 for n, *a in BOXES if b[0] < b[2] and b[1] < b[3] and a[0] < a[2] and b[0] < a[2] and b[2] > a[0] and b[1] < a[3] and b[3] > a[1]}
    assert found == want and {n for n, _ in found} == {"corner", "line", "far"}
    assert table.count() == len(data) and 0 < scanned(place.meeting(table, BOXES[:1])) < len(data) / 5
    assert place.meeting(table, []).count() == 0 and place.meeting(table.limit(0), BOXES).count() == 0


def test_keys_keep_neighbours_together(spark):
    from pyspark.sql import functions as F

    got = [r[0] for r in spark.createDataFrame([(0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (-5, 3), (4095, 4095)], "x int, y int").select(place.z_order(F.col("x"), F.col("y"))).collect()]
    assert got == [0, 1, 2, 3, 4, 10, (1 << 24) - 1]
