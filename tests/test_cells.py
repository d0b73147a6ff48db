import hashlib
import random
from datetime import datetime, timezone

from pyspark.sql import functions as F

from blockloom.model import CELL
from blockloom.operators import cells


def frame(spark, rows):
    return spark.createDataFrame(rows, CELL)


def test_first_cell_order(spark):
    rows = [
        ("a", "x", "proto", 5, b"old"),
        ("a", "x", "proto", 9, b"new"),
        ("b", "x", "proto", 9, b"p"),
        ("b", "x", "bin", 1, b"b"),
        ("c", "w", "z", 1, b"w"),
        ("c", "x", "a", 1, b"x"),
        ("d", "x", "bin", 1, b"2"),
        ("d", "x", "bin", 1, b"1"),
    ]
    found = {r["row_key"]: (r["qualifier"], r["ts"], bytes(r["value"])) for r in cells.first_cell(frame(spark, rows)).collect()}
    assert found == {"a": ("proto", 9, b"new"), "b": ("bin", 1, b"b"), "c": ("z", 1, b"w"), "d": ("bin", 1, b"1")}


def test_digest_of_hot_and_small_rows(spark, setting, plan_of):
    """A third of the cells in one row, runs that cross batches, null and empty values."""
    setting("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    rng = random.Random(5)
    rows = [(rng.choice(["hot", f"k{rng.randrange(40)}"]), "x", "q", i, rng.randbytes(rng.randrange(30))) for i in range(900)]
    rows += [("empty", "x", "q", 0, b""), ("null", "x", "q", 0, None), ("null", "x", "q", 1, b"v")]
    digest = cells.row_digest(frame(spark, rows))
    found = {r["row_key"]: r["digest"] for r in digest.collect()}
    expected = {}
    for key, _, _, _, value in sorted(rows, key=lambda r: (r[0], -r[3])):
        expected.setdefault(key, hashlib.sha256()).update(value or b"")
    assert found == {key: value.hexdigest() for key, value in expected.items()}
    assert "collect_list" not in plan_of(digest)


def test_one_cell_rows_digest_without_shuffle(spark, plan_of):
    rows = frame(spark, [(f"k{i}", "x", "q", i, bytes([i])) for i in range(20)])
    direct = cells.cell_digest(rows)
    assert "Exchange" not in plan_of(direct)
    assert cells.digest_differences(direct, cells.row_digest(rows)).count() == 0
    changed = rows.where("row_key <> 'k3'").withColumn("value", F.when(F.col("row_key") == "k4", F.lit(b"z")).otherwise(F.col("value")))
    assert {r[0] for r in cells.digest_differences(direct, cells.cell_digest(changed)).collect()} == {"k3", "k4"}


def test_file_to_cell_and_routing(spark):
    at = datetime(2024, 1, 2, tzinfo=timezone.utc)
    files = spark.createDataFrame(
        [(p, at, b"v") for p in ("/r/1/blocks/00a.pb", "/r/1/entries/00b", "/r/1/other/c.d.e", "lonely")],
        "path string, modificationTime timestamp, content binary",
    )
    made = cells.file_to_cell(files)
    row = made.where(F.col("row_key") == "00a").first()
    assert (row["family"], row["qualifier"], bytes(row["value"])) == ("x", "proto", b"v")
    assert row["ts"] == int(at.timestamp() * 1000)
    routed = {r["row_key"]: r["table_name"] for r in cells.route_cells(made).collect()}
    assert routed == {"00a": "blocks", "00b": "entries"}
    assert {r["row_key"] for r in cells.rejected_cells(made).collect()} == {"c.d", "lonely"}
