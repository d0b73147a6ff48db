import random

import pytest
from pyspark.sql import functions as F

from blockloom.operators import ranges


def planned(frame):
    return sorted((int(row[0], 16), int(row[1], 16)) for row in frame.select("start_key", "end_key").collect())


@pytest.mark.parametrize(
    "start, end, size, first, last, count",
    [
        (120, 1400, 100, 100, 1499, 14),  # start aligned down, last range past the end
        (100, 199, 100, 100, 199, 1),
        (100, 200, 100, 100, 299, 2),
        (7, 7, 1, 7, 7, 1),
        (0, 18750, 50000, 0, 49999, 1),
        (2**40 + 3, 2**40 + 250, 100, (2**40 + 3) // 100 * 100, None, 4),
    ],
)
def test_split(spark, start, end, size, first, last, count):
    found = planned(ranges.split_key_range(spark, start, end, size))
    assert len(found) == count
    assert found[0][0] == first
    assert last is None or found[-1][1] == last
    assert all(hi - lo + 1 == size for lo, hi in found)
    assert all(a[1] + 1 == b[0] for a, b in zip(found, found[1:]))
    bounds = spark.createDataFrame([(start, end)], "start long, end long")
    assert planned(ranges.split_key_ranges(bounds, size)) == found


@pytest.mark.parametrize("start, end, size", [(200, 100, 10), (120, 119, 100), (-1, 5, 10), (0, 5, 0)])
def test_split_rejects(spark, start, end, size):
    with pytest.raises(ValueError):
        ranges.split_key_range(spark, start, end, size)


def test_split_column_rejects(spark):
    bounds = spark.createDataFrame([(200, 100)], "start long, end long")
    with pytest.raises(Exception, match="no key range"):
        ranges.split_key_ranges(bounds, 10).collect()


def test_range_counts_of_large_slots(spark):
    slots = [2**62, 2**62 + 1, 2**53 + 1, 99, 100]
    rows = spark.createDataFrame([(slot,) for slot in slots], "slot long")
    found = {row["start_key"]: row["rows"] for row in ranges.range_row_counts(rows, F.col("slot"), 100).collect()}
    expected = {}
    for slot in slots:
        key = f"{slot // 100 * 100:016x}"
        expected[key] = expected.get(key, 0) + 1
    assert found == expected


def ledger(spark, records):
    return spark.createDataFrame(
        [("s", "blocks", f"{lo:016x}", f"{hi:016x}", hi - lo + 1, status) for lo, hi, status in records],
        "sync_type string, table_name string, start_key string, end_key string, size long, status string",
    )


def test_pending_and_status(spark):
    plan = ranges.split_key_range(spark, 0, 399, 100)
    known = ledger(spark, [(0, 99, "done"), (0, 99, "failed"), (100, 199, "failed"), (200, 249, "done"), (0, 99, "done")])
    assert planned(ranges.pending_ranges(plan, known)) == [(100, 199), (200, 299), (300, 399)]
    status = {int(r["start_key"], 16): r["status"] for r in ranges.range_status(plan, known).collect()}
    assert status == {0: "done", 100: "failed", 200: "pending", 300: "pending"}


PATHS = [
    ("a/blocks/range_0000000000000000_0000000000000063/blocks.seq", 0, 99),
    ("a/RANGE/range_00FF_01ff/x", 255, 511),
    ("a/range_80000000_ffffffff/entries.seq", 2**31, 2**32 - 1),
    ("a/range_ffffffffffffffff_ffffffffffffffff/b", None, None),
    ("a/range_1_2_3/range_5_6/b", 1, 2),
    ("a/checkpoints/blocks/0000_0063.txt", "none", "none"),
    ("a/range_xyz_1/b", "none", "none"),
]


def test_parse_paths(spark):
    files = spark.createDataFrame([(p,) for p, _, _ in PATHS], "path string")
    found = {r["path"]: (r["lo"], r["hi"]) for r in ranges.parse_range_path(files).collect()}
    assert found == {p: (lo, hi) for p, lo, hi in PATHS if lo not in (None, "none")}
    assert [r["path"] for r in ranges.rejected_range_paths(files).collect()] == [p for p, lo, _ in PATHS if lo is None]


@pytest.mark.parametrize(
    "lo, hi, start, end, strict, inclusive",
    [
        (0, 99, 50, 60, True, True),
        (0, 99, 99, 200, False, True),  # touch at one slot
        (5, 5, 0, 100, False, True),  # file of one slot
        (0, 99, 7, 7, False, True),  # request of one slot
        (0, 99, 100, 200, False, False),
    ],
)
def test_overlap(spark, lo, hi, start, end, strict, inclusive):
    files = spark.createDataFrame([("f", lo, hi)], "path string, lo long, hi long")
    assert (ranges.overlapping_files(files, start, end).count() == 1) == strict
    assert (ranges.overlapping_files(files, start, end, inclusive=True).count() == 1) == inclusive


@pytest.mark.parametrize("inclusive", [False, True])
def test_many_requests_equal_brute_force(spark, inclusive, plan_of):
    rng = random.Random(3)

    def interval(top):
        lo = rng.choice([rng.randrange(200), rng.randrange(top)])
        return lo, lo + rng.choice([-3, 0, 1, 5, 100, 5000, 2**41])

    file_rows = [(f"f{i}", *interval(2000)) for i in range(150)] + [("top", 2**62, 2**63 - 2), ("all", 0, 2**63 - 2)]
    request_rows = [(i, *interval(2000)) for i in range(150)] + [(900, 2**62 + 5, 2**62 + 6)]
    files = spark.createDataFrame(file_rows, "path string, lo long, hi long")
    requests = spark.createDataFrame(request_rows, "id long, s long, e long")
    joined = ranges.overlapping_files_of_requests(files, requests, inclusive)
    found = sorted((r["path"], r["id"]) for r in joined.collect())
    expected = sorted(
        (path, i)
        for path, lo, hi in file_rows
        for i, s, e in request_rows
        if (max(lo, s) <= min(hi, e) if inclusive else max(lo, s) < min(hi, e))
    )
    assert found == expected
    plan = plan_of(joined)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_route_and_pending_files(spark):
    files = spark.createDataFrame([("x/blocks/a",), ("x/entries/blocks",), ("x/other",)], "path string")
    routed = sorted((r["path"], r["kind"]) for r in ranges.route_by_kind(files).collect())
    assert routed == [("x/blocks/a", "blocks"), ("x/entries/blocks", "blocks"), ("x/entries/blocks", "entries")]
    known = spark.createDataFrame([("x/blocks/a",), ("x/blocks/a",)], "path string")
    assert sorted(r[0] for r in ranges.pending_files(files, known).collect()) == ["x/entries/blocks", "x/other"]


def test_cut_intervals_are_not_broadcast(spark, plan_of):
    """They grow by up to two pieces a level, of which Spark's estimate knows nothing."""
    files = spark.createDataFrame([("a", 0, 99), ("b", 100, 1 << 40)], "path string, lo long, hi long")
    requests = spark.createDataFrame([(1, 50, 150), (2, 1 << 35, 1 << 36)], "id long, s long, e long")
    pairs = ranges.overlapping_files_of_requests(files, requests)
    assert "BroadcastHashJoin" not in plan_of(pairs)
    assert sorted((r["path"], r["id"]) for r in pairs.collect()) == [("a", 1), ("b", 1), ("b", 2)]
