import pytest
from pyspark.sql import functions as F

from blockloom.functions import keys


def values(spark, column, inputs, kind):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [row[0] for row in frame.orderBy("i").select(column(F.col("v"))).collect()]


def test_slot_to_key(spark):
    slots = [0, 255, 2**40, 2**63 - 1]
    assert values(spark, keys.slot_to_key, slots, "long") == [f"{slot:016x}" for slot in slots]


def test_key_to_slot(spark):
    given = ["00000000000000ff", "FF", "0" * 30 + "1f", "7" + "f" * 15, "8" + "0" * 15, "12zz", "zz", "", None, "1" * 17]
    expected = [255, 255, 31, 2**63 - 1, None, None, None, None, None, None]
    assert values(spark, keys.key_to_slot, given, "string") == expected


def test_inverted_key_sorts_newest_first(spark):
    slots = [0, 5, 2**62]
    inverted = values(spark, keys.inverted_key, slots, "long")
    assert inverted == [f"{(1 << 64) - 1 - slot:016x}" for slot in slots]
    assert sorted(inverted, reverse=True) == inverted


@pytest.mark.parametrize(
    "path, stem, folder",
    [
        ("/in/r/7/blocks/00ff.pb", "00ff", "blocks"),
        ("/in/r/7/entries/00ff", "00ff", "entries"),
        ("/in/r/7/other/00ff.v1.pb", "00ff.v1", "other"),
        ("/in/r/7/kind=blocks/part.txt", "part", "blocks"),
    ],
)
def test_path_parts(spark, path, stem, folder):
    assert values(spark, keys.file_stem, [path], "string") == [stem]
    assert values(spark, keys.parent_folder, [path], "string") == [folder]


def test_folder_below(spark):
    found = values(
        spark, lambda p: keys.folder_below(p, "/data/in/"), ["file:/data/in/range_0_9/3/blocks/a", "/data/in/x=y/b"], "string"
    )
    assert found == ["range_0_9", "y"]


def test_payload_format(spark):
    given = ["proto", "bin", "p", "x", "", None]
    assert values(spark, keys.payload_format, given, "string") == ["proto", "bin", "proto", None, None, None]


def test_kinds(spark):
    given = ["a/blocks/b", "a/entries/blocks.seq", "a/other"]
    assert values(spark, keys.kinds_of, given, "string") == [["blocks"], ["blocks", "entries"], []]


def test_keys_of_slots(spark):
    odd = ["", "a", "x" * 16, "A" + "0" * 15, "0" * 17, "0" * 16 + "\n", "g" * 16, "8" + "0" * 15, "f" * 16, "0" * 15 + "é", "０" * 16, "-" + "0" * 15, None]
    good = ["0" * 16, "7" + "f" * 15, "0123456789abcdef"]
    frame = spark.createDataFrame([(k,) for k in odd + good], "k string")
    again = F.col("k") == keys.slot_to_key(keys.key_to_slot(F.col("k")))
    rows = frame.select("k", F.coalesce(keys.is_slot_key(F.col("k")), F.lit(False)).alias("is"), F.coalesce(again, F.lit(False)).alias("again")).collect()
    assert [r["k"] for r in rows if r["is"]] == [r["k"] for r in rows if r["again"]] == good
