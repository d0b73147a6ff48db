import re
from math import comb

import pytest
from pyspark.sql import functions as F

from blockloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    covered = {i + d for i, w in enumerate(windows) if times[w] > 1 for d in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), len(covered)


def test_counts(docs, odd, texts):
    rows = list(enumerate([*odd, "a b c a b c d", "x y z q x y z x y z", *texts.values()]))
    found = quality.measure(docs(rows).drop("measured")).select("doc_id", "measured.*").collect()
    assert {r[0]: tuple(r[1:]) for r in found} == {i: by_hand(t) for i, t in rows}


@pytest.mark.parametrize("n,k,p", ((50, 0, 0.1), (200, 3, 0.02), (3000, 12, 0.01), (90000, 700, 0.01), (10, 5, 0.01), (0, 0, 0.5)))
def test_binomial_tail(spark, n, k, p):
    row = spark.range(1).select(quality.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
    if k > n * p:
        assert row == 1
    elif n < 5000:
        exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert row == pytest.approx(exact, rel=1e-9)
    else:
        assert 0 < row < 1e-10


def labelled(spark, rows):
    kind = ", ".join(f"{c}: bigint" for c in quality.COUNTS)
    return spark.createDataFrame(
        [(s, (100, 500, symbols, 9, 0, 0), good) for s, symbols, good, times in rows for _ in range(times)],
        f"stratum string, measured struct<{kind}>, good boolean",
    )


def test_cutoffs_bound_false_rejections(spark):
    rows = labelled(
        spark,
        [
            ("a", 0, True, 5000), ("a", 60, False, 300), ("a", 20, True, 400), ("a", 20, False, 300),
            ("b", 0, True, 20), ("b", 60, False, 300), ("c", 60, None, 40),
        ],
    )
    found = {(r.stratum, r.rule): r for r in quality.cutoffs(rows).collect()}
    # 20 symbols among 500 characters are 40 per mille; rejecting there would lose too many good documents.
    assert set(found) == {("a", "symbols")}
    assert found["a", "symbols"].cutoff == 100 and found["a", "symbols"].lost_good == 0


def test_verdicts(docs, spark):
    plain = " ".join(f"w{i}" for i in range(80))
    rows = [(1, plain, "en"), (2, plain + " " + "# " * 90, "en"), (3, plain + " " + "# " * 90, None), (4, None, "en"), (None, plain, "en"), (1, plain, "en")]
    labels = spark.createDataFrame([(100 + i, int(i % 10 > 0)) for i in range(3000)] + [(None, 1)], "doc_id long, quality int")
    more = [(100 + i, plain + (" " + "# " * 90 if i % 10 == 0 else f" v{i}"), "en") for i in range(3000)]
    table = docs([*rows, *more])
    found = quality.quality_rules(table, labels).collect()
    assert len(found) == len(rows) + len(more)
    kept = {}
    for r in found:
        kept.setdefault(r.doc_id, []).append((r.base_failed, r.kept))
    assert kept[1] == [(False, True)] * 2 and kept[None] == [(False, True)]
    assert kept[2][0][1] is False and kept[4] == [(True, False)]
    assert all(kept[100 + i][0][1] for i in range(3000) if i % 10)
    left = quality.keep_good(table, labels)
    assert left.columns == table.columns
    assert left.count() == sum(r.kept for r in found)


def test_no_python_in_the_plan(docs, spark, plan_of):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert "Python" not in plan_of(quality.quality_rules(docs([(1, "a")]), labels))


def test_no_labels_and_no_rows(docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.quality_rules(docs([]), labels).count() == 0
    text = " ".join(f"w{i}" for i in range(60))
    assert [r.kept for r in quality.quality_rules(docs([(1, text)]), labels).collect()] == [True]


def test_levels_tighten_together():
    sets = quality.levels()
    assert sets[0] == {r.name: max(r.cutoffs) for r in quality.RULES}
    assert sets[-1] == {r.name: min(r.cutoffs) for r in quality.RULES}
    assert all(b[name] <= a[name] for a, b in zip(sets, sets[1:]) for name in a)


def test_a_hundred_and_eight_good_labels_suffice_in_four_strata(spark):
    rows = [("a", 0, True, 108), ("a", 60, False, 9), ("b", 0, True, 107), ("b", 60, False, 9), ("c", 0, True, 1), ("d", 0, True, 1)]
    assert [(r.stratum, r.rule, r.cutoff) for r in quality.cutoffs(labelled(spark, rows)).collect()] == [("a", "symbols", 100)]


def test_testing_ends_at_the_first_level_that_fails(spark):
    # 5 of 100 good rows are lost at the loosest level, so no level is certified, though most rules lose none.
    rows = [("a", 101, True, 50), ("a", 0, True, 950), ("a", 300, False, 500)]
    assert quality.cutoffs(labelled(spark, rows)).where("cutoff < 200").count() == 0


def test_copies_are_one_trial(docs, spark):
    plain = " ".join(f"w{i}" for i in range(80))
    rows = [(i, plain, "en") for i in range(3000)] + [(9000 + i, plain + " " + "#" * 90, "en") for i in range(50)]
    labels = spark.createDataFrame([(i, int(i < 9000)) for i, _, _ in rows], "doc_id long, quality int")
    assert all(r.kept for r in quality.quality_rules(docs(rows), labels).collect())


def test_true_risk_stays_within_the_bound_in_simulation():
    import random

    # A stratum of 300 labels whose every level loses 5 % of the good documents: certified in at most DOUBT of trials.
    made = random.Random(5)
    lost = [sum(made.random() < 0.05 for _ in range(300)) for _ in range(2000)]
    tail = {k: sum(comb(300, i) * quality.RISK**i * (1 - quality.RISK) ** (300 - i) for i in range(k + 1)) for k in set(lost)}
    assert sum(tail[k] <= quality.DOUBT for k in lost) / len(lost) <= quality.DOUBT


def test_extra_columns_of_any_name(docs, spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = docs([(1, text, "en"), (2, "short", "en")])
    odd = ["measured", "kept", "base_failed", "__words", "stratum", "row", "a.b", "digest"]
    for c in odd:
        rows = rows.drop(c).withColumn(c, F.lit("mine"))
    labels = spark.createDataFrame([], "doc_id long, quality int")
    left = quality.keep_good(rows, labels)
    assert left.columns == rows.columns and [[r[c] for c in odd] for r in left.collect()] == [["mine"] * len(odd)]
