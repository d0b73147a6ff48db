"""Quality rules whose cutoffs are chosen under a bound on false rejections.

Everything here is DataFrame expressions: counts come from one pass over the texts, cutoffs from labelled rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from blockloom.llm.common import SPACE
from blockloom.session import stage

#: Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"


class Rule(NamedTuple):
    """Rejects a document when 1000 * over > cutoff * under, for a cutoff that is chosen among ``cutoffs``."""

    name: str
    over: str
    under: str
    cutoffs: tuple[int, ...]


RULES = (
    Rule("symbols", "n_symbols", "word_chars", (5, 10, 20, 50, 100, 200)),
    Rule("dup_lines", "n_dup_lines", "n_lines", (100, 200, 300, 400, 500, 700)),
    Rule("repeats", "n_repeat_words", "n_words", (50, 100, 200, 300, 400)),
    Rule("word_length", "word_chars", "n_words", (8000, 10000, 12000, 15000, 20000)),
)

#: Of a stratum's good documents, at most this share may be rejected by all rules together ...
RISK = 0.04
#: ... except with this probability, over all strata and rule sets.
DOUBT = 0.05

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, text_col: str = "text", into: str = "measured") -> DataFrame:
    """Add a struct column ``into`` with ``COUNTS`` of each whole text. Null and empty texts have zeros.

    n_repeat_words counts the words that lie in a window of three words which the text has twice or more. Windows
    are sorted within the row, so no row leaves its task, and a text's memory is a few times its size.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumns(
        {"__words": F.array_remove(F.split(text, SPACE), ""), "__lines": F.split(text, "\n")}
    ).withColumn("__lines", F.filter("__lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    words, windows, starts = F.col("__words"), F.col("__windows"), F.col("__starts")
    at = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    window = F.sort_array(
        F.transform(
            at,
            lambda i: F.struct(
                F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("words"),
                i.alias("at"),
            ),
        )
    )
    rows = rows.withColumn("__windows", window)
    again = F.filter(
        windows,
        lambda x, i: F.coalesce(x["words"] == F.get(windows, i - 1)["words"], F.lit(False))
        | F.coalesce(x["words"] == F.get(windows, i + 1)["words"], F.lit(False)),
    )
    rows = rows.withColumn("__starts", F.sort_array(F.transform(again, lambda x: x["at"])))
    covered = F.transform(
        starts, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - x, F.lit(3)))
    )
    counts = {
        "n_words": F.size(words),
        "word_chars": F.char_length(F.array_join(words, "")),
        "n_symbols": F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, "")),
        "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.aggregate(covered, F.lit(0), lambda total, x: total + x),
    }
    measured = F.struct(*(c.cast("long").alias(name) for name, c in counts.items()))
    # Out of a generator, so that the optimiser does not put the counts' expressions in each place that uses them.
    return rows.withColumn(into, F.explode(F.array(measured))).drop("__words", "__lines", "__windows", "__starts")


def base_failed(measured: Column) -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    n = measured["n_words"]
    return (n < 50) | (100 * measured["n_repeat_words"] > 50 * n)


def _breaks(measured: Column, rule: Rule, cutoff: Column) -> Column:
    return 1000 * measured[rule.over] > cutoff * measured[rule.under]


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X of n trials with probability p; 1 where k is above the mean, as no bound is met there.

    At most d exactly where the exact (Clopper-Pearson) upper bound of k of n at confidence 1 - d is at most p.
    """
    first = n * F.log1p(F.lit(-p))
    terms = F.aggregate(
        F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")),
        F.struct(first.alias("term"), F.exp(first).alias("total")),
        lambda so_far, i: F.struct(
            (so_far["term"] + F.ln((n - i + 1) / i * (p / (1 - p)))).alias("term"),
            (so_far["total"] + F.exp(so_far["term"] + F.ln((n - i + 1) / i * (p / (1 - p))))).alias("total"),
        ),
        lambda so_far: so_far["total"],
    )
    return F.when(k > n * p, 1.0).otherwise(terms)


def levels(rules: tuple[Rule, ...] = RULES) -> list[dict[str, int]]:
    """Rule sets from the loosest to the strictest: every rule at its next cutoff, or at its last one."""
    ordered = {r.name: sorted(r.cutoffs, reverse=True) for r in rules}
    steps = max((len(c) for c in ordered.values()), default=0)
    return [{name: c[min(k, len(c) - 1)] for name, c in ordered.items()} for k in range(steps)]


def certified_levels(
    labelled: DataFrame, rules: tuple[Rule, ...] = RULES, risk: float = RISK, doubt: float = DOUBT
) -> DataFrame:
    """How far down ``levels`` each stratum may go: rows (stratum, level), of rows (stratum, measured, good boolean).

    Of the n good rows of a stratum, a level as a whole rejects k. It is certified if the exact upper confidence bound
    of the rejected share is at most ``risk``. Levels are tested from the loosest on and testing ends at the first that
    fails, so they need no correction among themselves; ``doubt`` is divided by the number of strata (Bonferroni).
    Strata where the loosest level fails have no row.
    """
    sets = levels(rules)
    steps = F.array(
        *(
            F.struct(
                F.lit(k).alias("level"),
                reduce(or_, (_breaks(F.col("measured"), r, F.lit(own[r.name])) for r in rules)).alias("breaks"),
            )
            for k, own in enumerate(sets)
        )
    )
    rows = labelled.select("stratum", "good", F.explode(steps).alias("step")).select("stratum", "good", "step.*")
    counted = rows.groupBy("stratum", "level").agg(
        F.count_if("good").alias("n_good"), F.count_if(F.col("good") & F.col("breaks")).alias("lost_good")
    )
    counted = stage(counted, "levels")
    strata = counted.select("stratum").distinct().count()
    passes = binomial_tail(F.col("lost_good"), F.col("n_good"), risk) <= doubt / max(1, strata)
    first = counted.groupBy("stratum").agg(
        (F.coalesce(F.min(F.when(~passes, F.col("level"))), F.lit(len(sets))) - 1).alias("level")
    )
    return first.where("level >= 0")


def cutoffs(labelled: DataFrame, rules: tuple[Rule, ...] = RULES, risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """Choose cutoffs from labelled rows (stratum, measured, good boolean): rows (stratum, rule, cutoff, ...).

    Rows that fail the base rules or have a null label are left out. A stratum's rules stay at or above the cutoffs of
    its last certified level (``certified_levels``). Whatever set is chosen there rejects no more than that level, so
    that all rules together stay within ``risk`` without a further test. Of these a rule takes the cutoff that rejects
    most bad rows over good rows, the loosest among equals, if it rejects more bad than good ones. Where a stratum has
    too few labels for any level, or a rule no such cutoff, the rule rejects nothing.
    """
    rows = labelled.where(F.col("good").isNotNull() & ~base_failed(F.col("measured")))
    sets = levels(rules)
    # The first level at which a cutoff is reached: it may be used from there on.
    tried = F.array(
        *(
            F.struct(
                F.lit(r.name).alias("rule"), F.lit(c).alias("cutoff"),
                F.lit(min(k for k, own in enumerate(sets) if own[r.name] == c)).alias("reached"),
                _breaks(F.col("measured"), r, F.lit(c)).alias("breaks"),
            )
            for r in rules
            for c in r.cutoffs
        )
    )
    last = stage(certified_levels(rows, rules, risk, doubt), "certified")
    each = rows.select("stratum", "good", F.explode(tried).alias("try")).select("stratum", "good", "try.*")
    counted = each.groupBy("stratum", "rule", "cutoff", "reached").agg(
        F.count_if("good").alias("n_good"),
        F.count_if(F.col("good") & F.col("breaks")).alias("lost_good"),
        F.count_if(~F.col("good") & F.col("breaks")).alias("caught_bad"),
    )
    gain = F.col("caught_bad") - F.col("lost_good")
    best = counted.join(last, "stratum").where((F.col("reached") <= F.col("level")) & (gain > 0))
    best = best.groupBy("stratum", "rule").agg(
        F.max_by(F.struct("cutoff", "n_good", "lost_good", "caught_bad"), F.struct(gain, "cutoff")).alias("best")
    )
    return best.select("stratum", "rule", "best.*")


def labels_of(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Labelled rows for ``cutoffs``, of rows (id_col, stratum, digest, measured). No rule was made from them.

    Copies are no independent trials: rows of one text count once in a stratum with a label. Null ids match nothing.
    """
    known = labels.select(F.col(id_col), (F.col("quality") == 1).alias("good")).distinct()
    rows = measured.join(known, id_col).groupBy("stratum", "digest", "good").agg(F.first("measured").alias("measured"))
    return rows.select("stratum", "measured", "good")


def judge(
    rows: DataFrame, chosen: DataFrame, rules: tuple[Rule, ...] = RULES, measured: str = "measured", stratum: str = "stratum"
) -> DataFrame:
    """Add base_failed and kept to rows by their columns ``measured`` and ``stratum`` and the strata's cutoffs.

    Kept are rows that pass the base rules and every rule with a cutoff in their stratum. The table of cutoffs has a
    row per stratum, and Spark broadcasts it when it is small.
    """
    own = [F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"__{r.name}") for r in rules]
    per_stratum = chosen.groupBy(F.col("stratum").alias("__of")).agg(*own)
    joined = rows.join(per_stratum, F.col(stratum) == F.col("__of"), "left")
    broken = F.lit(False)
    for rule in rules:
        broken = broken | F.coalesce(_breaks(F.col(measured), rule, F.col(f"__{rule.name}")), F.lit(False))
    failed = base_failed(F.col(measured))
    judged = joined.withColumns({"base_failed": failed, "kept": ~failed & ~broken})
    return judged.drop("__of", *(f"__{r.name}" for r in rules))


def stratum_of(column: str = "lang") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("none"))


def _chosen(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, stratum_col: str) -> tuple[DataFrame, DataFrame]:
    """The staged counts of all documents and the staged cutoffs."""
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col), text.alias("text"), stratum_of(stratum_col).alias("stratum"),
        F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("digest"),
    )
    rows = stage(measure(rows).select(id_col, "stratum", "digest", "measured"), "measured")
    return rows, stage(cutoffs(labels_of(rows, labels, id_col)), "cutoffs")


def quality_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang"
) -> DataFrame:
    """The verdict on every document: (id_col, COUNTS, base_failed, kept).

    Texts are read once; their counts are staged and serve the choice of cutoffs and the verdict. Null and empty
    texts fail the base rules. Null strata form one of their own. A null id has no label but gets a verdict; repeated
    rows get one each. Without labels only the base rules reject. Other columns are not read.
    """
    rows, chosen = _chosen(docs, labels, id_col, text_col, stratum_col)
    return judge(rows, chosen).select(id_col, "measured.*", "base_failed", "kept")


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang"
) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns, whatever their names. Texts are never
    shuffled: they are measured once for the cutoffs and once more where they are filtered."""
    _, chosen = _chosen(docs, labels, id_col, text_col, stratum_col)
    held = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(text_col).alias("text"), stratum_of(stratum_col).alias("stratum"),
    )
    return judge(measure(held), chosen).where("kept").select("row.*")
