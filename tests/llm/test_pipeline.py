"""The pipeline against plain Python over the whole small table, stage by stage, and its driver contract."""

import base64
import hashlib
import re

import public_tokenizers as tokenizers
import pytest
import tiktoken

import corpus_pipeline as pipeline
from blockloom.llm import language, queries
from blockloom.session import stage

from test_near_dup import brute_force as groups_by_hand
from test_quality import by_hand as counts_by_hand

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def steps(spark):
    """The table and what each stage makes of it."""
    found = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for name, function in pipeline.STAGES:
        found.append(stage(function(spark, found[-1], SF_DIR), name.replace(" ", "-")))
    return found


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_columns_and_names(steps):
    assert 4 <= len(pipeline.STAGES) <= 5
    assert all(s.columns == steps[0].columns for s in steps[1:-1])


def test_quality_rules(steps):
    # So few labels certify no cutoff, so the base rules alone reject.
    kept = [r for r in rows_of(steps[0]) for n in [counts_by_hand(r[1])] if n[0] >= 50 and 100 * n[5] <= 50 * n[0]]
    assert rows_of(steps[1]) == kept


def test_language_id(steps):
    model = language.learn(steps[1])
    own = language.Identifier(model)
    judged = [(r, own.identify(r[1])) for r in rows_of(steps[1])]
    wanted = [r for r, (lang, score) in judged if lang != "und" and score >= model.threshold]
    got = rows_of(steps[2])
    # Logits travel in single precision, which may move a score that is the threshold itself.
    assert {r[0] for r in got} ^ {r[0] for r in wanted} <= {r[0] for r, (_, s) in judged if abs(s - model.threshold) < 1e-5}
    assert set(got) <= set(rows_of(steps[1]))


def test_near_duplicates(steps):
    kept = {i for i, _, _, kept in groups_by_hand([r[:2] for r in rows_of(steps[2])]) if kept}
    assert rows_of(steps[3]) == [r for r in rows_of(steps[2]) if r[0] in kept]


def split(total, children):
    """Fill children (name -> (weight, capacity)) by weight: full ones drop out, the rest share what is left."""
    given, left = {}, dict(children)
    while left:
        weights = sum(w for w, _ in left.values())
        full = {k for k, (w, c) in left.items() if c * weights <= total * w}
        if not full:
            return given | {k: total * w // weights for k, (w, _) in left.items()}
        k = min(full, key=lambda k: (left[k][1] / left[k][0], k))
        given[k] = left.pop(k)[1]
        total -= given[k]
    return given


def test_mixing(steps):
    known = {name: w for _, name, w in queries.WEIGHTS}
    leaves, docs = {}, rows_of(steps[3])
    for i, text, lang, source, _ in docs:
        n = int(re.search(r"\d+$", source)[0])
        domain = "web" if n < 7 else "books" if n < 14 else "forums"
        leaves.setdefault(f"{domain}/{lang}/{source}", []).append((i, len(WORD.findall(text))))
    capacity = {}
    for leaf, members in leaves.items():
        parts = leaf.split("/")
        for k in range(4):
            node = "/".join(parts[:k])
            capacity[node] = capacity.get(node, 0) + sum(n for _, n in members) * pipeline.EPOCHS
    target = {"": min(int(sum(n for m in leaves.values() for _, n in m) * pipeline.SHARE), capacity[""])}
    for depth in range(1, 4):
        for node in [x for x in target if (x.count("/") + 1 if x else 0) == depth - 1]:
            children = {c for c in capacity if c and c.count("/") == depth - 1 and (not node or c.startswith(node + "/"))}
            weighed = {c: (known.get(c, 1), capacity[c]) for c in children if known.get(c, 1) > 0}
            target |= split(target[node], weighed)
    drawn = []
    for leaf, members in leaves.items():
        supply, total = sum(n for _, n in members), 0
        epoch, rest = divmod(target.get(leaf, 0), supply)
        drawn += [i for i, _ in members] * epoch
        for i, n in sorted(members, key=lambda m: hashlib.md5(f"{queries.SEED}-{epoch}-{m[0]}".encode()).hexdigest()):
            total += n
            if rest and total <= rest:
                drawn.append(i)
    by_id = {r[0]: r for r in docs}
    assert rows_of(steps[4]) == sorted(by_id[i] for i in drawn)


def test_encoding(steps):
    with open(tokenizers.path(queries.RANKS), "rb") as file:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("library", pat_str=tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
    found = {r.doc_id: r for r in steps[5].collect()}
    assert sorted(found) == [r[0] for r in rows_of(steps[4])]
    for i, text, *_ in rows_of(steps[4]):
        assert found[i].token_ids == library.encode_ordinary(text) and found[i].n_tokens == len(found[i].token_ids)


def test_run_gives_the_last_stage(spark, steps):
    assert rows_of(pipeline.run(spark, SF_DIR).drop("token_ids")) == rows_of(steps[5].drop("token_ids"))


def test_stages_bear_odd_rows(spark, docs, odd):
    extra = [(None, "a b", "en", "src1"), (None, None, None, None), (3, "x", "en", "src2"), (3, "x", "en", "src2")]
    table = docs([*((i, t, None, None) for i, t in enumerate(odd)), *extra], "n_tokens long, kept boolean")
    for _, function in pipeline.STAGES[:-1]:
        for frame in (table, table.limit(0)):
            assert function(spark, frame, SF_DIR).columns == table.columns
    kept = pipeline.near_duplicates(spark, table, SF_DIR)
    assert kept.where("doc_id IS NULL").count() == 2 and kept.where("doc_id = 3").count() == 1


def test_entry_without_the_subpackage(tmp_path):
    """The other queries remain when these folders are gone."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(pipeline.__file__))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/blockloom", tmp_path / "blockloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'tx_by_addr' in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


def test_mixing_draws_rows_of_one_id_and_of_none(spark):
    """Different texts under one id, null ids and exact copies: each row is drawn for itself."""
    own = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(7, own(k)) for k in range(40)] + [(None, own(k)) for k in range(40, 60)] + [(7, own(0)), (None, own(41)), (9, own(70))]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "src1", len(t)) for i, t in rows], kind)
    drawn = [(r.doc_id, r.text) for r in pipeline.mix_sources(spark, docs, SF_DIR).collect()]
    # Four fifths of the words in whole rows of 60, and no row oftener than it is there.
    assert len(drawn) == int(0.8 * len(rows))
    assert all(drawn.count(x) <= rows.count(x) for x in drawn)
    assert any(i is None for i, _ in drawn) and sum(i == 7 for i, _ in drawn) > 20
    assert pipeline.mix_sources(spark, docs.where("false"), SF_DIR).count() == 0
