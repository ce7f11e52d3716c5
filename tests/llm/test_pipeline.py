"""The stages against plain versions, each on its own input, and the entry points."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from llm.brute import base_spans, near_groups, without_repeats
from llm.samples import CLASHING
from llm.test_packing import check as check_pieces

import corpus_pipeline as p
from niaga.llm import queries, toxicity
from niaga.llm.common import table

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """Each stage's input and output, written and read again as in a run."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = table(spark, SF, "documents"), []
    for name, stage in p.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        made = spark.read.parquet(f"{folder}/{name}")
        out.append((docs, made))
        docs = made
    return out


def texts(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns(written, spark):
    columns = table(spark, SF, "documents").dtypes
    assert [made.dtypes for _, made in written[:4]] == [columns] * 4


def test_toxic_documents_go_and_others_stay_as_they_are(written, spark):
    docs, made = written[0]
    rejected = {r.doc_id for r in toxicity.score(docs, table(spark, SF, "labels")).collect() if r.score >= p.TOXIC}
    before, after = texts(docs), texts(made)
    assert set(after) == set(before) - rejected
    assert all(after[i] == before[i] for i in after)


def test_one_document_of_each_group_stays(written):
    docs, made = written[1]
    before = texts(docs)
    groups = near_groups([(i, r.text) for i, r in before.items()], p.SHINGLE)
    after = texts(made)
    assert set(after) == {i for i, root in groups.items() if root == i} and len(after) < len(before)
    assert all(after[i] == before[i] for i in after)


def test_repeated_passages_go(written):
    docs, made = written[2]
    expected = without_repeats([(r.doc_id, r.text) for r in docs.collect()])
    before, after = texts(docs), texts(made)
    assert set(before) == set(after)
    for i, r in after.items():
        n, kept = expected[i]
        assert r.text == (before[i].text if len(kept) == n else " ".join(kept))
        assert r.n_chars == (before[i].n_chars if len(kept) == n else len(r.text))


def test_personal_data_goes(written):
    docs, made = written[3]
    before, after = texts(docs), texts(made)
    assert set(before) == set(after) and any(base_spans(r.text) for r in before.values())
    for i, r in after.items():
        assert not base_spans(r.text)
        if not base_spans(before[i].text) and "<" not in (r.text or ""):
            assert r == before[i]


def test_sequences_hold_what_is_left(written, spark):
    docs, made = written[4]
    check_pieces(made.collect(), [(r.doc_id, r.text) for r in docs.collect()])
    run = queries.queries()["pipeline"](spark, SF)
    assert run.columns == made.columns and run.exceptAll(made).count() == 0


def test_odd_documents_pass_every_stage(spark, docs_of, tmp_path):
    long = " ".join(f"w{i}" for i in range(80))
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, long), (4, f"{long} +1 555 010 2345"), (5, "plain text"), (5, "plain text"), (None, None)]
    docs = docs_of(rows)
    for name, stage in p.STAGES[:4]:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert len(docs.columns) == 5 + len(CLASHING.split(","))
    got = sorted((r.doc_id or 0, r.text) for r in docs.select("doc_id", "text").collect() if r.text) 
    assert got == [(3, long), (5, "plain text")]
    assert docs.filter("text is null").count() == 2 and docs.filter("text = ''").count() == 1
    empty = docs_of([])
    for _, stage in p.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_stage_list_and_registration():
    assert [name for name, _ in p.STAGES] == ["toxicity", "near_duplicates", "substring_dedup", "personal_data", "packing"]
    names = list(queries.queries())
    assert [n for n in names if n.startswith("op")] == sorted(names[:-1], key=lambda n: int(n[2:].split("_")[0]))
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)


def test_the_library_imports_without_these_operators():
    code = (
        "import sys, importlib.util as u; sys.path.insert(0, sys.argv[1]); real = u.find_spec\n"
        "u.find_spec = lambda n, *a: None if n == 'niaga.llm' else real(n, *a)\n"
        "import __spark_entry__ as e; q = e.queries(); assert 'a1_monthly_kpi' in q and not any(n.startswith('op') for n in q)\n"
        "assert not [m for m in sys.modules if m.startswith(('niaga.llm', 'corpus_pipeline'))]"
    )
    subprocess.run([sys.executable, "-c", code, ROOT], check=True, cwd="/tmp")
