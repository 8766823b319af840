"""The corpus pipeline against a plain run of its decisions, and registration."""

import re
from collections import Counter

import pytest
import sentencepiece
from awkward import AWKWARD
from test_other_operators import plain_base

import __spark_entry__
import corpus_pipeline
from rasterloom.llm import mixing, queries, secret_scan, sentencepiece_codec

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_registration():
    names = list(queries.queries())
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_all_but_the_last_keep_the_columns(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].dtypes == stages["input"].dtypes


def test_language_stage_drops_only_texts_without_language(stages):
    kept = {r["doc_id"] for r in stages["language_id"].collect()}
    for r in stages["input"].collect():
        if not re.search(r"[^\W\d_]", r["text"]):
            assert r["doc_id"] not in kept
        elif len(r["text"]) > 40:
            assert r["doc_id"] in kept


def test_one_document_of_each_group_stays(stages):
    from test_near_copies import wanted

    rows = [(r["doc_id"], r["text"]) for r in stages["language_id"].collect()]
    assert {r["doc_id"] for r in stages["near_duplicates"].collect()} == wanted(rows)


def test_secrets_are_gone_and_documents_stay(stages):
    before = {r["doc_id"]: r["text"] for r in stages["near_duplicates"].collect()}
    after = {r["doc_id"]: r for r in stages["secret_scan"].collect()}
    assert set(before) == set(after)
    for i, r in after.items():
        if not plain_base(before[i]) and r["text"] == before[i]:
            continue
        assert "[SECRET]" in r["text"] and r["n_chars"] == len(r["text"])
        assert not any(before[i][a:b] in r["text"] for a, _, b in plain_base(before[i]) if b - a > 20)


def test_mix_repeats_whole_documents(stages):
    before = {r["doc_id"]: r["text"] for r in stages["secret_scan"].collect()}
    taken = stages["source_mixing"].collect()
    assert taken and all(before[r["doc_id"]] == r["text"] for r in taken)
    assert max(sum(1 for x in taken if x["doc_id"] == r["doc_id"]) for r in taken) <= 2


def test_ids_are_the_librarys(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.DEFAULT_MODEL)
    texts = sorted((r["doc_id"], library.encode(r["text"])) for r in stages["source_mixing"].collect())
    assert sorted((r["doc_id"], r["ids"]) for r in stages["sentencepiece"].collect()) == texts


def test_run_equals_the_stages(spark, stages):
    got = sorted((r["doc_id"], r["n_pieces"]) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == sorted((r["doc_id"], r["n_pieces"]) for r in stages["sentencepiece"].collect())


def test_native_scan_has_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = secret_scan.find_secrets(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


#: Awkward rows, one id with two unrelated texts (one of them a copy of a smaller id's), and a text that only rows without id hold.
KEYED = [
    *AWKWARD,
    (7, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (8, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (8, "many ships sail north in spring when the ice has left the wide harbour", "en", "b"),
    (None, "no row with an id holds this sentence about green apples and old carts", "en", "b"),
    (None, "no row with an id holds this sentence about green apples and old carts", "en", "b"),
]


def _keyed(docs_of):
    return docs_of(KEYED).select(corpus_pipeline.COLUMNS)


def test_one_row_of_each_group_stays_whatever_its_id(spark, docs_of):
    kept = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, _keyed(docs_of), SF).collect()), key=str)
    rows = sorted(KEYED, key=lambda r: (r[0] is None, r[0] or 0))
    label = [next(i for i, other in enumerate(rows) if other[1] == r[1]) for r in rows]  # equal texts only; no two others are near
    found = [next(g for g, r in zip(label, rows, strict=True) if r[:2] == k) for k in kept]
    assert sorted(found) == sorted(set(label))  # every group once
    assert [k[0] for k in kept] == [rows[g][0] for g in found]


def test_redaction_and_ids_take_every_row(spark, docs_of):
    key = lambda r: (str(r["doc_id"]), str(r["text"]))
    docs = _keyed(docs_of)
    redacted = corpus_pipeline.redact_secrets(spark, docs, SF)
    assert sorted(map(key, redacted.collect())) == sorted(map(key, docs.collect()))
    assert sorted(str(r["doc_id"]) for r in corpus_pipeline.tokenize(spark, docs, SF).collect()) == sorted(str(r[0]) for r in KEYED)


def test_language_stage_keeps_rows_without_id(spark, docs_of):
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.identify_language(spark, _keyed(docs_of), SF).collect()]
    assert sorted(map(str, kept)) == sorted(str(r[:2]) for r in KEYED if r[1] and r[1].strip())


def test_mix_emits_each_row_by_itself(spark, docs_of):
    docs = _keyed(docs_of)
    got = Counter((r["doc_id"], r["text"], r["source"]) for r in corpus_pipeline.mix_sources(spark, docs, SF).collect())
    held = Counter((r[0], r[1], r[3]) for r in KEYED)
    assert all(n <= 2 * held[k] for k, n in got.items())
    sized = mixing.mix(docs)[1].collect()
    for source in {r[3] for r in KEYED}:  # a source that is taken twice over emits each of its rows twice, those without id too
        rows = [k for k in held if k[2] == source and k[1] and k[1].split()]
        words = sum(held[k] * len(k[1].split()) for k in rows)
        if {r["target"] for r in sized if r["source_size"] == words} == {2.0 * words}:
            assert all(got[k] == 2 * held[k] for k in rows)
    assert any(k[0] is None for k in got)
