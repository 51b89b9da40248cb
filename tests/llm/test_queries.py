"""The registered queries of the subpackage and the pipeline on the smallest tables."""

import os
import sys

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tributary.llm.queries import LLM_QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(__file__))), "tools"))
from oracle_check import compare, duck_connection  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = {f"op{n}_" for n in range(1, 14)}
    assert {q.split("_")[0] + "_" for q in LLM_QUERIES} == names
    assert set(LLM_QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", ["op3_chat", "op8_mixing", "op11_repair", "op12_warc", "op13_collocations"])
def test_against_sql(spark, name):
    got = compare(spark, SF, name, LLM_QUERIES[name], entry.oracle_sql()[name], duck_connection(SF))
    assert got["status"] == "ok" and got["rows"] > 0, got


@pytest.mark.parametrize("name", ["op2_quality_rules", "op4_toxicity", "op7_line_templates", "op9_cotraining"])
def test_one_row_per_document(spark, name):
    ids = [r.doc_id for r in LLM_QUERIES[name](spark, SF).select("doc_id").collect()]
    want = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(ids) == sorted(want)


def test_stages(spark):
    """Each stage on its own input, by what it promises; the smallest tables hold too few labels to learn from."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    before = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf).cache()
        kept[name] = (before, after)
        before = after
    for name, (_, after) in list(kept.items())[:-1]:
        assert after.columns == columns, name
    ids = {n: (sorted(r.doc_id for r in a.collect()), sorted(r.doc_id for r in b.collect()))
           for n, (a, b) in list(kept.items())[:-1]}
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    gone = [toxic[d] for d in set(ids["toxicity"][0]) - set(ids["toxicity"][1]) if d in toxic]
    assert gone and sum(gone) >= 0.7 * len(gone)
    assert ids["line_dedup"][0] == ids["line_dedup"][1]

    from test_simhash import plain_components, plain_fingerprint
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in kept["near_duplicates"][0].collect()]
    component = plain_components(rows, 4)
    assert ids["near_duplicates"][1] == sorted(d for (d, _), c in zip(rows, component) if d == c)

    from tributary.llm.mixing import mix
    want = sorted(r.doc_id for r in mix(kept["mixing"][0]).collect() for _ in range(r.epochs))
    assert ids["mixing"][1] == want

    from tokenizers import Tokenizer

    from tributary.llm.tokens import default_vocabulary
    model = Tokenizer.from_file(default_vocabulary())
    total = sum(len(model.encode(r.text or "", add_special_tokens=False).ids) + 1
                for r in kept["packing"][0].collect())
    assert sum(r.length for r in kept["packing"][1].collect()) == total


def test_run_equals_the_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0 and got.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                   "sequence_id", "offset"]


def test_entry_works_whatever_is_missing(monkeypatch):
    """A missing package or folder leaves the operators out and all other queries in."""
    import builtins
    real = builtins.__import__

    def without(name, *args, **kwargs):
        if name == "xxhash" or name.startswith("tributary.llm"):
            raise ImportError(name)
        return real(name, *args, **kwargs)
    monkeypatch.setattr(builtins, "__import__", without)
    assert entry._llm() == ({}, {}) and "sales_fact" in entry.queries()
