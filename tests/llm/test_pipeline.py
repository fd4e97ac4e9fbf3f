import duckdb
import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from returnsmith.llm.oracle import ORACLE
from tests.llm.cases import frame, messy

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(str, got[columns].astype(object).values.tolist())) == sorted(map(str, want[columns].astype(object).values.tolist()))


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "secret_scan", "bpe_encoding"]


def test_stages_keep_columns_and_take_messy_rows(spark):
    docs = frame(spark, messy())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
    out = corpus_pipeline.encode(spark, docs, SF).collect()
    assert len(out) == len(messy()) and all(r["round_trip"] for r in out)


def test_pipeline_follows_from_its_stages(spark):
    from returnsmith.llm import bpe, decontaminate, jaccard_join, quality_rules, secret_scan
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    docs = read("documents")
    kept = {r["doc_id"] for r in quality_rules.judge(docs, read("labels")).filter("kept").collect()}
    docs = docs.filter(docs["doc_id"].isin(kept))
    kept = {r["doc_id"] for r in jaccard_join.near_duplicates(docs).collect() if r["component_id"] == r["doc_id"]}
    docs = docs.filter(docs["doc_id"].isin(kept))
    kept -= {r["doc_id"] for r in decontaminate.decontaminate(docs, read("benchmark")).filter("contaminated").collect()}
    encoder = bpe.encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    want = {r["doc_id"]: encoder.encode_ordinary(secret_scan.redact(r["text"], secret_scan.spans(r["text"]), "[secret]"))
            for r in docs.collect() if r["doc_id"] in kept}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == want and len(got) == len(want) and all(r["round_trip"] for r in got)
