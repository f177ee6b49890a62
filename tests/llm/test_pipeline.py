import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline as pipe
from barograph.llm import bpe, secret_scan
from tests.llm import brute


def ids(frame):
    return sorted(str(r["doc_id"]) for r in frame.select("doc_id").collect())


def test_registered():
    assert entry.queries()["pipeline"] is pipe.run
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 11))
    assert len(pipe.STAGES) == 5 and (pipe.ORACLE_SQL is None) == ("pipeline" not in entry.oracle_sql())


def test_quality_keeps_good_documents(spark, docs, folder):
    kept = pipe.good_quality(spark, docs, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert kept.schema == docs.schema
    good, bad = labels.where("quality = 1"), labels.where("quality = 0")
    assert kept.join(good, "doc_id").count() >= 0.97 * docs.join(good, "doc_id").count()
    assert kept.join(bad, "doc_id").count() <= 0.3 * docs.join(bad, "doc_id").count()


def test_one_document_of_each_group_stays(spark, docs, folder):
    kept = pipe.distinct_texts(spark, docs, folder)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    wanted = brute.components(rows)
    assert kept.schema == docs.schema
    assert ids(kept) == sorted(str(d) for d, t in rows if not brute.words(t) or wanted[t][1] == d)


def test_contaminated_documents_go(spark, docs, folder):
    kept = pipe.without_benchmark(spark, docs, folder)
    items = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    leaking = {d for d, _ in brute.leaks(rows, [tuple(r) for r in items])}
    assert leaking and ids(kept) == sorted(str(d) for d, _ in rows if d not in leaking)


def test_secrets_are_gone_and_all_documents_stay(spark, docs, folder):
    clean = pipe.without_secrets(spark, docs, folder)
    assert clean.schema == docs.schema and ids(clean) == ids(docs)
    assert secret_scan.scan(clean, secret_scan.BASE_RULES).where("size(spans) > 0").count() == 0
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = {r["doc_id"] for r in secret_scan.scan(docs).where("size(spans) > 0").collect()}
    for r in clean.collect():
        assert r["n_chars"] == len(r["text"])
        assert (r["text"] == texts[r["doc_id"]]) == (r["doc_id"] not in found)


def test_odd_rows_pass_every_stage(spark, odd, none, folder):
    rows = odd
    for name, stage in pipe.STAGES[:-1]:
        rows = stage(spark, odd, folder)
        assert rows.columns == odd.columns, name
        assert stage(spark, none, folder).count() == 0
    kept = ids(pipe.distinct_texts(spark, odd, folder))
    assert kept == sorted(["1", "4", "5", "6", "7", "9", "11", "12", "13", "14", "15", "None"])


def test_whole_run(spark, folder):
    out = pipe.run(spark, folder).collect()
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = bpe.read_ranks(file.read())
    codec = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    same = 0
    for r in out:
        text = docs[r["doc_id"]]
        assert r["n_tokens"] * 4 == len(r["ids"])
        if not any(rule.spans(text) for rule in secret_scan.RULES):
            assert r["n_tokens"] == len(codec.encode_ordinary(text))
            same += 1
    assert same > 50 and len({r["doc_id"] for r in out}) == len(out) < len(docs)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "x " * 40)]])
def test_tiny_tables(spark, folder, rows):
    tiny = spark.createDataFrame(rows, "doc_id long, text string")
    for _, stage in pipe.STAGES:
        assert stage(spark, tiny, folder).count() <= len(rows)
