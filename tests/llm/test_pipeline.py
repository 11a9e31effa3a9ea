"""The pipeline's stages against brute-force versions, each on its own input."""

import hashlib
import importlib.util
import itertools
import re

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from plumbline.llm import byte_bpe, mixing, toxicity
from plumbline.llm.common import read, saved
from plumbline.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = read(spark, SF, "documents")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF), f"t-{name}")
        out.append((name, docs))
    return dict(out)


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(stages):
    names = list(stages)
    assert names == ["documents", "toxicity", "exact_dedup", "near_dedup", "mix", "byte_bpe"]
    assert all(stages[n].columns == stages["documents"].columns for n in names[:-1])


def test_toxic_documents_go(spark, stages):
    docs = stages["documents"]
    machine = toxicity.train(docs, read(spark, SF, "labels"))
    want = {r.doc_id for r in toxicity.scores(docs, machine).where("toxic_score < 0.5").collect()}
    assert set(texts(stages["toxicity"])) == want and len(want) > 150


def test_copies_go(stages):
    first = {}
    for i, text in sorted(texts(stages["toxicity"]).items()):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", text), i)
    assert set(texts(stages["exact_dedup"])) == set(first.values())


def test_near_copies_go(stages):
    sets = {}
    for i, text in texts(stages["exact_dedup"]).items():
        w = text.lower().encode().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    low = {i: i for i in sets}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    for _ in sets:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    assert set(texts(stages["near_dedup"])) == {i for i in sets if low[i] == i}


def test_mix_keeps_all_in_its_order(stages):
    kept, mix = stages["near_dedup"], stages["mix"]
    assert texts(mix) == texts(kept)
    order = [r.doc_id for r in mixing.schedule(kept, mixing.tempered_shares(kept)).orderBy("mix_slot", "mix_row").collect()]
    files = {}
    for r in mix.selectExpr("_metadata.file_path AS f", "_metadata.row_index AS i", "doc_id").collect():
        files[r.f, r.i] = r.doc_id
    assert [files[k] for k in sorted(files)] == order


def test_run_ends_in_the_order_of_the_mix(spark, stages):
    mix = stages["mix"]
    order = mixing.schedule(mix, mixing.tempered_shares(mix)).orderBy("mix_slot", "mix_row")
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages["byte_bpe"].columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, stages["byte_bpe"].collect()), key=str)
    assert [r.doc_id for r in got.orderBy("mix_slot", "mix_row").collect()] == [r.doc_id for r in order.collect()]


def test_ids_are_the_library_s(stages):
    own, _ = byte_bpe.encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in stages["byte_bpe"].collect()}
    want = {}
    for i, text in texts(stages["mix"]).items():
        ids = library.encode_ordinary(text)
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    assert got == want


def test_stages_of_an_empty_table(spark):
    docs = read(spark, SF, "documents").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []


def test_queries_are_registered():
    import __spark_entry__ as contract

    assert importlib.util.find_spec("corpus_pipeline")
    found = contract.queries()
    assert [n for n in range(1, 11) if sum(k.startswith(f"op{n}_") for k in found) != 1] == [] and "pipeline" in found
    assert set(SQL) <= set(QUERIES) <= set(found) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    import duckdb
    from compare import difference

    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_a_worker_keeps_nothing_of_the_stage_before(spark, monkeypatch):
    """The encoder and its memos go when texts come to another operator, not
    when they come to its own."""
    import pyarrow as pa

    from plumbline.llm import near_dup

    docs = spark.createDataFrame([(1, "some words of a text")], "doc_id bigint, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    batch = pa.RecordBatch.from_pylist([{"doc_id": 1, "text": "some words of a text"}])
    path, kept = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), byte_bpe.encoder
    for _ in range(2):
        assert len(list(byte_bpe.encode_documents(docs, path, public_tokenizers.PATTERN)(iter([batch])))) == 1
        own = kept(path, public_tokenizers.PATTERN)
    hits = kept.cache_info().hits
    list(byte_bpe.encode_documents(docs, path, public_tokenizers.PATTERN)(iter([batch])))
    assert kept.cache_info().hits == hits + 1 and kept(path, public_tokenizers.PATTERN) is own
    assert len(list(near_dup.sketches(docs)(iter([batch])))) == 1
    assert kept.cache_info().currsize == 0
