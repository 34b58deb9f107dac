import duckdb
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from linecraft.llm import byte_cnn, oracles, registered  # noqa: E402
from linecraft.testing import compare, duckdb_connection  # noqa: E402

from . import test_decontamination, test_near_duplicates, test_packing, test_secrets  # noqa: E402
from .fixtures_llm import awkward, prose, same  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def folder(spark, tmp_path):
    texts = [(i, prose(i, 60)) for i in range(60)] + [(100 + i, prose(i, 60) + " end") for i in range(5)]
    texts += [(200, "x " + prose(1, 30)), (201, prose(7, 40) + " token = \"" + "ab12" * 8 + "\""), (202, "*** ### " * 40)]
    df, rows = awkward(spark, texts)
    docs = df.select("doc_id", "text").selectExpr("*", "'en' as lang", "'s' as source", "cast(length(text) as bigint) as n_chars", "'z' as score")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, 0) for i in range(40)] + [(1000 + i, 0, 0) for i in range(30)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    items = [(1, prose(1, 30)), (2, None)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_one_by_one(spark, folder, tmp_path):
    docs = corpus_pipeline._table(spark, folder, "documents")
    columns = docs.columns
    before = {(r["doc_id"], r["text"]) for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / f"stage{k}"))
        out = spark.read.parquet(str(tmp_path / f"stage{k}"))
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        if name == "packing":
            assert test_packing.check(rows, out.collect()) == 0
            break
        assert out.columns == columns
        kept = [(r["doc_id"], r["text"]) for r in out.collect()]
        if name == "quality classifier":
            assert set(kept) <= before
        if name == "near duplicates":
            ids = [d for d, _ in kept if d is not None]
            want = {c for d, _, c in test_near_duplicates.brute(rows, 5) if d is not None}
            assert set(ids) == want and len(ids) == len(want)
        if name == "benchmark decontamination":
            dirty = test_decontamination.brute(rows, [(1, prose(1, 30)), (2, None)])
            same(kept, [r for r, b in zip(rows, dirty, strict=True) if not b[-1]])
        if name == "secret scans":
            assert len(kept) == len(rows)
            assert not any(test_secrets.brute_spans(t) for _, t in kept)
        docs = out


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    ids = {r["doc_id"] for r in out.collect()}
    assert 0 in ids and not ids & {100, 200}
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(oracles.ORACLE_SQL))
def test_oracles_over_the_given_tables(spark, name):
    got = compare(registered.QUERIES[name](spark, SMALL), duckdb_connection(SMALL), oracles.ORACLE_SQL[name])
    assert got["values_match"], got


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in registered.QUERIES) == list(range(1, 14))
    assert duckdb and byte_cnn
