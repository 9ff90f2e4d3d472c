import duckdb
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tellmark.llm import pieces

MODEL = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
VOCABULARY = pieces.Vocabulary.read(pieces.MODEL)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abcdefghinorstu éß漢😀▁\n\t0189.-the", max_size=40), max_size=6))
def test_same_ids_as_the_model(texts):
    assert [x.tolist() for x in VOCABULARY.encode(texts)] == MODEL.encode(texts)


def test_documents(sf):
    texts = [r[0] for r in duckdb.sql(f"select text from read_parquet('{sf}/documents.parquet')").fetchall()]
    found = [x.tolist() for x in VOCABULARY.encode(texts)]
    assert found == MODEL.encode(texts)
    assert [VOCABULARY.decode(x) for x in found] == texts


def test_segments_do_not_change_ids(monkeypatch):
    text = "the quick  brown   fox " * 200 + "\n" + "x" * 300
    monkeypatch.setattr(pieces, "SEGMENT", 50)
    assert VOCABULARY.encode([text])[0].tolist() == MODEL.encode(text)


def test_tables(spark):
    df = spark.createDataFrame([(1, None, 5), (None, "", 6), (3, "a b", 7), (3, "a b", 7)], "doc_id bigint, text string, piece_ids int")
    got = pieces.decode(pieces.encode(df)).collect()
    assert [(r.doc_id, r.decoded) for r in got] == [(1, ""), (None, ""), (3, "a b"), (3, "a b")]
    assert pieces.encode(df.limit(0)).collect() == []
    assert pieces.decode(df.select(F.lit(None).cast("array<int>").alias("piece_ids"))).first().decoded is None


def test_query(spark, sf):
    got = pieces.query(spark, sf)
    assert got.filter(~F.col("round_trip")).count() == 0 and got.count() == 200
