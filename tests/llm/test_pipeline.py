import re

import sentencepiece

import corpus_pipeline
from tellmark.llm import mixing, pieces, toxicity
from tellmark.session import stored


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def norm(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ").lower()


def test_stages(spark, sf):
    """Each stage against brute force over what its predecessor kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after_df = stored(stage(spark, docs, sf), "stage")
        after = {r.doc_id: r for r in after_df.collect()}
        assert set(after) <= set(before) and after_df.count() == len(after)
        if name == "toxicity":
            index = toxicity.fit_on_tables(spark, docs, sf)
            assert set(after) == {i for i, r in before.items() if index.scores([toxicity.term_counts(r.text)])[0][0] < 0.3}
            assert all(after[i] == before[i] for i in after)
        if name == "line dedup":
            first = {}
            for i in sorted(before):
                for line in before[i].text.split("\n"):
                    first.setdefault(norm(line), i)
            for i, r in before.items():
                left = after[i].text.split("\n") if i in after else []
                lost = [x for x in r.text.split("\n") if x not in left]
                assert all(norm(x) for x in lost)  # blank lines stay
                exact = [x for x in r.text.split("\n") if norm(x) and first[norm(x)] < i]
                assert not set(exact) & set(left)
                if not lost:  # at most lines repeated in the text itself have gone
                    assert i in after and list(dict.fromkeys(after[i].text.split("\n"))) == list(dict.fromkeys(r.text.split("\n")))
        if name == "n-gram Jaccard join":
            ids = sorted(before)
            sets = {i: shingles(before[i].text) for i in ids}
            root = {i: i for i in ids}

            def find(i):
                while root[i] != i:
                    i = root[i]
                return i
            for x in ids:
                for y in ids:
                    if x < y and len(sets[x] & sets[y]) * 100 >= 80 * len(sets[x] | sets[y]) > 0:
                        a, b = sorted((find(x), find(y)))
                        root[b] = a
            assert set(after) == {i for i in ids if find(i) == i}
        if name.startswith("mixing"):
            size = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows.values())
            assert size(after) <= 0.9 * size(before) and len(after) > 0.5 * len(before)
        if name.startswith("SentencePiece"):
            model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
            assert set(after) == set(before) and all(r.piece_ids == model.encode(r.text) for r in after.values())
        else:
            assert after_df.columns == columns
        docs, before = after_df, after


def test_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeats and extra columns pass through every stage; an empty table too."""
    rows = [(1, None, None, None, 1), (2, "", "en", "a", 2), (None, "some words in a text", "en", "a", 3), (4, " \n", "en", None, 4), (5, "b c d e f g h", None, "b", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, score int")
    sf = str(tmp_path)
    spark.createDataFrame([(1, 0), (5, 1)], "doc_id bigint, toxic int").write.parquet(f"{sf}/labels.parquet")
    for table in (docs, docs.limit(0)):
        out = stored(table, "docs")
        for _, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, out, sf), "stage")
            assert {"doc_id", "text", "lang", "source", "score"} <= set(out.columns)
        assert (out.count() > 0) == (table is docs)
    assert mixing.query
