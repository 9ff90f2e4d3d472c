from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tellmark.llm import token_counts as tc

LIBRARY = Tokenizer.from_file(tc.TOKENIZER)
MACHINE = tc.Compiled(open(tc.TOKENIZER, encoding="utf-8").read())


def library_counts(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abcdelmrstvxST 'éß漢字ΣσİǺ½٣😀\n\t ​019.-!<|", max_size=40), max_size=6))
def test_same_counts_as_the_library(texts):
    assert MACHINE.counts(texts).tolist() == library_counts(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_any_text(texts):
    assert MACHINE.counts(texts).tolist() == library_counts(texts)


def test_contractions_and_special_strings():
    texts = ["it's 're 'r 'rx ''s !'s we'll 'l 'll'd 'S 'LL I'm' don't", "'", "'v", "x'", "<|endoftext|>a<|startoftext|><|endoftext|>", "<|endoftext", "e<|endoftext|>́"]
    assert MACHINE.counts(texts).tolist() == library_counts(texts)


def test_slices_lanes_and_a_small_memory_do_not_change_counts(monkeypatch):
    texts = ["inthing thatble eroure's 12 " * 60, "x" * 700, "abcabcabd" * 90, "", "é'll " * 50 + "漢字" * 90]
    want = library_counts(texts)
    for slice_, lane, kept in ((7, 3, 50), (64, 16, 10), (1 << 20, 5, 1 << 20), (301, 256, 0)):
        for name, value in (("SLICE", slice_), ("LANE", lane), ("KEPT", kept)):
            monkeypatch.setattr(tc, name, value)
        assert MACHINE.counts(texts).tolist() == want


def test_states_of_a_lane_compose():
    """The map of two lanes is the composition of their maps: any cut gives the same word ends."""
    words = MACHINE.words
    kinds = words.kind[[ord(c) for c in "a'r'll !'s x're'"]]
    for state in range(len(words.states)):
        whole, end = words.run(kinds, state)
        for cut in range(1, len(kinds)):
            first, middle = words.run(kinds[:cut], state)
            second, last = words.run(kinds[cut:], middle)
            assert [*first, *second] == [*whole] and last == end


def test_counts_on_transitions_are_never_negative():
    MACHINE.counts(["unbelievable antidisestablishmentarianism " + "thntreor inthing sanin"])
    assert all(n >= 0 for _, n in MACHINE.tokens.steps.values())


def test_tables(spark):
    rows = [(1, None, 5), (None, "", 6), (3, "a b", 7), (3, "a b", 7), (4, "w" * 100_000, 8), (5, " \n", 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, N_TOKENS int")
    got = tc.count_tokens(df)
    assert got.columns == ["doc_id", "text", "n_tokens"]
    assert sorted(map(str, ((r.doc_id, r.n_tokens) for r in got.collect()))) == sorted(map(str, zip([r[0] for r in rows], library_counts([r[1] for r in rows]))))
    assert tc.count_tokens(df.limit(0)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    want = dict(zip(texts, library_counts(texts.values())))
    got = tc.query(spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {d: (len(t.encode()), want[d], want[d] > 2048) for d, t in texts.items()}
    assert len(got) == len(texts)
