import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.common import documents, frame
from wardstat.llm import token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PLAIN = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_equals_the_library_on_real_texts(spark):
    rows = documents() + [(900, None), (901, ""), (902, " "), (903, "  a  b "), (904, "▁x ▁"), (905, "<s> hi </s>\n\n x"), (906, "a" * 40_000), (907, "é ﬁ　x\x00y"), (907, "é ﬁ　x\x00y")]
    got = sorted(map(tuple, token_counts.count_tokens(frame(spark, rows), MODEL).collect()))
    assert got == sorted((i, len((t or "").encode()), len(PLAIN.encode(t or ""))) for i, t in rows)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab ▁\n\t.é漢", max_size=40))
def test_pre_tokens_cover_any_text(text):
    table = token_counts.PieceTable(MODEL)
    assert table.totals([text]) == [len(PLAIN.encode(text))]


def test_a_full_table_is_refilled(monkeypatch):
    monkeypatch.setattr(token_counts, "TABLE_ENTRIES", 3)
    table = token_counts.PieceTable(MODEL)
    for text in ("one two three four", "four five", "one six seven eight", ""):
        assert table.totals([text]) == [len(PLAIN.encode(text))]


def test_empty_table_and_other_columns(spark):
    df = frame(spark, []).withColumn("n_tokens", token_counts.F.lit("mine"))
    assert token_counts.count_tokens(df, MODEL).collect() == []
    df = frame(spark, [(1, "a b")]).withColumn("n_tokens", token_counts.F.lit("mine"))
    assert [tuple(r) for r in token_counts.count_tokens(df, MODEL).collect()] == [(1, 3, 2)]
