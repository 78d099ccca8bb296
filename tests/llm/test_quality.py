"""Quality rules beside columns of any name."""

from inkspool.llm import quality


def test_extra_columns_of_any_name(spark):
    data = [(1, " ".join(f"w{k}" for k in range(60)) + "\n| a | b |", "x", 7, "y", 1, "t", True, "r", "a")]
    df = spark.createDataFrame(data, "doc_id long, text string, _text string, N_WORDS long, _words string, _windows int, _judged string, Kept boolean, _row string, `a.b` string")
    out = quality.clean(df)
    assert out.columns == df.columns
    row = out.first()
    assert row.text == " ".join(f"w{k}" for k in range(60)) and tuple(row)[2:] == data[0][2:]
    got = quality.measure(df)
    assert got.columns == ["doc_id", "text", "_text", "_words", "_windows", "_judged", "_row", "a.b", *quality.OWN]
    assert got.first().n_words == 65 and got.first()._text == "x"
