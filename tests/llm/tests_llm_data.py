"""Small tables with the awkward rows: nulls, empties, ties, repeats, very long texts, clashing columns."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASH = ["row", "fp", "size", "key", "words", "range", "row_no", "n_words", "taken__", "doc__", "rid__", "blob__", "made", "x", "score", "DOC"]


def sentence(k: int, n: int = 40) -> str:
    return " ".join(f"w{(k * 7919 + i * i * 31 + i) % 997}" for i in range(n))


def awkward(spark):
    rows = [
        (1, "Alpha beta gamma delta epsilon. Released under the MIT License. zeta eta theta", "en", "a", 60),
        (2, None, "en", "a", None),
        (3, "", None, "b", 0),
        (4, " \n\t ", "en", None, 4),
        (5, sentence(5), "en", "b", 100),
        (5, sentence(5), "en", "b", 100),
        (6, sentence(5), "en", "c", 100),
        (None, sentence(7), "de", "c", 90),
        (None, sentence(8), "de", None, 90),
        (7, sentence(9, 30_000), "en", "a", 5),
        (8, "mail bosbt.42@mail8.example.com or bosbt.42 again password=b7db7aa4a5fcc78305 end", "fr", "a", 5),
        (9, "é ü ß ñ 你好 \U0001f600 x", "es", "b", 5),
        (10, "one two", "en", "c", 7),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for k, c in enumerate(CLASH):
        df = df.selectExpr("*", f"{k} AS `{c}`")
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)
