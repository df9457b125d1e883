"""Hard rows that every operator meets: nulls, empty and long texts, repeated rows, ties, clashing column names."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, words int, statistics int, bucket int, row int"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
TEXTS = [
    (1, "The quick brown fox. It jumps over the lazy dog!\nAgain and again it jumps over the lazy dog."),
    (2, None),
    (3, ""),
    (4, " \t\n\r "),
    (5, "one"),
    (6, "Ünï çödé 😀 ß 漢字 password=äbc123 and more"),
    (7, LONG),
    (8, "The quick brown fox. It jumps over the lazy dog!\nAgain and again it jumps over the lazy dog."),
    (1, "The quick brown fox. It jumps over the lazy dog!\nAgain and again it jumps over the lazy dog."),
    (None, "a row without a number but with some words in it"),
    (9, "same same same same same same same same same same same same same same same same same same same same same same same"),
    # words whose unkeyed hashes are equal
    (11, "abcdefghijklmnop"),
    (12, "ivchbrsji4}i7t>{"),
    (13, "head " * 34 + "abcdefghijklmnop"),
    (14, "head " * 34 + "qlrgleemdu\\iA%C#"),
    (10, "tab\tseparated text  with   spaces \n\n\n and\x0bmore\x0c"),
]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", 1, 2, 3, 4) for i, t in texts], SCHEMA)
