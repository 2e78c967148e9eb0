"""Small tables with what real ones hold: nulls, empty and long texts, ties, repeated rows, clashing names."""

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
PROSE = "\n".join(" ".join(f"p{i}q{j}" for j in range(30)) for i in range(6))

ROWS = [
    (1, PROSE, "a", 7),
    (2, PROSE, "b", 7),
    (2, PROSE, "b", 7),
    (3, PROSE.replace("p0q0", "changed"), None, None),
    (4, None, "c", 1),
    (5, "", "c", 1),
    (6, "  \n\t ", "c", 1),
    (7, LONG, "d", 2),
    (8, "Ünïcode ÉÈ straße 日本語 🙂\nZwei Wörter", "e", 3),
    (None, "a row without an id", "f", 4),
    (None, "a row without an id", "f", 4),
    (9, "x", "g", 5),
    (10, "a  b\n \n c   d", "g", 5),
]

#: Extra columns whose names an operator gives to its own results too.
SCHEMA = "doc_id long, text string, kept string, n_words int"


def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)
