"""Awkward rows that every document operator must take: nulls, empty, long, ties, repeats, clashing names."""

WORDS = "the quick brown fox jumps over the lazy dog while seven grey owls watch from an old oak tree near town".split()
LONG = " ".join(WORDS[i * i % len(WORDS)] + str(i % 97) for i in range(30_000))
ROWS = [
    (1, "the quick  brown fox\tjumps over the lazy dog and runs far away"),
    (2, "the quick brown fox jumps over the lazy dog and runs far away"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, LONG),
    (7, LONG),
    (8, "Straße ÇÉ x́ \U0001f600 日本語  nbsp"),
    (9, "The Quick brown fox jumps over the lazy dog and runs far away"),
    (10, "one"),
    (10, "one"),
    (None, "one"),
    (None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, digest string, key int, u string"


def documents(spark, rows=ROWS):
    """Rows with the usual columns and extra ones whose names operators use inside."""
    return spark.createDataFrame([(i, t, None, None, None, 5, "d", 1, "u") for i, t in rows], SCHEMA)


def thue_morse(size):
    """A word of a and b and its complement, which differ in every place and yet agree in any polynomial modulo 2**64
    with an odd base, if size is large enough."""
    bits = [bin(i).count("1") & 1 for i in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
