"""Small tables with every odd case, for all operators."""
import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, n_tokens string, kept string, digest string, locator string, " \
         "__sha string, __id string, __text string, __rate string, __n_tokens string, row string, copies string, kept_id string"


def odd_rows():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    long = " ".join(rng.choice(words) for _ in range(40_000))
    near = [rng.choice(words) for _ in range(300)]
    other = near[:150] + ["changed"] + near[151:]
    texts = [
        (1, "Hello  World, it's 42!"), (2, None), (3, ""), (4, "hello  world, it's 42!"), (None, "HELLO  WORLD, IT'S 42!"),
        (5, long), (6, long), (7, " ".join(near)), (8, " ".join(other)), (9, " \t\n"), (10, "one two"), (11, "One two"),
        (12, "é ß € “x” <|endoftext|> İ \U0001F600"), (12, "é ß € “x” <|endoftext|> İ \U0001F600"), (7, " ".join(near)),
        (None, None), (13, "x" * 500), (14, "y" + "x" * 120 + "z"), (15, "two words\nand " + "x" * 60),
    ]
    return [(i, t, None, "s", None, 99, "clash", "clash", None, "clash", *["clash"] * 8) for i, t in texts]


def frame(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)


def docs(spark, pairs):
    return spark.createDataFrame(list(pairs), "doc_id long, text string")
