"""Small tables with every awkward row, and plain Python counterparts of what the operators read."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def prose(seed, n=200, vocabulary=400):
    rng = random.Random(seed)
    made = ["".join(rng.choice("aeioumnrstlé") for _ in range(rng.randint(2, 8))) for _ in range(vocabulary)]
    return " ".join(made[int(rng.random() ** 2 * vocabulary)] for _ in range(n))


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join("changed" + str(rng.randint(0, 10**6)) if rng.random() < share else w for w in text.split())


def odd_rows():
    """Null and empty texts, a null id, ties, repeated rows, odd characters, one very long text."""
    return [
        (1, None, "en", "a", None),
        (2, "", "en", None, 0),
        (3, " \n\t ", None, "a", 3),
        (None, "some text without an id", "en", "b", 5),
        (5, "same text here and there, twice", "en", "b", 5),
        (6, "same text here and there, twice", "de", "b", 5),
        (6, "same text here and there, twice", "de", "b", 5),
        (7, "one", "en", "c", 3),
        (8, "Été à la plage 東京 🙂 <|endoftext|> it's 12.5% off\x0bnow", "fr", "c", 40),
        (9, prose(9, 30_000), "en", "c", 200_000),
    ]


def docs_table(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df):
    """Extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    taken = "id n size shard hub node component rank start end key h pos url failures n_words tokens rate copies _text _id _row".split()
    return df.withColumns({c: F.lit("extra") for c in taken})
