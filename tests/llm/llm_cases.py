"""Small documents with every awkward case, shared by the operators' tests."""

import random
import zlib

#: Columns whose names clash with those the operators make themselves.
CLASHES = ("uid", "_row_id", "fp", "digest", "kept", "size", "taken", "sources", "cell", "rank",
           "h", "lang_pred", "score", "component_id", "shard", "n_words", "words", "slice", "pattern")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, base="ba be bi bo da de di do la le li lo".split()):
    return " ".join("".join(rng.choice(base) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows(seed=0):
    rng = random.Random(seed)
    out = [(i, words(rng, rng.randint(3, 120)), rng.choice(["en", "fr", None]), f"s{i % 4}", 0) for i in range(40)]
    long = words(rng, 9000)
    out += [
        (100, None, "en", None, None),                       # null text and source
        (101, "", "fr", "s0", 0),
        (102, " \t\n\x0b\x0c\r ", None, "s1", 0),            # blanks only
        (None, out[3][1], None, "s2", 0),                    # null id, a copy of row 3
        (103, out[3][1].upper(), "en", "s3", 0),             # equal after lower-casing
        (104, out[5][1], "en", "s0", 0), (104, out[5][1], "en", "s0", 0),   # repeated rows
        (105, long, "en", "s1", 0), (106, long + " tail", "en", "s1", 0),   # very long
        (107, "x" * 70_000, "en", "s2", 0),                  # no place to cut
        (108, "ÄÖÜ ß é 中文 текст 🙂 <|endoftext|>", "de", "s2", 0),
        (109, "12 34 !!", "en", "s3", 0),                    # no letter
        (None, None, None, None, None),                      # all null
    ]
    return out


def frame(spark, data, clashes=True):
    df = spark.createDataFrame(data, SCHEMA).coalesce(3)
    if clashes:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHES])
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())
