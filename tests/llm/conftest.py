import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
# Names that operators use inside: extra columns of a table may have them too.
CLASHING = ("mark", "keys", "row", "size", "block", "component_id", "spans", "copies", "x", "n", "rep", "text2")


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def corpus(seed=3):
    """Texts with exact and near copies, shared passages, short, empty, null
    and long texts, odd white space and other alphabets."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéßü") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    passage, line = prose(rng, 30, words), prose(rng, 9, words)
    texts = [prose(rng, rng.randint(1, 90), words) for _ in range(40)]
    for i in range(0, 12):
        w = texts[i].split(" ")
        if len(w) > 8:
            w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += texts[:6]
    texts += [prose(rng, 10, words) + "\n" + passage + "\t" + prose(rng, 10, words) for _ in range(8)]
    texts += [line + "\n" + prose(rng, 12, words) for _ in range(8)]
    texts += ["", None, " \t\n", "one", "one two three four", "ONE Two three Four", "same " * 300, "same " * 200,
              prose(rng, 20_000, words), "\x00\x01 odd \x7f bytes " * 5, "日本語 の テキスト " * 10, "日本語 の テキスト " * 10]
    return [(i, t, "en", f"s{i % 4}" if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture
def make_docs(spark):
    def make(data, clash=False):
        df = spark.createDataFrame(data, DOCS)
        if clash:
            from pyspark.sql import functions as F
            for name in CLASHING:
                df = df.withColumn(name, F.lit("clash"))
        return df.repartition(5)
    return make


@pytest.fixture
def in_folder(spark, tmp_path):
    """A folder of Parquet tables, as the queries read them."""
    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write
