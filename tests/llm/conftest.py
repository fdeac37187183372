import random

import pytest
from pyspark.sql import types as T

WORDS = [a + b for a in ("lor", "ip", "dol", "am", "con", "sec", "adi", "eli", "mag", "nul") for b in ("em", "sum", "or", "et", "um", "ix")]


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus(seed=7):
    """Plain, copied, edited, repeated, blank, odd and long texts; (doc_id, text)."""
    rng = random.Random(seed)
    passage, line = sentence(rng, 70), "All of these many lines are licensed alike to nobody at all"
    texts = [sentence(rng, rng.randint(30, 120)) + "\n" + sentence(rng, 25) for _ in range(14)]
    texts += [texts[0], texts[0], texts[1]]                                      # exact copies
    for k in (2, 3, 3, 3):                                                       # edited copies
        w = texts[k].split(" ")
        for _ in range(2):
            w[rng.randrange(len(w))] = "changed" + rng.choice(WORDS)
        texts.append(" ".join(w))
    texts += [sentence(rng, 40) + " " + passage + " " + sentence(rng, 30) for _ in range(3)]
    texts += [line + "\n" + sentence(rng, 50) + "\n" + line, line.upper() + "!\n" + sentence(rng, 40), line]
    texts += [None, "", " \t\n\x0b\x0c\r ", "one", "two words", " no　break   é ÀÉ ß\U0001f642", "same " * 200, "x" * 3000]
    texts += ["\n".join([sentence(rng, 12)] * 6), sentence(rng, 3000), "Shout NOW!! " * 30, "a | b # c & " * 20]
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With extra columns named as the operators name their own."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           *(T.StructField(c, T.LongType()) for c in ("key", "tag", "row", "h", "n", "u", "v", "node", "first", "words", "n_words", "id"))])
    return spark.createDataFrame([(i, t, *range(12)) for i, t in rows], schema).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)
