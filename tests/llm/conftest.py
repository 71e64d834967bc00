import random

import pytest

EXTRA = ["batch", "rep", "grp", "h", "pos", "key", "id", "shard", "range_no", "later", "sketch", "rank", "size",
         "kept_text", "n_lines", "drop", "split", "gone_id", "gone_hash", "drop_id", "_id", "n", "score", "length"]


def edge_rows(sf_rows):
    """Real rows and odd ones: null, empty and long texts, copies, near copies, passages, shared lines, repeated rows."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    words = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    out = list(sf_rows)
    i = 10_000
    passage, long = words(60), words(9_000)
    for text in (None, "", "   ", "\n\n", None, "", "one", "one", "ONE", "two words", long, long + " end",
                 passage, words(20) + " " + passage + " " + words(20), passage + " x " + passage,
                 "tab\tand\x0bvt\x0cff\rcr", "ünïcode Ünïcode <|endoftext|> ıİ  x", "a,b;c!d 'll don't"):
        out.append((i, text))
        i += 1
    base = words(150).split()
    for k in range(90):          # near copies, more than a block
        w = list(base)
        for _ in range(k % 9):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
        out.append((i, " ".join(w)))
        i += 1
    for k in range(12):          # a shared line
        out.append((i, f"{words(5)}\n  Shared LINE here\t\n{words(4)}\n\nshared line here"))
        i += 1
    out += [(i, "same row twice " + passage)] * 2 + [(None, "no id " + words(40)), (None, None)]
    return out


def write(spark, folder, rows, items, labels):
    docs = spark.createDataFrame([(d, t, "en", "src", len(t or "")) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for c in EXTRA:
        from pyspark.sql import functions as F

        docs = docs.withColumn(c, F.lit("x"))
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def edge(spark, sf, tmp_path_factory):
    """(folder, rows, items) of the small odd tables."""
    read = lambda t: [tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").collect()]
    rows = edge_rows([(r[0], r[1]) for r in read("documents")])
    items = read("benchmark") + [(900, "two words"), (901, None), (902, ""), (903, "w1"), (904, "w1"), (900, "two words")]
    long = rows[210][1].split()
    items.append((905, " ".join(long[100:130])))
    labels = read("labels") + [(None, 1, 0), (10_003, None, 0), (999_999, 1, 0)]
    folder = tmp_path_factory.mktemp("edge")
    return write(spark, folder, rows, items, labels), rows, items


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), [], [], [])
