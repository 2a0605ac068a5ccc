"""Small tables with every awkward case, and their registration with the SQL engine."""

import random
import re

import duckdb
import pyarrow as pa

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def documents(seed=1, n=60):
    """Random documents with copies, near copies, shared passages, repeated lines, NULLs, empty and long texts, ties."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    say = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage, line = say(70), "  A Shared Line of More than Twenty Signs\t"
    texts = []
    for _ in range(n):
        kind = rng.random()
        text = "\n".join(say(rng.randint(1, 40)) for _ in range(rng.randint(1, 6)))
        if kind < 0.15 and texts:
            text = rng.choice(texts)
        elif kind < 0.35 and texts:
            w = rng.choice(texts).split(" ")
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
            text = " ".join(w)
        elif kind < 0.5:
            text += "\n" + passage[: rng.randint(250, len(passage))] + "\n" + text
        elif kind < 0.7:
            text += "\n" + line + "\n" + line.lower() + "\nx"
        texts.append(text)
    run, turn = " ".join(["a"] * 130), " ".join(["a b"] * 70)
    texts += [None, "", " \n\t\n", "one", "one", "two Words", "TWO words", run, run + " b", "b " + run[:-20], turn, "c " + turn, say(30_000)]
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "ß", None]), 0) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return [*rows, (None, texts[3], "en", "s1", 0), (None, texts[3], "en", "s1", 0), rows[5], rows[6]]


def frame(spark, rows, schema=SCHEMA):
    """With other columns whose names the operators use themselves."""
    clashing = {"tag": 1, "row": 2, "n_words": 3, "kept": 4, "key": 5, "id": 6, "node": 7, "size": 8, "order": 9, "times": 10, "own_id": 11, "copy": 12}
    made = spark.createDataFrame(rows, schema)
    from pyspark.sql import functions as F

    return made.withColumns({c: F.lit(v) for c, v in clashing.items() if c not in made.columns})


def vectors(spark, rows):
    """With other columns whose names the operator uses itself."""
    from pyspark.sql import functions as F

    made = spark.createDataFrame(list(rows), "vec_id bigint, embedding array<float>, label int")
    return made.withColumns({c: F.lit(1) for c in ("row", "v", "rank", "row_block", "anchor_id", "positive_id", "a.b")})


def folder(spark, path, rows, benchmark=(), pages=(), embeddings=()):
    """The tables as a folder that queries read."""
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(benchmark), "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    vectors(spark, embeddings).write.parquet(f"{path}/embeddings.parquet")
    spark.createDataFrame(list(pages), "page_id bigint, url string, html string").write.parquet(f"{path}/pages.parquet")
    return str(path)


def by_sql(path, sql, tables=("documents", "benchmark", "pages", "embeddings")):
    connection = duckdb.connect()
    for t in tables:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet/*.parquet')")
    result = connection.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def same_rows(df, columns, rows):
    found = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    assert found == sorted(rows, key=str)


def text_array(texts):
    return pa.array(texts, pa.string())
