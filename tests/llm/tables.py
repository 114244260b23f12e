"""Small tables for the tests of this folder."""

import duckdb
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)
# Nulls in every column, empty, white space only, repeated rows, ties, odd characters.
HARD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "a",
    "The  same\ttext",
    "The same text",
    "The same text",
    "12345 67 !!",
    "日本語 テスト 😀 naïve É",
    " leading and trailing ",
    "it's <|endoftext|> they'll\r\n\r\nWARC/1.1 x",
    "word " * 3000,
    "x" * 4000,
]


def documents(spark, texts=HARD_TEXTS, ids=None):
    rows = [
        (i if ids is None else ids[i], t, None if i % 5 == 4 else "en", None, None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def oracle(sf_dir, sql):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    return columns, sorted(found.fetchall(), key=repr)


def rows_of(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
