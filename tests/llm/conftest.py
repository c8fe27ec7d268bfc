import duckdb
import pytest

SF001 = "/root/testdata/sf0.001"

# Columns that share names with what the operators add.
EXTRA = ["text", "lang", "source", "n_chars", "key", "size", "row", "n", "uid", "node", "bin", "_row", "_i", "data", "score", "sig", "n_bytes"]


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def texts(duck):
    """(doc_id, text) of the smallest documents table."""
    return duck.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def odd(texts):
    """Nulls, empty and long texts, ties and repeated rows next to real ones."""
    some = [(i, t) for i, t in texts[:60]]
    long = "\n".join(t for _, t in texts[:40]) * 3
    return some + [
        (1000, None), (1001, ""), (1002, " \t\n\x0b\x0c\r "), (None, None), (None, texts[0][1]), (1003, texts[1][1].replace(" ", "  ")),
        (1004, texts[2][1]), (1004, texts[2][1]), (1005, long), (1006, "x" * 5000), (1007, "a b c"), (1008, "A B  C"), (1009, "one"),
        (1010, texts[5][1] + " more words here"), (1011, "é" * 300), (1012, "ab" * 400), (1013, "😀 " * 40),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd):
    """The odd rows as a table with many more columns, over several partitions."""
    rows = [(i, t, "en" if (i or 0) % 2 else None, None if i is None or i % 7 == 0 else f"s{i % 3}", len(t or "")) + ("x",) * (len(EXTRA) - 4) for i, t in odd]
    kinds = ", ".join(f"`{c}` {'long' if c == 'n_chars' else 'string'}" for c in EXTRA)
    return spark.createDataFrame(rows, f"doc_id long, {kinds}").repartition(5)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


def tuples(df):
    return [tuple(r) for r in df.collect()]
