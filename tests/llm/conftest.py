import glob
import os
import random

import duckdb
import pytest

# Letters, signs, white space of several kinds, combining marks, emoji, other scripts.
ALPHABET = "abcdeABCXYZ  \n\t\r\x0b\x0c\x1c\x85\xa0 '’.,!#$%|<>&*éßΣσςİı中文字ก็ा́\U0001f600\U0001f468‍0123٣½"


def noise(seed: int, size: int) -> str:
    rng = random.Random(seed)
    return "".join(rng.choice(ALPHABET) for _ in range(size))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, SHARD int"


def messy_rows():
    """Nulls in every column, empty, white, long, equal and repeated rows."""
    words = "the quick brown fox jumps over a lazy dog and runs far away from it".split()
    long_text = " ".join(words[i * 7 % 15] + str(i % 97) for i in range(20_000))
    lines = "\n".join(" ".join(words[i:] + words[:i]) for i in range(10))
    texts = [
        None, "", " \t\n", "x", "a b", long_text, lines, lines, lines.upper(), "z" * 5000,
        lines + "\nmore", "\n".join([lines, "between", lines]), "ÀÉ " * 40, "àé " * 40,
        *[noise(i, 300) for i in range(12)],
    ]
    rows = [
        (i, t, ["en", "de", None][i % 3], ["s1", "s2", None, "s1"][i % 4], len(t or ""), "yes", i)
        for i, t in enumerate(texts)
    ]
    rows += [rows[6], rows[6], (None, lines, None, None, None, None, None), (None,) * 7]
    return rows


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table_of(columns, rows):
    """Rows as sorted tuples, columns by name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        ([None if r[i] is None else str(r[i]) for i in order] for r in rows), key=str
    )


@pytest.fixture(scope="session")
def same():
    def check(df, connection, sql):
        result = connection.execute(sql)
        columns = [d[0] for d in result.description]
        assert table_of(df.columns, df.collect()) == table_of(columns, result.fetchall())

    return check
