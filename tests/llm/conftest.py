from __future__ import annotations

import pyarrow.parquet as pq
import pytest
from samples import LONG, SF

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, key string, pos int, part long, fp long")


@pytest.fixture(scope="session")
def sf_docs():
    """doc_id -> text of the smallest documents table."""
    rows = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] for r in rows}


@pytest.fixture(scope="session")
def odd_texts():
    """(doc_id, text): nulls, empty and long texts, ties, repeated rows and ids."""
    shared = "a line that many texts hold\n"
    return [
        (1, None), (2, ""), (3, LONG), (4, shared + "x"), (5, shared + "y\n" + shared),
        (5, shared + "y\n" + shared), (6, "  A LINE that many texts hold\t\nz"), (7, " \t\n\n "),
        (None, shared + "no id"), (None, None), (8, "é漢字😀 <|endoftext|> 'S s's\x00\x0b１２"),
        (9, "Licensed under CC BY-NC 4.0.\nMIT\nLicense, mit license"), (10, "one two three"),
        (10, "another text of the same id"),
    ]


@pytest.fixture
def odd_docs(spark, odd_texts):
    rows = [(i, t, None if i == 7 else "en", None if i in (3, 6) else f"s{(i or 0) % 3}", 0,
             "r", "k", 1, 2, 3) for i, t in odd_texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
