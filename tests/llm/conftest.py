import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum, dolor " * 4000
#: Nulls, empty and very long texts, repeated rows, ties; further columns, some with names that operators use.
ODD = [(1, "The cat sat on the mat and the dog sat on the cat's mat again today.", "en", "a", 7, 1.5), (2, None, None, None, None, None),
       (3, "", "en", "a", 0, 0.0), (3, "", "en", "a", 0, 0.0), (4, LONG, "en", "a", 1, 2.0), (4, LONG, "en", "a", 1, 2.0), (5, LONG, None, "b", 1, 2.0),
       (None, "no key <|endoftext|> mail a.b@c.de", "de", "b", 3, 1.0), (6, " \t\n\x0b\x0c\r ", "", "", 5, 1.0),
       (7, "Ünïcödé 漢字 😀 \x1c é +1 (234) 567-8901 4111 1111 1111 1111 1.2.3.256 1.2.3.4", "fr", "c", 4, 1.0)]
SCHEMA = "doc_id long, text string, lang string, source string, n long, score double"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
