import pytest

from ratewise.llm.shipping import send_package


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    send_package(spark)


#: Texts that every operator has to bear, by doc_id; 7 and 8 are repeated rows.
ODD = {
    1: None,
    2: "",
    3: " \t\n ",
    4: "one",
    5: "Ünïcode, 世界 words\x0bhere\x0cand there",
    6: "word " * 60_000,
    9: "x" * 300_000,
}


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en", "src0", 1, "clash") for i, t in ODD.items()]
    rows += [(7, "the same row of words", None, None, None, "clash")] * 2
    rows += [(7, "another text under that id", "de", "src1", 3, "clash")]
    rows += [(None, "a text without any id", "en", "src0", 2, "clash")] * 2
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_docs string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
