import pytest
from odd_texts import odd_texts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, row string, body string, line long, made string, _key int"


@pytest.fixture
def odd_rows():
    """Rows of an odd table: repeated rows, a null id, ties, null sources and columns whose names the operators use."""
    texts = odd_texts()
    rows = [(i * 3, t, "en", ["s1", "s2", None][i % 3], None if t is None else len(t), 1, "r", "b", 2, "m", 3) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[0], rows[14], (None, texts[0], None, "s1", 1, None, None, None, None, None, None), (6, texts[7], "en", "s2", 5, 1, "r", "b", 2, "m", 3)]


@pytest.fixture
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(5)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
