import duckdb
import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """A table of documents from (id, text, lang, source) rows, with extra columns whose names results use too."""

    def make(rows, extra="n_tokens long, kept boolean, score double, component_id long, measured string, words string"):
        wide = T._parse_datatype_string(f"struct<{', '.join(':'.join(c.split()) for c in f'{DOCS}, {extra}'.split(', '))}>")
        full = [(*row, *[None] * (4 - len(row)), len(row[1] or "")) for row in rows]
        return spark.createDataFrame([(*row, *[None] * len(extra.split(", "))) for row in full], wide)

    return make


@pytest.fixture(scope="session")
def texts():
    """Texts of the small documents table."""
    return dict(duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall())


@pytest.fixture(scope="session")
def odd():
    """Texts that operators must bear."""
    return [
        None, "", " \t\n", "a", "A b", "it's  they'LL\r\n\r\n  x", "é" * 50, "日本語 テスト 🙂", "\x00\x1c\x85\xa0", "<|endoftext|> a",
        "word " * 400, "z" * 90_000, "ab12 \n" * 20_000, " " * 70_000, "1 2 3\n1 2 3\n\n1 2 3", "###&&& $$$",
    ]
