"""Small fixtures shared by the tests."""

from pathlib import Path

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return (text or "").encode().split()


def documents():
    """The smallest documents table as rows (doc_id, text)."""
    t = pq.read_table(Path(SF) / "documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return list(zip(t["doc_id"], t["text"]))


def frame(spark, rows, parts=3):
    """(doc_id, text) rows as a documents table."""
    return spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], SCHEMA).repartition(parts)
