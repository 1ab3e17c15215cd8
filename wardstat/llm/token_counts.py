"""Token counts of a sentencepiece model without materialising ids per document.

A piece of the model never holds a space mark after another character (checked when the model is loaded), so a text
falls apart, before every run of spaces, into pre-tokens that are encoded independently. A task counts the pieces of each
distinct pre-token once, joins them to every document's pre-token frequencies and sums. No row is shuffled.

Null text is empty; an empty text has no tokens; repeated rows are counted each; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Distinct pre-tokens whose piece counts a task remembers (about 150 MB); a fuller table is emptied and refilled.
TABLE_ENTRIES = 500_000
#: Texts whose new pre-tokens are counted together.
TEXTS = 256
_RUN = re.compile(r" *[^ ]+| +$")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, each without its first space mark (the model adds one in front of any text)."""
    text = text.replace(MARK, " ")
    if not text:
        return []
    if text[0] != " " and text[-1] != " " and "  " not in text:
        return text.split(" ")
    return [s[1:] for s in _RUN.findall(" " + text)]


class PieceTable:
    """Pieces of each distinct pre-token, counted once."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        if any(MARK in p.lstrip(MARK) for p in pieces) or len(self.model.encode("a  b")) != 3:
            raise ValueError("this model's pieces cross spaces or it changes them; pre-tokens cannot be counted apart")
        self.count: dict[str, int] = {}

    def totals(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text from its pre-token frequencies, after the new pre-tokens of all were counted at once."""
        frequencies = [Counter(pre_tokens(t or "")) for t in texts]
        if len(self.count) > TABLE_ENTRIES:
            self.count = {}
        known = self.count
        new = [t for t in set().union(*frequencies) if t not in known]
        known.update(zip(new, map(len, self.model.encode(new, num_threads=1))))
        known[""] = 1                           # a lone space mark at the end of a text
        return [sum([known[t] * n for t, n in f.items()]) for f in frequencies]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row; ``model_path`` must be readable on every executor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PieceTable(model_path)
        for batch in batches:
            texts = batch.column("t")
            found = [n for i in range(0, len(texts), TEXTS) for n in table.totals(texts.slice(i, TEXTS).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), pa.array(found, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
