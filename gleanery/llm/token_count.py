"""Token counts with a whole-token shortcut.

Offline, on the driver, the merges of every vocabulary string are run to the end; those that end
as one token are proven. In a count, a pre-token that is a proven string counts as one token
without further work, and only the rest go through merges. The proven table is bounded by the
vocabulary file and is broadcast.

Defined results: a null text counts as empty, with no bytes and no tokens; special strings inside
texts count as one token each, as the library's default has it; rows are counted one by one, so
repeated rows and null ids pass through; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.bpe import REMEMBERED, Vocabulary, prove_whole_tokens, splitter


def counter(vocabulary: Vocabulary, proven: frozenset[str], remembered: int = REMEMBERED) -> Callable[[str], int]:
    class Counts(dict):
        """Tokens by pre-token: the proven ones from the start, merged ones as they come."""

        def __missing__(self, pre_token: str) -> int:
            n = len(vocabulary.merge(vocabulary.letters(pre_token)))
            if len(self) >= len(proven) + remembered:
                self.clear()
                self.update(dict.fromkeys(proven, 1))
            self[pre_token] = n
            return n

    counts, split = Counts.fromkeys(proven, 1), splitter(vocabulary.path)
    counts = Counts(counts)
    one = counts.__getitem__
    has_special = tuple(vocabulary.special)

    def count(text: str) -> int:
        if any(s in text for s in has_special):
            return sum(1 if special else sum(map(one, split(piece))) for piece, special in vocabulary.pieces(text))
        return sum(map(one, split(text)))

    return count


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    vocabulary = Vocabulary(tokenizer_path)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, prove_whole_tokens(vocabulary)))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(*shared.value)
        for batch in batches:
            texts = batch.column("text")
            tokens = pa.array([count(t.as_py()) for t in texts], pa.int64())
            sizes = pa.compute.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, tokens, pa.compute.greater(tokens, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
