"""Token counts of whole texts by lookups in two tiers, with no shuffle at all.

A worker looks each word up in a bounded cache of its own first. What the cache misses is cut
into pre-tokens, and these are looked up in a broadcast table, pre-token to number of tokens, of
those the tokenizer's vocabulary holds whole: the strings its own training found most frequent, so
its size is bounded by the vocabulary and not by the data. What the table misses too is encoded by
the library and kept in a second cache. A text that cannot be cut into words goes to the library whole.

A null or empty text counts 0 tokens. Rows are independent: repeated rows and ids give
repeated results, extra columns are not read, an empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from lamina.llm.common import slices, texts_of
from lamina.llm.units import PIECES, UNITS, Remembered, Units, load_tokenizer

TOKEN_LIMIT = 512


def frequent_lengths(path: str, longest: int = 32) -> dict[str, int]:
    """Tokens of each vocabulary entry of up to ``longest`` symbols that is one pre-token."""
    model = load_tokenizer(path).model
    vocabulary = load_tokenizer(path).get_vocab(with_added_tokens=False)
    return {p: len(model.tokenize(p)) for p in vocabulary if len(p) <= longest}


class Counter:
    """Counts a text's tokens: the worker's cache of words, then broadcast table, then the library."""

    def __init__(self, path: str, frequent: dict[str, int]):
        self.units = Units(path)
        model = self.units.tokenizer.model
        missed = Remembered(lambda piece: len(model.tokenize(piece)), PIECES)

        def of_literal(text: str) -> int:
            total = 0
            for piece in self.units.pieces(text):
                known = frequent.get(piece)
                total += missed[piece] if known is None else known
            return total

        self.of_literal = of_literal
        self.of_unit = Remembered(lambda key: of_literal(self.units.literal(key)), UNITS)

    def count(self, text: str) -> int:
        cut = self.units.cut(text)
        if cut is None:
            return len(self.units.whole(text))
        return self.of_literal(cut[0]) + sum(map(self.of_unit.__getitem__, cut[1]))


def token_counts(docs: DataFrame, path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_lengths(path))

    def run(batches):
        counter = worker_counter(path, table)
        for batch in slices(batches, 2000):
            texts = batch.column("text").to_pylist()
            tokens = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return texts_of(docs).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )


_COUNTERS: dict[str, Counter] = {}


def worker_counter(path: str, table) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path, table.value)
    return _COUNTERS[path]
