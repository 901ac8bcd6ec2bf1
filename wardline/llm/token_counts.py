"""Token counts: most pre-tokens are one token, and only the rest are merged."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.bpe import ByteBpe, Remembered, opened, read_file, slices
from wardline.llm.python_tasks import prepare


def whole_tokens(bpe: ByteBpe) -> list[bytes]:
    """Vocabulary strings proven to encode alone as one token.

    A token can be in the vocabulary and still never come out of its own bytes, when merges of a
    better rank lead elsewhere; so each one is merged here, once, before any text is read.
    """
    return [token for token, number in bpe.ids.items() if bpe.merge(token) == [number]]


class Counter:
    """Counts tokens with the proven whole tokens as a shortcut."""

    def __init__(self, bpe: ByteBpe, proven: Iterable[bytes]):
        self.bpe = bpe
        self.known = Remembered(lambda piece: sum(len(bpe.merge(f)) for f in bpe.fragments(piece.encode())))
        self.whole = set()
        for token in proven:
            try:
                self.whole.add(token.decode())
            except UnicodeDecodeError:  # part of a character: never a whole pre-token
                continue

    def count(self, text: str) -> int:
        total, whole, known = 0, self.whole, self.known
        for part, special in self.bpe.plain_parts(text):
            if special is not None:
                total += 1
                continue
            pieces = self.bpe.pre_tokens(part)
            rest = [p for p in pieces if p not in whole]
            total += len(pieces) - len(rest) + sum(map(known.__getitem__, rest))
        return total


_counters: dict[int, Counter] = {}


def counter_for(source: str, proven: Iterable[bytes]) -> Counter:
    """The counter of a tokenizer file, which a worker keeps with what it remembers."""
    key = hash(source)
    if key not in _counters:
        _counters[key] = Counter(opened(source), proven)
    return _counters[key]


def count_tokens(
    docs: DataFrame, path: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``n_tokens`` is the number of tokens the tokenizers library gives for the file at ``path``, without
    added special tokens; a special string inside a text counts as its one token. Null and empty texts
    have 0 bytes and tokens. Rows are independent: repeated rows and null ids pass through, an empty
    table gives no rows, other columns are ignored. A very long text is counted whole by one task. The proof of whole tokens runs once on the driver.
    """
    spark = docs.sparkSession
    source = read_file(path)
    shared = spark.sparkContext.broadcast((source, whole_tokens(opened(source))))
    def run(batches):
        source, proven = shared.value
        counter = counter_for(source, proven)
        for whole in batches:
            for batch in slices(whole, "text"):
                counts = [counter.count(t) if t else 0 for t in batch.column("text").to_pylist()]
                size = pc.binary_length(batch.column("text")).cast(pa.int64()).fill_null(0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), size, pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prepare(spark)
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
