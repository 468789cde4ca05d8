"""Token counts by a public tokenizer."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import spread

#: Vocabulary file that counts tokens unless the caller names another; it must be readable on executors.
TOKENIZER = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_50k.json")


def _counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            sizes: list[int] = []
            for i in range(0, len(texts), 256):
                sizes += [len(e.ids) for e in tokenizer.encode_batch_fast([t or "" for t in texts[i : i + 256]], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64())], [*batch.schema.names[:-1], "n_tokens"])

    return count


def token_counts(documents: DataFrame, keep: list[str], text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(keep columns, n_tokens bigint) per row; NULL and empty texts have 0 tokens, special marks count as text."""
    rows = spread(documents.select(*keep, F.col(text).alias("__text")))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_counter(tokenizer), f"{kinds}, n_tokens bigint")
