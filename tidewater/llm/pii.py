"""Finding and replacing personal information in free text with the skip-chain field."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import spread
from .pii_field import Field
from .pii_lexer import TYPES

WEIGHTS = Path(__file__).with_name("pii_weights.json")


def placeholder(kind: str) -> str:
    return f"[{kind}]"


def occurrences(field: Field, text: str) -> list[tuple[str, int, int]]:
    """(type, start, end) in characters, in order, not overlapping; ends are exclusive."""
    return [(TYPES[kind.split("_")[0]], s, e) for s, e, kind, _ in field.spans(text)]


def redact(text: str, found: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, s, e in found:
        out += [text[at:s], placeholder(kind)]
        at = e
    return "".join(out) + text[at:]


def _finder(field: Field):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.set_threshold(100_000)  # many small tuples, no cycles
        for batch in batches:
            rows: list[int] = []
            found: list[tuple[str, int, int]] = []
            for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if text:
                    got = occurrences(field, text)
                    found += got
                    rows += [i] * len(got)
            keys = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.int32()), pa.array([x[2] for x in found], pa.int32())],
                [*batch.schema.names[:-1], "pii_type", "start_pos", "end_pos"],
            )

    return find


def _redactor(field: Field):
    def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.set_threshold(100_000)
        for batch in batches:
            texts, counts = [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                got = occurrences(field, text) if text else []
                texts.append(redact(text, got) if text else text)
                counts.append(len(got))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(counts, pa.int32())], [*batch.schema.names[:-1], "redacted_text", "replaced"])

    return clear


def _keyed(documents: DataFrame, keep: list[str], text: str) -> tuple[DataFrame, str]:
    rows = spread(documents.select(*keep, F.col(text).alias("__text")))
    return rows, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])


def find_pii(documents: DataFrame, keep: list[str], text: str, weights: str | Path = WEIGHTS) -> DataFrame:
    """(keep columns, pii_type, start_pos, end_pos), one row per occurrence; positions count characters.

    NULL, empty and blank texts give no row, repeated rows each give their own; a text is always
    read whole, and links between mentions never leave it.
    """
    rows, kinds = _keyed(documents, keep, text)
    return rows.mapInArrow(_finder(Field.load(str(weights))), f"{kinds}, pii_type string, start_pos int, end_pos int")


def redact_pii(documents: DataFrame, keep: list[str], text: str, weights: str | Path = WEIGHTS) -> DataFrame:
    """(keep columns, redacted_text, replaced): each occurrence becomes [TYPE], all else stays as it was.

    NULL stays NULL and empty stays empty, with 0 replaced.
    """
    rows, kinds = _keyed(documents, keep, text)
    return rows.mapInArrow(_redactor(Field.load(str(weights))), f"{kinds}, redacted_text string, replaced int")
