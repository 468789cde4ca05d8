"""File sources and sinks: CSV and JSON scans, Markdown documents, landing, micro-batch emitter."""

from __future__ import annotations

import csv
import hashlib
import json
import os
import shutil
from collections.abc import Iterable
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUFFIXES = (".csv", ".json", ".jsonl", ".md")
FRONT_MATTER = ("document_id", "title", "version", "effective_date", "security_class", "source_uri")
SECURITY = ("public", "internal", "restricted")


class SourceError(ValueError):
    """A file that cannot be taken in."""


def scan(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV (header) or JSON lines as strings, with _corrupt_record for lines that do not parse.

    Short CSV rows are filled with NULL, surplus fields make the line corrupt; JSON fields outside
    ``columns`` are ignored, absent ones NULL.
    """
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in columns], T.StructField("_corrupt_record", T.StringType())])
    suffix = Path(path.rstrip("/*")).suffix.lower()
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    if suffix == ".csv":
        return reader.option("header", True).option("enforceSchema", True).csv(path)
    if suffix in (".json", ".jsonl"):
        return reader.option("primitivesAsString", True).json(path)
    raise SourceError(f"no reader for {suffix or path}")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Markdown with front matter as (document_id, title, version, effective_date, security_class, source_uri, body).

    Files without the six keys, or of another security class, raise when they are read.
    """
    raw = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file"))
    head = F.regexp_extract("value", r"(?s)\A---\r?\n(.*?)\r?\n---\r?\n", 1)
    body = F.regexp_replace("value", r"(?s)\A---\r?\n.*?\r?\n---\r?\n", "")
    field = lambda k: F.trim(F.regexp_replace(F.regexp_extract(head, rf"(?m)^{k}:[ \t]*(.*?)[ \t]*\r?$", 1), "^[\"']|[\"']$", ""))
    out = raw.select(*[field(k).alias(k) for k in FRONT_MATTER], body.alias("body"), "file")
    bad = F.lit(False)
    for k in FRONT_MATTER:
        bad = bad | (F.col(k) == "")
    bad = bad | ~F.col("security_class").isin(*SECURITY)
    checked = F.when(bad, F.raise_error(F.concat(F.lit("bad front matter in "), F.col("file")))).otherwise(F.col("document_id"))
    return out.withColumn("document_id", checked).drop("file")


def sha256_file(path: str | Path) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def stage(path: str | Path, landing: str | Path, source: str) -> dict:
    """Copies a source file to its immutable place; the same content again is ALREADY_STAGED.

    Different content under a name that is taken, empty files, and unknown suffixes raise.
    """
    path, landing = Path(path), Path(landing)
    if not path.is_file() or path.suffix.lower() not in SUFFIXES or path.stat().st_size == 0:
        raise SourceError(f"cannot stage {path}")
    checksum = sha256_file(path)
    target = landing / source / path.name
    manifest = {"source_name": source, "sha256": checksum, "file_name": path.name, "file_size": path.stat().st_size, "identity": f"{source}:{checksum}", "path": str(target)}
    if target.exists():
        if sha256_file(target) != checksum:
            raise SourceError(f"{target} holds other content")
        return manifest | {"status": "ALREADY_STAGED"}
    target.parent.mkdir(parents=True, exist_ok=True)
    aside = target.with_name(f".{target.name}.{os.getpid()}")
    shutil.copyfile(path, aside)
    os.replace(aside, target)
    side = target.with_name(f"{target.name}.manifest.json")
    side.write_text(json.dumps(manifest, sort_keys=True))
    return manifest | {"status": "STAGED"}


def load_config(path: str | Path) -> dict:
    """A JSON or (where PyYAML is installed) YAML file with a top-level mapping."""
    text = Path(path).read_text()
    if Path(path).suffix.lower() == ".json":
        value = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as error:
            raise SourceError("YAML needs PyYAML") from error
        value = yaml.safe_load(text)
    if not isinstance(value, dict):
        raise SourceError(f"{path} holds no mapping")
    return value


def write_rows(rows: Iterable[dict], path: str | Path) -> Path:
    """Writes CSV or JSON lines, the same bytes for the same rows: two-digit money, ISO times, sorted JSON keys."""

    def plain(v: object) -> object:
        return f"{v:.2f}" if isinstance(v, Decimal) else v.isoformat(sep=" ") if isinstance(v, datetime) else v.isoformat() if isinstance(v, date) else v

    path, rows = Path(path), [{k: plain(v) for k, v in r.items()} for r in rows]
    with open(path, "w", newline="") as f:
        if path.suffix.lower() == ".csv":
            out = csv.DictWriter(f, list(rows[0]) if rows else [], lineterminator="\n")
            out.writeheader()
            out.writerows(rows)
        else:
            f.writelines(json.dumps(r, sort_keys=True) + "\n" for r in rows)
    return path


def emit_microbatches(rows: Iterable[dict | str], folder: str | Path, size: int = 100) -> list[Path]:
    """Writes JSON lines as microbatch-NNNNN.json, each whole or not at all; same content again is fine."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    lines = []
    for row in rows:
        value = json.loads(row) if isinstance(row, str) else row
        if not isinstance(value, dict):
            raise SourceError("a message must be a JSON object")
        lines.append(json.dumps(value, sort_keys=True, default=str))
    out = []
    for n, start in enumerate(range(0, len(lines), size)):
        target, text = folder / f"microbatch-{n:05d}.json", "\n".join(lines[start : start + size]) + "\n"
        if target.exists():
            if target.read_text() != text:
                raise SourceError(f"{target} holds other content")
        else:
            aside = folder / f".{target.name}.tmp"
            aside.write_text(text)
            os.replace(aside, target)
        out.append(target)
    return out
