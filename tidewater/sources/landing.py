"""Immutable landing of source files on any Hadoop file system, with a registry of what has been delivered."""

from __future__ import annotations

import posixpath

from pyspark.sql import SparkSession

from .files import SUFFIXES, SourceError
from .fs import Files


class Landing:
    """Files below ``root``/source/name, each beside its manifest; entries of the registry are files of their own.

    An entry is named by source and content, so any number of files can be staged without rewriting
    a common list, and looking one up reads one small file.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.files, self.root = Files(spark), root.rstrip("/")

    def _entry(self, source: str, checksum: str) -> str:
        return f"{self.root}/_registry/{source}-{checksum}.json"

    def get(self, source: str, checksum: str) -> dict | None:
        """The manifest under which this content was delivered, if it was."""
        at = self._entry(source, checksum)
        return self.files.read_json(at) if self.files.exists(at) else None

    def count(self) -> int:
        return sum(n.endswith(".json") for n in self.files.names(f"{self.root}/_registry"))

    def register(self, manifest: dict) -> None:
        """Adds a manifest; the same one again changes nothing, another one of the same identity raises."""
        known = self.get(manifest["source_name"], manifest["sha256"])
        if known is not None and known != manifest:
            raise SourceError(f"another file was delivered as {manifest['identity']}: {known['path']}")
        if known is None:
            self.files.write_json(self._entry(manifest["source_name"], manifest["sha256"]), manifest)

    def stage(self, path: str, source: str) -> dict:
        """Copies a file to its immutable place and registers it; the same content again is ALREADY_STAGED.

        A file that is missing or empty, an unknown suffix, and other content under a taken name raise.
        """
        size, name = self.files.size(path), posixpath.basename(path)
        if not size or not name.lower().endswith(SUFFIXES):
            raise SourceError(f"cannot stage {path}")
        checksum, target = self.files.sha256(path), f"{self.root}/{source}/{name}"
        known = self.get(source, checksum)
        if known is not None:
            return known | {"status": "ALREADY_STAGED"}
        manifest = {"source_name": source, "sha256": checksum, "file_name": name, "file_size": size, "identity": f"{source}:{checksum}", "path": target}
        if self.files.exists(target):
            if self.files.sha256(target) != checksum:
                raise SourceError(f"{target} holds other content")
        else:
            self.files.copy(path, target)
        self.files.write_json(f"{target}.manifest.json", manifest)
        self.register(manifest)
        return manifest | {"status": "STAGED"}
