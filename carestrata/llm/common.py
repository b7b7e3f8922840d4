"""Helpers the corpus operators share: tables, word splitting, files in the shared folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from carestrata.sources.storage import scratch_path, stage

__all__ = ["ASCII_SPACE", "claim_folder", "open_store", "stage", "table", "words_of", "write_file"]

#: what separates words everywhere in this subpackage, as a Java and Python character class body
ASCII_SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8 (``bytes.split`` cuts at exactly that white space)."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def claim_folder(spark: SparkSession, label: str) -> str:
    """URI of a folder below the shared one that no other run uses."""
    path = scratch_path(spark, label)
    return path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}"


def open_store(uri: str):
    """The file system and path of a URI, for tasks."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_file(folder: str, name: str, chunks) -> str:
    """Write a file whole or not at all: each attempt has its own name until it is complete, so a retried task is harmless."""
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    attempt = f"{path}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(attempt) as out:
        for chunk in chunks:
            out.write(chunk)
    store.move(attempt, f"{path}/{name}")
    return f"{folder}/{name}"
