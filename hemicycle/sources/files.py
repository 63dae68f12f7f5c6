"""Sources: JSON dimensions, landed pages, and documents in files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = "_id string, name string, shortname string, color string, parties array<string>"
_TEXT = {"text/plain": "txt", "application/pdf": "pdf", "application/msword": "doc", "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx", "application/vnd.openxmlformats-officedocument.presentationml.presentation": "pptx"}


def groups(spark: SparkSession, path: str) -> DataFrame:
    """Parliamentary groups from a JSON array."""
    rows = spark.read.option("multiLine", True).schema(GROUP).json(path)
    return rows.withColumnRenamed("_id", "id")


def period(rows: DataFrame, legislature: int) -> DataFrame:
    """The first period of a legislature, or an empty one."""
    found = rows.filter(F.col("id") == legislature).limit(1).agg(F.first("periodoLegislativo").alias("period"))
    return found.select(F.coalesce("period", F.lit("")).alias("period"))


def api_pages(spark: SparkSession, total: int, size: int = 20) -> DataFrame:
    """(page, offset) of a paged source; pages 1 to total // size + 1."""
    return spark.range(1, total // size + 2).select(F.col("id").alias("page"), ((F.col("id") - 1) * size).alias("offset"))


def clean_lines(text: str) -> list[str]:
    """Stripped text; form feeds become spaces, tabs vanish, a line each."""
    return text.strip().replace("\f", " ").replace("\t", "").split("\n")


def pdf_text(content: bytes) -> list[str]:
    try:
        from io import BytesIO

        from pypdf import PdfReader
    except ImportError:
        return []
    try:
        return clean_lines("\f".join(p.extract_text() or "" for p in PdfReader(BytesIO(content)).pages))
    except Exception:
        return []


READERS: dict[str, Callable[[bytes], list[str]]] = {"txt": lambda b: clean_lines(b.decode("utf-8", "replace")), "pdf": pdf_text}


def attachments(files: DataFrame, readers: dict[str, Callable[[bytes], list[str]]] | None = None) -> DataFrame:
    """Files (path, mime, content) to (path, lines, ignored). Formats without a reader are ignored, with one empty line."""
    known = {**READERS, **(readers or {})}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, mime, content in zip(batch["path"], batch["mime"], batch["content"], strict=True):
                read = known.get(_TEXT.get(mime, ""))
                lines = read(bytes(content)) if read and content is not None else []
                out.append((path, lines or [""], not lines))
            yield pd.DataFrame(out, columns=["path", "lines", "ignored"])

    return files.select("path", "mime", "content").mapInPandas(run, "path string, lines array<string>, ignored boolean")


def landed(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Binary files under a folder (path, content), for ``attachments``."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "content")
