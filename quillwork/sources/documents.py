"""Uploaded documents as binary files."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def is_pdf(name, content_type):
    """Accepted by its suffix or its content type; both are Columns."""
    return F.coalesce(F.lower(name).endswith(".pdf"), F.lit(False)) | F.coalesce(F.lower(content_type) == "application/pdf", F.lit(False))


def read_pdfs(spark: SparkSession, path: str) -> DataFrame:
    """path, raw_text, page_count, extraction_status of the PDF files under a path.

    Pages are stripped, blank ones dropped, the rest joined by blank lines. Reading needs the package pypdf; where it
    is missing, every file has the status unavailable.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(F.lower("path").endswith(".pdf"))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            from pypdf import PdfReader
        except ImportError:
            PdfReader = None
        for b in batches:
            out = []
            for name, content in zip(b["path"], b["content"]):
                if PdfReader is None:
                    out.append((name, None, 0, "unavailable"))
                    continue
                try:
                    pages = [(p.extract_text() or "").strip() for p in PdfReader(io.BytesIO(content)).pages]
                    kept = [p for p in pages if p]
                    out.append((name, "\n\n".join(kept), len(pages), "extracted" if kept else "empty"))
                except Exception:  # a damaged file is a status, not a failed job
                    out.append((name, None, 0, "failed"))
            yield pd.DataFrame(out, columns=["path", "raw_text", "page_count", "extraction_status"])

    return files.select("path", "content").mapInPandas(extract, "path string, raw_text string, page_count int, extraction_status string")
