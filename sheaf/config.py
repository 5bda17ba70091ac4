"""Defaults of the filing pipeline.

Fixed values that must equal the original system's for equal results are kept
together here, in plain text.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -----------------------------------------------------------
EVENT_TYPE = "filing.downloaded"
SCHEMA_VERSION = 1
DEFAULT_ALLOWED_FORMS = ("10-K", "10-Q", "10-K/A", "10-Q/A")
FORM_SELECTIONS = ("10-K", "10-Q", "8-K")
# spellings of forms without their dash, and with it
FORM_SPELLINGS = (("10K", "10-K"), ("10Q", "10-Q"), ("8K", "8-K"))
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 150
EMBED_BATCH_SIZE = 16
EMBED_MAX_SEQ_LENGTH = 512
VECTOR_DIM = 1024
SEARCH_TOP_K = 5          # library / command line default
API_TOP_K = 10            # mode-routed search default
MAX_TOP_K = 100
LOAD_REPORT_MAX_ERRORS = 20
MANIFEST_DOWNLOADED_AT = "2026-01-01T00:00:00Z"
MANIFEST_DOCUMENT_URL = ""
# model name -> vector length (catalog type wins when present)
MODEL_DIMENSIONS = (("bge-m3", 1024), ("bge-small", 384), ("bge-base", 768), ("bge-large", 1024))
# BM25 parameters (the keyword engine's usual defaults)
BM25_K1 = 1.2
BM25_B = 0.75
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    allowed_forms: tuple[str, ...] = DEFAULT_ALLOWED_FORMS
    chunk_size: int = CHUNK_SIZE
    chunk_overlap: int = CHUNK_OVERLAP
