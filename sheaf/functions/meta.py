"""Chunk metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: the filing fields copied into every chunk's metadata, in order
FILING_FIELDS = ("ticker", "company_name", "form", "filing_date", "accession_number", "local_path", "document_url")

METADATA_SCHEMA = ("struct<section:string,ticker:string,company_name:string,form:string,filing_date:string,"
                   "accession_number:string,local_path:string,document_url:string>")


def metadata_struct(section: Column | str = "section") -> Column:
    """Chunk fields first, then the filing's; the filing date as ISO text.

    Expects the filing columns by their names in scope.
    """
    sec = F.col(section) if isinstance(section, str) else section
    fields = [sec.alias("section")]
    for name in FILING_FIELDS:
        col = F.col(name)
        if name == "filing_date":
            col = F.date_format(col, "yyyy-MM-dd")
        fields.append(col.alias(name))
    return F.struct(*fields)


def metadata_json(section: Column | str = "section") -> Column:
    """JSON text of ``metadata_struct``; ``to_json`` leaves out null fields, so a
    chunk without a section has no ``section`` key."""
    return F.to_json(metadata_struct(section))


def parse_metadata(col: Column | str) -> Column:
    """JSON text back to the struct; anything that is not an object gives an
    all-null struct (the original falls back to ``{}``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.from_json(c, METADATA_SCHEMA), F.from_json(F.lit("{}"), METADATA_SCHEMA))


def meta_field(col: Column | str, key: str, default: str = "?") -> Column:
    """A metadata value by key with a fallback."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.get_json_object(c, f"$.{key}"), F.lit(default))
