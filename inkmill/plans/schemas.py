"""Schemas of the tables that stages hand on."""

from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "bool": T.BooleanType()}


def _schema(**fields: str) -> T.StructType:
    """Nullable fields in the order given, each with its kind."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in fields.items()])


MANIFEST = _schema(
    manifest_pos="long", name="string", rel="string", ext="string", category="string", size="long", quality="string", unit="string",
    count="int", chars="int", raw="string", raw_sha256="string", source_sha256="string", note="string", error="string", duplicate_of="string",
    ocr="bool", converted="bool", garble_fixed="bool", original_deleted="bool",
)
#: Sources as they are found: one row per file.
LISTING = _schema(rel="string", size="long", source_sha256="string")
#: Texts by archive path.
ARCHIVE = _schema(raw="string", text="string")
#: What an extractor makes of a source.
EXTRACTED = _schema(rel="string", text="string", unit="string", count="int", chars="int", quality="string", error="string", source_sha256="string")
