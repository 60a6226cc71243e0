"""Explicit schemas of the tables the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()

PAIRS = _struct(
    sample_id=_S, row_idx=_L, source=_S, target=_S, source_lang=_S, target_lang=_S, domain=_S,
    metadata=T.MapType(_S, _S),
)
PROCESSED_PAIR = _struct(source=_S, target=_S, domain=_S, sample_id=_S)
CACHED_PAIR = _struct(
    source=_S, target=_S, source_lang=_S, target_lang=_S, domain=_S, sample_id=_S,
    metadata=T.MapType(_S, _S),
)
TSV_PAIR = _struct(source=_S, target=_S)
TRANSLATIONS = _struct(source=_S, reference=_S, hypothesis=_S)
MANIFEST = _struct(name=_S, path=_S, count=_L, content_hash=_S, stored_at=T.TimestampType())
TOKEN_MAP = T.ArrayType(_struct(token=_S, original=_S))
SHIFT_EDITS = _struct(edits=_L, shifts=_L, ref_len=_L)
