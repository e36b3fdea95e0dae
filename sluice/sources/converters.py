"""Value converters besides JSON. Avro and Protobuf decoding are separate
Spark packages; these adapters use them when present and say so otherwise."""
from __future__ import annotations

from pyspark.sql import Column


def from_avro(value: Column, json_schema: str) -> Column:
    try:
        from pyspark.sql.avro.functions import from_avro as _fa
    except ImportError as e:  # pragma: no cover
        raise RuntimeError("Avro decoding needs pyspark.sql.avro and the spark-avro package") from e
    return _fa(value, json_schema)


def from_protobuf(value: Column, message: str, desc_file: str) -> Column:
    try:
        from pyspark.sql.protobuf.functions import from_protobuf as _fp
    except ImportError as e:  # pragma: no cover
        raise RuntimeError("Protobuf decoding needs the spark-protobuf package") from e
    return _fp(value, message, desc_file)
