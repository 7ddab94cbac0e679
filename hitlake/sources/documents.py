"""Documents of no fixed schema: lines parsed once to VARIANT, stored as such, asked by path.

A VARIANT keeps values, not their spelling: ``1.0`` is ``1``. Where the spelling counts ask the raw
lines (:func:`hitlake.functions.get_paths`).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.paths import CORRUPT, split_path
from .lines import read_lines

DOCUMENT = "document"


def read_documents(spark: SparkSession, *paths: str) -> DataFrame:
    """``document`` (VARIANT) of each non-blank line, and ``_corrupt_record``: the text of lines that are no JSON object.

    A line is parsed once, as the first of two items of an array, so that text behind it does not
    go unseen. An object with a repeated key is none.
    """
    value = F.col("value")
    both = F.try_parse_json(F.concat(F.lit("["), value, F.lit(",0]")))
    parsed = read_lines(spark, *paths).where(F.trim(value) != "").select("value", F.explode(F.array(both)).alias("items"))
    one = F.try_variant_get("items", "$[0]", "variant")
    whole = F.try_variant_get("items", "$[1]", "int").isNotNull() & F.try_variant_get("items", "$[2]", "variant").isNull()
    good = F.coalesce(whole & F.schema_of_variant(one).startswith("OBJECT"), F.lit(False))
    return parsed.select(F.when(good, one).alias(DOCUMENT), F.when(~good, value).alias(CORRUPT))


def store_documents(documents: DataFrame, path: str) -> DataFrame:
    """Write documents as Parquet, so that they are parsed once."""
    documents.write.parquet(path)
    return documents.sparkSession.read.parquet(path)


def variant_path(path: str) -> str:
    """A dotted path (see :func:`hitlake.functions.split_path`) in VARIANT's own spelling."""
    steps = split_path(path)
    if any('"' in step or "]" in step for step in steps):
        raise ValueError(f"a path into a VARIANT can't hold quotes or brackets: {path!r}")
    return "$" + "".join(f'["{step}"]' for step in steps)


def variant_text(document: Column, path: str) -> Column:
    """Text at a path, as :func:`hitlake.functions.get_path` gives it but for numbers' spelling.

    Descends objects only: a missing step, a step into something else, and JSON null give NULL;
    text is itself, other values are JSON.
    """
    found = F.try_variant_get(document, variant_path(path), "variant")
    kind = F.schema_of_variant(found)
    return F.when(kind == "STRING", F.try_variant_get(found, "$", "string")).when(kind != "VOID", F.to_json(found))


def variant_fields(document: Column, paths: Sequence[str]) -> list[Column]:
    """:func:`variant_text` for several paths."""
    return [variant_text(document, path) for path in paths]


def variant_schema(documents: DataFrame, document: str = DOCUMENT) -> T.StructType:
    """The schema that all documents share, in one pass: fields of any of them, with the type that holds all values.

    Fields whose values have no common type are VARIANT; those that are only ever null are VOID.
    """
    merged = documents.agg(F.schema_of_variant_agg(document)).first()[0]
    if not merged.startswith("OBJECT"):
        return T.StructType([])
    return T._parse_datatype_string(re.sub(r"\bOBJECT<", "STRUCT<", merged))
