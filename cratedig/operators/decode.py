"""Lines to documents, with what can't be read set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, LongType, StringType, StructField, StructType, VariantType, _parse_datatype_string

from cratedig.functions.text import line_trim, text
from cratedig.schemas import DOCUMENTS, REQUIRED

_CORRUPT = "_corrupt_record"


class MalformedDocuments(ValueError):
    pass


def clean_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with their ``line`` trimmed, without blank ones."""
    return lines.withColumn("line", line_trim(F.col("line"))).where("line <> ''")


def _loose(schema: DataType) -> DataType:
    """``schema`` with every leaf as a variant, which keeps the type that stands in the text."""
    if isinstance(schema, StructType):
        return StructType([StructField(f.name, _loose(f.dataType)) for f in schema.fields])
    if isinstance(schema, ArrayType):
        return ArrayType(_loose(schema.elementType))
    return VariantType()


#: What a variant says its type is, by the type of the field; null may stand anywhere.
_KINDS = {StringType: ["STRING", "VOID"], LongType: ["BIGINT", "VOID"], BooleanType: ["BOOLEAN", "VOID"]}


def _mistyped(x: Column, schema: DataType) -> Column:
    """Whether a value under ``x`` has another type than ``schema`` says; null as far as values are absent."""
    if isinstance(schema, StructType):
        out: Column = F.lit(False)
        for f in schema.fields:
            out = out | F.coalesce(_mistyped(x.getField(f.name), f.dataType), F.lit(False))
        return out
    if isinstance(schema, ArrayType):
        return F.exists(x, lambda e: F.coalesce(_mistyped(e, schema.elementType), F.lit(False)))
    return ~F.schema_of_variant(x).isin(_KINDS[type(schema)])


def parse(lines: DataFrame, entity: str, strict_types: bool = False) -> DataFrame:
    """``lines`` with the document ``doc`` and ``problem``: null, ``malformed`` or ``missing <field>``.

    ``strict_types`` adds the problems ``trailing``, of text behind the document,
    and ``type``, of a number, boolean or string where the field has another
    type. Without it such a value is read as the field's type, and text behind
    the document is dropped. Unknown fields may hold anything.
    """
    schema = f"{DOCUMENTS[entity]}, {_CORRUPT} string"
    out = lines.withColumn("doc", F.from_json("line", schema, {"columnNameOfCorruptRecord": _CORRUPT}))
    missing: Column = F.lit(None).cast("string")
    for field in reversed(REQUIRED[entity]):
        missing = F.when(text(F.col(f"doc.`{field}`")) == "", f"missing {field}").otherwise(missing)
    bad = F.col("doc").isNull() | F.col(f"doc.{_CORRUPT}").isNotNull()
    if not strict_types:
        return out.withColumn("problem", F.when(bad, "malformed").otherwise(missing))
    kinds = _parse_datatype_string(DOCUMENTS[entity])
    # a parser stops behind the first value, so the line is put where nothing may follow: text that closes an
    # array doesn't close an object, and what a comma brings is a second element
    listed = F.from_json(F.concat(F.lit("["), "line", F.lit("]")), ArrayType(_loose(kinds)))
    field = F.from_json(F.concat(F.lit('{"x":'), "line", F.lit("}")), "x variant").getField("x")
    alone = F.coalesce(F.size(listed) == 1, F.lit(False)) & field.isNotNull()
    wrong = F.coalesce(_mistyped(F.get(listed, F.lit(0)), kinds), F.lit(False))
    return out.withColumn("problem", F.when(bad, "malformed").when(~alone, "trailing").when(wrong, "type").otherwise(missing))


def split(parsed: DataFrame, entity: str, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(documents, quarantine) of parsed lines; strict: raises if anything is set aside."""
    bad = parsed.where("problem is not null").drop("doc")
    if strict and (first := bad.select("problem", "line").first()):
        raise MalformedDocuments(f"{entity}: {first['problem']}: {first['line'][:200]}")
    return parsed.where("problem is null").drop("line", "problem"), bad


def decode(lines: DataFrame, entity: str, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """``split`` of the clean lines of one entity."""
    return split(parse(clean_lines(lines), entity), entity, strict)
