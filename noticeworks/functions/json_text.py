"""Reading raw JSON text columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, StringType, StructField, StructType

#: Fields of the parsers' own in a parsed value and around it.
END, CORRUPT = "_end", "_corrupt_record"


def parse(text: Column, schema: DataType) -> Column:
    """Typed value of a JSON text; malformed text gives NULL (count it with ``malformed``)."""
    return F.from_json(text, schema)


def strict(text: Column) -> Column:
    """The one JSON value of a text as a variant; NULL if the text is no JSON or goes on behind the value.

    A parser stops behind the first value, so the text is put in a list before a word drawn for this query: only a
    text that is one value leaves the word in second place. The list is made once and handed on.
    """
    end = uuid.uuid4().hex
    both = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{end}"]')))
    whole = F.filter(F.array(both), lambda x: F.try_variant_get(x, "$[1]", "string") == end)
    return F.try_variant_get(F.get(whole, 0), "$[0]", "variant")


def parse_whole(text: Column, schema: StructType | ArrayType) -> Column:
    """One parse with its audit: ``value``, ``whole`` (the text is one JSON value of this kind, or null) and ``lost``
    (a value inside does not have its type, and is NULL).

    The text is the first entry of a list whose second entry carries a word drawn for this query in a field of its own;
    a text that is malformed, goes on behind its value or closes the list itself does not leave it there, nor can it open
    another list, whose name is drawn as well.
    """
    end, around = uuid.uuid4().hex, f"list-{uuid.uuid4().hex}"
    fields = (schema.elementType if isinstance(schema, ArrayType) else schema).fields
    marked = StructType([*fields, StructField(END, StringType(), True)])
    kind = ArrayType(marked) if isinstance(schema, ArrayType) else marked
    second = f'{{"{END}":"{end}"}}'
    second = f"[{second}]" if isinstance(schema, ArrayType) else second
    outer = StructType([StructField(around, ArrayType(kind), True), StructField(CORRUPT, StringType(), True)])
    listed = F.concat(F.lit(f'{{"{around}":['), text, F.lit(f",{second}]}}"))
    parsed = F.from_json(listed, outer, {"columnNameOfCorruptRecord": CORRUPT})

    def audited(x: Column) -> Column:
        first, last = F.get(x[around], 0), F.get(x[around], 1)
        if isinstance(schema, ArrayType):
            first, mark = F.transform(first, lambda item: item.dropFields(END)), F.get(last, 0)[END]
        else:
            first, mark = first.dropFields(END), last[END]
        whole = F.coalesce(mark == end, F.lit(False))
        return F.struct(
            first.alias("value"),
            whole.alias("whole"),
            (whole & x[CORRUPT].isNotNull()).alias("lost"),
        )

    return F.get(F.transform(F.array(parsed), audited), 0)


def parse_audited(text: Column, schema: StructType | ArrayType) -> Column:
    """``value`` as ``parse`` reads it, and ``malformed``: the text is not one whole JSON value of this kind.

    Whole texts are parsed once; only what is not whole is parsed again, for the value before its end.
    """

    def read(x: Column) -> Column:
        value = F.when(x["whole"], x["value"]).otherwise(parse(text, schema))
        return F.struct(value.alias("value"), (text.isNotNull() & ~x["whole"]).alias("malformed"))

    return F.get(F.transform(F.array(parse_whole(text, schema)), read), 0)


def malformed(text: Column) -> Column:
    """True for text that is present and not one JSON value."""
    return text.isNotNull() & strict(text).isNull()


def field(text: Column, key: str) -> Column:
    """Value of a top-level key as text; NULL if the key is missing or null."""
    return F.get_json_object(text, f"$.{key}")


def field_or_default(text: Column, key: str, default: str) -> Column:
    """Like ``field``, with a default only where the key is absent.

    An explicit JSON null stays NULL, so this is not ``coalesce``.
    """
    present = F.coalesce(F.array_contains(F.json_object_keys(text), key), F.lit(False))
    return F.when(present, field(text, key)).otherwise(F.lit(default))


def flags(text: Column, keys: list[str]) -> Column:
    """Struct of boolean keys, parsed in one pass; a missing key is NULL."""
    return parse(text, StructType([StructField(key, BooleanType(), True) for key in keys]))


def any_true(*flags_: Column) -> Column:
    """Disjunction that reads NULL as false."""
    result = F.lit(False)
    for flag in flags_:
        result = result | F.coalesce(flag, F.lit(False))
    return result


def to_text(value: Column) -> Column:
    """JSON text of a struct, array or map, null fields included."""
    return F.to_json(value, {"ignoreNullFields": "false"})
