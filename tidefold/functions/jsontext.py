r"""JSON text as columns: canonical form, object entries, value kinds.

Canonical text is compact, has sorted keys and raw UTF-8. Spark's variant gives all of that
but prints the number `1.0` as `1`, and the difference decides whether a column becomes
BIGINT or DOUBLE. So before parsing, every such number is wrapped into a marked string, and
unwrapped again in the output.

The quick wrapping looks only at the characters around a number. Should it hit text inside a
string, the quote it adds ends that string in front of the mark, which no JSON allows there:
parsing fails and the careful wrapping takes over. That one walks the text token by token
(`\G`, possessive quantifiers only), so strings are skipped whole, nothing backtracks or
recurses, and documents of any length pass.

A mark that a document already holds, as a character or as a JSON escape, is first followed by
a second one that no wrapped number has there, and that is taken out again at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK, FOREIGN = "\ue000", "\ue001"
_FOREIGN_MARK = MARK + FOREIGN
# The escape \ue000 behind an even number of backslashes.
_ESCAPED_MARK = r"(?<!\\)((?:\\\\)*)\\u[eE]000"
_INTEGRAL_DECIMAL = r"-?[0-9]++\.0++(?![0-9eE])"
_QUICK = r"([:\[,]\s*+)(-?[0-9]++\.0++)(?=\s*+[,}\]])"
_TOKENS_BEFORE = (
    r'[^"0-9-]++'
    r'|"(?:[^"\\]++|\\.)*+"'
    rf"|(?!{_INTEGRAL_DECIMAL})-?+[0-9]++(?:\.[0-9]++)?+(?:[eE][+-]?+[0-9]++)?+"
)
_CAREFUL = rf"(?s)\G((?:{_TOKENS_BEFORE})*+)({_INTEGRAL_DECIMAL})"
_MARKED = rf'"{MARK}(-?[0-9]+\.0)0*"'


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def parse_marked(text: Column | str) -> Column:
    """JSON object or array as a variant in which numbers like `1.0` are marked strings; NULL if it is not JSON."""
    text = _col(text)
    told_apart = F.regexp_replace(
        F.replace(text, F.lit(MARK), F.lit(_FOREIGN_MARK)), F.lit(_ESCAPED_MARK), F.lit(f"$1{_FOREIGN_MARK}")
    )
    text = F.when(text.contains(MARK) | F.lower(text).contains("\\ue000"), told_apart).otherwise(text)
    wrapped = F.lit(f'$1"{MARK}$2"')
    marked = [F.try_parse_json(F.regexp_replace(text, F.lit(pattern), wrapped)) for pattern in (_QUICK, _CAREFUL)]
    return F.when(text.contains(".0"), F.coalesce(*marked)).otherwise(F.try_parse_json(text))


def unmark_decimals(text: Column | str) -> Column:
    """JSON text with wrapped numbers as numbers, and foreign marks as they were."""
    text = _col(text)
    plain = unmark_text(F.regexp_replace(text, F.lit(_MARKED), F.lit("$1")))
    return F.when(text.contains(MARK), plain).otherwise(text)


def unmark_text(text: Column) -> Column:
    """A plain string value with foreign marks as they were."""
    return F.replace(text, F.lit(_FOREIGN_MARK), F.lit(MARK))


def is_wrapped(text: Column) -> Column:
    """Whether a string value stands for a number."""
    return text.startswith(MARK) & ~text.startswith(_FOREIGN_MARK)


def canonical_json(text: Column | str) -> Column:
    """Compact, key-sorted JSON text; NULL for text that is not JSON."""
    return unmark_decimals(F.to_json(parse_marked(text)))


def object_entries(variant: Column | str) -> Column:
    """Top-level members of a JSON object as map<string,variant>; NULL for anything else."""
    return _col(variant).try_cast("map<string,variant>")


def member(variant: Column | str, name: str) -> Column:
    """One top-level member as a variant, whatever characters its name has."""
    if "'" not in name and "\\" not in name:
        return F.try_variant_get(_col(variant), f"$['{name}']", "variant")
    return F.try_element_at(object_entries(variant), F.lit(name))


def member_as(variant: Column | str, name: str, type_name: str) -> Column:
    """The same as a value of a type; NULL where it is none."""
    if "'" not in name and "\\" not in name:
        return F.try_variant_get(_col(variant), f"$['{name}']", type_name)
    return F.try_variant_get(member(variant, name), "$", type_name)


def shape(variant: Column | str) -> Column:
    """Type of a value as text: BOOLEAN, BIGINT, DECIMAL(p,s), DOUBLE, STRING, ARRAY<…>, OBJECT<…> or VOID.

    NULL when the value is absent.
    """
    return F.schema_of_variant(_col(variant))


def is_nested(variant: Column | str) -> Column:
    return shape(variant).startswith("OBJECT") | shape(variant).startswith("ARRAY")


def flat_fields(document: Column | str) -> Column:
    """A JSON object as a variant whose nested members are their JSON text; anything else as it is.

    Members are scalars then, which is what Spark shreds into columns of their own.
    """
    document = _col(document)
    parsed = F.try_parse_json(document)
    entries = object_entries(parsed)

    def flat(texts: Column) -> Column:
        members = F.transform_values(
            entries, lambda name, value: F.when(is_nested(value), F.element_at(texts, name).cast("variant")).otherwise(value)
        )
        return F.to_variant_object(members)

    # A lambda variable holds the texts, so the document is read once and not for each member.
    flattened = F.element_at(F.transform(F.array(F.from_json(document, "map<string,string>")), flat), 1)
    return F.when(F.exists(F.map_values(entries), is_nested), flattened).otherwise(parsed)
