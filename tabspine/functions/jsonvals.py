"""JSON expressions: score payloads of many shapes, key/value payloads, metric values.

Payload text stays a column, and every branch is a built-in expression, so a payload table is parsed where its
partitions lie. The longer expressions are SQL text over column names; each parse is meant to be a column of its own, so
that it happens once per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OBJECTS = "array<map<string,variant>>"


def json_value(col: Column) -> Column:
    """JSON text of one value: arrays, maps and structs as such, a scalar as a bare value, null as ``null``."""
    wrapped = F.to_json(F.struct(col.alias("v")), {"ignoreNullFields": "false"})
    return F.when(col.isNull(), "null").otherwise(F.regexp_extract(wrapped, r'(?s)^\{"v":(.*)\}$', 1))


def _is(value: str, kind: str) -> str:
    return f"startswith(schema_of_variant({value}), '{kind}')"


def _number(value: str) -> str:
    """Double of a scalar variant: numbers, booleans as 1/0, numeric text; null for anything else."""
    return f"try_variant_get({value}, '$', 'double')"


def _scalar_or_pair(value: str) -> str:
    """A number, or of an array its second member, or the only one; null if that one cannot be read."""
    member = {path: f"try_variant_get({value}, '{path}', 'double')" for path in ("$", "$[1]", "$[0]")}
    size = f"size(try_variant_get({value}, '$', 'array<variant>'))"
    return (
        f"CASE WHEN NOT {_is(value, 'ARRAY')} THEN {member['$']} WHEN {size} > 1 THEN {member['$[1]']} "
        f"WHEN {size} = 1 THEN {member['$[0]']} END"
    )


def payload_body(payload: str, names: str) -> Column:
    """What a parsed payload predicts: the payload, or the value under ``predictions``, else ``prediction``."""
    return F.expr(f"""
        CASE WHEN NOT {_is(payload, 'OBJECT')} THEN {payload}
             WHEN array_contains({names}, 'predictions') THEN try_variant_get({payload}, '$.predictions', 'variant')
             ELSE try_variant_get({payload}, '$.prediction', 'variant') END""")


def body_items(body: str) -> Column:
    """Members of a payload body, each with its kind and its ``score`` and ``prediction`` fields; a scalar is one member."""
    return F.expr(f"""
        transform(
          CASE WHEN {_is(body, 'ARRAY')} THEN try_variant_get({body}, '$', 'array<variant>')
               WHEN NOT {_is(body, 'OBJECT')} THEN array({body}) END,
          m -> named_struct('is_object', {_is('m', 'OBJECT')}, 'value', m,
                            'score', try_variant_get(m, '$.score', 'variant'),
                            'prediction', try_variant_get(m, '$.prediction', 'variant')))""")


def ordered_objects(items: str, text: str) -> Column:
    """Objects of a payload list with their fields in the order of the text, which variants do not keep.

    Parsed only where some member is an object with neither ``score`` nor ``prediction``.
    """
    return F.expr(f"""
        CASE WHEN exists({items}, m -> m.is_object AND m.score IS NULL AND m.prediction IS NULL) THEN coalesce(
          from_json({text}, 'predictions {_OBJECTS}').predictions,
          from_json({text}, 'prediction {_OBJECTS}').prediction,
          from_json({text}, '{_OBJECTS}')) END""")


def item_scores(items: str, ordered: str) -> Column:
    """Scores of payload members as ``array<double>``, null for a member that cannot be read.

    A pair gives its second member. An object gives ``score``, else ``prediction``, else its first number, in the order of the
    text as far as ``ordered`` has it.
    """
    fields = f"coalesce(get({ordered}, i), try_variant_get(m.value, '$', 'map<string,variant>'))"
    numeric = "schema_of_variant(v) RLIKE '^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)'"
    first_number = f"get(filter(map_values({fields}), v -> {numeric}), 0)"
    return F.expr(f"""
        transform({items}, (m, i) ->
          CASE WHEN NOT m.is_object THEN {_scalar_or_pair('m.value')}
               WHEN m.score IS NOT NULL THEN {_number('m.score')}
               WHEN m.prediction IS NOT NULL THEN {_scalar_or_pair('m.prediction')}
               ELSE {_number(first_number)} END)""")


def if_complete(values: str) -> Column:
    """The array if it has no null member, else null."""
    return F.expr(f"CASE WHEN NOT exists({values}, v -> v IS NULL) THEN {values} END")


def _pair_entries(text: str) -> str:
    """Entries of key/value JSON, an object or a list of ``{key or name, value or val}``; never null.

    A list with other members than objects does not parse as maps; then its members are parsed one by one.
    """
    return f"""
        coalesce(CASE substring(ltrim({text}), 1, 1)
          WHEN '{{' THEN transform(map_entries(from_json({text}, 'map<string,string>')),
                                  e -> named_struct('key', e.key, 'value', coalesce(e.value, 'None')))
          WHEN '[' THEN filter(
            transform(coalesce(from_json({text}, 'array<map<string,string>>'),
                               transform(from_json({text}, 'array<string>'), t -> from_json(t, 'map<string,string>'))),
                      m -> named_struct('key', CASE WHEN coalesce(m['key'], '') <> '' THEN m['key'] ELSE m['name'] END,
                                        'value', CASE WHEN map_contains_key(m, 'value') THEN m['value'] ELSE m['val'] END)),
            e -> e.key IS NOT NULL AND e.value IS NOT NULL)
        END, from_json('[]', 'array<struct<key:string,value:string>>'))"""


def pair_map(*texts: str) -> Column:
    """One ``map<string,string>`` out of several key/value JSON text columns; of repeated keys the last one stays."""
    entries = ", ".join(_pair_entries(t) for t in texts)
    return F.expr(f"""
        aggregate(concat({entries}), from_json('{{}}', 'map<string,string>'),
                  (pairs, e) -> map_concat(map_filter(pairs, (k, v) -> k <> e.key), map(e.key, e.value)))""")
