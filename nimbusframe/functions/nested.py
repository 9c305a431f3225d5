"""Nested data: lateral unnest (J5), array/map helpers (F15-F20), tags.

All of these are per-row transformations (``Generate`` or higher-order
functions); none groups or shuffles, so they scale with the input and keep
data where it already is.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbusframe.functions.scalars import _col


def unnest(df: DataFrame, array_col: str | Column, alias: str, outer: bool = False) -> DataFrame:
    """One lateral unnest level: one output row per array element.

    Inner by default - a parent with an empty or NULL array disappears, which
    is what ``FROM t, UNNEST(x)`` does. ``outer=True`` keeps it with a NULL
    element."""
    gen = F.explode_outer if outer else F.explode
    return df.select("*", gen(_col(array_col)).alias(alias))


def unnest_path(
    df: DataFrame,
    path: str,
    aliases: Sequence[str] | None = None,
    outer: bool = False,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Unnest a dotted path of arrays, e.g. ``SecurityGroups.IpPermissions.IpRanges``.

    Level ``i`` explodes field ``parts[i]`` of the element produced by level
    ``i-1``. The element of every level is kept as a struct column named by
    ``aliases`` (default: the path part), so a projection can pick fields from
    any level. ``keep`` limits the parent columns carried along (column
    pruning then reaches the scan)."""
    parts = path.split(".")
    aliases = list(aliases or parts)
    if len(aliases) != len(parts):
        raise ValueError("one alias per path level")
    cur = df.select(*(keep or df.columns))
    prev = None
    for part, alias in zip(parts, aliases):
        src = F.col(part) if prev is None else F.col(prev).getField(part)
        cur = unnest(cur, src, alias, outer=outer)
        prev = alias
    return cur


def has_tags(col: Column | str) -> Column:
    """True when an array/map of tags is non-empty (NULL counts as empty)."""
    c = _col(col)
    return F.coalesce(F.size(c), F.lit(-1)) > 0


def filter_project(arr: Column | str, predicate, field: str | None = None) -> Column:
    """F16: ``[x.field for x in arr if predicate(x)]`` as one higher-order expression."""
    kept = F.filter(_col(arr), predicate)
    if field is None:
        return kept
    return F.transform(kept, lambda x: x.getField(field))


def any_element(arr: Column | str, predicate) -> Column:
    """F16: ``exists`` - true when some element satisfies the predicate."""
    return F.exists(_col(arr), predicate)


def reshape(arr: Column | str, fields: Mapping[str, str]) -> Column:
    """map every element to a struct of chosen (possibly nested) fields:
    ``{"Id": "InstanceId", "State": "State.Name"}``."""

    def pick(x: Column) -> Column:
        cols = []
        for new, path in fields.items():
            v = x
            for p in path.split("."):
                v = v.getField(p)
            cols.append(v.alias(new))
        return F.struct(*cols)

    return F.transform(_col(arr), pick)


def array_length(arr: Column | str) -> Column:
    """number of elements; NULL array -> 0 (the CLI's ``length`` of an absent list)."""
    return F.coalesce(F.size(_col(arr)), F.lit(0))


# --- typed attributes (key-value item wire form) ----------------------------

# The attribute type tags of the key-value wire format are
# S, N, BOOL, NULL, SS, NS, B, BS, M and L.
#
# A typed item is rewritten as text, from its innermost values outwards, so that
# it may nest to any depth and numbers keep every digit. JSON text has no raw
# control characters, so these stand for characters that must not be taken for
# structure (inside strings) or that are finished (around converted values).
_IN_STRINGS = ("{}[]:,", "\x12\x13\x14\x15\x16\x17")
_BACKSLASH, _QUOTE = "\x10", "\x11"
_DONE, _MAP, _LIST = "\x01", ("\x03", "\x04"), ("\x05", "\x06")

_NUMBER = r"(-?(?:0|[1-9]\d*))(?:(\.\d*?[1-9])0*|\.0+)?([eE][+-]?\d+)?"
_SCALARS = [
    # the elements of sets become typed values of their own
    *[(r'(?:(\{"' + many + r'":\[)|\G(?!\A)(,))("[^"]*")', r'$1$2{"' + one + '":$3}') for many, one in (("NS", "N"), ("SS", "S"), ("BS", "B"))],
    (r'\{"N":"' + _NUMBER + r'"\}', _DONE + "$1$2$3"),  # no zeros at the end of a fraction
    (r'\{"[SNB]":("[^"]*")\}', _DONE + "$1"),
    (r'\{"BOOL":"?(true|false)"?\}', _DONE + "$1"),
    (r'\{"NULL":"?(?:true|false)"?\}', _DONE + "null"),
]
_GROUPS = [
    (r'\{"M":\{([^{}\[\]]*)\}\}', _MAP[0] + "$1" + _MAP[1]),
    (r'\{"(?:L|SS|NS|BS)":\[([^{}\[\]]*)\]\}', _LIST[0] + "$1" + _LIST[1]),
]
_GROUP_TAG = r'\{"(?:M|L|SS|NS|BS)":'
# A value that no rule has converted: after a name, or in a list.
_UNTYPED = '[:,\x05][^\x01\x03\x05"\x06]|:"|[,\x05]"[^"]*"(?!:)'


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _replaced(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    for pattern, by in rules:
        text = F.regexp_replace(text, pattern, by)
    return text


def _plain_text(typed: Column) -> Column:
    """Plain JSON of the compact JSON text of a typed item, NULL if it is none."""
    bare = F.replace(F.replace(typed, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    # every second part between quotes is the inside of a string
    shielded = F.array_join(
        F.transform(F.split(bare, '"', -1), lambda x, i: F.when(i % 2 == 1, F.translate(x, *_IN_STRINGS)).otherwise(x)), '"'
    )
    scalars = _replaced(shielded, _SCALARS)

    def groups(text: Column) -> Column:
        levels = F.array_repeat(F.lit(0), F.size(F.split(text, _GROUP_TAG, -1)) - 1)  # at least as many as there are
        return F.aggregate(levels, text, lambda acc, _: F.when(acc.rlike(_GROUP_TAG), _replaced(acc, _GROUPS)).otherwise(acc))

    def finished(text: Column) -> Column:
        whole = text.rlike(r"\A\{[^{}\[\]]*\}\z") & ~text.rlike(_UNTYPED)
        back = F.translate(text, "".join([_IN_STRINGS[1], *_MAP, *_LIST, _DONE]), _IN_STRINGS[0] + "{}[]")
        return F.when(whole, F.replace(F.replace(back, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\")))

    return _let(_let(scalars, groups), finished)


def _parsed(col: Column) -> Column:
    return F.try_parse_json(col)


def parsed_item(col: Column | str) -> Column:
    """A typed item as a variant, for :func:`scalar_attribute`; NULL if it is no JSON."""
    return _parsed(_col(col))


def plain_json(col: Column | str) -> Column:
    """typed-attribute JSON text -> plain JSON text with the values' own
    types: numbers, booleans, null, nested maps and lists; sets are arrays,
    binary values their base64 text.

    Values may nest to any depth. Numbers keep their text (38 digits, exponents,
    ``-0``), but for zeros at the end of a fraction; a number that JSON cannot
    write is a string. NULL, invalid text and items with an untyped value give
    NULL."""
    return _plain_text(F.to_json(_parsed(_col(col))))


def unmarshal(col: Column | str, is_json: bool = True) -> Column:
    """typed-attribute JSON text (``{"Grade": {"N": "85"}}``) or a parsed
    map of typed values -> ``map<string,string>`` of plain values.

    ``S`` and ``N`` keep their text (numbers stay exact text; cast per column
    with :func:`attribute`), ``BOOL`` becomes ``'true'``/``'false'``, ``NULL``
    becomes SQL NULL, binary values their base64 text; sets, maps and lists of
    any depth become JSON text as :func:`plain_json` writes it. ``is_json=False``
    takes an already parsed ``map<string, struct<...>>`` column of scalars and
    sets."""
    c = _col(col)
    if is_json:
        get = lambda v, tag, kind="string": F.try_variant_get(v, f"$.{tag}", kind)

        def group(v: Column) -> Column:
            text = _plain_text(F.concat(F.lit('{"v":'), F.to_json(v), F.lit("}")))
            return F.substring(text, F.lit(6), F.length(text) - 6)

        return F.transform_values(
            F.try_variant_get(_parsed(c), "$", "map<string,variant>"),
            lambda _k, v: F.coalesce(
                get(v, "S"), get(v, "N"), get(v, "B"), get(v, "BOOL", "boolean").cast("string"),
                F.when(get(v, "NULL", "boolean").isNull(), group(v)),
            ),
        )
    return F.transform_values(
        c,
        lambda _k, v: F.coalesce(
            v.getField("S"),
            v.getField("N"),
            v.getField("BOOL").cast("string"),
            F.when(F.size(v.getField("SS")) >= 0, F.to_json(v.getField("SS"))),
            F.when(F.size(v.getField("NS")) >= 0, F.to_json(v.getField("NS"))),
        ),
    )


def typed_attribute(col: Column | str, name: str) -> Column:
    """The text of one scalar attribute of a typed item, without converting the rest."""
    return scalar_attribute(_parsed(_col(col)), name)


def scalar_attribute(item: Column, name: str) -> Column:
    """The same of an item that is parsed (a variant)."""
    item, path = _attribute_at(item, name)
    kinds = (("S", "string"), ("N", "string"), ("B", "string"), ("BOOL", "boolean"))
    return F.coalesce(*[F.try_variant_get(item, f"{path}.{t}", k).cast("string") for t, k in kinds])


def has_attribute(item: Column, name: str) -> Column:
    """Whether a parsed item has an attribute of that name."""
    return F.try_variant_get(*_attribute_at(item, name), "variant").isNotNull()


def _attribute_at(item: Column, name: str) -> tuple[Column, str]:
    quote = next((q for q in "'\"" if q not in name), None)
    if quote:
        return item, f"$[{quote}{name}{quote}]"
    return F.try_variant_get(item, "$", "map<string,variant>").getItem(name), "$"  # a path cannot hold both quotes


def attribute(plain_map: Column | str, name: str, dtype: str = "string") -> Column:
    """One plain attribute out of an unmarshalled map, cast safely."""
    v = _col(plain_map).getItem(name)
    return v if dtype == "string" else v.try_cast(dtype)


def marshal(df: DataFrame, cols: Sequence[str]) -> Column:
    """F19 reverse: chosen columns -> typed-attribute JSON text.

    Numeric columns become ``{"N": text}``, booleans ``{"BOOL": b}``, all other
    types ``{"S": text}``; NULL columns are left out (absent attribute)."""
    from pyspark.sql.types import BooleanType, NumericType

    kinds = {f.name: f.dataType for f in df.schema.fields}
    pieces = []
    for c in cols:
        v = df["`" + c.replace("`", "``") + "`"]
        if isinstance(kinds[c], BooleanType):
            val = F.struct(v.alias("BOOL"))
        elif isinstance(kinds[c], NumericType):
            val = F.struct(v.cast("string").alias("N"))
        else:
            val = F.struct(v.cast("string").alias("S"))
        pieces.append(F.when(v.isNotNull(), F.concat(F.lit(json.dumps(c, ensure_ascii=False) + ":"), F.to_json(val))))
    return F.concat(F.lit("{"), F.concat_ws(",", *pieces), F.lit("}"))


def split_overflow(
    fields: Column | str, known: Sequence[str]
) -> tuple[dict[str, Column], Column]:
    """split a request map into its known columns and the JSON text of
    the rest (the overflow ``data`` column). Returns ({name: col}, overflow)."""
    m = _col(fields)
    known_arr = F.array(*[F.lit(k) for k in known])
    cols = {k: m.getItem(k) for k in known}
    rest = F.map_filter(m, lambda k, _v: ~F.array_contains(known_arr, k))
    overflow = F.when(F.size(rest) > 0, F.to_json(rest))
    return cols, overflow
