"""XML text as nodes, so that elements are copied as they stand.

``children`` cuts the content of an element into its child elements: attributes, entities, CDATA,
comments and elements that no schema names stay in the text of their child. All of it is Spark
SQL and linear in the length of the text; the text must be well-formed. One pattern takes whole
children with up to ``_DEPTH`` elements inside one another; a text that goes deeper is cut into
single tags, and these are counted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_ATTRIBUTES = r"""[^<>"']*+(?:(?:"[^"]*+"|'[^']*+')[^<>"']*+)*+"""
_LEAF_ATTRIBUTES = r"""(?:\s++[^<>"'/]*+(?:(?:"[^"]*+"|'[^']*+')[^<>"'/]*+)*+)?+"""

# Comment, CDATA, processing instruction, element with nothing but text, tag, text.  A ``>`` may
# stand in an attribute.  Most elements hold only text; as one token each they need no depth.
_MISC = r"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>"
_TOKEN = (
    rf"(?s){_MISC}"
    rf"|<([^\s<>/!?]++){_LEAF_ATTRIBUTES}>[^<]*+</\1\s*+>"
    rf"|<{_ATTRIBUTES}>|[^<]++"
)
_DEPTH = 16


def _element_pattern(depth: int) -> str:
    """A whole element with at most ``depth`` levels of elements in it."""
    inside = rf"{_element_pattern(depth - 1)}|{_MISC}" if depth else _MISC
    content = rf"(?:[^<]++|{inside})*+"
    return rf"<(?![/!?]){_ATTRIBUTES}(?:(?<=/)>|(?<!/)>{content}</[^<>]*+>)"


# An outermost element as one piece, what stands between, and a bare ``<`` where neither fits.
_PIECE = rf"(?s){_element_pattern(_DEPTH)}|{_MISC}|[^<]++|<"
_TAG = rf"(?s)^<{_ATTRIBUTES}>"
_INNER = rf"{_TAG}(.*)</[^<]*+$"
_LEAF_TEXT = rf"(?s)^<{_ATTRIBUTES}>([^<]*+)</"
_NAME = r"^<([^\s/>]+)"
_BEFORE_TYPE = r"""(?s)^<[^\s/>]+(?:\s+[^\s=>]+\s*=\s*(?:"[^"]*"|'[^']*'))*?"""
_TYPE = _BEFORE_TYPE + r"""\s+type\s*=\s*(?:"([^"]*)"|'([^']*)')"""

_CHUNK = 32


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute a value once for an expression that needs it in several places."""
    return F.element_at(F.transform(F.array(value), use), 1)


_OTHER, _OPENING, _CLOSING, _WHOLE = range(4)


def _kind(token: Column) -> Column:
    """Opening tag, closing tag, whole element, or none of them."""
    whole = F.endswith(token, F.lit("/>")) | F.contains(token, F.lit("</"))
    return (
        F.when(~token.rlike("^<[^!?]"), _OTHER)
        .when(F.startswith(token, F.lit("</")), _CLOSING)
        .when(whole, _WHOLE)
        .otherwise(_OPENING)
    )


def _spans(kinds: Column) -> Column:
    """First and last place of each outermost element."""
    none = F.array().cast("array<struct<begin: int, end: int>>")
    last = F.greatest(F.ceil(F.size(kinds) / _CHUNK) - 1, F.lit(0)).cast("int")
    chunks = F.transform(
        F.sequence(F.lit(0), last), lambda k: F.slice(kinds, k * _CHUNK + 1, F.lit(_CHUNK))
    )

    def state(depth: Column, at: Column, begin: Column, spans: Column) -> Column:
        return F.struct(
            depth.alias("depth"), at.alias("at"), begin.alias("begin"), spans.alias("spans")
        )

    def token(before: Column, kind: Column) -> Column:
        depth, at = before["depth"], before["at"]
        begins = (depth == 0) & ((kind == _OPENING) | (kind == _WHOLE))
        begin = F.when(begins, at).otherwise(before["begin"])
        ends = ((depth == 0) & (kind == _WHOLE)) | ((depth == 1) & (kind == _CLOSING))
        span = F.struct(begin.alias("begin"), at.alias("end"))
        return state(
            F.when(kind == _OPENING, depth + 1)
            .when(kind == _CLOSING, depth - 1)
            .otherwise(depth),
            at + 1,
            begin,
            F.when(ends, F.concat(before["spans"], F.array(span))).otherwise(before["spans"]),
        )

    # Arrays grow within chunks only, so that long ones stay cheap.
    def chunk(before: Column, part: Column) -> Column:
        begin = state(before["depth"], before["at"], before["begin"], none)
        return bind(
            F.aggregate(part, begin, token),
            lambda after: state(
                after["depth"],
                after["at"],
                after["begin"],
                F.concat(before["spans"], F.array(after["spans"])),
            ),
        )

    nothing = F.array().cast("array<array<struct<begin: int, end: int>>>")
    start = state(F.lit(0), F.lit(0), F.lit(0), nothing)
    return F.flatten(F.aggregate(chunks, start, chunk, lambda after: after["spans"]))


def type_of(tag: Column) -> Column:
    """The ``type`` attribute of an opening tag; null without one."""
    both = F.concat(F.regexp_extract(tag, _TYPE, 1), F.regexp_extract(tag, _TYPE, 2))
    return F.when(F.contains(tag, F.lit("type")) & tag.rlike(_TYPE), both)


def _deep_children(content: Column) -> Column:
    """``children`` of any depth, by counting tags."""

    def node(tokens: Column, begin: Column, end: Column) -> Column:
        tag = F.get(tokens, begin)
        size = end - begin + 1
        inner = F.slice(tokens, begin + 2, F.greatest(size - 2, F.lit(0)))
        return F.struct(
            F.regexp_extract(tag, _NAME, 1).alias("name"),
            type_of(tag).alias("type"),
            F.array_join(F.slice(tokens, begin + 1, size), "").alias("outer"),
            F.when(size == 1, F.regexp_extract(tag, _LEAF_TEXT, 1))
            .otherwise(F.array_join(inner, ""))
            .alias("inner"),
        )

    def cut(tokens: Column) -> Column:
        spans = bind(F.transform(tokens, _kind), _spans)
        return F.transform(spans, lambda span: node(tokens, span["begin"], span["end"]))

    return bind(F.regexp_extract_all(content, F.lit(_TOKEN), F.lit(0)), cut)


def children(content: Column) -> Column:
    """The child elements, in order: ``name``, ``type``, ``outer`` text and ``inner`` text."""

    def is_element(piece: Column) -> Column:
        return F.startswith(piece, F.lit("<")) & ~F.substring(piece, 2, 1).isin("!", "?")

    def node(outer: Column) -> Column:
        return bind(
            F.regexp_extract(outer, _TAG, 0),
            lambda tag: F.struct(
                F.regexp_extract(tag, _NAME, 1).alias("name"),
                type_of(tag).alias("type"),
                outer.alias("outer"),
                F.regexp_extract(outer, _INNER, 1).alias("inner"),
            ),
        )

    def cut(pieces: Column) -> Column:
        whole = F.transform(F.filter(pieces, is_element), node)
        return F.when(F.array_contains(pieces, "<"), _deep_children(content)).otherwise(whole)

    return bind(F.regexp_extract_all(content, F.lit(_PIECE), F.lit(0)), cut)


def named(nodes: Column, name: str) -> Column:
    return F.filter(nodes, lambda node: node["name"] == name)


def first_named(nodes: Column, name: str) -> Column:
    """The first child of a name; null without one."""
    return F.get(nodes, (F.array_position(nodes["name"], name) - 1).cast("int"))
