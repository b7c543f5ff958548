"""Elements of a page, and the text of their paragraphs.

The rules are those of a lenient reader: names are case-blind, an element or comment that is
never closed runs to the end, and tags inside comments, scripts and style sheets do not count.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from html.entities import name2codepoint
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from litscreen.functions import let

# Loops are possessive: linear time and no deep recursion on long pages.
_ATTRIBUTES = r"""(?:[^<>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+"""
_HIDDEN = (
    r"<(?:!--.*?(?:-->|\z)|(?i:script)(?=[\s/>]).*?(?:</(?i:script)\s*>|\z)"
    r"|(?i:style)(?=[\s/>]).*?(?:</(?i:style)\s*>|\z))"
)
_TAG = rf"<(?:/?[a-zA-Z]{_ATTRIBUTES}>|[!?][^<>]*+>)"
_REFERENCE = r"\A&(?:#[xX]0*([0-9a-fA-F]{1,6})|#0*([0-9]{1,7})|([a-zA-Z][-.a-zA-Z0-9]*));?"
_OTHER_REFERENCE = r"&(?!(?:amp|lt|gt|quot|apos);)[#a-zA-Z]"

# A character that is reserved for internal use and stands for no text.
_MARK = "\ufdd0"
_OPENS, _CLOSES = _MARK + "(", _MARK + ")"


def _open_tag(name: str) -> str:
    return rf"<(?i:{name})(?=[\s/>]){_ATTRIBUTES}>"


def first_element(page: Column, name: str) -> Column:
    """The first element of that name with its markup; NULL if there is none.

    Elements of the same name inside it belong to it.
    """
    before = rf"(?:[^<]++|{_HIDDEN}|(?!<(?i:{name})[\s/>])<)*+"
    inside = rf"(?:[^<]++|{_HIDDEN}|(?!</(?i:{name})\s*>)<)*+(?:</(?i:{name})\s*>|\z)"
    pattern = rf"(?s)\A{before}({_open_tag(name)}(?:(?<=/>)|{inside}))"
    whole_tag = rf"(?i:<{name})(?=[\s/>])"

    def checked(found: Column) -> Column:
        # The pattern ends at the first closing tag, which is right unless another one opens before it.
        return F.when(F.regexp_count(found, F.lit(whole_tag)) > 1, _by_depth(page, name)).otherwise(F.nullif(found, F.lit("")))

    return let(F.regexp_extract(page, pattern, 1), checked)


def _by_depth(page: Column, name: str) -> Column:
    """The same, by counting tags of that name that open and close. Linear in the page."""
    opens, closes = _open_tag(name), rf"</(?i:{name})\s*>"
    pieces = F.regexp_extract_all(page, F.lit(rf"(?s){_HIDDEN}|{opens}|{closes}|(?:[^<]++|(?!{_HIDDEN}|{opens}|{closes})<)++"), F.lit(0))

    def step(state: Column, piece: Column) -> Column:
        opening = piece.rlike(rf"(?s)\A{opens}\z")
        empty = F.endswith(piece, F.lit("/>"))
        change = F.when(opening & ~empty, 1).when((state.first > 0) & piece.rlike(rf"(?s)\A{closes}\z"), -1).otherwise(0)
        first = F.when((state.first == 0) & opening, state.at).otherwise(state.first)
        depth = state.depth + change
        ended = (state.last == 0) & (first > 0) & (depth == 0)
        return F.struct(
            (state.at + 1).alias("at"), depth.alias("depth"), first.alias("first"),
            F.when(ended, state.at).otherwise(state.last).alias("last"),
        )

    start = F.struct(F.lit(1).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("first"), F.lit(0).alias("last"))

    def cut(all_pieces: Column) -> Column:
        def between(state: Column) -> Column:
            last = F.when(state.last > 0, state.last).otherwise(F.size(all_pieces))
            return F.when(state.first > 0, F.array_join(F.slice(all_pieces, state.first, last - state.first + 1), ""))

        return let(F.aggregate(all_pieces, start, step), between)

    return let(pieces, cut)


_BLOCK = 512  # pieces of text that are gathered at once


def decode_characters(text: Column) -> Column:
    """Replace character references, named or numbered, each of them once."""
    return let(text, _decode)


def _decode(text: Column) -> Column:
    few = text
    for name, character in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        few = F.replace(few, F.lit(f"&{name};"), F.lit(character))
    return (
        F.when(~F.contains(text, F.lit("&")), text)
        .when(text.rlike(_OTHER_REFERENCE), _decode_any(text))
        .otherwise(few)
    )


def _decode_any(text: Column) -> Column:
    names = F.from_json(F.lit(json.dumps(_named_characters())), "map<string,string>")

    def take_apart(part: Column) -> Column:
        def group(i: int) -> Column:
            return F.nullif(F.regexp_extract(part, _REFERENCE, i), F.lit(""))

        return F.struct(
            part.alias("part"),
            F.conv(F.coalesce(group(1), F.conv(group(2), 10, 16)), 16, 10).cast("int").alias("code"),
            group(3).alias("name"),
        )

    def decoded(found: Column) -> Column:
        # Only what is a character; other numbers and names stay as they are written.
        legal = found.code.between(1, 0xD7FF) | found.code.between(0xE000, 0x10FFFF)
        character = F.when(
            found.code.isNotNull(),
            F.when(legal, F.decode(F.unhex(F.lpad(F.hex(found.code), 8, "0")), "UTF-32")),
        ).when(found["name"].isNotNull(), F.try_element_at(names, found["name"]))
        rest = F.regexp_replace(found.part, _REFERENCE, "")
        return F.coalesce(F.concat(character, rest), found.part)

    parts = F.transform(F.split(text, "(?=&)"), take_apart)
    return F.array_join(F.transform(parts, decoded), "")


def _named_characters() -> dict[str, str]:
    return {"apos": "'"} | {name: chr(code) for name, code in name2codepoint.items()}


def paragraph_text(element: Column, decode: bool = True) -> Column:
    """The text of all ``p`` at any depth, joined by one space.

    A new piece begins at each ``p`` tag, opening or closing. A piece counts if it lies
    inside any ``p``, and counts once. Tags inside are removed, text outside is dropped, the
    text of CDATA sections is kept.
    An element without any ``p`` gives an empty text.
    """
    def only_if(text: Column, found: list[str], change: Callable[[Column], Column]) -> Column:
        # A search for bytes is much cheaper than a pattern that finds nothing.
        def changed(x: Column) -> Column:
            return F.when(reduce(or_, [F.contains(x, F.lit(f)) for f in found]), change(x)).otherwise(x)

        return let(text, changed)

    literal = r"(?s)<!\[CDATA\[(.*?)(?:\]\]>|\z)"
    empty = rf"<(?i:p)(?=[\s/>]){_ATTRIBUTES}(?<=/)>"
    text = only_if(element, [_MARK], lambda x: F.replace(x, F.lit(_MARK), F.lit("")))
    text = only_if(text, ["<!--", "<s", "<S"], lambda x: F.regexp_replace(x, rf"(?s){_HIDDEN}", ""))
    text = only_if(text, ["<![CDATA["], lambda x: F.regexp_replace(x, literal, "$1"))
    text = only_if(text, ["/>"], lambda x: F.regexp_replace(x, empty, _OPENS + _CLOSES))
    text = F.regexp_replace(text, _open_tag("p"), _OPENS)
    text = F.regexp_replace(text, r"</(?i:p)\s*>", _CLOSES)
    pieces = F.split(F.regexp_replace(text, _TAG, ""), _MARK)

    def step(state: Column, piece: Column) -> Column:
        opens = F.startswith(piece, F.lit("("))
        depth = F.when(opens, state.depth + 1).otherwise(F.greatest(state.depth - 1, F.lit(0)))
        # The text after an opening tag always counts, even if empty; the text after a
        # closing tag only where an outer ``p`` is still open and there is any.
        kept = opens | ((state.depth > 1) & (F.length(piece) > 1))
        return F.struct(
            depth.alias("depth"),
            F.when(kept, F.array_append(state.texts, F.substring(piece, 2, 2**31 - 1)))
            .otherwise(state.texts).alias("texts"),
        )

    def texts(depth: Column) -> Column:
        return F.struct(depth.alias("depth"), F.array().cast("array<string>").alias("texts"))

    # A growing array is copied at each step. Pieces are gathered by blocks, so that no copied
    # array is longer than a block or the number of blocks.
    def of_block(state: Column, block: Column) -> Column:
        def joined(found: Column) -> Column:
            return F.struct(
                found.depth.alias("depth"),
                F.when(F.size(found.texts) > 0, F.array_append(state.texts, F.array_join(found.texts, " ")))
                .otherwise(state.texts).alias("texts"),
            )

        return let(F.aggregate(block, texts(state.depth), step), joined)

    def blocks(p: Column) -> Column:
        begins = F.sequence(F.lit(2), F.size(p), F.lit(_BLOCK))
        return F.when(F.size(p) > 1, F.transform(begins, lambda b: F.slice(p, b, F.lit(_BLOCK)))).when(
            p.isNotNull(), F.array().cast("array<array<string>>"))

    plain = F.aggregate(let(pieces, blocks), texts(F.lit(0)), of_block, lambda state: F.array_join(state.texts, " "))
    return decode_characters(plain) if decode else plain
