"""Text out of raw HTML pages; every operator reads the whole page."""

from __future__ import annotations

import html.entities
import json
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions.casts import as_column, named

# The pieces of a page, in the order of trial; possessive, so that no page makes a pattern go back or recurse.
# An attribute's value may hold `>` in quotes; a quote that never closes ends with the tag.
_ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+))?+"""
_ATTRIBUTES = rf"(?:[\s/]++|{_ATTRIBUTE})*+"
_COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\z))|<[!?][^>]*+(?:>|\z)|</(?![a-z])[^>]*+(?:>|\z)"
_RAW = rf"<(script|style)(?=[\s/>]){_ATTRIBUTES}>.*?(?:</\1(?=[\s/>])[^>]*+>|\z)"
_TAG = rf"</?[a-z][^\s/>]*+{_ATTRIBUTES}>"
_UNFINISHED = r"</?[a-z][^>]*+\z"
_PIECE = rf"(?is){_COMMENT}|{_RAW}|{_TAG}|{_UNFINISHED}|[^<]++|<"

#: Fixed values of HTML: tags without content; tags whose start ends an open one of their own kind (a heading any
#: heading), and the tags which that does not reach through.
_VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_NOT_NESTED = ("a", "button", "dd", "dt", "li", "option", "p", "td", "th", "tr", *_HEADINGS)
_CONTAINERS = ("article", "aside", "body", "div", "dl", "main", "nav", "ol", "section", "select", "table", "ul")

#: Buckets of the table of named references, found by the names' CRC-32.
_BUCKETS = 1024


def _entity_table() -> Column:
    """All named references in buckets of two or three."""
    buckets: list[dict[str, str]] = [{} for _ in range(_BUCKETS)]
    for name, text in html.entities.html5.items():
        buckets[zlib.crc32(f"&{name}".encode()) % _BUCKETS]["&" + name] = text
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,string>>")


def _old_names() -> str:
    """The names that count without a semicolon, longest first, as alternatives."""
    return "|".join(sorted((k for k in html.entities.html5 if not k.endswith(";")), key=lambda k: (-len(k), k)))


def _windows_characters() -> str:
    """What the numbers 128 to 159 mean: the characters of Windows-1252 where it has one."""
    known = {str(n): bytes([n]).decode("cp1252", "ignore") for n in range(128, 160)}
    return json.dumps({n: c or chr(int(n)) for n, c in known.items()})


def decode_entities(text: Column) -> Column:
    """Named and numeric character references -> characters as HTML defines them; unknown ones stay as written.

    Old names count without a semicolon too, numbers may have leading zeros or no
    semicolon, and a number that is no character gives the replacement character.
    """
    table = _entity_table()
    windows = F.from_json(F.lit(_windows_characters()), "map<string,string>")

    def character(code: Column) -> Column:
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        own = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        old = F.when(code.between(128, 159), F.element_at(windows, code.cast("string")))
        return F.coalesce(old, own, F.lit("\ufffd"))

    def number(digits: Column, base: int) -> Column:
        """The value, or -1 for more digits than a character's number has."""
        return F.when(F.length(digits) > 7, F.lit(-1)).otherwise(F.conv(digits, base, 10).cast("bigint"))

    def known(name: Column) -> Column:
        return F.element_at(F.get(table, (F.crc32(name.cast("binary")) % _BUCKETS).cast("int")), name)

    def piece(p: Column) -> Column:
        hexadecimal = F.regexp_extract(p, "^&#[xX]0*([0-9A-Fa-f]+);?$", 1)
        decimal = F.regexp_extract(p, "^&#0*([0-9]+);?$", 1)
        old = F.regexp_extract(p, f"^&({_old_names()})", 0)
        return F.coalesce(
            F.when(~p.startswith("&"), p),
            F.when(hexadecimal != "", character(number(hexadecimal, 16))),
            F.when(decimal != "", character(number(decimal, 10))),
            known(p),
            F.when(old != "", F.concat(known(old), F.substr(p, F.length(old) + 1))),
            p,
        )

    pieces = F.regexp_extract_all(text, F.lit(r"(&(?:#[xX][0-9A-Fa-f]+|#[0-9]+|[0-9A-Za-z]+);?|[^&]+|&)"), F.lit(1))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, piece), "")).otherwise(text)


def _literal(value: str) -> str:
    """The characters of value as a pattern."""
    return r"\Q" + value.replace(r"\E", r"\E\\E\Q") + r"\E"


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _let(value: Column, body) -> Column:
    """body(value), with value computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _one_of(name: Column, names: tuple[str, ...]) -> Column:
    return name.isin(*names)


def _step(tag: str):
    """One tag of a page: the elements still open, innermost last, and the places of the finished ones called tag."""

    def cut(state: Column, event: Column, n: Column, opened: Column) -> Column:
        """Without the n innermost, which end here, and with those that start here."""
        stack = state["stack"]
        ended = F.filter(F.slice(stack, F.size(stack) - n + 1, n), lambda s: s["name"] == F.lit(tag))
        places = F.transform(ended, lambda s: F.struct(s["at"].alias("from"), event["at"].alias("to")))
        kept = F.slice(stack, F.lit(1), F.size(stack) - n)
        return F.struct(F.concat(kept, opened).alias("stack"), F.when(F.size(places) > 0, F.concat(state["found"], places)).otherwise(state["found"]).alias("found"))

    def step(state: Column, event: Column) -> Column:
        name = event["name"]
        one = F.array(F.struct(name.alias("name"), event["at"].alias("at")))
        none = F.slice(one, 1, 0)

        def place(wanted) -> Column:
            """How many elements up to the innermost wanted one; 0 without one."""
            return F.array_position(F.transform(F.reverse(state["stack"]), wanted), True).cast("int")

        same = lambda s: (s["name"] == name) | (_one_of(s["name"], _HEADINGS) & _one_of(name, _HEADINGS))
        walled = _let(place(same), lambda n: _let(place(lambda s: _one_of(s["name"], _CONTAINERS)), lambda w: F.when((w > 0) & (w < n), 0).otherwise(n)))
        starts = F.when(_one_of(name, _NOT_NESTED), walled).otherwise(F.lit(0))
        ends = _let(place(same), lambda n: F.when(n > 0, cut(state, event, n, none)).otherwise(state))
        return F.when(event["opens"], _let(starts, lambda n: cut(state, event, n, one))).otherwise(ends)

    return step


def extract_headings(pages: DataFrame, tag: str = "h3", html: str = "html") -> DataFrame:
    """Add `headings`, the non-blank texts of a tag's elements in page order, and `n_headings`.

    The page is cut into comments, scripts and styles, tags and texts, and its tags are folded over the elements
    that are open.  An element ends at its end tag; without one, at the end tag of an element around it, at the
    start of one that may not lie inside (a paragraph in a paragraph, a heading in a heading) or at the page's end.
    End tags of nothing open, comments, scripts, styles and an unfinished last tag count as nothing; `<x/>` is
    empty; `<` before anything else is text.  References are resolved in each piece of text by itself.
    """
    tag = tag.lower()
    pieces = F.regexp_extract_all(named(html), F.lit(_PIECE), F.lit(0))
    event = F.transform(
        F.col("__pieces"),
        lambda p, i: F.struct(
            i.alias("at"), F.lower(F.regexp_extract(p, r"(?i)^</?([a-z][^\s/>]*)", 1)).alias("name"), (~p.startswith("</")).alias("opens"), p.alias("p")
        ),
    )
    empty = r"(?s)^<[^\s/>]*/>$|^<.*[\s\"']/>$"
    skipped = lambda e: (e["name"] == "") | _one_of(e["name"], (*_VOID, "script", "style")) | (e["opens"] & e["p"].rlike(empty))
    tags = F.transform(F.filter(event, lambda e: ~skipped(e)), lambda e: F.struct(e["at"], e["name"], e["opens"]))
    nothing = F.from_json(F.lit('{"stack":[],"found":[]}'), "struct<stack:array<struct<name:string,at:int>>,found:array<struct<from:int,to:int>>>")
    open_ones = lambda s: F.filter(s["stack"], lambda e: e["name"] == F.lit(tag))
    rest = lambda s: F.transform(open_ones(s), lambda e: F.struct(e["at"].alias("from"), F.size("__pieces").alias("to")))
    places = F.aggregate("__tags", nothing, _step(tag), lambda s: F.array_sort(F.concat(s["found"], rest(s))))
    # a piece of text is what starts with no `<`, or is one
    shown = lambda p: (p == "<") | ~p.startswith("<")
    inside = lambda e: F.filter(F.slice(F.col("__pieces"), e["from"] + 2, e["to"] - e["from"] - 1), shown)
    texts = F.transform("__places", lambda e: _trimmed(F.array_join(F.transform(inside(e), decode_entities), "")))
    found = pages.withColumn("__pieces", pieces).withColumn("__tags", tags).withColumn("__places", places)
    found = found.withColumn("headings", F.filter(texts, lambda t: t != "")).drop("__pieces", "__tags", "__places")
    return found.withColumn("n_headings", F.size("headings"))


def has_marker(
    pages: DataFrame, tag: str = "script", attribute: str = "id", value: str = labels.PAYLOAD_SCRIPT_ID, html: str = "html"
) -> DataFrame:
    """Add `has_marker`: the page holds a start tag whose attribute is that value or begins with it as a word.

    Comments, scripts, other attributes' values and all but the first of repeated attributes do not count.
    """
    tag, attribute, value = map(_literal, (tag, attribute, value))
    others = rf"(?:[\s/]++|(?!{attribute}[\s/>=]){_ATTRIBUTE})*+"
    pattern = rf"""(?is)^<{tag}(?=[\s/]){others}{attribute}\s*+=\s*+(?:"\s*{value}[\s"]|'\s*{value}[\s']|{value}[\s>])"""
    pieces = F.regexp_extract_all(named(html), F.lit(_PIECE), F.lit(0))
    return pages.withColumn("has_marker", F.exists(pieces, lambda p: p.rlike(pattern)))


def payload_values(pages: DataFrame, key: str = "title", sample: int = 3, html: str = "html") -> DataFrame:
    """Add all `"key": "value"` values in page order, their number, and the first few distinct ones."""
    values = F.regexp_extract_all(named(html), F.lit(rf'"{_literal(key)}"\s*:\s*"([^"]+)"'), F.lit(1))
    found = pages.withColumn("payload", values)
    return found.withColumns(
        {
            "n_payload": F.size("payload"),
            "payload_sample": F.slice(F.array_distinct("payload"), 1, sample),
        }
    )


def count_phrases(
    pages: DataFrame, patterns=tuple(labels.COUNT_PATTERNS), text="html", keep=("page_id",)
) -> DataFrame:
    """Rows (keep..., pattern, pos, value): every first-group match of each pattern, ignoring case."""
    found = F.array(
        *[
            F.struct(
                F.lit(p).alias("pattern"),
                F.regexp_extract_all(as_column(text), F.lit("(?iu)" + p), F.lit(1)).alias("hits"),
            )
            for p in patterns
        ]
    )
    return (
        pages.select(*[named(c) for c in keep], F.explode(found).alias("p"))
        .select(*[named(c) for c in keep], "p.pattern", F.posexplode("p.hits").alias("pos", "value"))
    )
