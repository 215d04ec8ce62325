"""Extraction of title, date and content from a news page, with regular expressions only.

There is no document tree. The limits that follow from that:

* markup in comments, scripts and style sheets is removed first, so it cannot be mistaken for page structure;
* a paragraph ends at the next tag of a paragraph, opening or closing, and at no other tag;
* the attributes looked for must be quoted; a tag with a quote that is never closed is text;
* a ``<`` that no letter, ``/``, ``!`` or ``?`` follows is text;
* numeric references and those in ``REFERENCES`` are decoded if they end with a semicolon, others stay as written.
"""

from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodmart import fixed_values as V
from moodmart.functions.text import once

# The named references of HTML 4, from Python's own table, and the one that XML adds
REFERENCES = {f"&{name};": chr(code) for name, code in name2codepoint.items()} | {"&apos;": "'"}
_LONGEST_REFERENCE = max(len(reference) for reference in REFERENCES)
_LAST_CODE_POINT = 0x10FFFF

# The rest of a tag: quoted values are skipped, so that a > inside one does not end it
_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_ATTRIBUTE = r"""\s++[^\s=>"'/]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']++))?+"""
_TAG = rf"<[a-zA-Z/!?]{_REST}"


@dataclass(frozen=True)
class PageSelectors:
    """Which elements of a page hold what. Class names belong to one build of one site, hence parameters.

    ``headline_class`` is one class among those of the element, ``paragraph_class`` the whole class text; None accepts
    any. ``title_tag`` None takes the headline's own text as the title.
    """

    headline_tag: str = "span"
    headline_class: str | None = V.HEADLINE_CLASS
    title_tag: str | None = "span"
    article_tag: str = "article"
    paragraph_tag: str = "p"
    paragraph_class: str | None = V.PARAGRAPH_CLASS
    timestamp_tag: str = "span"
    timestamp_testid: str = V.TIMESTAMP_TESTID
    timestamp_text_testid: str = V.TIMESTAMP_TEXT_TESTID


def _quote(text: str) -> str:
    return rf"\Q{text}\E"


def _opening(tag: str, attribute: str | None = None, value: str | None = None, one_of: bool = False) -> str:
    """Pattern of an opening tag; ``one_of`` lets the attribute hold other blank-separated words around the value."""
    if value is None:
        return rf"<{tag}(?=[\s>/]){_REST}"
    before, after = (r"(?:[^\"'>]*\s)?", r"(?:\s[^\"'>]*)?") if one_of else ("", "")
    return rf"<{tag}(?=\s)(?:{_ATTRIBUTE})*?\s+{attribute}\s*=\s*[\"']{before}{_quote(value)}{after}[\"']{_REST}"


def drop_hidden_markup(html: Column) -> Column:
    return F.regexp_replace(html, r"(?s)<(?:!--.*?-->|(?i:(script|style)\b.*?</\1\s*>))", "")


def _strip_tags(markup: Column) -> Column:
    return F.regexp_replace(markup, _TAG, "")


def _numbered(digits: Column, base: int) -> Column:
    """The character of a numeric reference; what is no character reads U+FFFD."""
    code = F.conv(digits, base, 10).cast("decimal(20,0)")
    valid = (code > 0) & (code <= _LAST_CODE_POINT) & ~code.between(0xD800, 0xDFFF)
    encoded = F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0"))
    return F.when(valid, F.decode(encoded, "UTF-32")).otherwise("\ufffd")


def _decode(text: Column) -> Column:
    """One pass: the text is cut at every ampersand, and what follows says whether it starts a known reference."""
    characters = F.create_map(*[F.lit(part) for pair in REFERENCES.items() for part in pair])
    decimal, hexadecimal = r"^#([0-9]{1,10});", r"^#[xX]([0-9a-fA-F]{1,10});"

    def piece(part: Column, position: Column) -> Column:
        start = F.left(part, F.lit(max(_LONGEST_REFERENCE, 14)))
        reference = F.concat(F.lit("&"), F.substring_index(start, ";", 1), F.lit(";"))
        known = (
            F.when(~start.contains(";"), F.lit(None).cast("string"))
            .when(start.rlike(decimal), _numbered(F.regexp_extract(start, decimal, 1), 10))
            .when(start.rlike(hexadecimal), _numbered(F.regexp_extract(start, hexadecimal, 1), 16))
            .otherwise(F.try_element_at(characters, reference))
        )
        after = F.substring(part, F.locate(";", part) + 1, F.length(part))
        return F.when(position == 0, part).otherwise(
            F.coalesce(F.concat(known, after), F.concat(F.lit("&"), part))
        )

    return F.when(text.contains("&"), F.array_join(F.transform(F.split(text, "&"), piece), "")).otherwise(text)


def plain_texts(parts: Column) -> Column:
    """Text of each piece of markup in an array: tags removed, character references decoded.

    Two passes, so that the stripped text is a variable of the second one and is not computed again for each use.
    """
    return F.transform(F.transform(parts, _strip_tags), _decode)


def plain_text(markup: Column) -> Column:
    return once(_strip_tags(markup), _decode)


def _cut(markup: Column, tag: str) -> Column:
    """Markup cut before every opening and closing of ``tag``."""
    return F.split(markup, rf"(?i)(?=</?{tag}(?=[\s>/]))")


def _pieces_until_closed(pieces: Column, tag: str, backwards: bool = False) -> Column:
    """How many pieces lie inside an element of ``tag`` whose opening came just before the first piece.

    ``backwards`` takes the pieces from the last to the first, for an element still open after the last one: then the
    piece that its opening starts counts as well, and the result is null if there is no such element.
    """

    def change(piece: Column) -> Column:
        return (
            F.when(F.lower(F.left(piece, F.lit(len(tag) + 2))) == f"</{tag}", -1)
            .when(F.lower(F.left(piece, F.lit(len(tag) + 1))) == f"<{tag}", 1)
            .otherwise(0)
        )

    def count(state: Column, step: Column) -> Column:
        still_open = (state.open > 0) & (state.open + step > 0)
        return F.struct(
            F.when(still_open, state.open + step).otherwise(0).alias("open"),
            F.when(still_open, state.seen + 1).otherwise(state.seen).alias("seen"),
        )

    def count_back(state: Column, step: Column) -> Column:
        return F.struct(
            F.when(state.open > 0, state.open - step).otherwise(0).alias("open"),
            F.when(state.open > 0, state.seen + 1).otherwise(state.seen).alias("seen"),
        )

    start = F.struct(F.lit(1).alias("open"), F.lit(0).alias("seen"))
    if backwards:
        return F.aggregate(
            F.transform(F.reverse(pieces), change), start, count_back, lambda state: F.when(state.open <= 0, state.seen)
        )
    return F.aggregate(F.transform(pieces, change), start, count, lambda state: state.seen)


def with_page_fields(pages: DataFrame, html: str = "html", selectors: PageSelectors = PageSelectors()) -> DataFrame:
    """Add ``publishedDate``, ``title`` and ``content``, all text, of the last headline on each page.

    Content is every paragraph of the article around that headline, also those above it. What is missing reads
    "No ... found"; a timestamp without its inner text counts as no date.

    The work is a chain of narrow projections. Each step's column is used by several later expressions, so Catalyst
    keeps the steps apart and every page is split only once per step. The fields leave through a generator of one row,
    because a filter on a column made by a generator stays above it. Pushed below, the filter would bring a copy of
    the whole extraction with it.
    """
    s = selectors
    kept = [F.col(name) for name in pages.columns]

    headline = rf"(?is){_opening(s.headline_tag, 'class', s.headline_class, one_of=True)}"

    # Markup before and after the last headline's opening tag
    step = pages.select(*kept, F.split(drop_hidden_markup(F.col(html)), headline).alias("_around"))
    above = F.array_join(F.slice("_around", F.lit(1), F.size("_around") - 1), "")
    step = step.select(
        *kept,
        F.coalesce(F.size("_around") > 1, F.lit(False)).alias("_found"),
        F.when(F.size("_around") > 1, _cut(above, s.article_tag)).alias("_above"),
        F.when(F.size("_around") > 1, F.element_at("_around", -1)).alias("_after"),
    )

    # The article that is open where the headline starts, if any, and the part of it above and below the headline
    step = step.select(
        *kept,
        "_found",
        "_above",
        _pieces_until_closed(F.col("_above"), s.article_tag, backwards=True).alias("_depth"),
        _cut(F.col("_after"), s.article_tag).alias("_below"),
    )
    opened = F.slice("_above", F.size("_above") - F.col("_depth") + 1, F.col("_depth"))
    inside = F.slice("_below", F.lit(1), _pieces_until_closed(F.col("_below"), s.article_tag))
    step = step.select(
        *kept,
        "_found",
        F.when(F.col("_depth").isNotNull(), F.array_join(opened, "")).alias("_lead"),
        F.array_join(inside, "").alias("_below"),
    )
    step = step.select(*kept, "_found", "_lead", "_below", _cut(F.col("_below"), s.headline_tag).alias("_pieces"))

    # The headline element itself: title and date are looked for nowhere else
    inside = F.slice("_pieces", F.lit(1), _pieces_until_closed(F.col("_pieces"), s.headline_tag))
    step = step.select(*kept, "_found", "_lead", "_below", F.array_join(inside, "").alias("_head"))

    title_opening = rf"(?is){_opening(s.title_tag)}" if s.title_tag else None
    title_pieces = (
        _cut(F.get(F.split("_head", title_opening, 2), F.lit(1)), s.title_tag) if s.title_tag else F.array("_head")
    )
    stamp = (
        rf"(?is){_opening(s.timestamp_tag, 'data-testid', s.timestamp_testid)}.*?"
        rf"{_opening(s.timestamp_tag, 'data-testid', s.timestamp_text_testid)}(.*?)</{s.timestamp_tag}\s*>"
    )
    # An open paragraph ends where the next one starts
    one_paragraph = (
        rf"(?is){_opening(s.paragraph_tag, 'class', s.paragraph_class)}(.*?)(?=</?{s.paragraph_tag}(?=[\s>/])|\z)"
    )
    step = step.select(
        *kept,
        "_found",
        title_pieces.alias("_title"),
        F.regexp_extract_all("_head", F.lit(stamp), 1).alias("_stamps"),
        F.regexp_extract_all(F.concat("_lead", "_below"), F.lit(one_paragraph), 1).alias("_paragraphs"),
    )

    title = F.col("_title")
    if s.title_tag:
        title = F.slice(title, F.lit(1), _pieces_until_closed(title, s.title_tag))
    title_text = plain_text(F.array_join(title, ""))
    fields = F.struct(
        F.when(F.size("_stamps") > 0, plain_text(F.get("_stamps", F.lit(0))))
        .otherwise(V.NO_DATE)
        .alias("publishedDate"),
        F.when(F.col("_found"), F.coalesce(title_text, F.lit(V.NO_TITLE))).otherwise(V.NO_TITLE).alias("title"),
        F.when(F.size("_paragraphs") > 0, F.array_join(plain_texts(F.col("_paragraphs")), " "))
        .otherwise(V.NO_CONTENT)
        .alias("content"),
    )
    return step.select(*kept, F.inline(F.array(fields)))
