"""Records out of landed HTML pages.

A page is one row and stays one row until its records are exploded, so
extraction is a map over the pages table. Patterns are lazy and free of nested
repetition: the regular expression engine does not recurse on long pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinolens.functions.arrays import normalise_genres, parse_rating, split_genres
from kinolens.functions.html import all_matches, first_match, html_to_text
from kinolens.functions.text import replace_newlines
from kinolens.labels import ADD_REVIEW_NOTICE, SPOILER_NOTICE, UNWANTED_GENRES, USEFUL_NOTICE

# Where the fields sit in listing, detail and review pages.
TITLE_CELL = r'(?s)<td[^>]*class="title"[^>]*>.*?</td>'
LINK_HREF = r'(?s)<a\b[^>]*href="([^"]*)"'
LINK_TEXT = r"(?s)<a\b[^>]*>(.*?)</a>"
YEAR_SPAN = r'(?s)<span[^>]*class="year_type"[^>]*>(.*?)</span>'
OUTLINE_SPAN = r'(?s)<span[^>]*class="outline"[^>]*>(.*?)</span>'
GENRE_SPAN = r'(?s)<span[^>]*class="genre"[^>]*>(.*?)</span>'
GENRE_BLOCK = r'(?s)<div[^>]*itemprop="genre"[^>]*>(.*?)</div>'
CONTENT_START = r'(?s)<div[^>]*id="tn15content"[^>]*>(.*)'
HEADLINE = r"(?s)<h2[^>]*>(.*?)</h2>"
ALT_TEXT = r'(?s)\balt="([^"]*)"'
PARAGRAPH = r"(?s)<p\b[^>]*>(.*?)</p>"
PAGE_TITLE = r"(?is)<title[^>]*>(.*?)</title>"
GENRE_PREFIX = 10


def extract_records(df: DataFrame, html: str, record: str, fields: dict, keep=()) -> DataFrame:
    """One row per match of ``record`` with one column per field.

    A field is a pattern whose first group is the value, or a function from the
    record's Column to a Column, for values that need more than a pattern.
    """
    blocks = df.select(*keep, F.posexplode(all_matches(html, record, 0)).alias("pos", "__block"))
    cols = [
        (spec(F.col("__block")) if callable(spec) else first_match("__block", spec)).alias(name)
        for name, spec in fields.items()
    ]
    return blocks.select(*keep, "pos", *cols)


def extract_titles(df: DataFrame, html: str = "html", keep=(), drop=UNWANTED_GENRES, only=None) -> DataFrame:
    """Films of listing pages: link, title, year, outline and genre text."""

    def genre(names: Column) -> Column:
        return normalise_genres(names, keep=only) if only is not None else normalise_genres(names, drop=drop)

    # Fields are cut out before they are read: reading names its input many times, and each would run the pattern again.
    cut = {"title_url": LINK_HREF, "title": LINK_TEXT, "year": YEAR_SPAN, "outline": OUTLINE_SPAN, "genre": GENRE_SPAN}
    return extract_records(df, html, TITLE_CELL, cut, keep).select(
        *keep,
        "pos",
        "title_url",
        html_to_text("title").alias("title"),
        F.substring(html_to_text("year"), 2, 4).alias("year"),
        F.coalesce(html_to_text("outline"), F.lit("")).alias("outline"),
        genre(html_to_text("genre")).alias("genre"),
    )


def _innermost_divs(block: Column) -> Column:
    """Inner HTML of every div that holds no other div."""
    pieces = F.slice(F.split(block, r"(?i)<div\b"), 2, 1_000_000_000)
    return F.transform(pieces, lambda p: F.regexp_extract(p, r"(?is)^[^>]*>(.*?)</div>", 1))


def extract_reviews(df: DataFrame, html: str = "html", keep=("title_url",)) -> DataFrame:
    """Reviews of review pages: headline, author link, rating and text.

    Header blocks and body paragraphs are two lists; after the boilerplate is
    filtered out of both, the i-th header belongs to the i-th body.
    """
    content = F.regexp_extract(F.col(html), CONTENT_START, 1)
    headers = F.filter(
        _innermost_divs(content), lambda d: d.rlike("(?i)<h2") & ~F.contains(d, F.lit(USEFUL_NOTICE))
    )
    bodies = F.filter(
        F.transform(all_matches(content, PARAGRAPH), lambda p: html_to_text(p)),
        lambda p: ~F.trim(p).isin(SPOILER_NOTICE, ADD_REVIEW_NOTICE),
    )
    pairs = df.select(*keep, headers.alias("__headers"), bodies.alias("__bodies")).select(
        *keep,
        F.posexplode(
            F.transform(
                "__headers", lambda h, i: F.struct(h.alias("header"), F.get("__bodies", i).alias("body"))
            )
        ).alias("pos", "r"),
    )
    return pairs.select(
        *keep,
        "pos",
        html_to_text(first_match("r.header", HEADLINE)).alias("headline"),
        first_match("r.header", LINK_HREF).alias("author"),
        parse_rating(first_match("r.header", ALT_TEXT)).alias("rating"),
        replace_newlines("r.body").alias("review"),
    )


def extract_genres(df: DataFrame, html: str = "html", keep=("title_url",)) -> DataFrame:
    """Genres of detail pages, as array and as joined text."""
    block = html_to_text(first_match(html, GENRE_BLOCK))
    names = split_genres(F.substring(block, F.lit(GENRE_PREFIX + 1), F.length(block)))
    return df.select(*keep, names.alias("genres")).withColumn("genre", F.array_join("genres", " | "))


def extract_page(df: DataFrame, html: str = "html", keep=("page_id", "url")) -> DataFrame:
    """Title, links, paragraphs and visible text of any web page."""
    return df.select(
        *keep,
        html_to_text(first_match(html, PAGE_TITLE)).alias("title"),
        all_matches(html, LINK_HREF).alias("links"),
        F.transform(all_matches(html, PARAGRAPH), lambda p: html_to_text(p)).alias("paragraphs"),
        html_to_text(html).alias("text"),
    )
