"""Queries that read HTML: landed pages, and pages derived from the tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinolens.functions.arrays import names_of
from kinolens.functions.html import html_to_text
from kinolens.labels import ADD_REVIEW_NOTICE, LABELS_14, SPOILER_NOTICE, UNWANTED_GENRES, USEFUL_NOTICE
from kinolens.operators import extract as ex
from kinolens.plans import sql as S
from kinolens.plans.catalog import query
from kinolens.sources import views as V


def escape(c) -> Column:
    """Text as it stands in HTML."""
    text = F.col(c) if isinstance(c, str) else c
    for raw, entity in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")]:
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def listing_pages(spark, sf_dir):
    """One listing page per document with two films: with and without outline."""
    docs = V.reviews(spark, sf_dir)
    genres = F.array_join(F.reverse(names_of(V.film_target(F.col("title_url")), LABELS_14)), " | ")
    year = (1900 + F.col("review_id") % 120).cast("string")

    def cell(link, outline):
        return F.concat(
            F.lit('<td class="title">\n<a href="'), link, F.lit('">Film '), F.col("review_id").cast("string"),
            F.lit('</a>\n<span class="year_type">('), year, F.lit(")</span>"), outline,
            F.lit('<span class="genre"> Biography | '), F.upper(genres), F.lit("</span></td>"),
        )

    first = F.concat(F.lit("/title/"), F.col("review_id").cast("string"), F.lit("/"))
    second = F.concat(F.lit("/title/next"), F.col("review_id").cast("string"), F.lit("/"))
    outline = F.concat(F.lit('<span class="outline">'), escape("review"), F.lit("</span>"))
    page = F.concat(
        F.lit("<html><table><tr>"), cell(first, outline), F.lit("</tr><tr>"), cell(second, F.lit("")),
        F.lit("</tr></table></html>"),
    )
    return docs.select("review_id", page.alias("html"))


def review_pages(spark, sf_dir):
    """One review page per document: its text with a rating, its language without."""
    docs = V.reviews(spark, sf_dir)
    rid = F.col("review_id").cast("string")
    page = F.concat(
        F.lit('<html><div id="tn15content">\n<div>\n<h2>On '), rid, F.lit('</h2>\n<a href="/user/'), rid,
        F.lit('/">someone</a><img alt="'), (F.col("review_id") % 10 + 1).cast("string"), F.lit('/10">\n</div>\n<p>'),
        escape("review"), F.lit(f"</p>\n<div>\n\n{USEFUL_NOTICE}\r\n\n</div>\n<div><h2>"), F.col("lang"),
        F.lit(f'</h2><a href="/user/x/">x</a></div><p><b>{SPOILER_NOTICE}</b></p>\n<p>Written in\n'), F.col("lang"),
        F.lit(f'</p><p><a href="/add">{ADD_REVIEW_NOTICE}</a></p></div></html>'),
    )
    return docs.select(F.col("review_id").alias("title_url"), page.alias("html"))


def detail_pages(spark, sf_dir):
    docs = V.reviews(spark, sf_dir)
    genres = F.transform(
        F.reverse(names_of(V.film_target(F.col("title_url")), LABELS_14)),
        lambda g: F.concat(F.lit('<a href="/g">'), F.upper(g), F.lit("</a>&nbsp;")),
    )
    page = F.concat(
        F.lit('<div itemprop="genre">\n<h4>Genres:</h4>\n '), F.array_join(genres, "<span>|</span> "), F.lit("\n</div>")
    )
    return docs.select(F.col("review_id").alias("title_url"), page.alias("html"))


@query("b1_html_to_text", f"SELECT page_id, {S.stripped('html')} AS text FROM pages")
def b1(spark, sf_dir):
    return V.pages(spark, sf_dir).select("page_id", html_to_text("html").alias("text"))


@query(
    "b2_extract_records",
    r"""WITH r AS (SELECT page_id, regexp_extract_all(html, '(?s)<li>.*?</li>') AS l FROM pages),
u AS (SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS pos, unnest(l) AS b FROM r)
SELECT page_id, pos, regexp_extract(b, 'href="([^"]*)"', 1) AS link, regexp_extract(b, '<a[^>]*>(.*?)</a>', 1) AS label FROM u""",
)
def b2(spark, sf_dir):
    fields = {"link": r'href="([^"]*)"', "label": r"<a[^>]*>(.*?)</a>"}
    return ex.extract_records(V.pages(spark, sf_dir), "html", r"(?s)<li>.*?</li>", fields, ["page_id"])


@query(
    "b3_extract_titles",
    f"""WITH {S.FILMS},
g AS (SELECT title_url, string_agg(label, ' | ' ORDER BY label) FILTER (label NOT IN ({S.quoted(UNWANTED_GENRES)})) AS genre
      FROM film_labels GROUP BY title_url),
d AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS rid, text, genre FROM documents JOIN g ON g.title_url = source),
a AS (SELECT *, CAST(1900 + doc_id % 120 AS VARCHAR) AS year FROM d)
SELECT doc_id AS review_id, CAST(0 AS INT) AS pos, '/title/' || rid || '/' AS title_url, 'Film ' || rid AS title, year,
       text AS outline, coalesce(genre, '') AS genre FROM a
UNION ALL
SELECT doc_id, CAST(1 AS INT), '/title/next' || rid || '/', 'Film ' || rid, year, '', coalesce(genre, '') FROM a""",
)
def b3(spark, sf_dir):
    return ex.extract_titles(listing_pages(spark, sf_dir), keep=["review_id"])


@query(
    "b4_extract_reviews",
    """SELECT doc_id AS title_url, CAST(0 AS INT) AS pos, 'On ' || doc_id AS headline, '/user/' || doc_id || '/' AS author,
       CAST(doc_id % 10 + 1 AS INT) AS rating, replace(text, chr(10), ' ') AS review FROM documents
UNION ALL
SELECT doc_id, CAST(1 AS INT), lang, '/user/x/', NULL, 'Written in ' || lang FROM documents""",
)
def b4(spark, sf_dir):
    return ex.extract_reviews(review_pages(spark, sf_dir))


@query(
    "b6_extract_genres",
    f"""WITH {S.FILMS}
SELECT d.doc_id AS title_url, string_agg(label, ' | ' ORDER BY label) AS genre
FROM documents d JOIN film_labels l ON l.title_url = d.source GROUP BY d.doc_id""",
)
def b6(spark, sf_dir):
    return ex.extract_genres(detail_pages(spark, sf_dir)).select("title_url", "genre")


@query(
    "b7_extract_page",
    rf"""WITH p AS (
  SELECT page_id, url, {S.stripped(r"regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title,
         regexp_extract_all(html, '(?s)<a\b[^>]*href="([^"]*)"', 1) AS links,
         regexp_extract_all(html, '(?s)<p\b[^>]*>(.*?)</p>', 1) AS ps, {S.stripped('html')} AS text FROM pages)
SELECT page_id, url, title, array_to_string(links, ' ') AS links, CAST(len(ps) AS INT) AS n_paragraphs,
       array_to_string(list_transform(ps, lambda x: {S.stripped('x')}), chr(10)) AS body,
       CAST(length(text) AS INT) AS n_chars FROM p""",
)
def b7(spark, sf_dir):
    rows = ex.extract_page(V.pages(spark, sf_dir))
    return rows.select(
        "page_id", "url", "title", F.array_join("links", " ").alias("links"), F.size("paragraphs").alias("n_paragraphs"),
        F.array_join("paragraphs", "\n").alias("body"), F.length("text").alias("n_chars"),
    )
