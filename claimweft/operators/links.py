"""Link mining over stored pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweft.operators.dedupe import first_per_key

ANCHOR = r"""(?is)<a\s[^>]*?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a>"""
# Character entities that occur in addresses.
ENTITIES = (("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))

# Date shapes in file names, tried in this order, and their formats.
NAME_DATES = (
    (r"(\d{1,2}-\d{1,2}-20\d{2})", "M-d-yyyy"),
    (r"(\d{1,2}_\d{1,2}_20\d{2})", "M_d_yyyy"),
    (r"(\d{1,2}\.\d{1,2}\.20\d{2})", "M.d.yyyy"),
    (r"(\d{2}\d{2}20\d{2})", "MMddyyyy"),
)


def extract_links(
    pages: DataFrame,
    page: str = "page_id",
    html: str = "html",
    extensions: Sequence[str] = (),
    text_contains: str | None = None,
) -> DataFrame:
    """(page, position, href, text) of every anchor with a target, optionally filtered.

    Targets may be in double, single or no quotes; their entities are decoded.
    """
    groups = [F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(i + 1)) for i in range(4)]
    names = ("double", "single", "bare", "text")
    anchors = F.arrays_zip(*[g.alias(n) for g, n in zip(groups, names)])
    links = pages.select(page, F.posexplode(anchors).alias("position", "_a")).select(
        page,
        "position",
        F.trim(decode_entities(F.concat("_a.double", "_a.single", "_a.bare"))).alias("href"),
        F.trim(F.regexp_replace("_a.text", r"<[^>]*>", "")).alias("text"),
    )
    links = links.filter(F.col("href") != "")
    if extensions:
        ends = [F.col("href").endswith(e) for e in extensions]
        hit = ends[0]
        for more in ends[1:]:
            hit = hit | more
        links = links.filter(hit)
    if text_contains is not None:
        links = links.filter(F.col("text").contains(text_contains))
    return links


def decode_entities(text: Column) -> Column:
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def absolute_url(base: Column, href: Column) -> Column:
    """Address of a link on the page ``base``; parent steps (``../``) are taken one by one, at most ten."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)//", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_replace(F.substr(base, F.length(origin) + 1), r"[?#].*$", "")
    folder = F.coalesce(F.nullif(F.regexp_replace(path, r"[^/]*$", ""), F.lit("")), F.lit("/"))
    joined = (
        F.when(href.startswith("/"), href)
        .when(href.startswith("?"), F.concat(F.coalesce(F.nullif(path, F.lit("")), F.lit("/")), href))
        .otherwise(F.concat(folder, href))
    )
    for _ in range(10):
        joined = F.regexp_replace(joined, r"^((?:/[^/?#]+)*?)/(?!\.\.?/)[^/?#]+/\.\./", "$1/")
    joined = F.regexp_replace(F.regexp_replace(joined, r"^(/\.\.)+/", "/"), r"/(\./)+", "/")
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), href))
        .otherwise(F.concat(origin, joined))
    )


def file_name(url: Column) -> Column:
    """Last path part in lower case, without query and fragment."""
    last = F.element_at(F.split(url, "/"), -1)
    return F.regexp_replace(F.lower(last), r"[?#].*$", "")


def posted_date(url: Column) -> Column:
    """Date in the file name: the first shape that yields a real date wins."""
    name = file_name(url)
    return F.coalesce(
        *[
            F.to_date(F.try_to_timestamp(F.nullif(F.regexp_extract(name, shape, 1), F.lit("")), F.lit(fmt)))
            for shape, fmt in NAME_DATES
        ]
    )


def named_year(url: Column, text: Column) -> Column:
    """Calendar year of a link: ``cy20xx`` first, else any ``20xx``, as text."""
    both = F.lower(F.concat_ws(" ", text, url))
    return F.coalesce(
        F.nullif(F.regexp_extract(both, r"cy(20\d{2})", 1), F.lit("")),
        F.nullif(F.regexp_extract(both, r"(20\d{2})", 1), F.lit("")),
    )


def latest_link(links: DataFrame, by: Sequence[str], href: str = "href", text: str = "text", position: str = "position") -> DataFrame:
    """Newest link per group: by date in the name; without any date by (year, address).

    Among equal dates the later position wins.
    """
    dated = links.withColumns({"posted": posted_date(F.col(href)), "year": named_year(F.col(href), F.col(text))})
    undated = F.col("posted").isNull()
    rank = F.struct(
        F.col("posted").isNotNull().alias("_dated"),
        F.col("posted").alias("_posted"),
        F.when(undated, F.coalesce(F.col("year").try_cast("int"), F.lit(-1))).alias("_year"),
        F.when(undated, F.col(href)).alias("_href"),
        F.col(position).alias("_position"),
    )
    best = F.max_by(F.struct(href, text, "posted", "year"), rank).alias("_best")
    return dated.groupBy(*by).agg(best).select(
        *by, *[F.col(f"_best.{c}").alias(c) for c in (href, text, "posted", "year")]
    )


def latest_year_page(links: DataFrame, by: Sequence[str], pattern: str = r"/(20\d{2})-model-software", href: str = "href", position: str = "position") -> DataFrame:
    """Link of the highest year matching the pattern; the last link of that year wins."""
    years = links.withColumn("year", F.nullif(F.regexp_extract(href, pattern, 1), F.lit("")))
    return first_per_key(
        years.filter(F.col("year").isNotNull()),
        by,
        [F.col("year").desc(), F.col(position).desc()],
    ).select(*by, "year", href)


def next_iteration(records: DataFrame, projects: DataFrame, project: str, iteration: str) -> DataFrame:
    """Per project: next iteration number (1 without records) and number of records."""
    counts = records.groupBy(project).agg(
        F.max(F.coalesce(F.col(iteration), F.lit(0))).alias("_last"), F.count("*").alias("_n")
    )
    return projects.select(project).distinct().join(counts, project, "left").select(
        project,
        (F.coalesce(F.col("_last"), F.lit(0)) + 1).alias("next_iteration"),
        F.coalesce(F.col("_n"), F.lit(0)).alias("n_records"),
    )
