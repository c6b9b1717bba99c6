"""Tables and documents found by their place in a page: after anchors, by titles, on index pages.

All work on the node table of `functions.nodes`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nodes import HEADINGS, TEXT, by_place, contents, elements, tables_of
from ..functions.records import joined_url
from ..functions.text import strip

SCT = "summary compensation table"
#: Fixed phrases beside which a pay table is looked for.
NAME_CUES = r"(?iU)(name\s*(and|/|&)?\s*(principal)?\s*position)|principal\s*position|name\s*[/&]|named\s+executive\s+(officers?|positions?)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _href(attrs: Column) -> Column:
    return F.coalesce(attrs["href"], F.lit(""))


def anchor_links(nodes: DataFrame, key: str, phrase: str = SCT) -> DataFrame:
    """key, pos, href, text of the links to a place in the same page whose text holds the phrase, A-Z in any case."""
    links = elements(nodes, "a").where(_href(F.col("attrs")).startswith("#"))
    text = contents(nodes, key, "a")
    found = by_place(links, text, [key, "pos"]).where(F.translate("content", _UPPER, _UPPER.lower()).contains(phrase))
    return found.select(key, "pos", _href(F.col("attrs")).alias("href"), strip(F.col("content")).alias("text"))


def tables_after(nodes: DataFrame, key: str, places: DataFrame) -> DataFrame:
    """places (key, target, last) with table_idx: the first table that begins after each, null if none does.

    Places and tables are put in one order, backwards, and the nearest table is carried along.
    """
    marks = places.select(key, "target", F.col("last").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast("int").alias("_idx"))
    tables = tables_of(nodes, key).select(key, F.lit(None).cast("int").alias("target"), F.col("pos").alias("_at"), F.lit(0).alias("_kind"), F.col("table_idx").alias("_idx"))
    back = Window.partitionBy(key).orderBy(F.desc("_at"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    carried = marks.unionByName(tables).withColumn("table_idx", F.last("_idx", ignorenulls=True).over(back))
    return carried.where("_kind = 1").select(key, "target", "table_idx")


def tables_after_anchors(nodes: DataFrame, key: str, phrase: str = SCT) -> DataFrame:
    """key, pos, href, text, target, table_idx of each such link.

    target is the first element with the link's name as id or name, and the table the
    first that begins after its end: neither one inside it nor one around it.
    """
    links = anchor_links(nodes, key, phrase).withColumn("_name", F.substring("href", 2, 1 << 20))
    names = nodes.where("attrs is not null").select(key, F.col("pos").alias("target"), "last", F.explode(F.array_distinct(F.array(F.col("attrs")["id"], F.col("attrs")["name"]))).alias("_name"))
    wanted = by_place(names, links.select(key, "_name").distinct(), [key, "_name"], "left_semi")
    targets = wanted.groupBy(key, "_name").agg(F.min("target").alias("target"), F.min_by("last", "target").alias("last"))
    after = tables_after(nodes, key, targets.select(key, "target", "last").distinct())
    return by_place(by_place(links, targets.drop("last"), [key, "_name"], "left"), after, [key, "target"], "left").select(key, "pos", "href", "text", "target", "table_idx")


def titled_tables(nodes: DataFrame, key: str) -> DataFrame:
    """key, table_idx, title: a table's first caption, else the last heading that began before it, else Table_<number from 1>.

    An empty caption or heading counts as none, without a look at the ones before it.
    """
    tables = tables_of(nodes, key)
    title = contents(nodes, key, "caption", *HEADINGS, each=strip)
    captions = elements(nodes, "caption").select(key, F.col("pos").alias("_caption"), F.explode("inside").alias("pos"))
    captions = captions.groupBy(key, "pos").agg(F.min("_caption").alias("_caption"))
    heads = elements(nodes, *HEADINGS).select(key, "pos", F.col("pos").alias("_head"), F.lit(None).cast("int").alias("table_idx"))
    carried = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    both = heads.unionByName(tables.select(key, "pos", F.lit(None).cast("int").alias("_head"), "table_idx"))
    both = both.withColumn("_head", F.last("_head", ignorenulls=True).over(carried)).where("table_idx is not null")
    both = by_place(both, captions, [key, "pos"], "left").withColumn("_from", F.coalesce("_caption", "_head"))
    named = by_place(both, title.select(key, F.col("pos").alias("_from"), F.col("content").alias("_title")), [key, "_from"], "left")
    number = F.concat(F.lit("Table_"), F.col("table_idx") + 1)
    return named.select(key, "table_idx", F.coalesce("_title", number).alias("title"))


def index_documents(nodes: DataFrame, urls: DataFrame, key: str, url: str, form: str) -> DataFrame:
    """key, html_url, txt_url of each page of urls: the documents that a filing's index page links to.

    The page is the first row of a file table, its header row left out, whose cells name
    the form and whose first link ends in .htm or .html; else the first such link of the
    page.  The text is the first link that ends in .txt.
    """
    href = _href(F.col("attrs"))
    links = elements(nodes, "a").where(href != "").select(key, "pos", "inside", href.alias("href"))
    first = lambda pattern: F.min_by("href", F.when(F.col("href").rlike(pattern), F.col("pos")))
    plain = links.groupBy(key).agg(first(r"(?i)\.html?$").alias("_any"), first(r"(?i)\.txt$").alias("_txt"))

    files = tables_of(nodes, key).where(F.lower(F.coalesce(F.col("attrs")["class"], F.lit(""))).contains("tablefile"))
    rows = by_place(elements(nodes, "tr").select(key, F.col("pos").alias("_row"), F.explode("inside").alias("pos")), files.select(key, "pos"), [key, "pos"], "left_semi")
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy(key, "pos").orderBy("_row"))).where("_n > 1")

    cells = elements(nodes, "td", "th").select(key, F.col("pos"), F.explode("inside").alias("_row"))
    texts = by_place(cells, contents(nodes, key, "td", "th", between=" ", each=strip), [key, "pos"])
    texts = texts.groupBy(key, "_row").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "content"))), lambda x: x["content"]), "").alias("_text"))
    names_form = F.upper(F.replace("_text", F.lit(" "), F.lit(""))).contains(form.replace(" ", "").upper())
    # The first link of a row counts, with or without an address.
    firsts = elements(nodes, "a").select(key, F.col("pos").alias("_link"), href.alias("href"), F.explode("inside").alias("_row")).groupBy(key, "_row").agg(F.min_by("href", "_link").alias("href"))
    fit = by_place(by_place(rows, texts.where(names_form), [key, "_row"]), firsts, [key, "_row"]).where(F.col("href").rlike(r"(?i)\.html?$"))
    best = fit.groupBy(key).agg(F.min_by("href", F.struct("pos", "_row")).alias("_best"))
    out = by_place(by_place(urls.select(key, url), plain, key, "left"), best, key, "left")
    address = lambda c: F.when(c.isNotNull(), joined_url(F.col(url), c))
    return out.select(key, address(F.coalesce("_best", "_any")).alias("html_url"), address(F.col("_txt")).alias("txt_url"))


def salary_tables(nodes: DataFrame, key: str) -> DataFrame:
    """key, table_idx of each page's first table that holds a name cue in one piece of text, and salary in any cell."""
    tables = tables_of(nodes, key).select(key, "pos", "table_idx")
    cues = nodes.where((F.col("tag") == TEXT) & F.col("text").rlike(NAME_CUES)).select(key, F.col("pos").alias("_cue"), F.explode("inside").alias("pos"))
    # Of the tables around a cue the innermost counts.
    inner = by_place(cues, tables, [key, "pos"]).groupBy(key, "_cue").agg(F.max("pos").alias("pos"))
    paid = contents(nodes, key, "td", "th").where(F.lower("content").contains("salary")).select(key, F.col("pos").alias("_cell"))
    cells = elements(nodes, "td", "th").select(key, F.col("pos").alias("_cell"), F.explode("inside").alias("pos"))
    paid = by_place(cells, paid, [key, "_cell"], "left_semi").select(key, "pos").distinct()
    fit = by_place(inner, paid, [key, "pos"], "left_semi").groupBy(key).agg(F.min_by("pos", "_cue").alias("pos"))
    return by_place(fit, tables, [key, "pos"]).select(key, "table_idx")
