"""Plans that must not depend on how few files the input has, nor join a table with itself."""

from pyspark.sql import functions as F

from cornice.functions.htmlkit import parse_tables
from cornice.functions.nodes import parse_nodes
from cornice.operators import ascii_tables as A
from cornice.operators import cells as C
from cornice.operators import narrative as N
from cornice.operators import pages as P
from cornice.operators import scorers as SC
from cornice.operators import sections as S
from cornice.operators import tables as T

PAGE = "<table><tr><td>Name and Principal Position<td>Year<td>Salary<tr><td>Ann Roe<td>2023<td>5</table>"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _pages(spark):
    return spark.range(64).coalesce(1).select(F.col("id").cast("string").alias("doc"), F.lit(PAGE).alias("html"))


def test_pages_of_one_file_are_parsed_by_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    for parsed in (parse_tables(_pages(spark)), parse_nodes(_pages(spark), once=False)):
        assert parsed.select(F.spark_partition_id().alias("p")).distinct().count() >= min(2, cores)


def test_scores_and_guards_parse_once(spark):
    cells = parse_tables(_pages(spark))
    for found in (C.score_tables(cells), C.guard_tables(cells), C.best_table(cells), C.extracted_tables(cells, "both")):
        assert _plan(found).count("MapInArrow") == 1 and "Join" not in _plan(found)
        assert found.select("doc").distinct().count() == 64


def test_cleaning_parses_once(spark):
    rows = C.clean_sct(C.best_table(parse_tables(_pages(spark))))
    assert _plan(rows).count("MapInArrow") == 1 and "Join" not in _plan(rows)
    assert {(r.executive, r.year, r.fields["salary"]) for r in rows.collect()} == {("ann roe", 2023, "5")} and rows.count() == 64


def test_steps_on_lines_deal_texts_out_once(spark):
    docs = spark.range(8).coalesce(1).select(F.col("id").alias("k"), F.lit("Name and Principal Position   Year   Salary\nAnn Roe   2001   $5\nＡnn   x   7").alias("t"))
    for found in (N.summary_tables(docs, "k", "t"), N.top_paragraphs(docs, "k", "t"), A.with_found_header(A.ascii_cells(docs, "k", "t")), S.ownership_lines(docs, "k", "t")):
        assert "Join" not in _plan(found) and found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert "Ann   x" in N.summary_tables(docs, "k", "t").first().snippet and N.summary_tables(docs.withColumn("t", F.lit("")), "k", "t").count() == 8


def test_joins_of_nodes_send_nothing_to_the_driver(spark):
    pages = _pages(spark).withColumn("url", F.lit("https://host.example/"))
    nodes = parse_nodes(pages)
    for found in (P.index_documents(nodes, pages, "doc", "url", "DEF 14A"), P.titled_tables(nodes, "doc"), P.tables_after_anchors(nodes, "doc"), P.salary_tables(nodes, "doc")):
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_columns_are_named_without_joins(spark):
    cells = spark.range(4).select(F.col("id").alias("doc"), F.lit(0).alias("table_idx"), F.inline(F.array(*[F.struct(F.lit(r).alias("row_idx"), F.lit(c).alias("col_idx"), F.lit("a").alias("name"), F.lit(v).alias("text")) for r, c, v in [(0, 0, "Name"), (1, 0, "Ann"), (0, 1, "Pay"), (1, 1, "5")]])))
    for found in (C.unique_names(cells), T.with_two_row_header(cells), C.merged_fields(cells)):
        assert "Join" not in _plan(found)
    assert {(r.col_idx, r.name) for r in C.unique_names(cells).collect()} == {(0, "a"), (1, "a_2")}


def test_older_scores_parse_once(spark):
    cells = parse_tables(_pages(spark))
    for found in (SC.first_score(cells), SC.ranked_score(cells), SC.fallback_score(cells), SC.legacy_score(cells, ["salary"])):
        assert _plan(found).count("MapInArrow") == 1 and "Join" not in _plan(found)
