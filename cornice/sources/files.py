"""Readers and writers: filings, master records, metadata, CSV, warehouse tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import file_parts, form_folder
from ..session import cut


def tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """Parquet tables of a folder, each also a temporary view."""
    out = {}
    for name in names:
        out[name] = spark.read.parquet(f"{folder}/{name}.parquet")
        out[name].createOrReplaceTempView(name)
    return out


def csv_views(spark: SparkSession, paths: dict[str, str]) -> None:
    """Temporary views over CSV files with a header, for SQL: types are inferred, and each query scans the files anew."""
    for name, path in paths.items():
        quoted = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{name}` USING csv OPTIONS (path '{quoted}', header 'true', inferSchema 'true')")


def read_csv(spark: SparkSession, path: str, typed: bool = True, header: bool = True) -> DataFrame:
    return spark.read.csv(path, header=header, inferSchema=typed)


def valid_text(content: F.Column) -> F.Column:
    """Bytes as UTF-8 text without those that aren't valid; replacement characters of the text's own stay."""
    mark, other = F.lit("\ufffd"), F.lit("\U0010ffff")
    raw = F.replace(content.cast("string"), mark, other)
    return F.replace(F.replace(F.make_valid_utf8(raw), mark, F.lit("")), other, mark)


def filings(spark: SparkSession, root: str, extension: str = "html") -> DataFrame:
    """path, content, text, ticker, form, date of <root>/<ticker>/<form>/<date>_<form>.<extension>."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{extension}").load(root)
    raw = raw.where(~F.col("path").contains("/extracted/"))
    parts = file_parts(F.col("path"))
    text = valid_text(F.col("content"))
    return raw.select("path", "length", "content", text.alias("text"), *[c.alias(n) for n, c in parts.items() if n != "ext"])


def _path(spark: SparkSession, path: str):
    """A path and its file system by Hadoop's API, which knows any store."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it isn't there."""
    at, store = _path(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(at)) if store.exists(at) else []


def delete_path(spark: SparkSession, path: str) -> None:
    at, store = _path(spark, path)
    store.delete(at, True)


def tickers_with(files: DataFrame) -> DataFrame:
    return files.where(~F.col("ticker").startswith(".")).select(F.upper("ticker").alias("ticker")).distinct().orderBy("ticker")


def stored_path(ticker: str, form: str, date: str, extension: str) -> F.Column:
    folder = form_folder(F.col(form))
    return F.concat_ws("/", F.col(ticker), folder, F.concat(F.col(date).cast("string"), F.lit("_"), folder, F.lit(f".{extension}")))


def with_sidecar(files: DataFrame) -> DataFrame:
    """size and sha256 of the content, as a filing's sidecar has them."""
    return files.withColumn("size", F.length("content").cast("long")).withColumn("sha256", F.sha2("content", 256))


def master_records(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """id and fields of a JSON object keyed by id, or of a list, whose places are the ids."""
    raw = spark.read.text(path, wholetext=True)
    value = F.trim("value")
    as_map = raw.where(value.startswith("{")).select(F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("id", "rec"))
    as_list = raw.where(value.startswith("[")).select(F.posexplode(F.from_json("value", "array<map<string,string>>")).alias("id", "rec"))
    rows = as_map.unionByName(as_list.withColumn("id", F.col("id").cast("string")))
    return rows.select("id", *[F.col("rec")[f].alias(f) for f in fields])


def master_lines(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """id and fields of a master kept as JSON lines with an id each, which any number of tasks read; a line that is no record is left out."""
    rows = spark.read.schema(", ".join(["id string", *[f"`{f}` string" for f in fields], "_corrupt_record string"])).json(path)
    return rows.where("_corrupt_record is null and id is not null").drop("_corrupt_record")


def write_master(df: DataFrame, path: str, id_column: str = "id") -> None:
    """A master as JSON lines, for master_lines()."""
    df.withColumn("id", F.col(id_column).cast("string")).write.mode("overwrite").json(path)


def column_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("column string, name string, description string").json(path, multiLine=True)


def search_columns(catalog: DataFrame, term: str) -> DataFrame:
    t = term.lower()
    test = F.lit(False)
    for c in ("column", "name", "description"):
        test = test | F.coalesce(F.lower(c).contains(t), F.lit(False))
    return catalog.where(test)


def read_list(path: str, names: tuple[str, ...], upper: bool = True) -> list[str]:
    """Values of a list file: a named column, one row of values, or a value per line, in order and once each."""
    lines = [x.strip() for x in Path(path).read_text().splitlines() if x.strip()]
    if not lines:
        return []
    sep = next((s for s in ("\t", ";", "|", ",") if s in lines[0]), None)
    cells = [[c.strip().strip('"') for c in (x.split(sep) if sep else [x])] for x in lines]
    head = [c.lower() for c in cells[0]]
    at = next((head.index(n) for n in names if n in head), None)
    values = [r[at] for r in cells[1:] if len(r) > at] if at is not None else cells[0] if len(cells) == 1 else [r[0] for r in cells]
    return list(dict.fromkeys(v.upper() if upper else v for v in values if v))


def export_csv(df: DataFrame, path: str) -> bool:
    """Write CSV with a header unless df is empty."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").csv(path, header=True)
    return True


def export_json(df: DataFrame, path: str, by: str) -> None:
    df.write.mode("overwrite").partitionBy(by).json(path)


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_lines(df: DataFrame, column: str, path: str) -> None:
    """A line for each value, in order."""
    df.select(F.col(column).cast("string")).where(F.col(column).isNotNull()).orderBy(column).write.mode("overwrite").text(path)


def export_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, sep="\t")


def export_version(df: DataFrame, folder: str, version: str) -> str:
    """Write JSON lines to a folder of their own below `folder`, beside the earlier versions; Spark's commit makes it whole or absent."""
    path = f"{folder}/version={version}"
    df.write.mode("errorifexists").json(path)
    return path


def routed(df: DataFrame, kind: str, sinks: dict[str, Callable[[DataFrame], None]]) -> DataFrame:
    """Each row to the sink of its kind; the rows are worked out once.  Gives kind, n, written; rows without a sink are counted only."""
    df = cut(df)
    for name, sink in sinks.items():
        sink(df.where(F.col(kind) == name))
    return df.groupBy(kind).agg(F.count("*").alias("n")).withColumn("written", F.coalesce(F.col(kind).isin(*sinks), F.lit(False)))


class StageDumps:
    """Tables of chosen stages as CSV with a header under <folder>/<stage>, for a look at what a cleaning does; none by default."""

    def __init__(self, folder: str | None = None, stages: tuple[str, ...] = ()):
        self.folder, self.stages = folder, stages

    def __call__(self, stage: str, df: DataFrame) -> DataFrame:
        """The same table; one that is dumped is worked out once for that and for what follows."""
        if self.folder is None or stage not in self.stages:
            return df
        df = cut(df)
        flat = [F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("map", "array", "struct") else F.col(f.name) for f in df.schema.fields]
        df.select(*flat).write.mode("overwrite").csv(f"{self.folder}/{stage}", header=True)
        return df
