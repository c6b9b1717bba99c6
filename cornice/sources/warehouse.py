"""Reads of a warehouse: named projections over a range of years, for many tickers in one scan, and what came of each ticker.

Each takes a DataFrame of the table, however it is read; `partitioned_read` reads one
over JDBC in parallel, by lists of tickers.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed columns of annual compensation, of director compensation, and fixed filters of annual fundamentals.
ANNUAL_COMPENSATION = """
ticker year address city coname cusip exchange gvkey inddesc naics naicsdesc sic sicdesc spcode spindex state sub_tele tele zip
execid exec_fname exec_fullname exec_lname exec_mname gender nameprefix page becameceo co_per_rol execrank joined_co leftco leftofc
pceo pcfo reason rejoin releft title age allothpd allothtot bonus ceoann cfoann chg_ctrl_pymt comment defer_balance_tot
defer_contrib_co_tot defer_contrib_exec_tot defer_earnings_tot defer_rpt_as_comp_tot defer_withdr_tot eip_unearn_num eip_unearn_val
execdir execrankann interlock ltip noneq_incent old_datafmt_flag option_awards option_awards_blk_value option_awards_fv
option_awards_num option_awards_rpt_value opt_exer_num opt_exer_val opt_unex_exer_est_val opt_unex_exer_num opt_unex_unexer_est_val
opt_unex_unexer_num othann othcomp pension_chg pension_pymts_tot pension_value_tot reprice ret_yrs rstkgrnt rstkvyrs salary sal_pct
shrown_excl_opts shrown_excl_opts_pct shrown_tot shrown_tot_pct shrs_vest_num shrs_vest_val stock_awards stock_awards_fv
stock_unvest_num stock_unvest_val tdc1 tdc1_pct tdc2 tdc2_pct term_pymt titleann total_alt1 total_alt1_pct total_alt2 total_alt2_pct
total_curr total_curr_pct total_sec total_sec_pct
""".split()
DIRECTOR_COMPENSATION = """
cusip year address city coname exchange gvkey inddesc naics naicsdesc sic sicdesc spcode spindex state sub_tele tele ticker zip
cash_fees dirname dirnbr noneq_incent option_awards othcomp pension_chg stock_awards total_sec
""".split()
FUNDAMENTALS = {"indfmt": "INDL", "datafmt": "STD", "popsrc": "D", "consol": "C"}
#: First year of a batch, and how many tickers a JDBC query names.
FIRST_YEAR, IN_LIST = 1992, 500


def last_year() -> int:
    return date.today().year - 1


def in_lists(column: str, values: list[str], size: int = IN_LIST) -> list[str]:
    """SQL conditions that name all values, each of size values at most; quotes within values are doubled."""
    quoted = ["'" + v.replace("'", "''") + "'" for v in dict.fromkeys(values)]
    return [f"{column} IN ({', '.join(quoted[i : i + size])})" for i in range(0, len(quoted), size)]


def read_query(spark: SparkSession, url: str, query: str, properties: dict[str, str]) -> DataFrame:
    """A query of a PostgreSQL warehouse over JDBC; credentials come with the properties."""
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**properties).load()


def partitioned_read(spark: SparkSession, url: str, table: str, column: str, values: list[str], properties: dict[str, str], where: str = "1 = 1") -> DataFrame:
    """The rows of a PostgreSQL table that have one of the values, a partition and a query for each list of them."""
    return spark.read.jdbc(url, table, predicates=[f"({where}) AND {p}" for p in in_lists(column, values)], properties=properties)


def _of_tickers(df: DataFrame, column: str, tickers: DataFrame | None) -> DataFrame:
    """Rows of the tickers; their list may be long, so it is a table and joined."""
    if tickers is None:
        return df
    wanted = tickers.select(F.upper(tickers.columns[0]).alias("_ticker")).where("_ticker <> ''").distinct()
    return df.join(wanted, F.col(column) == F.col("_ticker"), "left_semi")


def annual_compensation(anncomp: DataFrame, tickers: DataFrame | None = None, first: int = FIRST_YEAR, last: int | None = None) -> DataFrame:
    rows = anncomp.where(F.col("year").between(first, last or last_year()))
    return _of_tickers(rows.select(*ANNUAL_COMPENSATION), "ticker", tickers)


def director_compensation(directorcomp: DataFrame, tickers: DataFrame | None = None, first: int = FIRST_YEAR, last: int | None = None) -> DataFrame:
    rows = directorcomp.where(F.col("year").between(first, last or last_year()))
    return _of_tickers(rows.select(*DIRECTOR_COMPENSATION), "ticker", tickers)


def annual_fundamentals(funda: DataFrame, tickers: DataFrame | None = None, first: int = FIRST_YEAR, last: int | None = None) -> DataFrame:
    """All columns of standard consolidated industrial statements."""
    rows = funda.where(F.col("fyear").between(first, last or last_year()))
    for column, value in FUNDAMENTALS.items():
        rows = rows.where(F.col(column) == value)
    return _of_tickers(rows, "tic", tickers)


def batch_outcomes(tickers: DataFrame, results: dict[str, DataFrame], ticker: str = "ticker") -> DataFrame:
    """ticker, a number of rows for each result, and status: downloaded, partial, no_data, or invalid for a blank ticker.

    A row for each distinct ticker of the list, so that nothing fails unseen.
    """
    name = F.trim(F.col(tickers.columns[0]))
    out = tickers.select(F.upper(F.coalesce(name, F.lit(""))).alias(ticker)).distinct()
    for n, df in results.items():
        out = out.join(df.groupBy(ticker).agg(F.count("*").alias(f"n_{n}")), ticker, "left")
    counts = [F.coalesce(F.col(f"n_{n}"), F.lit(0)) for n in results]
    full = sum(((c > 0).cast("int") for c in counts), F.lit(0))
    status = F.when(F.col(ticker) == "", "invalid").when(full == len(counts), "downloaded").when(full > 0, "partial").otherwise("no_data")
    return out.select(ticker, *[c.alias(f"n_{n}") for n, c in zip(results, counts, strict=True)], status.alias("status"))


def write_batch(results: dict[str, DataFrame], folder: str, ticker: str = "ticker") -> None:
    """Each result as CSV with a header under <folder>/<result>/ticker=<ticker>; the files of a ticker come from few tasks."""
    for n, df in results.items():
        df.withColumn("_t", F.col(ticker)).repartition("_t").write.mode("overwrite").partitionBy("_t").csv(f"{folder}/{n}", header=True)
