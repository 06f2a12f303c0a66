"""Reading reviews: JDBC, CSV, catalog tables, landed JSON pages and HTML."""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echoloom import schema
from echoloom.functions.text import html_nodes
from echoloom.operators.keyed import first_per_group, lookup_join

# Source table, driver class and pooler setting.
SOURCE_TABLE = "raw_reviews"
JDBC_DRIVER = "org.postgresql.Driver"
PREPARE_THRESHOLD = "0"


def jdbc_options(database_url: str) -> dict[str, str]:
    """Spark JDBC options from a ``postgres://user:password@host/db`` address."""
    parts = urlsplit(database_url)
    if parts.scheme not in ("postgres", "postgresql"):
        raise ValueError("only postgres:// and postgresql:// addresses are supported")
    host = parts.netloc.rpartition("@")[2]
    query = f"?{parts.query}" if parts.query else ""
    return {
        "url": f"jdbc:postgresql://{host}{parts.path}{query}",
        "user": unquote(parts.username or ""),
        "password": unquote(parts.password or ""),
        "driver": JDBC_DRIVER,
        "prepareThreshold": PREPARE_THRESHOLD,
    }


def jdbc_scan_options(
    database_url: str,
    table: str = SOURCE_TABLE,
    partition_column: str = "review_id",
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a table read, split by key range when its bounds are given."""
    options = jdbc_options(database_url) | {
        "dbtable": f'"{table}"',
        "fetchsize": str(fetch_size),
    }
    if lower_bound is not None and upper_bound is not None:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
            "numPartitions": str(partitions),
        }
    return options


def jdbc_bounds_options(
    database_url: str, table: str = SOURCE_TABLE, partition_column: str = "review_id"
) -> dict[str, str]:
    """Options of the query for the smallest and largest key, answered by the database."""
    column = f'"{partition_column}"'
    query = f'SELECT min({column}) AS low, max({column}) AS high FROM "{table}"'
    return jdbc_options(database_url) | {"query": query}


def scan_jdbc(
    spark: SparkSession,
    database_url: str,
    table: str = SOURCE_TABLE,
    partition_column: str | None = "review_id",
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    **options,
) -> DataFrame:
    """Read a table over many connections, each a range of ``partition_column`` (a whole number).

    Without bounds the database is asked for them first.  A table without rows,
    or without a ``partition_column`` (None), is read over one connection.
    """
    if partition_column is None:
        split: dict = {}
    else:
        if lower_bound is None or upper_bound is None:
            bounds = jdbc_bounds_options(database_url, table, partition_column)
            low, high = spark.read.format("jdbc").options(**bounds).load().first()
            lower_bound = low if lower_bound is None else lower_bound
            upper_bound = high if upper_bound is None else upper_bound
        if lower_bound is not None and upper_bound is not None:
            upper_bound = max(upper_bound, lower_bound + 1)  # Spark takes no range whose bounds are equal
        split = {
            "partition_column": partition_column,
            "lower_bound": lower_bound,
            "upper_bound": upper_bound,
        }
    scan = jdbc_scan_options(database_url, table, **split, **options)
    return spark.read.format("jdbc").options(**scan).load()


def scan_csv(
    spark: SparkSession,
    path: str,
    columns: T.StructType = schema.RAW_REVIEWS,
    multi_line: bool = True,
    corrupt: str | None = None,
) -> DataFrame:
    """Review CSV with a header; quoted fields may hold line breaks.

    With ``multi_line`` each file is read by one task; switch it off for files
    without such breaks, and Spark splits them.  ``corrupt`` names a column that
    receives the text of rows with a value that does not parse.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    if corrupt:
        columns = T.StructType([*columns.fields, T.StructField(corrupt, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(columns).csv(path)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def scan_json_pages(pages: DataFrame, max_reviews: int = 100) -> DataFrame:
    """Review texts from landed feed pages ``(app_id, page, body)``.

    Per app, reading ends before the first page without reviews and after the
    first page without a next-page token; empty snippets are skipped and at
    most ``max_reviews`` texts are kept in page order.
    """
    parsed = pages.select(
        "app_id", "page", F.from_json("body", schema.REVIEW_PAGE_BODY).alias("body")
    ).select(
        "app_id",
        "page",
        F.col("body.reviews").alias("reviews"),
        F.col("body.serpapi_pagination.next_page_token").alias("token"),
    )
    empty = F.coalesce(F.size("reviews"), F.lit(0)) <= 0
    ends = parsed.groupBy("app_id").agg(
        F.min(F.when(empty, F.col("page"))).alias("empty_page"),
        F.min(F.when(F.col("token").isNull(), F.col("page"))).alias("last_page"),
    )
    readable = lookup_join(parsed, ends, ["app_id"], ["page"]).filter(
        (F.col("empty_page").isNull() | (F.col("page") < F.col("empty_page")))
        & (F.col("last_page").isNull() | (F.col("page") <= F.col("last_page")))
    )
    snippets = (
        readable.select("app_id", "page", F.posexplode("reviews").alias("position", "review"))
        .select("app_id", "page", "position", F.col("review.snippet").alias("content"))
        .filter(F.col("content") != "")
    )
    return first_per_group(
        snippets, ["app_id"], [F.col("page"), F.col("position")], max_reviews, rank="review_no"
    )


def scan_html_reviews(
    pages: DataFrame,
    key: str,
    html: str = "html",
    tag: str = "p",
    css_class: str | None = None,
    max_reviews: int = 50,
) -> DataFrame:
    """Texts of the first matching nodes of each stored page."""
    nodes = F.slice(html_nodes(F.col(html), tag, css_class), 1, max_reviews)
    return pages.select(key, F.posexplode(nodes).alias("position", "content"))
