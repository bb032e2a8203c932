"""Pages of text to typed rows: JSON listings, directory indexes, control files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import last_segment, source_id
from tidemark.schemas import ENTRIES, RAW_COUNTS, conform

_S = T.StringType()


def _page(**entry: T.DataType) -> T.StructType:
    fields = T.StructType([T.StructField(k, v) for k, v in entry.items()])
    return T.StructType([T.StructField("next_collection_link", _S), T.StructField("entries", T.ArrayType(fields))])


PUBLISHED_PAGE = _page(self_link=_S, binary_package_name=_S, binary_package_version=_S, distro_arch_series_link=_S, status=_S, date_published=_S)
COUNTS_PAGE = _page(binary_package_name=_S, binary_package_version=_S, day=_S, count=T.LongType())


def _parsed(text: Column, schema: T.StructType) -> Column:
    """A malformed page is an error, as it must not pass for an empty one."""
    return F.from_json(text, schema, {"mode": "FAILFAST"})


def published_entries(pages: DataFrame) -> DataFrame:
    """Entries of listing pages (channel, text); a page without entries has no rows."""
    rows = pages.select("channel", F.explode(_parsed(F.col("text"), PUBLISHED_PAGE)["entries"]).alias("e"))
    fields = {"source_id": source_id("e.self_link"), "artifact": F.col("e.binary_package_name"), "release": F.col("e.binary_package_version"), "arch": last_segment("e.distro_arch_series_link"), "status": F.col("e.status"), "published": F.col("e.date_published")}
    return conform(rows.withColumns(fields), ENTRIES)


def count_rows(pages: DataFrame) -> DataFrame:
    """Rows of count pages (channel, text); several countries of a day are several rows."""
    rows = pages.select("channel", F.explode(_parsed(F.col("text"), COUNTS_PAGE)["entries"]).alias("e"))
    fields = {"artifact": F.col("e.binary_package_name"), "release": F.col("e.binary_package_version"), "day": F.col("e.day").try_cast("date"), "n": F.col("e.count")}
    return conform(rows.withColumns(fields), RAW_COUNTS)


def next_links(pages: DataFrame) -> DataFrame:
    """channel and the next page's address; the last page has none."""
    return pages.select("channel", F.get_json_object("text", "$.next_collection_link").alias("next"))


def hrefs(html: Column) -> Column:
    """All link targets of a page, as an array."""
    return F.regexp_extract_all(html, F.lit(r'href="([^"]*)"'), F.lit(1))


def directories(html: Column) -> Column:
    """Names of the directories that an index page links to, as an array; parents and files are left out."""
    names = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r'href="([^"/]+)/"'), F.lit(1))
    return F.filter(names, lambda n: ~n.isin(".", ".."))


def directory_names(pages: DataFrame) -> DataFrame:
    """``directories`` of index pages (html), one a row."""
    return pages.select(F.explode(directories(F.col("html"))).alias("name"))


def control_names(texts: DataFrame, field: str = "Package") -> DataFrame:
    """Values of a field's lines in control-file texts (text), trimmed, in order of lines."""
    lines = texts.select(F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "line"))
    return lines.where(F.col("line").startswith(f"{field}:")).select("line_no", F.trim(F.substr("line", F.lit(len(field) + 2))).alias("name"))
