"""Elements of articles: bodies, abstracts, and the reports on what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litscreen.functions import markup, text


def keep_present(df: DataFrame, value: Column, name: str, empty: bool = True) -> DataFrame:
    """Add a column and keep the rows that have a value in it, empty texts included or not.

    A row gives none or one row. Written as an explode, because a filter on a computed column
    is moved below it by the optimizer and then computes it twice.
    """
    present = (lambda x: x.isNotNull()) if empty else (lambda x: x != "")
    return df.select("*", F.explode(F.filter(F.array(value), present)).alias(name))


def with_element(pages: DataFrame, name: str, column: str = "element", page: str = "page") -> DataFrame:
    """Add the first element of that name and keep the pages that have one."""
    return keep_present(pages, markup.first_element(F.col(page), name), column)


def bodies(decoded: DataFrame) -> DataFrame:
    """Query folder, id, body and time of fetch of each article that has one."""
    return with_element(decoded, "body", "body_html").select("query_folder", "id", "body_html", "fetched_at")


def abstracts(decoded: DataFrame, name: str = "abstract") -> DataFrame:
    """Query folder, id, text and markup of each abstract; the text may be empty."""
    plain = text.without_quotes(markup.paragraph_text(F.col("abstract_html")))
    return with_element(decoded, name, "abstract_html").select(
        "query_folder", "id", plain.alias("abstract_text"), "abstract_html", "fetched_at"
    )


def without_element(pages: DataFrame, name: str, page: str = "page") -> DataFrame:
    """The pages that lack the element: the other side of :func:`with_element`."""
    return pages.filter(F.col(page).isNotNull() & markup.first_element(F.col(page), name).isNull())


def dataset_rows(extracted: DataFrame) -> DataFrame:
    """Abstracts as rows of the data set: on one line, empty ones dropped."""
    line = text.one_line(F.col("abstract_text"))
    return keep_present(extracted, line, "Abstract", empty=False).select(
        "Abstract", text.clean_id(F.col("id")).alias("ID"), "query_folder", "fetched_at"
    )
