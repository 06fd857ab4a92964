"""File sources and sinks."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticeworks import schemas
from noticeworks.functions.json_text import parse
from noticeworks.sources.listing import Listing
from noticeworks.sources.tables import small_table


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header. Large files are split; ``multi_line=True`` reads whole files per task,
    which quoted line breaks need."""
    return spark.read.csv(path, schema=schema, header=True, escape='"', multiLine=multi_line)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def category_pairs(spark: SparkSession, mapping: dict[str, list[str]]) -> DataFrame:
    """(category, prefix) rows of a mapping held in the program."""
    pairs = [(category, prefix) for category, prefixes in mapping.items() for prefix in prefixes]
    return small_table(
        spark, category=[c for c, _ in pairs], prefix=[p for _, p in pairs]
    )


def read_category_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(category, prefix) rows of a JSON file ``{category: [prefix, ...]}``."""
    document = spark.read.text(path, wholetext=True)
    return document.select(
        F.explode(parse(F.col("value"), schemas.CATEGORY_MAP)).alias("category", "prefixes")
    ).select("category", F.explode("prefixes").alias("prefix"))


def read_model_criteria(spark: SparkSession, path: str) -> DataFrame:
    """One row per entry of a model-criteria document, in document order."""
    return model_criteria(spark.read.text(path, wholetext=True), "value")


def model_criteria(documents: DataFrame, column: str) -> DataFrame:
    """(pos, key, id, text, groups) of model-criteria documents held in a text column."""
    return (
        documents.select(parse(F.col(column), schemas.MODEL_CRITERIA).alias("_doc"))
        .select(F.posexplode("_doc.criteria").alias("pos", "key", "_entry"))
        .select(
            "pos",
            "key",
            F.col("_entry.id").alias("id"),
            F.col("_entry.text").alias("text"),
            F.col("_entry.product_group_subjects.product_group_id").alias("groups"),
        )
    )


def read_attachments(spark: SparkSession, root: str, with_content: bool = False) -> DataFrame:
    """Files below ``root/<document>/``, empty ones too; the bytes are read only if asked for."""
    spark.dataSource.register(Listing)
    listed = spark.read.format(Listing.name()).load(root)
    parts = F.split("path", "/")
    columns = [
        F.element_at(parts, -2).alias("documentId"),
        F.element_at(parts, -1).alias("name"),
        "length",
        "modificationTime",
    ]
    if not with_content:
        return listed.select(*columns)
    # The file source, which splits the reading, leaves out files without content.
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    filled = files.select(*columns, "content")
    return filled.unionByName(listed.where("length = 0").select(*columns, F.lit(b"").alias("content")))


def natural(path: str) -> list:
    """Sorts paths with numbers by value: ``page_2`` before ``page_10``."""
    return [(part.isdigit(), int(part) if part.isdigit() else 0, part) for part in re.split(r"([0-9]+)", path)]


def read_list_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Notices of landed result pages, with their arrival order.

    ``_page`` is the rank of the file among all, by path with numbers by value; ``_line`` the place of the page
    within its file (start of the split, then reading order), ``_pos`` that of the notice within the page. The files
    are ranked once, from the list that the scan has anyway, and joined to pages, before these become notices.
    """
    pages = spark.read.schema(schemas.LIST_PAGE).json(path, multiLine=multi_line)
    # Local files have one slash in one of the two lists and three in the other.
    ordered = sorted((re.sub("^file:/+", "file:/", x) for x in pages.inputFiles()), key=natural)
    ranks = small_table(spark, _file=pa.array(ordered, pa.string()), _page=pa.array(range(len(ordered)), pa.int64()))
    line = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return (
        pages.select(F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("_file"), line.alias("_line"), "total", "items")
        .join(ranks, "_file")
        .select("_page", "_line", "total", F.posexplode("items").alias("_pos", "_item"))
        .select("_page", "_line", "_pos", "total", "_item.*")
    )
