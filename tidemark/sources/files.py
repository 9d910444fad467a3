"""Files: which are indexed, how their text is extracted, and how listings become items."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import path_id
from tidemark.functions.text import extension, file_name, folder, strip_markup
from tidemark.operators.changes import incremental

PLAIN = (".txt", ".md", ".csv", ".log", ".json", ".xml")
MARKUP = (".html", ".htm")
OFFICE = (".docx", ".pptx", ".xlsx")
MAX_BYTES = 64 << 20


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """path, modificationTime, length and content of all files below a root."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)


def indexable(path: Column, extensions: tuple[str, ...] | None = None) -> Column:
    """Not hidden or temporary, and of a wanted extension (by default, one that text comes out of)."""
    name = file_name(path)
    ok = ~name.rlike(r"^[._]") & ~F.lower(name).endswith(".tmp")
    return ok & extension(path).isin(*(extensions or PLAIN + MARKUP + OFFICE))


def gathered(listing: DataFrame, **resume) -> DataFrame:
    """Indexable files of a listing (path, modified, is_directory) after a marker, in its order."""
    return incremental(listing.where(~F.col("is_directory") & indexable(F.col("path"))), "modified", "path", **resume)


def office_text(content: bytes) -> str:
    """Text of a zipped XML document: paragraphs, slides or shared strings, a line each."""
    out = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = [n for n in z.namelist() if re.fullmatch(r"word/document\.xml|ppt/slides/slide\d+\.xml|xl/sharedStrings\.xml", n)]
        for name in sorted(names, key=lambda n: [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", n)]):
            for block in ElementTree.fromstring(z.read(name)).iter():
                if block.tag.rsplit("}", 1)[-1] in ("p", "si"):
                    line = "".join(t.text or "" for t in block.iter() if t.tag.rsplit("}", 1)[-1] == "t")
                    if line:
                        out.append(line)
    return "\n".join(out)


@F.pandas_udf(T.StringType())
def _office(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def one(x: bytes | None) -> str | None:
        try:
            return office_text(x) if x else None
        except (zipfile.BadZipFile, ElementTree.ParseError, KeyError):
            return None

    for s in batches:
        yield s.map(one)


def extracted(files: DataFrame, most: int = MAX_BYTES) -> DataFrame:
    """Adds text and status: extracted, empty, too large, unsupported or failed."""
    kind, big = extension(F.col("path")), F.col("length") > most
    raw = F.col("content").cast("string")
    text = F.when(kind.isin(*PLAIN), raw).when(kind.isin(*MARKUP), strip_markup(raw)).when(kind.isin(*OFFICE), _office(F.when(kind.isin(*OFFICE), F.col("content"))))
    d = files.withColumn("text", F.when(~big, text))
    status = F.when(big, "too large").when(~kind.isin(*PLAIN, *MARKUP, *OFFICE), "unsupported").when(F.col("text").isNull(), "failed").when(F.trim("text") == "", "empty").otherwise("extracted")
    return d.withColumn("status", status)


def file_items(files: DataFrame) -> DataFrame:
    """Items of extracted files."""
    p = F.col("path")
    return files.select(path_id(p).alias("item_id"), F.lit("file").alias("item_type"), file_name(p).alias("title"), extension(p).alias("extension"), folder(p).alias("folder"), F.col("text").alias("content"), F.col("modificationTime").alias("last_modified"))


def truncated(items: DataFrame, most: int, order: list[str]) -> tuple[DataFrame, bool]:
    """The first most items in order, and whether there were more: such a run hasn't seen all."""
    return items.orderBy(*order).limit(most), items.limit(most + 1).count() > most
