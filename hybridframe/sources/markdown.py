"""Markdown files cut into records, one per section."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hybridframe.schema import ID

# Fixed values of the ingestion contract: what begins a section, and the characters of a chunk.
SEPARATOR = "# "
MAX_CHARS = 8000

OPTIONS = {"wholetext": True, "recursiveFileLookup": True, "pathGlobFilter": "*.md"}


def _files(raw: DataFrame) -> DataFrame:
    """``source_file, text``; a file that is not UTF-8 is left out."""
    path = F.regexp_replace(F.col("_metadata.file_path"), "^file:/*", "/")
    return raw.select(path.alias("source_file"), F.col("value").alias("text")).filter(F.is_valid_utf8("text"))


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """One markdown file, or all below a folder. Other files are not read."""
    return _files(spark.read.text(path, **OPTIONS))


def stream_markdown(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The same for files as they arrive."""
    return _files(spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path, **OPTIONS))


def sections(text: Column) -> Column:
    """Trimmed, non-blank sections of a text in order. The separator is literal text."""
    pieces = F.split(text, F.lit(rf"\Q{SEPARATOR}\E"))
    trimmed = F.transform(pieces, lambda piece: F.regexp_replace(piece, r"(?U)^\s+|\s+$", ""))
    return F.array_remove(trimmed, "")


def chunks(files: DataFrame, source: str = "source_file", text: str = "text", max_chars: int | None = MAX_CHARS) -> DataFrame:
    """``source_file, chunk_index, text``: sections in order, numbered from 0.

    A section of more than ``max_chars`` characters is divided into several chunks, so that all of its text is there.
    """
    parts = sections(F.col(text))
    if max_chars is not None:
        starts = lambda part: F.sequence(F.lit(1), F.char_length(part), F.lit(max_chars))
        parts = F.flatten(F.transform(parts, lambda part: F.transform(starts(part), lambda at: F.substring(part, at, F.lit(max_chars)))))
    return files.select(F.col(source).alias("source_file"), F.posexplode(parts).alias("chunk_index", "text"))


def chunk_records(cut: DataFrame) -> DataFrame:
    """Records of sections, identified by file and number."""
    return cut.select(
        F.concat_ws("_", "source_file", "chunk_index").alias(ID),
        F.col("text").alias("document"),
        F.lit(None).cast("array<float>").alias("embedding"),
        F.to_json(F.struct("source_file", "chunk_index")).alias("metadata"),
    )


def source_of(metadata: Column) -> Column:
    """The file that a record comes from."""
    return F.get_json_object(metadata, "$.source_file")
