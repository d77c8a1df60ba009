"""Files around the tables: text lines, code lists, prompts, CSV, JSON metadata, models, logs."""

from __future__ import annotations

import json
import logging
import sys

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with something on them, trimmed."""
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value <> ''")


def codes(spark: SparkSession, path: str) -> DataFrame:
    """Lines as they are, blank ones too."""
    return spark.read.text(path).select("value")


def query_lines(path: str) -> list[str]:
    """Search expressions of a small local file, a line each, blank ones left out."""
    with open(path, encoding="utf-8") as f:
        return [x.strip() for x in f if x.strip()]


def code_list(path: str) -> list[str]:
    """Codes of a small local file, a line each, just as they are."""
    with open(path, encoding="utf-8") as f:
        return f.read().splitlines()


def place(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI (``file://``, ``hdfs://``, ``s3://``), and the path in it."""
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def read_text(path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    fs, at = place(path)
    if fs.get_file_info(at).type != pafs.FileType.File:
        return None
    with fs.open_input_stream(at) as f:
        return f.read().decode()


def write_text(path: str, text: str) -> None:
    """Written beside and moved, so a reader never sees half a file."""
    fs, at = place(path)
    fs.create_dir(at.rpartition("/")[0] or ".", recursive=True)
    with fs.open_output_stream(f"{at}.new") as f:
        f.write(text.encode())
    fs.move(f"{at}.new", at)


def names_in(folder: str) -> list[str]:
    fs, at = place(folder)
    found = fs.get_file_info(pafs.FileSelector(at, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == pafs.FileType.File)


def prompt(path: str) -> str:
    """A prompt file, white space around it left out."""
    text = read_text(path)
    if text is None:
        raise FileNotFoundError(path)
    return text.strip()


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, multiLine=True, escape='"')


def header(spark: SparkSession, path: str) -> str:
    """A schema of text columns with the names of a CSV file's first line."""
    return ", ".join(f"`{c}` string" for c in spark.read.csv(path, header=True, escape='"').columns)


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with header; one file only where people are to read it."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").csv(path, header=True, escape='"')


def read_json(path: str) -> dict:
    return json.loads(read_text(path))


def write_json(path: str, value: dict) -> None:
    write_text(path, json.dumps(value, indent=2))


def save_threshold(spark: SparkSession, path: str, value: float) -> None:
    spark.createDataFrame([(value,)], "threshold double").write.mode("overwrite").parquet(path)


def load_threshold(spark: SparkSession, path: str) -> float:
    return spark.read.parquet(path).first()["threshold"]


def tee(path: str, name: str = "curatrix") -> logging.Logger:
    """A logger that writes to the console and to a file."""
    logger = logging.getLogger(name)
    logger.setLevel(logging.INFO)
    for handler in (logging.StreamHandler(sys.stdout), logging.FileHandler(path)):
        handler.setFormatter(logging.Formatter("%(asctime)s %(message)s"))
        logger.addHandler(handler)
    return logger
