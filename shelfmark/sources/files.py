"""Landing folders and the files in them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PATTERNS = {"yyyy-MM-dd": "%Y-%m-%d", "yyyyMMdd": "%Y%m%d", "yyMMdd": "%y%m%d"}


def expand_landing_dirs(root: str, pattern: str, last_date: date, end_date: date) -> list[str]:
    """Date-named folders strictly after ``last_date``, up to and including ``end_date`` (A1)."""
    days = (end_date - last_date).days
    return [f"{root.rstrip('/')}/{(last_date + timedelta(i)).strftime(PATTERNS[pattern])}" for i in range(1, days + 1)]


def _dir_date(path: str) -> date:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    for form in PATTERNS.values():
        try:
            return datetime.strptime(name, form).date()
        except ValueError:
            continue
    raise ValueError(f"no date in {path!r}")


def pick_dirs(dirs: list[str], pull_type: str) -> list[str]:
    """All folders by date, or only the newest for a full pull (A2)."""
    ordered = sorted(dirs, key=_dir_date)
    if pull_type == "full":
        return ordered[-1:]
    if pull_type == "incremental":
        return ordered
    raise ValueError(f"unknown pull type {pull_type!r}")


def strip_quoted(column: Column, sep: str) -> Column:
    """A line without the quotes (single or double) that touch separators, one each, or its ends; inner quotes stay."""
    s, quote = re.escape(sep), "['\"]"
    new = sep.replace("\\", "\\\\").replace("$", "\\$")
    for touching in (f"{quote}{s}{quote}", f"{quote}{s}", f"{s}{quote}"):
        column = F.regexp_replace(column, touching, new)
    return F.regexp_replace(column, f"^{quote}+|{quote}+$", "")


def parse_stripped(lines: DataFrame, columns: list[str], sep: str, value: str = "value") -> DataFrame:
    """Lines with stripped quotes, split: missing fields NULL, extra ones dropped, '' NULL, empty lines dropped (A4)."""
    parts = F.split(strip_quoted(F.col(value), sep), re.escape(sep), -1)
    kept = [c for c in lines.columns if c != value]
    return (
        lines.where(F.length(F.trim(value)) > 0)
        .withColumn("__parts", parts)
        .select(*kept, *[F.nullif(F.get("__parts", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)])
    )


def read_delimited(
    spark: SparkSession, paths: str | list[str], sep: str = ",", header: bool = True, encoding: str = "UTF-8", mode: str = "standard",
    columns: list[str] | None = None,
) -> DataFrame:
    """Text files (also ``.gz``) with all columns as strings and '' as NULL (A3, A4).

    The header of one file names the columns. ``standard`` knows quotes and backslash escapes; ``strip_quotes`` splits.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if mode == "standard":
        df = spark.read.csv(paths, sep=sep, header=header, quote='"', escape="\\", encoding=encoding, mode="PERMISSIVE", nullValue="")
        return df.toDF(*columns) if columns else df
    if mode != "strip_quotes":
        raise ValueError(f"unknown mode {mode!r}")
    lines = spark.read.option("encoding", encoding).text(paths)
    if columns is None:
        first = lines.select(strip_quoted(F.col("value"), sep)).first()
        columns = first[0].split(sep) if header and first else [f"_c{i}" for i in range(len(first[0].split(sep)))] if first else []
    if header:
        lines = lines.where(strip_quoted(F.col("value"), sep) != sep.join(columns))
    return parse_stripped(lines, columns, sep)


def read_zipped_delimited(spark: SparkSession, paths: str | list[str], sep: str = ",", header: bool = True) -> DataFrame:
    """Members csv, txt and dat of zip files, UTF-8, each with its own header (A5). A member's lines are read by a task."""

    def lines(batches: Iterator) -> Iterator:
        import io
        import zipfile
        from itertools import islice

        import pandas as pd

        for batch in batches:
            for path, content in zip(batch.path, batch.content, strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in sorted(z.namelist()):
                        if name.lower().endswith((".csv", ".txt", ".dat")):
                            with io.TextIOWrapper(z.open(name), "utf-8") as f:
                                first = f.readline().rstrip("\r\n") if header else None
                                while rows := [x.rstrip("\r\n") for x in islice(f, 50_000)]:
                                    yield pd.DataFrame({"file": f"{path}!{name}", "head": first, "value": rows}, dtype=object)

    raw = spark.read.format("binaryFile").load(paths if isinstance(paths, list) else [paths]).select("path", "content")
    found = raw.mapInPandas(lines, "file string, head string, value string")
    first = found.select("head", "value").first()
    if first is None:
        return spark.createDataFrame([], "file string")
    names = strip_names(first["head"] if header else first["value"], sep, header)
    return parse_stripped(found.select("file", "value"), names, sep)


def strip_names(line: str, sep: str, header: bool) -> list[str]:
    parts = [p.strip().strip('"') for p in line.split(sep)]
    return [re.sub(r"[^A-Za-z0-9_]", "_", p) for p in parts] if header else [f"_c{i}" for i in range(len(parts))]


def read_parquet_dirs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parquet below a list of prefixes (A6); columns that some files lack are NULL there."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


# Date forms in paths, in order of trial.
_PATH_DATES = ((r"\d{14}", "yyyyMMddHHmmss"), (r"\d{12}", "yyyyMMddHHmm"), (r"\d{8}", "yyyyMMdd"), (r"\d{4}-\d{2}-\d{2}", "yyyy-MM-dd"))


def path_timestamp(path: Column) -> Column:
    """The load time in a path: the first form that is found and parses (A8). Digits that are no date hide none after them."""

    def parsed(pattern: str, form: str) -> Column:
        found = F.regexp_extract_all(path, F.lit(rf"(?<!\d)({pattern})(?!\d)"), F.lit(1))
        times = F.transform(found, lambda x: F.try_to_timestamp(x, F.lit(form)))
        return F.try_element_at(F.filter(times, lambda t: t.isNotNull()), F.lit(1))

    return F.coalesce(*[parsed(*p) for p in _PATH_DATES])


def below_root(path: Column, root: str) -> Column:
    """A path from behind ``root``; NULL where ``root`` is no part of it."""
    plain = re.sub(r"^[A-Za-z0-9+.-]+:(//[^/]*)?", "", root).rstrip("/")
    at = F.instr(path, plain)
    return F.when(at > 0, F.substr(path, at + len(plain)))


def with_audit_column(df: DataFrame, name: str, now: datetime | None = None, path: Column | None = None, root: str | None = None) -> DataFrame:
    """``name``: the load time in each row's file path, or ``now`` (A8, A9). Below ``root`` it is looked for first, since the
    folder of all loads may have digits of its own."""
    path = path if path is not None else F.col("_metadata.file_path")
    tries = [*([path_timestamp(below_root(path, root))] if root else []), path_timestamp(path)]
    return df.withColumn(name, F.coalesce(*tries, F.lit(now) if now else F.current_timestamp()))
