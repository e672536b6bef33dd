"""Landing files with drifting headers to staged rows.

Landings are CSV or Parquet with the publisher's headers; each file holds one
financial year of one trust type, both told by its name. All files are read in
one plan, so a landing of any number of files is one distributed scan.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide.functions import text
from ledgerwide.functions.numeric import truncate_to_integer
from ledgerwide.schemas import PROVIDER_HEADERS, RAW_HEADERS
from ledgerwide.sources.sinks import BYTE_ORDER_MARK

# The publisher's file naming.
FILE_PATTERN = "TAC_NHS_*"
EXCLUDED_WORD = "illustrative"

HEADER_READERS = 16  # landings whose headers are read at the same time


def is_data_file(name: str | Column) -> Column:
    """True for data files by name; the published format example is not one."""
    base = source_name(name)
    prefix = FILE_PATTERN.rstrip("*")
    return base.startswith(prefix) & ~F.lower(base).contains(EXCLUDED_WORD)


def discover_files(spark: SparkSession, folder: str) -> DataFrame:
    """Sorted paths of the data files in a folder; a large file may be a folder of parts.

    Only a landing's own name counts, not the folders above it. Contents are not read.
    """
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    )
    part = F.element_at(F.split("path", "/"), -1).startswith("part-")
    landed = F.when(part, F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.col("path"))
    return listing.select(landed.alias("path")).distinct().where(is_data_file("path")).orderBy("path")


def find_name(names: Iterable[str], target: str) -> str:
    """The name equal to ``target`` apart from case and surrounding blanks."""
    names = list(names)
    for name in names:
        if name.strip().lower() == target.strip().lower():
            return name
    raise ValueError(f"{target!r} not found; available: {names}")


def header_map(
    columns: Sequence[str], headers: Mapping[str, Sequence[str]], optional: Sequence[str] = ()
) -> dict[str, list[str]]:
    """Internal name -> columns carrying it, or ValueError naming every missing one."""
    found: dict[str, list[str]] = {}
    for name, spellings in headers.items():
        wanted = {s.strip().lower() for s in spellings}
        found[name] = [c for c in columns if c.strip().lower() in wanted]
    missing = [n for n, hits in found.items() if not hits and n not in optional]
    if missing:
        raise ValueError(f"missing columns {missing}; found: {list(columns)}")
    return found


def with_standard_headers(
    df: DataFrame, headers: Mapping[str, Sequence[str]], optional: Sequence[str] = ()
) -> list[Column]:
    """Select list giving each internal column; several spellings in one frame are coalesced."""
    found = header_map(df.columns, headers, optional)

    def pick(name: str) -> Column:
        hits = [F.col(f"`{c}`") for c in found[name]]
        return (F.coalesce(*hits) if hits else F.lit(None).cast("string")).alias(name)

    return [pick(name) for name in headers]


def clean_text(value: str | Column) -> Column:
    return F.trim(text.col(value).cast("string"))


def stage_rows(raw: DataFrame, source_file: str | Column = "source_file") -> DataFrame:
    """Raw statement rows to staged rows: current-year rows only, amounts as whole thousands.

    Rows without a name, code or amount are dropped before any text is made of
    them; an unreadable amount counts as 0.
    """
    source = text.col(source_file)
    rows = raw.select(*with_standard_headers(raw, RAW_HEADERS), source.alias("source_file"))
    rows = rows.na.drop(subset=["organisation_name", "sub_code", "total"])
    rows = rows.where(text.year_type("main_code") == "CY")
    return rows.select(
        clean_text("organisation_name").alias("organisation_name"),
        clean_text("worksheet_name").alias("worksheet_name"),
        F.col("table_id").try_cast("double").try_cast("smallint").alias("table_id"),
        clean_text("main_code").alias("main_code"),
        F.col("row_num").try_cast("double").try_cast("int").alias("row_num"),
        clean_text("sub_code").alias("sub_code"),
        truncate_to_integer("total").alias("total"),
        "source_file",
        text.trust_type_from_name("source_file").alias("trust_type"),
        text.financial_year_from_name("source_file").alias("financial_year"),
        F.lit("CY").alias("year_type"),
    )


def stage_providers(raw: DataFrame, source_file: str | Column = "source_file") -> DataFrame:
    """Raw provider rows to staged providers with a three-character code."""
    source = text.col(source_file)
    rows = raw.select(
        *with_standard_headers(raw, PROVIDER_HEADERS, optional=["region", "sector", "comments"]),
        source.alias("source_file"),
    )
    return rows.where(F.length(clean_text("org_code")) == 3).select(
        clean_text("organisation_name").alias("organisation_name"),
        clean_text("org_code").alias("org_code"),
        F.col("region").cast("string"),
        F.col("sector").cast("string"),
        F.col("comments").cast("string"),
        "source_file",
        text.trust_type_from_name("source_file").alias("trust_type"),
        text.financial_year_from_name("source_file").alias("financial_year"),
    )


def source_name(path: str | Column) -> Column:
    """Name of the landing file a row came from.

    A large file may be landed as a folder of parts; its rows then carry the
    folder's name (without the ``source_file=`` of a partitioned write).
    """
    parts = F.split(text.col(path), "/")
    name, parent = F.element_at(parts, -1), F.element_at(parts, -2)
    named = F.when(name.startswith("part-"), parent).otherwise(name)
    return F.url_decode(F.regexp_replace(named, "^source_file=", ""))


def part_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a landing: itself, or the parts of a folder in order of their names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.getFileStatus(target).isDirectory():
        return [path]
    parts = sorted(s.getPath().toString() for s in fs.listStatus(target) if s.isFile())
    visible = [p for p in parts if not p.rsplit("/", 1)[1].startswith(("_", "."))]
    if not visible:
        raise ValueError(f"no files in {path}")
    return visible


def csv_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of a CSV file, or of the first part of a folder of parts.

    Only the first line is read, on the driver, as planning reads a Parquet footer; files
    with a known compression are unpacked.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(part_files(spark, path)[0])
    raw = target.getFileSystem(conf).open(target)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
    stream = jvm.java.io.InputStreamReader(raw if codec is None else codec.createInputStream(raw), "UTF-8")
    reader = jvm.java.io.BufferedReader(stream)
    try:
        line = reader.readLine()
    finally:
        reader.close()
    if line is None:
        raise ValueError(f"empty file {path}")
    return tuple(next(csv.reader([line.lstrip(BYTE_ORDER_MARK)])))


#: Name and type of every column; CSV has no types.
Header = tuple[tuple[str, str], ...]


def parquet_header(spark: SparkSession, path: str) -> Header:
    """Columns of one Parquet file as its own footer tells them; no data is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    parquet = jvm.org.apache.parquet.hadoop
    source = parquet.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
    reader = parquet.ParquetFileReader.open(source)
    try:
        schema = reader.getFooter().getFileMetaData().getSchema()
        fields = [schema.getFields().get(i) for i in range(schema.getFieldCount())]
        return tuple((f.getName(), f.toString()) for f in fields)
    finally:
        reader.close()


def headers_of(spark: SparkSession, paths: Sequence[str], file_format: str) -> dict[Header, list[str]]:
    """Landing files grouped by header, read side by side.

    Every part of a Parquet landing counts by its own footer, since parts with other headers
    would read as nulls beside the first. Parts of a CSV landing carry the first part's header;
    another one raises when it is read.
    """
    if file_format == "csv":
        files = list(paths)

        def header(path: str) -> Header:
            return tuple((name, "string") for name in csv_header(spark, path))
    elif file_format == "parquet":
        with ThreadPoolExecutor(HEADER_READERS) as pool:
            files = [f for parts in pool.map(lambda p: part_files(spark, p), paths) for f in parts]

        def header(path: str) -> Header:
            return parquet_header(spark, path)
    else:
        files = list(paths)

        def header(path: str) -> Header:
            return tuple(spark.read.format(file_format).load(path).dtypes)

    with ThreadPoolExecutor(HEADER_READERS) as pool:
        found = list(pool.map(header, files))
    groups: dict[Header, list[str]] = defaultdict(list)
    for columns, path in zip(found, files):
        groups[columns].append(path)
    return groups


def read_groups(
    spark: SparkSession,
    paths: Sequence[str],
    file_format: str = "csv",
    headers: Mapping[str, Sequence[str]] | None = None,
    optional: Sequence[str] = (),
) -> list[DataFrame]:
    """One frame for every header among the files, with ``source_file`` telling each row's file.

    With ``headers`` every one must carry the required columns; the error names a file that
    does not.
    """
    if not paths:
        raise ValueError("no landing files")
    source = source_name("_metadata.file_path").alias("source_file")
    groups = []
    for header, members in headers_of(spark, paths, file_format).items():
        names = [name for name, _ in header if name != "source_file"]
        if headers is not None:
            try:
                header_map(names, headers, optional)
            except ValueError as error:
                raise ValueError(f"{members[0]}: {error}") from None
        if file_format == "csv":
            schema = ", ".join(f"`{c}` string" for c in names)
            reader = spark.read.schema(schema).options(header=True, escape='"', enforceSchema=False)
            scan = reader.csv(members)
        else:
            scan = spark.read.format(file_format).load(members).drop("source_file")
        groups.append(scan.select("*", source))
    return groups


def read_files(
    spark: SparkSession,
    paths: Sequence[str],
    file_format: str = "csv",
    headers: Mapping[str, Sequence[str]] | None = None,
    optional: Sequence[str] = (),
) -> DataFrame:
    """The frames of ``read_groups`` united by column name, never by position."""
    groups = read_groups(spark, paths, file_format, headers, optional)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)


PROVIDER_OPTIONAL = ["region", "sector", "comments"]


def read_statement_rows(spark: SparkSession, paths: Sequence[str], file_format: str = "csv") -> DataFrame:
    """Staged rows of all files; every header among them is mapped by itself, with its own types."""
    groups = read_groups(spark, paths, file_format, RAW_HEADERS)
    return reduce(DataFrame.unionByName, map(stage_rows, groups))


def read_provider_list(spark: SparkSession, paths: Sequence[str], file_format: str = "csv") -> DataFrame:
    groups = read_groups(spark, paths, file_format, PROVIDER_HEADERS, PROVIDER_OPTIONAL)
    return reduce(DataFrame.unionByName, map(stage_providers, groups))
