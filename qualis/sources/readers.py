"""Sources: all-text scans, NULL normalisation, input gate, manifest scan.

Every column is read as text (types are findings, not load errors); the only
normalisation is ``''`` -> NULL (plus configurable NULL tokens per source for
formats whose reader used to treat ``NA`` and friends as missing).
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from qualis.session import cut, file_system
from qualis.sources import csv_splits as CSV
from qualis.sources import fixture as FX
from qualis.sources import names as NM


class DataLoadError(RuntimeError):
    """An expected input is missing (file-level, aborts the run)."""


def empty_to_null(df: DataFrame, null_tokens: tuple[str, ...] = ("",)) -> DataFrame:
    """IO3: '' (and configured tokens) -> NULL on every text column."""
    cols = []
    for f in df.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, StringType) and not f.name.startswith("_"):
            c = F.when(c.isin(*null_tokens), F.lit(None).cast("string")).otherwise(c).alias(f.name, metadata=f.metadata)
        cols.append(c)
    return df.select(*cols)


def all_text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


HEADER_BYTES = 1 << 16  # read at first; more as long as the header record goes on


def headers(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(file, columns array<string>): the header record of every text file under
    ``path``, quotes respected. Only the first bytes of a file are read where the
    store can be opened by byte range; else the first record of its first split."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    if _opens_ranges(path):
        return files.mapInArrow(_first_records(sep), "file string, columns array<string>")
    lines = spark.read.text(path, recursiveFileLookup=True).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_blk"), F.monotonically_increasing_id().alias("_mid"))
    first = lines.where("_blk = 0").groupBy("file").agg(F.min_by("value", "_mid").alias("value"))
    return first.select("file", split_record("value", sep).alias("columns"))


def split_record(col: str, sep: str = ",") -> Column:
    """The fields of one CSV record: a quoted field may hold the separator."""
    q = re.escape(sep)
    parts = F.regexp_extract_all(F.col(col), F.lit(f'(?:^|{q})("(?:[^"]|"")*"|[^{q}]*)'), F.lit(1))
    return F.transform(parts, lambda x: F.when(
        x.startswith('"'), F.replace(F.regexp_replace(x, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(x))


def _opens_ranges(path: str) -> bool:
    from pyarrow import fs
    try:
        fs.FileSystem.from_uri(_arrow_uri(path))
        return True
    except Exception:  # noqa: BLE001 - any store that pyarrow cannot open takes the scan
        return False


def _arrow_uri(path: str) -> str:
    return "file:///" + path[5:].lstrip("/") if path.startswith("file:") else path.replace("s3a://", "s3://", 1)


def _first_records(sep: str):
    def run(batches):
        import csv
        import io
        csv.field_size_limit(1 << 30)

        import pyarrow as pa
        from pyarrow import fs
        for b in batches:
            cols = []
            for name in b.column(0).to_pylist():
                store, at = fs.FileSystem.from_uri(_arrow_uri(unquote(name) if name.startswith("file:") else name))
                with store.open_input_stream(at) as f:
                    data, more = b"", HEADER_BYTES
                    while True:
                        got = f.read(more)
                        data, more = data + got, 2 * more
                        text = io.StringIO(data.decode("utf-8-sig", "replace"), newline="")
                        record = next(csv.reader(text, delimiter=sep), [])
                        if not got or text.read(1):  # the file or the record has ended
                            break
                cols.append(record)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cols, pa.list_(pa.string()))], ["file", "columns"])
    return run


def read_csv_text(spark: SparkSession, path: str, columns: list[str], multi_line: bool = True,
                  sep: str = ",") -> DataFrame:
    """IO1, IO5: header CSV, doubled-quote escaping, every column text, no NA tokens, and the
    dense position of each row in file order as ``_row_id``.

    Files are split, also with line breaks in quoted cells (``csv_splits``); without
    ``multi_line`` every line is a record, whatever its quotes. Columns are bound *by
    header name*: files are grouped by their header, every group is parsed under its own,
    and the groups are united by name. Columns that a file lacks are NULL, columns beyond
    ``columns`` are kept. Names are exact (``names``): ``Sale_ID`` is no ``sale_id``, and a
    repeated name is numbered, x and x.1."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in headers(spark, path, sep).collect():  # one row per file, as Spark's own file listing
        groups.setdefault(tuple(NM.repeats_numbered(r["columns"])), []).append(unquote(r["file"]))
    if not groups:
        raise DataLoadError(f"no file under {path}")
    heads = sorted(groups)
    own = list(dict.fromkeys(c for head in heads for c in head))
    name = dict(zip(own, NM.internal(own, columns)))
    options = {"sep": sep, "escape": '"', "emptyValue": "", "multiLine": "true",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}  # raw stays raw
    out = None
    for head, rows in zip(heads, CSV.records(spark, [groups[h] for h in heads], sep, multi_line)):
        text = F.when(F.col("text").endswith("\r"), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
        schema = ", ".join(f"`{i}` string" for i in range(len(head)))
        df = rows.select(F.from_csv(text, schema, options).alias("r"), "_row_id").select(*[
            F.col(f"r.`{i}`").alias(name[c], metadata={NM.KEY: c} if name[c] != c else {}) for i, c in enumerate(head)], "_row_id")
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    absent = [c for c in columns if c not in out.columns]
    out = out.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else out
    rest = [c for c in out.columns if c not in columns]
    return out.select(*columns, *["`" + c.replace("`", "``") + "`" for c in rest])


def with_text_positions(df: DataFrame, out: str = "_row_id") -> DataFrame:
    """IO5 for text formats: dense position in file order, without moving the data. Rows of
    ``read_csv_text`` have theirs from the scan already.

    A row's place in its split is its scan id minus the split's smallest one;
    one row per split is aggregated, ranked and joined back."""
    if "_row_id" in df.columns:
        return df.withColumnRenamed("_row_id", out)
    if "_mid" not in df.columns:
        df = df.select("*", F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.file_block_start").alias("_blk"), F.monotonically_increasing_id().alias("_mid"))
    splits = df.groupBy("_file", "_blk").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    files = splits.groupBy("_file").agg(F.sum("_n").alias("_fn"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = files.select("_file", F.coalesce(F.sum("_fn").over(before), F.lit(0)).alias("_fo"))
    inside = Window.partitionBy("_file").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.join(files, "_file").select(
        "_file", "_blk", (F.col("_fo") + F.coalesce(F.sum("_n").over(inside), F.lit(0)) - F.col("_m0")).alias("_off"))
    return df.join(splits, ["_file", "_blk"]).withColumn(out, F.col("_mid") + F.col("_off")) \
        .drop("_file", "_blk", "_mid", "_off")


def header_problems(spark: SparkSession, path: str, required: list[str], sep: str = ",") -> DataFrame:
    """P1/SCH_001 for many-file landings: (file, missing column) for every file
    whose own header lacks a required column. Empty = the gate passes."""
    req = F.array(*[F.lit(c) for c in required])
    return headers(spark, path, sep).select("file", F.explode(F.array_except(req, "columns")).alias("missing_column"))


def read_any_text(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """IO2: typed formats (parquet/orc/json) cast to text on read; a ``_row_id``
    that the table brings stays a number, else parquet rows get file positions."""
    df = spark.read.format(fmt).load(path)
    if "_row_id" not in df.columns and fmt == "parquet":
        df = with_file_positions(df)
    return df.select(*[F.col("`" + c.replace("`", "``") + "`").cast("long" if c == "_row_id" else "string").alias(c)
                       for c in df.columns])


MAX_FILES = 1_000_000  # files whose offsets are broadcast (a path and a number each)


def with_file_positions(df: DataFrame, out: str = "_row_id") -> DataFrame:
    """IO5 for parquet: dense position in (file path, row index) order.

    One row per file is counted; the offsets of up to ``MAX_FILES`` files (checked) are
    broadcast, whatever the session's own limit, so the data is neither sorted nor
    moved. Beyond that they are joined by file.
    """
    meta = df.select("*", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.row_index").alias("_ri"))
    per_file = cut(meta.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")))
    w = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_file.select("_file", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    if per_file.count() <= MAX_FILES:
        offsets = F.broadcast(offsets)
    return meta.join(offsets, "_file").withColumn(out, F.col("_off") + F.col("_ri")).drop("_file", "_ri", "_off")


def missing_inputs(spark: SparkSession, landing: str, expected: dict[str, str]) -> list[str]:
    """IO4: expected input names (files or table folders) that the landing lacks."""
    out = []
    for name in expected.values():
        fs, p = file_system(spark, f"{landing.rstrip('/')}/{name}")
        if not fs.exists(p):
            out.append(name)
    return sorted(out)


def assert_inputs_present(spark: SparkSession, landing: str, expected: dict[str, str]) -> None:
    """IO4 as a gate: one error that names every missing input."""
    gone = missing_inputs(spark, landing, expected)
    if gone:
        raise DataLoadError(f"the landing {landing} is incomplete, not found: {', '.join(gone)}")


MANIFEST_SCHEMA = ("seed long, generated_for string, scope_note string, total_injected_errors long, "
                   "errors array<struct<table:string,row_ref:string,error_class:string,"
                   "column:string,detail:string>>")


ERROR_SCHEMA = "table string, row_ref string, error_class string, column string, detail string"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """IO6: manifest -> one row per expected error.

    Accepts the nested single-document form (header + ``errors[]``, as small
    single-machine tools write it) and the scalable layout of
    ``sinks.write_manifest`` (a folder with ``errors/`` as JSON lines)."""
    fs, p = file_system(spark, f"{path.rstrip('/')}/errors")
    if fs.exists(p):
        return spark.read.schema(ERROR_SCHEMA).json(f"{path.rstrip('/')}/errors")
    m = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)
    return m.select(F.explode("errors").alias("e")).select("e.*")


def load_fixture(spark: SparkSession, sf_dir: str, clean: bool = False, extended: bool = False) -> dict[str, DataFrame]:
    """The dirty fixture tables as the engine sees them (text, '' -> NULL)."""
    return {t: empty_to_null(df) for t, df in FX.raw_tables(spark, sf_dir, clean, extended).items()}


def read_landing(spark: SparkSession, landing: str) -> dict[str, DataFrame]:
    """Tables previously written by ``sinks.write_tables`` (parquet, with _row_id)."""
    return {t: spark.read.parquet(f"{landing}/{t}") for t in ("sales", "customers", "products", "targets")}
