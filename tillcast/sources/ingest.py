"""Checks of Parquet files one by one, from their footers and without merging schemas."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

FILE_SCHEMA = (
    "file string, bytes long, rows long, columns array<struct<name:string,type:string>>, "
    "issues array<struct<column:string,issue:string,detail:string>>"
)


def _uri(path: str) -> str:
    """A path as pyarrow takes it (Spark writes local ones as ``file:/…``)."""
    return path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def _opens(path: str) -> bool:
    """Whether pyarrow knows the store of ``path``; others are read through Spark."""
    try:
        pafs.FileSystem.from_uri(_uri(path))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def _is_negative(file: pq.ParquetFile, column: str) -> bool:
    """Whether a numeric column has a value below 0: by row-group statistics, by its values where there are none."""
    at = file.schema_arrow.get_field_index(column)
    kind = file.schema_arrow.field(at).type
    if not (pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_decimal(kind)):
        return False
    places = {file.schema.column(k).path: k for k in range(len(file.schema))}
    for group in range(file.metadata.num_row_groups):
        found = file.metadata.row_group(group).column(places[column]).statistics
        if found is not None and found.has_min_max:
            if found.min < 0:
                return True
            continue
        for batch in file.iter_batches(row_groups=[group], columns=[column]):
            values = batch.column(0).drop_null().to_pandas()
            if (values < 0).any():
                return True
    return False


def _spark_type(kind: pa.DataType) -> str:
    try:
        return from_arrow_type(kind).simpleString()
    except Exception:  # a type without a Spark counterpart is reported by its own name
        return str(kind)


def check_file(source, name: str, size: int, expected: Mapping[str, Sequence[str]], not_negative: Sequence[str]) -> dict:
    """One row of ``FILE_SCHEMA`` for a file; whatever is wrong with it becomes an issue."""
    out = {"file": name, "bytes": size, "rows": None, "columns": [], "issues": []}
    add = lambda column, issue, detail=None: out["issues"].append({"column": column, "issue": issue, "detail": detail})
    try:
        with pq.ParquetFile(source) as file:
            out["rows"] = file.metadata.num_rows
            types = {f.name: _spark_type(f.type) for f in file.schema_arrow}
            out["columns"] = [{"name": n, "type": t} for n, t in types.items()]
            folder_keys = {part.split("=", 1)[0] for part in name.split("/")[:-1] if "=" in part}
            if not out["rows"]:
                add(None, "empty")
            for column, wanted in expected.items():
                if column not in types:
                    if column not in folder_keys:
                        add(column, "missing")
                elif wanted and types[column] not in wanted:
                    add(column, "type", f"{types[column]}, expected {' or '.join(wanted)}")
            for column in not_negative:
                if column in types and _is_negative(file, column):
                    add(column, "negative")
    except (pa.ArrowException, OSError, ValueError, KeyError) as error:
        add(None, "unreadable", f"{type(error).__name__}: {error}"[:200])
    return out


def file_report(spark: SparkSession, path: str, expected: Mapping[str, str | Sequence[str] | None],
                not_negative: Sequence[str] = (), tasks: int = 200) -> DataFrame:
    """One row per Parquet file under ``path`` with its rows, columns and issues.

    ``expected`` maps each required column to its type, several accepted types,
    or None for any.  Spark lists the files; their footers are read in ``tasks``
    tasks, so a file with another schema, without rows or that cannot be read
    is a row with issues (``missing``, ``type``, ``empty``, ``negative``,
    ``unreadable``) and stops nothing.  Row counts and negative values come
    from the footers; a column's values are read only where a row group has no
    statistics.  A required column that holds only NULLs is not missing, one
    that an empty file lacks is.  Stores that only Spark reaches are read whole
    through Spark.  (Spark does not list files of zero bytes.)
    """
    wanted = {c: ([t] if isinstance(t, str) else list(t or ())) for c, t in expected.items()}
    negative = list(not_negative)
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path))

    def rows(found: list[dict]) -> pd.DataFrame:
        return pd.DataFrame(found, columns=["file", "bytes", "rows", "columns", "issues"]).astype({"rows": "Int64"})

    def by_path(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for name, size in zip(frame["path"], frame["length"]):
                try:
                    store, inner = pafs.FileSystem.from_uri(_uri(name))
                    with store.open_input_file(inner) as source:
                        found.append(check_file(source, name, size, wanted, negative))
                except OSError as error:
                    issue = {"column": None, "issue": "unreadable", "detail": f"{type(error).__name__}: {error}"[:200]}
                    found.append({"file": name, "bytes": size, "rows": None, "columns": [], "issues": [issue]})
            yield rows(found)

    def by_content(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield rows([check_file(pa.BufferReader(bytes(c)), n, s, wanted, negative)
                        for n, s, c in zip(frame["path"], frame["length"], frame["content"])])

    if _opens(path):
        return listed.select("path", "length").repartition(tasks, "path").mapInPandas(by_path, FILE_SCHEMA)
    return listed.select("path", "length", "content").mapInPandas(by_content, FILE_SCHEMA)


def issue_rows(report: DataFrame) -> DataFrame:
    """One row per file and issue: ``file, column, issue, detail``."""
    return report.select("file", F.inline("issues"))


def dataset_files(report: DataFrame, root: str) -> DataFrame:
    """``dataset, files, rows, bytes, column_names`` for each folder right under ``root``."""
    inner = F.regexp_replace("file", "^file:/+", "/")
    head = "/" + root.removeprefix("file:").strip("/") + "/" if root.startswith(("/", "file:")) else root.rstrip("/") + "/"
    name = F.element_at(F.split(F.substr(inner, F.lit(len(head) + 1)), "/"), 1)
    names = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.transform("columns", lambda c: c["name"])))))
    return report.groupBy(name.alias("dataset")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), names.alias("column_names"))
