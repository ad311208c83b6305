"""CSV files bound by their own headers: a registered source for batches and streams.

Spark binds a CSV schema by position. Link files are written by different jobs, so their column order
differs and some begin with an unnamed index column. Here the task that reads a file opens it, reads that
file's header, and binds the columns of the schema by name, so nothing is read twice and no file's layout
passes through the driver, which only lists the folder as for any scan.

Values are split as text and typed in Arrow batches. What does not fit comes out as a row of its own with a reason:

=================  =====================================================================
``fields``         a row with more or fewer fields than its header
``type``           a value that is not of its column's type; the values that fitted stay
``no key column``  a file whose header lacks a required column; the line is its header
``empty file``     a file without a header
``unreadable``     a file that breaks off in its compression or its quoting; rows before stay
=================  =====================================================================

Small files share a task, up to ``pack_bytes``; a file is read by one task, since a quoted line break makes it
unsplittable, but row by row, so its size is no matter of memory. An empty field is null, a quoted empty one
is empty text, ``12.0`` is the whole number 12. Columns a file lacks are null, others are left out.

As a stream the source keeps the list of files taken in the folder ``log`` names, one numbered list to an offset:
a batch that runs again reads the files it read before. Each trigger takes all files that are new.
"""

from __future__ import annotations

import bz2
import csv
import fnmatch
import gzip
import io
import json
import uuid
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

FORMAT = "headed_csv"
REJECT_COLUMN, REASON_COLUMN, FILE_COLUMN = "_rejected_line", "_reject_reason", "_source_file"
EXTRA = (REJECT_COLUMN, REASON_COLUMN, FILE_COLUMN)
#: The reasons that speak of a whole file.
FILE_REASONS = ("no key column", "empty file", "unreadable")
BATCH_ROWS, BATCH_CHARACTERS, PACK_BYTES = 10_000, 1 << 23, 1 << 24

_WHOLE = r"^\s*(?P<n>[+-]?\d+)(?:\.0*)?\s*$"
_BOUNDS = {IntegerType: (-(1 << 31), (1 << 31) - 1), LongType: (-(1 << 63), (1 << 63) - 1)}
_KINDS = (StringType, IntegerType, LongType, DoubleType, FloatType, BooleanType, DateType)
_BROKEN = (csv.Error, EOFError, zlib.error, gzip.BadGzipFile)


def with_extra(schema: StructType) -> StructType:
    """The schema with the three text columns the source adds."""
    return StructType([*schema.fields, *[StructField(name, StringType()) for name in EXTRA]])


class Files(InputPartition):
    """The files of one task."""

    def __init__(self, names: list[str]):
        self.names = names


def _located(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and "://" not in path else path)


def _prefix(path: str) -> str:
    """What a file's own path lacks of the URI it was asked for by."""
    system, place = _located(path)
    return path[: -len(place)] if path.endswith(place) and len(path) > len(place) else ""


def list_files(path: str, glob: str) -> list[tuple[str, int, int]]:
    """(name, bytes, time of change) of the folder's files that match, by name; hidden ones are left out."""
    system, place = _located(path)
    at = system.get_file_info(place)
    if at.type == fs.FileType.File:
        return [(path, at.size, at.mtime_ns or 0)]
    found = system.get_file_info(fs.FileSelector(place, allow_not_found=True))
    prefix = _prefix(path)
    return sorted(
        (prefix + info.path, info.size, info.mtime_ns or 0)
        for info in found
        if info.is_file and info.base_name[0] not in "._" and fnmatch.fnmatchcase(info.base_name, glob)
    )


def packed(files: Sequence[tuple[str, int, int]], most: int) -> list[Files]:
    """The files in order, small ones together up to ``most`` bytes."""
    parts, held = [], most + 1
    for name, size, _ in files:
        if held + size > most:
            parts.append(Files([]))
            held = 0
        parts[-1].names.append(name)
        held += size
    return parts


def _lines(path: str) -> io.TextIOBase:
    system, place = _located(path)
    raw = io.BufferedReader(system.open_input_stream(place, compression=None))
    if place.endswith(".gz"):
        raw = gzip.GzipFile(fileobj=raw)
    elif place.endswith(".bz2"):
        raw = bz2.BZ2File(raw)
    return io.TextIOWrapper(raw, encoding="utf-8-sig", errors="replace", newline="")


def _one(value: str | None, kind: pa.DataType):
    try:
        return None if value is None else pa.scalar(value).cast(kind).as_py()
    except pa.ArrowInvalid:
        return None


def typed(texts: pa.Array, kind: DataType) -> pa.Array:
    """The texts as values of the type; null where one is none."""
    if isinstance(kind, StringType):
        return texts
    arrow = to_arrow_type(kind)
    if type(kind) in _BOUNDS:
        digits = pc.utf8_ltrim(pc.struct_field(pc.extract_regex(texts, _WHOLE), "n"), "+")
        try:
            whole = digits.cast(pa.int64())
        except pa.ArrowInvalid:  # some number beyond a long
            low, high = _BOUNDS[LongType]
            values = (None if d is None else int(d) for d in digits.to_pylist())
            whole = pa.array([v if v is not None and low <= v <= high else None for v in values], pa.int64())
        low, high = _BOUNDS[type(kind)]
        fits = pc.and_(pc.greater_equal(whole, low), pc.less_equal(whole, high))
        return pc.if_else(fits, whole, None).cast(arrow)
    trimmed = pc.utf8_trim_whitespace(texts)
    try:
        return trimmed.cast(arrow)
    except pa.ArrowInvalid:
        return pa.array([_one(v, arrow) for v in trimmed.to_pylist()], arrow)


def _as_line(fields: Sequence[str | None]) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(fields)
    return out.getvalue()


class _Reader:
    """What the batch and the stream reader share: which columns are bound, and how files are read."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.path = options["path"]
        self.glob = options.get("glob", "*.csv")
        self.log = options.get("log", "")
        self.required = json.loads(options.get("required", "[]"))
        self.layout = json.loads(options.get("layout", "null"))
        self.pack = int(options.get("pack_bytes", PACK_BYTES))
        self.fields = [field for field in schema.fields if field.name not in EXTRA]
        for field in self.fields:
            if type(field.dataType) not in _KINDS:
                raise TypeError(f"no reading of {field.dataType.simpleString()} from CSV here: {field.name}")
        self.arrow = pa.schema(
            [(field.name, to_arrow_type(field.dataType)) for field in self.fields] + [(n, pa.string()) for n in EXTRA]
        )

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(1 << 62)
        for name in partition.names:
            yield from self._file(name)

    def _file(self, name: str) -> Iterator[pa.RecordBatch]:
        places: list[int | None] = []
        width, good, bad, held = 0, [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if good:
                yield self._typed(good, places, name)
                good.clear()
            if bad:
                yield self._rejects(bad, name)
                bad.clear()

        header = None if self.layout is None else list(self.layout)
        known = header is not None
        with _lines(name) as lines:
            # The form that tells an empty field from a quoted empty one.
            reader = csv.reader(lines, quoting=csv.QUOTE_NOTNULL)
            try:
                for row in reader:
                    if not row:
                        continue
                    if not width:
                        header = [field or "" for field in row] if header is None else header
                        if not all(key in header for key in self.required):
                            yield self._rejects([(_as_line(row), "no key column")], name)
                            return
                        places = [header.index(f.name) if f.name in header else None for f in self.fields]
                        width = len(header)
                        continue
                    if len(row) == width:
                        good.append(row)
                    else:
                        bad.append((_as_line(row), "fields"))
                    held += sum(map(len, filter(None, row)))
                    if len(good) + len(bad) >= BATCH_ROWS or held >= BATCH_CHARACTERS:
                        yield from flush()
                        held = 0
            except _BROKEN as error:
                bad.append((str(error), "unreadable"))
        yield from flush()
        if not width and not known and not bad:
            yield self._rejects([(None, "empty file")], name)

    def _typed(self, rows: list[list[str | None]], places: list[int | None], name: str) -> pa.RecordBatch:
        count, columns, failed = len(rows), [], None
        for field, place in zip(self.fields, places, strict=True):
            if place is None:
                columns.append(pa.nulls(count, to_arrow_type(field.dataType)))
                continue
            texts = pa.array([row[place] for row in rows], pa.string())
            values = typed(texts, field.dataType)
            columns.append(values)
            lost = pc.and_(pc.is_valid(texts), pc.is_null(values))
            failed = lost if failed is None else pc.or_(failed, lost)
        lines, reasons = pa.nulls(count, pa.string()), pa.nulls(count, pa.string())
        if failed is not None and pc.any(failed).as_py():
            marks = failed.to_pylist()
            lines = pa.array([_as_line(row) if m else None for row, m in zip(rows, marks, strict=True)], pa.string())
            reasons = pc.if_else(failed, pa.scalar("type"), None)
        columns += [lines, reasons, pa.array([name] * count, pa.string())]
        return pa.RecordBatch.from_arrays(columns, schema=self.arrow)

    def _rejects(self, rows: list[tuple[str | None, str]], name: str) -> pa.RecordBatch:
        count = len(rows)
        columns = [pa.nulls(count, to_arrow_type(field.dataType)) for field in self.fields]
        columns += [pa.array(x, pa.string()) for x in zip(*rows, strict=True)] + [pa.array([name] * count, pa.string())]
        return pa.RecordBatch.from_arrays(columns, schema=self.arrow)


class HeadedReader(_Reader, DataSourceReader):
    def partitions(self) -> list[Files]:
        return packed(list_files(self.path, self.glob), self.pack) or [Files([])]


class HeadedStreamReader(_Reader, DataSourceStreamReader):
    """Offsets count the lists of files in the log; list n holds the files of the step to offset n."""

    def __init__(self, options: dict[str, str], schema: StructType):
        super().__init__(options, schema)
        if not self.log:
            raise ValueError("a stream of files needs the option log: a folder for the list of files taken")
        self._seen: set[str] | None = None
        self._taken = 0

    def _list(self, number: int) -> str:
        return f"{self.log.rstrip('/')}/{number:010d}.json"

    def _read_list(self, number: int) -> list[list]:
        system, place = _located(self._list(number))
        with system.open_input_stream(place) as file:
            return json.loads(file.read())

    def initialOffset(self) -> dict:
        return {"taken": 0}

    def latestOffset(self) -> dict:
        if self._seen is None:
            self._seen, self._taken = set(), 0
            for name, _, _ in list_files(self.log, "*.json"):
                self._taken = max(self._taken, int(name.rsplit("/", 1)[1].removesuffix(".json")))
            for number in range(1, self._taken + 1):
                self._seen.update(name for name, *_ in self._read_list(number))
        new = [file for file in list_files(self.path, self.glob) if file[0] not in self._seen]
        if new:
            system, place = _located(self._list(self._taken + 1))
            system.create_dir(place.rsplit("/", 1)[0], recursive=True)
            # Whole under a name of its own first: a list is there or is not.
            begun = f"{place}.{uuid.uuid4().hex}"
            with system.open_output_stream(begun) as file:
                file.write(json.dumps(new).encode())
            system.move(begun, place)
            self._taken += 1
            self._seen.update(name for name, *_ in new)
        return {"taken": self._taken}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        files = [tuple(f) for n in range(start["taken"] + 1, end["taken"] + 1) for f in self._read_list(n)]
        return packed(files, self.pack) or [Files([])]


class HeadedCsv(DataSource):
    """``spark.read.format("headed_csv")``; the schema is that of ``with_extra``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        raise ValueError("state the schema: files are bound to it by their headers")

    def reader(self, schema: StructType) -> DataSourceReader:
        return HeadedReader(dict(self.options), schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return HeadedStreamReader(dict(self.options), schema)


def _options(path: str, required: Sequence[str], glob: str, layout: Sequence[str] | None) -> dict[str, str]:
    options = {"path": path, "glob": glob, "required": json.dumps(list(required))}
    return options if layout is None else {**options, "layout": json.dumps(list(layout))}


def read_headed(
    spark: SparkSession,
    path: str,
    schema: StructType,
    required: Sequence[str] = (),
    glob: str = "*.csv",
    layout: Sequence[str] | None = None,
) -> DataFrame:
    """The rows of all files and their rejects; ``layout`` names the columns in place of the headers."""
    spark.dataSource.register(HeadedCsv)
    reader = spark.read.format(FORMAT).schema(with_extra(schema))
    return reader.options(**_options(path, required, glob, layout)).load()


def stream_headed(
    spark: SparkSession, path: str, schema: StructType, log: str, required: Sequence[str] = (), glob: str = "*.csv"
) -> DataFrame:
    """As ``read_headed``, of the files that land in a folder; ``log`` keeps the list of those taken."""
    spark.dataSource.register(HeadedCsv)
    reader = spark.readStream.format(FORMAT).schema(with_extra(schema))
    return reader.options(**_options(path, required, glob, None), log=log).load()
