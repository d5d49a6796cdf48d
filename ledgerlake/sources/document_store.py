"""The customer store as a Spark data source: documents in JSON files.

    document_store.register(spark)
    spark.read.format("customer_documents").schema(USERS).load(path)

One document per line, in the files of a folder (any file system pyarrow names by
its URI).  A file is planned in byte ranges of about ``rangeBytes``; a range
belongs to the task that holds the start of its lines.  Comparisons of a
top-level text, number or boolean field with a value, IN lists and null tests are
evaluated beside the store, on the parsed columns, before rows go to Spark; other
filters stay with Spark.  Fields the schema does not name are not read.

Filters reach a Python source only if ``spark.sql.python.filterPushdown.enabled``
is set, which ``register`` does.  Rows that are no JSON object fail the scan.
"""

from __future__ import annotations

import io
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.json as pajson
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual,
                                    In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, NumericType, StringType, StructType

# The source travels with the plan, so executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "customer_documents"
RANGE_BYTES = 64 << 20
_COMPARES = {EqualTo: pc.equal, GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal,
             LessThan: pc.less, LessThanOrEqual: pc.less_equal}


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    end: int


def ranges(files: Iterable[tuple[str, int]], size: int) -> list[ByteRange]:
    """Byte ranges of about ``size`` that cover the files, (path, bytes) each."""
    return [ByteRange(path, at, min(at + size, length))
            for path, length in files for at in range(0, length, size)]


def lines_of(stream: pa.NativeFile, start: int, end: int, at_once: int = 8 << 20) -> Iterator[bytes]:
    """The whole lines that begin in [start, end), some megabytes at a time."""
    stream.seek(max(0, start - 1))
    if start:       # the line that begins before the range is another task's
        while (c := stream.read(1 << 16)):
            if (cut := c.find(b"\n")) >= 0:
                stream.seek(stream.tell() - len(c) + cut + 1)
                break
    at = stream.tell()
    while at < end:
        part = stream.read(min(at_once, end - at))
        if not part:
            return
        while not part.endswith(b"\n"):      # the last line may reach over the range
            more = stream.read(1 << 16)
            cut = more.find(b"\n") + 1
            part += more[:cut] if cut else more
            if cut:
                stream.seek(stream.tell() - len(more) + cut)
            if cut or not more:
                break
        at = stream.tell()
        yield part


class DocumentReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.path = schema, options["path"]
        self.size = int(options.get("rangebytes", RANGE_BYTES))
        self.kept: list[Filter] = []

    def _evaluates(self, f: Filter) -> bool:
        f = f.child if isinstance(f, Not) else f
        if not isinstance(f, (*_COMPARES, In, IsNull, IsNotNull)) or len(f.attribute) != 1:
            return False
        kinds = {x.name: x.dataType for x in self.schema.fields}
        kind = kinds.get(f.attribute[0])
        return isinstance(f, (IsNull, IsNotNull)) and kind is not None or isinstance(
            kind, (StringType, NumericType, BooleanType))

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if self._evaluates(f):
                self.kept.append(f)
            else:
                yield f

    def partitions(self) -> list[ByteRange]:
        fs, root = pafs.FileSystem.from_uri(self.path)
        info = fs.get_file_info(root)
        found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(root, recursive=True))
        files = [(f.path, f.size) for f in found
                 if f.is_file and f.size and not f.base_name.startswith(("_", "."))]
        return ranges(sorted(files), self.size) or [ByteRange("", 0, 0)]

    def _holds(self, table: pa.Table, f: Filter) -> pa.ChunkedArray:
        """The filter on the columns, null where SQL says null."""
        if isinstance(f, Not):
            return pc.invert(self._holds(table, f.child))
        col = table[f.attribute[0]]
        if isinstance(f, IsNull):
            return pc.is_null(col)
        if isinstance(f, IsNotNull):
            return pc.is_valid(col)
        if isinstance(f, In):
            among = pa.array([v for v in f.value if v is not None], col.type)
            found = pc.is_in(col, value_set=among)
            return pc.if_else(pc.is_valid(col), found, pa.scalar(None, pa.bool_()))
        return _COMPARES[type(f)](col, pa.scalar(f.value, col.type))

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        wanted = to_arrow_schema(self.schema)
        if not partition.path:
            return
        fs, _ = pafs.FileSystem.from_uri(self.path)
        how = pajson.ParseOptions(explicit_schema=wanted, unexpected_field_behavior="ignore")
        with fs.open_input_file(partition.path) as stream:
            for part in lines_of(stream, partition.start, partition.end):
                if not part.strip():
                    continue
                # a block takes the longest line
                block = pajson.ReadOptions(use_threads=False, block_size=len(part) + 1)
                table = pajson.read_json(io.BytesIO(part), block, how)
                for f in self.kept:
                    table = table.filter(self._holds(table, f))
                yield from table.select(wanted.names).cast(wanted).to_batches()


class CustomerDocuments(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        raise ValueError("documents are read with a declared schema")

    def reader(self, schema: StructType) -> DocumentReader:
        return DocumentReader(schema, {k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CustomerDocuments)


def read(spark: SparkSession, path: str, schema: StructType, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The documents under ``path`` with the declared fields."""
    register(spark)
    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    uri = "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri
    return spark.read.format(FORMAT).schema(schema).option("rangeBytes", str(range_bytes)).load(uri)


__all__ = ["register", "read", "CustomerDocuments", "FORMAT"]
