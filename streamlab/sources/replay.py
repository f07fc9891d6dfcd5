"""A user-defined streaming source: replays a parquet table in slices of event time.

    spark.dataSource.register(TableReplay)
    spark.readStream.format("table_replay").schema(schema).load(path=..., time="ts", slice_seconds="3600")

Each trigger takes up to ``slices_per_trigger`` slices. The driver reads only the time statistics in the file footers;
rows are read by the tasks, one per row group that overlaps the slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


class _Part(InputPartition):
    def __init__(self, file: str, row_group: int, low: datetime, high: datetime) -> None:
        self.file, self.row_group, self.low, self.high = file, row_group, low, high


class TableReplay(DataSource):
    @classmethod
    def name(cls) -> str:
        return "table_replay"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Reader(schema, dict(self.options))


def _naive(t: datetime) -> datetime:
    return t.astimezone(timezone.utc).replace(tzinfo=None) if t.tzinfo else t


class _Reader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema, self.path, self.time = schema, options["path"], options["time"]
        self.length = timedelta(seconds=float(options.get("slice_seconds", 3600)))
        self.step = int(options.get("slices_per_trigger", 1))
        self.groups = list(self._row_groups())
        self.start = min(low for *_, low, _ in self.groups)
        end = max(high for *_, high in self.groups)
        self.slices = int((end - self.start) / self.length) + 1
        self.position = 0

    def _row_groups(self) -> Iterator[tuple[str, int, datetime, datetime]]:
        system, base = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        info = system.get_file_info(base)
        files = [base] if info.type == fs.FileType.File else [
            f.path for f in system.get_file_info(fs.FileSelector(base)) if f.path.endswith(".parquet")]
        for file in sorted(files):
            meta = pq.read_metadata(file, filesystem=system)
            column = meta.schema.to_arrow_schema().get_field_index(self.time)
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(column).statistics
                yield file, g, _naive(stats.min), _naive(stats.max)

    def initialOffset(self) -> dict:
        return {"slice": 0}

    def latestOffset(self) -> dict:
        self.position = min(self.position + self.step, self.slices)
        return {"slice": self.position}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        low = self.start + start["slice"] * self.length
        high = self.start + end["slice"] * self.length
        self.position = max(self.position, end["slice"])
        return [_Part(f, g, low, high) for f, g, first, last in self.groups if first < high and last >= low]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        names = self.schema.names
        system = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path else fs.LocalFileSystem()
        with system.open_input_file(partition.file) as source:
            table = pq.ParquetFile(source).read_row_group(
                partition.row_group, columns=list(dict.fromkeys([*names, self.time])))
        at = table[self.time].cast(pa.timestamp("us"))
        inside = pc.and_(pc.greater_equal(at, pa.scalar(partition.low, pa.timestamp("us"))),
                         pc.less(at, pa.scalar(partition.high, pa.timestamp("us"))))
        rows = table.filter(inside).select(names)
        target = to_arrow_schema(self.schema)
        columns = []
        for field in target:
            column = rows[field.name]
            if pa.types.is_timestamp(field.type) and field.type.tz and column.type.tz is None:
                column = pc.assume_timezone(column.cast(pa.timestamp("us")), "UTC")
            columns.append(column.cast(field.type))
        yield from pa.Table.from_arrays(columns, schema=target).to_batches()
