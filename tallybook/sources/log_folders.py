"""A stream source over a log that has a folder per partition: by offset, bounded in rows, in Arrow batches.

A micro-batch takes at most so many rows of each log partition, one input partition for each. Which rows follows from
the offsets alone, so a repeated batch reads the same ones. Offsets are dense: what is read ends before the first gap,
so files of a write that is not done yet are never read around.

Spark's own work for a micro-batch does not depend on its rows, so a reader of small batches that lags behind may take many
of them at once: each is still the same rows of each partition, and every row says which batch it belongs to.

Only footers of files are read on the driver, once each: a line per file. The rows are read in the tasks, and of a file
only the row groups that hold wanted offsets.

Spark asks a source how far it may read without saying from where, also after a restart. So the reader notes beside the
checkpoint up to where it has planned; a batch that Spark repeats is planned again and noted again.

Every executor needs the path: it is opened by Arrow, as a local path or by a scheme that Arrow knows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import LongType, StructType

from tallybook.schemas import EARLIEST, LOG_RECORD, MICRO_BATCH_ROWS
from tallybook.sources.log_writer import FOLDER

ARROW = pa.schema(
    [
        ("key", pa.binary()),
        ("value", pa.binary()),
        ("partition", pa.int32()),
        ("offset", pa.int64()),
        ("timestamp", pa.timestamp("us", tz="UTC")),
    ]
)


@dataclass(frozen=True)
class Stretch:
    """A file and the offsets it holds, both ends included."""

    path: str
    first: int
    last: int


class Slice(InputPartition):
    """The rows of one log partition with offsets from start on and below end; batches are counted from begin on."""

    def __init__(self, partition: int, start: int, end: int, files: Sequence[str], begin: int = 0):
        super().__init__(partition)
        self.partition, self.start, self.end, self.files, self.begin = partition, start, end, list(files), begin


def opened(path: str) -> tuple[fs.FileSystem, str]:
    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    return fs.FileSystem.from_uri(path)


def stretch(files: fs.FileSystem, path: str) -> Stretch | None:
    """The offsets of a file, from its footer; None for a file without rows."""
    with files.open_input_file(path) as source:
        footer = pq.ParquetFile(source).metadata
    if footer.num_rows == 0:
        return None
    at = footer.schema.names.index("offset")
    ends = [footer.row_group(k).column(at).statistics for k in range(footer.num_row_groups)]
    first, last = min(s.min for s in ends), max(s.max for s in ends)
    if last - first + 1 != footer.num_rows:
        raise ValueError(f"offsets {first} to {last} in {footer.num_rows} rows are not dense: {path}")
    return Stretch(path, first, last)


class LogReader(DataSourceStreamReader):
    def __init__(self, path: str, starts: Mapping[int, int], rows: int, notes: str, at_once: int | None = None):
        if rows < 1:
            raise ValueError("a batch needs at least one row of each partition")
        if at_once is not None and at_once < 1:
            raise ValueError("at least one batch is taken at once")
        self.path, self.starts, self.rows, self.notes, self.at_once = path, dict(starts), rows, notes, at_once
        self.known: dict[str, Stretch | None] = {}
        self.begins: dict[int, int] = {}
        self.position: dict[int, int] | None = None

    def _held(self, partition: int) -> list[Stretch]:
        """What the folder of a log partition holds, by offset."""
        files, root = opened(self.path)
        folder = fs.FileSelector(f"{root}/{FOLDER}={partition}", allow_not_found=True)
        found = [f.path for f in files.get_file_info(folder) if f.base_name.endswith(".parquet") and f.base_name[0] not in "._"]
        for path in found:
            if path not in self.known:
                self.known[path] = stretch(files, path)
        return sorted((s for path in found if (s := self.known[path])), key=lambda s: (s.first, s.last))

    def _begin(self, partition: int) -> int:
        """The first offset to read, found once: the earliest there is may change."""
        if partition not in self.begins:
            held, start = self._held(partition), self.starts[partition]
            if start == EARLIEST:
                start = held[0].first if held else 0
            self._check(partition, start, held)
            self.begins[partition] = start
        return self.begins[partition]

    def _check(self, partition: int, at: int, held: list[Stretch]) -> None:
        if held and at < held[0].first:
            raise ValueError(f"partition {partition} has no offset {at} any more, it begins at {held[0].first}")

    def _notes(self) -> list[tuple[int, str]]:
        files, root = opened(self.notes)
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted((int(f.base_name.removesuffix(".json")), f.path) for f in found if f.base_name.endswith(".json"))

    def _noted(self) -> dict[int, int]:
        if not (notes := self._notes()):
            return {}
        with opened(self.notes)[0].open_input_stream(notes[-1][1]) as source:
            noted = json.loads(source.read())
        # Where a partition began is noted too: the earliest offset there is may have changed since.
        self.begins = {int(p): at for p, at in noted.get("begins", {}).items()} | self.begins
        return {int(p): at for p, at in noted.get("position", noted).items()}

    def _note(self, position: Mapping[int, int]) -> None:
        """A new file for each note, complete when it has its name; older ones go."""
        files, root = opened(self.notes)
        files.create_dir(root, recursive=True)
        notes = self._notes()
        number = notes[-1][0] + 1 if notes else 0
        with files.open_output_stream(f"{root}/{number}.part") as sink:
            named = {"position": position, "begins": self.begins}
            sink.write(json.dumps({name: {str(p): at for p, at in of.items()} for name, of in named.items()}).encode())
        files.move(f"{root}/{number}.part", f"{root}/{number}.json")
        for _, path in notes[:-1]:
            files.delete_file(path)

    def initialOffset(self) -> dict:
        return {str(p): self._begin(p) for p in self.starts}

    def latestOffset(self) -> dict:
        if self.position is None:
            self.position = self._noted()
        ends = {}
        for partition in self.starts:
            at = self.position[partition] if partition in self.position else self._begin(partition)
            held, end = self._held(partition), at
            self._check(partition, at, held)
            for s in held:
                if s.first <= end <= s.last:
                    end = s.last + 1
            ends[str(partition)] = min(end, self._bound(partition, at))
        return ends

    def _bound(self, partition: int, at: int) -> int:
        """Where a micro-batch that starts at this offset ends at the latest."""
        return at + self.rows * (1 if self.at_once is None else self.at_once)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if self.position is None:
            self.position = self._noted()
        slices = []
        for name, to in end.items():
            at = start[name] if name in start else self._begin(int(name))
            if at < to:
                files = [s.path for s in self._held(int(name)) if s.first < to and s.last >= at]
                slices.append(Slice(int(name), at, to, files, 0 if self.at_once is None else self._begin(int(name))))
        position = {int(name): to for name, to in end.items()}
        if position != self.position or start != end:
            self._note(position)
        self.position = position
        return slices

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        files, _ = opened(self.path)
        got = 0
        for path in partition.files:
            with files.open_input_file(path) as source:
                parquet = pq.ParquetFile(source)
                at = parquet.metadata.schema.names.index("offset")
                ends = [parquet.metadata.row_group(k).column(at).statistics for k in range(parquet.num_row_groups)]
                wanted = [k for k, s in enumerate(ends) if s.min < partition.end and s.max >= partition.start]
                for batch in parquet.iter_batches(row_groups=wanted, columns=ARROW.names):
                    here = batch.column("offset")
                    inside = pc.and_(pc.greater_equal(here, partition.start), pc.less(here, partition.end))
                    rows = batch.filter(inside).select(ARROW.names).cast(ARROW)
                    got += len(rows)
                    yield rows if self.at_once is None else self._numbered(rows, partition.begin)
        if got != partition.end - partition.start:
            raise ValueError(f"partition {partition.partition} lost rows of {partition.start} to {partition.end}: {got} are left")


    def _numbered(self, rows: pa.RecordBatch, begin: int) -> pa.RecordBatch:
        """The rows with the number of their batch; offsets are at or behind begin, so the division rounds down."""
        return rows.append_column("batch", pc.divide(pc.subtract(rows.column("offset"), begin), self.rows))


class LogFolders(DataSource):
    """Options: path, starts (a JSON object of partition and offset), rows (of a partition per batch at most), notes,
    and, if batches are numbered, at_once (so many of them at most)."""

    @classmethod
    def name(cls) -> str:
        return "log_folders"

    def schema(self) -> StructType:
        numbered = StructType([*LOG_RECORD.fields]).add("batch", LongType())
        return numbered if "at_once" in self.options else LOG_RECORD

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        starts = {int(p): int(at) for p, at in json.loads(self.options["starts"]).items()}
        at_once = int(self.options["at_once"]) if "at_once" in self.options else None
        return LogReader(self.options["path"], starts, int(self.options["rows"]), self.options["notes"], at_once)


def read_log_folders(
    spark: SparkSession,
    path: str,
    starts: Mapping[int, int],
    checkpoint: str,
    rows: int = MICRO_BATCH_ROWS,
    at_once: int | None = None,
) -> DataFrame:
    """Streaming log records of the given partitions, each from its start on; checkpoint is that of the query.

    With at_once, a micro-batch of Spark takes up to so many batches of `rows` rows of a partition, and the column `batch` has
    the number of a row's batch: from 0, counted from where the partition began. Otherwise it takes one.

    As long as the checkpoint is there, a restart goes on from it and not from the starts. Take a trigger by time:
    availableNow would take one batch and end.
    """
    spark.dataSource.register(LogFolders)
    options = {"path": path, "starts": json.dumps({str(p): at for p, at in starts.items()}), "rows": str(rows)}
    options["notes"] = f"{checkpoint.rstrip('/')}/planned"
    if at_once is not None:
        options["at_once"] = str(at_once)
    return spark.readStream.format(LogFolders.name()).options(**options).load()
