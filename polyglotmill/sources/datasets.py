"""Named datasets: a data source with subsets and splits, read in parts with pushed filters, published all at once.

    spark.dataSource.register(NamedDataset)
    spark.read.format("dataset").option("mirror", root).option("split", "de").load("org/name")

A dataset is a folder `{mirror}/{name}` that the driver and all executors see.
Published ones hold Parquet files under `data/` and a log of versions; version
n is the file `_log/{n}.json`, which names the files of each subset and split.
A reader takes the latest version. A folder without a log is a plain mirror:
`{subset}/{split}/*.parquet`, or `{split}/*.parquet` without a subset.

Options: `mirror`; `subset` (default `default`; none for a plain mirror);
`split` (default `train`, `*` for all); `split_column` (for writing: the column
that names the split of a row; it stays in the files, and a null goes to the
split `(none)`); `part_bytes`. A schema given to the reader chooses columns:
the others are not read.

Reading makes a task of every `part_bytes` of a file; it reads the row groups
that begin there and that the filters can match. Filters on integers, strings
and booleans are applied here, row by row; all others are left to Spark.

Writing is one transaction. Each task writes files of its own under a folder of
the transaction; the driver then makes the next version of the log, by a link
that fails if another writer was first, and tries again. A failed job leaves no
version, so either all splits appear or none; `vacuum` deletes files that its
last tasks may have left.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as api
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import BooleanType, IntegralType, StringType, StructType

DEFAULT_SUBSET, DEFAULT_SPLIT, ALL, NO_SPLIT = "default", "train", "*", "(none)"
PART_BYTES = 128 << 20
#: Rows that a task writes at once as a row group, at most.
ROW_GROUP = 100_000


def local_path(path: str) -> str:
    """A file: URI or a plain path, as a path; other stores are Spark's own readers' matter."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"a mirror is a folder that all executors see, not {path}")
    return path.rstrip("/")


# ---- versions


def _log(root: str) -> str:
    return f"{root}/_log"


def latest(root: str) -> tuple[int, dict]:
    """(number, content) of the latest version; (0, nothing) without a log. content: schema, subsets -> splits -> files."""
    numbers = [int(x[:-5]) for x in os.listdir(_log(root)) if x.endswith(".json")] if os.path.isdir(_log(root)) else []
    if not numbers:
        return 0, {"schema": None, "subsets": {}}
    with open(f"{_log(root)}/{max(numbers):012d}.json") as f:
        return max(numbers), json.load(f)


def _publish(root: str, change) -> int:
    """Make the next version from the latest by `change`; again if another writer has made that number meanwhile."""
    os.makedirs(_log(root), exist_ok=True)
    while True:
        number, content = latest(root)
        made = f"{_log(root)}/.{uuid.uuid4().hex}"
        with open(made, "w") as f:
            json.dump(change(content), f)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(made, f"{_log(root)}/{number + 1:012d}.json")
            return number + 1
        except FileExistsError:
            continue
        finally:
            os.unlink(made)


def vacuum(mirror: str, name: str) -> int:
    """Delete the versions but the latest, and the files that it doesn't name. Not while others write or read. Returns the number of files."""
    root = f"{local_path(mirror)}/{name}"
    number, content = latest(root)
    log = os.listdir(_log(root)) if number else []
    held = {x["file"] for splits in content["subsets"].values() for files in splits.values() for x in files}
    gone = 0
    for folder, _, names in os.walk(f"{root}/data"):
        for x in names:
            path = f"{folder}/{x}"
            if os.path.relpath(path, root) not in held:
                os.unlink(path)
                gone += 1
    for x in log:
        if x != f"{number:012d}.json":
            os.unlink(f"{_log(root)}/{x}")
    return gone


def files_of(root: str, subset: str | None, split: str) -> tuple[list[str], str | None]:
    """Paths of a split's files, and the published schema (JSON) if there is a log. What is not there is an error that names what is."""
    if not os.path.isdir(root):
        raise FileNotFoundError(f"no dataset at {root}")
    number, content = latest(root)
    if number:
        subsets = content["subsets"]
        splits = subsets.get(subset or DEFAULT_SUBSET)
        if splits is None:
            raise FileNotFoundError(f"no subset {subset or DEFAULT_SUBSET!r}; there are {sorted(subsets)}")
        if split != ALL and split not in splits:
            raise FileNotFoundError(f"no split {split!r}; there are {sorted(splits)}")
        chosen = splits if split == ALL else {split: splits[split]}
        return [f"{root}/{x['file']}" for _, files in sorted(chosen.items()) for x in files], content["schema"]
    base = f"{root}/{subset}" if subset else root
    splits = sorted(x for x in os.listdir(base) if os.path.isdir(f"{base}/{x}")) if os.path.isdir(base) else []
    if split != ALL and split not in splits:
        raise FileNotFoundError(f"no split {split!r} in {base}; there are {splits}")
    found = [f"{base}/{x}/{name}" for x in (splits if split == ALL else [split]) for name in sorted(os.listdir(f"{base}/{x}")) if name.endswith(".parquet")]
    if not found:
        raise FileNotFoundError(f"no Parquet files for split {split!r} in {base}")
    return found, None


# ---- reading


@dataclass
class Part(api.InputPartition):
    """Row groups that begin in [start, end) of a file."""

    file: str
    start: int
    end: int
    value: object = field(default=None)


def as_arrow(f: api.Filter, schema: StructType) -> pc.Expression | None:
    """A filter as an Arrow expression that keeps the same rows; None where Spark has to do it."""
    if isinstance(f, api.Not):
        # Not of `in` stays with Spark: to Arrow, null is not in a list; to Spark that is unknown.
        inner = as_arrow(f.child, schema) if isinstance(f.child, (api.EqualTo, api.IsNull)) else None
        return None if inner is None else ~inner
    name = getattr(f, "attribute", ())
    kind = next((x.dataType for x in schema if len(name) == 1 and x.name == name[0]), None)
    if not isinstance(kind, (IntegralType, StringType, BooleanType)):
        return None
    column = pc.field(name[0])
    if isinstance(f, api.IsNull):
        return column.is_null()
    if isinstance(f, api.IsNotNull):
        return column.is_valid()
    if isinstance(f, api.In):
        values = [x for x in f.value if x is not None]
        return column.isin(values) if len(values) == len(f.value) else None
    if isinstance(f, api.StringStartsWith):
        return pc.starts_with(column, f.value)
    compare = {
        api.EqualTo: lambda a, b: a == b, api.GreaterThan: lambda a, b: a > b, api.GreaterThanOrEqual: lambda a, b: a >= b,
        api.LessThan: lambda a, b: a < b, api.LessThanOrEqual: lambda a, b: a <= b,
    }.get(type(f))
    return compare(column, pc.scalar(f.value)) if compare and f.value is not None else None


class Reader(api.DataSourceReader):
    def __init__(self, files: list[str], schema: StructType, part_bytes: int):
        self.files, self.schema, self.part_bytes, self.pushed = files, schema, part_bytes, []

    def pushFilters(self, filters):
        for f in filters:
            if as_arrow(f, self.schema) is None:
                yield f
            else:
                self.pushed.append(f)

    def partitions(self) -> list[Part]:
        parts = [Part(f, at, at + self.part_bytes) for f in self.files for at in range(0, os.path.getsize(f), self.part_bytes)]
        return parts or [Part("", 0, 0)]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        if not part.file:
            return
        meta, columns = pq.read_metadata(part.file), self.schema.names
        begins = [meta.row_group(i).column(0) for i in range(meta.num_row_groups)]
        begins = [min(x for x in (c.dictionary_page_offset, c.data_page_offset) if x is not None) for c in begins]
        own = [i for i, at in enumerate(begins) if part.start <= at < part.end]
        if not own:
            return
        where = None
        for f in self.pushed:
            one = as_arrow(f, self.schema)
            where = one if where is None else where & one
        fragment = next(iter(ds.dataset(part.file, format="parquet").get_fragments())).subset(row_group_ids=own)
        for batch in fragment.to_batches(columns=columns, filter=where, batch_size=8192, use_threads=False):
            if batch.num_rows:
                yield batch


# ---- writing


@dataclass
class Written(api.WriterCommitMessage):
    files: list[tuple[str, str, int]]  # split, file, rows


class Writer(api.DataSourceArrowWriter):
    def __init__(self, root: str, subset: str, split: str | None, name: str, schema: StructType, overwrite: bool):
        self.root, self.subset, self.split, self.name, self.overwrite = root, subset, split, name, overwrite
        self.schema, self.transaction = schema.json(), uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """One file a split and run of rows: rows sorted by split need one open file at a time."""
        done, out, now, rows, file = [], None, None, 0, ""
        for batch in batches:
            for split, piece in self._runs(batch):
                if out is None or split != now:
                    if out is not None:
                        out.close()
                        done.append((now, file, rows))
                    file = f"data/{self.transaction}/{quote(self.subset, safe='')}/{quote(split, safe='')}/{uuid.uuid4().hex}.parquet"
                    os.makedirs(os.path.dirname(f"{self.root}/{file}"), exist_ok=True)
                    out, now, rows = pq.ParquetWriter(f"{self.root}/{file}", batch.schema), split, 0
                out.write_batch(piece, row_group_size=ROW_GROUP)
                rows += piece.num_rows
        if out is not None:
            out.close()
            done.append((now, file, rows))
        return Written(done)

    def _runs(self, batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
        """Stretches of rows of one split."""
        if self.split is None:
            yield self.name, batch
            return
        names = [NO_SPLIT if x is None else str(x) for x in batch.column(self.split).to_pylist()]
        start = 0
        for i in range(1, len(names) + 1):
            if i == len(names) or names[i] != names[start]:
                yield names[start], batch.slice(start, i - start)
                start = i

    def commit(self, messages: list) -> None:
        added: dict[str, list] = {}
        for split, file, rows in sorted(x for m in messages if m is not None for x in m.files):
            added.setdefault(split, []).append({"file": file, "rows": rows, "bytes": os.path.getsize(f"{self.root}/{file}")})

        def change(content: dict) -> dict:
            had = {} if self.overwrite else content["subsets"].get(self.subset, {})
            splits = {k: [*had.get(k, []), *added.get(k, [])] for k in {**had, **added}}
            return {"schema": self.schema, "subsets": content["subsets"] | {self.subset: splits}}

        _publish(self.root, change)

    def abort(self, messages: list) -> None:
        shutil.rmtree(f"{self.root}/data/{self.transaction}", ignore_errors=True)


class NamedDataset(api.DataSource):
    """Format `dataset`; see the module."""

    @classmethod
    def name(cls) -> str:
        return "dataset"

    def _root(self) -> str:
        if "mirror" not in self.options or "path" not in self.options:
            raise ValueError("give the dataset's name to load() or save(), and the folder of the mirror as option `mirror`")
        return f"{local_path(self.options['mirror'])}/{self.options['path']}"

    def _files(self) -> tuple[list[str], str | None]:
        return files_of(self._root(), self.options.get("subset"), self.options.get("split", DEFAULT_SPLIT))

    def schema(self) -> StructType:
        files, published = self._files()
        return StructType.fromJson(json.loads(published)) if published else from_arrow_schema(pq.read_schema(files[0]))

    def reader(self, schema: StructType) -> Reader:
        return Reader(self._files()[0], schema, int(self.options.get("part_bytes", PART_BYTES)))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        root, split = self._root(), self.options.get("split_column")
        if split is not None and split not in schema.names:
            raise ValueError(f"no column {split!r}; there are {schema.names}")
        _, content = latest(root)
        if content["schema"] and not overwrite:
            published = StructType.fromJson(json.loads(content["schema"])).simpleString()
            if published != schema.simpleString():
                raise ValueError(f"the published schema is {published}, not {schema.simpleString()}")
        return Writer(root, self.options.get("subset", DEFAULT_SUBSET), split, self.options.get("split", DEFAULT_SPLIT), schema, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format `dataset` known to the session, and let filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(NamedDataset)


def read(spark: SparkSession, name: str, mirror: str, subset: str | None = None, split: str = DEFAULT_SPLIT, schema: StructType | str | None = None) -> DataFrame:
    register(spark)
    reader = spark.read.format("dataset").option("mirror", mirror).option("split", split)
    reader = reader.option("subset", subset) if subset else reader
    return (reader.schema(schema) if schema is not None else reader).load(name)


def publish(df: DataFrame, name: str, mirror: str, split_column: str, subset: str = DEFAULT_SUBSET, mode: str = "overwrite") -> None:
    """All splits of df become visible at once. Rows are sorted by split within tasks only, so a large split keeps many writers."""
    register(df.sparkSession)
    writer = df.sortWithinPartitions(split_column).write.format("dataset").mode(mode)
    writer.option("mirror", mirror).option("subset", subset).option("split_column", split_column).save(name)


def kept(spark: SparkSession, copy: str, name: str, mirror: str, subset: str | None = None, split: str = DEFAULT_SPLIT) -> DataFrame:
    """The rows of a copy if a whole one is there, else the dataset's, of which a copy is made first. FileNotFoundError without either."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{copy.rstrip('/')}/_SUCCESS")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        files_of(f"{local_path(mirror)}/{name}", subset, split)
        read(spark, name, mirror, subset, split).write.mode("overwrite").parquet(copy)
    return spark.read.parquet(copy)
