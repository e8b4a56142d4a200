"""What the operators share: the work folder, staged tables, and row-wise work on Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: Text handed to a worker function at once; a batch of longer texts is worked off in slices.
SLICE_BYTES = 4_000_000


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the folder ``spark.checkpoint.dir`` names, which all executors share.

    A local session that names none (tests) works below /tmp/checkpoints; a cluster must name one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = "file:///tmp/checkpoints"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(frame: DataFrame, name: str, folder: str | None = None, **options: str) -> DataFrame:
    """Write a table to the work folder once and go on from the files: lineage ends here."""
    spark = frame.sparkSession
    path = folder or work_folder(spark, name)
    frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_schema(ddl: str) -> pa.Schema:
    schema = _parse_datatype_string(ddl)
    assert isinstance(schema, StructType)
    return to_arrow_schema(schema)


def runs(batch: pa.RecordBatch, column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose text or binary ``column`` holds about ``size`` bytes."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64())).to_pylist()
    start = 0
    while start < len(ends):
        limit, stop = (ends[start - 1] if start else 0) + size, start + 1
        while stop < len(ends) and ends[stop] <= limit:
            stop += 1
        yield batch.slice(start, stop - start)
        start = stop


def slices(batch: pa.RecordBatch, text: int, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The runs of a batch, each with the texts of column ``text`` (null: empty)."""
    for part in runs(batch, text, size):
        yield part, [x or "" for x in part.column(text).to_pylist()]


def per_text(
    frame: DataFrame, keep: Iterable[str], text: str, work: Callable[[list[str]], dict[str, list]], added: str
) -> DataFrame:
    """Columns ``keep`` of every row, and the columns ``added`` (a DDL string) that ``work`` makes of its text.

    Columns are given by name, ``text`` may be one of ``keep``. ``work`` takes a list of texts and returns a list for each added column. Rows are neither moved nor
    joined; extra columns of the frame are not read.
    """
    keep = list(keep)
    own = text in keep  # then the text goes to the workers once
    picked = frame.select(*keep) if own else frame.select(*keep, frame[text].cast("string").alias("_text"))
    schema = StructType(picked.schema.fields[: len(keep)] + _parse_datatype_string(added).fields)
    types = to_arrow_schema(schema)
    place = keep.index(text) if own else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, place):
                made = work(texts)
                columns = [part.column(i).cast(types.field(i).type) for i in range(len(keep))]
                columns += [pa.array(made[f.name], f.type) for f in list(types)[len(keep) :]]
                yield pa.RecordBatch.from_arrays(columns, schema=types)

    return picked.mapInArrow(run, schema)
