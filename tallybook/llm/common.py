"""Small helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Only a local session in which none is set, as in tests, gets one of its own.
    """
    context = spark.sparkContext
    shared = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tallybook-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared)
    return shared


#: Short rows that a file of a checkpoint holds before there is a second one.
FILE_ROWS = 100_000


def files_for(rows: int, each: int = FILE_ROWS) -> int:
    return max(1, -(-rows // each))


def checkpointed(df: DataFrame, files: int | None = None) -> DataFrame:
    """The rows written to the shared folder, so that neither lineage nor executors are needed again.

    There is a file for each partition, `files` at most if that is given: the tasks after the last exchange then read
    several of its partitions one after the other. With few rows in many partitions, opening files is most of the work.
    """
    shared_folder(df.sparkSession)
    return (df if files is None else df.coalesce(files)).checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in a new folder of the shared one."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(modulus: int, id_column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo; a null id counts as 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % modulus, F.lit(0))


def fresh(taken: Iterable[str], name: str) -> str:
    """A column name that no given column has, whatever its case."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that extra columns can't clash with those an operator adds."""
    return df.select(*[F.col(f"`{n}`") for n in names])


#: Rows that a task turns into Python objects at once.
SLICE = 500
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of 2 MB, unless the session has a limit of its own: two workers share an executor with the JVM.

    The JVM holds a batch on its way in and out, and a worker what it makes of one; neither gives freed memory back.
    """
    if spark.conf.get(BATCH) == "67108864b":  # Spark's default
        spark.conf.set(BATCH, "2m")


def map_batches(source: DataFrame, columns: list[str], kept: list[str], make, added: str, keep=None) -> DataFrame:
    """Columns `kept` of every row as they came, and what `make()(*lists)` adds to them; map-only.

    `make` takes a list for each of `columns` and returns a list for each added column, whose schema
    is `added`. The kept columns never leave Arrow, so that ids stay exact whatever stands beside them. `keep`
    may turn the added lists into a list of booleans, which rows to keep; nothing is added then.
    Positions stand for names inside, so that names may clash.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    bounded_batches(source.sparkSession)
    fields = source.schema.fields
    at = {f.name: i for i, f in enumerate(fields)}
    new = T.StructType.fromDDL(added).fields if added else []
    types = [to_arrow_type(f.dataType) for f in new]
    use, held = [at[c] for c in columns], [at[c] for c in kept]

    def run(batches):
        work = make()
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                out = work(*[batch.column(i).to_pylist() for i in use])
                if keep:
                    batch, out = batch.filter(pa.array(keep(*out), pa.bool_())), []
                arrays = [batch.column(i) for i in held]
                arrays += [pa.array(list(values), kind) for values, kind in zip(out, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = [f"c{i}" for i in range(len(held) + len(new))]
    final = [*[fields[i] for i in held], *new]
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, final)])
    inner = source.toDF(*[f"c{i}" for i in range(len(fields))])
    return inner.mapInArrow(run, schema).toDF(*[f.name for f in final])


def map_rows(docs: DataFrame, columns: list[str], make, added: str, left_out: str = "text") -> DataFrame:
    """The named columns of every row, less the one left out, and what `make()(*values)` adds to them."""
    return map_batches(pick(docs, *columns), columns, [c for c in columns if c != left_out], make, added)


def filter_rows(docs: DataFrame, column: str, make) -> DataFrame:
    """The rows, with all their columns, for which `make()(values)` gives true."""
    return map_batches(docs, [column], docs.columns, make, "", keep=lambda flags: flags)
