"""Helpers shared by the operators: tables, shared scratch folder, word tables."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Byte table: A-Z to a-z, digits, a-z and all bytes above 0x7F kept, the rest
#: a space.  ``text.translate(WORD_BYTES).split()`` gives the maximal runs of
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` of the lower-cased text, as UTF-8.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256))


#: Most bytes of an Arrow batch between Spark and Python: texts vary from bytes to megabytes,
#: and both sides keep buffers of the largest batch.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's sources to the executors, once per application (as
    ``--py-files`` would), so that functions in tasks can import it, and bound the session's
    Arrow batches to ``BATCH_BYTES``, if they are not bounded lower."""
    sc = spark.sparkContext
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    current = spark.conf.get(bound).rstrip("b")
    if not current.isdigit() or int(current) > BATCH_BYTES:
        spark.conf.set(bound, str(BATCH_BYTES))
    if _shipped.get("application") != sc.applicationId:
        root = Path(__file__).resolve().parents[2]
        target = Path(tempfile.mkdtemp(prefix="clickmarts-src-")) / "clickmarts.zip"  # read by this driver only
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted((root / "clickmarts").rglob("*.py")):
                z.write(f, f.relative_to(root))
        sc.addPyFile(str(target))
        _shipped["application"] = sc.applicationId
    return spark


_shipped: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the text as UTF-8 bytes, for Arrow batches."""
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"))


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; own folder only where
    it is unset and all executors share this machine (``local[...]``, as in tests)."""
    sc = spark.sparkContext
    path = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
            or sc.getCheckpointDir())
    if path:
        return path.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="clickmarts-llm-")
    sc.setCheckpointDir(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back: cuts the
    lineage, and a lost executor's tasks reread the files.  The files of one
    application lie under one folder, to be deleted when it has ended."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    # Shuffle files of a finished step go when the driver's garbage collector finds the step
    # unused; long jobs would otherwise keep those of all their steps on disk.
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete the files of materialized tables that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def trimmed(run):
    """A batch function that gives its free memory back to the machine at the end: Python
    workers stay for later stages, and would hold on to it."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)
    return wrapped


def pieces(batches, max_rows: int, max_bytes: int, column: str = "text"):
    """Cut Arrow batches into slices of at most ``max_rows`` rows and about
    ``max_bytes`` bytes of ``column`` (a longer single row is a slice of its own)."""
    for b in batches:
        sizes = [0 if v is None else v for v in pa.compute.binary_length(b.column(column)).to_pylist()]
        start = size = 0
        for i, s in enumerate(sizes):
            if i > start and (i - start >= max_rows or size + s > max_bytes):
                yield b.slice(start, i - start)
                start, size = i, 0
            size += s
        if start < b.num_rows:
            yield b.slice(start)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def named(columns) -> list:
    """Columns by their plain names, which may hold dots."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in columns]


def lower_ascii(column):
    return F.translate(column, UPPER, LOWER)


def bit_filter(keys: DataFrame, column: str, bits: int):
    """Broadcast bit table of ``2 ** bits`` bits with the bits of all hashes in ``column``
    (long) set: a fixed size, however many keys.  False positives only cost work; the
    exact join follows."""
    at = F.pmod(F.col(column), F.lit(1 << bits))
    words = (keys.select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod({column}, 64) as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow())
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words.column("word").to_numpy()] = words.column("bit").to_numpy()
    return keys.sparkSession.sparkContext.broadcast(out.view(np.uint64))


#: Bits of a table for each of its keys, at least, and the most bits of a table (64 MB).
KEY_BITS, MOST_BITS = 12, 29


def bits_for(keys: int) -> int:
    """Bits (as a power of two) of a table that few other hashes pass."""
    return min(MOST_BITS, max(20, (KEY_BITS * keys).bit_length()))


def bit_table(keys: DataFrame, column: str, bits: int):
    """As :func:`bit_filter`, made in slices where the keys lie: the driver gets the table's
    bytes alone, however many keys there are."""
    schema = pa.schema([("part", pa.int32()), ("bits", pa.binary())])
    width = bits - 6  # bits of a place within one of 64 slices

    def slices(batches):
        made: dict[int, np.ndarray] = {}
        for b in batches:
            part, at = (b.column(c).to_numpy() for c in ("part", "at"))
            for p in np.unique(part).tolist():
                own = at[part == p] & ((1 << width) - 1)
                words = made.setdefault(p, np.zeros(1 << (width - 6), np.uint64))
                np.bitwise_or.at(words, own >> 6, np.uint64(1) << (own & 63).astype(np.uint64))
        for p, words in made.items():
            yield batch(schema, part=[p], bits=[words.tobytes()])

    at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    dealt = keys.select(at.alias("at"), F.shiftright(at, width).cast("int").alias("part")).repartition("part")
    found = dealt.mapInArrow(trimmed(slices), "part int, bits binary").toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    for p, words in zip(found.column("part").to_pylist(), found.column("bits").to_pylist()):
        out[p << (width - 6):(p + 1) << (width - 6)] = np.frombuffer(words, np.uint64)
    return keys.sparkSession.sparkContext.broadcast(out)


def probe(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of ``hashes`` (uint64) have their bit set."""
    at = hashes & np.uint64(len(table) * 64 - 1)
    return (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def probed(hashes, shared):
    """Column: whether the bit of a hash (long column) is set."""
    @F.pandas_udf("boolean")
    def hit(values: pd.Series) -> pd.Series:
        return pd.Series(probe(shared.value, values.to_numpy().view(np.uint64)))
    return hit(hashes)


def keep_probed(df: DataFrame, column: str, shared, found: bool = True) -> DataFrame:
    """Rows whose hash (a long) has its bit set, or with ``found=False`` the others."""
    hit = probed(F.col(column), shared)
    return df.where(hit if found else ~hit)
