"""What the operators of this subpackage share: columns by exact name, staged tables, text slices."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.session import ensure_checkpoint_dir

# Fixed value: the white space that separates words.
SPACE = r"[\x20\x09-\x0D]+"

#: Text bytes that a Python task turns into objects at once.
SLICE_BYTES = 4 << 20
#: Code points whose words are hashed at once; sums and powers take 8 bytes each for them.
HASHED = 1 << 18


def place(df: DataFrame, name: str) -> int:
    """Position of the column of this very name; the first one, if it is there twice."""
    return df.columns.index(name)


def numbered(df: DataFrame) -> DataFrame:
    """The same rows with columns _0, _1, ...: no name can clash, not even by case."""
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Select columns by exact name under new names: ``pick(docs, doc_id="doc_id")``."""
    plain = numbered(df)
    return plain.select(*[F.col(f"_{place(df, old)}").alias(new) for new, old in wanted.items()])


def staged(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder and read back: fixed rows, short lineage.

    Lost executors don't matter, as the files lie in the folder that the cluster names in
    spark.checkpoint.dir. The folder belongs to the run, as Spark's own checkpoints there do.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/staged-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables that ``staged`` has written and that nobody has discarded.
STAGED: list[str] = []


def discard(spark: SparkSession, kept: int = 0) -> None:
    """Delete what ``staged`` has written, but for the first ``kept`` tables: call it when the result is written."""
    while len(STAGED) > kept:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(STAGED.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def apart(summary: DataFrame) -> DataFrame:
    """Deal a table of sums out evenly before it is joined to the rows that it sums up.

    Otherwise the join runs where the sums were made, and Spark can't split a hot key's rows there.
    """
    return summary.repartition(int(summary.sparkSession.conf.get("spark.sql.shuffle.partitions")))


#: Rows of a list that are sent to all tasks at most (some hundred bytes each).
SENT_ROWS = 1 << 20


def sent_if_few(table: DataFrame, most: int = SENT_ROWS) -> DataFrame:
    """A written table, marked to be sent to all tasks if it has few rows; otherwise Spark shuffles both sides."""
    return F.broadcast(table) if table.count() <= most else table


def with_names(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds ``name``: two hashes of id and text. Rows with one name are interchangeable."""
    return rows.withColumn("name", F.struct(F.xxhash64(id_col, text_col).alias("k1"), F.hash(text_col, id_col).alias("k2")))


def only_kept(rows: DataFrame, decided: DataFrame, most: int = SENT_ROWS) -> DataFrame:
    """The rows that stay. ``decided``: name and kept, one row per row; of rows with one name one stays.

    What goes is looked up where the rows are read, as long as it is few; texts are not moved for it.
    """
    decided = staged(decided.select("name", "kept"))
    gone = staged(decided.filter("not kept").select("name").distinct())
    left = rows.join(sent_if_few(gone, most), "name", "left_anti")
    twins = staged(decided.filter("kept").groupBy("name").count().filter("count > 1").select("name"))
    if twins.isEmpty():
        return left
    side = sent_if_few(twins, most)
    return left.join(side, "name", "left_anti").unionByName(left.join(side, "name", "left_semi").dropDuplicates(["name"]))


def null_to_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text, and one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = starts_of(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(sizes, sizes[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def starts_of(column: pa.Array) -> np.ndarray:
    """At which byte each text starts, and where the last one ends; nulls are empty."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and where each starts (one more for the end); nulls are empty."""
    full = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(full, pa.ChunkedArray):
        full = full.combine_chunks()
    offsets = np.frombuffer(full.buffers()[1], np.int64, len(full) + 1, full.offset * 8)
    data = full.buffers()[2]
    if data is None or not len(full):
        return np.zeros(0, np.uint8), offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def batch_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    """An Arrow batch with the columns in the order of the schema."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def buckets_for(rows: int, each: int, least: int = 8) -> int:
    """A power of two so that ``rows`` spread evenly come to at most ``each`` in a bucket."""
    n = least
    while n * each < rows:
        n *= 2
    return n


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as were ever asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up, self.down = (_powers(x, size) for x in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


BASES = (Powers(0x9E3779B97F4A7C15), Powers(0xD1342543DE82EF95))


def stretch_sums(values: np.ndarray, which: int = 0) -> np.ndarray:
    """Rabin-Karp sums before each value; one more for the end."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * BASES[which].to(len(values) + 1)[0][:-1], out=sums[1:])
    return sums


def stretch_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0, summed: bool = False) -> np.ndarray:
    """Rabin-Karp hashes modulo 2**64 of values[start:end], mixed with the length; the place doesn't matter.

    ``summed``: the values are ``stretch_sums`` already.
    """
    sums = values if summed else stretch_sums(values.astype(np.uint64), which)
    down = BASES[which].to(len(sums))[1]
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def gram_hashes(sums: np.ndarray, size: int) -> np.ndarray:
    """``stretch_hashes`` (which = 0) of all stretches of one size, from ``stretch_sums``."""
    down = BASES[0].to(len(sums))[1]
    return mixed((sums[size:] - sums[:-size]) * down[: len(sums) - size] + np.uint64(size * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def letters(keep, size: int = 0x30000) -> np.ndarray:
    """For each code point whether it belongs to a word; larger ones are like the last."""
    return np.array([keep(chr(c)) for c in range(size)])


#: Words between white space, as in SPACE.
NOT_SPACE = np.array([c not in (0x20, *range(0x09, 0x0E)) for c in range(64)])


class Words:
    """The words of many texts: code points, where words start and end, and each word's text."""

    def __init__(self, texts: list[str], belongs: np.ndarray, lower_ascii: bool = False):
        # A line feed belongs to no word, so words don't reach over the end of a text.
        joined = "\n".join(texts).encode("utf-32-le", "surrogatepass")
        self.code = np.frombuffer(joined, np.uint32)
        if lower_ascii:
            self.code = self.code + np.uint32(32) * ((self.code >= 65) & (self.code <= 90))
        mask = np.zeros(len(self.code) + 2, bool)
        mask[1:-1] = belongs[np.minimum(self.code, len(belongs) - 1)]
        edges = np.flatnonzero(mask[1:] != mask[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        #: Which words belong to text k: first[k] to first[k + 1].
        self.text_starts = np.concatenate([[0], np.cumsum(sizes)])
        self.first = np.searchsorted(self.starts, self.text_starts)

    def hashes(self, which: int = 0) -> np.ndarray:
        """Hashes of all words; the place doesn't matter, so sums go over ``HASHED`` code points at once (or one longer word)."""
        found = np.empty(len(self.starts), np.uint64)
        i = 0
        while i < len(found):
            begin = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.ends, begin + HASHED, "right")))
            found[i:j] = stretch_hashes(self.code[begin : self.ends[j - 1]], self.starts[i:j] - begin, self.ends[i:j] - begin, which)
            i = j
        return found


def gathered(code: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: int, after: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of code one after the other, each between two marks; and the sizes with marks."""
    sizes = ends - starts + 2
    at = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    place = np.arange(total) - np.repeat(at - starts + 1, sizes)
    out = code[np.clip(place, 0, max(0, len(code) - 1))].copy()
    out[at], out[at + sizes - 1] = before, after
    return out, sizes
