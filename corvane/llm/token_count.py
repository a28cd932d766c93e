"""Token counts from flat, unindexed token files: vectorised searches for end-of-document ids in blocks, and a prefix scan
over the blocks that joins documents cut by their boundaries."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import filesystem, scratch, sliced, staged
from .encoding import default_path, encoder

#: Ids in a block that one search reads.
BLOCK_IDS = 1 << 20


def write_flat(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int | None = None) -> DataFrame:
    """Writes the ids of every whole text of docs (doc_id, text), end_id after each (by default that of
    `separator`), to one flat file for each task, without any index. Returns the order of documents: doc_id,
    file, ord. A file of a task that is run again gets another name; only those that the order names count."""
    spark = docs.sparkSession
    tokenizer = tokenizer or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([separator(tokenizer) if end_id is None else end_id], dtype=enc.dtype).tobytes()
        fs, where = filesystem(path)
        fs.create_dir(where, recursive=True)
        name, out, ord_ = f"{uuid.uuid4().hex}.ids", None, 0
        for batch in sliced(batches):
            if out is None:
                out = fs.open_output_stream(f"{where}/{name}")
            for data in enc.encode([t or "" for t in batch.column(1).to_pylist()]):
                out.write(data)
                out.write(end)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([name] * n, pa.string()), pa.array(range(ord_, ord_ + n), pa.int64())], ["doc_id", "file", "ord"])
            ord_ += n
        if out is not None:
            out.close()

    return staged(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, file string, ord long"), f"{path}/order")


def separator(tokenizer: str) -> int:
    """The id that ends documents: that of <|endoftext|>, which texts never get."""
    t = encoder(tokenizer).tokenizer
    found = t.token_to_id("<|endoftext|>")
    return t.get_vocab_size() if found is None else found


def count_tokens(spark: SparkSession, path: str, names: list[str], end_id: int, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row for each document of the flat files: file, ord (its place in the file), start, n_tokens, closed.

    Ids are little-endian, of `width` bytes. A document is what stands between two end ids; n_tokens leaves its end id out, so
    two end ids in a row make a document of no tokens. Ids after the last end id make a document with closed = false. An empty
    file has no documents. names: one for each file; the files' lengths are read by the driver, their contents by tasks.

    Blocks are independent; what is scanned over them is a row for each block with its count and last end id."""
    fs, where = filesystem(path)
    sizes = [(i.base_name, i.size // width) for i in fs.get_file_info([f"{where}/{n}" for n in names])] if names else []
    table = spark.createDataFrame(sizes, "file string, ids long")
    blocks = table.where("ids > 0").select("file", "ids", F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("ids") - 1) / block_ids).cast("long"))).alias("block"))
    total = sum(-(-n // block_ids) for _, n in sizes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, where = filesystem(path)
        for b in batches:
            for file, ids, block in zip(*(c.to_pylist() for c in b.columns), strict=True):
                first = block * block_ids
                n = min(block_ids, ids - first)
                with fs.open_input_file(f"{where}/{file}") as f:
                    f.seek(first * width)
                    data = f.read(n * width)
                ends = np.flatnonzero(np.frombuffer(data, f"<u{width}") == end_id) + first
                last = pa.array([int(ends[-1]) if len(ends) else None], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([ids], pa.int64()), pa.array([block], pa.int64()), pa.array([ends], pa.list_(pa.int64())), last], ["file", "ids", "block", "ends", "last"])

    found = blocks.repartition(max(1, min(total, 4096)), "file", "block").mapInArrow(search, "file string, ids long, block long, ends array<long>, last long")
    # Per block: how many documents ended before it, and where the last of them ended.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scanned = found.withColumn("ord0", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0))).withColumn("open", F.coalesce(F.max("last").over(before), F.lit(-1)))
    closed = scanned.select("file", "ord0", F.concat(F.array("open"), "ends").alias("e"), F.size("ends").alias("k")).where("k > 0")
    docs = closed.select("file", "ord0", "e", F.explode(F.sequence(F.lit(1), F.col("k"))).alias("i")).select(
        "file", (F.col("ord0") + F.col("i") - 1).cast("long").alias("ord"), (F.element_at("e", F.col("i")) + 1).alias("start"), (F.element_at("e", F.col("i") + 1) - F.element_at("e", F.col("i")) - 1).alias("n_tokens"), F.lit(True).alias("closed")
    )
    tails = found.groupBy("file", "ids").agg(F.sum(F.size("ends")).cast("long").alias("ord"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"))
    return docs.unionByName(tails.where("start < ids").select("file", "ord", "start", (F.col("ids") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed")))


def document_tokens(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and n_tokens (without the end id) for each row of docs (doc_id, text), counted from flat files that it writes to a
    scratch folder. A null or empty text has no tokens. Rows of one doc_id, and of a null one, are counted one by one."""
    spark = docs.sparkSession
    tokenizer = tokenizer or default_path()
    path = scratch(spark, "flat")
    order = write_flat(docs, path, tokenizer)
    names = [r[0] for r in order.select("file").distinct().collect()]  # one for each task that wrote
    counts = count_tokens(spark, path, names, separator(tokenizer), encoder(tokenizer).width)
    # Sort-merge at every size: both sides have a row for each document.
    return order.join(counts.hint("merge"), ["file", "ord"]).select("doc_id", "n_tokens")
