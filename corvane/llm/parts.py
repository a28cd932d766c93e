"""Part files: documents are packed, by the tasks that read them, into files of bounded size on shared storage. Later steps go
back to the texts of a part by its file, so no text is ever shuffled."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import filesystem, sliced, staged, unique

#: Bytes of text in a part, or one longer text. Rows of short texts count as ROW_BYTES more.
PART_BYTES, ROW_BYTES = 4 << 20, 64
#: Most partitions that parts are dealt to.
MOST_TASKS = 50_000

#: From texts to their word or line counts and the 64-bit codes that stand for what they hold.
Describe = Callable[[list[str | None]], tuple[list[int], list[np.ndarray]]]


def pack(docs: DataFrame, path: str, describer: Callable[[], Describe], summary: Callable[[np.ndarray], np.ndarray], size: int = PART_BYTES) -> DataFrame:
    """Writes docs (doc_id long, text string) to part files with the columns doc_id, text, n and codes of each row, as a describer of the task
    gives them. Returns a row for each part: p (numbers from 0), file, n_codes and codes (the summary of all codes of the part).

    A task that runs again writes files of other names; only those count that the returned table, which is written last, names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, describe, k = TaskContext.get().partitionId(), describer(), 0
        ids, texts, held = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal k, held
            n, codes = describe(texts)
            ends = np.cumsum([0, *map(len, codes)], dtype=np.int64)
            flat = np.concatenate(codes).view(np.int64) if len(codes) else np.empty(0, np.int64)
            lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat))
            name = f"{unique()}.parquet"
            fs, where = filesystem(f"{path}/files")
            fs.create_dir(where, recursive=True)
            table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.large_string()), "n": pa.array(n, pa.int64()), "codes": lists})
            with fs.open_output_stream(f"{where}/{name}") as out:
                pq.write_table(table, out, compression="zstd", use_dictionary=False, write_statistics=False)
            brief = summary(flat.view(np.uint64)).view(np.int64)
            row = pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([k], pa.int64()), pa.array([name]), pa.array([len(flat)], pa.int64()), pa.array([brief], pa.list_(pa.int64()))], ["task", "k", "file", "n_codes", "codes"])
            k, held = k + 1, 0
            ids.clear()
            texts.clear()
            return row

        for batch in sliced(batches):
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t)
                held += len(t or "") + ROW_BYTES
                if held >= size:
                    yield flush()
        if ids:
            yield flush()

    made = staged(docs.select("doc_id", "text").mapInArrow(run, "task long, k long, file string, n_codes long, codes array<long>"), f"{path}/packed")
    # A row for each task, so one window over all is small.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = made.groupBy("task").agg(F.count(F.lit(1)).alias("c")).select("task", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    return staged(made.join(base.hint("merge"), "task").select((F.col("base") + F.col("k")).alias("p"), "file", "n_codes", "codes"), f"{path}/parts")


def read_part(path: str, file: str, columns: list[str]) -> pa.Table:
    fs, where = filesystem(f"{path}/files")
    with fs.open_input_file(f"{where}/{file}") as f:
        return pq.read_table(f, columns=columns)


def code_lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All codes of a part, and the place of the first of each row, with their number at the end."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], column.type)
    return lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.asarray(lists.offsets) - (lists.offsets[0].as_py() if len(lists.offsets) else 0)


def dealt(rows: DataFrame, n_parts: int) -> DataFrame:
    """rows, dealt by p to a task for each part or few of them."""
    return rows.repartition(max(1, min(n_parts, MOST_TASKS)), "p")
