"""Models behind one interface, and the fused step from recordings to embeddings and top-k predictions."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corvane import schemas
from corvane.functions import signal

#: A batch of prepared chunks (n x samples) to embeddings (n x d) and logits (n x classes).
Runner = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


class StandIn:
    """A deterministic stand-in for a model: fixed projections of a chunk's spectrum. It recognises nothing."""

    def __init__(self, embedding: int = 64, classes: int = 200, seed: int = 7, bands: int = 128):
        r = np.random.default_rng(seed)
        self.bands = bands
        self.a, self.b = r.normal(size=(bands, embedding)) / np.sqrt(bands), r.normal(size=(embedding, classes))

    def __call__(self, batch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        power = np.abs(np.fft.rfft(batch.astype(np.float64), axis=1))[:, 1:]
        n = power.shape[1] // self.bands * self.bands
        bands = np.log1p(power[:, :n].reshape(len(batch), self.bands, -1).mean(axis=2))
        emb = np.tanh(bands @ self.a)
        return emb.astype(np.float32), (emb @ self.b).astype(np.float32)


class Fixed:
    """A model with fixed answers for tests: of three classes the first leads for sound and the third for silence, and the second comes next."""

    def __call__(self, batch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        loud = (np.abs(batch).max(axis=1) > 0)[:, None]
        return batch[:, :4].astype(np.float32), np.where(loud, [[2.0, 1.0, -1.0]], [[-1.0, 1.0, 2.0]]).astype(np.float32)


class Onnx:
    """An ONNX model whose outputs are told by name."""

    def __init__(self, path: str, threads: int = 1, embedding: str = "embedding", logits: str = "label"):
        import onnxruntime as ort

        options = ort.SessionOptions()
        options.intra_op_num_threads, options.inter_op_num_threads = threads, 1
        options.execution_mode = ort.ExecutionMode.ORT_SEQUENTIAL
        options.graph_optimization_level = ort.GraphOptimizationLevel.ORT_ENABLE_ALL
        self.session = ort.InferenceSession(path, options, providers=["CPUExecutionProvider"])
        self.input, self.names = self.session.get_inputs()[0].name, [embedding, logits]

    def __call__(self, batch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        emb, logits = self.session.run(self.names, {self.input: batch.astype(np.float32)})
        return emb, logits


class TfLite:
    """A TensorFlow Lite model, one chunk at a time, whose outputs are told by shape."""

    def __init__(self, path: str, threads: int = 4, embedding: int = schemas.EMBEDDING_SIZE):
        try:
            from tflite_runtime.interpreter import Interpreter
        except ImportError as e:
            raise RuntimeError("tflite_runtime isn't installed") from e
        self.net, self.embedding = Interpreter(model_path=path, num_threads=threads), embedding
        self.net.allocate_tensors()

    def __call__(self, batch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        embs, logits = [], []
        for x in batch:
            self.net.set_tensor(self.net.get_input_details()[0]["index"], x[None].astype(np.float32))
            self.net.invoke()
            for out in self.net.get_output_details():
                value = self.net.get_tensor(out["index"]).reshape(-1)
                (embs if len(value) == self.embedding else logits).append(value) if len(value) == self.embedding or len(value) > 10_000 else None
        return np.stack(embs), np.stack(logits)


_runners: dict[str, Runner] = {}
#: What native libraries read their number of threads from.
THREADS = ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS", "VECLIB_MAXIMUM_THREADS", "NUMEXPR_NUM_THREADS")


def limit_threads(n: int = 1) -> None:
    """Caps the threads of native libraries that this process loads later, unless its environment says otherwise: a task has its own core."""
    for name in THREADS:
        os.environ.setdefault(name, str(n))


def cached(key: str, make: Callable[[], Runner]) -> Runner:
    """The runner of a key; a worker process keeps the latest one."""
    if key not in _runners:
        _runners.clear()
        limit_threads()
        _runners[key] = make()
    return _runners[key]


def best(logits: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest logits of each row, NaN first, then by value, of equals the larger place first."""
    key = np.where(np.isnan(logits), np.inf, logits)
    k = min(k, logits.shape[1])
    least = np.partition(key, -k, axis=1)[:, -k]
    out = np.empty((len(logits), k), np.int64)
    for r, (row, low) in enumerate(zip(key, least, strict=True)):
        at = np.flatnonzero(row >= low)
        nan = np.isnan(logits[r, at])
        out[r] = at[np.lexsort((-at, -row[at], ~nan))][:k]
    return out


def infer(files: DataFrame, make: Callable[[], Runner], names: list[str], k: int = 10, batch: int = 4, key: str | None = None, always_scale: bool = False) -> DataFrame:
    """recordings to rows of KEYS, embedding, topk and reason; a file that can't be decoded gives one row with a reason.

    Decoding, the model and the choice of k run in one pass of a task, so neither samples nor whole logits leave it. Calls with one key share the
    runner that the first of them made in a worker process; without a key each call has its own."""
    key = key or uuid.uuid4().hex
    kind = pa.list_(pa.struct([("rank", pa.int32()), ("idx", pa.int32()), ("species", pa.string()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runner = cached(key, make)
        waiting: list[tuple] = []

        def flush() -> pa.RecordBatch:
            x = np.stack([signal.prepared(w[2], always=always_scale) for w in waiting])
            emb, logits = runner(x)
            tops = [[{"rank": j + 1, "idx": int(i), "species": names[i] if i < len(names) else str(i), "score": float(row[i])} for j, i in enumerate(at)] for row, at in zip(logits, best(logits, k), strict=True)]
            paths, idx, _, start, end = zip(*waiting, strict=True)
            keys = [f"{stem(p)}_{i}" for p, i in zip(paths, idx, strict=True)]
            return rows(keys, paths, idx, start, end, list(emb), tops, [None] * len(waiting))

        def rows(*cols) -> pa.RecordBatch:
            kinds = [pa.string(), pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float32()), kind, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["file", "file_path", "chunk_idx", "start_time", "end_time", "embedding", "topk", "reason"])

        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                try:
                    x = signal.load(content.as_buffer().to_pybytes() if content.is_valid else b"")
                except signal.BadAudio as e:
                    yield rows([None], [path], [None], [None], [None], [None], [None], [str(e)])
                    continue
                for i, part in enumerate(signal.frames(x)):
                    waiting.append((path, i, part, i * signal.CHUNK / signal.RATE, min((i + 1) * signal.CHUNK, len(x)) / signal.RATE))
                    if len(waiting) == batch:
                        yield flush()
                        waiting = []
        if waiting:
            yield flush()

    return files.select("path", "content").mapInArrow(run, f"{schemas.KEYS}, embedding array<float>, topk array<struct<rank: int, idx: int, species: string, score: double>>, reason string")


def stem(path: str) -> str:
    name = path.rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[0] if "." in name[1:] and not name.endswith(".") else name
