"""Sweeps of configurations: repeated runs, statistics, speedups against the slowest, and reports."""

from __future__ import annotations

import json
import os
import platform
import threading
import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.operators import stats


def system_info() -> dict:
    """What the report says of the machine; the clock rate is 0 where it isn't told."""
    memory, clock = 0.0, 0.0
    if os.path.exists("/proc/meminfo"):
        with open("/proc/meminfo") as f:
            memory = next((int(x.split()[1]) / 1e6 for x in f if x.startswith("MemTotal")), 0.0)
        with open("/proc/cpuinfo") as f:
            clock = max([float(x.split(":")[1]) for x in f if x.lower().startswith("cpu mhz")], default=0.0)
    return {
        "platform": platform.platform(), "processor": platform.processor(), "python_version": platform.python_version(), "cpu_count": os.cpu_count(),
        "cpu_mhz": clock, "memory_gb": round(memory, 1), "timestamp": time.strftime("%Y-%m-%dT%H:%M:%S"),
    }


def _tree() -> tuple[float, float]:
    """CPU seconds and resident MB of this process and all below it, from /proc; shared pages count for each process."""
    below: dict[int, list[int]] = {}
    seen: dict[int, tuple[float, float]] = {}
    tick, page = os.sysconf("SC_CLK_TCK"), os.sysconf("SC_PAGE_SIZE")
    for name in os.listdir("/proc"):
        if name.isdigit():
            try:
                with open(f"/proc/{name}/stat") as f:
                    x = f.read().rpartition(")")[2].split()
            except OSError:
                continue
            below.setdefault(int(x[1]), []).append(int(name))
            seen[int(name)] = (int(x[11]) + int(x[12])) / tick, int(x[21]) * page / 1e6
    cpu = mb = 0.0
    waiting = [os.getpid()]
    while waiting:
        pid = waiting.pop()
        cpu, mb = cpu + seen.get(pid, (0, 0))[0], mb + seen.get(pid, (0, 0))[1]
        waiting += below.get(pid, [])
    return cpu, mb


class Monitor:
    """Readings of CPU (percent of one core) and memory of the driver and its processes while a run lasts. Executors elsewhere aren't seen."""

    def __init__(self, every: float = 0.5):
        self.every, self.cpu, self.mb, self.done = every, [], [], threading.Event()
        self.thread = threading.Thread(target=self._watch, daemon=True)

    def _watch(self) -> None:
        if not os.path.exists("/proc/self/stat"):
            return
        at, (used, _), ended = time.perf_counter(), _tree(), False
        while not ended:
            ended = self.done.wait(self.every)
            now, (cpu, mb) = time.perf_counter(), _tree()
            # What ended in between makes a reading smaller.
            self.cpu.append(max(0.0, (cpu - used) / max(now - at, 1e-3) * 100))
            self.mb.append(mb)
            at, used = now, cpu

    def __enter__(self) -> Monitor:
        self.thread.start()
        return self

    def __exit__(self, *_) -> None:
        self.done.set()
        self.thread.join()


RUNS = "config string, iteration int, returncode int, elapsed double, files long, cpu double, memory double, cpu_readings array<double>, memory_readings array<double>"


def sweep(spark: SparkSession, run: Callable[[dict], int], configs: Iterable[dict], iterations: int = 3, timeout: float | None = None) -> DataFrame:
    """RUNS: `run` on each configuration, as often as asked; it returns the number of files. A run that raises has returncode 1 and no time; one whose
    Spark jobs are still running after `timeout` seconds is cancelled and has returncode -1. cpu and memory are means of the readings."""
    rows, sc = [], spark.sparkContext
    for config in configs:
        for i in range(iterations):
            group, late = f"sweep-{len(rows)}-{time.monotonic_ns()}", threading.Event()
            stop = threading.Timer(timeout or 0, lambda group=group, late=late: (late.set(), sc.cancelJobGroup(group)))
            sc.setJobGroup(group, json.dumps(config), interruptOnCancel=True)
            start = time.perf_counter()
            with Monitor() as seen:
                if timeout:
                    stop.start()
                try:
                    files, code = int(run(config)), 0
                except Exception:
                    files, code = 0, 1
                elapsed = time.perf_counter() - start
                stop.cancel()
            sc._jsc.clearJobGroup()
            code = -1 if late.is_set() else code
            mean = lambda x: sum(x) / len(x) if x else None
            rows.append((json.dumps(config, sort_keys=True), i, code, elapsed if code == 0 else None, files if code == 0 else 0, mean(seen.cpu), mean(seen.mb), seen.cpu, seen.mb))
    return spark.createDataFrame(rows, RUNS)


def report(runs: DataFrame) -> DataFrame:
    """A row for each configuration with a run that succeeded: statistics of its times and rates, and its speedup and rank."""
    ok = stats.successful(runs).withColumn("throughput", F.when(F.col("elapsed") > 0, F.col("files") / F.col("elapsed")))
    times = stats.sample_stats(ok, ["config"], "elapsed")
    rates = stats.sample_stats(ok, ["config"], "throughput").select("config", F.col("mean").alias("throughput_mean"), F.col("min").alias("throughput_min"), F.col("max").alias("throughput_max"))
    return stats.speedups(times.join(rates, "config", "left"), "config", "mean")


#: The report's names for what is measured, and the column of runs that has it.
MEASURED = {"elapsed_time_stats": "elapsed", "throughput_stats": "throughput", "cpu_stats": "cpu", "memory_stats": "memory"}
SECONDS_EACH = 60.0


def write_report(runs: DataFrame, path: str, model_path: str = "", script_path: str = "", timeout: int | None = None, seconds_each: float = SECONDS_EACH) -> None:
    """One JSON document in the layout that sources.tables.benchmark_report reads: benchmark_metadata, system_info, test_parameters, results by rank (with
    statistics of times, rates, CPU and memory, and the raw samples), speedup_analysis. Everything is a row for each configuration or run."""
    spark = runs.sparkSession
    ok = stats.successful(runs).withColumn("throughput", F.when(F.col("elapsed") > 0, F.col("files") / F.col("elapsed")))
    compared = {r["config"]: r.asDict() for r in report(runs).collect()}
    each = {name: {r["config"]: {k: v for k, v in r.asDict().items() if k != "config"} for r in stats.sample_stats(ok, ["config"], column).collect()} for name, column in MEASURED.items()}
    samples: dict[str, list] = {}
    for r in runs.orderBy("config", "iteration").collect():
        samples.setdefault(r["config"], []).append(r)
    results = []
    for config in sorted(compared, key=lambda c: compared[c]["rank"]):
        good = [r for r in samples[config] if r["returncode"] == 0]
        rate = each["throughput_stats"].get(config, {}).get("mean")
        results.append(
            {"config": json.loads(config), "iterations_successful": len(good), "iterations_requested": len(samples[config]), **{name: each[name].get(config) for name in MEASURED}, "files_processed": sum(r["files"] for r in good)}
            | {"raw_elapsed_times": [r["elapsed"] for r in good], "raw_throughputs": [r["files"] / r["elapsed"] for r in good if r["elapsed"]], "speedup_factor": rate and rate * seconds_each}
            | {k: compared[config][k] for k in ("rank", "speedup", "percent_faster", "time_saved", "baseline_time")}
        )
    configs = [json.loads(c) for c in samples]
    doc = {
        "benchmark_metadata": {
            "timestamp": time.strftime("%Y-%m-%dT%H:%M:%S"), "script_path": script_path, "model_path": model_path, "num_test_files": max((r["files"] for s in samples.values() for r in s), default=0),
            "iterations_per_config": max(map(len, samples.values()), default=0), "total_benchmark_time_seconds": sum(r["elapsed"] or 0.0 for s in samples.values() for r in s),
            "configurations_tested": len(samples), "successful_configurations": len(results),
        },
        "system_info": system_info(),
        "test_parameters": {"workers_tested": sorted({c["workers"] for c in configs if "workers" in c}), "batch_sizes_tested": sorted({c["batch_size"] for c in configs if "batch_size" in c}), "timeout_seconds": timeout},
        "results": results,
        "speedup_analysis": stats.speedup_summary(report(runs)).first().asDict(),
    }
    spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def analysis(reports: DataFrame, seconds_each: float = SECONDS_EACH) -> DataFrame:
    """From reports as read: a row for each configuration with its mean throughput, times real time (files of seconds_each seconds), means of time, CPU and memory,
    and its rank by throughput, of equals by configuration."""
    r = reports.select(F.explode("results").alias("r")).select("r.*")
    mean = lambda c: F.col(f"{c}.mean")
    out = r.select("config.*", mean("throughput_stats").alias("mean_throughput"), (mean("throughput_stats") * seconds_each).alias("speedup_factor"), mean("elapsed_time_stats").alias("mean_time"), mean("cpu_stats").alias("mean_cpu"), mean("memory_stats").alias("mean_memory"), "iterations_successful", "iterations_requested")
    keys = [F.desc("speedup_factor"), "workers", "batch_size", "loader_threads", "use_float16"]
    return out.withColumn("rank", F.row_number().over(Window.orderBy(*keys)))  # a row for each configuration
