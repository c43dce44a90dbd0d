"""User functions and external commands over partitions, and named functions."""

from __future__ import annotations

import contextlib
import io
import os
import pickle
import subprocess
import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Values shipped to every executor with a user function.
MAX_VARS_BYTES = 64 << 20


def pipe_rows(
    df: DataFrame,
    command: Sequence[str],
    id: str = "id",
    line: str = "line",
    run_timeout: float = 5.0,
    stop_timeout: float = 2.0,
) -> DataFrame:
    """Send lines through a command, one process per Arrow batch.

    Output and errors are merged. When the command succeeds and answers each
    line with one line, the answers carry the ids. Otherwise every id keeps a
    row with a null line, and the output follows with null ids.
    """
    id_type = df.schema[id].dataType.simpleString()
    argv = list(command)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = "".join(f"{value}\n" for value in batch[line].fillna(""))
            output, code, timed_out = _run(argv, text, run_timeout, stop_timeout)
            answers = output.split("\n")
            if answers[-1] == "":
                answers.pop()
            ids = batch[id].astype(object)
            if code == 0 and not timed_out and len(answers) == len(batch):
                out = pd.DataFrame({"id": ids, "line": answers})
            else:
                out = pd.concat([
                    pd.DataFrame({"id": ids}).assign(line=None),
                    pd.DataFrame({"id": pd.Series([None] * len(answers), dtype=object), "line": answers}),
                ])
            yield out.assign(returncode=code, timed_out=timed_out)

    schema = f"id {id_type}, line string, returncode int, timed_out boolean"
    return df.select(id, line).mapInPandas(run, schema)


def run_commands(
    df: DataFrame,
    command: str = "command",
    run_timeout: float = 5.0,
    stop_timeout: float = 2.0,
    env: Mapping[str, str | None] | None = None,
    cwd: str | None = None,
) -> DataFrame:
    """Run the shell command in each row; adds output, returncode and timed_out.

    A command past its time is terminated, and killed if it does not go. A null
    in ``env`` unsets the variable. Task retries repeat commands.
    """
    schema = T.StructType([
        *df.schema,
        T.StructField("output", T.StringType()),
        T.StructField("returncode", T.IntegerType()),
        T.StructField("timed_out", T.BooleanType()),
    ])
    overlay = dict(env or {})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            results = [
                _run(["bash", "-c", text], None, run_timeout, stop_timeout, overlay, cwd)
                for text in batch[command]
            ]
            output, codes, late = zip(*results) if results else ((), (), ())
            yield batch.assign(output=list(output), returncode=list(codes), timed_out=list(late))

    return df.mapInPandas(run, schema)


def _run(argv, text, run_timeout, stop_timeout, overlay=None, cwd=None):
    env = {**os.environ, **(overlay or {})}
    process = subprocess.Popen(
        argv,
        stdin=subprocess.DEVNULL if text is None else subprocess.PIPE,
        stdout=subprocess.PIPE,
        stderr=subprocess.STDOUT,
        text=True,
        env={k: v for k, v in env.items() if v is not None},
        cwd=cwd,
    )
    timed_out = False
    try:
        output, _ = process.communicate(text, run_timeout)
    except subprocess.TimeoutExpired:
        timed_out = True
        process.terminate()
        try:
            output, _ = process.communicate(timeout=stop_timeout)
        except subprocess.TimeoutExpired:
            process.kill()
            output, _ = process.communicate()
    return output, process.returncode, timed_out


def apply_with(
    df: DataFrame,
    fn: Callable,
    inputs: Sequence[str],
    vars: Mapping[str, object],
    result: str,
    max_tries: int = 1,
    pause: float = 0.0,
    retry_on: tuple[type[Exception], ...] = (Exception,),
    max_vars_bytes: int | None = None,
) -> DataFrame:
    """Call ``fn(*inputs, **vars)`` for each row, keeping what it returns and prints.

    Adds ``value`` of the SQL type ``result``, ``printed`` lines, ``attempts``
    and ``error_type``, which is null on success. The exceptions in ``retry_on``
    are retried up to ``max_tries`` calls in all; any other ends the row. The function gets
    plain Python values, whole numbers as such and nulls as None, and the columns of ``df``
    pass through as they are. ``max_vars_bytes``, by default ``MAX_VARS_BYTES``, bounds what is
    shipped to every executor.
    """
    spark = df.sparkSession
    packed = cloudpickle.dumps(dict(vars))
    most = MAX_VARS_BYTES if max_vars_bytes is None else max_vars_bytes
    if len(packed) > most:
        raise ValueError(f"vars take {len(packed)} bytes, more than {most}")
    shipped = spark.sparkContext.broadcast(packed)
    names = list(inputs)
    added = T.StructType.fromDDL(
        f"value {result}, printed array<string>, attempts int, error_type string"
    )
    schema = T.StructType([*df.schema, *added])

    def call(args, values):
        printed, error = [], None
        for attempt in range(1, max_tries + 1):
            out = io.StringIO()
            try:
                with contextlib.redirect_stdout(out):
                    value = fn(*args, **values)
                return value, printed + out.getvalue().splitlines(), attempt, None
            except Exception as e:
                printed += out.getvalue().splitlines()
                error = type(e).__name__
                if not isinstance(e, retry_on):
                    break
            if attempt < max_tries:
                time.sleep(pause)
        return None, printed, attempt, error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = pickle.loads(shipped.value)  # packed above by this very call
        types = [to_arrow_type(f.dataType) for f in added]
        for batch in batches:
            inputs = [batch.column(name).to_pylist() for name in names]
            done = [call(args, values) for args in zip(*inputs)] if inputs else [
                call((), values) for _ in range(batch.num_rows)
            ]
            columns = list(zip(*done)) if done else [(), (), (), ()]
            made = [pa.array(column, kind) for column, kind in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *added.names])

    return df.mapInArrow(run, schema)


def register_transform(
    spark: SparkSession, name: str, fn: Callable, result: str, force: bool = False
) -> str:
    """Make a pandas function callable from SQL by name.

    Registering a known name again changes nothing unless forced.
    """
    if force or not spark.catalog.functionExists(name):
        spark.udf.register(name, F.pandas_udf(fn, result))
    return name
