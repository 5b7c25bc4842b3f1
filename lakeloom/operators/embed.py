"""Embeddings (U1-U3 P26 P27 AG21), image download (S16) and resumable
embedding jobs (S12 S13).

* Text: the default encoder is signed feature hashing on Arrow batches: a token's
  MD5 digest gives its dimension and its sign, tokens are counted
  and the vector is normalized. It needs no model file, and SQL can compute it.
  Any other model is injected as a factory ``() -> encode(list[str]) ->
  ndarray``; it runs in ``mapInPandas``, is built once per Python worker and is
  fed ``batch_size`` texts at a time.
* Images: ``mapInArrow`` over the task table; downloads use a small thread
  pool per task with back-pressure, bounded slices and the retry rule 1 +
  ``retries`` attempts; a failure is a row with ``success = false``, the error
  text and the attempts, never a lost row.
* Resume: ``run_resumable`` reads finished ids back from the output table and
  removes them by an anti join; each run appends its own ``run_id`` partition
  and readers keep the newest row per id. ``runs.run_committed`` does it with a
  commit log and one scan of the input.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.frames import with_one_row
from lakeloom.operators.search import releasing

TEXT_MODEL = "signed-hash"
IMAGE_MODEL = "byte-histogram-256"

_WORKER_MODELS: dict[str, Callable] = {}


def _model(factory: Callable[[], Callable], name: str | None) -> Callable:
    """An injected model: of one name it is built once per Python worker
    process, without a name anew in each task."""
    if name is None:
        return factory()
    if name not in _WORKER_MODELS:
        _WORKER_MODELS[name] = factory()
    return _WORKER_MODELS[name]


def _unit_rows(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    n[n == 0] = 1.0
    return (m / n).astype(np.float32)


# -------------------------------------------------------------------- text
#: Tokens of the built-in encoder: runs without ASCII white space, A-Z lower-cased.
TOKEN = r"[^\x20\x09-\x0D]+"
#: Tokens of one task whose places are kept; a table that is full starts anew.
KEPT_TOKENS = 200_000


class _Places(dict):
    """Token -> its place: below ``dim`` with a positive sign, from there on with a negative one."""

    def __init__(self, dim: int) -> None:
        self.dim = dim

    def __missing__(self, token: bytes) -> int:
        digest = hashlib.md5(token, usedforsecurity=False).digest()
        at = int.from_bytes(digest[:4], "big") % self.dim
        if digest[4] >= 128:
            at += self.dim
        if len(self) >= KEPT_TOKENS:
            self.clear()
        self[token] = at
        return at


def _hashed(dim: int):
    """mapInArrow body: ``_text`` becomes ``_vec``."""

    def run(batches):
        places = _Places(dim)
        for b in batches:
            at = b.schema.get_field_index("_text")
            m = np.zeros((b.num_rows, dim))
            for i, text in enumerate(b.column(at)):
                # of bytes, lower() takes A-Z only and split() parts at ASCII white space only
                tokens = text.as_buffer().to_pybytes().lower().split() if text.is_valid else []
                if tokens:
                    n = np.bincount(np.fromiter(map(places.__getitem__, tokens), np.int64, len(tokens)), minlength=2 * dim)
                    m[i] = n[:dim] - n[dim:]
            flat = pa.array(_unit_rows(m).ravel())
            vec = pa.ListArray.from_arrays(pa.array(np.arange(0, b.num_rows * dim + 1, dim, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(b.columns) if i != at), vec], names=[*(n for n in b.schema.names if n != "_text"), "_vec"])

    return releasing(run)


def hashed_vectors(df: DataFrame, text_col: str, dim: int) -> DataFrame:
    """``df`` without its text and with ``_vec``: the unit vector of signed token counts. Of a
    token's MD5 the first 32 bits choose the dimension and the next one the sign; an empty or
    NULL text gives the zero vector. Words repeat, so a task hashes a token once."""
    rest = [f for f in df.schema.fields if f.name != text_col]
    schema = T.StructType([*rest, T.StructField("_vec", T.ArrayType(T.FloatType()))])
    return df.select(*[f.name for f in rest], F.col(text_col).cast("string").alias("_text")).mapInArrow(_hashed(dim), schema)


def embed_text(
    df: DataFrame,
    text_col: str,
    keep: Sequence[str],
    dim: int = 384,
    encoder_factory: Callable[[], Callable[[list[str]], np.ndarray]] | None = None,
    model_name: str | None = None,
    batch_size: int = 32,
) -> DataFrame:
    """(keep..., embedding_model, embedding_dimension, embedding)
    with unit-length float32 vectors. ``model_name`` stands for one injected
    encoder: workers keep the encoder of a name between tasks."""
    if dim <= 0 or batch_size <= 0:
        raise ValueError("dim and batch_size must be positive")
    if encoder_factory is None:
        vec = hashed_vectors(df.select(*keep, F.col(text_col).alias("_text")), "_text", dim)
        name = model_name or f"{TEXT_MODEL}-{dim}"
        return vec.select(*keep, F.lit(name).alias("embedding_model"), F.lit(dim).cast("int").alias("embedding_dimension"),
                          F.col("_vec").alias("embedding"))

    name = model_name or "injected"
    in_schema = df.select(*keep).schema
    out_schema = T.StructType(list(in_schema.fields) + [
        T.StructField("embedding_model", T.StringType()),
        T.StructField("embedding_dimension", T.IntegerType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ])

    def run(batches):
        encode = _model(encoder_factory, model_name)
        for pdf in batches:
            texts = pdf.pop("_text").fillna("").tolist()
            parts = [np.asarray(encode(texts[i:i + batch_size]), dtype=np.float64)
                     for i in range(0, len(texts), batch_size)]
            m = _unit_rows(np.vstack(parts)) if parts else np.zeros((0, dim), np.float32)
            pdf["embedding_model"] = name
            pdf["embedding_dimension"] = np.int32(m.shape[1] if len(m) else dim)
            pdf["embedding"] = list(m)
            yield pdf

    return df.select(*keep, F.col(text_col).alias("_text")).mapInPandas(run, out_schema)


def embed_query(spark, text: str, **kw) -> list[float]:
    """One query string through the same text pipeline."""
    if not text or not text.strip():
        raise ValueError("query must not be blank")
    df = spark.createDataFrame([(0, text)], "qid long, text string")
    row = embed_text(df, "text", ["qid"], **kw).first()
    return [float(x) for x in row["embedding"]]


# ------------------------------------------------------------------ images
def http_fetch(url: str, timeout: float = 10.0) -> bytes:
    """Default downloader (the cluster needs network access to the image host)."""
    import urllib.request

    with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
        return r.read()


def byte_histogram_encoder() -> Callable[[list[bytes]], np.ndarray]:
    """Built-in image encoder without model weights: 256-bin byte histogram."""

    def encode(blobs: list[bytes]) -> np.ndarray:
        return np.stack([np.bincount(np.frombuffer(b, dtype=np.uint8), minlength=256).astype(np.float64)
                         for b in blobs])

    return encode


def _download(fetch: Callable[[str], bytes], url: str, retries: int, max_bytes: int) -> tuple[bytes | None, str | None, int]:
    """(content, error, attempts): the first try and up to ``retries`` more."""
    err = None
    for attempt in range(1, 2 + retries):
        try:
            data = fetch(url)
            if not data:
                raise ValueError("empty content")
        except Exception as ex:  # noqa: BLE001 - every failure becomes a row
            err = f"{type(ex).__name__}: {ex}"
            continue
        if len(data) > max_bytes:  # another try would bring the same image
            return None, f"ValueError: image of {len(data)} bytes is over {max_bytes}", attempt
        return data, None, attempt
    return None, err, 1 + retries


def _in_flight(pool: ThreadPoolExecutor, work: Callable, items: Iterable, most: int) -> Iterator:
    """Results in order, with at most ``most`` items submitted and not yet taken: whoever takes
    them slowly holds the fetching back."""
    waiting: deque = deque()
    for item in items:
        if len(waiting) >= most:
            yield waiting.popleft().result()
        waiting.append(pool.submit(work, item))
    while waiting:
        yield waiting.popleft().result()


def embed_images(
    tasks: DataFrame,
    keep: Sequence[str],
    url_col: str = "image_url",
    content_col: str | None = None,
    fetch: Callable[[str], bytes] | None = None,
    encoder_factory: Callable[[], Callable[[list[bytes]], np.ndarray]] = byte_histogram_encoder,
    model_name: str = IMAGE_MODEL,
    threads: int = 16,
    retries: int = 2,
    batch_size: int = 32,
    slice_bytes: int = 64 << 20,
    max_bytes: int = 32 << 20,
) -> DataFrame:
    """One row per task with success, error, attempts and (on success) a
    unit float32 embedding. Content comes from ``content_col`` when the bytes are
    already in the table (a NULL or empty value is a failed download, an attempt
    all the same), else from ``fetch(url)``.

    Images stream through fetch, encode and output in slices of at most
    ``batch_size`` images or ``slice_bytes`` (a slice ends with the image that
    reaches it). At most ``threads`` images are being fetched or wait for the
    encoder, so a task holds ``threads + 1`` images of ``max_bytes`` besides a
    slice, whatever an Arrow batch holds; a larger image is an error row."""
    if min(threads, batch_size, slice_bytes, max_bytes) <= 0 or retries < 0:
        raise ValueError("threads, batch_size, slice_bytes and max_bytes must be positive, retries not negative")
    fetch = fetch or http_fetch
    cols = list(keep) + [url_col] + ([content_col] if content_col else [])
    in_schema = tasks.select(*keep, url_col).schema
    out_schema = T.StructType(list(in_schema.fields) + [
        T.StructField("success", T.BooleanType()),
        T.StructField("error", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("embedding_model", T.StringType()),
        T.StructField("embedding_dimension", T.IntegerType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ])
    names = out_schema.fieldNames()

    def given(content) -> tuple[bytes | None, str | None, int]:
        return _download(lambda _: content.as_buffer().to_pybytes() if content.is_valid else b"", "", 0, max_bytes)

    def run(batches):
        encode = _model(encoder_factory, model_name)

        def encoded(rows: pa.RecordBatch, got: list) -> pa.RecordBatch:
            vecs: list = [None] * len(got)
            ok = [i for i, (data, _, _) in enumerate(got) if data is not None]
            if ok:
                for i, vec in zip(ok, _unit_rows(np.asarray(encode([got[i][0] for i in ok]), dtype=np.float64)), strict=True):
                    vecs[i] = vec
            more = [
                pa.array([data is not None for data, _, _ in got]), pa.array([e for _, e, _ in got], pa.string()), pa.array([n for _, _, n in got], pa.int32()),
                pa.array([model_name] * len(got)), pa.array([None if v is None else len(v) for v in vecs], pa.int32()), pa.array(vecs, pa.list_(pa.float32()))]
            return pa.RecordBatch.from_arrays([*rows.columns, *more], names=names)

        with ThreadPoolExecutor(max_workers=threads) as pool:
            for b in batches:
                rows = b.select(names[: len(in_schema)])
                if content_col is not None:
                    results = map(given, b.column(content_col))
                else:
                    results = _in_flight(pool, lambda u: _download(fetch, u, retries, max_bytes), b.column(url_col).to_pylist(), threads)
                first, got, size = 0, [], 0
                for r in results:
                    got.append(r)
                    size += len(r[0] or b"")
                    if len(got) >= batch_size or size >= slice_bytes:
                        yield encoded(rows.slice(first, len(got)), got)
                        first, got, size = first + len(got), [], 0
                if got:
                    yield encoded(rows.slice(first, len(got)), got)

    return tasks.select(*cols).mapInArrow(run, out_schema)


def embedding_totals(results: DataFrame, tasks_without_image: DataFrame | None = None) -> DataFrame:
    """AG21: tasks, processed, failed, rows with a vector and the dimension."""
    ok = F.coalesce(F.col("success"), F.lit(True)) if "success" in results.columns else F.lit(True)
    out = results.agg(
        F.count(F.lit(1)).alias("tasks"),
        F.count_if(ok).alias("processed"),
        F.count_if(~ok).alias("failed"),
        F.count_if(F.col("embedding").isNotNull()).alias("rows_with_embedding"),
        F.max(F.size("embedding")).alias("embedding_dimension"),
    )
    if tasks_without_image is not None:
        n = tasks_without_image.agg(F.count(F.lit(1)).alias("products_without_image"))
        out = with_one_row(out, n)
    return out


# ------------------------------------------------------------------ resume
def pending(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``todo`` whose key is not in the finished output."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def run_resumable(
    todo: DataFrame,
    key: str,
    job: Callable[[DataFrame], DataFrame],
    out_path: str,
    run_id: int,
    parts: int = 1,
) -> DataFrame:
    """Process only the keys missing from ``out_path`` and append them as
    partition ``run_id``. Safe to re-run after a lost executor or a killed
    driver: finished work is never recomputed.

    With ``parts`` the missing keys are dealt by hash into that many writes,
    each a checkpoint: a run that is killed keeps all parts it has finished,
    and the next one starts with the rest. Each part filters the input anew."""
    if parts <= 0:
        raise ValueError("parts must be positive")
    spark = todo.sparkSession
    try:
        done = spark.read.parquet(out_path)
        rest = pending(todo, done, key)
    except AnalysisException as ex:
        if ex.getCondition() not in ("PATH_NOT_FOUND",):
            raise
        rest = todo  # first run: nothing written yet
    for part in range(parts):
        mine = rest.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part) if parts > 1 else rest
        job(mine).withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(out_path)
    return read_latest(spark, out_path, key)


def read_latest(spark, out_path: str, key: str) -> DataFrame:
    """S13 SO1 (K20): all part files as one table, newest run per key."""
    parts = spark.read.parquet(out_path)
    cols = [c for c in parts.columns if c not in (key, "run_id")]
    best = F.max(F.struct(F.col("run_id"), *[F.col(c) for c in cols])).alias("_b")
    return parts.groupBy(key).agg(best).select(key, *[F.col(f"_b.{c}").alias(c) for c in ["run_id", *cols]])


def compact(spark, out_path: str, key: str, target: str) -> None:
    """Merge all runs into one compacted table (newest row per key)."""
    read_latest(spark, out_path, key).write.mode("overwrite").option("compression", "zstd").parquet(target)
