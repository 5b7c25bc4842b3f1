"""Token-id files (operator 4).

Texts are range-partitioned by id, so that partitions are consecutive runs of
documents. Each task encodes its documents (every distinct word once per
worker, see vocabulary.py) and writes a flat file of unsigned integers and a
small file of (id, length) pairs; a prefix sum over the partitions' totals
gives each partition its base; a second pass writes the 64-bit offsets.
Readers memory-map the three files of a partition.

Files of partition p in the folder:
  tokens-p.bin   ids, little-endian, 2 or 4 bytes each (see ``dtype``)
  offsets-p.bin  int64, position of each document's first id in the whole
                 corpus, then the position after the partition's last id
  docs-p.bin     int64 pairs (document id, number of ids)

Files are written under another name and renamed, so a task that runs twice
leaves one whole file. The folder is below the shared folder unless given.

Defined results: null and empty texts have the end id only; a null id sorts
first and is read back as null; rows repeating an id are ordered by text; an
empty table gives a folder without documents.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.base import NO_ID, id_of, shared_folder, text_of, written
from lakeloom.llm.vocabulary import encoder, id_type, read, share, split

_MANIFEST = "part int, n_docs long, n_tokens long"


def _place(folder: str):
    fs, path = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
    return fs, path


def _writer(folder: str, vocabulary, dtype: str, end_id: int):
    def run(batches):
        from pyspark import TaskContext

        enc = encoder(vocabulary.value, dtype)
        fs, path = _place(folder)
        fs.create_dir(path, recursive=True)
        part, mark = TaskContext.get().partitionId(), uuid.uuid4().hex
        names = [f"{path}/{kind}-{part:06d}.bin" for kind in ("tokens", "docs")]
        end, size = np.array([end_id], dtype).tobytes(), np.dtype(dtype).itemsize
        n_docs = n_tokens = 0
        with fs.open_output_stream(f"{names[0]}.{mark}") as tokens, fs.open_output_stream(f"{names[1]}.{mark}") as docs:
            for b in batches:
                pairs = np.empty((b.num_rows, 2), "<i8")
                pairs[:, 0] = b.column("doc").to_numpy(zero_copy_only=False)
                for i, t in enumerate(b.column("text")):
                    words = split(t.as_py())
                    known = enc.learn(set(words))
                    raw = b"".join([known[w] for w in words]) + end
                    tokens.write(raw)
                    pairs[i, 1] = len(raw) // size
                docs.write(pairs.tobytes())
                n_docs, n_tokens = n_docs + b.num_rows, n_tokens + int(pairs[:, 1].sum())
        for name in names:
            fs.move(f"{name}.{mark}", name)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n_docs], pa.int64()), pa.array([n_tokens], pa.int64())], names=["part", "n_docs", "n_tokens"])

    return run


def _offsets(folder: str):
    def run(batches):
        fs, path = _place(folder)
        for b in batches:
            for row in b.to_pylist():
                with fs.open_input_file(f"{path}/docs-{row['part']:06d}.bin") as f:
                    n = np.frombuffer(f.read(), "<i8").reshape(-1, 2)[:, 1]
                name = f"{path}/offsets-{row['part']:06d}.bin"
                with fs.open_output_stream(mark := f"{name}.{uuid.uuid4().hex}") as out:
                    out.write((row["base"] + np.concatenate([[0], np.cumsum(n)])).astype("<i8").tobytes())
                fs.move(mark, name)
            yield b

    return run


def write_token_files(docs: DataFrame, vocabulary_path: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[str, str, DataFrame]:
    """Writes the files; returns (folder, dtype, manifest of (part, n_docs, n_tokens, base))."""
    spark = docs.sparkSession
    content = read(vocabulary_path)
    dtype = id_type(content)
    folder = folder or shared_folder(spark, "tokens")
    rows = docs.select(F.coalesce(id_of(id_col), F.lit(NO_ID)).alias("doc"), text_of(text_col).alias("text"))
    ranged = rows.repartitionByRange("doc").sortWithinPartitions("doc", "text")
    parts = written(ranged.mapInArrow(_writer(folder, share(spark, content), dtype, end_id), _MANIFEST), "token-parts")
    # one row a partition: its number bounds this prefix sum
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    manifest = written(based.repartition(F.col("part")).mapInArrow(_offsets(folder), f"{_MANIFEST}, base long"), "token-manifest")
    return folder, dtype, manifest


def _reader(folder: str, dtype: str):
    def run(batches):
        fs, path = _place(folder)

        def mapped(kind, part):
            name = f"{path}/{kind}-{part:06d}.bin"
            if not isinstance(fs, pafs.LocalFileSystem):
                return fs.open_input_file(name).read_buffer()
            with pa.memory_map(name) as m:
                return m.read_buffer()

        for b in batches:
            for row in b.to_pylist():
                if not row["n_docs"]:
                    continue
                docs = np.frombuffer(mapped("docs", row["part"]), "<i8").reshape(-1, 2)
                offsets = np.frombuffer(mapped("offsets", row["part"]), "<i8")
                tokens = np.frombuffer(mapped("tokens", row["part"]), dtype)
                at = offsets - offsets[0]
                for i in range(0, len(docs), 1024):
                    ids = docs[i : i + 1024, 0]
                    raw = [tokens[at[k] : at[k + 1]].astype("<u4").tobytes() for k in range(i, i + len(ids))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64(), mask=ids == NO_ID), pa.array(offsets[i : i + len(ids)], pa.int64()), pa.array([len(x) // 4 for x in raw], pa.int64()), pa.array([zlib.crc32(x) for x in raw], pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return run


def read_digests(folder: str, dtype: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the mapped files."""
    return manifest.repartition(F.col("part")).mapInArrow(_reader(folder, dtype), "doc_id long, start long, n_tokens long, ids_crc32 long")
