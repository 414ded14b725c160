"""Token ids as flat binary files with 64-bit document offsets.

Layout of a folder: for each block of consecutive document ids

* ``<name>.ids``: the ids of the block's documents, unsigned little-endian integers of two
  or four bytes, nothing else;
* ``<name>.offsets``: n + 1 signed 64-bit little-endian integers, where the n documents
  start in ``.ids`` and where the last ends, then n document ids of 64 bits;

and a table ``manifest`` of Spark's (block, name, documents, tokens, base, width): ``base``
is the number of ids in all blocks before, a prefix sum, so document i of a block starts at
``base + offsets[i]`` of the whole sequence.

A task writes files under a name of its own and the manifest lists the names of the tasks
whose results Spark kept: a repeated or lost attempt leaves files that nothing refers to.
Files are reached through Arrow's file systems, so the folder may be on any shared store;
on a mounted one they are memory-mapped.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import blocks, texts
from skyledger.llm.bpe import byte_level

#: Rows with the same text and id are documents of their own; a null id is stored as this one.
NULL_ID = blocks.LEAST

WRITTEN = "block int, name string, documents long, tokens long, width int"


def _open(folder: str):
    if "://" in folder or folder.startswith("file:"):
        system, path = fs.FileSystem.from_uri(folder)
    else:
        system, path = fs.LocalFileSystem(), folder
    return system, path.rstrip("/")


def _stored(folder: str, name: str):
    """A file for random reads: a memory map where the store is mounted."""
    system, path = _open(folder)
    if isinstance(system, fs.LocalFileSystem):
        return pa.memory_map(f"{path}/{name}")
    return system.open_input_file(f"{path}/{name}")


def _writer(folder: str, tokenizer: str, end_id: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, block, lengths, ids = byte_level(tokenizer), None, [], []
        end = np.array([] if end_id is None else [end_id], dtype=bpe.dtype)
        name = uuid.uuid4().hex
        system, path = _open(folder)
        out = None
        for batch in batches:
            for part in texts.sliced(batch):
                if out is None:
                    block = part.column("block")[0].as_py()
                    system.create_dir(path, recursive=True)
                    out = system.open_output_stream(f"{path}/{name}.ids")
                encoded = bpe.encode(part.column("text"))
                for x in encoded:
                    out.write(x.tobytes())
                    out.write(end.tobytes())
                lengths.append(np.fromiter(map(len, encoded), dtype="<i8", count=len(encoded)) + len(end))
                ids.append(part.column("order_id").to_numpy().astype("<i8"))
        if out is None:
            return
        out.close()
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype("<i8")
        with system.open_output_stream(f"{path}/{name}.offsets") as f:
            f.write(offsets.tobytes())
            f.write(np.concatenate(ids).tobytes())
        yield pa.RecordBatch.from_pydict(
            {"block": [block], "name": [name], "documents": [len(offsets) - 1], "tokens": [int(offsets[-1])], "width": [bpe.dtype.itemsize]},
            schema=pa.schema([("block", pa.int32()), ("name", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64()), ("width", pa.int32())]),
        )

    return write


def write(df: DataFrame, folder: str, tokenizer: str, end_id: int | None = 0) -> DataFrame:
    """Writes the ids of each row's whole ``text`` in ascending ``doc_id`` order; returns the manifest.

    ``tokenizer`` is the path of a byte-level vocabulary that every executor can read;
    ``end_id`` is put after each document. A null text is an empty one; null ids come first;
    rows with the same id are in the order of their texts. Other columns are ignored.
    """
    spark = df.sparkSession
    rows = df.select("doc_id", "text")
    placed = blocks.in_blocks(rows, blocks.bounds(rows)).select("block", "order_id", "text")
    found = placed.mapInArrow(_writer(f"{folder}/files", tokenizer, end_id), WRITTEN).collect()  # a row for each block
    found.sort(key=lambda r: r["block"])
    base, manifest = 0, []
    for r in found:
        manifest.append((*r, base))
        base += r["tokens"]
    table = spark.createDataFrame(manifest, f"{WRITTEN}, base long").coalesce(1)
    table.write.parquet(f"{folder}/manifest")
    return manifest_of(spark, folder)


def manifest_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{WRITTEN}, base long").parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str, each: Callable[[np.ndarray], int], name: str) -> DataFrame:
    """One row per document, from the files: doc_id, start in the whole sequence, n_tokens, ``each(ids)`` as ``name``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n = r["documents"]
                with _stored(f"{folder}/files", f"{r['name']}.offsets") as f:
                    numbers = np.frombuffer(f.read_buffer(), dtype="<i8")
                offsets, ids = numbers[: n + 1], numbers[n + 1 :]
                with _stored(f"{folder}/files", f"{r['name']}.ids") as f:
                    for at in range(0, n, 1 << 14):
                        part = offsets[at : min(at + (1 << 14), n) + 1]
                        values = []
                        for a, b in zip(part[:-1].tolist(), part[1:].tolist(), strict=True):
                            f.seek(a * r["width"])
                            values.append(each(np.frombuffer(f.read_buffer((b - a) * r["width"]), dtype=f"<u{r['width']}")))
                        keys = ids[at : at + len(values)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(keys, mask=keys == NULL_ID),
                                pa.array(r["base"] + part[:-1]),
                                pa.array(np.diff(part)),
                                pa.array(values, pa.int64()),
                            ],
                            names=["doc_id", "start", "n_tokens", name],
                        )

    manifest = manifest_of(spark, folder)
    count = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return manifest.repartitionById(count, "block").mapInArrow(rows, f"doc_id long, start long, n_tokens long, {name} long")


def ids_crc32(ids: np.ndarray) -> int:
    """Checksum of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def total_tokens(manifest: DataFrame) -> int:
    return manifest.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
