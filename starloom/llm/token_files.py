"""Token-ID files with a shared zstandard dictionary.

A data set is a folder::

    dictionary.bin          the zstandard dictionary
    data/part-NNNNN-A.bin   one per range of doc_id: a 48-byte header (magic,
                            version, SHA-256 of the dictionary), then one frame
                            per document
    index/*.parquet         doc_id, part, file, start (ids before the document
                            in its part), n_tokens, offset and size of its frame
    parts/*.parquet         part, start (ids before the part), n_tokens

Each frame is one document's ids, little-endian unsigned 32-bit numbers,
compressed by itself with the shared dictionary, so that a single document is
read with one small range read. The dictionary is what makes short documents
small: it is trained on serialized id arrays of a bounded, hash-chosen sample
of documents (``dictionary_docs``, ``dictionary_bytes`` of each at most); it
changes sizes only, never contents.

Data files are written by tasks through pyarrow's file systems under a name of
their own and named by the index, which Spark commits; files of tasks that
failed are in no index and are removed at the end.
"""

from __future__ import annotations

import hashlib
import uuid
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import few_rows_at_once, scratch, ship
from .tokens import column_stretches, encoder, place

MAGIC, VERSION = b"TOKZDICT", 1
INDEX = "doc_id long, part int, file string, start long, n_tokens long, offset long, size long"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and its path there."""
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:") and not path.startswith("file://"):
            path = "file://" + path[len("file:"):]
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def header(dictionary: bytes) -> bytes:
    return MAGIC + VERSION.to_bytes(8, "little") + hashlib.sha256(dictionary).digest()


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def train_dictionary(docs: DataFrame, *, doc_id: str, text: str, end_id: int,
                     tokenizer: str | None, dictionary_docs: int, dictionary_bytes: int,
                     dictionary_size: int) -> bytes:
    """A dictionary from about ``dictionary_docs`` distinct texts, those with
    the smallest hashes. Empty, with a warning, where there is too little to
    train on; the files' header then holds the hash of an empty dictionary."""
    hashed = docs.select(F.col(text).cast("binary").alias("t"), F.xxhash64(F.col(text)).alias("h"))
    least = hashed.select("h").distinct().orderBy("h").limit(dictionary_docs)
    some = hashed.join(F.broadcast(least), "h", "left_semi").groupBy("h").agg(F.first("t").alias("t")).select("t")

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(place(tokenizer))
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            made = [(x + end)[:dictionary_bytes] for x in encode(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["ids"])

    samples = [bytes(r[0]) for r in some.mapInArrow(ids, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(dictionary_size, sorted(samples)).as_bytes()
    except zstandard.ZstdError as e:  # too few samples
        warnings.warn(f"no dictionary could be trained on {len(samples)} texts: {e}", stacklevel=2)
        return b""


@dataclass(frozen=True)
class TokenFiles:
    """A written data set."""
    spark: SparkSession
    path: str

    def _dict(self) -> bytes:
        fs, root = _open(self.path)
        with fs.open_input_stream(f"{root}/dictionary.bin") as f:
            return f.read()

    def index(self) -> DataFrame:
        return self.spark.read.schema(INDEX).parquet(f"{self.path}/index")

    def parts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/parts")

    def read(self) -> DataFrame:
        """All documents from the files: doc_id, start (ids of all documents
        before it), n_tokens and ids (little-endian unsigned 32-bit)."""
        path = self.path

        def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fs, root = _open(path)
            with fs.open_input_stream(f"{root}/dictionary.bin") as f:
                dictionary = f.read()
            decompress = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress
            at, source = None, None
            for batch in batches:
                for k in range(0, batch.num_rows, 256):
                    rows = batch.slice(k, 256).to_pylist()
                    ids = []
                    for r in rows:
                        if r["file"] != at:
                            if source is not None:
                                source.close()
                            at, source = r["file"], fs.open_input_file(f"{root}/data/{r['file']}")
                            if source.read_at(48, 0) != header(dictionary):
                                raise ValueError(f"{at} was not written with this dictionary")
                        ids.append(decompress(source.read_at(r["size"], r["offset"]),
                                              max_output_size=4 * r["n_tokens"]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["doc_id"] for r in rows], pa.int64()),
                         pa.array([r["start"] for r in rows], pa.int64()),
                         pa.array([r["n_tokens"] for r in rows], pa.int64()),
                         pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])
            if source is not None:
                source.close()

        base = self.parts().select("part", F.col("start").alias("base"))
        # a part's rows stay together, so that a task opens few files; parts are of even size
        rows = self.index().join(base, "part").withColumn("start", F.col("start") + F.col("base"))
        rows = rows.repartition("file").sortWithinPartitions("file", "offset")
        return rows.mapInArrow(load, "doc_id long, start long, n_tokens long, ids binary")

    def document(self, doc_id: int) -> np.ndarray | None:
        """The ids of one document, by one index look-up and one range read."""
        found = self.index().where(F.col("doc_id") == doc_id).limit(1).collect()
        if not found:
            return None
        fs, root = _open(self.path)
        with fs.open_input_file(f"{root}/data/{found[0].file}") as f:
            frame = f.read_at(found[0].size, found[0].offset)
        raw = zstandard.ZstdDecompressor(dict_data=_dictionary(self._dict())).decompress(
            frame, max_output_size=4 * found[0].n_tokens)
        return np.frombuffer(raw, "<u4")


def write_token_files(docs: DataFrame, path: str | None = None, *, end_id: int = 2,
                      doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
                      level: int = 3, dictionary_docs: int = 1000, dictionary_bytes: int = 16_384,
                      dictionary_size: int = 65_536) -> TokenFiles:
    """Write ``docs`` in ascending doc_id order (NULLs first; equal ids by the
    hash of their text) below ``path``, a folder that all executors share
    (None: a new one in the checkpoint folder).

    A NULL or empty text is the end id alone. Repeated rows are written as
    often as they occur. An empty table gives an empty data set. Other columns
    are not read."""
    spark = ship(docs.sparkSession)
    path = path or scratch(spark, "token-files")
    dictionary = train_dictionary(
        docs, doc_id=doc_id, text=text, end_id=end_id, tokenizer=tokenizer,
        dictionary_docs=dictionary_docs, dictionary_bytes=dictionary_bytes,
        dictionary_size=dictionary_size)
    fs, root = _open(path)
    fs.create_dir(f"{root}/data", recursive=True)
    with fs.open_output_stream(f"{root}/dictionary.bin") as f:
        f.write(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(path)
        encode, end = encoder(place(tokenizer)), np.asarray([end_id], "<u4").tobytes()
        # the file's header names the dictionary, so the frames needn't
        compress = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(dictionary),
                                            write_dict_id=False).compress
        part = TaskContext.get().partitionId()
        name = f"part-{part:05d}-{uuid.uuid4().hex[:12]}.bin"
        out, offset, start = None, 48, 0
        for batch in batches:
            for k, to in column_stretches(batch.column(1)):
                keys = batch.column(0).slice(k, to - k)
                ids = [x + end for x in encode(batch.column(1).slice(k, to - k).to_pylist())]
                frames = [compress(x) for x in ids]
                if out is None:
                    out = fs.open_output_stream(f"{root}/data/{name}")
                    out.write(header(dictionary))
                out.write(b"".join(frames))
                n, size = [len(x) // 4 for x in ids], [len(x) for x in frames]
                starts = start + np.concatenate([[0], np.cumsum(n)])
                offsets = offset + np.concatenate([[0], np.cumsum(size)])
                start, offset = int(starts[-1]), int(offsets[-1])
                m = len(n)
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array([part] * m, pa.int32()), pa.array([name] * m),
                     pa.array(starts[:-1], pa.int64()), pa.array(n, pa.int64()),
                     pa.array(offsets[:-1], pa.int64()), pa.array(size, pa.int64())],
                    ["doc_id", "part", "file", "start", "n_tokens", "offset", "size"])
        if out is not None:
            out.close()

    order = [F.col("_id"), F.xxhash64("_text")]
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).cast("binary").alias("_text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    with few_rows_at_once(spark):
        rows.mapInArrow(write, INDEX).write.parquet(f"{path}/index")
    made = TokenFiles(spark, path)
    # one row per part, of which there are as many as tasks
    counts = sorted(made.index().groupBy("part", "file").agg(F.sum("n_tokens")).collect())
    starts = np.concatenate([[0], np.cumsum([c[2] for c in counts])]).astype(int).tolist()
    spark.createDataFrame([(c[0], s, c[2]) for c, s in zip(counts, starts, strict=False)],
                          "part int, start long, n_tokens long").coalesce(1).write.parquet(f"{path}/parts")
    kept = {c[1] for c in counts}
    for info in fs.get_file_info(pafs.FileSelector(f"{root}/data")):
        if info.base_name.endswith(".bin") and info.base_name not in kept:
            fs.delete_file(info.path)
    return made
