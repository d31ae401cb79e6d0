"""Pins of files of any size: SHA-256 of each file's bytes, streamed in one task, and one digest of a whole folder.

A hash of a file is sequential, so each file is one task and never a value: the
task reads the file's lines one after the other and feeds them to the hash with
their line ends. Files are hashed side by side. The lines of a file say everything
about its bytes but two things, a byte order mark at its begin and a line end at its
end; what its length leaves over after the lines tells which of them is there.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.expressions import digest_of
from tallyframe.plans.sizing import SCAN

_OPEN_COST = "spark.sql.files.openCostInBytes"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_MARK = b"\xef\xbb\xbf"
#: Endings by which Spark's text reader takes a file for compressed; their bytes are not what it reads.
PACKED = ("bz2", "deflate", "gz", "lz4", "snappy", "zst")
#: Bytes of lines that travel to the task, and that the hash is fed with, at once.
FEED = 4 << 20


def _files(spark: SparkSession, path: str, kind: str, names: str = "*") -> DataFrame:
    """Files below path with the columns path and length of their own, written alike for every kind of reader."""
    read = spark.read.format(kind).option("recursiveFileLookup", True).option("pathGlobFilter", names)
    # the line end is given, so that \r stays
    frame = (read.option("lineSep", "\n") if kind == "text" else read).load(path)
    return frame.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"), "*" if kind == "text" else "content")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, sha256) of each file, whose lines come one after the other as (path, length, line)."""
    path = length = plain = marked = None
    size = -1

    def ended() -> pa.RecordBatch:
        left = length - max(size, 0)
        if left not in (0, 1, 3, 4):
            raise ValueError(f"{path} was not read in one piece, or changed meanwhile: {length} bytes listed, {size} read")
        digest = marked if left > 2 else plain
        if left % 3 == 1:
            digest.update(b"\n")
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([digest.hexdigest()])], ["path", "sha256"])

    for batch in batches:
        paths = batch.column(0).dictionary_encode()
        names, which = paths.dictionary.to_pylist(), paths.indices.to_pylist()
        lines, lo = batch.column(2).cast(pa.binary()), 0
        ends = lines.offsets.to_pylist() if hasattr(lines, "offsets") else None
        while lo < len(which):
            hi = lo + 1
            while hi < len(which) and which[hi] == which[lo] and (ends is None or ends[hi] - ends[lo] < FEED):
                hi += 1
            if names[which[lo]] != path:
                if path is not None:
                    yield ended()
                path, length, size = names[which[lo]], batch.column(1)[lo].as_py(), -1
                plain, marked = hashlib.sha256(), hashlib.sha256(_MARK)
            block = (b"" if size < 0 else b"\n") + b"\n".join(lines.slice(lo, hi - lo).to_pylist())
            plain.update(block)
            marked.update(block)
            size, lo = max(size, 0) + len(block), hi
    if path is not None:
        yield ended()


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of every file below path that is not empty: the SHA-256 that any tool gives for the file.

    A task holds some lines of one file at a time, whatever the file's size; a line
    may have 2 GB. Files that the text reader would unpack are read whole instead,
    and can't be larger than 2 GB themselves. A file that is not read in one piece is
    an error, not another hash.
    """
    # a session of its own, in which a scan neither splits a file nor packs two into one task
    own = spark.newSession()
    largest = _files(own, path, "binaryFile").agg(F.coalesce(F.max("length"), F.lit(0))).first()[0]
    for name in (SCAN, _OPEN_COST):
        own.conf.set(name, str(max(largest, 1)))
    own.conf.set(_BATCH_BYTES, str(FEED))
    packed = F.substring_index("path", ".", -1).isin(*PACKED)
    # Spark hands bytes of any kind through as text
    lines = _files(own, path, "text").where(~packed).select("path", "length", F.col("value").cast("binary").alias("line"))
    found = lines.mapInArrow(_hashed, "path string, sha256 string")
    whole = _files(own, path, "binaryFile", "*.{" + ",".join(PACKED) + "}").select("path", F.sha2("content", 256).alias("sha256"))
    listing = _files(own, path, "binaryFile").select("path", "length")
    # nothing but a byte order mark has no lines
    bare = F.when(F.col("length") == len(_MARK), F.lit(hashlib.sha256(_MARK).hexdigest()))
    answer = found.unionAll(whole).withColumnRenamed("path", "of")
    return listing.join(answer, F.col("path") == F.col("of"), "left").select("path", "length", F.coalesce("sha256", bare).alias("sha256"))


def manifest(hashes: DataFrame) -> DataFrame:
    """One row (files, bytes, digest, sha256) of file_hashes().

    digest covers the path of each file below their common folder and its hash, in no
    order, so that neither the folder's place nor the listing decides. sha256 is the
    hash of the file if there is one only. No list of files is gathered.
    """
    # the common folder of all paths is that of the first and the last
    ends = hashes.agg(F.coalesce(F.min("path"), F.lit("")).alias("least"), F.coalesce(F.max("path"), F.lit("")).alias("most")).first()
    folder = os.path.commonpath([ends.least, ends.most]) if ends.least != ends.most else os.path.dirname(ends.least)
    inner = F.substring("path", F.lit(len(folder) + 2), F.length("path"))
    named = hashes.withColumn("named", F.sha2(F.concat_ws("\n", inner, "sha256"), 256))
    return named.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), digest_of(F.col("named")).alias("digest"),
        F.when(F.count("*") == 1, F.max("sha256")).alias("sha256"),
    )


def source_pin(spark: SparkSession, path: str) -> str:
    """What pins the bytes below path: the SHA-256 of a single file, the manifest digest of several; ValueError without any."""
    found = manifest(file_hashes(spark, path)).first()
    if not found.files:
        raise ValueError(f"{path} has no file to pin")
    return found.sha256 or found.digest
