"""Token counts by separator scan over flat token files without an index.

A token file is a run of little-endian unsigned ids, documents divided by an end-of-document id. Files are cut into
blocks of equal size wherever that falls; each block is searched at once by numpy for the end id, and yields its
count, its first and last end and the lengths between. A prefix scan over a file's blocks then gives every
block the number of documents before it and the last end before it, which stitches documents across blocks.

``write_tokens`` makes such files from documents with a public tokenizer (its folder is a parameter) and a side table
(shard, ordinal, doc_id); a file is renamed into place when whole, and a second attempt of its task writes the same
bytes. Memory is bounded by a block when reading and by a batch of texts when writing.

Defined cases: null and empty texts are documents of 0 tokens; ids after a file's last end are a last document; an
empty table has no file and gives no rows; repeated rows are separate documents; extra columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import files
from .common import cut, fresh_path

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
END = 50256
ID_BYTES = 2
BLOCK = 8 << 20
#: Fixed value: the pre-tokenizer pattern of the vocabulary file.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def write_tokens(docs: DataFrame, folder: str, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """Writes a token file per partition under ``folder``; returns the written side table (shard, ordinal, doc_id)."""

    def encode(batches: Iterator) -> Iterator:
        import base64

        import numpy as np
        import pyarrow as pa
        import tiktoken
        from pyspark import TaskContext

        with open(f"{tokenizers}/{vocabulary}", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        context = TaskContext.get()
        shard, out, n = context.partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or files.AtomicFile(f"{folder}/{shard:06d}.bin", context.taskAttemptId())
            for text in batch.column(1):
                ids = own.encode_ordinary(text.as_py() or "")
                out.write(np.array([*ids, END], f"<u{ID_BYTES}").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([shard] * batch.num_rows, pa.int64()), pa.array(range(n, n + batch.num_rows), pa.int64()), batch.column(0)], ["shard", "ordinal", "doc_id"])
            n += batch.num_rows
        if out:
            out.close()

    return cut(docs.select("doc_id", "text").mapInArrow(encode, f"shard bigint, ordinal bigint, doc_id {dict(docs.dtypes)['doc_id']}"), "tokens-side")


def scan_blocks(spark: SparkSession, folder: str, end: int = END, id_bytes: int = ID_BYTES, block: int = BLOCK) -> DataFrame:
    """(shard, block, ids, ends, first, last, inner) per block of the token files: positions are in ids from the file's
    start, inner the lengths of documents between the block's ends."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select("path", "length")
    blocks = listed.select("path", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("length") / block) - 1, F.lit(0).cast("bigint")))).alias("block"))

    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for x in batch.to_pylist():
                fs, path = files.filesystem(x["path"])
                with fs.open_input_file(path) as f:
                    data = f.read_at(min(block, x["length"] - x["block"] * block), x["block"] * block)
                ids = np.frombuffer(data, f"<u{id_bytes}", len(data) // id_bytes)
                at = np.flatnonzero(ids == end) + x["block"] * (block // id_bytes)
                row = {"shard": int(path.rpartition("/")[2].split(".")[0]), "block": x["block"], "ids": len(ids), "ends": len(at), "first": int(at[0]) if len(at) else None, "last": int(at[-1]) if len(at) else None, "inner": (np.diff(at) - 1).tolist()}
                yield pa.RecordBatch.from_pylist([row], pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("ids", pa.int64()), ("ends", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("inner", pa.list_(pa.int64()))]))

    n = max(1, spark.sparkContext.defaultParallelism * 2)
    return blocks.repartition(n, "path", "block").mapInArrow(search, "shard bigint, block bigint, ids bigint, ends bigint, first bigint, last bigint, inner array<bigint>")


def stitch(blocks: DataFrame) -> DataFrame:
    """(shard, ordinal, n_tokens) of every document, from the blocks of ``scan_blocks``."""
    up = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("shard")
    b = blocks.withColumns({"before": F.coalesce(F.sum("ends").over(up), F.lit(0)), "open": F.coalesce(F.last("last", True).over(up), F.lit(-1).cast("bigint")) + 1, "size": F.sum("ids").over(every), "top": F.max("block").over(every), "last_end": F.max("last").over(every)})
    whole = b.where("ends > 0").select("shard", "before", F.posexplode(F.concat(F.array(F.col("first") - F.col("open")), "inner")).alias("k", "n_tokens"))
    whole = whole.select("shard", (F.col("before") + F.col("k")).alias("ordinal"), "n_tokens")
    tail = b.where("block = top").select("shard", (F.col("before") + F.col("ends")).alias("ordinal"), (F.col("size") - F.coalesce(F.col("last_end") + 1, F.lit(0))).alias("n_tokens"))
    return whole.unionByName(tail.where("n_tokens > 0"))


def count_tokens(docs: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """(doc_id, n_tokens) per row of documents, by way of token files in the shared folder."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "tokens")
    side = write_tokens(docs, folder, tokenizers)
    if side.isEmpty():
        return side.select("doc_id", F.lit(0).cast("bigint").alias("n_tokens"))
    counts = stitch(cut(scan_blocks(spark, folder), "token-blocks"))
    return side.join(counts, ["shard", "ordinal"]).select("doc_id", "n_tokens")


cloudpickle.register_pickle_by_value(files)
cloudpickle.register_pickle_by_value(sys.modules[__name__])
