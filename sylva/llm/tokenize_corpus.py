"""Encoding of a whole corpus with a public tokenizer, through a table of distinct words.

1. Spark splits the texts into words with the tokenizer's own pattern. Tasks gather documents to blocks and
   keep a block as its distinct words and, for each document, the places of its words among them.
2. Distinct words of all blocks form one table; each word is encoded once.
3. Ids join back by (block, place), and each block's documents are put together from them.

What is shuffled are the distinct words of blocks, not the words of the corpus: a word occurs at most once a block, so frequent
words don't make hot groups.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.session import written

#: Fixed value: white space as the tokenizer's pattern means it (Unicode White_Space; Java's \s is ASCII only).
_SPACE = r"\u0009-\u000d\u0020\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: the public byte-level pattern, with that white space.
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


@dataclass(frozen=True)
class TokenizerParams:
    """``ranks``: a rank file (base64 piece and id on each line) that every executor can read; ``block_words`` bounds a block."""

    ranks: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    block_words: int = 1_000_000
    null_ids: tuple[int, ...] = ()


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    # every word already is one piece of the split, so the pattern takes it whole
    return tiktoken.Encoding("sylva", pat_str=r"[\s\S]+", mergeable_ranks=read_ranks(path), special_tokens={})


def _blocks(block_words: int):
    schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("places", pa.binary()), ("words", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        ids: list[pa.Array] = []
        lists: list[pa.Array] = []

        def block() -> pa.RecordBatch:
            nonlocal made
            words = pa.chunked_array([x.flatten() for x in lists], pa.string()).combine_chunks()
            words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
            coded = words.dictionary_encode()
            sizes = np.concatenate([pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False) for x in lists]).astype(np.int32)
            places = pa.compress(coded.indices.to_numpy().astype("<u4").tobytes(), codec="zstd", asbytes=True)
            row = [[base + made], [pa.chunked_array(ids).to_pylist()], [sizes], [places], [coded.dictionary]]
            made += 1
            cols = [pa.array(row[0], pa.int64()), pa.array(row[1], pa.list_(pa.int64())), pa.array(row[2], pa.list_(pa.int32())), pa.array(row[3], pa.binary())]
            offsets = pa.array([0, len(coded.dictionary)], pa.int32())
            cols.append(pa.ListArray.from_arrays(offsets, coded.dictionary))
            return pa.RecordBatch.from_arrays(cols, schema=schema)

        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # small steps keep a block near its bound
                part = batch.slice(at, 256)
                ids.append(part.column(0))
                lists.append(part.column(1))
                held += len(part.column(1).flatten())
                if held >= block_words:
                    yield block()
                    ids, lists, held = [], [], 0
        if ids:
            yield block()

    return run


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(path).encode_ordinary
        for batch in batches:
            words = batch.column(0)
            yield pa.RecordBatch.from_arrays([words, pa.array([encode(w) for w in words.to_pylist()], pa.list_(pa.int32()))], names=["word", "ids"])

    return run


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's documents from (doc_ids, sizes, places) and its table (place, ids)."""
    for batch in batches:
        for r in range(batch.num_rows):
            row = batch.slice(r, 1)
            doc_ids, sizes = row.column("doc_ids").flatten(), row.column("sizes").flatten().to_numpy()
            table = row.column("table").flatten()
            place, ids = table.field("place").to_numpy(), table.field("ids")
            length = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = ids.flatten().to_numpy()
            start = np.concatenate([[0], np.cumsum(length)[:-1]]) if len(length) else np.zeros(0, np.int64)
            first, count = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
            first[place], count[place] = start, length
            total = int(sizes.sum())
            blob = row.column("places")[0].as_py()
            places = np.frombuffer(pa.decompress(blob, total * 4, codec="zstd", asbytes=True), "<u4") if total else np.zeros(0, np.int64)
            n = count[places]
            ends = np.cumsum(n)
            at = np.arange(int(ends[-1]) if total else 0) - np.repeat(ends - n, n) + np.repeat(first[places], n)
            words_at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            offsets = np.concatenate([[0], ends])[words_at].astype(np.int32)
            yield pa.RecordBatch.from_arrays([doc_ids, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[at].astype(np.int32)))], names=["doc_id", "ids"])


def encode_corpus(documents: DataFrame, params: TokenizerParams = TokenizerParams(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``, one row for each row of ``documents``, without special tokens.

    An empty text has no ids; a null text has ``null_ids`` (none by default). Strings that look like special tokens
    are ordinary text. Repeated ids and texts keep their rows; null ids stay null. An empty table gives no rows.
    Texts of any length are encoded whole.
    """
    source = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.regexp_extract_all(F.col(text_col), F.lit(WORDS), F.lit(0)).alias("w"))
    if params.null_ids:
        source = source.where(F.col("w").isNotNull())
    blocks = written(source.mapInArrow(_blocks(params.block_words), "block bigint, doc_ids array<bigint>, sizes array<int>, places binary, words array<string>"))
    listed = blocks.select("block", F.posexplode("words").alias("place", "word"))
    words = listed.select("word").distinct().mapInArrow(_encode(params.ranks), "word string, ids array<int>")
    table = listed.join(words, "word").groupBy("block").agg(F.collect_list(F.struct("place", "ids")).alias("table"))
    empty = F.expr("cast(array() as array<struct<place: int, ids: array<int>>>)")
    whole = blocks.select("block", "doc_ids", "sizes", "places").join(table, "block", "left").withColumn("table", F.coalesce("table", empty))
    out = whole.select("doc_ids", "sizes", "places", "table").mapInArrow(_assemble, "doc_id bigint, ids array<int>")
    if params.null_ids:
        nulls = F.array(*[F.lit(i) for i in params.null_ids])
        out = out.unionByName(documents.where(F.col(text_col).isNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), nulls.alias("ids")))
    return out


def piece_table(spark: SparkSession, params: TokenizerParams = TokenizerParams()) -> DataFrame:
    """``(id, piece)``: as many rows as the vocabulary, a fixed bound."""
    ranks = read_ranks(params.ranks)
    return spark.createDataFrame([(i, bytearray(piece)) for piece, i in ranks.items()], "id int, piece binary")


def decode_corpus(encoded: DataFrame, params: TokenizerParams = TokenizerParams()) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)`` by a join of ids with their pieces; each row of ``encoded`` must have its own doc_id.

    The piece table is broadcast: its size is the vocabulary's. Documents without ids have the empty text.
    Raises for an id outside the vocabulary.
    """
    pieces = F.broadcast(piece_table(encoded.sparkSession, params))
    listed = encoded.select("doc_id", F.posexplode_outer("ids").alias("pos", "id")).join(pieces, "id", "left")
    known = F.when(F.col("id").isNotNull() & F.col("piece").isNull(), F.raise_error(F.concat(F.lit("no piece for id "), F.col("id").cast("string")))).otherwise(F.hex("piece"))
    joined = listed.select("doc_id", "pos", known.alias("hex")).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.when(F.col("hex").isNotNull(), F.struct("pos", "hex")))).alias("p"))
    return joined.select("doc_id", F.decode(F.unhex(F.array_join(F.transform("p", lambda x: x["hex"]), "")), "UTF-8").alias("text"))
