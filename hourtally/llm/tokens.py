"""Token ids in Parquet, laid out for reading some of it.

A row is a document: its ids as a list column in dictionary or delta encoding (format
version 2), its number of ids, and where it starts among the ids of its part. Parts follow
each other in the order asked for, one file each (or a few). Row groups and pages have set
sizes and a page index, so a reader of some documents opens few pages, and a reader of
counts opens no ids at all.

A null text is an empty one: its ids are the end id alone. Rows of equal order are ordered by
their texts; repeated rows are repeated. Other columns of the documents are not written.

A text is encoded word by word if the tokenizer drops white space, so that no token crosses
a blank or a line end; another tokenizer gets whole texts. The words of a batch are told apart first, and each is looked
up once for the batch. A task keeps a bounded number of runs of letters in lower case, and of words that are no such runs, with
their ids; the tokenizer's own model gives the ids of a run that is new.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

END_ID = 2
# Words and runs of letters kept with their ids, together; longer ones are encoded each time.
KEPT_WORDS = 500_000
LONGEST_KEPT = 48
# Ids of a batch of rows on their way to the file.
BATCH_IDS = 1 << 20

LAYOUT = {
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "true",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}
FILES = "part int, place long, doc_id long, start long, n_tokens long, tokens array<int>"


# Signs that are one piece to the tokenizer when they follow letters: all of ASCII but the apostrophe.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LETTERS_AND_SIGNS = f"\\A(?P<letters>[A-Za-zªµºÀ-ÖØ-öø-ÿ]+)(?P<signs>[{re.escape(SIGNS)}]*)\\z"


class _Words(dict):
    """The ids of words, by word; those of a new word are found when it is asked for.

    A word of letters, with or without signs after them, is put together from ``pieces``, the ids of
    runs of letters in lower case, and those of the signs.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces: dict[str, bytes] = {}
        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(256) if chr(c).isalpha() and not chr(c).isupper()]
        self.spelling = str.maketrans({x: spell.pre_tokenize_str(x)[0][0] for x in letters})
        apart = [b"".join(self.whole(x.split())) for x in ("a b", "One,\nTwo three")]
        self.by_words = apart == self.whole(["a b", "One,\nTwo three"])
        sample = ["word", "Übergrößen", "a", "élève", "zzyzx", "µªº"]
        self.by_pieces = self.by_words and all(self.piece(x.lower()) == self.whole([x])[0] for x in sample)

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def piece(self, letters: str) -> bytes:
        """The ids of a run of letters in lower case, by the tokenizer's model alone."""
        return array("I", [x.id for x in self.tokenizer.model.tokenize(letters.translate(self.spelling))]).tobytes()

    def keep(self, kept: dict[str, bytes], word: str, ids: bytes) -> bytes:
        if len(word) <= LONGEST_KEPT:
            if len(self) + len(self.pieces) >= KEPT_WORDS:
                self.clear()
                self.pieces.clear()
            kept[word] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        return self.keep(self, word, self.whole([word])[0])

    def of(self, words: pa.Array) -> pa.ListArray:
        """The ids of each of different words."""
        if not self.by_pieces:
            return _lists([self[w] for w in _strings(words)])
        split = pc.extract_regex(words, LETTERS_AND_SIGNS)
        runs = pc.utf8_lower(pc.struct_field(split, "letters")).dictionary_encode()
        signs = pc.struct_field(split, "signs").dictionary_encode()
        others = split.is_null()
        known = self.pieces.get
        ids = [known(x) or self.keep(self.pieces, x, self.piece(x)) for x in _strings(runs.dictionary)]
        ids += [self[x] for x in _strings(signs.dictionary)]
        ids += [self[x] for x in _strings(words.filter(others))]
        ids.append(b"")
        # Two places of ``ids`` for each word: its letters and its signs, or itself and nothing.
        places = np.full((len(words), 2), len(ids) - 1)
        alone = others.to_numpy(zero_copy_only=False)
        n_runs, n_signs = len(runs.dictionary), len(signs.dictionary)
        places[~alone, 0] = runs.indices.drop_null().to_numpy()
        places[~alone, 1] = n_runs + signs.indices.drop_null().to_numpy()
        places[alone, 0] = np.arange(n_runs + n_signs, len(ids) - 1)
        put = _lists(ids).take(pa.array(places.ravel()))
        return pa.ListArray.from_arrays(put.offsets[::2], put.flatten())

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text."""
        texts = texts.fill_null("")
        if not self.by_words:
            return _lists(self.whole(texts.to_pylist()))
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        numbered = words.flatten().dictionary_encode()
        ids = self.of(numbered.dictionary).take(numbered.indices)
        return pa.ListArray.from_arrays(ids.offsets.take(words.offsets), ids.flatten())


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


def _lists(found: list[bytes]) -> pa.ListArray:
    edges = np.zeros(len(found) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4, out=edges[1:])
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32()))


@cache
def _words(path: str) -> _Words:
    return _Words(path)


def encode(path: str, texts: list[str | None]) -> list[bytes]:
    """The ids of each text, four bytes each, the end id not included."""
    lists = _words(path).encode(pa.array(texts, pa.string()))
    ids, edges = lists.values.to_numpy(), lists.offsets.to_numpy()
    return [ids[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _runs(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    lengths = pc.binary_length(texts).fill_null(0).to_pylist()
    at = 0
    while at < len(lengths):
        upto, total = at, 0
        while upto < len(lengths) and (upto == at or total + lengths[upto] < size):
            total += lengths[upto]
            upto += 1
        yield at, upto
        at = upto


def _encoded(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, place = TaskContext.get().partitionId(), 0, 0
        end = np.array(end_id, "<u4").view("<i4")
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for at, upto in _runs(texts, 4 * BATCH_IDS):
                lists = _words(path).encode(texts.slice(at, upto - at))
                edges = lists.offsets.to_numpy().astype(np.int64)
                ids = np.insert(lists.values.to_numpy(), edges[1:], end)
                edges += np.arange(len(edges))
                columns = [
                    pa.array(np.full(upto - at, part), pa.int32()),
                    pa.array(np.arange(place, place + upto - at), pa.int64()),
                    doc_ids.slice(at, upto - at),
                    pa.array(start + edges[:-1], pa.int64()),
                    pa.array(np.diff(edges), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids, pa.int32())),
                ]
                start += int(edges[-1])
                place += upto - at
                yield pa.RecordBatch.from_arrays(columns, names=["part", "place", "doc_id", "start", "n_tokens", "tokens"])
        pa.default_memory_pool().release_unused()  # Arrow holds on to what batches have used

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, order: Sequence[Column] | None = None, end_id: int = END_ID
) -> None:
    """Write the ids of ``docs`` (``doc_id, text``) in an order, by default that of ``doc_id``.

    The order's columns may be any of the documents'.
    """
    order = [F.col("doc_id")] if order is None else list(order)
    keys = [f"order_{i}" for i in range(len(order))]
    named = [column.alias(name) for column, name in zip(order, keys, strict=True)]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *named)
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "text").select("doc_id", "text")
    sorted_rows.mapInArrow(_encoded(tokenizer, end_id), FILES).write.options(**LAYOUT).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILES).parquet(path)


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part, before``: the ids of all parts before each. One row for each part."""
    counts = read_tokens(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    _words.cache_clear()  # the ids are written, so what this process kept to find them goes
    pa.default_memory_pool().release_unused()
    for batch in batches:
        lists = batch.column("tokens")
        values = memoryview(lists.values.to_numpy().astype("<i4", copy=False)).cast("B")
        edges = (lists.offsets.to_numpy().astype(np.int64) * 4).tolist()
        sums = [zlib.crc32(values[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        columns = [batch.column(n) for n in ("part", "doc_id", "start")]
        columns += [pa.array(np.diff(edges) // 4, pa.int64()), pa.array(sums, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "start", "n_tokens", "ids_crc32"])


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read from the files."""
    kind = "part int, doc_id long, start long, n_tokens long, ids_crc32 long"
    rows = read_tokens(spark, path).select("part", "doc_id", "start", "tokens").mapInArrow(_checked, kind)
    placed = rows.join(part_starts(spark, path), "part")
    return placed.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
