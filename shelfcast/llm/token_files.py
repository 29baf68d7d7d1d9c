"""Token ids as files: canonical length-limited Huffman codes from global counts, read back by table look-ups.

A file is a row of blocks. Each block decodes alone: it carries the ends of its documents and, every so many
ids, the bit at which decoding can start.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm.common import Scratch, U, arrow_schema, ceil_div, ship, shuffle_partitions, span_hashes, text_pieces

# The id that ends a document, and the vocabulary that contracts name.
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"
# Bits of the longest code; a decoding table has two to the power of it entries. A vocabulary that needs more gets more.
MOST_BITS = 18
# Ids of a block, ids between two places where decoding can start, and ids of a file, about.
BLOCK_IDS, CHECKPOINT_IDS, FILE_IDS = 1 << 16, 256, 1 << 22
# Bytes of text tokenized in one step, distinct words whose ids a worker remembers, and new words of a string.
PIECE_BYTES, REMEMBERED, WORDS_A_STRING = 1 << 21, 1 << 21, 256


# Tokenizing -----------------------------------------------------------------------------------


SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
POINT = np.zeros(256, bool)
POINT[list(b".,;:!?)")] = True
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where texts laid end to end can be cut without a change of their ids, every text's start among them; and
    whether the words between them may also be tokenized one behind the other.

    The vocabulary's splitting pattern never runs from a visible character on to white space, so each place
    before an ASCII white space that follows a visible character will do, and so will one before a point that follows
    a letter or digit. Characters that could be other white space (those with first byte C2, E1, E2 or E3) are not told
    apart, and are no place to cut behind. Words from white space to such a cut keep their ids behind each other.
    """
    space = SPACE[data]
    seen = ~space  # whether what ends here is surely visible
    seen[1:] &= data[:-1] != 0xC2
    seen[2:] &= (data[:-2] < 0xE1) | (data[:-2] > 0xE3) | (data[1:-1] < 0x80)
    letter = ALNUM[data]
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)  # all but two of these are letters
    ruled = np.zeros(len(data) + 1, bool)
    ruled[1:-1] = (seen[:-1] & space[1:]) | (letter[:-1] & POINT[data[1:]])
    all_ = ruled.copy()
    all_[offsets] = True
    places = np.flatnonzero(all_)
    return places, space[places[:-1]] & ruled[places[1:]]


def byte_lengths(tokenizer: Tokenizer) -> np.ndarray:
    """Bytes that each id stands for. Only byte-level vocabularies have them: a character of a token is a byte."""
    kind = json.loads(tokenizer.to_str())["pre_tokenizer"]
    if not kind or kind["type"] != "ByteLevel" or kind["add_prefix_space"]:
        raise ValueError("a byte-level vocabulary without a prefix space is needed")
    vocabulary = tokenizer.get_vocab()
    out = np.zeros(max(vocabulary.values()) + 1, np.int64)
    out[list(vocabulary.values())] = [len(token) for token in vocabulary]
    return out


class WordIds:
    """Ids of texts, each distinct word tokenized once for as long as it is remembered.

    Words are told apart by 64-bit hashes; among n different ones two meet with odds n^2 / 2^65. New words are handed
    to the tokenizer in strings of many, which it takes much faster than one by one.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # a special token's string in a text is ordinary text
        self.lengths = byte_lengths(self.tokenizer)
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.empty(0, U)
        self.starts, self.counts = np.empty(0, np.int64), np.empty(0, np.int32)
        self.ids = np.empty(0, np.uint16 if len(self.lengths) <= 1 << 16 else np.uint32)

    def _learn(self, hashes: np.ndarray, words: pa.Array, sizes: np.ndarray, joint: np.ndarray) -> None:
        """Remembers new words (hashes ascending), those of `joint` put one behind the other."""
        order = np.concatenate((np.flatnonzero(joint), np.flatnonzero(~joint)))
        listed = words.take(pa.array(order)).to_pylist()
        together = int(joint.sum())
        strings = ["".join(listed[k : min(k + WORDS_A_STRING, together)]) for k in range(0, together, WORDS_A_STRING)]
        found = self.tokenizer.encode_batch_fast(strings + listed[together:], add_special_tokens=False)
        flat = np.fromiter(chain.from_iterable(e.ids for e in found), self.ids.dtype)
        ends = np.cumsum(self.lengths[flat])
        last = np.searchsorted(ends, np.cumsum(sizes[order]))
        if not np.array_equal(ends[last], np.cumsum(sizes[order])):
            raise ValueError("ids run across the ends of words")
        counts = np.diff(last, prepend=-1)
        starts = np.empty(len(order), np.int64)
        starts[order] = len(self.ids) + last + 1 - counts
        number = np.empty(len(order), np.int32)
        number[order] = counts
        merged = np.concatenate((self.hashes, hashes))
        place = np.argsort(merged, kind="stable")
        self.hashes = merged[place]
        self.starts = np.concatenate((self.starts, starts))[place]
        self.counts = np.concatenate((self.counts, number))[place]
        self.ids = np.concatenate((self.ids, flat))

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of UTF-8 texts laid end to end, and the number of ids up to each text's start."""
        places, joint = cuts(data, offsets)
        hashes = span_hashes(data, places[:-1], places[1:])
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > self.remembered:
            self._forget()
        new = first[~np.isin(distinct, self.hashes, assume_unique=True)]
        if len(new):
            words = pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data))
            self._learn(hashes[new], words.take(pa.array(new)), np.diff(places)[new], joint[new])
        at = np.searchsorted(self.hashes, distinct)
        counts, begin = self.counts[at].astype(np.int64)[which], self.starts[at][which]
        upto = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)))
        source = np.arange(upto[-1]) + np.repeat(begin - upto[:-1], counts)
        return self.ids[source], upto[np.searchsorted(places, offsets)]


@cache
def words_of(path: str) -> WordIds:
    """One per worker process, so that tasks go on with the words of those before."""
    return WordIds(path)


TOKENS = "doc_id long, th long, uid long, n long, ids binary"


def _tokens(path: str, kind: str):
    """Each text's ids and the end id, as bytes."""
    schema = arrow_schema(TOKENS)
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        for batch in batches:
            for i, j, data, offsets in text_pieces(batch.column("text"), PIECE_BYTES):
                ids, upto = words(data, offsets)
                ids = np.insert(ids, upto[1:], END_ID).astype(kind)
                ends = (upto + np.arange(len(upto))) * width
                blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids)])
                keys = [batch.column(c).slice(i, j - i) for c in ("doc_id", "th", "uid")]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(np.diff(ends) // width), blobs.cast(pa.binary())], schema=schema)

    return run


# Codes ----------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """Bits of each symbol's code, 0 for those that do not occur: the cheapest prefix code with no code longer than
    `most` bits (or than the alphabet needs), by package-merge.

    Every level merges the symbols with the pairs of the level before, by weight. The first 2n - 2 entries of the
    last level are taken; the symbols among them get a bit each, and the pairs say how many to take below.
    """
    used = np.flatnonzero(counts)
    out, n = np.zeros(len(counts), np.uint8), len(used)
    if n < 2:
        out[used] = 1
        return out
    most = max(most, int(n - 1).bit_length())
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.int64)
    level, levels = leaves, [np.ones(n, bool)]
    for _ in range(most - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaves, pairs))
        order = np.argsort(both, kind="stable")
        level = both[order]
        levels.append(order < n)
    bits, take = np.zeros(n, np.uint8), 2 * n - 2
    for is_leaf in reversed(levels):
        own = int(np.count_nonzero(is_leaf[:take]))
        bits[:own] += 1
        take = 2 * (take - own)
    out[used] = bits
    return out


def canonical_codes(bits: np.ndarray) -> np.ndarray:
    """The code of each symbol: codes count up in the order of length, then symbol."""
    codes = np.zeros(len(bits), U)
    order = np.lexsort((np.arange(len(bits)), bits))
    order = order[bits[order] > 0]
    if len(order):
        longest = int(bits[order[-1]])
        steps = U(1) << (U(longest) - bits[order].astype(U))
        codes[order] = (np.cumsum(steps) - steps) >> (U(longest) - bits[order].astype(U))
    return codes


def pack_bits(codes: np.ndarray, bits: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Codes end to end, first bit first, and the bit at which each starts."""
    ends = np.cumsum(bits.astype(np.int64))
    starts = ends - bits
    if not len(codes):
        return b"", starts
    word, free = starts >> 6, 64 - (starts & 63) - bits  # below zero: so many bits go into the next word
    own = np.where(free >= 0, codes << np.maximum(free, 0).astype(U), codes >> np.maximum(-free, 0).astype(U))
    heads = np.flatnonzero(np.diff(word, prepend=-1))
    out = np.zeros(int(ends[-1] + 63) // 64 + 1, U)
    out[word[heads]] = np.add.reduceat(own, heads)  # codes do not overlap, so a sum is a union
    over = np.flatnonzero(free < 0)
    out[word[over] + 1] += codes[over] << (64 + free[over]).astype(U)
    return out.astype(">u8").tobytes()[: int(ends[-1] + 7) // 8], starts


class Decoder:
    """Symbols from bits by one table: the next bits, as many as the longest code has, name symbol and length."""

    def __init__(self, bits: np.ndarray):
        order = np.lexsort((np.arange(len(bits)), bits))
        order = order[bits[order] > 0]
        self.longest = longest = int(bits.max(initial=1))
        if longest > 25:
            raise ValueError(f"a code of {longest} bits does not fit the look-up of 32")
        times = 1 << (longest - bits[order].astype(np.int64))
        self.symbols = np.resize(np.repeat(order.astype(np.uint32), times), 1 << longest)
        self.lengths = np.resize(np.repeat(bits[order].astype(np.int64), times), 1 << longest)

    def lanes(self, data: np.ndarray, starts: np.ndarray, steps: int) -> np.ndarray:
        """`steps` symbols from each of the bits `starts` on, all lanes in step: lanes x steps. Bits after the end
        are zeros."""
        wide = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint32)
        windows = wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:]
        out, at, last = np.empty((steps, len(starts)), np.uint32), starts.astype(np.int64), len(windows) - 1
        for k in range(steps):
            peek = windows[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32) >> np.uint32(32 - self.longest)
            out[k] = self.symbols[peek]
            at += self.lengths[peek]
        return out.T


# Files ----------------------------------------------------------------------------------------

# What files and blocks start with, and the byte after each.
FILE_MARK, BLOCK_MARK, END_MARK = b"TOKF", b"TOKB", b"\n"
FILE_HEAD, BLOCK_HEAD = struct.Struct("<4sIQ"), struct.Struct("<4sIIIIQ")


def file_head(number: int, bits: np.ndarray) -> bytes:
    """Mark, the file's place among the files, number of symbols; then each symbol's code length, a byte each."""
    return FILE_HEAD.pack(FILE_MARK, number, len(bits)) + bits.astype(np.uint8).tobytes()


def block(first: int, ids: np.ndarray, doc_ids: list[int | None], ends: list[int], codes: np.ndarray, bits: np.ndarray) -> bytes:
    """Mark; ids, documents, starts and code bytes in it; ids before it in the file. Then of each document that ends
    in it the doc_id, whether that is null, and its end; the bit of every CHECKPOINT_IDS-th id; and the codes."""
    packed, starts = pack_bits(codes[ids], bits[ids])
    starts = starts[::CHECKPOINT_IDS].astype("<u4")
    return b"".join(
        (
            BLOCK_HEAD.pack(BLOCK_MARK, len(ids), len(ends), len(starts), len(packed), first),
            np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
            bytes(d is None for d in doc_ids),
            np.array(ends, "<u4").tobytes(),
            starts.tobytes(),
            packed,
        )
    )


def _blocks(bits: np.ndarray, kind: str, block_ids: int):
    """The head and the blocks of one file from a partition's documents, in their order."""
    codes = canonical_codes(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(value: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([value], pa.binary())], names=["value"])

        first, held, parts, doc_ids, ends, begun = 0, 0, [], [], [], False

        def flush() -> bytes:
            return block(first, np.concatenate(parts), doc_ids, ends, codes, bits)

        for batch in batches:
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                if not begun:
                    yield row(file_head(TaskContext.get().partitionId(), bits))
                    begun = True
                ids = np.frombuffer(value.as_buffer(), kind)
                while len(ids):
                    taken = ids[: block_ids - held]
                    parts.append(taken)
                    held, ids = held + len(taken), ids[len(taken) :]
                    if not len(ids):
                        doc_ids.append(doc_id)
                        ends.append(held)
                    if held == block_ids:
                        yield row(flush())
                        first, held, parts, doc_ids, ends = first + held, 0, [], [], []
        if held:
            yield row(flush())

    return run


class Block:
    """One block of a file's bytes, its codes not yet decoded."""

    def __init__(self, content: memoryview, at: int):
        mark, self.n, docs, starts, size, self.first = BLOCK_HEAD.unpack_from(content, at)
        if mark != BLOCK_MARK:
            raise ValueError(f"no block at byte {at}")
        at += BLOCK_HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(content, kind, count, at)
            at += found.nbytes
            return found

        ids, null = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if none else int(d) for d, none in zip(ids, null, strict=True)]
        self.ends, self.starts, self.codes = take("<u4", docs).astype(np.int64), take("<u4", starts), take("u1", size)
        if bytes(content[at : at + 1]) != END_MARK:
            raise ValueError(f"a block does not end at byte {at}")
        self.stop = at + 1

    def span(self, decoder: Decoder, a: int, z: int) -> np.ndarray:
        """Ids a to z of the block, decoded from the last start before a."""
        if a >= z:
            return np.empty(0, np.uint32)
        lanes = self.starts[a // CHECKPOINT_IDS : -(-z // CHECKPOINT_IDS)]
        found = decoder.lanes(self.codes, lanes, CHECKPOINT_IDS).ravel()
        skipped = a // CHECKPOINT_IDS * CHECKPOINT_IDS
        return found[a - skipped : z - skipped]


def read_file(content: bytes) -> tuple[int, Decoder, Iterator[Block]]:
    """A file's place among the files, its decoder and its blocks."""
    view = memoryview(content)
    mark, number, symbols = FILE_HEAD.unpack_from(view)
    if mark != FILE_MARK:
        raise ValueError("not a token file")
    bits = np.frombuffer(view, np.uint8, symbols, FILE_HEAD.size)

    def blocks() -> Iterator[Block]:
        at = FILE_HEAD.size + symbols + len(END_MARK)
        while at < len(view):
            found = Block(view, at)
            yield found
            at = found.stop

    return number, Decoder(bits), blocks()


Reduce = Callable[[object, np.ndarray], object]


def documents_of(content: bytes, start: object, add: Reduce) -> Iterator[tuple[int, int | None, int, int, object]]:
    """(file, doc_id, ids before it in the file, its ids, `add` over the parts of its ids from `start` on)."""
    number, decoder, blocks = read_file(content)
    state, begin = start, 0
    for found in blocks:
        ids, at = found.span(decoder, 0, found.n), 0
        for doc_id, end in zip(found.doc_ids, found.ends.tolist(), strict=True):
            state = add(state, ids[at:end])
            yield number, doc_id, begin, found.first + end - begin, state
            state, at, begin = start, end, found.first + end
        if at < found.n:
            state = add(state, ids[at:])


READ = "file int, doc_id long, place long, n_tokens long, "


def _read(column: str, start: object, add: Reduce):
    schema = arrow_schema(READ + column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                if len(content.as_buffer()):
                    rows, held = [], 0
                    for row in documents_of(content.as_buffer(), start, add):
                        rows.append(row)
                        held += row[3]
                        if held > 1 << 21:
                            yield _batch(rows, schema)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _add_crc(crc: int, ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4"), crc)


def _add_bytes(known: bytes, ids: np.ndarray) -> bytes:
    return known + ids.astype("<u4").tobytes()


def _counted(kind: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            column = batch.column("ids").cast(pa.large_binary())
            bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            ids = np.frombuffer(column.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]].view(kind)
            total += np.bincount(ids, minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    scratch: Scratch | None = None,
    block_ids: int = BLOCK_IDS,
    file_ids: int = FILE_IDS,
) -> None:
    """Token files of the texts of `docs` (doc_id, text) in the new folder `path`, in ascending doc_id order.

    Null ids come first; rows of one id come in the order of their texts' hashes. Null and empty texts have the end
    id alone. Rows are dealt to files by id, text and place in the table, so equal ids, whatever their number, fill
    as many files as they need. Columns not named are not read. An empty table gives a folder without blocks.

    1. Texts become ids, stored once; `vocabulary` is the path of a tokenizer file, the same on all machines.
    2. Ids are counted over all documents, summed before the shuffle: one row per id of the vocabulary comes to the
       driver, which makes the code.
    3. One range shuffle by id, and each partition is written as one file of about `file_ids` ids through Spark's text
       writer, whose line end closes each block.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = scratch or Scratch(spark, "tokens")
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    size = Tokenizer.from_file(vocabulary).get_vocab_size()
    kind = "<u2" if size <= 1 << 16 else "<u4"
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.monotonically_increasing_id().alias("uid"), text.alias("text")
    )
    tokens = scratch.store(keyed.mapInArrow(_tokens(vocabulary, kind), TOKENS), compression="zstd")
    sums = tokens.select("ids").mapInArrow(_counted(kind, size), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = sums.toArrow()  # at most a row per id of the vocabulary
    counts = np.zeros(size, np.int64)
    counts[found.column("id").to_numpy()] = found.column("n").to_numpy()
    bits = code_lengths(counts)
    files = max(shuffle_partitions(spark) if counts.sum() > file_ids else 1, ceil_div(int(counts.sum()), file_ids))
    order = ["doc_id", "th", "uid"]
    placed = tokens.select(*order, "ids").repartitionByRange(files, *order).sortWithinPartitions(*order)
    blocks = placed.select("doc_id", "ids").mapInArrow(_blocks(bits, kind, block_ids), "value binary")
    blocks.select(F.col("value").cast("string").alias("value")).write.option("lineSep", END_MARK.decode()).text(path)
    scratch.drop(tokens)


def _decoded(spark: SparkSession, path: str, column: str, start: object, add: Reduce, scratch: Scratch) -> DataFrame:
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    rows = scratch.store(files.mapInArrow(_read(column, start, add), READ + column))
    sizes = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))  # one row per file
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("file", F.coalesce(before, F.lit(0)).alias("base"))
    return rows.join(bases, "file").select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", column.split()[0])


def read_token_files(spark: SparkSession, path: str, scratch: Scratch | None = None) -> DataFrame:
    """Of every document in the files of `path`: doc_id, start (ids of all documents before it), n_tokens (with the end
    id), ids (little-endian unsigned 32-bit integers)."""
    return _decoded(spark, path, "ids binary", b"", _add_bytes, scratch or Scratch(spark, "read-tokens"))


def token_digests(spark: SparkSession, path: str, scratch: Scratch | None = None) -> DataFrame:
    """As `read_token_files`, with the ids' unsigned crc32, ids_crc32, in place of the ids."""
    return _decoded(spark, path, "ids_crc32 long", 0, _add_crc, scratch or Scratch(spark, "read-tokens"))


def tokens_written_and_read(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """`token_digests` of the files that `write_token_files` writes for `docs`, in the shared folder."""
    scratch = scratch or Scratch(docs.sparkSession, "token-files")
    path = scratch.path()
    write_token_files(docs, path, scratch=scratch)
    return token_digests(docs.sparkSession, path, scratch)
