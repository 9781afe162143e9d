"""Token ids of documents in files of adaptive range-coded blocks.

Documents go to shards by ranges of their id and are sorted there. A task
tokenizes its shard, appends the end id to each document and writes one file:
blocks of `coder.BLOCK` ids, and an index of the shard's documents. The ids of
all documents in ascending id order are the shards' ids one after the other.

A file: ``ATID`` and version (u32), vocabulary size (u32); for each block its
length (u32) and the block; a zero length; the index, zlib-compressed: ids
(i64), whether the id is null (u8) and token counts (u64) of the documents;
crc32 of the compressed index (u32), its length (u32), documents (u32). All
integers are little-endian. Files are written under a name of the attempt and
then renamed, so a repeated task leaves one whole file.

Words between ASCII blanks are encoded once and kept by the worker: this
tokenizer drops blanks before it splits, so a text's ids are its words' ids.
Arrow splits a piece of texts and numbers its distinct words; only these are
looked up one by one.

Defined cases: a null or empty text has the end id alone. Null ids come first;
rows with the same id are ordered by a hash of their text. An empty table is
one file without blocks.
"""

from __future__ import annotations

import os
import string
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import accumulate, batched, chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areacast.llm import coder
from areacast.llm.common import byte_texts, new_folder, pieces

TOKENIZER, SYMBOLS, END = "word_bpe_49k.json", 49_408, 2
#: Words a worker keeps with their ids; beyond, it begins anew.
KNOWN_WORDS = 600_000
#: Text of the documents tokenized at once.
_PIECE = 4 << 20
_MARKS = string.punctuation
#: Texts that may hold a special token, or a capital that joins the accent after
#: it only in lower case, are not lower-cased before the tokenizer does it.
_AS_IT_IS = r"<\||[A-Z]\p{M}"


@cache
def _tokenizer(path: str):
    # Tasks are the parallelism; the library's threads would add to them.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _expand(flat: np.ndarray, offsets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of numbered words one after the other, and their counts; word k
    of the table has ``flat[offsets[k] : offsets[k + 1]]``."""
    starts = offsets[at]
    sizes = offsets[at + 1] - starts
    through = np.cumsum(sizes)
    place = np.repeat(starts - through + sizes, sizes)
    place += np.arange(len(place))
    return flat[place], sizes


class WordIds:
    """The ids of words, in one array; a word's number gives its place.

    ASCII is lower-cased, and the ASCII marks at a word's beginning and end are
    taken as words of their own where the tokenizer parts them, so the table
    holds what is between them. Up to ``KNOWN_WORDS`` words are kept. Then a
    piece's further words are encoded for the moment, or, if they are many, the
    table is begun anew.
    """

    def __init__(self, path: str):
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = _tokenizer(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        # For words of a to z, which the other steps leave as they are.
        self.model = type(self.tokenizer)(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        self.parted: dict[str, bool] = {}
        self.parted_ascii = np.array([k < 128 and self._is_parted(chr(k)) for k in range(256)])
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {b"": 0}
        self.flat, self.offsets = np.zeros(0, np.int32), np.zeros(2, np.int64)

    def _is_parted(self, char: str) -> bool:
        """Whether the tokenizer parts marks from this character beside them."""
        if char not in self.parted:
            whole = self.tokenizer.normalizer.normalize_str(f"!{char}!")
            runs = [run for run, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(whole)]
            self.parted[char] = len(runs) > 2 and runs[0] == runs[-1] == "!"
        return self.parted[char]

    def _runs(self, tokenizer, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids and counts of words that are one token run each, which its end
        marks; so many of them are encoded as one text."""
        joined = [b" ".join(some).decode() for some in batched(words, 64)]
        ids = [e.ids for e in tokenizer.encode_batch_fast(joined, add_special_tokens=False)] if joined else []
        flat = np.fromiter(chain.from_iterable(ids), np.int32)
        return flat, np.diff(np.flatnonzero(self.ends[flat]) + 1, prepend=0)

    def _encode(self, words: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """An order of the words, and the ids and counts of the words in it."""
        plain, letters, others = [], [], []
        for k, word in enumerate(words):
            # Of bytes, these tests hold for ASCII alone.
            if word.isalpha():
                (plain if word.islower() else letters).append(k)
            else:
                (letters if word.decode().isalpha() else others).append(k)
        parts = [self._runs(self.model, [words[k] for k in plain]), self._runs(self.tokenizer, [words[k] for k in letters])]
        if len(parts[1][1]) != len(letters):
            parts.pop()
            letters, others = [], letters + others
        texts = [words[k].decode() for k in others]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []
        parts.append((np.fromiter(chain.from_iterable(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids))))
        return plain + letters + others, *(np.concatenate(p) for p in zip(*parts))

    def _parts(self, words: pa.Array) -> pa.Array:
        """The marks before each word, the word, and the marks after it, by turns.
        The marks stay with a word that may hold a special token, or from which
        the tokenizer does not part them."""
        bare = pa.compute.ascii_ltrim(words, _MARKS.replace("'", ""))  # 's is a run of its own
        lengths = [pa.compute.binary_length(v).to_numpy() for v in (words, bare, pa.compute.ascii_rtrim(bare, _MARKS))]
        before, after = lengths[0] - lengths[1], lengths[1] - lengths[2]
        begins = np.frombuffer(words.buffers()[1], np.int32)[words.offset :][: len(words) + 1]
        data = words.buffers()[2] or pa.py_buffer(b"")
        marked = np.flatnonzero((before + after > 0) & (lengths[2] > 0) & ~pa.compute.match_substring(words, "<|").to_numpy(zero_copy_only=False))
        first, last = begins[marked] + before[marked], begins[marked + 1] - after[marked] - 1
        raw = np.frombuffer(data, np.uint8)
        ahead, behind = self.parted_ascii[raw[first]], self.parted_ascii[raw[last]]
        for found, here, side in ((ahead, raw[first] >= 128, 0), (behind, raw[last] >= 128, -1)):
            for k in np.flatnonzero(here & ((before, after)[side][marked] > 0)).tolist():
                found[k] = self._is_parted(raw[first[k] : last[k] + 1].tobytes().decode()[side])
        places = np.stack([begins[:-1], begins[:-1], begins[1:]], axis=1)
        places[marked, 1] += before[marked] * ahead
        places[marked, 2] -= after[marked] * behind
        return pa.StringArray.from_buffers(3 * len(words), pa.py_buffer(np.append(places.ravel(), begins[-1]).astype(np.int32)), data)

    def encode(self, texts: list[bytes | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, an end after each, and their counts by text."""
        column = pa.array(texts, pa.binary()).cast(pa.string())
        kept = pa.compute.match_substring_regex(column, _AS_IT_IS)
        split = pa.compute.ascii_split_whitespace(pa.compute.if_else(kept, column, pa.compute.ascii_lower(column)))
        ends = np.cumsum(pa.compute.list_value_length(split).fill_null(0).to_numpy())
        coded = split.flatten().dictionary_encode()
        words = coded.indices.to_numpy()
        parts = self._parts(coded.dictionary).dictionary_encode()
        part = parts.indices.to_numpy().reshape(-1, 3)
        keys = parts.dictionary.cast(pa.binary()).to_pylist()

        at = np.fromiter(map(self.number.get, keys, repeat(-1)), np.int64, len(keys))
        missing = np.flatnonzero(at < 0)
        full = len(self.number) + len(missing) > KNOWN_WORDS
        if full and 4 * int((at < 0)[part].any(axis=1)[words].sum()) > len(words):
            self.clear()
            at, full = np.where([k == b"" for k in keys], 0, -1), False
            missing = np.flatnonzero(at < 0)
        flat, offsets = self.flat, self.offsets
        if len(missing):
            new = [keys[k] for k in missing.tolist()]
            order, ids, sizes = self._encode(new)
            count = len(offsets) - 1
            at[missing[order]] = np.arange(count, count + len(new))
            flat, offsets = np.concatenate([flat, ids]), np.concatenate([offsets, offsets[-1] + np.cumsum(sizes)])
            if not full:
                self.flat, self.offsets = flat, offsets
                self.number.update(zip((new[k] for k in order), range(count, count + len(new))))

        # The piece's own words, the end as one more, then the texts.
        flat, sizes = _expand(flat, offsets, at[part].ravel())
        sizes = np.append(sizes.reshape(-1, 3).sum(axis=1), 1)
        flat, sizes = _expand(np.append(flat, np.int32(end)), np.append(0, np.cumsum(sizes)), np.insert(words, ends, len(sizes) - 1))
        stops = np.cumsum(sizes)[ends + np.arange(len(ends))]
        return flat, np.diff(stops, prepend=0)


class TextIds:
    """The ids of whole texts, by any tokenizer."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)

    def encode(self, texts: list[bytes | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch([(t or b"").decode() for t in texts], add_special_tokens=False)
        sizes = np.fromiter((len(e.ids) + 1 for e in found), np.int64, len(found))
        return np.fromiter(chain.from_iterable((*e.ids, end) for e in found), np.int64, int(sizes.sum())), sizes


@cache
def _encoder(path: str | None) -> WordIds | TextIds:
    """Words are encoded one by one for the tokenizer that this holds for."""
    return TextIds(path) if path else WordIds(public_tokenizers.path(TOKENIZER))


def _place(uri: str) -> tuple[pa.fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pa.fs.FileSystem.from_uri(uri) if "://" in uri else (pa.fs.LocalFileSystem(), uri)


def _name(folder: str, shard: int) -> str:
    return f"{folder}/part-{shard:06d}.atid"


def write_file(out, documents: Iterator[tuple[list[int | None], np.ndarray, np.ndarray]], symbols: int = SYMBOLS) -> tuple[int, int]:
    """Writes documents given as (doc ids, token ids, token counts) pieces;
    returns the documents and ids written."""
    out.write(b"ATID" + struct.pack("<II", 2, symbols))
    places = [12]
    names: list[int | None] = []
    counts: list[np.ndarray] = [np.zeros(0, np.int64)]
    held = np.zeros(0, np.int32)
    total = 0

    def block(ids: np.ndarray) -> None:
        data = coder.encode(ids, symbols)
        out.write(struct.pack("<I", len(data)) + data)
        places.append(places[-1] + 4 + len(data))

    for ids, tokens, sizes in documents:
        names += ids
        counts.append(sizes)
        total += len(tokens)
        held = np.concatenate([held, tokens])
        while len(held) >= coder.BLOCK:
            block(held[: coder.BLOCK])
            held = held[coder.BLOCK :]
    if len(held):
        block(held)
    index = zlib.compress(
        np.array([i or 0 for i in names], "<i8").tobytes() + np.array([i is None for i in names], "u1").tobytes() + np.concatenate(counts).astype("<u8").tobytes()
        + np.array(places, "<u8").tobytes()
    )
    out.write(struct.pack("<I", 0) + index + struct.pack("<III", zlib.crc32(index), len(index), len(names)))
    return len(names), total


def _index(source) -> tuple[int, list[int | None], np.ndarray, np.ndarray]:
    """Symbols, doc ids, token counts and the places of the blocks of a file."""
    source.seek(0, 2)
    size = source.tell()
    source.seek(size - 12)
    check, length, n = struct.unpack("<III", source.read(12))
    source.seek(size - 12 - length)
    packed = source.read(length)
    source.seek(0)
    head = source.read(12)
    if head[:4] != b"ATID" or zlib.crc32(packed) != check:
        raise ValueError("not a whole file of token ids")
    index = zlib.decompress(packed)
    names = np.frombuffer(index, "<i8", n).tolist()
    nulls = np.frombuffer(index, "u1", n, 8 * n).tolist()
    ids = [None if z else i for i, z in zip(names, nulls)]
    return struct.unpack("<II", head[4:])[1], ids, np.frombuffer(index, "<u8", n, 9 * n).astype(np.int64), np.frombuffer(index, "<u8", -1, 17 * n).astype(np.int64)


def read_document(source, k: int) -> np.ndarray:
    """The ids of the k-th document of a file; reads the blocks that hold it."""
    symbols, _, counts, places = _index(source)
    start, stop = int(counts[:k].sum()), int(counts[: k + 1].sum())
    first, last = start // coder.BLOCK, (stop - 1) // coder.BLOCK
    parts = []
    for block in range(first, last + 1):
        source.seek(int(places[block]) + 4)
        parts.append(coder.decode(source.read(int(places[block + 1] - places[block]) - 4), symbols))
    return np.concatenate(parts)[start - first * coder.BLOCK : stop - first * coder.BLOCK]


def read_file(source) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(doc ids, token ids, token counts) of the documents of a file, by block;
    ``source`` can seek. Raises on damage."""
    symbols, ids, counts, places = _index(source)
    n = len(ids)
    source.seek(int(places[0]))
    done, held = 0, np.zeros(0, np.int32)
    while length := struct.unpack("<I", source.read(4))[0]:
        held = np.concatenate([held, coder.decode(source.read(length), symbols)])
        through = np.cumsum(counts[done:])
        more = int(np.searchsorted(through, len(held), "right"))
        if more:
            used = int(through[more - 1])
            yield ids[done : done + more], held[:used], counts[done : done + more]
            held, done = held[used:], done + more
    if done != n or len(held):
        raise ValueError("the blocks do not match the index")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end: int = END) -> list[tuple[int, int]]:
    """Writes the files of ``docs`` (doc_id, text) into ``folder``, which all
    executors share; returns each shard's documents and ids, in order. That is
    a pair for each partition. ``tokenizer``: the file of another tokenizer of
    at most SYMBOLS ids, which encodes whole texts. The order, and the ranges,
    are those of id and a hash of the text, so that rows of one id are dealt
    to several files."""
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task = _encoder(tokenizer), TaskContext.get()
        system, base = _place(folder)
        system.create_dir(base)
        shard = task.partitionId()

        def documents():
            for b in pieces(batches, "text", _PIECE):
                tokens, sizes = words.encode(byte_texts(b.column(1)), end)
                yield b.column(0).to_pylist(), tokens, sizes

        temporary = f"{base}/_{shard}-{task.taskAttemptId()}-{uuid.uuid4().hex}"
        with system.open_output_stream(temporary) as out:
            n, ids = write_file(out, documents())
        system.move(temporary, _name(base, shard))
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (shard, n, ids)], ["shard", "documents", "ids"])

    written = ordered.mapInArrow(run, "shard long, documents long, ids long").collect()
    found = {r.shard: (r.documents, r.ids) for r in written}
    return [found[k] for k in range(len(found))]


def read_token_files(spark: SparkSession, folder: str, shards: list[tuple[int, int]], digest: bool = False) -> DataFrame:
    """doc_id, start (ids before the document) and its ids, from the files; with
    ``digest`` n_tokens and ids_crc32 in their place."""
    before = list(accumulate((n for _, n in shards), initial=0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard in b.column(0).to_pylist():
                system, base = _place(folder)
                start = before[shard]
                with system.open_input_file(_name(base, shard)) as source:
                    for names, ids, counts in read_file(source):
                        stops = np.cumsum(counts)
                        starts = stops - counts
                        columns = [pa.array(names, pa.int64()), pa.array(start + starts)]
                        if digest:
                            raw = ids.astype("<u4").tobytes()
                            crc = [zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(starts.tolist(), stops.tolist())]
                            columns += [pa.array(counts), pa.array(crc, pa.int64())]
                        else:
                            columns.append(pa.ListArray.from_arrays(pa.array(np.append(starts, stops[-1:]), pa.int32()), pa.array(ids)))
                        start += int(stops[-1])
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", *(["n_tokens", "ids_crc32"] if digest else ["ids"])])

    schema = "doc_id long, start long, " + ("n_tokens long, ids_crc32 long" if digest else "ids array<int>")
    return spark.range(0, len(shards), 1, max(len(shards), 1)).mapInArrow(run, schema)


def token_digests(docs: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from
    the files it writes into the shared folder."""
    spark = docs.sparkSession
    folder = new_folder(spark, "token-files")
    return read_token_files(spark, folder, write_token_files(docs, folder), digest=True)
