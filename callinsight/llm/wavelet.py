"""Token ids on disk as wavelet matrices: one compressed file per shard, which answers token access, counting and
occurrence lookup without being unpacked.

Documents are dealt to tasks by ranges of their id, and each task writes its documents in ascending order
to files of about ``shard_tokens`` ids. A file holds

- ``WVMX0001``, the length of a JSON header (four bytes), the header, then sections that it points to;
- the ids and token counts of its documents and its distinct tokens, the commonest first (Zstandard);
- a bit plane for each bit of a token's rank in that list, highest bit first: the bits of all tokens in the
  order that the plane above left them in (its zeros first, then its ones, each in order). A plane is cut
  into blocks, each compressed on its own, with the ones before each block beside them.

``rank`` reads one block a plane, ``select`` one block a plane after a binary search, and a whole shard is
decoded from the last plane up. Files get a name of their own for each attempt of a task and count only when
Spark has committed the manifest row that names them, so lost executors leave no half-written shard behind.

Rows: a NULL text counts as empty (it has only the end id), a NULL ``doc_id`` sorts last, equal ids follow each
other by a hash of their texts; an empty table makes no file. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import string
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callinsight.llm import bpe
from callinsight.llm.common import external_id, internal_id, per_worker, shared_folder, text_of, written
from callinsight.llm.words import slices, word_numbers

DEFAULT_PATH = public_tokenizers.path("word_bpe_49k.json")
END = 2
MAGIC = b"WVMX0001"
#: Bits of a block.
BLOCK = 1 << 16
#: Bytes of text tokenized at once in a worker.
CHUNK = 6_000_000


# --- One shard --------------------------------------------------------------------------------


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(values.tobytes())


def build(tokens: np.ndarray, doc_ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """The file of ``tokens``, the ids of documents ``doc_ids`` end to end, ``sizes`` each."""
    counts = np.bincount(tokens)
    alphabet = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    rank = np.zeros(len(counts), np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
    rank[alphabet] = np.arange(len(alphabet))
    codes = rank[tokens]
    width = max(1, (len(alphabet) - 1).bit_length()) if len(alphabet) else 0
    sections = [_packed(doc_ids.astype("<i8")), _packed(sizes.astype("<i8")), _packed(alphabet.astype("<u4"))]
    zeros, pack = [], zstandard.ZstdCompressor(level=1)
    for bit in range(width - 1, -1, -1):
        ones = (codes & codes.dtype.type(1 << bit)) != 0
        raw = np.packbits(ones).tobytes()
        blocks = [raw[at : at + BLOCK // 8] for at in range(0, len(raw), BLOCK // 8)]
        small = [pack.compress(b) for b in blocks]
        kept = [s if len(s) < len(b) else b for s, b in zip(small, blocks, strict=True)]
        per_block = np.add.reduceat(ones, np.arange(0, len(ones), BLOCK), dtype=np.int64)
        sections.append(np.concatenate(([0], np.cumsum([len(k) for k in kept]))).astype("<i8").tobytes())
        sections.append(np.concatenate(([0], np.cumsum(per_block))).astype("<i8").tobytes())
        sections.append(b"".join(kept))
        low = codes[~ones]
        zeros.append(len(low))
        codes = np.concatenate((low, codes[ones]))
    header = {"tokens": len(tokens), "documents": len(doc_ids), "block": BLOCK, "zeros": zeros, "sections": [len(s) for s in sections]}
    head = json.dumps(header).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *sections])


class Shard:
    """Reads a shard from its bytes; blocks are unpacked where a question needs them."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a wavelet matrix shard")
        (size,) = struct.unpack_from("<I", data, 8)
        head = json.loads(data[12 : 12 + size])
        self.tokens, self.block, self.zeros = head["tokens"], head["block"], head["zeros"]
        ends = 12 + size + np.concatenate(([0], np.cumsum(head["sections"]))).astype(np.int64)
        view = memoryview(data)
        part = [view[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        unpacked = [np.frombuffer(zstandard.ZstdDecompressor().decompress(p), t) for p, t in zip(part[:3], ("<i8", "<i8", "<u4"), strict=True)]
        self.doc_ids, self.sizes, self.alphabet = unpacked
        self.starts = np.concatenate(([0], np.cumsum(self.sizes))).astype(np.int64)
        self.code = {int(t): c for c, t in enumerate(self.alphabet)}
        self.offsets = [np.frombuffer(p, "<i8") for p in part[3::3]]
        self.ones = [np.frombuffer(p, "<i8") for p in part[4::3]]
        self.data = part[5::3]
        self._bits = lru_cache(maxsize=256)(self._unpack)

    def _unpack(self, plane: int, block: int) -> np.ndarray:
        raw = self.data[plane][self.offsets[plane][block] : self.offsets[plane][block + 1]]
        bits = min(self.block, self.tokens - block * self.block)
        if len(raw) != -(-bits // 8):
            raw = zstandard.ZstdDecompressor().decompress(raw)
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=bits).view(bool)

    def _rank1(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block, rest = divmod(i, self.block)
        return int(self.ones[plane][block]) + (int(np.count_nonzero(self._bits(plane, block)[:rest])) if rest else 0)

    def _select(self, plane: int, one: bool, k: int) -> int:
        """Place of the ``k``-th (from 0) one, or zero, of a plane."""
        ones = self.ones[plane]
        before = ones if one else np.minimum(np.arange(len(ones)) * self.block, self.tokens) - ones
        block = int(np.searchsorted(before, k, side="right")) - 1
        return block * self.block + int(np.flatnonzero(self._bits(plane, block) == one)[k - before[block]])

    def access(self, i: int) -> int:
        """The ``i``-th token."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        code = 0
        for plane, zeros in enumerate(self.zeros):
            bit = bool(self._bits(plane, i // self.block)[i % self.block])
            ones = self._rank1(plane, i)
            code, i = 2 * code + bit, zeros + ones if bit else i - ones
        return int(self.alphabet[code])

    def _down(self, code: int, i: int) -> int:
        for plane, zeros in enumerate(self.zeros):
            ones = self._rank1(plane, i)
            i = zeros + ones if code >> (len(self.zeros) - 1 - plane) & 1 else i - ones
        return i

    def rank(self, token: int, i: int) -> int:
        """How often ``token`` occurs among the first ``i`` tokens."""
        code = self.code.get(token)
        return 0 if code is None else self._down(code, i) - self._down(code, 0)

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        return self.rank(token, self.tokens if end is None else end) - self.rank(token, start)

    def select(self, token: int, k: int) -> int:
        """Place of the ``k``-th occurrence (from 0) of ``token``."""
        code = self.code.get(token)
        if code is None or not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._down(code, 0) + k
        for plane in range(len(self.zeros) - 1, -1, -1):
            one = bool(code >> (len(self.zeros) - 1 - plane) & 1)
            i = self._select(plane, one, i - self.zeros[plane] if one else i)
        return i

    def locate(self, token: int) -> np.ndarray:
        """All places of ``token``, ascending, plane by plane from the last one up."""
        code = self.code.get(token)
        if code is None:
            return np.zeros(0, np.int64)
        first = self._down(code, 0)
        places = np.arange(first, first + self.count(token))
        for plane in range(len(self.zeros) - 1, -1, -1):
            one = bool(code >> (len(self.zeros) - 1 - plane) & 1)
            holds = np.flatnonzero(self._plane(plane) == one)
            places = holds[places - self.zeros[plane] if one else places]
        return places

    def _plane(self, plane: int) -> np.ndarray:
        return np.concatenate([self._unpack(plane, b) for b in range(len(self.offsets[plane]) - 1)] or [np.zeros(0, bool)])

    def decode(self) -> np.ndarray:
        """All tokens: each plane, from the last, puts its zeros and ones back where they were."""
        codes = np.zeros(self.tokens, np.uint16 if len(self.zeros) <= 16 else np.uint32)
        for plane in range(len(self.zeros) - 1, -1, -1):
            ones, above = self._plane(plane), np.empty_like(codes)
            above[~ones] = codes[: self.zeros[plane]]
            above[ones] = codes[self.zeros[plane] :] | codes.dtype.type(1 << (len(self.zeros) - 1 - plane))
            codes = above
        return self.alphabet[codes]


# --- Tokens -----------------------------------------------------------------------------------


#: Letters whose only form is one character, in either case; the library makes one pre-token of a word of these.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_PUNCTUATION = "!-/:-@\\[-`{-~"


class Tokenizer:
    """Ids by the tokenizers library, worked out once for each distinct word of a batch.

    The vocabulary drops white space and no pre-token of it contains any, so a text's ids are those of its
    words. Punctuation that ends a word of letters is a pre-token of its own. What is left of a word, if Latin letters
    alone, is one pre-token and goes to the library's model directly, in lower case and in the format's byte
    alphabet; anything else goes through the whole library. Both are remembered for later batches, in two generations
    of bounded size.
    """

    def __init__(self, path: str, remember: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.remember = remember
        self.letters = {byte: ord(shown) for shown, byte in bpe._byte_alphabet().items()}
        self.plain = re.compile(f"[{LETTERS}]+").fullmatch
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, part: str) -> bytes:
        if self.plain(part):
            low = part.lower()
            shown = low if low.isascii() else low.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.model.tokenize(shown)]
        else:
            ids = self.library.encode(part, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def encoded(self, parts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each of the distinct ``parts`` of words."""
        if len(self.young) > self.remember:
            self.old, self.young = self.young, {}
        young, old, out = self.young, self.old, []
        for part in parts:
            got = young.get(part)
            if got is None:
                got = old.get(part)
                if got is None:
                    got = self._ids(part)
                young[part] = got
            out.append(got)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, with the end id after each; how many each has)."""
        numbers, counts, words = word_numbers(texts)
        # Words apart from the punctuation that ends them. Special tokens stay whole.
        ends_plain = pc.match_substring_regex(words, f"^[^<]*[{LETTERS}][{_PUNCTUATION}]+$")
        stems = pc.if_else(ends_plain, pc.utf8_rtrim(words, string.punctuation), words)
        tails = pc.if_else(ends_plain, pc.replace_substring_regex(words, f"^.*[^{_PUNCTUATION}]", ""), "")
        stems = pc.if_else(pc.match_substring_regex(stems, f"^[{LETTERS}]+$"), pc.utf8_lower(stems), stems)
        coded = pa.concat_arrays([stems, tails.cast(stems.type)]).dictionary_encode()
        encoded = self.encoded(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        flat = np.frombuffer(b"".join(encoded), "<u4")
        starts = np.cumsum(lengths) - lengths
        stem, tail = np.split(coded.indices.to_numpy(), 2)

        # Ids of each distinct word, its stem's and its tail's, and after the last word the end id.
        per_word = lengths[stem] + lengths[tail]
        ends = np.append(np.cumsum(per_word), int(per_word.sum()) + 1)
        begins = ends - np.append(per_word, 1)
        of_words = np.empty(int(ends[-1]), np.uint32)
        of_words[-1] = END
        for part, at in ((stem, begins[:-1]), (tail, begins[:-1] + lengths[stem])):
            of_words[_ranges(at, lengths[part])] = flat[_ranges(starts[part], lengths[part])]

        every = np.full(len(numbers) + len(counts), len(words), np.int32)
        inner = np.ones(len(every), bool)
        inner[np.cumsum(counts + 1) - 1] = False
        every[inner] = numbers
        sizes = (ends - begins)[every]
        after = np.cumsum(sizes)
        per_text = np.diff(np.concatenate(([0], after[~inner])))
        return of_words[_ranges(begins[every], sizes)], per_text


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + size - 1`` of each pair, end to end."""
    after = np.cumsum(sizes)
    total = int(after[-1]) if len(after) else 0
    return np.repeat(starts - (after - sizes), sizes) + np.arange(total)


# --- Shards of a table ------------------------------------------------------------------------

_MANIFEST = "task int, before long, file string, first_id long, last_id long, documents long, tokens long, bytes long"


def _open(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


def _read(uri: str) -> Shard:
    files, path = _open(uri)
    with files.open_input_stream(path) as f:
        return Shard(f.read())


@dataclass
class WaveletShards:
    """Writes and reads the shards of a table. ``shard_tokens``: a shard ends with the document that reaches it."""

    path: str = DEFAULT_PATH
    shard_tokens: int = 4_000_000

    def write(self, docs: DataFrame, folder: str | None = None) -> DataFrame:
        """Write all rows of ``docs`` (doc_id, text) below ``folder``, a place that every executor reaches and pyarrow
        can write to; returns the manifest, a written table with a row per shard:
        (task, before, file, first_id, last_id, documents, tokens, bytes). ``before``: tokens of the task's
        earlier shards; tasks are in order of their ids."""
        spark, path, limit = docs.sparkSession, self.path, self.shard_tokens
        folder = (folder or shared_folder(spark, "wavelet")).rstrip("/")
        files, inner = _open(folder)
        files.create_dir(inner, recursive=True)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokenizer = per_worker(f"wavelet:{path}", lambda: Tokenizer(path))
            task, before = TaskContext.get().partitionId(), 0
            held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            waiting = 0

            def shard() -> pa.RecordBatch:
                nonlocal before, waiting
                tokens, ids, sizes = (np.concatenate(p) for p in zip(*held, strict=True))
                held.clear()
                data = build(tokens, ids, sizes)
                name = f"{folder}/{task:06d}-{before:014d}-{uuid.uuid4().hex}.wvm"
                store, target = _open(name)
                with store.open_output_stream(target) as f:
                    f.write(data)
                row = (task, before, name, ids[0], ids[-1], len(ids), len(tokens), len(data))
                before, waiting = before + len(tokens), 0
                types = [pa.int32(), pa.int64(), pa.string(), *[pa.int64()] * 5]
                return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], [c.split()[0] for c in _MANIFEST.split(", ")])

            for batch in batches:
                for part in slices(batch, CHUNK):
                    tokens, sizes = tokenizer.encode(part.column("text"))
                    ids, done = part.column("id").to_numpy(), 0
                    ends = np.cumsum(sizes)
                    while done < len(ids):
                        at = int(ends[done - 1]) if done else 0
                        stop = min(len(ids), int(np.searchsorted(ends, at + limit - waiting)) + 1)
                        held.append((tokens[at : ends[stop - 1]], ids[done:stop], sizes[done:stop]))
                        waiting, done = waiting + int(ends[stop - 1]) - at, stop
                        if waiting >= limit:
                            yield shard()
            if held:
                yield shard()

        # Equal ids (NULLs among them) are dealt on by a hash of the text: none of them is a hot range.
        keyed = docs.select(internal_id().alias("id"), text_of().alias("text")).withColumn("mix", F.xxhash64("text"))
        ordered = keyed.repartitionByRange("id", "mix").sortWithinPartitions("id", "mix").select("id", "text")
        return written(ordered.mapInArrow(run, _MANIFEST), "wavelet-manifest")

    def _shards(self, manifest: DataFrame) -> DataFrame:
        """The manifest dealt over tasks; a shard is opened by one of them."""
        n = manifest.count()
        tasks = min(n, max(4 * manifest.sparkSession.sparkContext.defaultParallelism, n // 16))
        return manifest.repartition(max(1, tasks), "file")

    def read(self, manifest: DataFrame) -> DataFrame:
        """(doc_id, start, n_tokens, ids_crc32, ids): every document from the files, ``start`` counted over all shards.

        ``ids``: little-endian 32-bit ids."""
        # One number for each task that wrote shards, as many as partitions.
        totals = sorted((r["task"], r["tokens"]) for r in manifest.groupBy("task").agg(F.sum("tokens").alias("tokens")).collect())
        base, so_far = {}, 0
        for task, tokens in totals:
            base[task], so_far = so_far, so_far + tokens

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for task, before, file in zip(*(batch.column(c).to_pylist() for c in ("task", "before", "file")), strict=True):
                    shard = _read(file)
                    data = memoryview(shard.decode().astype("<u4")).cast("B")
                    done = 0
                    while done < len(shard.sizes):  # about a million ids at once, or one document
                        stop = max(done + 1, int(np.searchsorted(shard.starts, shard.starts[done] + 1_000_000, side="right")) - 1)
                        ids = [bytes(data[4 * a : 4 * b]) for a, b in zip(shard.starts[done:stop], shard.starts[done + 1 : stop + 1], strict=True)]
                        columns = [
                            pa.array(shard.doc_ids[done:stop], pa.int64()),
                            pa.array(shard.starts[done:stop] + (base[task] + before), pa.int64()),
                            pa.array(shard.sizes[done:stop], pa.int64()),
                            pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                            pa.array(ids, pa.binary()),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, ["id", "start", "n_tokens", "ids_crc32", "ids"])
                        done = stop

        found = self._shards(manifest).select("task", "before", "file").mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long, ids binary")
        return found.select(external_id("id").alias("doc_id"), "start", "n_tokens", "ids_crc32", "ids")

    def count(self, manifest: DataFrame, tokens: list[int]) -> DataFrame:
        """(token, occurrences) over all shards, by rank at their ends; nothing is decoded."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for file in batch.column("file").to_pylist():
                    shard = _read(file)
                    found = [shard.count(t) for t in tokens]
                    yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(found, pa.int64())], ["token", "n"])

        found = self._shards(manifest).select("file").mapInArrow(run, "token long, n long")
        return found.groupBy("token").agg(F.sum("n").alias("occurrences"))

    def locate(self, manifest: DataFrame, token: int) -> DataFrame:
        """(doc_id, position): every occurrence of ``token``, the position counted in its document."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for file in batch.column("file").to_pylist():
                    shard = _read(file)
                    places = shard.locate(token)
                    document = np.searchsorted(shard.starts, places, side="right") - 1
                    columns = [pa.array(shard.doc_ids[document], pa.int64()), pa.array(places - shard.starts[document], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "position"])

        found = self._shards(manifest).select("file").mapInArrow(run, "id long, position long")
        return found.select(external_id("id").alias("doc_id"), "position")


def write_and_read(spark: SparkSession, docs: DataFrame, path: str = DEFAULT_PATH) -> DataFrame:
    shards = WaveletShards(path)
    return shards.read(shards.write(docs))
