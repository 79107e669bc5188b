"""Byte-level BPE by traversing a trie of distinct words, and its inverse.

A text is cut into pre-tokens ("words"); what BPE makes of a word depends on the word alone. The distinct
words of a batch form a trie. Each node of it, a prefix, has one state: the last token of the prefix's
encoding. The state follows from states nearer the root: of the tokens that end the prefix, exactly one
is such that BPE would never have merged it with (or across into) the token before it. Walking
the trie depth first, a prefix shared by many words is worked out once, and a word's encoding is read
off backwards, one state per token. Sorted words are such a walk; only the states on the path to
the current word are held.

Encoded words are remembered in each worker for later batches, in two generations of bounded size. That
changes the speed only.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callinsight.llm.common import internal_id, per_worker, text_of

DEFAULT_PATH = public_tokenizers.path("byte_bpe_50k.json")
#: Fixed by the vocabulary's format: how text is cut before merging (white space in the sense of Unicode).
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Words with more characters are left to the trie, whose time grows with the length alone.
LONG = 100
#: Characters worked on at once in a worker.
CHUNK = 1_000_000


def _byte_alphabet() -> dict[str, int]:
    """The format writes a byte as a printable character: itself, or else the next one from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Vocabulary:
    """Tables of a ``tokenizers`` file with a byte-level BPE model."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = _byte_alphabet()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {text: i for text, i in spec["model"]["vocab"].items() if text not in self.added}
        self.token = {i: bytes(alphabet[c] for c in text) for text, i in ids.items()}
        self.id_of = {token: i for i, token in self.token.items()}
        self.token |= {i: text.encode() for text, i in self.added.items()}
        # The tokens spelt backwards, as a trie: (node, byte) to node, and the token that ends at a node or -1.
        self.down: dict[int, int] = {}
        self.ends = [-1]
        for token, i in self.id_of.items():
            node = 0
            for byte in reversed(token):
                node = self.down.setdefault(node << 8 | byte, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = i
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}  # the rank of the merge that makes a token; -1 for single bytes
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            both, whole = (ids[left], ids[right]), ids[left + right]
            self.rank[both] = rank
            if whole not in self.parts:
                self.parts[whole], self.made[whole] = both, rank
        self._apart: dict[int, bool] = {}

    def columns(self) -> tuple[pa.Array, pa.Array]:
        """The bytes and the decimal number of each token, by id."""
        ids = range(max(self.token) + 1)
        return pa.array([self.token.get(i) for i in ids], pa.binary()), pa.array([str(i) if i in self.token else None for i in ids], pa.string())

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether BPE over the bytes of both tokens gives just these two tokens.

        Undo both merges step by step, the later one first. At each step the two pieces that touch are
        those that touched in the run of BPE; a merge of them that would have come before the merges
        which used them up proves the opposite. At equal rank the place further left goes first.
        """
        key = left << 32 | right
        known = self._apart.get(key)
        if known is not None:
            return known
        made, none = self.made, 1 << 60
        a, b, a_until, b_until, apart = left, right, none, none, True
        while True:
            rank = self.rank.get((a, b))
            if rank is not None and rank < a_until and rank <= b_until:
                apart = False
                break
            a_made, b_made = made.get(a, -1), made.get(b, -1)
            if a_made < 0 and b_made < 0:
                break
            if a_made > b_made:
                a, a_until = self.parts[a][1], a_made
            else:
                b, b_until = self.parts[b][0], b_made
        if len(self._apart) >= 200_000:
            self._apart.clear()
        self._apart[key] = apart
        return apart

    def encode_sorted(self, words: Iterable[bytes]) -> Iterator[list[int]]:
        """The encodings of sorted, distinct, non-empty words."""
        token, apart, known, down, ends = self.token, self.stay_apart, self._apart.get, self.down.__getitem__, self.ends
        last, before = [-1], b""  # last[n]: last token of the current word's first n bytes
        for word in words:
            shared = 0
            for x, y in zip(before, word, strict=False):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                node, start = 0, end
                while True:  # exactly one token that ends here fits what is before it
                    start -= 1
                    node = down(node << 8 | word[start])
                    t = ends[node]
                    if t < 0:
                        continue
                    if start:
                        ok = known(last[start] << 32 | t)
                        if ok is None:
                            ok = apart(last[start], t)
                        if not ok:
                            continue
                    last.append(t)
                    break
            out, at = [], len(word)
            while at:
                out.append(last[at])
                at -= len(token[last[at]])
            out.reverse()
            before = word
            yield out

    def ranks_suffice(self) -> bool:
        """Whether merging neighbours by the number of the token they form, whatever the pair, gives the listed merges.

        It does if numbers grow with the merges, no token is made before its parts and each token's own bytes encode as
        it alone: then its bytes never lie in two neighbours other than its parts when its turn comes."""
        order = sorted(self.made, key=self.made.__getitem__)
        if order != sorted(order) or any(self.made.get(p, -1) >= self.made[t] or p > t for t in order for p in self.parts[t]):
            return False
        tokens = sorted(self.id_of)
        return all(ids == [self.id_of[t]] for t, ids in zip(tokens, self.encode_sorted(tokens), strict=True))


class Sizes(dict):
    """From a word to its number of tokens, worked out when first asked for and remembered in two generations.

    Words come one by one, so they are not walked as a trie: ``tiktoken`` merges them by rank, where that is the same."""

    def __init__(self, vocabulary: Vocabulary, remember: int):
        super().__init__()
        self.vocabulary, self.remember, self.old = vocabulary, remember, {}
        self.merged = None
        if vocabulary.ranks_suffice():
            uncut = tiktoken.Encoding("words", pat_str="(?s:.+)", mergeable_ranks=vocabulary.id_of, special_tokens={})
            self.merged = uncut.encode_ordinary

    def __missing__(self, word: str) -> int:
        if len(self) > self.remember:
            self.old = dict(self)
            self.clear()
        size = self.old.get(word)
        if size is None:
            if self.merged and len(word) <= LONG:
                size = len(self.merged(word))
            else:
                (ids,) = self.vocabulary.encode_sorted([word.encode("utf-8", "surrogatepass")])
                size = len(ids)
        self[word] = size
        return size


class Encoder:
    """Encodes texts with a vocabulary, remembering words in two generations."""

    def __init__(self, path: str, remember: int = 160_000):
        self.vocabulary = Vocabulary(path)
        self.remember = remember
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pattern = regex.compile(WORDS)
        self.words = self.pattern.findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.vocabulary.added)) + ")") if self.vocabulary.added else None

    @cached_property
    def sizes(self) -> Sizes:
        return Sizes(self.vocabulary, self.remember)

    def learn(self, words: Iterable[str]) -> None:
        """Have the encodings (little-endian 32-bit ids) of all ``words`` in ``young``."""
        if len(self.young) > self.remember:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        todo = []
        for word in words:
            if word not in young:
                got = old.get(word)
                if got is None:
                    todo.append(word.encode("utf-8", "surrogatepass"))
                else:
                    young[word] = got
        todo.sort()
        for word, ids in zip(todo, self.vocabulary.encode_sorted(todo), strict=True):
            young[word.decode("utf-8", "surrogatepass")] = struct.pack(f"<{len(ids)}I", *ids)

    def split(self, text: str) -> list[list[str] | int]:
        """Word lists, and between them the ids of special tokens that the text spells out."""
        if self.special is None or not any(s in text for s in self.vocabulary.added):
            return [self.words(text)]
        parts = self.special.split(text)
        return [self.vocabulary.added[p] if n % 2 else self.words(p) for n, p in enumerate(parts)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        cut = [self.split(t) for t in texts]
        self.learn(set(chain.from_iterable(p for parts in cut for p in parts if isinstance(p, list))))
        get = self.young.__getitem__
        out = []
        for parts in cut:
            encoded = b"".join(
                b"".join(map(get, p)) if isinstance(p, list) else np.array([p], "<u4").tobytes() for p in parts
            )
            out.append(np.frombuffer(encoded, "<u4"))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.vocabulary.token.__getitem__, ids)).decode("utf-8", "replace")


def encoder(path: str = DEFAULT_PATH) -> Encoder:
    return per_worker(f"bpe:{path}", lambda: Encoder(path))


def chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of ``batch`` with about ``CHUNK`` bytes of text or one row each."""
    sizes = np.asarray(pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), np.int64)
    start = 0
    while start < batch.num_rows:
        n = max(1, int(np.searchsorted(np.cumsum(sizes[start:]), CHUNK, side="right")))
        part = batch.slice(start, n)
        yield part, part.column(column).to_pylist()
        start += n


def encode(docs: DataFrame, path: str = DEFAULT_PATH) -> DataFrame:
    """(id, ids array<int>), one row per row of ``docs`` (doc_id, text); NULL and empty texts have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            for part, texts in chunks(batch):
                found = bpe.encode(texts)
                offsets = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
                flat = np.concatenate([*found, np.zeros(0, "<u4")]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column("id"), ids], ["id", "ids"])

    return docs.select(internal_id().alias("id"), text_of().alias("text")).mapInArrow(run, "id long, ids array<int>")


def decode(encoded: DataFrame, path: str = DEFAULT_PATH) -> DataFrame:
    """(id, n, text, ids_text): how many ``ids``, their text, and they in decimal joined by commas. NULL: empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        token, decimal = per_worker(f"bpe-tokens:{path}", bpe.vocabulary.columns)
        for whole in batches:
            sizes = pa.compute.list_value_length(whole.column("ids")).to_numpy(zero_copy_only=False)
            start = 0
            while start < whole.num_rows:  # about CHUNK ids at once, or one row
                batch = whole.slice(start, max(1, int(np.searchsorted(np.cumsum(sizes[start:]), CHUNK, side="right"))))
                start += batch.num_rows
                offsets = batch.column("ids").offsets
                flat = batch.column("ids").values.slice(offsets[0].as_py(), offsets[-1].as_py() - offsets[0].as_py())
                own = token.take(flat)
                if own.null_count:
                    raise KeyError("an id that no token has")
                offsets = pa.compute.subtract(offsets, offsets[0])
                texts = pa.compute.binary_join(pa.ListArray.from_arrays(offsets, own), b"")
                try:
                    texts = texts.cast(pa.string())
                except pa.ArrowInvalid:  # some bytes are no UTF-8
                    texts = pa.array([text.as_py().decode("utf-8", "replace") for text in texts], pa.string())
                counts = pa.compute.list_value_length(batch.column("ids")).cast(pa.int64())
                columns = [batch.column("id"), counts, texts, pa.compute.binary_join(pa.ListArray.from_arrays(offsets, decimal.take(flat)), ",")]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "text", "ids_text"])

    ids = F.coalesce("ids", F.array().cast("array<int>")).alias("ids")
    return encoded.select("id", ids).mapInArrow(run, "id long, n long, text string, ids_text string")
