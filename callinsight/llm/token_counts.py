"""Token counts that follow edits without encoding the text again.

A document is kept as its pre-tokens in leaves of a segment tree whose inner nodes hold the sums of code points and
tokens below them. An edit finds its place by the sums, cuts the text anew from shortly before the edit, as far
back as the edit can change a cut, until a new cut falls on an old one beyond it, encodes only the pre-tokens
in between, and corrects the sums on the way to the root. The total is always the root's.

Counts are those of the tokenizer with special strings as ordinary text; a word is encoded when its count is first
asked for, see ``bpe.Sizes``. Documents are independent rows; nothing is
shuffled, and a worker holds the trees of one document. Trees can be kept: ``trees`` makes them once, a table of them is
written, and ``edit_trees`` applies further edits to it without the tokenizer seeing the rest of the text.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate, pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callinsight.llm import bpe
from callinsight.llm.common import external_id, internal_id, text_of

LEAF = 64
#: A cut depends on the text up to this many code points beyond it: the rest of white space and what follows.
AHEAD = 2
EDITS = "array<struct<start:int,end:int,text:string>>"


class TokenTree:
    """``encoder``: its ``pattern`` cuts texts, its ``sizes`` tell the tokens of a word."""

    def __init__(self, words: list[str], encoder: bpe.Encoder):
        self.encoder = encoder
        self.encoded = 0  # words that edits had encoded anew
        self._build([words[i : i + LEAF] for i in range(0, len(words), LEAF)] or [[]])

    @classmethod
    def kept(cls, words: list[str], leaf_words: list[int], leaf_tokens: list[int], encoder: bpe.Encoder) -> TokenTree:
        """The tree of stored leaves; their sums are taken as they are, and no word is encoded."""
        tree = cls.__new__(cls)
        tree.encoder, tree.encoded = encoder, 0
        ends = [0, *accumulate(leaf_words)]
        leaves = [words[a:b] for a, b in pairwise(ends)] or [[]]
        tree._build(leaves, [(sum(map(len, leaf)), tokens) for leaf, tokens in zip(leaves, leaf_tokens or [0], strict=True)])
        return tree

    def _build(self, leaves: list[list[str]], known: list[tuple[int, int] | None] | None = None) -> None:
        """``known``: the sums (code points, tokens) of leaves that have them."""
        self.leaves = leaves
        self.width = 1 << (len(leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for n in range(len(leaves)):
            if known and known[n] is not None:
                self.chars[self.width + n], self.tokens[self.width + n] = known[n]
            else:
                self._sum_leaf(n)
        for n in range(self.width - 1, 0, -1):
            self.chars[n] = self.chars[2 * n] + self.chars[2 * n + 1]
            self.tokens[n] = self.tokens[2 * n] + self.tokens[2 * n + 1]

    def _sum_leaf(self, n: int) -> None:
        leaf = self.leaves[n]
        self.chars[self.width + n] = sum(map(len, leaf))
        self.tokens[self.width + n] = sum(map(self.encoder.sizes.__getitem__, leaf))

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join("".join(leaf) for leaf in self.leaves)

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds code point ``at`` (the last one for the end) and where the leaf begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if at >= begin + self.chars[node] and self.chars[node + 1]:
                begin += self.chars[node]
                node += 1
        return min(node - self.width, len(self.leaves) - 1), begin

    def edit(self, start: int, end: int, text: str) -> None:
        """Replace code points start..end (clipped to the text) by ``text``."""
        start = max(0, min(start, self.length))
        end = max(start, min(end, self.length))
        first, begin = self._find(max(0, start - AHEAD))
        leaf = self.leaves[first]
        ends = [0, *accumulate(map(len, leaf))]
        keep = max(0, bisect_right(ends, start - AHEAD - begin) - 1)
        begin += ends[keep]
        # The old words from the cut on, read leaf by leaf, and the text that they become.
        last, old = first, leaf[keep:]
        span = sum(map(len, old))
        while True:
            while begin + span < end + AHEAD + 1 and last + 1 < len(self.leaves):
                last += 1
                old.extend(self.leaves[last])
                span += sum(map(len, self.leaves[last]))
            whole = last + 1 == len(self.leaves)
            was = "".join(old)
            now = was[: start - begin] + text + was[end - begin :]
            shift = len(now) - len(was)
            cuts = [0, *accumulate(map(len, old))]  # in places of the old text
            n = bisect_left(cuts, end - begin)  # the first at or beyond the edit
            fresh, meets = [], None
            for match in self.encoder.pattern.finditer(now):
                if not whole and match.end() > len(now) - AHEAD:
                    break
                fresh.append(match.group())
                place = match.end() - shift
                while n < len(old) and cuts[n] < place:
                    n += 1
                if n < len(old) and cuts[n] == place:
                    meets = n
                    break
            if meets is None and whole:
                meets = len(old)
            if meets is not None:
                break
            before = last
            last = min(last + 1, len(self.leaves) - 1)
            if last > before:
                old.extend(self.leaves[last])
                span += sum(map(len, self.leaves[last]))
        self.encoded += len(fresh)
        self._replace(first, keep, last, fresh + old[meets:])

    def _replace(self, first: int, keep: int, last: int, words: list[str]) -> None:
        words = self.leaves[first][:keep] + words
        count = last - first + 1
        if len(words) > 4 * LEAF * count:
            sums = [(self.chars[self.width + n], self.tokens[self.width + n]) for n in range(len(self.leaves))]
            made = [words[i : i + LEAF] for i in range(0, len(words), LEAF)]
            self._build(self.leaves[:first] + made + self.leaves[last + 1 :], [*sums[:first], *[None] * len(made), *sums[last + 1 :]])
            return
        share = -(-len(words) // count) if words else 1
        for k in range(count):
            self.leaves[first + k] = words[k * share : (k + 1) * share]
            self._sum_leaf(first + k)
        nodes = {(self.width + first + k) // 2 for k in range(count)}
        while nodes and 0 not in nodes:
            for n in nodes:
                self.chars[n] = self.chars[2 * n] + self.chars[2 * n + 1]
                self.tokens[n] = self.tokens[2 * n] + self.tokens[2 * n + 1]
            nodes = {n // 2 for n in nodes}


def tree(text: str, encoder: bpe.Encoder) -> TokenTree:
    return TokenTree(encoder.words(text), encoder)


_TREES = "id long, text string, word_chars array<int>, leaf_words array<int>, leaf_tokens array<int>, n_tokens long, encoded_words long"


def _rows(ids: pa.Array, trees: list[TokenTree]) -> pa.RecordBatch:
    ints = lambda of: pa.array([of(t) for t in trees], pa.list_(pa.int32()))
    columns = [
        ids,
        pa.array([t.text() for t in trees], pa.string()),
        ints(lambda t: [len(w) for leaf in t.leaves for w in leaf]),
        ints(lambda t: [len(leaf) for leaf in t.leaves]),
        ints(lambda t: t.tokens[t.width : t.width + len(t.leaves)]),
        pa.array([t.total for t in trees], pa.int64()),
        pa.array([t.encoded for t in trees], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _TREES.split(", ")])


def trees(docs: DataFrame, path: str = bpe.DEFAULT_PATH) -> DataFrame:
    """(doc_id, text, word_chars, leaf_words, leaf_tokens, n_tokens, encoded_words): the segment tree of each row of
    ``docs`` (doc_id, text), to be written and edited later by ``edit_trees``. The text is cut and encoded here, once.

    ``word_chars``: lengths of the pre-tokens; ``leaf_words`` and ``leaf_tokens``: pre-tokens and tokens of the leaves, from
    which the inner sums follow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(path)
        for batch in batches:
            for part, texts in bpe.chunks(batch):
                yield _rows(part.column("id"), [tree(t, encoder) for t in texts])

    made = docs.select(internal_id().alias("id"), text_of().alias("text")).mapInArrow(run, _TREES)
    return made.withColumn("id", external_id("id")).withColumnRenamed("id", "doc_id")


def edit_trees(stored: DataFrame, path: str = bpe.DEFAULT_PATH) -> DataFrame:
    """The trees ``stored`` (the columns of ``trees`` and ``edits``, see ``count_edits``) after their edits, with the same
    columns. A text is neither cut nor encoded again but for the words around its edits; ``encoded_words`` counts these.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(path)
        for batch in batches:
            for part, texts in bpe.chunks(batch):
                done = []
                for text, chars, words, tokens, edits in zip(texts, *(part.column(c).to_pylist() for c in _STORED), strict=True):
                    cut = [text[a:b] for a, b in pairwise([0, *accumulate(chars)])]
                    kept = TokenTree.kept(cut, words, tokens, encoder)
                    for e in edits or []:
                        kept.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
                    done.append(kept)
                yield _rows(part.column("id"), done)

    narrow = stored.select(internal_id().alias("id"), "text", *_STORED[:-1], F.col("edits").cast(EDITS).alias("edits"))
    return narrow.mapInArrow(run, _TREES).withColumn("id", external_id("id")).withColumnRenamed("id", "doc_id")


_STORED = ["word_chars", "leaf_words", "leaf_tokens", "edits"]


def count_edits(docs: DataFrame, path: str = bpe.DEFAULT_PATH) -> DataFrame:
    """(doc_id, n_tokens, edited_tokens, n_words, encoded_words, edited_text), a row per row of ``docs``
    (doc_id, text, edits): the count before and after the edits, which apply one after the other to the text as
    it is by then. Offsets beyond the text are clipped; NULL edits, texts and replacements count as empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(path)
        for batch in batches:
            for part, texts in bpe.chunks(batch):
                out: list[list] = [[], [], [], [], []]
                for text, edits in zip(texts, part.column("edits").to_pylist(), strict=True):
                    cut = encoder.words(text)
                    grown = TokenTree(cut, encoder)
                    before = grown.total
                    for e in edits or []:
                        grown.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
                    for column, value in zip(out, (before, grown.total, len(cut), grown.encoded, grown.text()), strict=True):
                        column.append(value)
                columns = [part.column("id"), *[pa.array(c, pa.int64()) for c in out[:4]], pa.array(out[4], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "edited_tokens", "n_words", "encoded_words", "edited_text"])

    narrow = docs.select(internal_id().alias("id"), text_of().alias("text"), F.col("edits").cast(EDITS).alias("edits"))
    counted = narrow.mapInArrow(run, "id long, n_tokens long, edited_tokens long, n_words long, encoded_words long, edited_text string")
    return counted.select(external_id("id").alias("doc_id"), "n_tokens", "edited_tokens", "n_words", "encoded_words", "edited_text")


def usual_edits(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``edits`` of a revision: a passage goes, one is repeated, one is put in, the end is
    rewritten. All follow from the text alone."""
    n = F.length(text_of())
    at = lambda share: F.floor(n * share).cast("int")
    edit = lambda start, end, text: F.struct(start.alias("start"), end.alias("end"), text.alias("text"))
    return docs.select("doc_id", "text").withColumn(
        "edits",
        F.array(
            edit(at(0.25), at(0.25) + F.least(at(0.05), F.lit(200)), F.lit("")),
            edit(at(0.5), at(0.5), F.substr(text_of(), at(0.1) + 1, F.lit(120))),
            edit(at(0.7), at(0.7) + 5, F.lit(" Revised, it's 2 lines:\n\n")),
            edit(n - 3, n + 10, F.lit("the end.")),
        ),
    )
