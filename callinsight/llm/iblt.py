"""Document fingerprints as invertible Bloom lookup sketches, with DataFrame functions only.

A text's paragraphs, cut by a pattern, become 64-bit digests (a paragraph that occurs again gets a digest of its
own). The sketch has three tables of ``CELLS / 3`` cells; a digest falls into one cell
of each, where its count, its XOR and the XOR of its check value are kept. Two sketches subtract cell by
cell; what both texts share cancels. A cell left with one digest gives it away, it is peeled from its other
cells, and so on. If cells remain, the sketch was too small: its counts tell about how many digests differ, and the
same is done with so many sketches, a power of four, over a share of the digests each, and where one of them is too
small with four in its place, again and again, until all differing digests are recovered.

All of it is expressions on one row, linear in the text; memory is that of one document. The next
document is found by cutting the ids into ranges of about equal size at existing ids (the only thing that
the driver sees) and by sending the first row of each range to the range before it as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callinsight.llm.common import external_id, internal_id, text_of

CELLS = 18
_TABLE = CELLS // 3
#: Attempts after the first, each with four times the sketches; all 64 bits of a digest are used up by then.
ATTEMPTS = 32
ROUNDS = 12
#: Digests that a sketch of the first attempt after the first is to hold, about.
LOAD = 5
#: Paragraphs end at every line break and every sentence end, so where one ends depends on what is there alone.
PARAGRAPH_END = r"[.!?\n]+"

# --- SQL of one row: "els" are digests, "cells" a sketch ---------------------------------------


def _element(x: str, sign: int = 1) -> str:
    """A digest with its check value and, as bits of ``m``, its cell in each table."""
    places = " | ".join(f"shiftleft(1, cast({_TABLE * j} + pmod(shiftright({x}, {13 * j}), {_TABLE}) as int))" for j in range(3))
    return f"named_struct('s', {sign}, 'x', {x}, 'c', xxhash64({x}, 2L), 'm', {places})"


def _hits(m: str, i: str) -> str:
    return f"getbit({m}, {i}) = 1Y"


def digests_sql(text: str, paragraph_end: str = PARAGRAPH_END) -> str:
    """Distinct 64-bit digests of the paragraphs of ``text``, ascending by paragraph."""
    parts = f"filter(split({text}, '{paragraph_end}'), p -> p <> '')"
    hashed = f"sort_array(transform({parts}, p -> xxhash64(p)))"
    # Equal digests lie together; the k-th of a run becomes the digest of (digest, k).
    starts = "filter(sequence(0, size(s) - 1), i -> i = 0 or s[i] <> s[i - 1])"
    ends = "if(j + 1 < size(st), st[j + 1], size(s))"
    numbered = f"flatten(transform(st, (b, j) -> transform(sequence(1, {ends} - b), k -> xxhash64(s[b], k))))"
    some = f"transform(array({starts}), st -> {numbered})[0]"
    return f"transform(array({hashed}), s -> if(size(s) = 0, cast(array() as array<bigint>), {some}))[0]"


def _cells(els: str) -> str:
    """A sketch of elements with the sign ``s``."""
    zero = "named_struct('n', 0, 'x', 0L, 'c', 0L)"
    add = "named_struct('n', a.n + e.s, 'x', a.x ^ e.x, 'c', a.c ^ e.c)"
    return (
        f"transform(array({els}), es -> transform(sequence(0, {CELLS - 1}), "
        f"i -> aggregate(filter(es, e -> {_hits('e.m', 'i')}), {zero}, (a, e) -> {add})))[0]"
    )


def sketch_sql(els: str) -> str:
    return _cells(f"transform({els}, x -> {_element('x')})")


def difference_sql(a: str, b: str) -> str:
    """The sketch of ``a`` less that of ``b``, in one go: sketches are linear."""
    return _cells(f"concat(transform({a}, x -> {_element('x')}), transform({b}, x -> {_element('x', -1)}))")


def subtract_sql(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (p, q) -> named_struct('n', p.n - q.n, 'x', p.x ^ q.x, 'c', p.c ^ q.c))"


def peel_sql(cells: str) -> str:
    """(ok, found array<struct<n, x>>): n is 1 for digests of the first text alone, -1 for the second."""
    nothing = "cast(array() as array<struct<n:int,x:bigint>>)"
    alone = "filter(s.cells, c -> abs(c.n) = 1 and xxhash64(c.x, 2L) = c.c)"
    once = f"array_distinct(transform({alone}, c -> named_struct('n', c.n, 'x', c.x)))"
    pure = f"transform({once}, p -> named_struct('n', p.n, 'e', {_element('p.x')}))"
    taken = f"aggregate(filter(pure, q -> {_hits('q.e.m', 'i')}), c, (a, q) -> named_struct('n', a.n - q.n, 'x', a.x ^ q.e.x, 'c', a.c ^ q.e.c))"
    step = (
        f"if(s.done, s, transform(array({pure}), pure -> if(size(pure) = 0, named_struct('done', true, 'cells', s.cells, 'found', s.found), "
        f"named_struct('done', false, 'cells', transform(s.cells, (c, i) -> {taken}), "
        "'found', concat(s.found, transform(pure, q -> named_struct('n', q.n, 'x', q.e.x))))))[0])"
    )
    end = "named_struct('ok', forall(s.cells, c -> c.n = 0 and c.x = 0 and c.c = 0), 'found', s.found)"
    begin = f"named_struct('done', false, 'cells', {cells}, 'found', {nothing})"
    return f"aggregate(sequence(1, {ROUNDS}), {begin}, (s, r) -> {step}, s -> {end})"


def splits_sql(cells: str) -> str:
    """How often the digests of a difference are cut in four before sketches of ``CELLS`` cells hold them.

    In each table the squares of the counts add up to about the differing digests, but for what the texts differ in
    number, which no cell hides; this decides only what is tried first."""
    net = f"aggregate({cells}, 0D, (a, c) -> a + c.n) / 3"
    squares = f"aggregate({cells}, 0D, (a, c) -> a + double(c.n) * c.n) / 3"
    differ = f"greatest(abs({net}), ({squares} - {net} * {net} / {_TABLE}) * {_TABLE} / {_TABLE - 1})"
    return f"cast(least({ATTEMPTS}, greatest(1, ceil(log(4, greatest(1D, {differ}) / {LOAD})))) as int)"


def differing_sql(a: str, b: str, cells_a: str, cells_b: str) -> str:
    """The digests in which two texts differ: from their sketches, else with more sketches.

    What does not peel is dealt to four times as many sketches by the next two bits of the digests, from the
    top; their cells follow from the bits at the bottom. After the first sketch the digests are dealt as often as
    :func:`splits_sql` says before the next sketches are made.
    """
    bits = "(shiftright(x, cast(62 - 2 * k as int)) & 3) = j"
    split = (
        "filter(flatten(transform(t.open, o -> transform(sequence(0, 3), j -> "
        f"named_struct('a', filter(o.a, x -> {bits}), 'b', filter(o.b, x -> {bits}))))), o -> size(o.a) + size(o.b) > 0)"
    )
    tried = f"transform({split}, o -> named_struct('o', o, 'r', {peel_sql(difference_sql('o.a', 'o.b'))}))"
    attempt = (
        f"transform(array({tried}), w -> named_struct('skip', t.skip, 'open', transform(filter(w, v -> not v.r.ok), v -> v.o), "
        "'found', concat(t.found, flatten(transform(filter(w, v -> v.r.ok), v -> v.r.found)))))[0]"
    )
    dealt = f"named_struct('skip', t.skip, 'open', {split}, 'found', t.found)"
    parts = "array<struct<a:array<bigint>,b:array<bigint>>>"
    whole = f"array(named_struct('a', {a}, 'b', {b}))"
    nothing = "cast(array() as array<struct<n:int,x:bigint>>)"
    first = (
        f"transform(array({subtract_sql(cells_a, cells_b)}), d -> transform(array({peel_sql('d')}), r -> named_struct("
        f"'skip', if(r.ok, 0, {splits_sql('d')}), "
        f"'open', if(r.ok, cast(array() as {parts}), {whole}), 'found', if(r.ok, r.found, {nothing})))[0])[0]"
    )
    step = f"if(size(t.open) = 0, t, if(k + 1 < t.skip, {dealt}, {attempt}))"
    return f"aggregate(sequence(0, {ATTEMPTS - 1}), {first}, (t, k) -> {step}, t -> t.found)"


def fingerprint_sql(cells: str) -> str:
    """The sketch as text: 28 hex digits a cell (count, XOR of digests, XOR of check values)."""
    cell = "concat(lpad(hex(c.n & 65535), 4, '0'), lpad(hex(c.x), 16, '0'), lpad(hex(c.c & 4294967295L), 8, '0'))"
    return f"lower(array_join(transform({cells}, c -> {cell}), ''))"


# --- Documents --------------------------------------------------------------------------------


def fingerprints(docs: DataFrame, paragraph_end: str = PARAGRAPH_END) -> DataFrame:
    """``docs`` with ``digests`` (array<long>), ``cells`` and ``fingerprint`` of ``text``; NULL counts as
    empty, an empty text has no paragraphs and empty cells."""
    out = docs.withColumn("digests", F.expr(digests_sql("coalesce(text, '')", paragraph_end)))
    out = out.withColumn("cells", F.expr(sketch_sql("digests")))
    return out.withColumn("fingerprint", F.expr(fingerprint_sql("cells")))


def likeness(found: Column, a: Column, b: Column) -> Column:
    """Shared paragraphs as a share of all, from 0 to 1; two texts without any are alike."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise((both - F.size(found)) / (both + F.size(found)))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` (id, text, ...) with ``next_<column>`` of the row that follows by (id, text); the first row
    follows the last. One shuffle, by ranges of ids."""
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [n / parts for n in range(parts)]
    bounds = docs.agg(F.percentile_approx("id", shares, 10_000), F.min("id")).first()
    bounds = sorted({bounds[1], *(bounds[0] or [])} - {None})
    if not bounds:
        return docs.select("*", *[F.lit(None).cast(docs.schema[c].dataType).alias(f"next_{c}") for c in columns])
    edges = F.array(*map(F.lit, bounds))
    chunk = F.size(F.filter(edges, lambda b: b <= F.col("id"))) - 1
    opens = F.array_contains(edges, F.col("id"))
    here = F.struct(F.col("_chunk").alias("chunk"), F.lit(False).alias("extra"))
    there = F.struct(F.pmod(F.col("_chunk") - 1, F.lit(len(bounds))).alias("chunk"), F.lit(True).alias("extra"))
    rows = docs.withColumn("_chunk", chunk)
    rows = rows.withColumn("_at", F.explode(F.when(opens, F.array(here, there)).otherwise(F.array(here))))
    rows = rows.withColumn("_chunk", F.col("_at.chunk")).withColumn("_extra", F.col("_at.extra")).drop("_at")
    order = Window.partitionBy("_chunk").orderBy("_extra", "id", "text")
    ahead = {f"next_{c}": F.lead(c).over(order) for c in columns}
    return rows.withColumns(ahead).where(~F.col("_extra")).drop("_chunk", "_extra")


def compared(docs: DataFrame, paragraph_end: str = PARAGRAPH_END) -> DataFrame:
    """Each document next to its edited text and to the next document.

    (doc_id, n_chars, edited, fingerprint, edited_fingerprint, edited_difference, next_difference, near_edited,
    near_next); the differences are array<struct<n, x>>, the recovered digests. The edit replaces the last
    quarter of the code points by the first ones of the next document. A sole document follows itself.
    """
    own = fingerprints(docs.select(internal_id().alias("id"), text_of().alias("text")), paragraph_end)
    own = with_next(own, ["text", "digests", "cells"])
    chars = F.length("text")
    cut = F.floor(chars / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), chars - cut), F.substr("next_text", F.lit(1), cut))
    both = own.select("id", chars.cast("long").alias("n_chars"), edited.alias("edited"), "digests", "cells", "fingerprint", "next_digests", "next_cells")
    both = both.withColumn("edited_digests", F.expr(digests_sql("edited", paragraph_end)))
    both = both.withColumn("edited_cells", F.expr(sketch_sql("edited_digests")))
    return both.select(
        external_id("id").alias("doc_id"),
        "n_chars",
        "edited",
        "fingerprint",
        F.expr(fingerprint_sql("edited_cells")).alias("edited_fingerprint"),
        F.expr(differing_sql("digests", "edited_digests", "cells", "edited_cells")).alias("edited_difference"),
        F.expr(differing_sql("digests", "next_digests", "cells", "next_cells")).alias("next_difference"),
        "digests", "edited_digests", "next_digests",
    ).select(
        "doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "edited_difference", "next_difference",
        likeness(F.col("edited_difference"), F.col("digests"), F.col("edited_digests")).alias("near_edited"),
        likeness(F.col("next_difference"), F.col("digests"), F.col("next_digests")).alias("near_next"),
    )
