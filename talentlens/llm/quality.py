"""Quality rules with an n-gram perplexity model.

The model is a modified Kneser-Ney model of order four over the code points themselves, one
for each value of the language column, however many there are.  Nothing is folded, dropped or capped:
Spark counts every n-gram of all documents, joins the orders with their contexts and back-offs, and
only joins move the model; the driver sees none of it.

Texts are staged in blocks, in buckets by block.  A block's distinct n-grams go into the counting, their scores
come back to the block as arrays of hashes and scores, and the documents of the block are scored against that table:
n-grams are shuffled once for each block that has them, not for each document, and texts are not shuffled.

A document is scored without its own evidence: n-grams and contexts that no other document has
count as unseen, or junk would predict itself (the counts of all others include its own).  An n-gram of a document is had
by another one just when two documents have it, so the score of an n-gram is the same in all of them.

A document that passes the base rules is rejected if its perplexity lies outside its
language's band.  Bands come from a histogram over the distinct texts of the language that
pass the base rules: the median and ``reach`` robust standard deviations (1.4826 times the
median distance from the median) on both sides, taken again from the texts inside until the
band stays: a hot source with a third of a language's documents moves it little.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .folded_ngrams import KneserNey, codes  # noqa: F401  (tests take them from here)
from .staging import bucketed, columns_to_keep, release, stage
from .text import SPACES, U64, Rolling, bytes_of, covered, give_back, mix, slices, sums_by, tidy, word_hashes, word_spans

ORDER = 4
#: Stands before a text, ORDER - 1 times: a code point that no text should hold.
PADDING = 0xFDD0
#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 16 << 20
#: Bytes of text in a bucket of blocks, about, and buckets at least.
BUCKET_BYTES, MIN_BUCKETS = 32 << 20, 200
#: Scores that a task merges by block before they are shuffled.
TABLE_ENTRIES = 1_000_000
#: Robust standard deviations that a band reaches on both sides of the median.
REACH = 5.0
#: A language's standard deviation, in bits per character, counts as this at least.
LEAST_SPREAD = 0.02
#: So many distinct texts double the band; more widen it less.
FEW_TEXTS = 20
#: Histogram bins of a bit of log-perplexity, and bins in all.
BINS_PER_BIT, BINS = 2000, 40_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SLICE = 1 << 20

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def blocks(rows: DataFrame) -> DataFrame:
    """``rows`` packed: (block, first, packed) with a run of rows and the number of its first one, unique over all rows."""

    def run(batches):
        task = TaskContext.get().partitionId()
        block, size, row_number = 0, 0, 0
        for batch in batches:
            for row, raw, bounds in slices(batch, "body", SLICE):
                n = len(bounds) - 1
                if size and size + len(raw) > BLOCK_BYTES:
                    block, size = block + 1, 0
                size += len(raw)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(batch.slice(row, n))
                yield pa.RecordBatch.from_arrays([pa.array([task << 32 | block], pa.int64()), pa.array([task << 40 | row_number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                                 names=["block", "first", "packed"])
                row_number += n

    return rows.mapInArrow(tidy(run), "block long, first long, packed binary")


def _unpacked(packed: bytes) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    """(batch, first row, bytes, bounds) of a packed run of rows."""
    with pa.ipc.open_stream(packed) as rows:
        for batch in rows:
            for row, raw, bounds in slices(batch, "body", SLICE):
                yield batch, row, raw, bounds


def _code_points(raw: np.ndarray) -> np.ndarray:
    return np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4").astype(U64)


def _hash(points: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Hash of the n-grams whose i-th code points are ``points[i]``, in the languages ``keys``."""
    h = np.zeros(len(points[0]), U64)
    for p in points:
        h = h * U64(0x9E3779B97F4A7C15) + p + U64(1)
    return mix(h + mix(keys.astype(U64)))


def ngrams(raw: np.ndarray, bounds: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the n-gram that ends at each character, bounds by document, padded code points, where each n-gram starts in them)."""
    sizes = sums_by((raw & 0xC0) != 0x80, bounds)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    start = np.arange(len(doc)) + (ORDER - 1) * doc
    padded = np.full(len(doc) + (ORDER - 1) * (len(sizes) + 1), PADDING, U64)
    padded[start + ORDER - 1] = _code_points(raw)
    return _hash([padded[start + k] for k in range(ORDER)], keys[doc]), np.concatenate([[0], np.cumsum(sizes)]), padded, start


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(hash, count, the only document or -1, language, code points) by hash."""
    h, n, only, keys, points = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(h, kind="stable")
    at = np.flatnonzero(np.concatenate([[True], h[order[1:]] != h[order[:-1]]])) if len(h) else np.zeros(0, np.int64)
    if not len(at):
        return h, n, only, keys, points
    only = only[order]
    least, most, head = np.minimum.reduceat(only, at), np.maximum.reduceat(only, at), order[at]
    return h[head], np.add.reduceat(n[order], at), np.where(least == most, least, -1), keys[head], points[head]


def count_ngrams(packed: DataFrame) -> DataFrame:
    """(key, gram, n, only, blocks) over all n-grams of the blocks: ``only`` is the number of the one document that has it, or -1."""

    def counted(raw, bounds, keys, first):
        h, edges, padded, start = ngrams(raw, bounds, keys)
        doc = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        order = np.argsort(h, kind="stable")                      # documents stay in order within an n-gram
        at = np.flatnonzero(np.concatenate([[True], h[order[1:]] != h[order[:-1]]]))
        head, last = order[at], order[np.concatenate([at[1:], [len(order)]]) - 1]
        points = padded[start[head][:, None] + np.arange(ORDER)].astype("<u4")
        return h[head], np.diff(np.concatenate([at, [len(order)]])), np.where(doc[head] == doc[last], first + doc[head], -1), keys[doc[head]], points

    def given(block, parts):
        _, n, only, keys, points = _merged(parts)
        for a in range(0, len(n), 50_000):
            text = points[a:a + 50_000].tobytes().decode("utf-32-le")
            grams = [text[i:i + ORDER] for i in range(0, len(text), ORDER)]
            yield pa.RecordBatch.from_arrays([pa.array(keys[a:a + 50_000]), pa.array(grams, pa.string()), pa.array(n[a:a + 50_000], pa.int64()), pa.array(only[a:a + 50_000], pa.int64()),
                                              pa.array(np.full(len(grams), block), pa.int64())], names=["key", "gram", "n", "only", "block"])

    def run(batches):
        block, parts = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["block"] != block:
                    if parts:
                        yield from given(block, parts)
                    block, parts = r["block"], []
                for rows, row, raw, bounds in _unpacked(r["packed"]):
                    if len(raw):
                        keys = rows.column("key").slice(row, len(bounds) - 1).to_numpy()
                        parts.append(counted(raw, bounds, keys, r["first"] + row))
                if len(parts) > 8:
                    parts = [_merged(parts)]
        if parts:
            yield from given(block, parts)

    return (packed.mapInArrow(tidy(run), "key long, gram string, n long, only long, block long")
            .groupBy("key", "gram").agg(F.sum("n").alias("n"), _only(), F.collect_list("block").alias("blocks")))


def _only() -> Column:
    return F.when(F.min("only") == F.max("only"), F.min("only")).otherwise(F.lit(-1)).alias("only")


def _discounts(grams: DataFrame) -> DataFrame:
    """(key, d1, d2, d3): modified Kneser-Ney discounts of each language for counts of 1, 2 and 3 or more."""
    n = {k: F.col(f"n{k}") for k in range(1, 5)}
    y = n[1] / F.nullif(n[1] + 2 * n[2], F.lit(0.0))
    by_rule = {k: F.greatest(F.lit(0.05), F.least(F.lit(float(k)), k - (k + 1) * y * n[k + 1] / F.nullif(n[k], F.lit(0.0)))) for k in (1, 2, 3)}
    return (grams.groupBy("key").agg(*[F.sum((F.col("n") == k).cast("int")).cast("double").alias(f"n{k}") for k in n])
            .select("key", *[F.when((n[1] == 0) | (n[2] == 0) | (n[k] == 0), F.lit(0.5)).otherwise(by_rule[k]).alias(f"d{k}") for k in by_rule]))


def fit(grams: DataFrame) -> DataFrame:
    """``grams`` with ``bits``: -log2 of the probability of an n-gram's last character after the others, in a document that has the n-gram.

    Lower orders count the distinct characters before them.  ``p`` is the model's probability; ``q`` takes what
    only one document has for unseen.  One row for each language is broadcast, all else is joined.
    """
    levels = {ORDER: grams}
    for n in range(ORDER - 1, 0, -1):
        levels[n] = stage(levels[n + 1].groupBy("key", F.expr("substring(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("n"), _only()), f"grams{n}")
    lower = levels[1].groupBy("key").agg((1 / (F.count(F.lit(1)) + 1)).alias("below")).select("key", F.lit("").alias("rest"), F.col("below").alias("p_below"), F.col("below").alias("q_below"))
    for n in range(1, ORDER + 1):
        d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = (levels[n].join(F.broadcast(_discounts(levels[n])), "key").withColumn("d", d).drop("d1", "d2", "d3")
                .withColumn("context", F.expr(f"substring(gram, 1, {n - 1})")).withColumn("rest", F.expr("substring(gram, 2)")))
        contexts = (rows.groupBy("key", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("freed"), _only())
                    .select("key", "context", "total", (F.col("freed") / F.col("total")).alias("weight"), (F.col("only") == -1).alias("held")))
        p = (F.col("n") - F.col("d")) / F.col("total") + F.col("weight") * F.col("p_below")
        q = F.when(F.col("only") == -1, p).otherwise(F.when(F.col("held"), F.col("weight")).otherwise(F.lit(1.0)) * F.col("q_below"))
        scored = rows.join(contexts, ["key", "context"]).join(lower if n > 1 else F.broadcast(lower), ["key", "rest"])
        if n < ORDER:
            lower = stage(scored.select("key", F.col("gram").alias("rest"), p.alias("p_below"), q.alias("q_below")), f"scores{n}")
    return scored.select("key", "gram", "blocks", (-F.log2(q)).alias("bits"))


def base_counts(raw: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each document of a slice."""
    starts, ends, first = word_spans(raw, bounds)
    in_word = ~SPACES[raw]
    words = word_hashes(raw, starts, ends)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    repeat = np.zeros(len(words), bool)
    if len(words) >= 3:
        h = Rolling(words).every(3)
        at = np.flatnonzero(doc[2:] == doc[:-2])
        key = mix(h[at] + mix(doc[at].astype(U64)))
        order = np.argsort(key)
        same = np.concatenate([[False], key[order[1:]] == key[order[:-1]]])
        often = at[order[same | np.concatenate([same[1:], [False]])]]
        repeat = covered(often, often + 3, len(words))
    breaks = np.flatnonzero(raw == 0x0A)
    line_start = np.sort(np.concatenate([bounds[:-1], breaks + 1]))
    line_doc = np.searchsorted(bounds, line_start, "right") - 1
    # an empty document's start equals the next one's; a break at a document's end starts an empty line of it
    line_end = np.concatenate([line_start[1:], [len(raw)]])
    content_end = line_end - ((line_end > line_start) & (line_end > 0) & (raw[np.maximum(line_end - 1, 0)] == 0x0A) if len(raw) else 0)
    word_count = np.concatenate([[0], np.cumsum(in_word)])
    lines = np.flatnonzero(word_count[content_end] > word_count[line_start])
    n_docs = len(bounds) - 1
    dup = np.zeros(n_docs, np.int64)
    if len(lines):
        a, b = line_start[lines], content_end[lines]
        key = mix(Rolling(raw).window(a, b) + (b - a).astype(U64) * U64(0x9FB21C651E98DF25) + mix(line_doc[lines].astype(U64)))
        _, kept = np.unique(key, return_index=True)
        dup = np.bincount(line_doc[lines], minlength=n_docs) - np.bincount(line_doc[lines[kept]], minlength=n_docs)
    return {"n_words": np.diff(first), "word_chars": sums_by(in_word & ((raw & 0xC0) != 0x80), bounds), "n_symbols": sums_by(_SYMBOLS[raw], bounds),
            "n_dup_lines": dup, "n_repeat_words": sums_by(repeat, first)}


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def tables(scores: DataFrame) -> DataFrame:
    """(block, hashes, bits): 64-bit hashes of n-grams of the block, ascending, and their scores as doubles; a block has several rows."""

    def given(parts):
        block, h, bits = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((h, block))
        block, h, bits = block[order], h[order], bits[order]
        edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]])) if len(block) else np.zeros(1, np.int64)
        for a in range(0, len(edges) - 1, 1000):
            cuts = edges[a:a + 1001]
            yield pa.RecordBatch.from_arrays([pa.array(block[cuts[:-1]]), *(pa.array([x[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()) for x in (h, bits))],
                                             names=["block", "hashes", "bits"])

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            points = _code_points(bytes_of(batch.column("gram"))[0]).reshape(-1, ORDER)
            h, bits, found_in = _hash(list(points.T), batch.column("key").to_numpy()), batch.column("bits").to_numpy(), batch.column("blocks")
            at = np.repeat(np.arange(len(h)), np.diff(found_in.offsets.to_numpy()))
            parts.append((found_in.flatten().to_numpy(), h[at], bits[at]))
            size += len(at)
            if size > TABLE_ENTRIES:
                yield from given(parts)
                parts, size = [], 0
        if parts:
            yield from given(parts)

    return scores.select("key", "gram", "bits", "blocks").mapInArrow(tidy(run), "block long, hashes binary, bits binary")


class _Scores:
    """Scores of a block's n-grams by their hashes."""

    def __init__(self, hashes: list[bytes], bits: list[bytes]):
        h, bits = np.frombuffer(b"".join(hashes), U64), np.frombuffer(b"".join(bits))
        order = np.argsort(h)
        self.h, self.bits = h[order], bits[order]
        self.mask = U64((1 << (4 * len(h)).bit_length()) - 1)
        self.slot = np.zeros(int(self.mask) + 1, np.int32)         # most n-grams are found by their low bits, the others by a search
        self.slot[self.h & self.mask] = np.arange(len(h), dtype=np.int32)

    def of(self, h: np.ndarray) -> np.ndarray:
        if len(h) and not len(self.h):
            raise RuntimeError("a block has no scores")
        at = self.slot[h & self.mask]
        other = np.flatnonzero(self.h[at] != h)
        at[other] = np.minimum(np.searchsorted(self.h, h[other]), len(self.h) - 1)
        if not np.array_equal(self.h[at[other]], h[other]):
            raise RuntimeError("an n-gram of a block has no score")
        return self.bits[at]


def measure(packed: DataFrame, scores: DataFrame, kept: dict[str, str]) -> DataFrame:
    """The columns ``kept``, lang, the base counts and ``bits``, the mean of -log2 p over the characters (null: no characters).

    ``packed`` lies in buckets of blocks: the scores are shuffled to them, the texts stay where they are.
    """

    def judged(batch, row, raw, bounds, table):
        n = len(bounds) - 1
        base, bits = base_counts(raw, bounds), np.full(n, np.nan)
        if len(raw):
            h, first, _, _ = ngrams(raw, bounds, batch.column("key").slice(row, n).to_numpy())
            some = np.diff(first) > 0
            bits[some] = sums_by(table.of(h), first)[some] / np.diff(first)[some]
        part = batch.slice(row, n)
        return pa.RecordBatch.from_arrays([*(part.column(c) for c in [*kept, "lang"]), *(pa.array(base[c], pa.int64()) for c in BASE), pa.array(bits, pa.float64(), from_pandas=True)],
                                          names=[*kept, "lang", *BASE, "bits"])

    def run(texts: pa.Table, scored: pa.Table) -> pa.Table:
        table = _Scores(scored.column("hashes").to_pylist(), scored.column("bits").to_pylist())
        out = pa.Table.from_batches([judged(rows, row, raw, bounds, table) for packed_rows in texts.column("packed") for rows, row, raw, bounds in _unpacked(packed_rows.as_py())])
        give_back()
        return out

    schema = ", ".join([*(f"{x} {t}" for x, t in kept.items()), "lang string", *(f"{c} long" for c in BASE), "bits double"])
    return packed.groupBy("block").cogroup(tables(scores).groupBy("block")).applyInArrow(run, schema)


def _median(values: np.ndarray, n: np.ndarray) -> float:
    """Median of ``values``, each of which counts ``n`` times."""
    order = np.argsort(values)
    upto = np.cumsum(n[order])
    return float(np.mean([values[order[np.searchsorted(upto, upto[-1] / 2, side)]] for side in ("left", "right")]))


def band(bits: np.ndarray, n: np.ndarray, reach: float = REACH) -> tuple[float, float]:
    """(least, most) of a language whose values ``bits`` occur ``n`` times each."""
    reach, inside, seen = reach * (1 + FEW_TEXTS / n.sum()), np.ones(len(n), bool), set()
    while inside.tobytes() not in seen:
        seen.add(inside.tobytes())
        middle = _median(bits[inside], n[inside])
        spread = max(1.4826 * _median(np.abs(bits[inside] - middle), n[inside]), LEAST_SPREAD)
        least, most = middle - reach * spread, middle + reach * spread
        inside = (bits >= least) & (bits <= most)
    return float(least), float(most)


def bands(measured: DataFrame, text_hash: str, reach: float = REACH) -> list[tuple[str, float, float]]:
    """(lang, least bits, most bits), from the histogram over all distinct texts that pass the base rules."""
    texts = measured.where(~F.col("base_failed") & F.col("bits").isNotNull()).groupBy("lang", text_hash).agg(F.min("bits").alias("bits"))
    bin_ = F.least(F.floor(F.col("bits") * BINS_PER_BIT), F.lit(BINS - 1)).cast("int")
    got = texts.groupBy("lang", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n")).toArrow().to_pylist()
    by_lang = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["lang"], r["bin"])):
        by_lang[r["lang"]].append((r["bin"], r["n"]))
    out = []
    for g, pairs in by_lang.items():
        bins, n = (np.array(x) for x in zip(*pairs, strict=True))
        out.append((g, *band((bins + 0.5) / BINS_PER_BIT, n, reach)))
    return out


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", keep: list[str] | None = None, reach: float = REACH) -> DataFrame:
    """The rows of ``docs`` with the base counts, ``base_failed``, ``perplexity`` and ``kept``.

    A null text has no words and fails the base rules, as every text of fewer than 50 words does.  A null
    language counts as a language of its own.  Repeated rows count as often as they come in the model
    and once in the band.  An empty table gives an empty table.
    """
    keep = columns_to_keep(docs, keep, [*BASE, "base_failed", "perplexity", "kept"])
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for n, c in zip(names, keep, strict=True)],
                       F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("body"))
    text_hash = f"k{len(keep)}"
    rows = rows.withColumn(text_hash, F.xxhash64("body")).withColumn("key", F.xxhash64("lang"))
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    packed, drop = bucketed(blocks(rows), "texts", max(MIN_BUCKETS, total // BUCKET_BYTES), "block", "first")
    grams = stage(count_ngrams(packed), "grams")
    release(docs.sparkSession)
    kept = {n: rows.schema[n].dataType.simpleString() for n in [*names, text_hash]}
    scores = fit(grams)
    release(docs.sparkSession)
    measured = measure(packed, scores, kept)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    measured = stage(measured.withColumn("base_failed", failed), "perplexity")
    drop()
    limits = docs.sparkSession.createDataFrame(bands(measured, text_hash, reach), "lang string, least double, most double")
    return (measured.join(F.broadcast(limits), "lang", "left")                                # one row for each language
            .select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], *BASE, "base_failed", F.pow(F.lit(2.0), "bits").alias("perplexity"),
                    (~F.col("base_failed") & F.coalesce(F.col("bits").between(F.col("least"), F.col("most")), F.lit(False))).alias("kept")))


def digests(docs: DataFrame) -> DataFrame:
    return judge(docs, keep=["doc_id"]).select("doc_id", *BASE, "base_failed", "kept", "perplexity")
