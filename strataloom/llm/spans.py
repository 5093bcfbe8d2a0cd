"""Long exact spans shared between records (problem 10).

Prefix-partitioned suffix trees over a sample of suffixes that misses no span. Winnowing keeps the suffixes whose prefix of half a
span has the least hash of its neighbours within the other half; a run of a whole span holds all those neighbours, so both its
copies keep the same suffixes of it. The suffixes are partitioned by their prefixes, prefixes of one document fall away, and each
group that is left is small enough to be sorted in memory. The nodes of its suffix tree, read off the common prefixes of sorted
neighbours, are the maximal repeats to the right of the prefix; each is split by as many characters to the left as its depth
lacks. A prefix with more suffixes than GROUP is lengthened, by halves of what a span can still reach to its left and right, until
its groups are small enough or the prefix is a whole span.

Texts are read where they lie; what is shuffled are hashes of prefixes and the surroundings of those that stand in two texts.
Nothing is paired before it is known to be shared; copies of one text are handled as one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataloom.runtime import materialise, pairs_within, spread

#: Least length of a span unless another is given; a prefix is half as long.
SPAN = 200
#: Suffixes of one prefix that are sorted in one task's memory; characters hashed at once.
GROUP, CHUNK = 5_000, 1_000_000

# An odd 64-bit base for polynomial hashes and the multipliers of a finaliser.
BASE, MIX1, MIX2 = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64, for i < n."""
    inverse = pow(BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]), dtype=np.uint64) for b in (BASE, inverse))


class Rolling:
    """Hashes of the runs of code points, of any length, from one pass of sums."""

    def __init__(self, codes: np.ndarray):
        up, self._down = _powers(1 << max(10, len(codes).bit_length()))
        self._n = len(codes)
        with np.errstate(over="ignore"):
            self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], dtype=np.uint64)])

    def hashes(self, size: int) -> np.ndarray:
        """A 64-bit hash of every run of ``size`` code points."""
        if self._n < size:
            return np.empty(0, np.uint64)
        with np.errstate(over="ignore"):
            h = (self._sums[size:] - self._sums[:-size]) * self._down[: self._n - size + 1]
            h ^= h >> np.uint64(33)
            h *= np.uint64(MIX1)
            h ^= h >> np.uint64(33)
            h *= np.uint64(MIX2)
            return h ^ (h >> np.uint64(33))


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` code points."""
    return Rolling(codes).hashes(size)


def _sliding(values: np.ndarray, width: int, op: np.ufunc, fill: int) -> np.ndarray:
    """``op`` over every ``width`` consecutive values, by prefix and suffix folds of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, fill, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = op.accumulate(blocks, axis=1).ravel()
    behind = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(texts: list[str], span: int = SPAN) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, prefix hashes) of the kept suffixes of each text; none of a text shorter than ``span``."""
    prefix = span // 2
    out, width = [], span - prefix + 1
    empty = (np.empty(0, np.int64), np.empty(0, np.uint64))
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) <= CHUNK):
            size += len(texts[end])
            end += 1
        sizes = np.array([len(t) for t in texts[start:end]])
        begins = np.concatenate([[0], np.cumsum(sizes)])
        h = gram_hashes(codes_of("".join(texts[start:end])), prefix)
        if len(h) < width:
            out += [empty] * (end - start)
            start = end
            continue
        for stop in begins[1:-1]:  # prefixes that run into the next text are no prefixes
            h[max(0, stop - prefix + 1) : stop] = np.iinfo(np.uint64).max
        least = _sliding(h, width, np.minimum, np.iinfo(np.uint64).max)
        edge = np.zeros(len(h) + width - 1, np.uint64)
        edge[width - 1 : width - 1 + len(least)] = least
        kept = np.flatnonzero((_sliding(edge, width, np.maximum, 0) == h) & (h != np.iinfo(np.uint64).max))
        cuts = np.searchsorted(kept, begins)
        for i in range(end - start):
            at = kept[cuts[i] : cuts[i + 1]]
            out.append((at - begins[i], h[at]) if sizes[i] >= span else empty)
        start = end
    return out


def _anchor_batches(span: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        got = anchors(list(pdf["text"]), span)
        sizes = [len(p) for p, _ in got]
        if sum(sizes):
            yield pd.DataFrame({"doc_id": np.repeat(pdf["doc_id"].to_numpy(np.int64), sizes), "pos": np.concatenate([p for p, _ in got]).astype(np.int32), "prefix": np.concatenate([h for _, h in got]).view(np.int64)})


def common_prefix(a: str, b: str) -> int:
    """The length of the common start of two texts."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


def _nodes(rows: list[tuple[int, int, str, str]], span: int) -> Iterator[tuple[int, list[int]]]:
    """(depth, rows) of the sets of rows, of two documents or more, that share ``span`` characters around a suffix; the depth are those from the suffix on.

    ``rows`` (doc_id, pos, left, right) of one prefix, sorted by right. The stack holds the open nodes of the suffix tree, as their
    depth and first row; a node closes where the common prefix of neighbours falls below its depth. A node's rows share ``span``
    characters if they share the missing ones to the left.
    """
    stack: list[tuple[int, int]] = []
    for i in range(1, len(rows) + 1):
        depth = min(span, common_prefix(rows[i - 1][3], rows[i][3])) if i < len(rows) else 0
        first = i - 1
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            missing = span - d
            by_left: dict[str, list[int]] = {}
            for k in range(first, i):
                left = rows[k][2]
                if len(left) >= missing:
                    by_left.setdefault(left[len(left) - missing :], []).append(k)
            yield from ((d, group) for group in by_left.values() if any(rows[k][0] != rows[group[0]][0] for k in group))
        if depth >= span // 2 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def maximal_repeats(rows: list[tuple[int, int, str, str]], span: int = SPAN) -> list[list[int]]:
    """The sets of documents that share ``span`` characters around a suffix of one prefix."""
    return [sorted({rows[k][0] for k in group}) for _, group in _nodes(rows, span)]


def shared_extents(rows: list[tuple[int, int, str, str]], span: int = SPAN) -> list[tuple[int, int, int]]:
    """(doc_id, start, end): around each suffix of one prefix, the characters that it shares with another document as part of a span."""
    reach: dict[int, tuple[int, int]] = {}
    for depth, group in _nodes(rows, span):
        order = sorted(group, key=lambda k: rows[k][2][::-1])
        lefts = [rows[k][2][::-1] for k in order]
        for n, k in enumerate(order):
            best = span - depth
            for step in (-1, 1):  # the nearest row of another document on either side
                m = n + step
                while 0 <= m < len(order) and rows[order[m]][0] == rows[k][0]:
                    m += step
                if 0 <= m < len(order):
                    best = max(best, common_prefix(lefts[n], lefts[m]))
            left, right = reach.get(k, (0, 0))
            reach[k] = (max(left, best), max(right, depth))
    return [(rows[k][0], rows[k][1] - left, rows[k][1] + right) for k, (left, right) in reach.items()]


def _tree_batches(span: int, extents: bool, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    open_prefix, rows, out = None, [], []
    columns = ["doc_id", "start", "end"] if extents else ["repeat", "doc_id"]

    def flush() -> None:
        if extents:
            out.extend(shared_extents(rows, span))
        else:
            out.extend((f"{open_prefix}-{k}", d) for k, docs in enumerate(maximal_repeats(rows, span)) for d in docs)

    for pdf in batches:
        for prefix, doc, pos, left, right in zip(pdf["prefix"], pdf["doc_id"], pdf["pos"], pdf["left"], pdf["right"]):
            if prefix != open_prefix:
                flush()
                open_prefix, rows = prefix, []
            rows.append((doc, pos, left, right))
        yield pd.DataFrame(out, columns=columns)
        out = []
    flush()
    yield pd.DataFrame(out, columns=columns)


def copies(documents: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, rep): every document with a text of ``span`` characters or more, and the least doc_id that has the same text."""
    hashed = documents.where((F.length("text") >= span) & F.col("doc_id").isNotNull()).select("doc_id", F.unhex(F.sha2("text", 256)).alias("_sha")).distinct()
    hashed = materialise(hashed, "texts")
    twins = hashed.groupBy("_sha").agg(F.min("doc_id").alias("_least"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_sha", "_least")
    return materialise(hashed.join(twins, "_sha", "left").select("doc_id", F.coalesce("_least", "doc_id").alias("rep")), "copies")


def shared_suffixes(documents: DataFrame, reps: DataFrame, span: int = SPAN) -> DataFrame:
    """(prefix, n, doc_id, pos, left, right): the kept suffixes whose prefix stands in two different texts or more, with their surroundings.

    The first scan keeps hashes, the second cuts the surroundings of the hits alone. The hits and the copies are written first, so
    that the planner knows their sizes and broadcasts them only where they are small.
    """
    texts = documents.where(F.length("text") >= span).select("doc_id", "text")
    # The documents that only repeat another's text: few beside all, so leaving them out moves less than picking the others.
    again = materialise(reps.groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("rep")).alias("_own")).where("not _own").select("doc_id"), "copies-only")
    kept = texts.where("doc_id is not null").mapInPandas(partial(_anchor_batches, span), "doc_id bigint, pos int, prefix bigint").join(again, "doc_id", "left_anti")
    kept = materialise(kept, "anchors")
    known = kept.groupBy("prefix").agg(F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b")).where("_a < _b").select("prefix")
    hits = materialise(kept.join(materialise(known, "prefixes"), "prefix"), "hits")
    sizes = hits.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    half = span - span // 2
    left = F.expr(f"substring(text, greatest(1, pos + 1 - {half}), least(pos, {half}))")
    right = F.expr(f"substring(text, pos + 1, {span})")
    cut = hits.join(texts, "doc_id").select(F.col("prefix").cast("string").alias("prefix"), "doc_id", "pos", left.alias("left"), right.alias("right"))
    return materialise(materialise(cut, "surroundings").join(sizes.withColumn("prefix", F.col("prefix").cast("string")), "prefix"), "suffixes")


def _lengthened(hot: DataFrame, span: int) -> DataFrame:
    """(prefix, n, doc_id, pos, left, right, lo, hi): the suffixes of ``hot`` under two longer prefixes each; prefixes of one document fall away.

    A span around the suffix starts between lo and hi characters before it, so all its spans have the part from lo before it to
    the end of the one that starts at hi in common. Each half of that range has a longer such part: that is the new prefix.
    """
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.explode(F.array(F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct((mid + 1).alias("lo"), F.col("hi").alias("hi"))))
    rows = hot.withColumn("_h", halves).select("prefix", "doc_id", "pos", "left", "right", "_h.lo", "_h.hi")
    rows = rows.where((F.length("left") >= F.col("lo")) & (F.length("right") >= span - F.col("hi")))
    common = F.expr(f"substring(concat(left, right), length(left) - lo + 1, {span} - hi + lo)")
    rows = rows.withColumn("prefix", F.sha2(F.concat_ws("|", "prefix", "lo", "hi", common), 256))
    sizes = rows.groupBy("prefix").agg(F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b"), F.count(F.lit(1)).alias("n")).where("_a < _b").select("prefix", "n")
    return rows.join(sizes, "prefix")


def groups(documents: DataFrame, reps: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """The suffixes whose groups fit into memory (prefix, doc_id, pos, left, right), and those whose prefix was lengthened to a whole span (prefix, doc_id, start)."""
    suffixes = shared_suffixes(documents, reps, span)
    columns = ["prefix", "doc_id", "pos", "left", "right"]
    small = suffixes.where(F.col("n") <= GROUP).select(columns)
    whole = suffixes.where("false").select("prefix", "doc_id", F.col("pos").alias("start"))
    hot = suffixes.where(F.col("n") > GROUP).withColumns({"lo": F.lit(0), "hi": F.lit(span - span // 2)})
    while not hot.isEmpty():  # the range halves each time
        longer = materialise(_lengthened(hot, span), "lengthened")
        whole = whole.unionByName(longer.where("lo = hi").select("prefix", "doc_id", (F.col("pos") - F.col("lo")).alias("start")))
        small = small.unionByName(longer.where((F.col("n") <= GROUP) & (F.col("lo") < F.col("hi"))).select(columns))
        hot = longer.where((F.col("n") > GROUP) & (F.col("lo") < F.col("hi")))
    return small, whole


def _grown(small: DataFrame, span: int, extents: bool) -> DataFrame:
    """What the suffix trees of ``groups`` give: repeats or extents."""
    sorted_ = spread(small, "prefix").sortWithinPartitions("prefix", "right", "doc_id")
    return sorted_.mapInPandas(partial(_tree_batches, span, extents), "doc_id bigint, start int, end int" if extents else "repeat string, doc_id bigint")


def repeats(documents: DataFrame, reps: DataFrame, span: int = SPAN) -> DataFrame:
    """(repeat, doc_id): the documents, each standing for its copies, that share a run of ``span`` characters; two or more of each repeat.

    Repeats of the same documents are kept once, told by the sums of their documents' hashes.
    """
    small, whole = groups(documents, reps, span)
    found = materialise(_grown(small, span, False).unionByName(whole.select(F.col("prefix").alias("repeat"), "doc_id").distinct()), "repeats")
    marks = found.groupBy("repeat").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("_m"), F.sum(F.hash("doc_id").cast("bigint")).alias("_k"))
    first = marks.groupBy("_n", "_m", "_k").agg(F.min("repeat").alias("repeat")).select("repeat")
    return found.join(first, "repeat")


def repeat_classes(documents: DataFrame, span: int = SPAN) -> DataFrame:
    """(repeat, doc_id, n_docs, n_copies): the classes of documents that share a run of ``span`` characters, one row a document, no pairs.

    doc_id stands for the n_copies documents of its text; n_docs counts the different texts of the repeat. A text that only has
    copies is a repeat of its own, named by its doc_id.
    """
    reps = copies(documents, span)
    twins = reps.groupBy(F.col("rep").alias("doc_id")).agg(F.count(F.lit(1)).alias("n_copies"))
    found = materialise(repeats(documents, reps, span), "classes")
    sizes = found.groupBy("repeat").agg(F.count(F.lit(1)).alias("n_docs"))
    own = twins.where("n_copies > 1").join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(F.concat(F.lit("copies-"), F.col("doc_id").cast("string")).alias("repeat"), "doc_id", F.lit(1).cast("bigint").alias("n_docs"), "n_copies")
    return found.join(sizes, "repeat").join(twins, "doc_id").select("repeat", "doc_id", "n_docs", "n_copies").unionByName(own)


def shared_pairs(documents: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id_a, doc_id_b) with doc_id_a < doc_id_b: two documents that share a run of ``span`` characters or more (code points).

    Null, empty and shorter texts share nothing. A doc_id that occurs twice is one document with all its texts. Hot repeats and
    hot copies are paired in pieces.
    """
    reps = copies(documents, span)
    links = pairs_within(repeats(documents, reps, span), "repeat", "doc_id")
    a, b = reps.select(F.col("rep").alias("a"), F.col("doc_id").alias("x")), reps.select(F.col("rep").alias("b"), F.col("doc_id").alias("y"))
    out = links.join(a, "a").join(b, "b").where("x <> y").select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b"))
    own = pairs_within(reps, "rep", "doc_id").select(F.col("a").alias("doc_id_a"), F.col("b").alias("doc_id_b"))
    return out.union(own).distinct()


def shared_share(documents: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, n_chars, n_shared): of each doc_id, the characters of its text and those within a run of ``span`` characters that stands in another document.

    Null texts have null counts; texts that share nothing, among them those shorter than ``span``, 0. A text with a copy is shared whole.
    """
    reps = copies(documents, span)
    twins = reps.groupBy("rep").agg(F.count(F.lit(1)).alias("_copies"))
    small, whole = groups(documents, reps, span)
    parts = materialise(_grown(small, span, True).unionByName(whole.select("doc_id", "start", (F.col("start") + span).alias("end"))), "extents").distinct()
    # Of a document's extents in order, each adds what lies beyond the ends before it.
    before = F.max("end").over(Window.partitionBy("doc_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    added = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, "start")))
    covered = parts.withColumn("_c", added).groupBy("doc_id").agg(F.sum("_c").alias("_shared"))
    by_doc = reps.join(twins, "rep").join(covered.withColumnRenamed("doc_id", "rep"), "rep", "left").select("doc_id", "_copies", "_shared")
    out = documents.select("doc_id", F.length("text").cast("bigint").alias("n_chars")).join(by_doc, "doc_id", "left")
    n = F.when(F.col("_copies") > 1, F.col("n_chars")).otherwise(F.coalesce("_shared", F.lit(0)).cast("bigint"))
    return out.select("doc_id", "n_chars", F.when(F.col("n_chars").isNotNull(), n).alias("n_shared"))
