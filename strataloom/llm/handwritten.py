"""Generated, minified or vendored source files and data blobs (problem 4).

Linear support-vector classifiers over hashed character n-grams and path components, one a kind, trained on labels that the
corpus gives away itself: path conventions, known upstream files, initialisers of nothing but literals, code of nothing but short
names. Comments, and with them every giveaway header, are masked in the text that these classifiers read; the rules only label.
Two further sources are kept apart from them: a classifier of comments alone, for files whose header is the only thing that tells
them from written code, and verbatim copies of known upstream files. Repositories are split between training and validation, and
the thresholds are set on all files of the latter.

A file of any size is scored in blocks of tokens whose sums are added up; only compact sums of a file meet in one task. Features are
computed where the tokens are read and never written.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.spans import MIX1, MIX2, Rolling, codes_of
from strataloom.runtime import materialise, spread

#: Tokens of a block; hashed features of the code and of the path; lengths of the character n-grams of code, of its shapes and of comments.
BLOCK, DIMENSIONS = 512, 1 << 16
#: Blocks that a worker holds as Python objects at once.
SLICE = 256
GRAMS, SHAPES, NOTES = (6, 9, 14), (5, 8, 12), (3, 5)
#: Weight of the path's components beside the code, each of unit length.
PATH_WEIGHT = 2.0
#: Documented bounds of the fit: labelled blocks of each class, and passes over them.
SAMPLE, PASSES = 3_000, 40
#: Tokens that a file needs; shingle length and share that make a known upstream file.
LEAST_TOKENS, SHINGLE, CONTAINED = 24, 5, 0.4
#: Bits of the sieve of upstream shingles: of fixed size whatever they are; what passes it is compared exactly.
SIEVE = 20
#: Share of tokens of a literals-only initialiser.
LITERALS = 0.6
#: Share of names of one or two letters, and names needed, that label minified code.
SHORT_NAMES, LEAST_NAMES = 0.75, 4
#: Thresholds that validation chooses from; one repository in so many only validates.
THRESHOLDS, HELD_ONE_IN = [t / 20 for t in range(-12, 7)], 5

KINDS = ("generated", "minified", "vendored", "blob")

# Path conventions of files not written by hand, and phrases of notices.
VENDOR_DIRS = "third_party|3rdparty|thirdparty|vendor|vendored|external|externals|extern|deps|contrib|node_modules|bower_components"
PATHS = {
    "vendored": f"(^|/)({VENDOR_DIRS})/",
    "minified": "[.-]min\\.[A-Za-z+]+$",
    "generated": "(\\.(gen|pb|generated|tab|designer)\\.[A-Za-z+]+$)|(_(generated|pb|bindings|pb2)\\.[A-Za-z+]+$)|(OuterClass|Grpc)\\.java$|(^|/)(moc_|ui_|lex\\.|qrc_)[^/]*$",
    "blob": "$^",
}
NOTICE = (
    "@generated\\b|\\bDO NOT (EDIT|MODIFY)\\b|AUTO-?GENERATED|<auto-?generated>|(?i:automatically generated)|(?i:auto-?generated file)|Generated by |Changes will be lost|Code produced by"
    "|(?i:machine-made by)|created automatically|buffer-read-only: t|local edits are overwritten|Generado con|Automatisch erzeugt|Fichier généré par|do not modify by hand|No editar"
)

_NUMBER = re.compile(r"^[+-]?(0[xX][0-9a-fA-F]+|\d[\d.']*)[uUlLfF]*$")
_WORD = re.compile(r"[^\W\d]+")


def is_comment(token: str) -> bool:
    return token.startswith(("/*", "//"))


def normal(token: str) -> str:
    """A token with its literal values masked."""
    if _NUMBER.match(token):
        return "9"
    if token[:1] in "\"'":
        return '"X"' if "\\x" in token else '"S"'
    return token


def shape(token: str) -> str:
    """A token's form: names as one to four letters by their length."""
    return _WORD.sub(lambda m: m[0] if m[0] in _KEPT else "a" * min(4, len(m[0])), token) if token[:1] not in "\"'" else token


# Keywords whose place in the shape of code is telling.
_KEPT = frozenset("case return static const struct typedef include if else while for switch goto break sizeof".split())


def _grams(texts: list[str], sizes: tuple[int, ...], salt: int) -> list[np.ndarray]:
    """The hashed features of each text's character n-grams, with repeats."""
    rolling = Rolling(codes_of("".join(texts)))
    ends = np.cumsum([len(t) for t in texts])
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    for size in sizes:
        h = rolling.hashes(size) * np.uint64(2 * (size + salt) + 1)
        h = ((h >> np.uint64(40)) % np.uint64(DIMENSIONS)).astype(np.int32)
        start = 0
        for i, end in enumerate(ends):
            parts[i].append(h[start : max(start, end - size + 1)])
            start = end
    return [np.concatenate(p) if p else np.empty(0, np.int32) for p in parts]


def _counts(features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sparse logarithmic counts of unit length."""
    if not len(features):
        return features.astype(np.int32), np.empty(0, np.float32)
    ordered = np.sort(features)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    x = 1 + np.log(np.diff(np.concatenate([starts, [len(ordered)]])))
    return ordered[starts], (x / np.sqrt((x * x).sum())).astype(np.float32)


@lru_cache(1 << 14)
def path_features(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Sparse counts of a path's hashed components: its directories and the words of its file's name, with their place."""
    *dirs, name = path.split("/")
    words = re.split(r"[._-]+|(?<=[a-z0-9])(?=[A-Z])", name)
    parts = [f"d:{d.lower()}" for d in dirs] + [f"w:{w.lower()}" for w in words] + [f"s:{w.lower()}" for w in words[:1]] + [f"e:{'.'.join(words[-2:]).lower()}"]
    return _counts(np.array([xxhash.xxh32_intdigest(p) % DIMENSIONS for p in parts], np.int32))


def literal_run(tokens: list[str]) -> int:
    """The tokens of the longest run of nothing but literals, commas and braces."""
    best = run = 0
    for t in tokens:
        run = run + 1 if t in (",", "{", "}") or t[:1] in "\"'" or _NUMBER.match(t) or is_comment(t) and run else 0
        best = max(best, run)
    return best


def name_counts(tokens: list[str], types: list[str]) -> tuple[int, int]:
    """The names, and those of one or two letters."""
    names = [t for t, kind in zip(tokens, types) if kind == "name"]
    return len(names), sum(len(t) <= 2 for t in names)


def shingles(tokens: list[str]) -> np.ndarray:
    """A hash of every SHINGLE consecutive tokens."""
    n = len(tokens) - SHINGLE + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    own = np.array([_token_hash(t) for t in tokens], np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            h = h * np.uint64(MIX2) + own[k : k + n]
        h ^= h >> np.uint64(33)
        return h * np.uint64(MIX1)


@lru_cache(1 << 16)
def _token_hash(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"))


def blocks_of(tokens: DataFrame) -> DataFrame:
    """(repo_name, file_path, block, values, types): each file's tokens in blocks by token_index; repeated rows once, of a repeated index the least value; null values as ''."""
    known = tokens.where("repo_name is not null and file_path is not null and token_index is not null")
    block = F.floor(F.col("token_index") / BLOCK).alias("block")
    got = known.groupBy("repo_name", "file_path", block).agg(F.array_sort(F.collect_set(F.struct("token_index", "token_value", "token_type"))).alias("_t"))
    first = F.filter("_t", lambda t, i: (i == 0) | (t["token_index"] != F.col("_t")[F.greatest(i - 1, F.lit(0))]["token_index"]))
    text = lambda field: F.transform("_f", lambda t: F.coalesce(t[field], F.lit(""))).alias(f"{field[6:]}s")
    return got.select("repo_name", "file_path", "block", first.alias("_f")).select("repo_name", "file_path", "block", text("token_value"), text("token_type"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[str]]]]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            yield part, part.column("values").to_pylist()


_FILE = [("repo_name", pa.string()), ("file_path", pa.string())]
_FACTS = pa.schema([*_FILE, ("block", pa.int64()), ("n", pa.int64()), ("literals", pa.int64()), ("names", pa.int64()), ("short", pa.int64()), ("notes", pa.list_(pa.string())), ("hits", pa.list_(pa.int64()))])


def _fact_batches(sieve, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    passes = np.zeros(1 << SIEVE, bool)
    passes[sieve.value] = True
    for part, values in _slices(batches):
        hashes = [shingles(ts) for ts in values]
        hits = [h[passes[(h >> np.uint64(64 - SIEVE)).astype(np.int64)]].view(np.int64) for h in hashes]
        names = [name_counts(ts, kinds) for ts, kinds in zip(values, part.column("types").to_pylist())]
        own = [[len(ts) for ts in values], [literal_run(ts) for ts in values], [n for n, _ in names], [s for _, s in names], [[t for t in ts if is_comment(t)] for ts in values], hits]
        yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("repo_name", "file_path", "block")), *(pa.array(c, f.type) for c, f in zip(own, list(_FACTS)[3:]))], schema=_FACTS)


def _upstream_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = [shingles([t or "" for t in ts or []]).view(np.int64) for ts in batch.column("token_values").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("up"), pa.array(h, pa.list_(pa.int64()))], ["up", "h"])


def upstream_shingles(upstream: DataFrame) -> DataFrame:
    """(up, h): the shingles of every known upstream file, each once."""
    up = upstream.select(F.xxhash64("lib_name", "lib_version", "file_name").alias("up"), "token_values")
    return up.mapInArrow(_upstream_batches, "up bigint, h array<bigint>").select("up", F.explode("h").alias("h")).distinct()


def facts_of(blocks: DataFrame, known: DataFrame) -> DataFrame:
    """(repo_name, file_path, block, n, literals, names, short, notes, hits): what labels a block; hits are its shingles that pass the sieve of ``known``."""
    slot = F.shiftrightunsigned("h", 64 - SIEVE)
    slots = known.select(slot.alias("s")).distinct().toArrow().column("s").to_numpy()  # at most 2**SIEVE numbers
    schema = "repo_name string, file_path string, block bigint, n bigint, literals bigint, names bigint, short bigint, notes array<string>, hits array<bigint>"
    return spread(blocks).mapInArrow(partial(_fact_batches, blocks.sparkSession.sparkContext.broadcast(slots)), schema)


def evidence_of(facts: DataFrame, known: DataFrame) -> DataFrame:
    """(repo_name, file_path, n, held, noticed, contained, one label a kind) of every file.

    contained is the greatest share of its shingles that stand in one known upstream file. The labels are those of the rules.
    """
    files = ["repo_name", "file_path"]
    sums = facts.groupBy(*files).agg(
        F.sum("n").alias("n"), F.max("literals").alias("_literals"), F.sum("names").alias("_names"), F.sum("short").alias("_shorts"), F.bool_or(F.exists("notes", lambda t: t.rlike(NOTICE))).alias("noticed"),
        F.sum(F.greatest(F.col("n") - SHINGLE + 1, F.lit(0))).alias("_all"),
    )
    hits = facts.select(*files, F.explode("hits").alias("h")).join(known, "h").groupBy(*files, "up").agg(F.count(F.lit(1)).alias("_n")).groupBy(*files).agg(F.max("_n").alias("_n"))
    both = sums.join(hits, files, "left").withColumn("contained", F.coalesce(F.col("_n") / F.col("_all"), F.lit(0.0)))
    path = {k: F.col("file_path").rlike(PATHS[k]) for k in KINDS}
    short = (F.col("_names") >= LEAST_NAMES) & (F.col("_shorts") >= SHORT_NAMES * F.col("_names"))
    label = {"generated": path["generated"], "minified": path["minified"] | short, "vendored": path["vendored"] | (F.col("contained") >= CONTAINED), "blob": F.col("_literals") >= LITERALS * F.least("n", F.lit(BLOCK))}
    held = F.pmod(F.xxhash64("repo_name"), F.lit(HELD_ONE_IN)) == 0
    return both.select(*files, "n", held.alias("held"), "noticed", "contained", *[c.alias(k) for k, c in label.items()])


def features_of(values: list[list[str]], paths: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each block's sparse features: its code with comments and literals masked, its shapes, and its path's components behind them."""
    code = [[normal(t) for t in ts if not is_comment(t)] for ts in values]
    raw = _grams([" ".join(ts) for ts in code], GRAMS, 0)
    forms = _grams([" ".join(map(shape, ts)) for ts in code], SHAPES, 100)
    for path, a, b in zip(paths, raw, forms):
        at, x = _counts(np.concatenate([a, b]))
        there, y = path_features(path)
        yield np.concatenate([at, there + DIMENSIONS]).astype(np.int32), np.concatenate([x, PATH_WEIGHT * y]).astype(np.float32)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, values in _slices(batches):
        got = list(features_of(values, part.column("file_path").to_pylist()))
        yield pa.RecordBatch.from_arrays([part.column("key"), pa.array([a for a, _ in got], pa.list_(pa.int32())), pa.array([x for _, x in got], pa.list_(pa.float32()))], ["key", "at", "x"])


@dataclass
class Linear:
    """A trained classifier: weights and bias, the threshold that its validation repositories gave, and how it does on them."""

    weights: np.ndarray
    bias: float
    threshold: float = 0.0
    precision: float = 0.0
    recall: float = 0.0
    held: int = 0

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        return float(self.weights[at] @ x) + self.bias


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], dimensions: int, passes: int = PASSES, c: float = 5.0) -> Linear:
    """A linear support-vector classifier with squared hinge loss, by dual coordinate descent; classes weigh by their rarity."""
    rng = np.random.default_rng(7)
    w = np.zeros(dimensions + 1)
    n_pos = sum(y > 0 for *_, y in rows)
    share = {1: c * len(rows) / max(1, 2 * n_pos), -1: c * len(rows) / max(1, 2 * (len(rows) - n_pos))}
    alpha = np.zeros(len(rows))
    norm = [float(x @ x) + 1 + 1 / (2 * share[y]) for _, x, y in rows]
    active = np.arange(len(rows))
    for _ in range(passes):
        moved, kept, whole = 0.0, [], len(active) == len(rows)
        for i in rng.permutation(active):
            at, x, y = rows[i]
            gradient = y * (float(w[at] @ x) + w[-1]) - 1 + alpha[i] / (2 * share[y])
            if alpha[i] == 0 and gradient > 0:  # well on its side: left out until the others have settled
                continue
            kept.append(i)
            step = max(0.0, alpha[i] - gradient / norm[i]) - alpha[i]
            if step:
                alpha[i] += step
                w[at] += step * y * x
                w[-1] += step * y
                moved = max(moved, abs(step))
        if moved < 0.01 and whole:
            break
        active = np.arange(len(rows)) if moved < 0.01 or not kept else np.array(kept)
    return Linear(w[:-1], float(w[-1]))


def set_threshold(model: Linear, counts: list[tuple[int, bool, int]]) -> None:
    """Gives ``model`` the one of THRESHOLDS that does best (F1), nearest to 0 among equals, from (thresholds reached, truth, files)."""
    model.held = sum(n for _, truth, n in counts if truth)
    best = -1.0
    for i in sorted(range(len(THRESHOLDS)), key=lambda i: abs(THRESHOLDS[i])):
        said = sum(n for reached, _, n in counts if reached > i)
        hit = sum(n for reached, truth, n in counts if reached > i and truth)
        p, r = hit / max(1, said), hit / max(1, model.held)
        f = 2 * p * r / max(1e-9, p + r)
        if f > best + 1e-9:
            best = f
            model.threshold, model.precision, model.recall = (THRESHOLDS[i], p, r) if model.held else (0.0, 0.0, 0.0)


def note_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sparse counts of a comment's character n-grams, digits masked and non-ASCII letters as one class."""
    plain = re.sub(r"[^\x00-\x7f]+", "*", re.sub(r"\d+", "9", text.lower()))
    return _counts(_grams([f"^{plain}$"], NOTES, 200)[0])


def train(blocks: DataFrame, facts: DataFrame, evidence: DataFrame, upstream: DataFrame) -> dict[str, Linear]:
    """The classifiers of KINDS and of 'notice', from the labelled blocks and comments of the repositories that don't validate.

    At most SAMPLE blocks of each kind, of files without any label and of comments with and without a notice are drawn, by hash,
    so what is collected is bounded; the draw reads keys and labels of all data. The first SAMPLE known upstream files train as vendored.
    """
    files = ["repo_name", "file_path"]
    open_ = evidence.where("not held")
    keys = facts.select(*files, "block").join(open_, files)
    order = F.xxhash64(*files, "block")
    bare = ~F.greatest(*[F.col(k) for k in KINDS]) & ~F.col("noticed")
    drawn = None
    for pool in (*[F.col(k) for k in KINDS], bare):
        one = keys.where(pool).orderBy(order).limit(SAMPLE).select(*files, "block", *KINDS)
        drawn = one if drawn is None else drawn.unionByName(one)
    drawn = materialise(drawn.distinct().withColumn("key", F.concat_ws("|", *[F.col(k).cast("int").cast("string") for k in KINDS])), "drawn")
    picked = blocks.join(F.broadcast(drawn), [*files, "block"]).select("key", "file_path", "values")  # bounded by SAMPLE
    known = upstream.orderBy(F.xxhash64("lib_name", "lib_version", "file_name")).limit(SAMPLE)
    own = "|".join(str(int(k == "vendored")) for k in KINDS)
    known = known.select(F.lit(own).alias("key"), F.concat_ws("/", "lib_name", "file_name").alias("file_path"), F.transform(F.coalesce("token_values", F.array()), lambda t: F.coalesce(t, F.lit(""))).alias("values"))
    t = spread(picked.unionByName(known)).mapInArrow(_feature_batches, "key string, at array<int>, x array<float>").toArrow()
    at, x = (t.column(c).combine_chunks() for c in ("at", "x"))
    labels = [dict(zip(KINDS, (v == "1" for v in key.split("|")))) for key in t.column("key").to_pylist()]
    rows = [(at[i].values.to_numpy(zero_copy_only=False), x[i].values.to_numpy(zero_copy_only=False), labels[i]) for i in sorted(range(t.num_rows), key=lambda i: (len(at[i]), at[i].values[:8].to_pylist()))]
    models = {}
    for kind in KINDS:
        sure = [(a, v, 1 if y[kind] else -1) for a, v, y in rows if any(y.values())]
        clean = [(a, v, -1) for a, v, y in rows if not any(y.values())]
        for _ in range(2):  # what looks like the kind among files without a label is left out of the second fit
            if not any(y > 0 for *_, y in sure):
                break
            models[kind] = fit([*sure, *clean], 2 * DIMENSIONS)
            clean = [r for r in clean if models[kind].score(r[0], r[1]) < 0]
    notes = facts.select(*files, F.explode("notes").alias("note")).join(open_.select(*files), files).select("note", F.col("note").rlike(NOTICE).alias("noticed")).distinct()
    said = [(*note_features(r["note"]), 1 if c == "noticed" else -1) for c in ("noticed", "not noticed") for r in notes.where(c).orderBy(F.xxhash64("note"), "note").limit(SAMPLE).collect()]
    if any(y > 0 for *_, y in said):
        models["notice"] = fit(said, DIMENSIONS)
    return models


#: Score of a kind that nothing was learned of, and of files without comments.
UNKNOWN = -9.0


def score_files(blocks: DataFrame, models: dict[str, Linear]) -> DataFrame:
    """(repo_name, file_path, one score a kind, notice): by file, the blocks' scores weighed by their tokens and the best comment's."""
    sent = blocks.sparkSession.sparkContext.broadcast({k: (m.weights.astype(np.float32), m.bias) for k, m in models.items()})  # of fixed size
    out = pa.schema([*_FILE, ("n", pa.int64()), *((k, pa.float64()) for k in (*KINDS, "notice"))])

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {k: Linear(w, b) for k, (w, b) in sent.value.items()}
        heard: dict[str, float] = {}
        for part, values in _slices(stream):
            scores: dict[str, list[float]] = {k: [] for k in (*KINDS, "notice")}
            for ts, (at, x) in zip(values, features_of(values, part.column("file_path").to_pylist())):
                for k in KINDS:
                    scores[k].append(len(ts) * (own[k].score(at, x) if k in own else UNKNOWN))
                notes = [t for t in ts if is_comment(t)] if "notice" in own else []
                for t in notes:
                    if t not in heard:
                        if len(heard) > 1 << 16:
                            heard.clear()
                        heard[t] = own["notice"].score(*note_features(t))
                scores["notice"].append(max((heard[t] for t in notes), default=UNKNOWN))
            yield pa.RecordBatch.from_arrays([part.column("repo_name"), part.column("file_path"), pa.array([len(ts) for ts in values], pa.int64()), *(pa.array(c, pa.float64()) for c in scores.values())], schema=out)

    schema = "repo_name string, file_path string, n bigint, " + ", ".join(f"{k} double" for k in (*KINDS, "notice"))
    scored = spread(blocks).mapInArrow(batches, schema)
    return scored.groupBy("repo_name", "file_path").agg(*[(F.sum(k) / F.sum("n")).alias(k) for k in KINDS], F.max("notice").alias("notice"))


def validate(scores: DataFrame, evidence: DataFrame, models: dict[str, Linear]) -> None:
    """Sets every model's threshold on all files of the validating repositories, by counts of files that reach each threshold.

    A kind is validated on files with a label or without notice: what a header alone tells isn't known to the code. Verbatim
    copies of known upstream files are left out: the comparison with these decides them whatever the threshold.
    """
    held = scores.join(evidence.where(F.col("held") & (F.col("n") >= LEAST_TOKENS) & (F.col("contained") < CONTAINED)).select("repo_name", "file_path", "noticed", *[F.col(k).alias(f"_{k}") for k in KINDS]), ["repo_name", "file_path"])
    labelled = F.greatest(*[F.col(f"_{k}") for k in KINDS])
    truth = {k: F.when(labelled | ~F.col("noticed"), F.col(f"_{k}")) for k in KINDS} | {"notice": F.col("noticed")}
    reached = lambda k: F.size(F.filter(F.array(*[F.lit(t) for t in THRESHOLDS]), lambda t: F.col(k) >= t))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), reached(k).alias("reached"), truth[k].alias("truth")) for k in models]))
    rows = held.select(each.alias("x")).groupBy("x.kind", "x.reached", "x.truth").agg(F.count(F.lit(1)).alias("n")).where("truth is not null").collect() if models else []  # two for each kind and threshold
    for kind, model in models.items():
        set_threshold(model, [(r["reached"], r["truth"], r["n"]) for r in rows if r["kind"] == kind])


def classify(tokens: DataFrame, upstream: DataFrame) -> tuple[DataFrame, dict[str, Linear]]:
    """Every file of LEAST_TOKENS distinct token indexes or more as (repo_name, file_path, n_tokens, kind, source), and the classifiers.

    kind and source are null for hand-written source. source says what told the kind: 'code' for the classifiers of code and
    path, of which the one furthest above its threshold gives the kind; where none says so, 'copy' for a verbatim copy of a known
    upstream file, then 'comment' for the classifier of comments. Rows without repository, path or token_index belong to no
    file; null token values count as empty tokens.
    """
    files = ["repo_name", "file_path"]
    blocks = materialise(blocks_of(tokens), "blocks")
    known = materialise(upstream_shingles(upstream), "upstream-shingles")
    facts = materialise(facts_of(blocks, known), "facts")
    evidence = materialise(evidence_of(facts, known), "evidence")
    models = train(blocks, facts, evidence, upstream)
    scores = materialise(score_files(blocks, models), "scores")
    validate(scores, evidence, models)
    above = {k: F.col(k) - (models[k].threshold if k in models else 0.0) for k in (*KINDS, "notice")}
    best = F.greatest(*[F.when(above[k] >= 0, F.struct(above[k].alias("s"), F.lit(k).alias("kind"), F.lit("code").alias("source"))) for k in KINDS])
    copied = F.when(F.col("contained") >= CONTAINED, F.struct(F.lit(0.0).alias("s"), F.lit("vendored").alias("kind"), F.lit("copy").alias("source")))
    noticed = F.when(above["notice"] >= 0, F.struct(above["notice"].alias("s"), F.lit("generated").alias("kind"), F.lit("comment").alias("source")))
    joined = scores.join(evidence.where(F.col("n") >= LEAST_TOKENS).select(*files, "n", "contained"), files)
    out = joined.withColumn("_k", F.coalesce(best, copied, noticed))
    return out.select(*files, F.col("n").alias("n_tokens"), F.col("_k.kind").alias("kind"), F.col("_k.source").alias("source")), models


def not_handwritten(tokens: DataFrame, upstream: DataFrame) -> DataFrame:
    """(repo_name, file_path, kind, source) of the files that ``classify`` gives a kind."""
    return classify(tokens, upstream)[0].where("kind is not null").select("repo_name", "file_path", "kind", "source")
