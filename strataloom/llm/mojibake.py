"""Text decoded with the wrong character encoding (problem 7).

A hidden Markov model labels the characters of a text: one clean state and one state per encoding pair (read as, was). A state
emits a unit of one or more characters, the image of one original character under its pair; ASCII is its own image in every
state and costs nothing. Emission probabilities are conditional counts of the corpus: a character given its two neighbours on
either side, backed off to the character alone. Viterbi's path splits the text into spans; a span of a pair's state gets that
pair's inverse transform.

The counts are never gathered: every reading of every character is a row of fixed size, which names its text by a number and is
joined with the counts by its context. The texts themselves are joined once, to the readings of each.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataloom.runtime import materialise, spread

# The encoding pairs. UTF-8 read as a single-byte encoding, once or twice, and one single-byte encoding read as another.
UTF8_READ_AS = ("latin-1", "cp1252", "cp437", "mac_roman", "cp1250", "cp1251")
TWICE_READ_AS = ("latin-1", "cp1252")
CP1252_READ_AS = ("cp437", "mac_roman")
LOST = "�"

#: Log probabilities of leaving the clean state for a garbled one, of going back, and of going over to another pair.
ENTER, LEAVE, SWITCH = math.log(0.01), math.log(0.01), math.log(0.0001)
#: Weight of the character alone in its conditional probability, as a number of observations.
BACKOFF = 0.5
#: Characters that an unseen one competes with.
ALPHABET = 2000

STATES = ["clean", *(f"utf-8 as {w}" for w in UTF8_READ_AS), *(f"utf-8 as {w} twice" for w in TWICE_READ_AS), *(f"cp1252 as {w}" for w in CP1252_READ_AS)]


@lru_cache(maxsize=None)
def _byte(char: str, read_as: str) -> int:
    """The byte that ``read_as`` shows as ``char``; C1 controls stand for the bytes a code page leaves open; -1 if there is none."""
    try:
        return char.encode(read_as)[0]
    except UnicodeEncodeError:
        return ord(char) if 0x80 <= ord(char) <= 0x9F and read_as.startswith("cp125") else -1


def _utf8_unit(units: list[tuple[int, int, str]], at: int, read_as: str) -> tuple[int, str] | None:
    """The number of items from ``at`` on and the character they spell in UTF-8 bytes read as ``read_as``, or None."""
    lead = _byte(units[at][2], read_as)
    size = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 0
    if not size or at + size > len(units):
        return None
    rest = [_byte(u[2], read_as) for u in units[at + 1 : at + size]]
    if any(not 0x80 <= b <= 0xBF for b in rest):
        return None
    try:
        return size, bytes([lead, *rest]).decode("utf-8")
    except UnicodeDecodeError:
        return None


def _collapse(units: list[tuple[int, int, str]], read_as: str) -> tuple[list[tuple[int, int, str]], list[bool]]:
    """Greedy inverse of UTF-8 read as ``read_as`` over (start, length, character) items; which of the items were spelled so."""
    out, spelled, at = [], [], 0
    while at < len(units):
        got = _utf8_unit(units, at, read_as) if ord(units[at][2]) > 127 else None
        if got:
            last = units[at + got[0] - 1]
            out.append((units[at][0], last[0] + last[1] - units[at][0], got[1]))
        else:
            out.append(units[at])
        spelled.append(bool(got))
        at += got[0] if got else 1
    return out, spelled


def readings(text: str) -> list[tuple[int, int, int, str]]:
    """(start, length, state, character): every way to read a non-ASCII part of ``text`` as one original character."""
    chars = [(i, 1, c) for i, c in enumerate(text)]
    out = [(i, 1, 0, c) for i, _, c in chars if ord(c) > 127]
    for k, w in enumerate(UTF8_READ_AS, 1):
        units, spelled = _collapse(chars, w)
        out += [(i, n, k, c) for (i, n, c), s in zip(units, spelled) if s]
    for k, w in enumerate(TWICE_READ_AS, 1 + len(UTF8_READ_AS)):
        once, _ = _collapse(chars, w)
        for v in dict.fromkeys((w, *TWICE_READ_AS)):
            units, spelled = _collapse(once, v)
            out += [(i, n, k, c) for (i, n, c), s in zip(units, spelled) if s and n > 2]
    for k, w in enumerate(CP1252_READ_AS, 1 + len(UTF8_READ_AS) + len(TWICE_READ_AS)):
        for i, _, c in chars:
            if ord(c) > 127 and (b := _byte(c, w)) >= 0x80:
                try:
                    out.append((i, 1, k, bytes([b]).decode("cp1252")))
                except UnicodeDecodeError:
                    pass
    return list(dict.fromkeys(out))


def _context(text: str, start: int, length: int) -> str:
    """The two neighbours on either side, lower case; digits and further non-ASCII characters each as one class."""
    side = lambda s: "".join("*" if ord(c) > 127 else "0" if c.isdigit() else c.lower() for c in s)
    return f"{side(text[max(0, start - 2) : start]):>2}|{side(text[start + length : start + length + 2]):<2}"


def _kind(char: str) -> str:
    """The script of a letter, else the general category."""
    kind = unicodedata.category(char)
    return unicodedata.name(char, "?").split(" ")[0] if kind in ("Ll", "Lo", "Lu") else kind


def _likely(char: str) -> float:
    """Prior weight of a character by its category, where the corpus has not seen it."""
    kind = unicodedata.category(char)
    return 1.0 if kind in ("Ll", "Lo", "Lu") else 0.1 if kind[0] in "PSNZLM" and not 0x2500 <= ord(char) <= 0x25FF else 0.001


def _fits(char: str, before: str, after: str) -> float:
    """How well a character goes with its neighbours whatever the corpus says: symbols, capitals and foreign letters are rare within words."""
    kind = unicodedata.category(char)
    if kind == "Cc" or char == LOST:
        return 0.001
    if not (before.isalpha() and after.isalpha()):
        return 1.0
    if kind[0] in "SN" or kind in ("Lm", "Po", "Lo") and ord(char) < 0x2000:
        return 0.02
    if before.isascii() and after.isascii() and _kind(char) in ("GREEK", "CYRILLIC"):
        return 0.02
    return 0.05 if kind == "Lu" and before.islower() else 1.0


def _read_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for text, group, value, n in zip(pdf["id"], pdf["grp"], pdf["value"], pdf["n"]):
            got = readings(value)
            spelled = {i for start, size, s, _ in got if 1 <= s <= len(UTF8_READ_AS) for i in range(start, start + size)}
            for i, size, state, c in got:
                fits = _fits(c, value[i - 1 : i], value[i + size : i + size + 1])
                rows.append((text, group, n, i, size, state, c, c.lower(), _context(value, i, size), _kind(c), i in spelled, _likely(c), fits))
        yield pd.DataFrame(rows, columns=["id", "grp", "n", "start", "size", "state", "char", "low", "ctx", "kind", "spelled", "prior", "fits"])


_READ = "id bigint, grp string, n bigint, start int, size int, state int, char string, low string, ctx string, kind string, spelled boolean, prior double, fits double"


def viterbi(text: str, emissions: list[tuple[int, int, int, str, float]]) -> tuple[str, list[tuple[int, int, int]]]:
    """The most likely original of ``text`` and its garbled spans (start, end, state), from (start, length, state, character, log probability)."""
    by_start: dict[int, list[tuple[int, int, str, float]]] = {}
    for i, size, state, c, p in emissions:
        by_start.setdefault(i, []).append((size, state, c, p))
    n = len(text)
    best: list[dict[int, tuple[float, int, int, str]]] = [{} for _ in range(n + 1)]  # state -> score, previous position, previous state, character
    best[0][0] = (0.0, -1, -1, "")
    for i in range(n):
        if not best[i]:
            continue
        here = best[i]
        options = by_start.get(i)
        if options is None:  # ASCII: stays in its state, or goes back to clean
            options = [(1, s, text[i], 0.0) for s in here]
            if 0 not in here:
                options.append((1, 0, text[i], 0.0))
        for size, state, c, p in options:
            to = best[i + size]
            for was, (score, *_) in here.items():
                move = 0.0 if was == state else ENTER if was == 0 else LEAVE if state == 0 else SWITCH
                total = score + move + p
                if state not in to or total > to[state][0]:
                    to[state] = (total, i, was, c)
    state = max(best[n], key=lambda s: best[n][s][0])
    at, out, spans = n, [], []
    while at > 0:
        _, i, was, c = best[at][state]
        out.append(c)
        if state and ord(text[i]) > 127:
            spans.append((i, at, state))
        at, state = i, was
    return "".join(reversed(out)), spans[::-1]


def _label_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for group, value, read in zip(pdf["grp"], pdf["value"], pdf["read"]):
            text, spans = viterbi(value, [(r["start"], r["size"], r["state"], r["char"], r["p"]) for r in read])
            if spans or LOST in text:
                rows.append((group, value, "" if LOST in text else text, len(spans)))
        yield pd.DataFrame(rows, columns=["grp", "value", "restored", "n_spans"])


def restore(values: DataFrame) -> DataFrame:
    """(grp, value, restored, n_spans) of the wrongly decoded ones among ``values`` (grp, value, n).

    ``grp`` names the language a value's characters are counted with, ``n`` how often the value occurs. restored is the whole
    original text, '' if part of it is lost for good (U+FFFD stands in it). Null and pure ASCII values are never garbled. One
    row per distinct grp and value; values of any length count whole.
    """
    todo = values.where(F.col("value").rlike(NON_ASCII)).groupBy("grp", "value").agg(F.sum("n").alias("n"))
    todo = materialise(todo.withColumn("id", F.monotonically_increasing_id()), "garbled-or-not")  # numbers are fixed once written
    read = materialise(spread(todo).mapInPandas(_read_batches, _READ), "readings")
    # Texts with a unit of UTF-8 whose character is of a kind that the corpus writes outright don't count as clean.
    plain = read.where("state = 0 and not spelled").groupBy("kind").agg(F.count(F.lit(1)).alias("_n"))
    all_kinds = F.sum("_n").over(Window.partitionBy(F.lit(0)))  # at most the scripts and categories of Unicode
    kinds = plain.withColumn("_all", all_kinds).where("_n * 10000 >= _all").select("kind")
    unclean = read.where(F.col("state").between(1, len(UTF8_READ_AS))).join(F.broadcast(kinds), "kind", "left_semi").select("id", F.lit(True).alias("_unclean")).distinct()
    read = read.join(unclean, "id", "left").withColumn("trains", (F.col("state") == 0) & F.col("_unclean").isNull()).drop("_unclean")
    seen = read.where("trains").groupBy("grp", "ctx", "low").agg(F.sum("n").alias("n_seen"))
    around = seen.groupBy("grp", "ctx").agg(F.sum("n_seen").alias("n_ctx"))
    alone = read.where("trains").groupBy("grp", "char").agg(F.sum("n").alias("n_char"))
    total = alone.groupBy("grp").agg(F.sum("n_char").alias("n_all"))
    full = read.join(seen, ["grp", "ctx", "low"], "left").join(around, ["grp", "ctx"], "left").join(alone, ["grp", "char"], "left").join(total, ["grp"], "left").na.fill(0, ["n_seen", "n_ctx", "n_char", "n_all"])
    own = F.when(F.col("trains"), F.col("n")).otherwise(0)  # a text is no evidence for its own reading
    unigram = (F.col("n_char") - own + 0.01 * F.col("prior")) / (F.col("n_all") - own + 0.01 * ALPHABET)
    p = F.log(F.col("fits") * (F.greatest(F.col("n_seen") - own, F.lit(0)) + BACKOFF * unigram) / (F.greatest(F.col("n_ctx") - own, F.lit(0)) + BACKOFF))
    scored = full.groupBy("id").agg(F.collect_list(F.struct("start", "size", "state", "char", p.alias("p"))).alias("read"))  # of one text
    return spread(todo.join(scored, "id").select("grp", "value", "read")).mapInPandas(_label_batches, "grp string, value string, restored string, n_spans int")


#: The fields that can be garbled, and the language that each is counted with: the three names count as one.
FIELDS = {"author_name": "name", "person_name": "name", "committer_name": "name", "commit_summary": "summary", "source_text": "source"}
NON_ASCII = "[^\\x00-\\x7f]"


def occurrences(rows: DataFrame, fields: tuple[str, ...] = tuple(FIELDS)) -> DataFrame:
    """(grp, field, record_key, value, n_rows): the non-ASCII values of ``fields``, by commit or, source_text, by token; one scan.

    The record key is null where the commit or a part of the token's key is.
    """
    token = F.when(F.col("repo_name").isNotNull() & F.col("file_path").isNotNull() & F.col("token_index").isNotNull(), F.concat_ws("|", "repo_name", "file_path", F.col("token_index").cast("string"))) if "source_text" in fields else None
    key = {f: token if f == "source_text" else F.col("original_commit_sha") for f in fields}
    some = None
    for f in fields:
        some = F.col(f).rlike(NON_ASCII) if some is None else some | F.col(f).rlike(NON_ASCII)
    each = F.explode(F.array(*[F.struct(F.lit(FIELDS[f]).alias("grp"), F.lit(f).alias("field"), key[f].alias("record_key"), F.col(f).alias("value")) for f in fields]))
    found = rows.where(some).select(each.alias("_x")).select("_x.*").where(F.col("value").rlike(NON_ASCII))
    return found.groupBy("grp", "field", "record_key", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def counted(found: DataFrame) -> DataFrame:
    """(grp, value, n) of ``occurrences``: in how many commits and fields a value stands, or in how many rows a source_text."""
    return found.groupBy("grp", "value").agg(F.sum(F.when(F.col("grp") == "source", F.col("n_rows")).otherwise(1)).alias("n"))


def restore_tokens(tokens: DataFrame) -> DataFrame:
    """(field, record_key, restored): the wrongly decoded author_name and commit_summary by commit, and source_text by repo_name|file_path|token_index.

    Rows without a commit or with a null part of the token's key have no record key and are left out; repeated rows come out once.
    """
    found = materialise(occurrences(tokens), "occurrences")
    fixed = materialise(restore(counted(found)), "restored").select(F.col("grp").alias("_grp"), F.col("value").alias("_value"), "restored")
    rows = found.where(F.col("record_key").isNotNull() & F.col("field").isin("author_name", "commit_summary", "source_text"))
    return rows.join(fixed, (F.col("grp") == F.col("_grp")) & (F.col("value") == F.col("_value"))).select("field", "record_key", "restored").distinct()
