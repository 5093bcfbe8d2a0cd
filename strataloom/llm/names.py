"""Variant spellings of names typed by people (problem 3).

Suffix blocking: a name is put under the suffix of each of its tokens, so that initials, nicknames, reordered parts, joined user
names and early typos meet; names under one address or person id meet too. A block of too many names is cut into pieces, and
every two of its pieces are compared, so a pair meets whatever the block's size. The pairs are compared by
longest-common-subsequence ratio, the linked ones make components.

What the comparison knows of given names it learns from the data, by shares that don't depend on the amount of it: a given name is a
token that stands first beside several others, a short form is a token that stands, under one address or person id and beside
one family name, for a name that more people bear.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm import mojibake
from strataloom.llm.components import components
from strataloom.runtime import materialise, pairs_within, pieces, spread

#: Characters of the indexed suffix; names of a piece of a block; names of a piece from which pairs are sifted by letter counts first.
SUFFIX, BLOCK, SIFTED = 5, 200, 12
#: Rows that a task holds back to leave out repeated ones before it hands them on.
HELD = 10_000
#: Longest-common-subsequence ratios that family names and given names need.
FAMILY, GIVEN = 0.86, 0.8
#: A given name: different tokens it stands before, share of its names in which it stands first.
PARTNERS, FIRST = 3, 2 / 3
#: A short form: families in which it stands for the other name, share of its families with another name.
FAMILIES, STANDS_FOR = 2, 0.1

NAME_FIELDS = ("author_name", "person_name", "committer_name")

# Letters that fold to two ASCII letters or have no decomposition.
FOLDS = {"ß": "ss", "ø": "o", "ð": "d", "đ": "d", "ł": "l", "æ": "ae", "œ": "oe", "þ": "th", "ı": "i"}
#: Stands for a letter lost in decoding: it is alike to any letter.
ANY = "ʔ"

def fold(name: str) -> str:
    """Lower case without diacritics; what was lost in decoding becomes ANY."""
    plain = "".join(FOLDS.get(c, c) for c in re.sub(f"{mojibake.LOST}+", ANY, name.lower()))
    return "".join(c for c in unicodedata.normalize("NFD", plain) if not unicodedata.combining(c))


def tokens_of(name: str) -> list[str]:
    """The folded parts of a name without what stands in brackets, in order, each once."""
    return list(dict.fromkeys(t for t in re.split(r"[^\w']+|_", fold(re.sub(r"\([^)]*\)|\[[^\]]*\]", " ", name))) if t))


@lru_cache(1 << 17)
def lcs_ratio(a: str, b: str) -> float:
    """Twice the length of the longest common subsequence over the sum of lengths; bit-parallel."""
    if not a or not b:
        return 0.0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    any_mask = masks.get(ANY, 0)
    v = full
    for c in b:
        u = v & (full if c == ANY else masks.get(c, 0) | any_mask)
        v = ((v + u) | (v - u)) & full
    return 2 * (len(a) - bin(v).count("1")) / (len(a) + len(b))


NONE: frozenset[str] = frozenset()


class Known:
    """What is known of given names: the tokens that are ones, and the names that a short form stands for."""

    def __init__(self, given: frozenset[str] | set[str] = NONE, forms: dict[str, frozenset[str]] | None = None):
        self.given, self.forms = given, forms or {}

    def of(self, token: str) -> frozenset[str]:
        return self.forms.get(token, NONE)


NOTHING = Known()


@lru_cache(1 << 16)
def _same_given(a: str, b: str, forms_a: frozenset[str], forms_b: frozenset[str], both_given: bool) -> bool:
    if a == b or (len(a) == 1 or len(b) == 1) and a[0] == b[0]:
        return True
    if a in forms_b or b in forms_a or forms_a & forms_b:
        return True
    if both_given:
        return False
    return any(lcs_ratio(b, f) >= FAMILY for f in forms_a) or any(lcs_ratio(a, f) >= FAMILY for f in forms_b) or a[0] == b[0] and lcs_ratio(a, b) >= GIVEN


def _same_family(a: str, b: str) -> bool:
    """Alike enough for family names; a swap of neighbours counts as one typo, tokens below 4 letters must be equal."""
    if a == b or min(len(a), len(b)) < 4:
        return a == b
    if lcs_ratio(a, b) >= FAMILY:
        return True
    at = [i for i, (c, d) in enumerate(zip(a, b)) if c != d] if len(a) == len(b) >= SUFFIX else []
    return len(at) == 2 and at[1] == at[0] + 1 and at[0] > 0 and a[at[0]] == b[at[1]] and a[at[1]] == b[at[0]]


def given_of(tokens: list[str], known: Known = NOTHING) -> set[str]:
    """The tokens that are known as given names, if another is left to be the family name."""
    listed = {t for t in tokens if t in known.given}
    return listed if any(len(t) > 1 and t not in listed for t in tokens) else set()


def same_person(a: list[str], b: list[str], together: bool, known: Known = NOTHING) -> bool:
    """Whether two token lists can name one person; ``together``: they stand under one address or id, so the given names may differ."""
    long_a, long_b = [t for t in a if len(t) > 1], [t for t in b if len(t) > 1]
    if not long_a or not long_b:
        return False
    if len(a) == 1 or len(b) == 1:
        one, rest = (a[0], b) if len(a) == 1 else (b[0], a)
        if len(rest) == 1:
            return lcs_ratio(one, rest[0]) >= FAMILY and (one[0] == rest[0][0] or together)
        for family in (t for t in rest if len(t) >= SUFFIX):
            for given in (t for t in rest if t != family):
                initials = {given[0]} | {f[0] for f in known.of(given)}
                if len(one) > len(family) - 2 and any(one[0] == i and lcs_ratio(one[1:], family) >= FAMILY for i in initials):
                    return True
        return together and any(lcs_ratio(one, t) >= FAMILY for t in rest if len(t) >= SUFFIX)
    known_a, known_b = given_of(a, known), given_of(b, known)
    for x in long_a:
        for y in long_b:
            if x in known_a and y in known_b or not _same_family(x, y):
                continue
            # A short token beside two others can be a particle or what decoding left of a name.
            if together and (min(len(x), len(y)) >= 4 or len(a) == len(b) == 2) or _all_given(_main([t for t in a if t != x]), _main([t for t in b if t != y]), known):
                return True
    return False


def _all_given(a: list[str], b: list[str], known: Known) -> bool:
    """Whether every given name of the shorter list has its like in the other."""
    few, more = sorted((a, b), key=len)
    return bool(few) and all(any(_same_given(g, h, known.of(g), known.of(h), g in known.given and h in known.given) for h in more) for g in few)


def _main(given: list[str]) -> list[str]:
    """The given names without middle initials."""
    return [t for t in given if len(t) > 1] or given[:1]


def other_given(a: list[str], b: list[str]) -> tuple[str, str, str] | None:
    """(given, given, family) of two names that have one family name in common and one further token each, a different one."""
    common = [t for t in a if t in b and len(t) >= 4]
    if len(common) != 1:
        return None
    rest = [_main([t for t in side if t != common[0]]) for side in (a, b)]
    if len(rest[0]) != 1 or len(rest[1]) != 1 or rest[0] == rest[1] or min(len(rest[0][0]), len(rest[1][0])) < 2:
        return None
    return rest[0][0], rest[1][0], common[0]


def _token_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"name": pdf["name"], "tokens": [tokens_of(r) if isinstance(r, str) and r else tokens_of(n) for n, r in zip(pdf["name"], pdf["restored"])]})


def _counts(tokens: list[str], letters: np.ndarray) -> np.ndarray:
    """How often each of the code points ``letters`` stands in each token."""
    codes = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.searchsorted(letters, codes).clip(max=len(letters) - 1)
    of = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    there = letters[at] == codes
    return np.bincount(of[there] * len(letters) + at[there], minlength=len(tokens) * len(letters)).reshape(len(tokens), len(letters))


def _bound(a: list[str], b: list[str]) -> np.ndarray:
    """For every two tokens, whether their letter counts allow a longest common subsequence that links them."""
    letters = np.unique(np.frombuffer("".join(a).encode("utf-32-le", "surrogatepass"), np.uint32))
    sides = [_counts(ts, letters) for ts in (a, b)]
    # The lesser of two counts, summed over the letters, as a product: one column for each letter and number of times.
    levels = [[n >= k for k in range(1, int(min(sides[0].max(), sides[1].max())) + 1)] for n in sides]
    most = np.zeros((len(a), len(b)), np.float32)
    if levels[0]:
        x, y = (np.concatenate(n, axis=1) for n in levels)
        used = x.any(axis=0) & y.any(axis=0)
        most += x[:, used].astype(np.float32) @ y[:, used].astype(np.float32).T
    most += np.add.outer([t.count(ANY) for t in a], [t.count(ANY) for t in b])
    sizes = np.add.outer([len(t) for t in a], [len(t) for t in b])
    # A joined user name is compared without its first letter, a swap of neighbours keeps all letters.
    return 2 * most >= FAMILY * (sizes - 1)


def _alike(x: str, y: str) -> bool:
    """Whether ``same_person`` can link two names by these tokens: alike as family names, or one without its first letter."""
    return lcs_ratio(x, y) >= FAMILY or _same_family(x, y) or lcs_ratio(x[1:], y) >= FAMILY or lcs_ratio(x, y[1:]) >= FAMILY


def _sifted(left: list[dict], right: list[dict], known: Known) -> Iterator[tuple[dict, dict]]:
    """The pairs of two pieces that ``same_person`` can link: two tokens, not both given names, that are alike; each two tokens are compared once."""
    if len(left) * len(right) < SIFTED * SIFTED:
        yield from ((x, y) for x in left for y in right)
        return
    bearers: list[dict[str, tuple[list[int], list[int]]]] = []  # token -> names that bear it otherwise, as a given name
    for side in (left, right):
        of: dict[str, tuple[list[int], list[int]]] = {}
        for i, x in enumerate(side):
            given = given_of(x["tokens"], known) if len(x["tokens"]) > 1 else NONE
            for t in x["tokens"]:
                if len(t) > 1:
                    of.setdefault(t, ([], []))[t in given].append(i)
        bearers.append(of)
    own = [list(of) for of in bearers]
    if not own[0] or not own[1]:
        return
    linked: set[int] = set()
    for k, m in zip(*(at.tolist() for at in np.nonzero(_bound(own[0], own[1])))):
        (other_x, given_x), (other_y, given_y) = bearers[0][own[0][k]], bearers[1][own[1][m]]
        if (other_x or other_y) and _alike(own[0][k], own[1][m]):
            linked.update(i * len(right) + j for i in other_x for j in (*other_y, *given_y))
            linked.update(i * len(right) + j for i in given_x for j in other_y)
    for k in sorted(linked):
        yield left[k // len(right)], right[k % len(right)]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, bool, dict, list]]:
    """(unit, together, right, name with its tokens, (token, given, forms) of what is known of them) of each row."""
    for batch in batches:
        tokens, (key, i, j, together, right, name) = batch.column("tokens"), (batch.column(c).to_pylist() for c in ("key", "i", "j", "together", "right", "name"))
        parts = tokens.flatten()
        ts, fields = parts.field("t").to_pylist(), {f.name for f in parts.type}
        given = parts.field("given").to_pylist() if "given" in fields else [False] * len(ts)
        forms = parts.field("forms").to_pylist() if "forms" in fields else [None] * len(ts)
        ends = np.cumsum(tokens.value_lengths().to_numpy(zero_copy_only=False)).tolist()
        for n, (start, end) in enumerate(zip([0, *ends], ends)):
            told = [x for x in zip(ts[start:end], given[start:end], forms[start:end]) if x[1] or x[2]]
            yield (key[n], i[n], j[n]), together[n], right[n], {"name": name[n], "tokens": ts[start:end]}, told


def _read_units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], list[dict], bool, bool, Known]]:
    """(left, right, same, together, known) of each unit, whose rows stand together; no more than one unit is held."""
    for (_, i, j), rows in groupby(_rows(batches), itemgetter(0)):
        sides: tuple[list[dict], list[dict]] = ([], [])
        parts: list[tuple] = []
        together = False
        for _, together, right, name, told in rows:
            sides[right].append(name)
            parts += told
        known = Known({t for t, given, _ in parts if given}, {t: frozenset(forms) for t, _, forms in parts if forms}) if parts else NOTHING
        yield sides[0], sides[0] if i == j else sides[1], i == j, together, known


def _handed_on(found: Iterator[tuple[str, ...]], columns: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """The distinct rows of ``found``, HELD at a time."""
    held: set[tuple[str, ...]] = set()
    for row in found:
        held.add(row)
        if len(held) >= HELD:
            yield _batch_of(held, columns)
            held.clear()
    yield _batch_of(held, columns)


def _batch_of(rows: set[tuple[str, ...]], columns: tuple[str, ...]) -> pa.RecordBatch:
    ordered = sorted(rows)
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in ordered], pa.string()) for k in range(len(columns))], names=list(columns))


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    for left, right, same, together, known in _read_units(batches):
        for x, y in _sifted(left, right, known):
            if (x["name"] < y["name"] or not same) and same_person(x["tokens"], y["tokens"], bool(together), known):
                yield min(x["name"], y["name"]), max(x["name"], y["name"])


def _compare_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _handed_on(_links(batches), ("a", "b"))


def _other_givens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, str]]:
    for left, right, same, _, _ in _read_units(batches):
        for x in left:
            for y in right:
                if (x["name"] < y["name"] or not same) and (got := other_given(x["tokens"], y["tokens"])):
                    yield min(got[:2]), max(got[:2]), got[2]


def _given_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _handed_on(_other_givens(batches), ("g", "h", "family"))


def spellings(commits: DataFrame) -> DataFrame:
    """(name, address, person): every spelling with every lower-cased address and person id it stands beside; null where there is none."""
    sides = [("author_name", "author_email", F.col("personid")), ("person_name", "person_email", F.col("personid")), ("committer_name", "committer_email", F.lit(None).cast("string"))]
    x = F.explode(F.array(*[F.struct(F.col(n).alias("name"), F.nullif(F.lower(F.trim(e)), F.lit("")).alias("address"), F.nullif(F.trim(p), F.lit("")).alias("person")) for n, e, p in sides]))
    return commits.select(x.alias("x")).select("x.*").where("name is not null").distinct()


def blocks_of(named: DataFrame, beside: DataFrame) -> DataFrame:
    """(key, together, name) from (name, tokens) and ``beside`` (name, address, person): each name under the suffixes of its tokens, the whole token where it is shorter, its addresses and person ids.

    A single letter is an initial and no key.
    """
    suffix = named.select(F.explode("tokens").alias("t"), "name").where(F.length("t") > 1).select(F.concat(F.lit("s|"), F.right("t", F.lit(SUFFIX))).alias("key"), F.lit(False).alias("together"), "name")
    shared = beside.join(named.select("name"), "name")
    sides = [shared.where(f"{c} is not null").select(F.concat(F.lit(f"{c}|"), c).alias("key"), F.lit(True).alias("together"), "name") for c in ("address", "person")]
    return suffix.union(sides[0]).union(sides[1]).distinct()


def given_names(named: DataFrame) -> DataFrame:
    """(t, given) from (name, tokens): the tokens that stand first, beside PARTNERS different ones or more, in FIRST of their names of several tokens."""
    several = named.where(F.size("tokens") > 1).select(F.posexplode("tokens").alias("_pos", "t"), F.try_element_at("tokens", F.lit(-1)).alias("_last"))
    by = several.groupBy("t", "_last").agg(F.count_if(F.col("_pos") == 0).alias("_first"), F.count(F.lit(1)).alias("_n"))
    sums = by.groupBy("t").agg(F.sum("_first").alias("_first"), F.sum("_n").alias("_n"), F.count_if(F.col("_first") > 0).alias("_partners"))
    return sums.where((F.length("t") > 1) & (F.col("_partners") >= PARTNERS) & (F.col("_first") >= FIRST * F.col("_n"))).select("t", F.lit(True).alias("given"))


def short_forms(pairs: DataFrame) -> DataFrame:
    """(t, forms) from (g, h, family): the names that a token stands for, each borne in at least as many families as the token.

    A name counts if it takes STANDS_FOR of the token's families, and FAMILIES at least, so a token has at most 1 / STANDS_FOR forms.
    """
    both = pairs.distinct()
    both = both.select(F.col("g").alias("t"), F.col("h").alias("form"), "family").union(both.select("h", "g", "family"))
    borne = both.groupBy("t", "family").agg(F.count(F.lit(1)).alias("_c")).groupBy("t").agg(F.count(F.lit(1)).alias("_n"))
    shared = both.groupBy("t", "form").agg(F.count(F.lit(1)).alias("_s")).where(F.col("_s") >= FAMILIES)
    rated = shared.join(borne, "t").join(borne.select(F.col("t").alias("form"), F.col("_n").alias("_m")), "form")
    return rated.where((F.col("_n") <= F.col("_m")) & (F.col("_s") >= STANDS_FOR * F.col("_n"))).groupBy("t").agg(F.collect_set("form").alias("forms"))  # at most 1 / STANDS_FOR


def _units(blocks: DataFrame, named: DataFrame) -> DataFrame:
    """(key, i, j, together, right, name, tokens): the names of every two pieces of a block, the rows of two pieces next to each other in one partition.

    A row is one name and no list of names, so what a task holds at once is a batch of small rows, however large the blocks are.
    """
    met = pieces(blocks.join(named, "name"), "key", "name", BLOCK).select("key", "i", "j", "together", "right", "name", "tokens")
    return spread(met, "key", "i", "j").sortWithinPartitions("key", "i", "j")


def link_names(tokens: DataFrame) -> DataFrame:
    """(name, person): every spelling that has a variant, with the least spelling of its person.

    Null names are no spelling, blank ones and those without letters link to nothing. Spellings decoded wrongly count as what
    they restore to; where that is lost, a lost letter is alike to any. A spelling that two people use joins
    them: the data can't tell which is meant.
    """
    commits = materialise(tokens.select("original_commit_sha", *NAME_FIELDS, "author_email", "person_email", "personid", "committer_email").distinct(), "name-rows")
    beside = materialise(spellings(commits), "spellings")
    garbled = mojibake.restore(mojibake.counted(mojibake.occurrences(commits, NAME_FIELDS))).select(F.col("value").alias("name"), "restored")
    names = beside.select("name").distinct().join(garbled, "name", "left")
    named = materialise(spread(names).mapInPandas(_token_batches, "name string, tokens array<string>"), "names")
    blocks = materialise(blocks_of(named, beside), "blocks")
    plain = named.select("name", F.transform("tokens", lambda t: F.struct(t.alias("t"))).alias("tokens"))
    seen = _units(blocks.where("together"), plain).mapInArrow(_given_batches, "g string, h string, family string")
    forms = materialise(short_forms(seen), "short-forms")
    each = named.select("name", F.posexplode("tokens").alias("pos", "t")).join(given_names(named), "t", "left").join(forms, "t", "left")
    known = each.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("pos", "t", F.coalesce("given", F.lit(False)).alias("given"), "forms"))).alias("tokens"))  # of one name
    links = _units(blocks, materialise(known, "known-names")).mapInArrow(_compare_batches, "a string, b string")
    return components(links).select(F.col("id").alias("name"), F.col("component").alias("person"))


def variant_pairs(tokens: DataFrame) -> DataFrame:
    """(name_a, name_b) with name_a < name_b by code point: all pairs of different spellings of a person."""
    people = materialise(link_names(tokens), "people")
    return pairs_within(people, "person", "name").select(F.col("a").alias("name_a"), F.col("b").alias("name_b"))
