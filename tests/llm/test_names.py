import random
import tracemalloc
from itertools import groupby

import pyarrow as pa
from pyspark.sql import functions as F

from strataloom.llm import names as N
from strataloom.llm.components import components

COLUMNS = "original_commit_sha string, author_name string, author_email string, person_name string, person_email string, personid string, committer_name string, committer_email string, commit_summary string"


def tokens(spark, people):
    """people: lists of (spelling, address); each spelling is an author of one commit."""
    rows = [(f"s{i}-{j}", n, e, people[i][0][0], people[i][0][1], None, n, e, "x") for i, p in enumerate(people) for j, (n, e) in enumerate(p)]
    return spark.createDataFrame(rows, COLUMNS)


def taught(*pairs):
    """People from whom short forms are learned: both names under one address, in three families of their own each."""
    families = iter(stems(400, 99, 6))
    return [[(f"{g} {f}", f"{f}@teach"), (f"{h} {f}", f"{f}@teach")] for g, h in pairs for f in (next(families) for _ in range(3))]


def planted_pairs(spark, people, *pairs):
    """The pairs found among the spellings of ``people``, beside those that teach ``pairs``."""
    known = {n for p in people for n, _ in p}
    return {tuple(r) for r in N.variant_pairs(tokens(spark, people + taught(*pairs))).collect() if set(r) <= known}


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return 2 * row[-1] / (len(a) + len(b))


def test_lcs_against_dynamic_programming():
    r = random.Random(3)
    for _ in range(500):
        a, b = ("".join(r.choice("abcd") for _ in range(r.randint(1, 14))) for _ in "ab")
        assert N.lcs_ratio(a, b) == brute_lcs(a, b)


def test_variants_link_and_siblings_do_not(spark):
    a = ["Susanna Daldufilev", "Daldufilev, Susanna", "DALDUFILEV Susanna", "sdaldufilev", "sue.daldufilev", "S. Daldufilev", "Daldufilev S", "Susanna Daldulfilev", "Susanna K. Daldufilev (Firm)", "Sussana Daldufilev"]
    b = ["Theodora Daldufilev", "tdaldufilev"]
    c = ["Jürgen Öftunronor", "Juergen Oeftunronor", "JÃ¼rgen Ã–ftunronor", "Jogi Öftunronor", "J�rgen �ftunronor"]
    lone = ["Forge Merge Bot", "", "  ", "李雷"]
    people = [[(n, f"{k}{i}@x") for i, n in enumerate(p)] for k, p in (("a", a), ("b", b), ("c", c))] + [[(n, None)] for n in lone] + [[(None, None)]]
    got = planted_pairs(spark, people, ("Susanna", "Sue"), ("Jürgen", "Jogi"))
    assert got == {(x, y) for p in (a, b, c) for x in p for y in p if x < y}


def test_an_address_links_given_names_that_differ(spark):
    people = [[("Rosalind Vesfenvesme", "v@x"), ("Mopsy Vesfenvesme", "V@X "), ("Karl Other", "v@x")], [("Otto Vesfenvesme", "o@x")]]
    assert {tuple(r) for r in N.variant_pairs(tokens(spark, people)).collect()} == {("Mopsy Vesfenvesme", "Rosalind Vesfenvesme")}


def test_a_common_suffix_is_refined_and_loses_no_variant(spark):
    r = random.Random(4)
    stems = ["".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(4)) for _ in range(260)]
    people = [[(f"{g} {s}berger", f"{i}@x"), (f"{s}berger {g}", f"{i}@y")] for i, (s, g) in enumerate((s.title(), "Anna") for s in dict.fromkeys(stems))]
    got = {tuple(r) for r in N.variant_pairs(tokens(spark, people)).collect()}
    assert {tuple(sorted(n for n, _ in p)) for p in people} <= got


def test_empty(spark):
    assert N.variant_pairs(tokens(spark, [[("A B", None)]]).limit(0)).count() == 0


def test_components_against_union_find(spark):
    r = random.Random(1)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 480)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent}


def linked(spark, names, *pairs):
    return planted_pairs(spark, [[(n, f"{i}@x")] for i, n in enumerate(names)], *pairs)


def stems(n, seed, size=4):
    r = random.Random(seed)
    return list(dict.fromkeys("".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(size)).title() for _ in range(n)))


def test_a_common_given_name_changes_no_link(spark):
    pairs = {("Thomas Abcdefg", "Thomas Abdcefg"), ("Francisco Golidupen", "Paco Golidupen")}
    apart = ["Francois Golidupen"]
    planted = [n for p in pairs for n in p] + apart
    many = [f"{g} {s}" for g in ("Thomas", "Francisco") for s in stems(40, 8)]
    for names in (planted, planted + many):
        taught_pairs = ("Francisco", "Paco"), ("Francois", "Franz"), ("Thomas", "Tom")
        assert {p for p in linked(spark, names, *taught_pairs) if set(p) & set(planted)} == pairs


def test_short_forms_are_learned_by_shares(spark):
    family = stems(40, 12)
    rows = [("bob", "robert", f) for f in family[:6]] + [("rob", "robert", f) for f in family[6:12]] + [("al", "robert", family[0]), ("al", "albert", family[1]), ("al", "albert", family[2])]
    got = {r["t"]: set(r["forms"]) for r in N.short_forms(spark.createDataFrame(rows + rows, "g string, h string, family string")).collect()}
    assert got == {"bob": {"robert"}, "rob": {"robert"}, "albert": {"al"}}  # the one borne in fewer families stands for the other
    assert N.short_forms(spark.createDataFrame([], "g string, h string, family string")).count() == 0


def test_given_names_stand_first_beside_several_others(spark):
    rows = [("a", ["ann", "lee"]), ("b", ["ann", "kim"]), ("c", ["ann", "roe"]), ("d", ["lee", "ann"]), ("e", ["bob", "lee"]), ("f", ["cyd", "lee"]), ("g", ["solo"])]
    assert [tuple(r) for r in N.given_names(spark.createDataFrame(rows, "name string, tokens array<string>")).collect()] == [("ann", True)]


def test_a_block_of_more_names_loses_no_pair(spark):
    pairs = {("Bill Smithers", "William Smithers"), ("John Q Smithers", "John Smithers"), ("Yolanda Smithers", "Yolanda Tmithers")}
    planted = [n for p in pairs for n in p]
    for n in (20, 460):
        assert pairs <= linked(spark, planted + [f"{s} Smithers" for s in stems(n, 5)], ("William", "Bill"))


def test_an_address_of_many_names_loses_no_pair(spark):
    names = ["Rosalind Vesfenvesme", "Mopsy Vesfenvesme"] + [f"{a} {b}" for a, b in zip(stems(260, 6), stems(260, 7, 5))]
    got = {tuple(r) for r in N.variant_pairs(tokens(spark, [[(n, "noreply@x")] for n in names])).collect()}
    assert ("Mopsy Vesfenvesme", "Rosalind Vesfenvesme") in got


def test_sifting_leaves_out_no_linked_pair():
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdeʔ" if r.random() < 0.1 else "abcde") for _ in range(r.randint(1, 8)))
    side = [{"name": str(i), "tokens": list(dict.fromkeys(r.choice(["bill", "william", word()]) for _ in range(r.randint(1, 3))))} for i in range(150)]
    known = N.Known({"bill", "william"}, {"bill": frozenset({"william"})})
    kept = {(x["name"], y["name"]) for x, y in N._sifted(side, side, known)}
    said = {(x["name"], y["name"], t) for x in side for y in side for t in (False, True) if N.same_person(x["tokens"], y["tokens"], t, known)}
    assert said and {(a, b) for a, b, _ in said} <= kept


def test_short_names_have_blocks_of_their_own(spark):
    people = [["Alex Wong", "Wong, Alex", "Alexander Wong"], ["A. Lee", "Ann Lee", "LEE Ann"], ["J. Kim", "James Kim", "Jim Kim"]]
    lone = ["Bob Lee", "Jan de Boer", "Jan de Vries", "Ann Kin"]
    assert linked(spark, [n for p in people for n in p] + lone, ("Alexander", "Alex"), ("James", "Jim")) == {(a, b) for p in people for a in p for b in p if a < b}


def test_a_row_for_comparison_is_one_name_however_large_the_block(spark):
    named = spark.createDataFrame([(f"{s} Smithers", [{"t": s.lower()}, {"t": "smithers"}]) for s in stems(460, 5)], "name string, tokens array<struct<t string>>")
    units = N._units(named.select(F.lit("s|thers").alias("key"), F.lit(False).alias("together"), "name"), named)
    rows = units.select(F.length(F.to_json(F.struct(*units.columns))).alias("size"), "name", "key", "i", "j", F.spark_partition_id().alias("p")).collect()
    assert max(r["size"] for r in rows) < 300
    runs = [u for u, _ in groupby((r["p"], r["key"], r["i"], r["j"]) for r in rows)]
    assert len(runs) == len({u[1:] for u in runs}) == 6  # three pieces: each unit stands together, in one partition
    assert {r["name"] for r in rows} == {r["name"] for r in named.collect()}


def test_comparing_holds_one_unit_at_a_time():
    tokens = pa.list_(pa.struct({"pos": pa.int32(), "t": pa.string(), "given": pa.bool_(), "forms": pa.list_(pa.string())}))
    family, given = stems(120, 13, 5), ["Anna", "Bob", "Carl", "Robert"]

    def batches(units, size):
        rows = []
        for u in range(units):
            for k in range(60):
                g, f = given[k % 4], family[(u + k % 15) % len(family)]
                known = [{"pos": 0, "t": g.lower(), "given": True, "forms": ["robert"] if g == "Bob" else None}, {"pos": 1, "t": f.lower(), "given": False, "forms": None}]
                rows.append({"key": f"s|{u}", "i": 0, "j": 1, "together": False, "right": k >= 30, "name": f"{g} {f}{u}{'' if k < 30 else '+'}", "tokens": known})
        schema = pa.schema([("key", pa.string()), ("i", pa.int32()), ("j", pa.int32()), ("together", pa.bool_()), ("right", pa.bool_()), ("name", pa.string()), ("tokens", tokens)])
        return [pa.RecordBatch.from_pylist(rows[k : k + size], schema) for k in range(0, len(rows), size)]

    def links(units, size):
        return {tuple(r.values()) for b in N._compare_batches(iter(batches(units, size))) for r in b.to_pylist()}

    said = links(30, 10_000)
    assert said and links(30, 7) == links(30, 60) == said  # a unit may go on in the next batch
    peaks = []
    for n in (20, 400):
        sent = batches(n, 600)
        N.lcs_ratio.cache_clear()
        tracemalloc.start()
        for _ in N._compare_batches(iter(sent)):
            pass
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 2 * peaks[0] + (4 << 20)
