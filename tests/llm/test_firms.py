import pytest

from strataloom.llm import firms as M

LIST = [(1, "Soltav Storage", "soltav.example", "Fenkin"), (2, "Ranvel Energy", "ranvel.example", "Tresal"), (3, "Ranvel Data Systems", "ranvel-data.example", "Kormur"), (4, "Brincal Software", "brincal-software.example", "Lohal"), (5, "Wynquå", "wynquå.example", "Glohal"), (6, "Xalith Cloud Services", "xalith.example", None), (7, "Astdro", None, "Kinwen")] + [(10 + i, f"{n} {g}", f"{n.lower()}.example", "X") for i, (n, g) in enumerate((n, g) for g in ("Storage", "Energy", "Software", "Systems", "Services") for n in (f"Kor{g[:2].lower()}zib", f"Mal{g[:2].lower()}tex", f"Nub{g[:2].lower()}gal"))]
NAMES = {
    "Soltav Storage": "Soltav Storage", "  soltav STORAGE, Inc. ": "Soltav Storage", "SoltavStorage": "Soltav Storage", "Storage Soltav": "Soltav Storage", "Slotav Storage GmbH": "Soltav Storage",
    "Soltav Stor.": "Soltav Storage", "Soltav": "Soltav Storage", "c/o Soltav Storage": "Soltav Storage", "Fenkin office, Soltav Storage": "Soltav Storage", "The Soltav Storage Group (R&D)": "Soltav Storage",
    "Brincal SW": "Brincal Software", "X.C.S.": "Xalith Cloud Services", "Wynqua": "Wynquå", "Ranvel Data Sys": "Ranvel Data Systems", "Mobamo Storage": "", "private": "", "": "", "-": "", "Storage": "",
}
HOMES = {"mx4.soltav.example": "Soltav Storage", "soltav-labs12.test": "Soltav Storage", "eu1.ranvel-data.test": "Ranvel Data Systems", "ranvel.org": "Ranvel Energy", "x.brincall-software.example": "Brincal Software", "host-9.localdomain.invalid": "", "murnizel490.example": "", "astdro.example": ""}


@pytest.fixture(scope="module")
def result(spark):
    fc = spark.createDataFrame([(n, None if i % 2 else " ") for i, n in enumerate(NAMES)] + [(None, None), ("Reviewed", "Astdro")], "firm_raw string, firm string").withColumn("tokens", M.F.lit(1)).withColumn("entry", M.F.lit("x"))
    tk = spark.createDataFrame([(f"  {d.upper()} ",) for d in HOMES] * 2 + [("mapped.example",), ("",), (None,)], "person_domain string")
    dm = spark.createDataFrame([(" Mapped.example ",), (None,)], "domain string")
    fl = spark.createDataFrame(LIST, "firm_id bigint, firm string, home_domain string, city string")
    return {(r["value_kind"], r["raw_value"]): r["firm"] for r in M.canonical_firms(fc, tk, dm, fl).collect()}


def test_names_and_domains(result):
    expected = {("firm_raw", n): f for n, f in NAMES.items()} | {("person_domain", d): f for d, f in HOMES.items()}
    assert result == expected


def test_repair_finds_what_a_full_comparison_finds(spark):
    vocabulary = ["storage", "soltav", "ranvel", "brincal", "software"]
    tokens = ["soltav", "soltv", "slotav", "soltavv", "sollav", "xoltav", "brincla", "storag", "ranve", "rnavle", "softwear", "zzzz", "a"]
    v = spark.createDataFrame([(w, False) for w in vocabulary], "word string, generic boolean")
    got = {(r["token"], r["word"]) for r in M.repair(spark.createDataFrame([(t,) for t in tokens], "token string"), v).collect()}

    def near(a, b):
        if a == b:
            return True
        if len(a) == len(b):
            diff = [i for i in range(len(a)) if a[i] != b[i]]
            return len(diff) == 1 or len(diff) == 2 and diff[1] == diff[0] + 1 and a[diff[0]] == b[diff[1]] and a[diff[1]] == b[diff[0]]
        short, long = sorted((a, b), key=len)
        return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    assert {(t, w) for t in tokens for w in vocabulary if near(t, w)} <= got


def test_repair_over_two_edits(spark):
    v = spark.createDataFrame([("storage", True), ("soltav", False), ("data", True)], "word string, generic boolean")
    t = spark.createDataFrame([(t,) for t in ("stroaeg", "soltxvy", "stv", "olav", "stg", "storages", "srg", "dta", "gst")], "token string")
    one, two = ({(r["token"], r["word"]): r["sim"] for r in M.repair(t, v, edits).collect()} for edits in (1, 2))
    assert set(one) == {("stg", "storage"), ("srg", "storage"), ("storages", "storage"), ("dta", "data")} and set(two) == set(one) | {("soltxvy", "soltav"), ("olav", "soltav")}
    assert two["soltxvy", "soltav"] < one["dta", "data"]


def test_forms_of_one_entry_only(spark):
    rows = [("A", ["kor", "energy"]), ("B", ["mal", "energy"]), ("C", ["nub", "energy"]), ("D", ["nub"]), ("E", ["kor", "extra", "energy"])]
    got = {(r["entry"], r["form"], r["word"]) for r in M.entry_forms(spark.createDataFrame(rows, "entry string, tokens array<string>")).collect() if r["form"] != "whole"}
    assert got == {("A", "telling", "kor"), ("B", "telling", "mal"), ("E", "telling", "kor"), ("E", "telling", "extra"), ("A", "initials", "ke"), ("B", "initials", "me"), ("C", "initials", "ne"), ("E", "initials", "kee")}


def test_empty_tables(spark):
    empty = lambda s: spark.createDataFrame([], s)
    fl = spark.createDataFrame(LIST, "firm_id bigint, firm string, home_domain string, city string")
    assert M.canonical_firms(empty("firm_raw string, firm string"), empty("person_domain string"), empty("domain string"), fl).count() == 0
    one = spark.createDataFrame([("Soltav", None)], "firm_raw string, firm string")
    assert [r["firm"] for r in M.canonical_firms(one, empty("person_domain string"), empty("domain string"), fl.limit(0)).collect()] == [""]
