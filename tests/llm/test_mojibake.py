import pytest

from strataloom.llm import mojibake as M

WORDS = ["Größe prüfen", "naïve café", "déjà vu", "año de la versión", "SÃO ÂNGULO", "Zmień wysokość", "проверить длину", "長さを確認", "prêt à l’emploi", "Ärger übrig", "coração", "výška a šířka", "£5 or €7 – fees"]


def garble(text, was, read_as):
    return text.encode(was).decode(read_as)


@pytest.mark.parametrize("read_as", ["latin-1", "cp437", "mac_roman"])
def test_readings_hold_the_inverse(read_as):
    state = 1 + M.UTF8_READ_AS.index(read_as)
    for w in WORDS:
        bad = garble(w, "utf-8", read_as)
        spelled = "".join(c for i, n, s, c in sorted(M.readings(bad)) if s == state)
        assert spelled == "".join(c for c in w if ord(c) > 127)


def corpus():
    texts = [f"{w} {t} {i}" for w in WORDS for t in ("row", "node") for i in range(6)]
    bad = {}
    for i, w in enumerate(WORDS):
        good = f"{w} lone {i}"
        for was, read_as in (("utf-8", "latin-1"), ("utf-8", "cp437"), ("utf-8", "mac_roman"), ("cp1252", "mac_roman"), ("cp1252", "cp437")):
            try:
                bad[garble(good, was, read_as)] = good
            except UnicodeError:
                pass
        bad[garble(garble(good, "utf-8", "latin-1"), "utf-8", "latin-1")] = good
        bad[good.encode("ascii", "replace").decode().replace("?", M.LOST)] = ""
    return texts, bad


def test_restores_every_pair_and_leaves_clean_texts_alone(spark):
    texts, bad = corpus()
    df = spark.createDataFrame([("g", t, 5) for t in texts] + [("g", b, 1) for b in bad], "grp string, value string, n bigint")
    got = {r["value"]: r["restored"] for r in M.restore(df).collect()}
    wrong = {b: (got.get(b), w) for b, w in bad.items() if got.get(b) != w}
    assert not [t for t in texts if t in got]
    assert len(wrong) <= 0.05 * len(bad), wrong
    assert all(got[b] == "" for b, w in bad.items() if w == "")


def test_a_text_that_is_garbled_in_part(spark):
    rows = [("g", f"Begoña Wesňe {i}", 3) for i in range(20)] + [("g", "BegoÃ±a Wesňe x", 1)]
    got = {r["value"]: r["restored"] for r in M.restore(spark.createDataFrame(rows, "grp string, value string, n bigint")).collect()}
    assert got == {"BegoÃ±a Wesňe x": "Begoña Wesňe x"}


def test_edges(spark):
    schema = "grp string, value string, n bigint"
    assert M.restore(spark.createDataFrame([("g", None, 1), ("g", "", 1), ("g", "plain", 2)], schema)).count() == 0
    assert M.restore(spark.createDataFrame([], schema)).count() == 0
    long = "naïve café " * 3000
    rows = [("g", long, 2), ("g", long, 2), ("g", garble(long, "utf-8", "latin-1"), 1)]
    got = [tuple(r)[1:3] for r in M.restore(spark.createDataFrame(rows, schema)).collect()]
    assert got == [(garble(long, "utf-8", "latin-1"), long)]


def test_tokens_keep_their_keys(spark):
    clean = [("r", "f.c", i, "Größe row", f"s{i}", "Jürgen Öfner", "J", "J", "naïve fix") for i in range(8)]
    bad = [("r", "f.c", 9, garble("Größe row", "utf-8", "latin-1"), "s9", garble("Jürgen Öfner", "utf-8", "latin-1"), "J", "J", "na�ve")] * 2 + [(None, "f.c", 10, None, None, None, None, None, None)]
    df = spark.createDataFrame(clean + bad, "repo_name string, file_path string, token_index bigint, source_text string, original_commit_sha string, author_name string, person_name string, committer_name string, commit_summary string").withColumn("value", M.F.lit(1)).withColumn("grp", M.F.lit(2))
    assert {tuple(r) for r in M.restore_tokens(df).collect()} == {("author_name", "s9", "Jürgen Öfner"), ("commit_summary", "s9", ""), ("source_text", "r|f.c|9", "Größe row")}
