"""Free-entered values mapped to a reference list (problem 6).

Token-level repair: every distinct token is joined to the vocabulary of the reference list by edit distance, through the
deletions that two near tokens share, and by the ways words are shortened. The repaired tokens of a value are then combined with
soft TF-IDF, and the entries are ranked by cosine. The vocabulary holds the words of every entry, its initials, and its telling
words as a form of their own, where one entry alone has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.runtime import materialise

#: Least cosine of a match; by how much the best entry must be ahead of the second.
LEAST, AHEAD = 0.8, 0.01
#: Similarity of a token an edit away, for each edit, and of a shortened word. Edits allowed unless told otherwise; shortest token that is repaired by one.
EDITED, SHORTENED, EDITS, SHORTEST = 0.97, 0.95, 1, 4
#: Entries in which a generic word stands.
GENERIC = 3

# Words that say nothing about which firm is meant.
LEGAL_FORMS = "inc incorporated corp corporation co company ltd limited llc llp plc gmbh ag kg ab oy as asa sa sarl srl spa bv nv pty kk group holding holdings the".split()
ROLE_WORDS = "employee of working for at with co office team member".split()
DOMAIN_WORDS = "corp inc labs rd group hq net web".split()
# Letters without a decomposition into an ASCII letter and a mark.
FROM, TO = "øðđłıåäöüáàâãéèêëíìîïóòôõúùûñçšžýňřčćęąśź", "oddliaaouaaaaeeeeiiiioooouuuncszynrcceasz"


def fold(c: Column) -> Column:
    """Lower case ASCII where a letter has an ASCII base."""
    return F.translate(F.lower(c), FROM, TO)


def name_tokens(c: Column, cities: Column | None = None) -> Column:
    """The telling tokens of a firm's name, each once, in order: without brackets, legal forms, roles and the city of an office."""
    plain = F.regexp_replace(c, "\\([^)]*\\)", " ")
    plain = F.regexp_replace(plain, "(?i)\\bc/o\\b|\\b[Pp]ty\\.? [Ll]td\\b", " ")
    plain = F.regexp_replace(plain, "(?i)\\bgmbh\\b", " ")
    plain = F.regexp_replace(plain, "(\\p{Ll}{3})(?=\\p{Lu}\\p{Ll}{2})", "$1 ")
    plain = F.regexp_replace(plain, "(\\p{Ll}{3})(?:corp|inc|ltd)\\b", "$1")
    plain = F.regexp_replace(plain, "(?i)^.*\\boffice,", " ")
    plain = F.regexp_replace(plain, "(?i)\\b([a-z])\\.(?=[a-z]\\b)", "$1")  # initials with points make one token
    words = F.split(F.regexp_replace(fold(plain), "[^\\p{L}\\p{N}]+", " "), " ")
    noise = F.array(*[F.lit(w) for w in sorted({*LEGAL_FORMS, *ROLE_WORDS})])
    return F.array_distinct(F.filter(words, lambda w: (w != "") & ~F.array_contains(noise, w)))


def domain_tokens(c: Column) -> Column:
    """The tokens of the label that a domain is registered under, without a numbered suffix."""
    labels = F.split(fold(F.trim(c)), "\\.")
    label = F.when(F.size(labels) >= 2, F.try_element_at(labels, F.size(labels) - 1)).otherwise(labels[0])
    bare = F.regexp_replace(label, f"-({'|'.join(DOMAIN_WORDS)})?\\d+$", "")
    return F.array_distinct(F.filter(F.split(F.regexp_replace(bare, "\\d+$", ""), "[^\\p{L}\\p{N}]+"), lambda w: w != ""))


def _deletions(token: Column, edits: int) -> Column:
    """The token and what is left of it without any ``edits`` characters or fewer."""
    out = F.array(token)
    for _ in range(edits):
        shorter = F.transform(out, lambda t: F.transform(F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))), lambda i, t=t: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t)))))
        out = F.array_distinct(F.concat(out, F.flatten(shorter)))
    return out


def _sorted_letters(token: Column) -> Column:
    return F.array_join(F.array_sort(F.split(token, "")), "")


def repair(tokens: DataFrame, vocabulary: DataFrame, edits: int = EDITS, by: tuple[str, ...] = ()) -> DataFrame:
    """(token, word, sim): the vocabulary's words that a token stands for, itself included; up to ``edits`` edits or one swap away, or shortened.

    ``vocabulary`` has (word, generic). The columns of ``by`` stand in both tables and the result; only what agrees in them meets. Two tokens that near share what is left of them without as many characters, so the join on
    these misses none. Only generic words are shortened in use: to two or more of their letters in order, the first among
    them, or from a longer form with the same start. A word holds the token's letters in order if nothing but insertions is between them.
    """
    t = tokens.select(*by, "token").where("token <> ''").distinct()
    exact = t.join(vocabulary.select(*by, "word", F.col("word").alias("token")), [*by, "token"]).select(*by, "token", "word", F.lit(1.0).alias("sim"))
    left = t.where(F.length("token") >= SHORTEST - edits).select(*by, "token", F.explode(_deletions(F.col("token"), edits)).alias("_d"))
    right = vocabulary.where(F.length("word") >= SHORTEST).select(*by, "word", F.explode(_deletions(F.col("word"), edits)).alias("_d"))
    apart = F.levenshtein("token", "word")
    swapped = (F.length("token") == F.length("word")) & (_sorted_letters(F.col("token")) == _sorted_letters(F.col("word"))) & (apart == 2)
    near = left.join(right, [*by, "_d"]).select(*by, "token", "word").distinct()
    edited = near.where(apart.between(1, edits) | swapped).select(*by, "token", "word", F.pow(F.lit(EDITED), F.when(swapped, 1).otherwise(apart)).alias("sim"))
    generic = vocabulary.where("generic")
    ends = F.concat(F.substring("token", 1, 1), F.substring("token", -1, 1))
    keys = t.where(F.length("token") >= 2).select(*by, "token", ends.alias("_s"))
    letters = F.array_distinct(F.transform(F.filter(F.split(F.substring(F.col("word"), F.lit(2), F.length("word")), ""), lambda c: c != ""), lambda c: F.concat(F.substring("word", 1, 1), c)))
    fewer = keys.join(generic.select(*by, "word", F.explode(letters).alias("_s")), [*by, "_s"]).where(apart == F.length("word") - F.length("token"))
    stem = F.regexp_replace("word", "s$", "")
    stems = generic.select(*by, "word", stem.alias("_stem")).where(F.length("_stem") >= 3).withColumn("_s", F.substring("_stem", 1, 3))
    more = t.select(*by, "token", F.substring("token", 1, 3).alias("_s")).join(stems, [*by, "_s"]).where(F.col("token").startswith(F.col("_stem")))
    shortened = fewer.select(*by, "token", "word").union(more.select(*by, "token", "word")).select(*by, "token", "word", F.lit(SHORTENED).alias("sim"))
    return exact.union(edited).union(shortened).groupBy(*by, "token", "word").agg(F.max("sim").alias("sim"))


def entry_forms(entries: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, entry, form, word) from (by, entry, tokens): each entry's words, and where no entry has the same in any form, its initials and its telling words alone.

    Telling are the words that aren't generic. Initials need two tokens.
    """
    e = entries.select(*by, "entry", F.explode("tokens").alias("word")).distinct()
    df = e.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("_df"))
    telling = e.join(df, [*by, "word"]).groupBy(*by, "entry").agg(F.array_sort(F.collect_list(F.when(F.col("_df") < GENERIC, F.col("word")))).alias("words"), F.count(F.lit(1)).alias("_n"))  # of one entry
    telling = telling.where((F.size("words") > 0) & (F.size("words") < F.col("_n"))).select(*by, "entry", F.lit("telling").alias("form"), "words")
    letters = F.array_join(F.transform("tokens", lambda t: F.substring(t, 1, 1)), "")
    two = F.when(F.size("tokens") >= 2, F.struct(F.lit("initials").alias("form"), F.array(letters).alias("words")))
    plain = entries.select(*by, "entry", F.explode(F.array(F.struct(F.lit("whole").alias("form"), F.array_sort("tokens").alias("words")), two)).alias("_f")).where("_f is not null").select(*by, "entry", "_f.form", "_f.words")
    owners = plain.union(telling).groupBy(*by, "words").agg(F.countDistinct("entry").alias("_n"), F.min("entry").alias("entry"), F.collect_set("form").alias("_forms")).where("_n = 1")  # forms: three at most
    alone = owners.where(~F.array_contains("_forms", "whole")).select(*by, "entry", F.col("_forms")[0].alias("form"), F.explode("words"))
    return e.select(*by, "entry", F.lit("whole").alias("form"), "word").union(alone)


def match(values: DataFrame, entries: DataFrame, edits: int = EDITS, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, value, entry, score): the best entry of each value, null and 0 where none reaches LEAST or two come out within AHEAD.

    ``values`` (by, value, tokens) and ``entries`` (by, entry, tokens); the columns of ``by`` keep several reference lists apart.
    Weights are the entries' inverse document frequencies; a token that no word explains weighs as much as the rarest. A value
    without tokens has no entry. Repeated values come out once.

    Pairs are sought through a value's weightiest tokens alone: those without which the rest can't reach LEAST. A generic word
    therefore joins values and entries only where it carries the value.
    """
    forms = materialise(entry_forms(entries, by), "forms")
    sizes = forms.groupBy(*by).agg(F.countDistinct("entry").alias("n"))  # one row a list
    df = forms.groupBy(*by, "word").agg(F.countDistinct("entry").alias("df"))
    listed = df.join(sizes, list(by)) if by else df.withColumn("n", F.lit(sizes.first()["n"]))
    weight = F.log((1.0 + F.col("n")) / F.col("df"))
    vocabulary = materialise(listed.select(*by, "word", (F.col("df") >= GENERIC).alias("generic"), weight.alias("w"), F.log(1.0 + F.col("n")).alias("rarest")), "vocabulary")
    values = materialise(values.groupBy(*by, "value").agg(F.first("tokens").alias("tokens")), "values")
    v = values.select(*by, "value", F.explode("tokens").alias("token")).distinct()
    fixed = materialise(repair(v, vocabulary, edits, by).join(vocabulary.select(*by, "word", "w"), [*by, "word"]), "repaired")
    best = fixed.groupBy(*by, "token").agg(F.max_by("w", F.struct("sim", "w")).alias("tw"), F.count(F.lit(1)).alias("_m"))
    rarest = vocabulary.groupBy(*by).agg(F.max("rarest").alias("rarest"))
    known = v.join(best, [*by, "token"], "left")
    known = known.join(rarest, list(by), "left") if by else known.withColumn("rarest", F.lit(rarest.first()["rarest"]))
    # A token that stands for several words can count once for each: m is how often at most.
    of_value = Window.partitionBy(*by, "value")
    weighed = known.select(*by, "value", "token", F.coalesce("tw", "rarest").alias("tw"), F.coalesce("_m", F.lit(1)).alias("_m"))
    lighter = F.sum(F.col("_m") * F.col("tw") * F.col("tw")).over(of_value.orderBy("tw", F.col("token").desc()))  # of one value
    weighed = materialise(weighed.withColumn("vn", F.sqrt(F.sum(F.col("tw") * F.col("tw")).over(of_value))).withColumn("_weighty", F.sqrt(lighter) >= (LEAST - AHEAD) * F.col("vn")), "weighed")
    found = weighed.where("_weighty").join(fixed, [*by, "token"]).join(forms, [*by, "word"]).select(*by, "value", "entry", "form", "vn").distinct()
    fw = forms.join(vocabulary, [*by, "word"]).select(*by, "entry", "form", "word", "w")
    fw = fw.withColumn("en", F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*by, "entry", "form"))))  # of one entry
    said = weighed.join(fixed.select(*by, "token", "word", "sim"), [*by, "token"]).groupBy(*by, "value", "word").agg(F.max(F.col("sim") * F.col("tw")).alias("_s"))
    cosine = found.join(fw, [*by, "entry", "form"]).join(said, [*by, "value", "word"]).groupBy(*by, "value", "entry", "form", "vn", "en").agg(F.sum(F.col("_s") * F.col("w")).alias("p"))
    scored = cosine.groupBy(*by, "value", "entry").agg(F.max(F.col("p") / F.col("vn") / F.col("en")).alias("score"))
    order = of_value.orderBy(F.col("score").desc(), "entry")
    ranked = scored.withColumn("_r", F.row_number().over(order)).withColumn("_next", F.coalesce(F.lead("score").over(order), F.lit(0.0)))
    top = ranked.where(f"_r = 1 and score >= {LEAST} and score - _next >= {AHEAD}").select(*by, "value", "entry", "score")
    return values.select(*by, "value").join(top, [*by, "value"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def canonical_firms(firm_canonical: DataFrame, tokens: DataFrame, domain_map: DataFrame, firm_list: DataFrame) -> DataFrame:
    """(value_kind, raw_value, firm): each open firm_raw as stored and each unmapped person_domain, trimmed and lower-cased, with its firm or ''.

    Null raw values are left out; a blank firm_raw comes out unmatched. Firms are ranked by name for a firm_raw, by home domain
    for a person_domain; a firm without home domain has no domain to match.
    """
    firms = firm_list.where("firm is not null").select("firm", "home_domain")
    raw = firm_canonical.where("firm_raw is not null and (firm is null or trim(firm) = '')").select(F.col("firm_raw").alias("value")).distinct().withColumn("tokens", name_tokens(F.col("value")))
    by_name = firms.select(F.col("firm").alias("entry"), name_tokens(F.col("firm")).alias("tokens")).distinct()
    known = domain_map.where("domain is not null").select(F.lower(F.trim("domain")).alias("_d")).distinct()
    domains = tokens.select(F.lower(F.trim("person_domain")).alias("value")).where("value <> ''").distinct()
    domains = domains.join(known, domains["value"] == known["_d"], "left_anti").withColumn("tokens", domain_tokens(F.col("value")))
    by_home = firms.where("home_domain is not null").select(F.col("firm").alias("entry"), domain_tokens(F.col("home_domain")).alias("tokens")).distinct()
    kind = lambda df, name: df.withColumn("value_kind", F.lit(name))
    values = kind(raw, "firm_raw").unionByName(kind(domains, "person_domain"))
    entries = kind(by_name, "firm_raw").unionByName(kind(by_home, "person_domain"))
    return match(values, entries, by=("value_kind",)).select("value_kind", F.col("value").alias("raw_value"), F.coalesce("entry", F.lit("")).alias("firm"))
