import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnflow.llm import quality as Q
from cairnflow.llm import queries

COMMON = {"en": frozenset("the a of this my we you every would because under that our he she they".split()), "de": frozenset("der die das und wir".split())}
ALL = frozenset().union(*COMMON.values())
PROSE = "We carried the lamp under our bridge.\nWait.\nYou would mend this kettle\nbecause she sold every barrel!\nHe forgot the river."


def cues(lines):
    return "\n\n".join(f"{i}\n00:00:{i:02d},000 --> 00:00:{i:02d},500\n{line}" for i, line in enumerate(lines, 1))


JUNK = {
    "bullets": ["* cabin", "• bridge (3)", "• lamp", "* river"],
    "titles": ["1) Our Garden of the Station", "2) The Bridge", "03. Green Market", "4) This Lamp"],
    "table": ["R3\t8\t543\tlate", "R6\t9\t12\tdup", "R2\t12\t218\tok"],
    "pipes": ["| 0 | 01:06:04:11 | 5.18 |", "| 1 | 01:34:28:24 | 4.93 |"],
    "credits": ["Gaffer ..... Orrin Norby", "Casting — Lisk Benan", "ORRIN TORER", "MARO POWER"],
    "dictionary": ["barrel = the miller", "drawer = my boat"],
    "hex": ["a4 f2 00 a6 b5 0f", "24 ac 53 6e 14 92"],
    "code": ["VHq0Omix18z2rBaCvgT/YzomsUkWwrNMsYYMPuj0nI", "I6bn4ZPnsbWZmsZeJ0Ww4PSoVd/Q2LphfxYhpp"],
    "symbols": [">f}/=°]>l@<¬;<[", "`.{¬lj°[#@I|>", "----------"],
    "strokes": [".l l 'i 1i tl I1", "ji ti r1 '1 j1"],
    "adverts": ["Visit mint.example for more free subs", "*** some TEAM *** join us today!"],
    "words": ["Jacke, Leiter", "Tasche, Fluss, Feder"],
    "marks": ["[?]"] * 6,
    "music": ["♪ ♪ ♪"] * 5,
    "over and over": ["We carried the lamp.", "He forgot."] * 5,
}


def junk(text):
    s = dict(zip(["guess", *Q.STATS, *Q._COUNTS], Q.document_stats(text, ALL, COMMON)))
    return s["n_entries"] > s["n_prose"] or (s["repeat_share"] or 0) > 0.5


@pytest.mark.parametrize("name", sorted(JUNK))
def test_junk(name):
    assert junk("\n".join(JUNK[name]))
    assert junk(cues(JUNK[name]))


@pytest.mark.parametrize("text", [
    PROSE, PROSE.upper(), PROSE.lower().replace(".", "").replace("!", ""), cues(PROSE.split("\n")), cues(["ORRIN: " + line for line in PROSE.split("\n")]),
    "\n".join(f"{a}\n{a}" for a in PROSE.split("\n")), PROSE.replace("e", "é").encode().decode("latin-1") + "\nThe lamp of the river", "", "\n", PROSE + "\n* cabin\n[laughs]",
])
def test_prose(text):
    assert not junk(text)


def test_language_guess():
    assert Q.document_stats(PROSE, ALL, COMMON)[0] == "en"
    assert Q.document_stats("wir und der die das wir", ALL, COMMON)[0] == "de"
    assert Q.document_stats("wir the", ALL, COMMON)[0] is None


def test_statistics_and_tails(spark):
    words = spark.createDataFrame([(k, w) for k, ws in COMMON.items() for w in ws] + [(None, "x"), ("en", None)], "lang string, word string")
    rows = [(i, "ENG", PROSE + f"\nThe lamp {i}.", "c") for i in range(40)] + [(100, "und", "\n".join(JUNK["hex"]), "c"), (101, "en", None, "c"), (102, None, "", "c"), (103, "xx", "\n".join(JUNK["bullets"]), "c"), (None, "en", PROSE, "c")]
    docs = spark.createDataFrame(rows + rows[:3] + rows[40:41], "doc_id bigint, lang string, text string, language string")
    stats = Q.statistics(docs, words)
    assert stats.count() == 44 and stats.where("language = 'en'").count() == 41
    assert sorted(r.doc_id for r in Q.not_prose(stats).collect()) == [100, 103]
    scored = {r.doc_id: r for r in Q.scored(stats).collect()}
    assert len(scored) == 44 and scored[101].pct_entry_share is None and scored[100].z_entry_share > 1 and scored[100].pct_entry_share > 0.9
    assert Q.not_prose(Q.statistics(docs.limit(0), words)).count() == 0


def test_sketches_merge(spark):
    """Sketches of parts, merged, hold the quantiles of the whole to their accuracy."""
    df = spark.range(20_000).selectExpr("'en' AS language", *[f"cast(pmod(id * 7919, 10007) AS double) AS {s}" for s in Q.STATS])
    for parts in (1, 16):
        q = {r.language: r for r in Q.sketches(df.repartition(parts)).collect()}
        assert q["en"].q_n_words[20] == pytest.approx(5003, abs=30) and q["*"].mad_n_words == pytest.approx(2502, abs=30)


def test_majority_junk_language_is_scored_against_all(spark, small):
    found = queries.p9_found(spark, small)
    assert found.count() == found.distinct().count() > 0


@pytest.mark.parametrize("unit", ["#", "# ", "[", "(a", "-", "subtitle ", "*** ", "♪x", "Ã", "a'", "1", "|", ". ", "— ", "<i", "{\\", "\n", "x\n", "{1}{2}"])
def test_very_long_odd_texts_take_linear_time(unit):
    """A text of a megabyte without line ends, or of nothing else, is measured and read in moments."""
    import time

    from cairnflow.llm import leakage
    from cairnflow.llm.subtitles import reread

    text = unit * (1_000_000 // len(unit)) + "x"
    items = [(1, [f"word{c}" for c in "abcdefghijklmn"])]
    vocabulary, other, weights = leakage.prepared(items, frozenset())
    index = leakage.Index(items, leakage.Lexicon(vocabulary, other), weights)
    began = time.process_time()
    Q.document_stats(text, ALL, COMMON)
    index.leaks([np.array(leakage.spoken(reread(text), index.lexicon), np.int64)])
    assert time.process_time() - began < 10


def documents(spark, texts, lang="en"):
    words = spark.createDataFrame([(k, w) for k, ws in COMMON.items() for w in ws], "lang string, word string")
    return Q.statistics(spark.createDataFrame([(i, lang, t) for i, t in enumerate(texts)], "doc_id bigint, lang string, text string"), words)


def test_junk_is_found_whatever_the_rest_is(spark):
    """Tables of junk alone, of one document, and of mostly junk: the usual is held within what prose can have."""
    junk_texts = ["\n".join(lines) for lines in JUNK.values()]
    want = set(range(len(junk_texts)))
    assert {r.doc_id for r in Q.not_prose(documents(spark, junk_texts)).collect()} == want
    assert {r.doc_id for r in Q.not_prose(documents(spark, junk_texts + [PROSE] * 3)).collect()} == want
    assert [r.doc_id for r in Q.not_prose(documents(spark, junk_texts[:1])).collect()] == [0]
    assert Q.not_prose(documents(spark, [PROSE])).count() == 0


def test_the_tails_alone_decide(spark):
    stats = documents(spark, [PROSE] * 30 + ["\n".join(lines) for lines in JUNK.values()])
    scores = Q.scored(stats, [*Q.PROSE])
    found = {r.doc_id: set(r.tails) for r in Q.in_tails(scores).collect()}
    assert set(found) == set(range(30, 30 + len(JUNK)))
    assert Q.in_tails(scores, Q.TAILS[1:2]).count() < len(JUNK) and {"entries", "repeats", "signs", "numbers"} == set().union(*found.values())
    # Without a tail's limit everything is found, beyond every value nothing.
    assert Q.in_tails(scores, (("all", (("entry_share", 1e-9),)), ("none", (("entry_share", -1e9),)))).count() == sum(r.entry_share > 0 for r in scores.collect() if r.entry_share is not None)
    assert Q.in_tails(scores, (("far", (("entry_share", 1e9),)),)).count() == 0


def test_the_language_s_sketch_moves_the_tail(spark):
    """Half entries are far out where a language has none, and less far where every document has some."""
    fields = {s: 0.0 for s in Q.STATS} | {"common_share": 0.4}

    def scores(usual):
        rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("en").alias("language"), *[F.lit(v).alias(s) for s, v in fields.items() if s != "entry_share"], F.when(F.col("id") == 0, 0.5).otherwise((F.col("id") % 3) * usual).alias("entry_share"))
        return Q.scored(rows, [*Q.PROSE])

    clean, mixed = (scores(u).where("doc_id = 0").first() for u in (0.0, 0.1))
    assert clean.z_entry_share > 6 > mixed.z_entry_share
    assert Q.in_tails(scores(0.0)).count() == 1 and Q.in_tails(scores(0.1)).count() == 0


def test_percentiles_are_ranks(spark):
    rows = spark.range(1001).select(F.col("id").alias("doc_id"), F.lit("en").alias("language"), *[(F.col("id") / 1000).alias(s) for s in Q.STATS])
    got = {r.doc_id: r.pct_symbol_ratio for r in Q.scored(rows).collect()}
    assert all(abs(got[i] - i / 1000) < 0.03 for i in range(1001))


def test_long_words_are_words():
    kinds = [Q.line_kind(line, ALL) for line in ("der Donaudampfschifffahrtsgesellschaftskapitän und wir", "we saw the " + "x" * 300, "Rindfleischetikettierungsüberwachungsaufgabe!")]
    assert kinds == [1, 1, 1]
    assert Q.line_kind("[" + "a long sound " * 60 + "]", ALL) is None
