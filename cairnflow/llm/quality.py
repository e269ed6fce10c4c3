"""Per-document text statistics, their quantile sketches per language, and the documents in the tails.

Statistics are shares and means over the lines and words of what a document says. For each language mergeable quantile
sketches (Greenwald-Khanna, as the engine's approximate percentiles keep them) are built map-side and merged; they turn
values into percentiles and robust z-scores. A document is no natural prose where a statistic that tells it apart, or
several together, lie that far in the tail of its language (``TAILS``); nothing else decides.

A language most of whose documents are junk must not make junk usual. The sketch's median and median absolute deviation
of a statistic are therefore held within what natural prose can have (``PROSE``); within that range they move the tail.

Defined results: a null or blank text, or one without lines, has null shares and is never found; repeated rows of a
document are one document; a language is the declared one in its short form, told from common words where there are
enough of them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnflow.llm.subtitles import advertises, cues, may_advertise, reread, unlabelled, untagged
from cairnflow.session import materialise

#: Other names of languages.
LANGUAGES = {"eng": "en", "en": "en", "fre": "fr", "fra": "fr", "fr": "fr", "ger": "de", "deu": "de", "de": "de", "spa": "es", "es": "es"}
STATS = ["n_words", "mean_word_len", "symbol_ratio", "digit_ratio", "punct_end_share", "common_share", "entry_share", "repeat_share"]
_WORD = re.compile(r"[^\W\d_]+(?:[’'][^\W\d_]+)*")
_ENTRY = re.compile(r"\(?\d{1,4}\s?[.):]\s|[•*·▪◦●]\s|\S+ —")
_NEUTRAL = re.compile(r"(?:[\[(][^\[(\])]*[\])]|[♪♫#\s])+")
#: What divides columns: tabs, signs other than dashes, notes and those of sentences standing alone, leaders and rules of one sign.
_COLUMNS = re.compile(r"\t|\s[^\w\s.?!,:…\-–—\"'’“”«»¿¡♪♫#&�]{1,3}\s|([^\w\s?!�])\1{3}")
#: What no language has: a long run with digits, signs or capitals within.
_RUN = re.compile(r"[A-Za-z0-9+/=]{25,}")
_CODED = re.compile(r"[0-9+/=]|[a-z][A-Z]")
_END = ".!?…–”\"»“�"


def line_kind(line: str, common: frozenset[str], adverts: bool = True) -> int | None:
    """1: prose or dialogue, 0: entry of a list, row of a table or junk, None: can't tell by itself."""
    s = untagged(line)
    if not s or (s[0] in "[(♪♫#" and _NEUTRAL.fullmatch(s)):
        return None
    if adverts and advertises(s) or _ENTRY.match(s) or _COLUMNS.search(s) or s.count("|") > 1 or s.count(";") > 2:
        return 0
    if len(s) >= 25 and any(_CODED.search(run) for run in _RUN.findall(s)):
        return 0
    if ":" in s:
        s = unlabelled(s)
    n = len(s) - s.count(" ") - s.count("’") - s.count("'")
    if n <= 0:
        return None
    words = _WORD.findall(s.lower())
    m = len(words)
    letters = sum(map(len, words)) - s.count("’") - s.count("'")
    digits = 0 if letters >= n else sum(map(str.isdigit, s))
    if not m and n <= 2 and not digits:
        return None
    if digits > 0.25 * n or n - letters - digits > 0.35 * n or not m:
        return 0
    if m >= 3 and letters < 4 * m and sum(len(w) == 1 for w in words) > 0.5 * m:
        return 0
    hits = not common.isdisjoint(words)
    if hits and m >= 3:
        return 1
    if s[-1] in _END:
        return 1
    if "," in s and not hits and m >= 2:
        return 0
    if m >= 3 and not hits:
        return 0
    if m == 2 and not hits and all(w[0].isupper() for w in s.split() if w[0].isalpha()):
        return 0
    return None


def document_stats(text: str, common: frozenset[str], by_lang: dict[str, frozenset[str]]) -> tuple:
    """language guess (or None), then STATS, then the numbers of prose, entry and unclear lines and of repeated ones."""
    text = reread(text)
    lines = [line for cue in cues(text) for line in cue]
    if not lines:
        return (None, 0, *[None] * (len(STATS) - 1), 0, 0, 0, 0)
    adverts = may_advertise(text)
    kinds = Counter(line_kind(line, common, adverts) for line in lines)
    said = " ".join(lines)
    words = _WORD.findall(said.lower())
    solid = said.replace(" ", "")
    letters, digits = sum(map(len, words)), sum(map(str.isdigit, solid))
    counted = Counter(words)
    hits = {lang: sum(n for w, n in counted.items() if w in own) for lang, own in by_lang.items()}
    known = sum(n for w, n in counted.items() if w in common)
    best = max(hits, key=lambda k: (hits[k], k)) if hits else None
    guess = best if best and hits[best] >= 5 and hits[best] > 1.5 * max([v for k, v in hits.items() if k != best], default=0) else None
    # What a line says twice it says once.
    often = Counter(" ".join(dict.fromkeys(line.lower().split())) for line in lines)
    repeated = sum(n for _, n in often.most_common(2) if n >= 4)
    judged = kinds[0] + kinds[1]
    n_words = len(words)
    return (
        guess, n_words, sum(map(len, words)) / n_words if n_words else None, (len(solid) - letters - digits) / len(solid), digits / len(solid),
        sum(line[-1] in _END for line in lines) / len(lines), known / n_words if n_words else None, kinds[0] / judged if judged else None, repeated / len(lines),
        kinds[1], kinds[0], kinds[None], repeated,
    )


_COUNTS = ["n_prose", "n_entries", "n_unclear", "n_repeated"]
_FIELDS = [("doc_id", pa.int64()), ("declared", pa.string()), ("guess", pa.string()), ("n_words", pa.int64()), *[(s, pa.float64()) for s in STATS[1:]], *[(c, pa.int64()) for c in _COUNTS]]


def _measure(by_lang: dict[str, frozenset[str]]):
    common = frozenset().union(*by_lang.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, lang, *document_stats(text or "", common, by_lang)) for i, lang, text in zip(*(c.to_pylist() for c in batch.columns))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _FIELDS)], names=[n for n, _ in _FIELDS])

    return run


def statistics(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """doc_id, language, STATS and line counts of each document. common_words: lang, word; some hundreds of rows."""
    listed = common_words.where("lang IS NOT NULL AND word IS NOT NULL").select(F.lower("lang"), F.lower("word")).distinct().limit(100_001).collect()
    if len(listed) > 100_000:
        raise ValueError("at most 100,000 common words")
    by_lang = {lang: frozenset(w for k, w in listed if k == lang) for lang in {r[0] for r in listed}}
    schema = ", ".join(["doc_id bigint, declared string, guess string, n_words bigint", *[f"{s} double" for s in STATS[1:]], *[f"{c} bigint" for c in _COUNTS]])
    rows = documents.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").alias("declared"), "text").mapInArrow(_measure(by_lang), schema)
    names = F.create_map(*[F.lit(x) for pair in LANGUAGES.items() for x in pair])
    declared = F.lower(F.trim("declared"))
    rows = materialise(rows.withColumn("language", F.coalesce("guess", names[declared], F.lit("und"))).drop("declared", "guess"), "doc-stats")
    first = [F.max_by(F.struct("language", *STATS, *_COUNTS), F.struct("n_words", "n_prose", "n_entries")).alias("s")]
    return rows.groupBy("doc_id").agg(*first).select("doc_id", "s.*")


GRID = [i / 40 for i in range(41)]

#: What natural prose can have in a statistic: ranges of its median and of its median absolute deviation among the
#: documents of a language. A share can't be told more finely than a line in twenty.
PROSE = {
    "entry_share": ((0.0, 0.05), (0.05, 0.055)),
    "repeat_share": ((0.0, 0.05), (0.05, 0.055)),
    "common_share": ((0.3, 0.6), (0.02, 0.06)),
    "symbol_ratio": ((0.0, 0.08), (0.01, 0.03)),
    "digit_ratio": ((0.0, 0.03), (0.01, 0.02)),
}
#: Tails and how far, in robust deviations, each of their statistics must lie out. The first two stand alone; words that
#: are hardly ever common ones are telling only together with signs or digits.
TAILS = (
    ("entries", (("entry_share", 6.0),)),
    ("repeats", (("repeat_share", 6.0),)),
    ("signs", (("common_share", -6.0), ("symbol_ratio", 6.0))),
    ("numbers", (("common_share", -6.0), ("digit_ratio", 6.0))),
)


#: Stands for all languages together; it also scores documents of no known language and of rare ones.
POOLED = "*"
LEAST_DOCUMENTS = 200


def sketches(stats: DataFrame, names: list[str] = STATS) -> DataFrame:
    """language and, per statistic, its values at the grid's ranks (q_*) and its median absolute deviation (mad_*).

    The row of language ``*`` holds the merged sketch of all documents.
    """
    both = stats.select(F.explode(F.array("language", F.lit(POOLED))).alias("language"), *[F.col(s).cast("double").alias(s) for s in names])
    q = both.groupBy("language").agg(F.count("*").alias("n_documents"), *[F.percentile_approx(s, GRID, 2_000).alias(f"q_{s}") for s in names])
    away = both.join(q, "language")
    mad = away.groupBy("language").agg(*[F.percentile_approx(F.abs(F.col(s) - F.col(f"q_{s}")[20]), 0.5, 2_000).alias(f"mad_{s}") for s in names])
    return q.join(mad, "language")


def _per_group(found: DataFrame) -> DataFrame:
    """For a join: a language is one of the common words' or of LANGUAGES or "und", so these are a few rows."""
    return F.broadcast(found.withColumnRenamed("language", "sketch_of"))


def _rank(value, grid: str):
    """Mid-rank of a value on a sketch's grid, 0 to 1."""
    below, upto = F.size(F.filter(grid, lambda x: x < value)), F.size(F.filter(grid, lambda x: x <= value))
    return (below + upto) / (2 * len(GRID))


def _against(rows: DataFrame, names: list[str]) -> DataFrame:
    for s in names:
        value = F.col(s).cast("double")
        middle, away = F.col(f"q_{s}")[20], F.col(f"mad_{s}")
        if s in PROSE:
            (low, high), (least, most) = PROSE[s]
            middle, away = F.greatest(F.least(middle, F.lit(high)), F.lit(low)), F.greatest(F.least(away, F.lit(most)), F.lit(least))
        rows = rows.withColumn(f"pct_{s}", F.when(value.isNotNull(), _rank(value, f"q_{s}")))
        rows = rows.withColumn(f"z_{s}", F.when(value.isNotNull(), (value - middle) / (F.greatest(away, F.lit(1e-3)) * 1.4826)))
    return rows.drop("n_documents", *[f"q_{s}" for s in names], *[f"mad_{s}" for s in names])


def scored(stats: DataFrame, names: list[str] = STATS) -> DataFrame:
    """The statistics with pct_* (mid-rank among the documents of the language) and z_* (robust z-score) of each."""
    found = materialise(sketches(stats, names), "doc-sketches")
    own = found.where((F.col("n_documents") >= LEAST_DOCUMENTS) & ~F.col("language").isin(POOLED, "und"))
    ranked = [r[0] for r in own.select("language").collect()]
    group = F.when(F.col("language").isin(*ranked), F.col("language")).otherwise(F.lit(POOLED))
    wide = stats.withColumn("sketch_of", group).join(_per_group(found), "sketch_of")
    return _against(wide, names).select(*stats.columns, *[f"{k}_{s}" for s in names for k in ("pct", "z")])


def in_tails(scores: DataFrame, tails: tuple = TAILS) -> DataFrame:
    """The documents that all statistics of one of the tails put into it, with the names of those tails."""
    tests = []
    for name, parts in tails:
        far = [F.col(f"z_{s}") >= z if z > 0 else F.col(f"z_{s}") <= z for s, z in parts]
        tests.append(F.when(reduce(and_, far), F.lit(name)))
    return scores.withColumn("tails", F.array_compact(F.array(*tests))).where(F.size("tails") > 0)


def not_prose(stats: DataFrame) -> DataFrame:
    """Documents that lie in a tail of their language, or, where that has few documents or is unknown, of all documents."""
    return in_tails(scored(stats, [*PROSE]))
