import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from cairnflow.llm import leakage as L
from cairnflow.llm import queries
from cairnflow.llm.subtitles import cues, reread

ITEM = "The patient sailor carried every wooden barrel behind our quiet harbour while nobody remembered the broken lantern near that rusty bridge."
OTHER = "Her golden cousin washed another strange mirror under my narrow garden because someone should mend this hollow kettle before the winter evening."
ITEMS = [(1, ITEM), (2, OTHER)]


def index_of(items, other=frozenset()):
    own = [(i, ws) for i, text in items if len(ws := L.item_words(text)) >= L.LEAST]
    vocabulary, other, weights = L.prepared(own, other)
    return L.Index(own, L.Lexicon(vocabulary, other), weights)


def leaks(text, items=ITEMS):
    index = index_of(items)
    found = index.leaks([np.array(L.spoken(reread(text), index.lexicon), np.int64)])
    return [int(index.item_ids[n]) for _, n in found]


def words(n, start=0, text=ITEM):
    return " ".join(text.split()[start : start + n])


def test_length_and_order():
    assert leaks(words(12)) == [1] and leaks("x y " + words(12, 5) + " z") == [1]
    assert leaks(words(11)) == [] and leaks(words(11) + " unrelated " + words(5, 15)) == []
    shuffled = ITEM.split()
    random.Random(1).shuffle(shuffled)
    assert leaks(" ".join(shuffled)) == []
    assert leaks(ITEM + " " + OTHER) == [1, 2]
    assert leaks(" ".join(reversed(ITEM.split()))) == []


def test_a_replaced_word_does_not_hide_the_words_after_it():
    long = (7, " ".join(f"{a}{b}" for a in ("morning", "kettle", "garden", "window", "thunder") for b in ("ful", "less", "ward", "smith", "berry", "stone")))
    w = long[1].split()
    for k in range(6, 12):
        assert leaks(" ".join([*w[:k], "xylophone", *w[k + 1 :]]), [long]) == [7]
    assert leaks(" ".join([*w[:9], "xylophone", *w[10:18], "zebra", *w[19:]]), [long]) == []
    assert leaks(" ".join([*w[:7], "xylophone", *w[8:15], "zebra", *w[16:28]]), [long]) == [7]


def test_unread_short_words_leave_the_passage_found():
    """Each misreading is near two words of the items and so stays unmapped."""
    w = "sailor carried wooden barrel brown in harbour nobody remembered it lantern rusty".split()
    items = [(1, " ".join(w)), (2, "an on if is of us at am we he me my no so do go")]
    assert leaks(" ".join([*w[:5], "xn", *w[6:9], "xt", *w[10:]]), items) == [1]
    w[2] = "us"
    items = [(1, " ".join(w)), items[1]]
    assert leaks(" ".join([*w[:2], "xs", *w[3:5], "xn", *w[6:9], "xt", *w[10:]]), items) == [1]
    assert leaks(" ".join([*w[:5], "xn", *w[6:9], "zebra", *w[10:]]), items) == []


def test_what_subtitles_add_is_no_interruption():
    w = words(14).split()
    srt = f"1\n00:00:01,000 --> 00:00:02,000\n<i>- {' '.join(w[:4])}</i>\n\n2\n00:00:03,000 --> 00:00:04,000\n[door creaks]\n\n3\n00:00:05,000 --> 00:00:06,000\nRip by someone, please rate this subtitle\n\n4\n00:00:07,000 --> 00:00:08,000\nORRIN: {' '.join(w[4:9]).upper()},\n{w[9][:3]}-\n{w[9][3:]} {' '.join(w[10:])}"
    assert leaks(srt) == [1]
    micro = "{1}{20}" + " ".join(w[:5]) + "|" + " ".join(w[5:9]) + "\n{21}{40}(laughs)\n{41}{60}" + " ".join(w[9:])
    assert leaks(micro) == [1]


def test_rolling_lines_are_said_once():
    w = words(14).split()
    chunks = [" ".join(w[i : i + 3]) for i in range(0, 14, 3)]
    cue = lambda i, *ls: f"{i}\n00:00:0{i},000 --> 00:00:0{i},900\n" + "\n".join(ls) + "\n\n"
    assert leaks(cue(1, chunks[0]) + "".join(cue(i + 1, a, b) for i, (a, b) in enumerate(zip(chunks, chunks[1:]), 1))) == [1]
    assert leaks("\n".join([chunks[0], *(f"{a} {b}" for a, b in zip(chunks, chunks[1:])), chunks[-1]])) == [1]


def test_misread_and_wrongly_encoded_words():
    bad = words(12).replace("patient", "pafient").replace("wooden", "w0oden").replace("harbour", "liarbour").replace("barrel", "barreI")
    assert leaks(bad) == [1]
    item = (3, "Él vendía nuestro pequeño jardín detrás de una montaña después mientras nadie podía recordar el último otoño.")
    double = item[1].encode().decode("latin-1")
    assert leaks(double, [item]) == [3]
    assert leaks(item[1].encode("cp1252").decode("cp1251"), [item]) == [3]
    assert leaks("".join(c if c.isascii() else "�" for c in item[1]), [item]) == [3]


def test_fingerprints_within_the_radius_are_all_found():
    index = index_of(ITEMS)
    rng = np.random.default_rng(5)
    base = rng.integers(0, len(index.prints), 400)
    flips = np.zeros(400, np.uint64)
    for _ in range(L.RADIUS):
        flips |= np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)
    at, of = index.candidates(index.prints[base] ^ flips)
    assert set(zip(range(400), base.tolist())) <= set(zip(at.tolist(), of.tolist()))


def test_against_every_window(spark, small):
    """All passages that a search without fingerprints, from every shared pair of words, would find."""
    docs = {r.doc_id: r.text for r in queries.table(spark, small, "documents").where("text IS NOT NULL").select("doc_id", "text").collect()}
    items = [tuple(r) for r in queries.table(spark, small, "eval_items").select("item_id", "text").collect()]
    common = frozenset(r[0] for r in queries.table(spark, small, "common_words").select("word").collect())
    index = index_of(items, common)
    starts = {}
    for n, ids in enumerate(index.items):
        for p in range(len(ids) - 1):
            starts.setdefault((ids[p], ids[p + 1]), []).append((n, p))
    want = set()
    for doc_id, text in docs.items():
        s = L.spoken(reread(text), index.lexicon)
        own = np.array(s, np.int64)
        for j in range(len(s) - 1):
            for n, p in starts.get((s[j], s[j + 1]), ()):
                begin, end = index.aligned(index.items[n], own, p, j)
                if end - begin >= L.LEAST:
                    want.add((int(index.item_ids[n]), doc_id))
    got = [tuple(r) for r in queries.p8_found(spark, small).collect()]
    assert len(got) == len(set(got))
    assert set(got) == want and want


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, ITEM, 0), (3, ITEM, 1), (None, ITEM, 0), (4, ITEM + " \0 " + "x" * 50_000, 0)], "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame([(1, ITEM), (1, ITEM), (2, None), (3, "too short"), (None, OTHER)], "item_id bigint, text string")
    want = [(1, 3), (1, 4)]
    assert sorted(map(tuple, L.leaked(docs, items).collect())) == want
    assert L.leaked(docs.limit(0), items).collect() == [] == L.leaked(docs, items.limit(0)).collect()
    both = items.unionByName(spark.createDataFrame([(9, OTHER)], "item_id bigint, text string"))
    assert sorted(map(tuple, L.leaked(docs, both, block_words=25).collect())) == want


def test_the_similarity_rejects():
    """Eleven words share seven of a window's eight shingles, a replaced word in the middle three; a candidate they are."""
    index = index_of(ITEMS)
    n, item = 0, index.items[0]
    for words_, begin, end, shared in ((item[:11], 0, 11, 7), (np.r_[item[:6], -7, item[7:12]], 0, 6, 2)):
        assert index.aligned(item, words_, 0, 0) == (begin, end)
        weight = index.shingles[n][:8]
        assert index.similarity(n, 0, begin, end) == pytest.approx(weight[:shared].sum() / weight.sum()) and index.similarity(n, 0, begin, end) < L.LIMIT
        assert index.leaks([words_]) == []
    at, of = index.candidates(index.fingerprints(item[None, :9]))
    assert (index.owner[of] == 0).any()
    assert index.leaks([item[:12]]) == [(0, 0)]


def test_every_choice_of_unread_words_is_found():
    index = index_of(ITEMS)
    item = index.items[0]
    for gone in itertools.combinations(range(4, 16), L.UNREAD):
        stream = item[4:16].copy()
        for k, g in enumerate(gone):
            index.lexicon.letters[-1 - k] = index.lexicon.words[item[g]][:-1] + "�"
            stream[g - 4] = -1 - k
        assert index.leaks([stream]) == [(0, 0)], gone


def test_blocks_and_kept_tokens_change_nothing(spark, monkeypatch, small):
    """Which items share an index, and how many tokens' meanings a task keeps, make no difference."""
    docs, items, common = (queries.table(spark, small, n) for n in ("documents", "eval_items", "common_words"))
    want = sorted(map(tuple, L.leaked(docs, items, common).collect()))
    assert want == sorted(map(tuple, L.leaked(docs, items, common, block_words=900).collect()))
    vocabulary = [(1, ITEM.replace("wooden", "house") + " and more words to fill"), (2, OTHER.replace("golden", "hause"))]
    index = index_of(vocabulary)
    assert index.lexicon.id("h0use") < 0 and index.lexicon.same(index.lexicon.ids["house"], index.lexicon.id("h0use"))
    texts = [(i, r.text) for i, r in enumerate(docs.where("text IS NOT NULL").limit(40).collect())]
    own = [(r.item_id, L.item_words(r.text)) for r in items.collect()]
    words_, other, weights = L.prepared(own, frozenset())
    found = []
    for most, group in ((0, 1), (10**9, 10**9)):
        monkeypatch.setattr(L, "_KNOWN_TOKENS", most)
        lexicon = L.Lexicon(words_, other)
        index = L.Index(own, lexicon, weights)
        batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in texts], "text": [t for _, t in texts]})
        found.append(sorted((int(index.item_ids[n]), ids[s]) for ids, streams in L._parsed(iter([batch]), lexicon, group) for s, n in index.leaks(streams)))
    assert found[0] == found[1]


def test_too_many_common_words_are_refused(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_COMMON", 3)
    docs, items = spark.createDataFrame([(1, "x")], "doc_id bigint, text string"), spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    with pytest.raises(ValueError):
        L.leaked(docs, items, spark.createDataFrame([(w,) for w in "abcd"], "word string"))


def test_long_words_tags_and_sounds():
    long = "donaudampfschifffahrtsgesellschaftskapitaen"
    item = (5, ITEM.replace("wooden", long))
    assert leaks(words(12, 0, item[1]).replace(long, long.replace("ge", "qe")), [item]) == [5]
    w = words(12).split()
    assert leaks(" ".join(w[:6]) + " <font color=" + "x" * 90 + "> [" + "door creaks " * 40 + "] " + " ".join(w[6:])) == [1]
    assert leaks(" ".join(w[:6]) + "\nVisit some-place.org/" + "y" * 300 + "\n" + " ".join(w[6:])) == [1]
    assert L.stripped("¿¡" + "-" * 100_000 + "x" + "." * 100_000) == "x" and L.stripped("...") == "" == L.stripped("")


@pytest.mark.parametrize("text", ["", "\n\n", "-->", "1\n2\n3", "{}{}", "WEBVTT", "{1}{2}|||"])
def test_cues_of_odd_files(text):
    assert all(line for cue in cues(text) for line in cue)
