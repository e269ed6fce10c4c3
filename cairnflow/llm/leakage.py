"""Evaluation passages that occur in documents, as spoken.

Both sides become streams of words. What a subtitle file adds to speech (numbers, times, markup, speaker labels, sound
descriptions, adverts, lines shown twice, words broken at line ends) is taken out, and words that were misread or
wrongly encoded are mapped to the evaluation word they stand for.

The unit that leaks is the smallest passage that counts, ``LEAST`` words of an item. Each such window of an item is
fingerprinted by SimHash, as a whole and with every choice of up to ``UNREAD`` of its words left out: whatever choice of
words stayed unreadable in a document, the words it does show are ``SHOWN`` successive ones with a fingerprint of the
item. Fingerprints are looked up in a multi-index over four blocks of 16 bits: two within ``RADIUS`` = 3 bits agree in at
least one block, so every such pair is found. A candidate is verified by weighted-shingle similarity: the item's window
and the stretch of the document are aligned word by word, shingles of ``SHINGLE`` successive words weigh what their
words weigh (rare ones more), and the weight both sides share must reach ``LIMIT`` of the window's. A passage one word
too short shares all shingles but one, so the limit is the whole.

Defined results: null texts match nothing; items shorter than the smallest passage match nothing; repeated rows give
one pair. The vocabulary is that of all items together, so results don't depend on ``block_words``, the words of items
that one index holds; beyond one index the documents are parsed once and their streams written.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations
from operator import ne

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnflow.llm.subtitles import advertises, cues, may_advertise, reread, unlabelled, untagged, without_sounds
from cairnflow.session import materialise

LEAST, UNREAD, RADIUS, BLOCK_BITS = 12, 3, 3, 16
SHOWN = LEAST - UNREAD
SHINGLE, LIMIT = 5, 1.0
#: Words of items in one index (about 7 KB each) and of common words.
BLOCK_WORDS, MAX_COMMON = 10_000, 100_000
_BITS = 64
_TOKEN = re.compile(r"[^ \t\r\n\f\v]+")
_INNER = re.compile(r"[\w�]")
_SPOKEN = re.compile(r"[^\W_]")
#: Letters and groups that character recognition takes for one another, each with the class it folds to.
_GROUPS = (("rn", "m"), ("vv", "w"), ("li", "h"), ("ii", "u"), ("cl", "d"), ("fi", "h"))
_FOLD = str.maketrans({"0": "o", "c": "e", "o": "e", "a": "e", "e": "e", "1": "l", "i": "l", "j": "l", "|": "l", "!": "l", "t": "l", "f": "l", "l": "l", "5": "s", "8": "b", "6": "b", "h": "b", "b": "b", "9": "g", "q": "g", "g": "g", "u": "n", "n": "n", "v": "y", "y": "y"})
_ACCENTS = str.maketrans("àáâãäåèéêëìíîïòóôõöùúûüçñýÿ", "aaaaaaeeeeiiiiooooouuuucnyy")
#: Encodings a Western text may have been read as.
_ENCODINGS = ("cp1251", "cp1250", "iso8859-2", "cp1254", "iso8859-5", "koi8-r", "cp437", "cp850", "mac-roman", "cp1253", "iso8859-7")


def stripped(word: str) -> str:
    """Without the signs at its ends, in linear time however long it is."""
    first = _INNER.search(word)
    if first is None:
        return ""
    return word[first.start() : len(word) - _INNER.search(word[::-1]).start()]


def spell(token: str) -> str:
    """A token as a word: encoding mended, lower case, without punctuation at its ends."""
    return stripped(reread(token).lower())


def skeleton(word: str) -> str:
    for a, b in _GROUPS:
        word = word.replace(a, b)
    return word.translate(_ACCENTS).translate(_FOLD)


def close(a: str, b: str) -> bool:
    """Within one edit for short words, two for longer ones; a replacement character stands for any."""
    if abs(len(a) - len(b)) > 2 or min(len(a), len(b)) < 2:
        return len(a) == len(b) == 1 and "�" in (a, b)
    most = 1 if max(len(a), len(b)) < 8 else 2
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y and x != "�" and y != "�"))
    return row[-1] <= most


def _letters(word: str) -> int:
    """The set of letters of a word, as bits; an edit changes at most two of them."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) & 63)
    return bits


class Lexicon:
    """Word ids: evaluation words have their own, any other word a negative one that depends on its letters.

    letters keeps the spelling of the other words met since the last forget(), which must not be called while streams
    that hold them are in use.
    """

    def __init__(self, words: list[str], other: frozenset[str]) -> None:
        self.words = words
        self.ids = {w: i for i, w in enumerate(words)}
        self.other = other
        self.by_skeleton: dict[str, int] = {}
        for w, i in self.ids.items():
            self.by_skeleton[k] = -1 if (k := skeleton(w)) in self.by_skeleton else i
        self.by_shape: dict[tuple, list[tuple[int, str]]] = defaultdict(list)
        for w in words:
            self.by_shape[len(w), w[:1]].append((_letters(w), w))
            self.by_shape[len(w), "", w[-1:]].append((_letters(w), w))
        #: A reading is at most two letters longer than its word, or twice as long where single letters were read as two.
        self.longest = 2 * max(map(len, words), default=0) + 2
        self.cache: dict[str, int] = {}
        self.letters: dict[int, str] = {}

    def forget(self, most: int) -> None:
        if len(self.cache) > most:
            self.cache.clear()
            self.letters.clear()

    def _meant(self, word: str) -> int | None:
        found = self.by_skeleton.get(skeleton(word), -1)
        if found >= 0:
            return found
        if len(word) < 4:
            return None
        bits = _letters(word)
        most = 2 if len(word) < 8 else 4
        near = {
            w for n in (len(word) - 1, len(word), len(word) + 1) for key in ((n, word[:1]), (n, "", word[-1:]))
            for own, w in self.by_shape.get(key, ()) if (own ^ bits).bit_count() <= most and close(word, w)
        }
        if len(near) == 1:
            return self.ids[near.pop()]
        return None

    def _resolve(self, token: str) -> int | None:
        spelled = spell(token)
        if not _SPOKEN.search(spelled):
            return None
        if spelled in self.ids:
            return self.ids[spelled]
        if spelled not in self.other and len(spelled) <= self.longest and sum(map(str.isdigit, spelled)) <= len(spelled) / 2:
            if not spelled.isascii():
                for code in _ENCODINGS:
                    try:
                        again = stripped(token.encode(code).decode("cp1252").lower())
                    except (UnicodeEncodeError, UnicodeDecodeError):
                        continue
                    if again in self.ids:
                        return self.ids[again]
            if (meant := self._meant(spelled)) is not None:
                return meant
        other = -1 - (hash_word(spelled) % (1 << 40))
        self.letters[other] = spelled
        return other

    def id(self, token: str) -> int | None:
        """None for a token that says nothing."""
        try:
            return self.cache[token]
        except KeyError:
            found = self.cache[token] = self._resolve(token)
            return found

    def same(self, item_word: int, seen: int) -> bool:
        if item_word == seen:
            return True
        if seen >= 0 or (spelled := self.letters.get(seen)) is None or spelled in self.other:
            return False
        word = self.words[item_word]
        return skeleton(word) == skeleton(spelled) or close(word, spelled)


def hash_word(word: str) -> int:
    h = 1469598103934665603
    for b in word.encode("utf-8", "replace"):
        h = ((h ^ b) * 1099511628211) & 0xFFFFFFFFFFFFFFFF
    return h


def _overlap(before: list[int], new: list[int]) -> int:
    """The longest run of words that ends what was said and begins the new line, allowing one misread word in four."""
    first, last = new[0], before[-1]
    for k in range(min(len(before), len(new)), 0, -1):
        if (before[-k] == first or last == new[k - 1]) and sum(map(ne, before[-k:], new[:k])) <= k // 4:
            return k
    return 0


def spoken(text: str, lexicon: Lexicon) -> list[int]:
    """The ids of the words a document says, in order."""
    lines: list[list[int]] = []
    adverts = may_advertise(text)
    cache, resolve = lexicon.cache, lexicon.id
    pending, before = "", []
    for cue in cues(text):
        for line in cue:
            line = without_sounds(untagged(line))
            if adverts and advertises(line):
                continue
            if ":" in line:
                line = unlabelled(line)
            tokens = line.split() if line.isascii() else _TOKEN.findall(line)
            if not tokens:
                continue
            shown = [cache[t] if t in cache else resolve(t) for t in tokens]
            # A line shown twice in a row is said once.
            if len(shown) == len(before) and (shown == before or 4 * sum(a != b for a, b in zip(shown, before)) <= len(shown)):
                continue
            before = shown
            if pending:
                shown = [resolve(pending + tokens[0].lstrip("-–—“\"'")), *shown[1:]]
                pending = ""
            last = tokens[-1]
            if last[-1] in "-\xad" and len(last) > 1 and last[-2].isalpha():
                pending = last[:-1]
                shown = shown[:-1]
            ids = [i for i in shown if i is not None]
            if ids:
                lines.append(ids)
    if pending and (i := resolve(pending)) is not None:
        lines.append([i])
    if len(lines) < 2:
        return lines[0] if lines else []
    overlaps = [0, *(_overlap(a, b) for a, b in zip(lines, lines[1:]))]
    rolling = sum(k >= 2 or k == len(b) for k, b in zip(overlaps, lines)) * 3 >= len(lines)
    out: list[int] = []
    for k, line in zip(overlaps, lines):
        if rolling or k >= 3 or k == len(line) >= 2:
            out += line[k:]
        else:
            out += line
    return out


def item_words(text: str) -> list[str]:
    plain = Lexicon([], frozenset())
    return [s for t in _TOKEN.findall(text) if plain.id(t) is not None and (s := spell(t))]


def _choices() -> list[np.ndarray]:
    """Places of SHOWN words among at most LEAST successive ones, the first and the last among them."""
    return [np.array((0, *inner, span - 1)) for span in range(SHOWN, LEAST + 1) for inner in combinations(range(1, span - 1), SHOWN - 2)]


class Index:
    """Fingerprints of the windows of some items, as ids and words, under each of their four blocks.

    lexicon, weights: of all items, see prepared().
    """

    def __init__(self, items: list[tuple[int, list[str]]], lexicon: Lexicon, weights: np.ndarray) -> None:
        self.lexicon = lexicon
        rng = np.random.default_rng(20250302)
        self.planes = rng.choice(np.array([-1, 1], np.int8), (len(lexicon.words) + 1, _BITS))
        self.item_ids = np.array([i for i, _ in items], np.int64)
        self.items = [np.array([lexicon.ids[w] for w in ws], np.int64) for _, ws in items]
        self.shingles = [np.convolve(weights[ids], np.ones(SHINGLE), "valid") for ids in self.items]
        words = np.concatenate(self.items) if items else np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(items)), [len(x) for x in self.items])
        place = np.concatenate([np.arange(len(x)) for x in self.items]) if items else np.empty(0, np.int64)
        prints, at = [], []
        for choice in _choices():
            n = len(words) - choice[-1]
            starts = np.flatnonzero(owner[: max(n, 0)] == owner[len(owner) - max(n, 0) :])
            prints.append(self.fingerprints(words[starts[:, None] + choice]))
            at.append(starts)
        self.prints = np.concatenate(prints)
        at = np.concatenate(at)
        self.owner, self.place = owner[at], place[at]
        gaps = [words[: max(len(words) - g, 0)] * len(lexicon.words) + words[g:] for g in range(1, UNREAD + 2)]
        near = [owner[: max(len(words) - g, 0)] == owner[g:] for g in range(1, UNREAD + 2)]
        #: Words that follow one another in an item, with up to UNREAD others between them.
        self.pairs = np.unique(np.concatenate([k[n] for k, n in zip(gaps, near)]))
        self.blocks = []
        for b in range(_BITS // BLOCK_BITS):
            value = ((self.prints >> np.uint64(b * BLOCK_BITS)) & np.uint64(0xFFFF)).astype(np.int64)
            order = np.argsort(value, kind="stable").astype(np.int32)
            self.blocks.append((order, np.concatenate(([0], np.cumsum(np.bincount(value, minlength=1 << BLOCK_BITS))))))

    def fingerprints(self, windows: np.ndarray) -> np.ndarray:
        """SimHash of windows of SHOWN known words, one a row."""
        if not len(windows):
            return np.empty(0, np.uint64)
        total = self.planes[windows[:, 0]].copy()
        for k in range(1, windows.shape[1]):
            total += self.planes[windows[:, k]]
        # Ties at zero are broken by the window's first word, the same way on both sides.
        bits = (total > 0) | ((total == 0) & (self.planes[windows[:, 0]] > 0))
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (document window, item window) within RADIUS bits."""
        found_at, found_of = [], []
        for b, (order, ends) in enumerate(self.blocks):
            value = ((prints >> np.uint64(b * BLOCK_BITS)) & np.uint64(0xFFFF)).astype(np.int64)
            first = ends[value]
            n = ends[value + 1] - first
            at = np.repeat(np.arange(len(prints)), n)
            of = order[np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]
            near = np.bitwise_count(prints[at] ^ self.prints[of]) <= RADIUS
            found_at.append(at[near])
            found_of.append(of[near])
        return np.concatenate(found_at), np.concatenate(found_of)

    def aligned(self, item: np.ndarray, words: np.ndarray, place: int, at: int) -> tuple[int, int]:
        """The item's words, first to last plus one, that the document says in order around the place."""
        same = self.lexicon.same

        def extend(i: int, j: int, step: int) -> int:
            while 0 <= i < len(item) and 0 <= j < len(words):
                if same(item[i], words[j]):
                    i, j = i + step, j + step
                elif words[j] < 0 and 0 <= j + step < len(words) and same(item[i], words[j + step]):
                    j += step  # a stray piece between two words of the passage
                elif words[j] < 0 and self._pieces(item[i], words, j, step):
                    i, j = i + step, j + 2 * step
                else:
                    break
            return i

        return extend(place - 1, at - 1, -1) + 1, extend(place, at, 1)

    def similarity(self, n: int, place: int, first: int, end: int) -> float:
        """The greatest share of its shingles' weight that a window of the item over the place has among the words first to end."""
        weight = self.shingles[n]
        best = 0.0
        for start in range(max(0, place - LEAST + 1), min(place, len(self.items[n]) - LEAST) + 1):
            whole = weight[start : start + LEAST - SHINGLE + 1].sum()
            shared = weight[max(start, first) : max(min(start + LEAST, end) - SHINGLE + 1, 0)].sum()
            best = max(best, float(shared / whole))
        return best

    def _pieces(self, word: int, words: np.ndarray, j: int, step: int) -> bool:
        """Two neighbouring tokens that together are the word."""
        k = j + step
        if not 0 <= k < len(words):
            return False
        spell = [self.lexicon.words[w] if w >= 0 else self.lexicon.letters.get(int(w), "") for w in (words[min(j, k)], words[max(j, k)])]
        joined, meant = "".join(spell), self.lexicon.words[word]
        return joined == meant or skeleton(joined) == skeleton(meant)

    def leaks(self, streams: list[np.ndarray]) -> list[tuple[int, int]]:
        """(stream, item) of each passage found."""
        if not streams or not len(self.prints):
            return []
        words = np.concatenate(streams)
        start = np.concatenate(([0], np.cumsum([len(s) for s in streams])))
        known = np.flatnonzero(words >= 0)
        if len(known) < SHOWN:
            return []
        stream = np.searchsorted(start, known, "right") - 1
        # A window that is verified shows words in an item's order; others needn't be looked up.
        shown = words[known]
        key = shown[:-1] * len(self.lexicon.words) + shown[1:]
        slot = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        follows = np.concatenate(([0], np.cumsum(self.pairs[slot] == key)))
        whole = follows[SHOWN - 1 :] - follows[: len(follows) - SHOWN + 1] == SHOWN - 1
        first = np.flatnonzero(whole & (stream[: len(known) - SHOWN + 1] == stream[SHOWN - 1 :]))
        at, of = self.candidates(self.fingerprints(shown[first[:, None] + np.arange(SHOWN)]))
        at = first[at]
        tries = np.stack((known[at], self.owner[of], self.place[of], stream[at]))
        tries = np.unique(tries, axis=1) if tries.size else tries
        out: set[tuple[int, int]] = set()
        for a, n, place, s in tries.T.tolist():
            if (s, n) in out:
                continue
            begin, end = self.aligned(self.items[n], words[start[s] : start[s + 1]], place, int(a - start[s]))
            if self.similarity(n, place, begin, end) >= LIMIT - 1e-9:
                out.add((s, n))
        return sorted(out)


#: Words of streams searched together, and tokens whose meaning a task keeps; neither changes what is found.
_STREAM_WORDS, _KNOWN_TOKENS = 50_000, 300_000
_STREAMS = "doc_id bigint, words array<bigint>, odd array<string>"
_PAIRS = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64())])


def _found(index: Index, ids: list[int], streams: list[np.ndarray]) -> pa.RecordBatch:
    found = index.leaks(streams)
    return pa.RecordBatch.from_arrays([pa.array([int(index.item_ids[n]) for _, n in found], pa.int64()), pa.array([ids[s] for s, _ in found], pa.int64())], schema=_PAIRS)


def _parsed(batches: Iterator[pa.RecordBatch], lexicon: Lexicon, most: int = _STREAM_WORDS) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Documents' streams in groups; what the lexicon keeps of a group is only forgotten after it."""
    ids, streams, n = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            words = spoken(reread(text), lexicon)
            if len(words) >= SHOWN:
                ids.append(doc_id)
                streams.append(np.array(words, np.int64))
                n += len(words)
            if n >= most:
                yield ids, streams
                lexicon.forget(_KNOWN_TOKENS)
                ids, streams, n = [], [], 0
    if ids:
        yield ids, streams


def _search_texts(words: list[str], other: frozenset[str], items: list, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(words, other)
        index = Index(items, lexicon, weights)
        for ids, streams in _parsed(batches, lexicon):
            yield _found(index, ids, streams)

    return run


def _parse(words: list[str], other: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(words, other)
        for ids, streams in _parsed(batches, lexicon):
            odd = [[None if w >= 0 else lexicon.letters[w] for w in s.tolist()] for s in streams]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(streams, pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.string()))], names=["doc_id", "words", "odd"])

    return run


def _search_streams(words: list[str], other: frozenset[str], items: list, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(words, other)
        index = Index(items, lexicon, weights)
        for batch in batches:
            streams = [np.array(s, np.int64) for s in batch.column("words").to_pylist()]
            for s, odd in zip(streams, batch.column("odd").to_pylist()):
                lexicon.letters.update((w, o) for w, o in zip(s.tolist(), odd) if o is not None)
            yield _found(index, batch.column("doc_id").to_pylist(), streams)
            lexicon.letters.clear()

    return run


def prepared(items: list[tuple[int, list[str]]], other: frozenset[str]) -> tuple[list[str], frozenset[str], np.ndarray]:
    """Vocabulary of the items, the other words, and the weight of each word: rarer among the items, heavier."""
    count: dict[str, int] = defaultdict(int)
    for _, ws in items:
        for w in set(ws):
            count[w] += 1
    words = sorted(count)
    return words, other - count.keys(), np.log(1 + len(items) / np.array([count[w] for w in words] or [1.0]))


def leaked(documents: DataFrame, items: DataFrame, other_words: DataFrame | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """item_id, doc_id of documents that hold a passage of an item.

    items: the query set, held by the driver and each task. other_words: word; words that are never misread evaluation
    words, ``MAX_COMMON`` at most.
    """
    texts = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    other: frozenset[str] = frozenset()
    if other_words is not None:
        other = frozenset(r[0] for r in other_words.where("word IS NOT NULL").select(F.lower("word")).distinct().limit(MAX_COMMON + 1).collect())
        if len(other) > MAX_COMMON:
            raise ValueError(f"at most {MAX_COMMON:,} common words")
    rows = items.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("bigint"), "text").distinct().toLocalIterator()
    all_items = [(i, ws) for i, text in rows if len(ws := item_words(text)) >= LEAST]
    words, other, weights = prepared(all_items, other)
    blocks: list[list] = [[]]
    size = 0
    for item in all_items:
        if blocks[-1] and size + len(item[1]) > block_words:
            blocks.append([])
            size = 0
        blocks[-1].append(item)
        size += len(item[1])
    pair = "item_id bigint, doc_id bigint"
    if len(blocks) == 1:
        return texts.mapInArrow(_search_texts(words, other, blocks[0], weights), pair).distinct()
    streams = materialise(texts.mapInArrow(_parse(words, other), _STREAMS), "spoken-words")
    found = None
    for block in blocks:
        part = streams.mapInArrow(_search_streams(words, other, block, weights), pair)
        found = part if found is None else found.unionByName(part)
    return found.distinct()
