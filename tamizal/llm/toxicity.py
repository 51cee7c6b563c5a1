"""Toxicity: a learned lexicon in a trie, met by Levenshtein automata, with scores of context windows.

The lexicon is learned from labelled texts: words, and beginnings of words, that stand in toxic texts far
more often than in others. A word of a text meets the lexicon if the automaton of the word, with a few
edits allowed, and the trie accept a common term; a beginning is met by a beginning of the word. The distinct
words of a batch walk the trie together, level by level: what is alive is (word, node, state of its automaton),
and one table of transitions serves all words. What a match counts for depends on its window: alone or among
others, between quotation marks that pair up inside the window or not, exact or misspelled. A logistic model turns these scores of a text into one; it is fitted on the same bounded sample of labelled
texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamizal.llm.common import bounded_batches, table, words_of, written

FOLDS = 5
SAMPLE_DOCS = 20_000  # labelled texts that the lexicon and the model are fitted on, at most about so many
BEGINNINGS = (4, 5, 6, 7, 8)
LEAST_TEXTS, LEAST_SHARE, LEAST_RATIO, LEAST_EVIDENCE = 3, 0.01, 10.0, 12.0
WINDOW = 12
MEMO_WORDS = 300_000
_WALKED = 512  # words that walk the trie together

_BEGINNING = "beginning"  # in the trie, beside letters: a beginning of words ends here; "" is the end of a word
_WORD = re.compile(r"[^\W_]+(?:[*@$!'’][^\W_]+)*")
# Marks of quotations: double ones, and single ones, which are apostrophes between letters.
_QUOTES = re.compile("[\"“”«»„‟]|['‘’‚‹›]")
_SINGLE = frozenset("'‘’‚‹›")
_BEFORE_QUOTE = frozenset("([{<—–-:;,.!?…/¿¡\"“„«'‘‚‹")
# Characters that stand for letters in disguised words.
_DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})


def edits_allowed(term: str) -> int:
    """Edits within which a word is a misspelling of ``term``: none for short ones."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """The Levenshtein automaton of a word, for at most ``most`` edits.

    A state is how many letters were read, and the distances to the prefixes of the word about as long. Where
    a letter leads depends on these distances and on which letters of the word nearby are equal to it, not
    on the word, so the transitions found for one word serve all.
    """

    transitions: dict[tuple, tuple[int, ...]] = {}

    def __init__(self, word: str, most: int):
        self.size, self.most = len(word), most
        self.padded = "\0" * most + word + "\0" * (2 * most + 2)

    def start(self) -> tuple[int, tuple[int, ...]]:
        far = self.most + 1
        return 0, (*[far] * self.most, *range(self.most + 1))

    def step(self, state: tuple[int, tuple[int, ...]], letter: str) -> tuple[int, tuple[int, ...]] | None:
        """The state after ``letter``; none if more than ``most`` edits are certain."""
        read, band = state
        seen = self.padded[read : read + len(band)]
        if len(seen) < len(band):
            return None
        key = band, tuple([own == letter for own in seen])
        after = Automaton.transitions.get(key)
        if after is None:
            far, row = self.most + 1, []
            for k, equal in enumerate(key[1]):
                above = band[k + 1] + 1 if k + 1 < len(band) else far
                left = row[-1] + 1 if row else far
                row.append(min(band[k] + (not equal), above, left, far))
            after = Automaton.transitions[key] = tuple(row)
        return (read + 1, after) if min(after) <= self.most else None

    def distance(self, state: tuple[int, tuple[int, ...]] | None) -> int:
        """Edits between the word and the letters read, ``most + 1`` for any more."""
        k = self.size - state[0] + self.most if state else -1
        return state[1][k] if 0 <= k < 2 * self.most + 1 else self.most + 1


class Transitions:
    """The automaton's bands as numbers, and where each leads for every way the letters nearby can be equal."""

    def __init__(self, most: int):
        self.most, self.width = most, 2 * most + 1
        numbers = {Automaton("", most).start()[1]: 0}
        rows, waiting = [], list(numbers)
        for band in waiting:  # grows as it goes
            row = []
            for bits in range(1 << self.width):
                # a word of letters that are equal to the one read, or not
                word = "".join("x" if bits >> k & 1 else "y" for k in range(self.width))
                automaton = Automaton("", most)
                automaton.padded = word
                after = automaton.step((0, band), "x")
                if after is None:
                    row.append(-1)
                    continue
                if after[1] not in numbers:
                    numbers[after[1]] = len(numbers)
                    waiting.append(after[1])
                row.append(numbers[after[1]])
            rows.append(row)
        self.table = np.array(rows, np.int16)
        self.bands = np.array(waiting, np.int16)
        self.least = self.bands.min(axis=1)


class FlatTrie:
    """A trie as arrays: the children of a node stand together, with the letter that leads to each."""

    transitions: dict[int, Transitions] = {}

    def __init__(self, trie: dict):
        letters, first, count, ends, begins = [0], [0], [0], [-1], [-1]
        self.codes: dict[str, int] = {}
        found: list[str] = []
        waiting = [trie]
        for number, node in enumerate(waiting):  # grows as it goes
            first[number] = len(waiting)
            for letter, below in node.items():
                if letter in ("", _BEGINNING):
                    (begins if letter else ends)[number] = len(found)
                    found.append(below)
                    continue
                waiting.append(below)
                letters.append(self.codes.setdefault(letter, len(self.codes) + 1))
                for column in (first, count):
                    column.append(0)
                for column in (ends, begins):
                    column.append(-1)
                count[number] += 1
        self.letters, self.first, self.count = (np.array(c, np.int64) for c in (letters, first, count))
        self.ends, self.begins = np.array(ends, np.int64), np.array(begins, np.int64)
        self.terms = sorted(set(found))
        rank = {t: i for i, t in enumerate(self.terms)}
        self.rank = np.array([rank[t] for t in found] or [0], np.int64)
        self.allowed = np.array([edits_allowed(t) for t in found] or [0], np.int64)
        self.depth = max(map(len, self.terms), default=0)

    def walk(self, words: list[str], most: int) -> list[str | None]:
        """The nearest term for each word, by trie and automata at once."""
        if most not in FlatTrie.transitions:
            FlatTrie.transitions[most] = Transitions(most)
        moves = FlatTrie.transitions[most]
        size = np.array([len(w) for w in words])
        # no more letters than the deepest term can be compared with
        padded = np.zeros((len(words), self.depth + 3 * most + 2), np.int64)
        for i, word in enumerate(words):
            codes = [self.codes.get(letter, -1) for letter in word[: self.depth + most + 1]]
            padded[i, most : most + len(codes)] = codes
        worst = (most + 1) * len(self.terms)
        best = np.full(len(words), worst)

        def offer(word: np.ndarray, term: np.ndarray, distance: np.ndarray) -> None:
            near = (term >= 0) & (distance <= np.minimum(self.allowed[term], most))
            np.minimum.at(best, word[near], distance[near] * len(self.terms) + self.rank[term[near]])

        word, node, state = np.arange(len(words)), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for read in range(self.depth):
            count = self.count[node]
            above = np.repeat(np.arange(len(node)), count)
            child = np.arange(len(above)) - np.repeat(np.cumsum(count) - count, count) + self.first[node][above]
            word, letter = word[above], self.letters[child]
            equal = padded[word[:, None], read + np.arange(moves.width)] == letter[:, None]
            after = moves.table[state[above], equal @ (1 << np.arange(moves.width))]
            alive = np.flatnonzero((after >= 0) & (read <= size[word] + most))
            word, node, state = word[alive], child[alive], after[alive].astype(np.int64)
            if not len(word):
                break
            place = size[word] - (read + 1) + most
            inside = (place >= 0) & (place < moves.width)
            offer(word[inside], self.ends[node[inside]], moves.bands[state[inside], place[inside]].astype(np.int64))
            offer(word, self.begins[node], moves.least[state].astype(np.int64))
        return [self.terms[b % len(self.terms)] if b < worst else None for b in best.tolist()]


@dataclass
class Lexicon:
    """Terms with weights: whole words, beginnings of words, and words with such a beginning; a trie of all that may be misspelled."""

    words: dict[str, float]
    stems: dict[str, float]
    inflected: dict[str, float] = field(default_factory=dict)  # met exactly by their beginning, misspelled by themselves
    trie: dict = field(default_factory=dict)

    def __post_init__(self):
        self.weights = {**self.inflected, **self.stems, **self.words}
        places: dict[int, set[str]] = {}
        for end, terms in (("", (*self.words, *self.inflected)), (_BEGINNING, self.stems)):
            for term in terms:
                edits = edits_allowed(term)
                if not edits:  # only met exactly
                    continue
                node = self.trie
                for letter in term:
                    node = node.setdefault(letter, {})
                node[end] = term
                cuts = [len(term) * k // (edits + 1) for k in range(edits + 2)]
                for low, high in zip(cuts, cuts[1:]):  # of one more pieces than edits, one is untouched, and hardly moved
                    for at in range(max(low - edits, 0), low + edits + 1):
                        places.setdefault(at, set()).add(term[low:high])
        self.pieces = [(at, sorted({len(piece) for piece in own}), own) for at, own in sorted(places.items())]
        self.lengths = sorted({len(s) for s in self.stems})
        self.flat = FlatTrie(self.trie)

    def maybe(self, word: str) -> bool:
        """Whether a piece of any term stands in ``word`` about where it does in the term."""
        return any(word[at : at + length] in own for at, lengths, own in self.pieces for length in lengths)

    def near(self, word: str) -> str | None:
        """The nearest term that ``word`` is a misspelling of."""
        return self.nearest([word])[0]

    def nearest(self, words: list[str]) -> list[str | None]:
        """For each word the nearest term that it is a misspelling of, the first of equally near ones."""
        out: list[str | None] = [None] * len(words)
        for most in (1, 2):
            asked = [i for i, w in enumerate(words) if len(w) >= 4 and (len(w) < 7) == (most == 1) and self.maybe(w)]
            asked.sort(key=words.__getitem__)
            for low in range(0, len(asked), _WALKED):
                part = asked[low : low + _WALKED]
                for i, term in zip(part, self.flat.walk([words[i] for i in part], most)):
                    out[i] = term
        return out

    def meet(self, word: str) -> tuple[float, bool] | None:
        """Weight of the term that a word meets, and whether it is met exactly."""
        return self.meet_all([word])[0]

    def meet_all(self, words: list[str]) -> list[tuple[float, bool] | None]:
        out: list[tuple[float, bool] | None] = [None] * len(words)
        asked: dict[int, str] = {}
        for i, word in enumerate(words):
            weight = self.words.get(word)
            if weight is None:
                weight = self._begun(word)
            if weight is not None:
                out[i] = weight, True
                continue
            plain = re.sub("[*'’]", "", word.translate(_DISGUISE)) if not word.isalpha() else word
            weight = self.words.get(plain)
            if weight is None:
                weight = self._begun(plain)
            if weight is not None:
                out[i] = weight, False
            else:
                asked[i] = plain
        for i, term in zip(asked, self.nearest(list(asked.values()))):
            if term is not None:
                out[i] = self.weights[term], False
        return out

    def _begun(self, word: str) -> float | None:
        return next((self.stems[word[:length]] for length in self.lengths if word[:length] in self.stems), None)


FEATURES = ("exact", "misspelled", "quoted", "dense", "share", "any")


def _marks(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of quotation marks, whether each is single, and whether it opens (1), closes (-1) or neither (0).

    A mark opens after a blank, the start or a sign, before something else; it closes the other way about. What
    stands between two letters or digits is an apostrophe, and after a digit before a blank a sign of measure.
    """
    places, single, turns = [], [], []
    for found in _QUOTES.finditer(text):
        at, mark = found.start(), found[0]
        before, after = text[at - 1 : at], text[at + 1 : at + 2]
        if before.isalnum() and after.isalnum():
            continue
        free_before, free_after = not before or before.isspace(), not after or after.isspace()
        if free_before and free_after:
            continue
        if free_before or (before in _BEFORE_QUOTE and after.isalnum()):
            turn = 1
        elif before.isdigit() and mark in "\"'":
            turn = 0
        else:
            turn = -1
        places.append(at)
        single.append(mark in _SINGLE)
        turns.append(turn)
    return np.array(places, np.int64), np.array(single, bool), np.array(turns, np.int64)


def _quoted(begin: int, end: int, low: int, high: int, marks: list[tuple[np.ndarray, np.ndarray]]) -> bool:
    """Whether [begin, end) stands between a mark that opens and one that closes, both in [low, high) and of one kind.

    Of each kind the nearest mark on either side decides: nothing before the window is asked.
    """
    for places, turns in marks:
        left, right = int(np.searchsorted(places, begin)) - 1, int(np.searchsorted(places, end))
        while left >= 0 and turns[left] == 0 and places[left] >= low:
            left -= 1
        while right < len(places) and turns[right] == 0 and places[right] < high:
            right += 1
        if left >= 0 and right < len(places) and places[left] >= low and places[right] < high and turns[left] == 1 and turns[right] == -1:
            return True
    return False


class Scorer:
    """Scores of texts against a lexicon; words met before are kept in a bounded memo."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.known = lexicon, {}

    def rows(self, texts: list[str]) -> list[list[float]]:
        """Features of each text; the words that are new to all of them meet the lexicon together."""
        lower = [text.lower() for text in texts]
        new = set()
        for text in lower:
            new.update(_WORD.findall(text))
        if len(self.known) + len(new.difference(self.known)) > MEMO_WORDS:
            self.known = {}
        new = sorted(new.difference(self.known))
        for word, met in zip(new, self.lexicon.meet_all(new)):
            self.known[word] = met
        return [self._of(text) for text in lower]

    def features(self, text: str) -> list[float]:
        return self.rows([text])[0]

    def _of(self, lower: str) -> list[float]:
        known = self.known
        words = _WORD.findall(lower)
        places = [i for i, word in enumerate(words) if known[word] is not None]
        if not places:
            return [0.0] * len(FEATURES)
        at, single, turns = _marks(lower)
        marks = [(at[kind], turns[kind]) for kind in (single, ~single) if kind.any()]
        spans = [m.span() for m in _WORD.finditer(lower)] if marks else []
        exact = misspelled = quoted = dense = near = 0.0
        first = 0  # of the matches that are in the window before the current one
        for n, place in enumerate(places):
            weight, is_exact = known[words[place]]
            begin, end = spans[place] if marks else (0, 0)
            if marks and _quoted(begin, end, spans[max(place - WINDOW, 0)][0] - 1, spans[min(place + WINDOW, len(spans) - 1)][1] + 1, marks):
                quoted += weight
            elif is_exact:
                exact += weight
            else:
                misspelled += weight
            near += weight
            while place - places[first] > WINDOW:
                near -= known[words[places[first]]][0]
                first += 1
            dense = max(dense, near)
        share = (exact + misspelled) / math.sqrt(len(words))
        return [math.log1p(exact), math.log1p(misspelled), math.log1p(quoted), math.log1p(dense), math.log1p(share), 1.0]


def _fold(doc_id: str) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each label that hold each word, and each beginning of a word."""
    for batch in batches:
        counts: dict[int, Counter[tuple[str, bool]]] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = set(_WORD.findall(text.lower()))
            counts[toxic].update({(w, True) for w in words} | {(w[:k], False) for w in words for k in BEGINNINGS if len(w) >= k})
        rows = [(term, whole, counts[1][term, whole], counts[0][term, whole]) for term, whole in counts[0] | counts[1]]
        if rows:
            kinds = [pa.string(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["term", "whole", "toxic", "clean"])


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Terms of the labelled texts ``sample`` (``text``, ``toxic``), by how much they tell toxic texts apart.

    Words of any length, and beginnings, count in Spark for both labels. A term of at least ``LEAST_TEXTS`` toxic
    texts, and ``LEAST_SHARE`` of them, counts with the logarithm of how much more often it stands in toxic texts,
    and needs evidence (a likelihood ratio) that chance does not give. All that have it are terms: as each stands in
    ``LEAST_SHARE`` of the sample's toxic texts, they are no more than a hundred times the terms of one text. Of a
    beginning and longer ones that tell no more, the shortest is taken; a word that only stands alone is
    a word. Words with such a beginning are kept for their misspellings.
    """
    n_toxic, n_clean = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count_if(F.col("toxic") == 0)).first()
    if not n_toxic or not n_clean:
        return Lexicon({}, {})
    least = max(LEAST_TEXTS, math.ceil(LEAST_SHARE * n_toxic))
    counted = sample.select("text", "toxic").mapInArrow(_terms, "term string, whole boolean, toxic bigint, clean bigint")
    often = counted.groupBy("term", "whole").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).where(F.col("t") >= least)
    t, c, base = F.col("t").cast("double"), F.col("c").cast("double"), n_toxic / (n_toxic + n_clean)
    ratio = (t / n_toxic) / ((c + 0.5) / (n_clean + 1.0))
    telling = often.where(ratio >= LEAST_RATIO)
    told = []
    for r in telling.collect():
        t, c = r.t, r.c
        evidence = t * math.log(t / ((t + c) * base)) + (c * math.log(c / ((t + c) * (1 - base))) if c else 0.0)
        if evidence >= LEAST_EVIDENCE:
            told.append((-evidence, (r.term, r.whole), t, (t / n_toxic) / ((c + 0.5) / (n_clean + 1.0))))
    words, beginnings = {}, []
    for _, (term, whole), texts, ratio in sorted(told):
        if whole:
            words[term] = texts, ratio
        else:
            beginnings.append((len(term), term, texts, ratio))
    longest: dict[str, int] = {}  # texts of the most frequent word with a beginning
    for word, (n, _) in words.items():
        for k in BEGINNINGS:
            if len(word) >= k:
                longest[word[:k]] = max(longest.get(word[:k], 0), n)
    stems: dict[str, float] = {}
    for _, term, texts, ratio in sorted(beginnings):
        spread = term not in words or words[term][0] < 0.8 * texts
        # mostly one longer word: that word is the term
        one = longest.get(term, 0) >= 0.8 * texts
        if spread and not one and not any(term[:k] in stems for k in BEGINNINGS):
            stems[term] = math.log(ratio)
    begun = {w for w in words if any(w[:k] in stems for k in BEGINNINGS)}
    weights = {w: math.log(ratio) for w, (_, ratio) in words.items()}
    return Lexicon({w: weight for w, weight in weights.items() if w not in begun}, stems, {w: weights[w] for w in begun})


def _score_rows(lexicon: Lexicon, extra: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in batches:
            rows = scorer.rows(batch.column("text").to_pylist())
            features = [pa.array([r[k] for r in rows], pa.float64()) for k in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in extra], *features], names=[*extra, *FEATURES])

    return score


_FEATURE_TYPES = ", ".join(f"{name} double" for name in FEATURES)


def fit_logistic(features: np.ndarray, labels: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights and intercept (last) by Newton's method with a ridge penalty."""
    x = np.column_stack([features, np.ones(len(features))])
    ridge = np.diag([penalty] * features.shape[1] + [1e-3])
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (labels - p) - ridge @ weights)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def labelled_sample(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``text`` and ``toxic`` of labelled texts that are not held out, copies and most near copies once; about ``sample_docs`` at most."""
    known = labels.where((_fold("doc_id") != 0) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    chosen = known
    if total > sample_docs:
        share = int(sample_docs / total * (1 << 20))
        chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) < share)
    joined = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    # near copies share their smallest shingle mostly, and would else make words of one text look telling
    words = joined.withColumn("words", words_of(F.col("text")))
    shingles = F.transform(
        F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    )
    kind = F.when(F.size("words") >= 3, F.array_min(shingles)).otherwise(F.xxhash64("text"))
    single = words.withColumn("kind", kind).groupBy("kind", "toxic").agg(F.min("text").alias("text"))
    return written(single.select("text", F.col("toxic").cast("int").alias("toxic")), "toxic-sample")


def toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs`` (``doc_id``, ``text``).

    ``labels`` has ``doc_id`` and ``toxic``. Null and empty texts have a score too, that of a text without
    any match, as has every text if there are no labels of both kinds (then one half less a little).
    Repeated rows score alike; a null ``doc_id`` is not held out.
    """
    bounded_batches(docs.sparkSession, 500)
    sample = labelled_sample(docs, labels, sample_docs)
    lexicon = learn_lexicon(sample)
    rows = sample.mapInArrow(_score_rows(lexicon, ["toxic"]), f"toxic int, {_FEATURE_TYPES}").collect()
    # at most ``sample_docs`` rows of a few numbers
    features = np.array([[r[name] for name in FEATURES] for r in rows]).reshape(len(rows), len(FEATURES))
    truth = np.array([r["toxic"] for r in rows], float)
    if 0 < truth.sum() < len(truth):
        weights = fit_logistic(features, truth)
    else:
        weights = np.array([0.0] * len(FEATURES) + [-1e-3])
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    scored = own.mapInArrow(_score_rows(lexicon, ["doc_id"]), f"doc_id bigint, {_FEATURE_TYPES}")
    margin = F.lit(float(weights[-1]))
    for name, weight in zip(FEATURES, weights):
        margin = margin + F.col(name) * float(weight)
    score = 1 / (1 + F.exp(-margin))
    held = F.coalesce(_fold("doc_id") == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)
    )


def op9_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
