import itertools
import math
import random

from tamizal.llm.toxicity import Automaton, Lexicon, Scorer, edits_allowed, learn_lexicon, toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i, *itertools.accumulate(range(1, len(b) + 1), lambda left, j: min(left + 1, row[j] + 1, row[j - 1] + (x != b[j - 1])), initial=i)][1:]
    return row[-1]


def test_automaton_accepts_within_its_edits():
    words = ["".join(w) for n in range(5) for w in itertools.product("ab", repeat=n)]
    for word in words:
        automaton = Automaton(word, 2)
        for other in words:
            state = automaton.start()
            for letter in other:
                state = state and automaton.step(state, letter)
            assert automaton.distance(state) == min(distance(word, other), 3)


def test_near_finds_all_that_brute_force_finds():
    rng = random.Random(1)
    terms = ["".join(rng.choices("abcd", k=rng.randint(5, 11))) for _ in range(25)]
    lexicon = Lexicon(dict.fromkeys(terms, 1.0), {})
    for _ in range(4000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word))
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "cd"])
        word = "".join(word)
        best = min((distance(word, t), t) for t in terms if distance(word, t) <= edits_allowed(t)) if any(distance(word, t) <= edits_allowed(t) for t in terms) else None
        assert lexicon.near(word) == (best[1] if best and len(word) >= 4 else None)


def test_misspellings_and_disguises():
    lexicon = Lexicon({"idiot": 2.0, "worthless": 1.0, "scum": 3.0}, {"lowei": 1.5})
    assert lexicon.meet("idiot") == (2.0, True) and lexicon.meet("loweischaft") == (1.5, True)
    for word, weight in (("idiott", 2.0), ("id1ot", 2.0), ("1d10t", 2.0), ("wortless", 1.0), ("worthles", 1.0), ("wrthlss", 1.0)):
        assert lexicon.meet(word) == (weight, False)
    assert lexicon.meet("scam") is None and lexicon.meet("idea") is None


def test_misspellings_of_words_with_a_known_beginning():
    lexicon = Lexicon({"scum": 3.0}, {"idiot": 2.0, "lowe": 1.5}, {"lowering": 1.0})
    for word in ("id1ot", "1d10ts", "id1otic", "idot", "idiiotic", "ediots", "l0wely", "lovering", "lowering"):
        assert lexicon.meet(word) is not None, word
    assert lexicon.meet("id1otic") == (2.0, False) and lexicon.meet("idiotic") == (2.0, True) and lexicon.meet("lovering") == (1.0, False)
    assert lexicon.meet("lowering") == (1.5, True) and lexicon.meet("ideal") is None and lexicon.meet("lov") is None


def test_every_term_is_looked_for_with_edits():
    rng = random.Random(2)
    terms = list(dict.fromkeys("".join(rng.choices("abcdefghij", k=rng.randint(5, 10))) for _ in range(400)))
    words, stems = dict.fromkeys(terms[:300], 1.0), dict.fromkeys([t[:8] for t in terms[300:]], 2.0)
    lexicon = Lexicon(words, stems)
    for _ in range(120):
        word = list(rng.choice(terms) + rng.choice(["", "zx", "k"]))
        for _ in range(rng.randint(0, 2)):
            word[rng.randrange(len(word))] = rng.choice(["", "a", "bc"])
        word = "".join(word)
        cuts = {d: word[:d] for d in range(len(word) + 1)}
        found = [(distance(word, t), t) for t in words if abs(len(t) - len(word)) <= 2]
        found += [(min(distance(cut, t) for d, cut in cuts.items() if abs(d - len(t)) <= 2), t) for t in stems if len(word) >= len(t) - 2]
        best = min((f for f in found if f[0] <= edits_allowed(f[1])), default=(0, None))
        assert lexicon.near(word) == best[1]


def test_learned_words_of_a_beginning_are_kept_for_misspellings(spark):
    rng = random.Random(5)
    plain = "river stone window garden paper letter moment summer yellow follow number travel".split()
    bad = ["idiot", "idiots", "idiotic", "idiotism", "idiotry"]
    rows = [(" ".join([*rng.choices(plain, k=20), *([bad[i % 5], bad[i // 5 % 5]] if i % 2 else [])]), i % 2) for i in range(400)]
    lexicon = learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert any("idiotic".startswith(s) for s in lexicon.stems) and "idiotic" not in lexicon.words
    for word in ("id1ot", "idiitic", "iditic", "ediots", "idyotism"):
        assert lexicon.meet(word) and not lexicon.meet(word)[1]


def test_all_matches_of_a_window_count():
    scorer = Scorer(Lexicon({"idiot": 2.0}, {}))
    ten, thirteen = (scorer.features(" ".join(["idiot"] * n)) for n in (10, 13))
    assert math.isclose(math.expm1(ten[3]), 20.0) and math.isclose(math.expm1(thirteen[3]), 26.0)


def test_quoted_terms_count_apart():
    scorer = Scorer(Lexicon({"idiot": 2.0}, {}))
    plain, quoted = scorer.features("you are an idiot indeed"), scorer.features('they wrote "an idiot indeed" there')
    assert plain[0] > 0 and plain[2] == 0 and quoted[0] == 0 and quoted[2] > 0
    assert scorer.features("") == [0.0] * 6


def test_quotations_are_pairs_inside_the_window():
    scorer = Scorer(Lexicon({"grimble": 2.0}, {}))
    quoted = ["he said 'you grimble' and left", "„du grimble“ sagte er", "« grimble, dit-il »".replace("« ", "«").replace(" »", "»"), "she typed “grimble”.", "the word ‘grimble’, again", "(\"grimble\")",
              "don't say 'the grimble's hat' here", "\"a 5\" grimble\" she wrote"]
    plain = ["the 5\" screen is fine. you are a grimble fool, he typed on a 7\" one", "don't be a grimble, it's bad", "\"yes\" you grimble \"no\"", "the dogs' grimble ate 'it'", "grimble", "\" grimble \"",
             "\"" + "far " * 20 + "grimble\"", "he's a grimble, rock 'n' roll", "“open grimble", "grimble” closed"]
    for text in quoted:
        assert scorer.features(text)[2] > 0 and scorer.features(text)[0] == 0, text
    for text in plain:
        assert scorer.features(text)[2] == 0 and scorer.features(text)[0] > 0, text
    # what stands before the window changes nothing
    for before in ("", "\" ", "it's \"odd ", "“ “ “ " * 5):
        assert scorer.features(before + "so " * 30 + "you grimble")[2] == 0
        assert scorer.features(before + "so " * 30 + "\"you grimble\"")[2] > 0


def _plain_features(lexicon, text):
    """Windows by looking at every pair of matches."""
    import re

    lower = text.lower()
    spans = [m.span() for m in re.finditer(r"[^\W_]+(?:[*@$!'’][^\W_]+)*", lower)]
    met = [lexicon.meet(lower[a:b]) for a, b in spans]
    hits = [i for i, m in enumerate(met) if m]
    exact = sum(met[i][0] for i in hits if met[i][1])
    other = sum(met[i][0] for i in hits if not met[i][1])
    dense = max([sum(met[j][0] for j in hits if 0 <= i - j <= 12) for i in hits], default=0)
    return [math.log1p(exact), math.log1p(other), 0.0, math.log1p(dense), math.log1p((exact + other) / math.sqrt(len(spans))) if hits else 0.0, float(bool(hits))]


def test_windows_equal_a_plain_version():
    rng = random.Random(11)
    lexicon = Lexicon({"worthless": 1.0, "scum": 3.0}, {"idiot": 2.0}, {"idiotic": 1.5})
    scorer = Scorer(lexicon)
    for _ in range(300):
        words = rng.choices(["river", "stone", "scum", "idiots", "worthles", "id1otic", "a", "scummy", "worthless"], weights=[9, 9, 1, 1, 1, 1, 3, 1, 1], k=rng.randint(0, 90))
        text = rng.choice([" ", ", ", "\n"]).join(words)
        assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(scorer.features(text), _plain_features(lexicon, text)))


def test_large_lexicons_and_long_words():
    import time

    rng = random.Random(12)
    terms = list(dict.fromkeys("".join(rng.choices("abcdefghijklmnop", k=rng.randint(5, 12))) for _ in range(4000)))
    lexicon = Lexicon(dict.fromkeys(terms, 1.0), {})
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 14))) for _ in range(3000)]
    began = time.process_time()
    found = lexicon.meet_all(words + [terms[0] + "x", "q" * 1_000_000, "abcdefgh" * 100_000])
    assert time.process_time() - began < 40 and found[3000] is not None and found[3001] is None
    for word in words[:40]:
        near = [(distance(word, t), t) for t in terms if abs(len(t) - len(word)) <= 2 and distance(word, t) <= edits_allowed(t)]
        want = min(near)[1] if near and len(word) >= 4 and word not in lexicon.words else None
        assert word in lexicon.words or lexicon.near(word) == want


def test_no_cap_on_terms(spark):
    """More telling words than any small number: all of them are terms, short and long ones too."""
    rng = random.Random(13)
    bad = ["".join(rng.choices("bcdfghjkmnpqrstvwxz", k=9)) for _ in range(60)] + ["zq", "x" * 60]
    plain = "river stone window garden paper letter moment summer yellow follow number travel".split()
    rows = [(" ".join([*rng.choices(plain, k=15), *(rng.sample(bad, 30) if i % 2 else [])]), i % 2) for i in range(300)]
    lexicon = learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert all(lexicon.meet(word) and lexicon.meet(word)[1] for word in bad)


def _corpus(spark):
    rng = random.Random(3)
    clean = "river stone window garden paper letter moment summer yellow follow number travel".split()
    bad = "zorgle blimfot skrunty grawbit".split()
    rows, labels = [], []
    for i in range(600):
        words = rng.choices(clean, k=rng.randint(5, 60))
        toxic = i % 7 == 0
        for _ in range(rng.randint(2, 5) if toxic else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    rows += [(700, None, None), (701, "", ""), (702, "zorgle " * 20, ""), (None, "a zorgle", None), (1, rows[1][1], "again")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, score string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = _corpus(spark)
    rows = toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert len(held) > 60 and right / len(held) > 0.95
    assert next(r.predicted for r in rows if r.doc_id == 702) == 1 and next(r.predicted for r in rows if r.doc_id == 701) == 0


def test_labels_of_the_held_out_fold_are_not_read(spark):
    from pyspark.sql import functions as F

    docs, labels = _corpus(spark)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {(r.doc_id, r.score) for r in toxicity(docs, labels).collect()}
    assert a == {(r.doc_id, r.score) for r in toxicity(docs, other).collect()}


def test_without_labels_or_rows(spark):
    docs, labels = _corpus(spark)
    assert {r.predicted for r in toxicity(docs, labels.where("toxic = 0")).collect()} == {0}
    assert toxicity(docs.limit(0), labels).count() == 0
