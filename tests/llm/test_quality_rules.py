import re
from collections import Counter

from tamizal.llm.quality_rules import RULES, Rule, base_counts, cascade_order, quality_stage, quality_verdict


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    covered = {p for i, g in enumerate(grams) if often[g] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts(docs):
    for row in base_counts(docs).collect():
        want = brute(row.text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
        assert row.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_order_does_not_change_the_verdict(docs):
    forth = {(r.doc_id, r.text, r.kept) for r in quality_verdict(docs, RULES).collect()}
    back = {(r.doc_id, r.text, r.kept) for r in quality_verdict(docs, RULES[::-1], sample_rows=5).collect()}
    assert forth == back and {k for *_, k in forth} == {True, False}


def test_order_by_rejections_per_cost(docs):
    rules = (Rule("never", "n_words < 0"), Rule("always", "n_words >= 0"))
    assert [r.name for r in cascade_order(docs, rules)] == ["always", "never"]


def test_order_counts_what_is_left_and_what_it_costs(docs):
    # "part" rejects nothing that "all but few" leaves, though it rejects more than "rest" at first
    rules = (Rule("rest", "n_words < 12"), Rule("part", "n_words >= 30"), Rule("all but few", "n_words >= 12"))
    assert [r.name for r in cascade_order(docs, rules)] == ["all but few", "rest", "part"]
    slow = "length(regexp_replace(repeat(text, 20), '([a-z]+)[a-z ]*x', '')) >= 0"
    assert [r.name for r in cascade_order(docs, (Rule("slow", slow), Rule("fast", "n_words >= 0")))] == ["fast", "slow"]


def test_stage_keeps_columns_and_clean_rows(spark, docs, empty):
    clash = docs.withColumn("kept", docs.lang).withColumn("_words", docs.source).withColumn("judged_text", docs.lang)
    kept = quality_stage(spark, clash, "")
    assert kept.columns == clash.columns
    texts = {r.doc_id for r in kept.collect()}
    assert texts and None in texts and 51 not in texts
    assert quality_stage(spark, empty, "").count() == 0
