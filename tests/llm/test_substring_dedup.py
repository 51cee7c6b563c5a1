import re
from collections import Counter

from tamizal.llm.substring_dedup import remove_repeated_windows

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, window):
    words = [(i, WORD.findall((t or "").encode())) for i, t, *_ in rows]
    first = {}
    for i, ws in words:
        for k in range(len(ws) - window + 1) if i is not None else ():
            key = tuple(ws[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = Counter()
    for i, ws in words:
        gone = set()
        for k in range(len(ws) - window + 1) if i is not None else ():
            if first[tuple(ws[k : k + window])] < i:
                gone.update(range(k, k + window))
        out[i, len(ws), len(gone), b" ".join(w for k, w in enumerate(ws) if k not in gone).decode()] += 1
    return out


def test_same_as_brute_force(spark, docs):
    rows = [tuple(r) for r in docs.collect()]
    for window in (50, 1):
        got = Counter(tuple(r) for r in remove_repeated_windows(docs, window).collect())
        assert got == brute(rows, window)


def test_clashing_columns_and_no_rows(spark, docs, empty):
    clash = docs.withColumnsRenamed({"lang": "covered", "source": "row_key", "n_chars": "piece"})
    assert Counter(map(tuple, remove_repeated_windows(clash).collect())) == Counter(map(tuple, remove_repeated_windows(docs).collect()))
    assert remove_repeated_windows(empty).count() == 0


def test_a_crowd_of_copies(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(i, text if i % 3 else f"own{i} {text} end{i}") for i in range(600)]
    got = {r.doc_id: r.n_removed for r in remove_repeated_windows(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[0] == 0 and all(v == 80 for k, v in got.items() if k)
