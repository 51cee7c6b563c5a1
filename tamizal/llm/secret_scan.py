"""Secret scan: patterns with known shapes, and sliding-window entropy over long candidate strings.

Everything is a built-in expression over one row: matches come from ``regexp_extract_all``, their
places from the lengths of the pieces between them, and the entropy of a window from counts that one
character enters and one leaves at each step. A run is one scan without a shuffle.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamizal.llm.common import free_name, table

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_CHARS = 12
# A run is taken whole, so a longer minimum is the same as dropping the short matches.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"

CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
# Bits per character that a window must reach, by the class of its candidate: first match counts.
CLASSES = (
    ("^[0-9a-fA-F]+$", 3.0),
    ("^(?=.*[0-9])(?=.*[A-Za-z])", 3.7),
    ("", 4.1),
)
ALLOWED = (
    "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # identifiers
    "^[A-Za-z][a-z]*([-_/=+]+[A-Za-z]?[a-z]*)*$",  # words and paths of words
    "^[A-Z]+([-_/=+]+[A-Z]*)*$",
    "^[0-9]+([-_/=+]+[0-9]*)*$",  # numbers, dates
    "(?i)example|sample|placeholder|changeme|xxxx",
)
# c * log2(c) for the counts of a window, in fixed point: sums are exact and do not drift
_POINT = 1 << 20
_PLOGP = [round(c * math.log2(c) * _POINT) if c else 0 for c in range(WINDOW + 1)]
# counts of a window, at most 20 each, packed into 64-bit words
_COUNT_BITS = 5
_PER_WORD = 12
_WORDS = -(-len(ALPHABET) // _PER_WORD)
MASK = "[SECRET]"

_SPANS = "array<struct<start:int,kind:int,end:int,found:string>>"


def _placed(matches: str, pieces: str, kind: int) -> Column:
    """(start, kind, end, text) of each match, from the pieces of text before and between matches."""
    none = F.struct(F.lit(0).alias("at"), F.from_json(F.lit("[]"), _SPANS).alias("spans"))

    def step(done: Column, i: Column) -> Column:
        found = F.get(matches, i)
        start = done["at"] + F.length(F.get(pieces, i))
        end = start + F.length(found)
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), found.alias("found"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    listed = F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), none, step, lambda done: done["spans"])
    return F.when(F.size(matches) > 0, listed).otherwise(F.from_json(F.lit("[]"), _SPANS))


def _hot_range(candidate: Column) -> Column:
    """From the first to the last window of ``candidate`` that reaches its class's entropy; null if none.

    The candidate is taken apart into codes once, and every code stands beside the one that leaves when it
    enters; a step changes two counts and never looks at the text again, so the cost follows the length.
    """
    needed = F.lit(None).cast("bigint")
    for pattern, bits in reversed(CLASSES):
        most = round((math.log2(WINDOW) - bits) * WINDOW * _POINT)  # H >= bits: sum of c log c at most this
        needed = F.when(candidate.rlike(pattern), F.lit(most)).otherwise(needed)
    table_ = F.array(*[F.lit(v).cast("bigint") for v in _PLOGP])

    def coded(char: Column) -> Column:
        """Where the count of a character is kept: five bits of one of the words."""
        code = F.instr(F.lit(ALPHABET), char) - 1
        shift = (code % _PER_WORD) * _COUNT_BITS
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)
        return F.struct(code.alias("code"), F.floor(code / _PER_WORD).cast("int").alias("word"), shift.alias("shift"), one.alias("one"))

    codes = F.transform(F.split(candidate, ""), coded)
    none = F.lit(None).cast("struct<code:int,word:int,shift:int,one:bigint>")
    before = F.concat(F.array_repeat(none, WINDOW), F.slice(codes, F.lit(1), F.greatest(F.length(candidate) - WINDOW, F.lit(0))))
    pairs = F.slice(F.zip_with(codes, before, lambda e, l: F.struct(e.alias("enters"), l.alias("leaves"))), F.lit(1), F.length(candidate))
    zero = F.struct(
        F.array_repeat(F.lit(0).cast("bigint"), _WORDS).alias("counts"),
        F.lit(0).cast("bigint").alias("total"),
        F.lit(0).alias("at"),
        needed.alias("needed"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )

    def count(state: Column, of: Column) -> Column:
        word = F.call_function("shiftright", F.get(state["counts"], of["word"]), of["shift"])
        return word.bitwiseAND(F.lit((1 << _COUNT_BITS) - 1).cast("bigint")).cast("int")

    def step(state: Column, pair: Column) -> Column:
        enters, leaves = pair["enters"], pair["leaves"]
        more, fewer = count(state, enters), count(state, leaves)
        gained = F.get(table_, more + 1) - F.get(table_, more)
        lost = F.coalesce(F.get(table_, fewer) - F.get(table_, fewer - 1), F.lit(0))
        same = F.coalesce(enters["code"] == leaves["code"], F.lit(False))
        total = F.when(same, state["total"]).otherwise(state["total"] + gained - lost)
        nought = F.lit(0).cast("bigint")
        counts = F.when(same, state["counts"]).otherwise(
            F.transform(
                state["counts"],
                lambda c, k: c + F.when(k == enters["word"], enters["one"]).otherwise(nought) - F.when(k == leaves["word"], leaves["one"]).otherwise(nought),
            )
        )
        return F.struct(
            counts.alias("counts"),
            total.alias("total"),
            (state["at"] + 1).alias("at"),
            state["needed"].alias("needed"),
            state["first"].alias("first"),
            state["last"].alias("last"),
        )

    def marked(state: Column) -> Column:
        """After a step: whether the window that ends here is hot."""
        hot = (state["at"] >= WINDOW) & (state["total"] <= state["needed"])
        return F.struct(
            state["counts"].alias("counts"),
            state["total"].alias("total"),
            state["at"].alias("at"),
            state["needed"].alias("needed"),
            F.coalesce(state["first"], F.when(hot, state["at"] - WINDOW)).alias("first"),
            F.when(hot, state["at"]).otherwise(state["last"]).alias("last"),
        )

    # the window that ended before a step is judged as the step begins, so that its total is made once
    return F.aggregate(
        pairs, zero, lambda state, pair: step(marked(state), pair), lambda s: F.struct(marked(s)["first"].alias("first"), marked(s)["last"].alias("last"))
    )


def _allowed(candidate: Column) -> Column:
    """One of ``ALLOWED`` fits. Those with repeated groups are asked of the characters, since a group costs
    the pattern machine a level of its stack at every repetition: the same strings fit."""
    first, small, capitals, digits, words = ALLOWED
    asked = {
        first: candidate.rlike(first),
        small: candidate.rlike("^[A-Za-z][A-Za-z_/=+-]*$") & ~candidate.rlike("[A-Za-z][A-Z]"),
        capitals: candidate.rlike("^[A-Z][A-Z_/=+-]*$"),
        digits: candidate.rlike("^[0-9][0-9_/=+-]*$"),
        words: candidate.rlike(words),
    }
    return reduce(or_, asked.values())


def _entropy_spans(candidates: Column, base: Column) -> Column:
    """Hot ranges of candidates that are not allowed and do not lie in a span of ``base``."""
    suspect = F.filter(candidates, lambda c: ~_allowed(c["found"]))
    ranges = F.transform(
        suspect, lambda c: F.struct(c["start"].alias("start"), c["found"].alias("found"), _hot_range(c["found"]).alias("hot"))
    )
    spans = F.transform(
        F.filter(ranges, lambda r: r["hot"]["first"].isNotNull()),
        lambda r: F.struct(
            (r["start"] + r["hot"]["first"]).alias("start"),
            F.lit(len(KINDS) - 1).alias("kind"),
            (r["start"] + r["hot"]["last"]).alias("end"),
            F.substr(r["found"], r["hot"]["first"] + 1, r["hot"]["last"] - r["hot"]["first"]).alias("found"),
        ),
    )
    return F.filter(spans, lambda s: ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"])))


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``secrets``: sorted spans (``start``, ``kind``, ``end``, ``found``), in code points.

    ``kind`` is the place in ``KINDS``. A null text is empty and has no spans, as has an empty one;
    matches of different kinds may overlap, and every repeat is a span of its own. A column of ``docs``
    named ``secrets`` is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != "secrets"]
    names = {n: free_name(docs, f"secret_{n}") for n in ("text", "lower")}
    text, lower = names["text"], names["lower"]
    work = docs.select(*kept, F.coalesce("text", F.lit("")).alias(text)).withColumn(lower, F.lower(text))
    keyword = F.lit(False)
    for word in ASSIGN_WORDS:
        keyword = keyword | F.contains(F.col(lower), F.lit(word))
    wanted = {
        "assign": (ASSIGN, keyword),
        "access": (ACCESS, F.contains(F.col(text), F.lit("AKIA"))),
        "hex": (HEX, F.lit(True)),
        "candidate": (CANDIDATE, F.lit(True)),
    }
    found = {k: (free_name(docs, f"{k}_matches"), free_name(docs, f"{k}_pieces")) for k in wanted}
    for kind, (pattern, possible) in wanted.items():
        none = F.array().cast("array<string>")
        matches = F.when(possible, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
        work = work.withColumn(found[kind][0], matches)
    for kind, (pattern, _) in wanted.items():
        matches, pieces = found[kind]
        work = work.withColumn(pieces, F.when(F.size(matches) > 0, F.split(text, pattern, -1)))
    value = free_name(docs, "assign_value")
    work = work.withColumn(
        value, F.when(F.size(found["assign"][0]) > 0, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)))
    )
    placed = {k: free_name(docs, f"{k}_spans") for k in wanted}
    for k in wanted:
        spans = _placed(*found[k], KINDS.index(k) if k in KINDS else len(KINDS) - 1)
        if k == "assign":
            spans = F.filter(spans, lambda _, i: F.length(F.get(value, i)) >= ASSIGN_CHARS)
        work = work.withColumn(placed[k], spans)
    base = free_name(docs, "base_spans")
    work = work.withColumn(base, F.concat(*[F.col(placed[k]) for k in KINDS[:-1]]))
    entropy = F.when(F.size(placed["candidate"]) > 0, _entropy_spans(F.col(placed["candidate"]), F.col(base)))
    spans = F.sort_array(F.concat(F.col(base), F.coalesce(entropy, F.from_json(F.lit("[]"), _SPANS))))
    return work.select(*kept, spans.alias("secrets"))


def _named(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span, or run of overlapping spans, replaced by ``MASK``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        fresh = span["start"] >= done["at"]
        gap = F.substr(text, done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        out = F.when(fresh, F.concat(done["out"], gap, F.lit(MASK))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), out.alias("out"))

    return F.aggregate(
        spans, start, step, lambda done: F.concat(done["out"], F.substr(text, done["at"] + 1, F.length(text)))
    )


def _count(kind: int) -> Column:
    return F.size(F.filter("secrets", lambda span: span["kind"] == kind)).cast("bigint")


def op8_secret_scan(spark, sf_dir):
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] < len(KINDS) - 1)
    counts = [_count(KINDS.index(kind)).alias(f"n_{kind}") for kind in KINDS[:-1]]
    return found.select(
        "doc_id", *counts, F.sha2(_named(base), 256).alias("base_sha256"), _named(F.col("secrets")).alias("spans")
    )


def secret_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in a text are masked, and ``n_chars`` follows the text."""
    key, masked = free_name(docs, "scanned_row"), free_name(docs, "masked_text")
    found = find_secrets(docs.select(F.struct(*docs.columns).alias(key), "text"))
    hit = F.size("secrets") > 0
    found = found.withColumn(masked, F.when(hit, redacted(F.col("text"), F.col("secrets"))).otherwise(F.col("text")))
    changed = {"text": F.col(masked)}
    if "n_chars" in docs.columns:
        kind, old = docs.schema["n_chars"].dataType, F.col(f"{key}.n_chars")
        changed["n_chars"] = F.when(hit, F.length(masked).cast(kind)).otherwise(old)
    return found.select(*[changed.get(c, F.col(f"{key}.{c}")).alias(c) for c in docs.columns])


def _oracle() -> str:
    """The same scan as SQL: places from the lengths of the pieces, entropies of whole windows."""

    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def spans(kind: str, pattern: str, keep: str = "true") -> str:
        return f"""{kind}_found AS (
    SELECT doc_id, regexp_extract_all(t, {quoted(pattern)}) AS ms, string_split_regex(t, {quoted(pattern)}) AS ps,
           regexp_extract_all(t, {quoted(pattern)}, {2 if kind == "assign" else 0}) AS vs FROM d
), {kind} AS (
    SELECT doc_id, '{kind}' AS kind, s, s + length(found) AS e, found FROM (
        SELECT doc_id, ms[i] AS found, vs[i] AS value,
               list_sum(list_transform(ps[1:i], lambda x: length(x)))
               + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s
        FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM {kind}_found)
    ) WHERE {keep}
)"""

    allowed = " OR ".join(f"regexp_matches(found, {quoted(p)})" for p in ALLOWED)
    bits = (
        f"CASE WHEN regexp_matches(found, '{CLASSES[0][0]}') THEN {CLASSES[0][1]} "
        f"WHEN regexp_matches(found, '[0-9]') AND regexp_matches(found, '[A-Za-z]') THEN {CLASSES[1][1]} ELSE {CLASSES[2][1]} END"
    )
    steps = [
        "d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)",
        spans("assign", ASSIGN, f"length(value) >= {ASSIGN_CHARS}"),
        spans("access", ACCESS),
        spans("hex", HEX),
        spans("candidate", CANDIDATE),
        """base AS (
    SELECT doc_id, 0 AS k, kind, s, e FROM assign UNION ALL SELECT doc_id, 1, kind, s, e FROM access
    UNION ALL SELECT doc_id, 2, kind, s, e FROM hex
)""",
        f"""hot AS (
    SELECT doc_id, s + min(w) - 1 AS s, s + max(w) - 1 + {WINDOW} AS e
    FROM (SELECT doc_id, s, found, {bits} AS bits, unnest(range(1, length(found) - {WINDOW - 2})) AS w FROM candidate WHERE NOT ({allowed})) c
    WHERE list_aggregate(string_split(substring(found, w, {WINDOW}), ''), 'entropy') >= bits
    GROUP BY doc_id, c.s, found
)""",
        """every AS (
    SELECT * FROM base UNION ALL
    SELECT doc_id, 3, 'entropy', s, e FROM hot
    WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = hot.doc_id AND b.s <= hot.s AND b.e >= hot.e)
)""",
    ]
    return (
        "WITH "
        + ",\n".join(steps)
        + """
SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
       sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER (k < 3), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e), '') AS spans
FROM d LEFT JOIN every USING (doc_id) GROUP BY doc_id
"""
    )


OP8_SQL = _oracle()
