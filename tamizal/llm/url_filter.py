"""URL filter: rules first, and gradient-boosted trees on lexical features for what no rule decides.

A URL is described by integers: lengths, depth, digits, entropy, parameters, and statistics of its host's
suffix. The trees are grown in Spark on a bounded sample of labelled URLs: each level is one grouped sum of
gradients per node, feature and bin, and the driver reads those sums (nodes x features x bins) to choose the
splits. Gradients are fixed-point integers, so that a sum, and with it every split, does not depend on the
order of rows. Scores are nested conditions over columns: nothing here leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamizal.llm.common import free_name, table, written

SAMPLE_URLS = 20_000  # labelled URLs the trees are fitted on, about; statistics of suffixes cover all rows
TREES = 12
DEPTH = 3
BINS = 16
RATE = 0.3
SMOOTH = 1.0  # added to a node's second derivatives
POINT = 1 << 20
SUFFIX_LABELS = 2
FEATURES = (
    "length", "host_length", "host_labels", "depth", "longest_segment", "digits", "entropy", "parameters", "suffix_share", "suffix_count",
)


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    host = F.regexp_extract(_after(url), "^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    return F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of ``text`` and ``verdict``; null if none does."""
    cases = []
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        cases.append(F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))))
    return F.coalesce(*cases, F.lit(None).cast("struct<text:string,verdict:string>"))


def suffix_of(host: Column, labels: int = SUFFIX_LABELS) -> Column:
    return F.substring_index(host, ".", -labels)


def _entropy(text: Column) -> Column:
    """Thousandths of a bit per character: equal characters stand together, and runs are counted once."""
    chars = F.array_sort(F.split(text, ""))
    size = F.length(text).cast("double")
    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("bits"))

    def bits(state: Column) -> Column:
        share = state["run"] / size
        return F.when(state["run"] > 0, state["bits"] - share * F.log2(share)).otherwise(state["bits"])

    def step(state: Column, char: Column) -> Column:
        same = char == state["last"]
        return F.struct(
            char.alias("last"),
            F.when(same, state["run"] + 1).otherwise(F.lit(1.0)).alias("run"),
            F.when(same, state["bits"]).otherwise(bits(state)).alias("bits"),
        )

    return F.when(size > 0, F.round(F.aggregate(chars, start, step, bits) * 1000)).otherwise(0).cast("bigint")


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """The features that a URL alone gives. Null is the empty URL."""
    text = F.coalesce(url, F.lit(""))
    size = F.length(text)
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    query = F.regexp_extract(text, r"^[^?#]*\?([^#]*)", 1)
    digits = size - F.length(F.translate(text, "0123456789", ""))
    found = {
        "length": size,
        "host_length": F.length(host),
        "host_labels": F.size(F.filter(F.split(host, r"\."), lambda s: s != "")),
        "depth": F.size(segments),
        "longest_segment": F.coalesce(F.array_max(F.transform(segments, F.length)), F.lit(0)),
        "digits": F.when(size > 0, F.floor(digits * 1000 / size)).otherwise(0),
        "entropy": _entropy(text),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda s: s != "")),
    }
    return {name: column.cast("bigint") for name, column in found.items()}


def _share(blocked: Column, known: Column) -> Column:
    """Blocked per thousand, drawn to a half where little is known; half for an unknown suffix."""
    b, n = F.coalesce(blocked, F.lit(0)), F.coalesce(known, F.lit(0))
    return F.floor((b * 1000 + 500) / (n + 1)).cast("bigint")


def _log_count(n: Column) -> Column:
    return F.floor(F.log2(F.coalesce(n, F.lit(0)) + 1.0) * 1000).cast("bigint")


@dataclass
class Trees:
    """Sum of trees: a tree is (feature, bound, left, right) or a leaf in fixed point."""

    start: int
    trees: list

    def score(self, columns: Sequence[Column]) -> Column:
        total = F.lit(self.start).cast("bigint")
        for tree in self.trees:
            total = total + _value(tree, columns)
        return total

    def chance(self, columns: Sequence[Column]) -> Column:
        return 1 / (1 + F.exp(-self.score(columns).cast("double") / POINT))


def _place(value: Column, bounds: Sequence[int]) -> Column:
    """Place of the first bound that is not below ``value``."""
    return F.size(F.filter(F.array(*[F.lit(b).cast("bigint") for b in bounds]), lambda bound: bound < value))


def _value(tree, columns: Sequence[Column]) -> Column:
    if isinstance(tree, int):
        return F.lit(tree).cast("bigint")
    feature, bound, left, right = tree
    return F.when(columns[feature] <= bound, _value(left, columns)).otherwise(_value(right, columns))


def _node(tree, columns: Sequence[Column], number: int = 1) -> Column:
    """Number of the open leaf (None in the tree) a row is in; 0 for a closed one."""
    if tree is None:
        return F.lit(number)
    if isinstance(tree, int):
        return F.lit(0)
    feature, bound, left, right = tree
    return F.when(columns[feature] <= bound, _node(left, columns, 2 * number)).otherwise(_node(right, columns, 2 * number + 1))


def _split(bins: dict[int, dict[int, tuple[int, int]]], bounds: list[list[int]], smooth: float):
    """(gain, feature, bound, left sums, right sums) of the best split; the first of equal ones. None: none gains."""
    total_g, total_h = (sum(v[i] for v in bins[0].values()) for i in (0, 1))
    best = None
    for feature in range(len(bounds)):
        g = h = 0
        for place, bound in enumerate(bounds[feature]):
            more = bins[feature].get(place, (0, 0))
            g, h = g + more[0], h + more[1]
            if h == 0 or h == total_h:
                continue
            gain = g * g / (h + smooth * POINT) + (total_g - g) ** 2 / (total_h - h + smooth * POINT) - total_g**2 / (total_h + smooth * POINT)
            if gain > 1e-9 and (best is None or gain > best[0]):
                best = (gain, feature, bound, (g, h), (total_g - g, total_h - h))
    return best


def fit_trees(
    rows: DataFrame, features: Sequence[str], label: str, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE,
    smooth: float = SMOOTH,
) -> Trees:
    """Boosted trees for a 0/1 ``label`` over integer ``features``, by logistic loss.

    ``rows`` is read once per level and tree: a bounded sample, written down. Bounds of a feature are its
    quantiles among the rows. No rows give a chance of a half, rows of one label give that label's side.
    """
    quantiles = F.array(*[F.lit((i + 1) / bins) for i in range(bins - 1)])
    first = rows.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(label), F.lit(0)), *[F.approx_percentile(f, quantiles, 1_000_000) for f in features]
    ).first()
    count, positive = int(first[0]), int(first[1])
    odds = F.log((F.lit(positive) + 0.5) / (F.lit(count - positive) + 0.5)) * POINT
    model = Trees(int(rows.sparkSession.range(1).select(F.round(odds).cast("bigint")).first()[0]), [])
    if count == 0 or positive in (0, count):
        return model
    bounds = [sorted(set(b)) for b in first[2:]]
    columns = [F.col(f) for f in features]
    places = [_place(value, of) for value, of in zip(columns, bounds)]
    placed = rows.select(*columns, F.col(label).cast("int").alias("_label"), F.array(*places).alias("_places"))
    for _ in range(trees):
        chance = model.chance(columns)
        g = F.round((F.col("_label") - chance) * POINT).cast("bigint")
        h = F.round(chance * (1 - chance) * POINT).cast("bigint")
        held = placed.select(*columns, "_places", g.alias("_g"), h.alias("_h"))
        tree = None
        for level in range(depth):
            at = held.withColumn("_node", _node(tree, columns)).where("_node > 0")
            sums = (
                at.select("_node", "_g", "_h", F.posexplode("_places").alias("_feature", "_place"))
                .groupBy("_node", "_feature", "_place")
                .agg(F.sum("_g"), F.sum("_h"))
                .collect()
            )
            nodes: dict[int, dict[int, dict[int, tuple[int, int]]]] = {}
            for node, feature, place, sum_g, sum_h in sums:
                nodes.setdefault(node, {f: {} for f in range(len(features))})[feature][place] = (sum_g, sum_h)
            grown = {node: _split(found, bounds, smooth) for node, found in nodes.items()}
            tree = _grow(tree, grown, nodes, 1, level + 1 == depth, rate, smooth)
        model.trees.append(tree)
    return model


def _leaf(g: int, h: int, rate: float, smooth: float) -> int:
    return round(rate * g / (h + smooth * POINT) * POINT)


def _grow(tree, grown: dict, nodes: dict, number: int, last: bool, rate: float, smooth: float):
    """The tree with its open leaves split, or closed where nothing is gained or the depth is reached."""
    if isinstance(tree, int):
        return tree
    if tree is not None:
        feature, bound, left, right = tree
        return feature, bound, *(_grow(t, grown, nodes, n, last, rate, smooth) for t, n in ((left, 2 * number), (right, 2 * number + 1)))
    split = grown.get(number)
    if split is None:
        found = nodes.get(number, {0: {}})[0].values()
        return _leaf(sum(g for g, _ in found), sum(h for _, h in found), rate, smooth)
    _, feature, bound, left, right = split
    if last:
        return feature, bound, _leaf(*left, rate, smooth), _leaf(*right, rate, smooth)
    return feature, bound, None, None


def judge_urls(
    pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[Rule] = RULES, url: str = "url", sample: int = SAMPLE_URLS,
    trees: int = TREES, depth: int = DEPTH,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``score`` (chance of block, 0 to 1).

    A rule decides where one fits (the longest), else the trees: block at 0.5 or more. ``labelled`` (``url`` and a
    0/1 ``blocked``) trains them; without it the URLs that rules decide are the labelled ones. Each distinct labelled
    URL counts once (a contradiction counts as blocked); if there are more than ``sample``, those of the smallest
    hashes are fitted on, while the suffix statistics are of all labelled URLs and of all rows. Labelled URLs are in two
    halves by hash, and a sampled URL's suffix share is that of the other half, so that it does not tell its own label. Null and malformed URLs have empty host and path and are judged by the trees;
    with no labelled URLs they are allowed. Columns of ``pages`` with a new column's name give way to it.
    """
    new = ("host", "path", "rule", "verdict", "score")
    kept = [c for c in pages.columns if c.lower() not in new or c == url]
    rows = pages.select(*[F.col(f"`{c}`") for c in kept])
    names = {n: free_name(rows, f"_{n}") for n in ("host", "path", "rule", "suffix", "n", "known", "blocked", *FEATURES)}
    link = F.col(f"`{url}`").cast("string")
    rows = rows.withColumns({names["host"]: host_of(link), names["path"]: path_of(link)})
    rows = rows.withColumns({names["rule"]: rule_of(F.col(names["host"]), F.col(names["path"]), rules), names["suffix"]: suffix_of(F.col(names["host"]))})
    # every distinct URL once for training, every row for the counts
    if labelled is None:
        ruled = rows.where(F.col(names["rule"]).isNotNull())
        labelled = ruled.select(link.alias("url"), (F.col(f"{names['rule']}.verdict") == "block").cast("int").alias("blocked"))
    known = written(labelled.where("url IS NOT NULL").groupBy("url").agg(F.max("blocked").cast("int").alias("blocked")), "url-labels")
    known = known.withColumn("suffix", suffix_of(host_of(F.col("url"))))
    counts = rows.groupBy(F.col(names["suffix"]).alias("suffix")).agg(F.count(F.lit(1)).alias("n"))
    known = known.withColumn("half", F.pmod(F.xxhash64("url", F.lit("half")), F.lit(2)))
    first = F.col("half") == 0
    shares = known.groupBy("suffix").agg(
        F.count(F.lit(1)).alias("known"), F.sum("blocked").alias("bad"), F.count_if(first).alias("known_0"), F.sum(F.when(first, F.col("blocked")).otherwise(0)).alias("bad_0")
    )
    suffixes = written(counts.join(shares, "suffix", "full"), "url-suffixes")
    total = suffixes.agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0]
    part = 1.0 if total <= sample else sample / total
    picked = known.where(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < round(part * (1 << 30))).join(suffixes, "suffix")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    other = [F.when(first, F.col(c) - F.col(f"{c}_0")).otherwise(F.col(f"{c}_0")) for c in ("bad", "known")]
    own = {**lexical(F.col("url"), host, path), "suffix_share": _share(*other), "suffix_count": _log_count(F.col("n"))}
    fitted = written(picked.select("blocked", *[own[f].alias(f) for f in FEATURES]), "url-sample")
    model = fit_trees(fitted, FEATURES, "blocked", trees, depth)
    met = suffixes.select(
        F.col("suffix").alias(names["suffix"]), F.col("n").alias(names["n"]), F.col("known").alias(names["known"]), F.col("bad").alias(names["blocked"])
    )
    rows = rows.join(met, names["suffix"], "left")
    described = {
        **lexical(link, F.col(names["host"]), F.col(names["path"])),
        "suffix_share": _share(F.col(names["blocked"]), F.col(names["known"])),
        "suffix_count": _log_count(F.col(names["n"])),
    }
    rows = rows.withColumns({names[f]: described[f] for f in FEATURES})
    score = model.chance([F.col(names[f]) for f in FEATURES]) if total else F.lit(0.0)
    rows = rows.withColumn(free_name(rows, "score"), score)
    blocked = F.when(F.col(rows.columns[-1]) >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        *[F.col(f"`{c}`") for c in kept if c.lower() not in new or c == url],
        F.col(names["host"]).alias("host"),
        F.col(names["path"]).alias("path"),
        F.col(f"{names['rule']}.text").alias("rule"),
        F.coalesce(F.col(f"{names['rule']}.verdict"), blocked).alias("verdict"),
        F.col(rows.columns[-1]).alias("score"),
    )


def op12_url_filter(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
