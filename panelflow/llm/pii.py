"""Personal data by candidate gradient boosting (operator 6); DataFrame functions only.

BASE finds the spans every text must give. GENERATORS are looser patterns
that propose further, overlapping spans. Each proposal is described by a few
small whole numbers about its format and its context; counting proposals by
these numbers, and how many of them touch a base span, over all texts gives
a table whose size the numbers' ranges bound. Boosted trees are fitted to
that table, turned into a SQL expression, and a threshold for each kind is
set where the counted precision reaches PRECISION. Proposals that pass,
touch no base span and lose to no better proposal are added.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")        # the order in which equal starts are listed

# The contracts' patterns; possessive repeats and starts at a run's head keep them linear on any text.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a match must pass, over its text t.
_DIGITS = "length(regexp_replace(t, '[^0-9]', ''))"
CHECKS = {
    "email": "true",
    "ip": r"forall(split(t, '[.]'), p -> length(ltrim('0', p)) < 3 or length(ltrim('0', p)) = 3 and ltrim('0', p) <= '255')",
    "card": f"{_DIGITS} between 14 and 19 and aggregate(sequence(1, {_DIGITS}), 0, (n, i) -> n + element_at(array(0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 0, 2, 4, 6, 8, 1, 3, 5, 7, 9), "
            "cast(substring(regexp_replace(t, '[^0-9]', ''), -i, 1) as int) + if(i % 2 = 0, 10, 0) + 1)) % 10 = 0",
    "phone": f"{_DIGITS} between 10 and 15",
}
GENERATORS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)*+",
    "ip": r"(?:(?<![0-9A-Fa-f:])|\G)(?:[0-9A-Fa-f]{1,4}:){3,7}+[0-9A-Fa-f]{1,4}",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[ ./-]?[0-9]){12,18}+",
    "phone": r"(?:(?<![0-9])|\G)(?:\([0-9]{2,4}+\)[ .-]?|[0-9]{2,4}+[ .-])[0-9]{2,4}+(?:[ .-][0-9]{2,4}+){0,3}+",
}
# What a text holds if the pattern can match at all; cheaper to look for than the pattern.
_DIGIT = "text rlike '[0-9]'"
HINTS = {
    "email": "contains(text, '@')", "ip": _DIGIT, "card": _DIGIT, "phone": "contains(text, '+')",
    "email ": "(contains(text, '@') or contains(text, '(at)') or contains(text, '[at]'))",
    "ip ": "text rlike ':[0-9A-Fa-f]{1,4}:'", "card ": _DIGIT, "phone ": _DIGIT,
}
CONTEXT = r"(?i)tel|phone|call|fax|mail|card|visa|address|contact|\bip\b"
# Format and context of a proposal p (kind k, text t, b before, a after), and the largest value of each.
_NEIGHBOUR = r"case when {0} = '' or {0} = '\n' then 0 when {0} = ' ' then 1 when {0} rlike '[0-9]' then 2 when {0} rlike '[A-Za-z]' then 3 else 4 end"
FEATURES = {
    "k": ("k", 3),
    "digits": ("least(20, length(regexp_replace(t, '[^0-9]', '')))", 20),
    "groups": ("least(6, size(split(t, '[^A-Za-z0-9]+')))", 6),
    "parens": ("cast(t like '(%' as int)", 1),
    "left_": (_NEIGHBOUR.format("right(b, 1)"), 4),
    "right_": (_NEIGHBOUR.format("a"), 4),
    "context": (f"cast(b rlike '{CONTEXT}' as int)", 1),
}
TREES, DEPTH, RATE, PRECISION = 24, 2, 0.4, 0.9


def _quoted(pattern: str) -> str:
    return "r'" + pattern + "'"


def _spans(m: str, gaps: str) -> str:
    """SQL of array<struct<s, e, t, b, a>>: places and neighbours of matches ``m`` between ``gaps``."""
    kind = "struct<at:int,out:array<struct<s:int,e:int,t:string,b:string,a:string>>>"
    return f"""if(size({m}) = 0, cast(array() as array<struct<s:int,e:int,t:string,b:string,a:string>>),
        aggregate(sequence(1, size({m})), cast(named_struct('at', 0, 'out', array()) as {kind}), (x, i) -> named_struct(
            'at', x.at + length({gaps}[i - 1]) + length({m}[i - 1]),
            'out', concat(x.out, array(named_struct('s', x.at + length({gaps}[i - 1]), 'e', x.at + length({gaps}[i - 1]) + length({m}[i - 1]),
                't', {m}[i - 1], 'b', right({gaps}[i - 1], 24), 'a', left({gaps}[i], 1))))), x -> x.out))"""


def _over(var: str, sql: str) -> str:
    """``sql`` over the fields t, b, a and k, read from the struct ``var``."""
    return re.sub(r"(?<![\w'.])([tbak])(?![\w'(.])", rf"{var}.\1", sql)


def _all_spans(docs: DataFrame) -> DataFrame:
    """doc_id, base: array of (s, k, e); proposed: array of (s, k, e, t, b, a), for docs(doc_id, text)."""
    found = {f"b{i}": (BASE[k], HINTS[k]) for i, k in enumerate(KINDS)} | {f"g{i}": (GENERATORS[k], HINTS[k + " "]) for i, k in enumerate(KINDS)}
    none = "cast(array() as array<string>)"
    hints = {h: f"h{i}" for i, h in enumerate(dict.fromkeys(h for _, h in found.values()))}
    df = docs.select("doc_id", "text", *[F.expr(h).alias(n) for h, n in hints.items()])
    df = df.select("doc_id", "text", *[F.expr(f"if({hints[h]}, regexp_extract_all(text, {_quoted(p)}, 0), {none})").alias(f"m_{n}") for n, (p, h) in found.items()])
    df = df.select("doc_id", *[f"m_{n}" for n in found], *[F.expr(f"if(size(m_{n}) = 0, null, split(text, {_quoted(p)}, -1))").alias(f"s_{n}") for n, (p, _) in found.items()])
    df = df.select("doc_id", *[F.expr(_spans(f"m_{n}", f"s_{n}")).alias(n) for n in found])
    base = ", ".join(f"transform(filter(b{i}, x -> {_over('x', CHECKS[k])}), x -> named_struct('s', x.s, 'k', {i}, 'e', x.e))" for i, k in enumerate(KINDS))
    more = ", ".join(f"transform(g{i}, x -> named_struct('s', x.s, 'k', {i}, 'e', x.e, 't', x.t, 'b', x.b, 'a', x.a))" for i in range(len(KINDS)))
    return df.selectExpr("doc_id", f"sort_array(concat({base})) as base", f"concat({more}) as proposed")


def _features(var: str) -> str:
    return "named_struct(" + ", ".join(f"'{n}', cast({_over(var, sql)} as int)" for n, (sql, _) in FEATURES.items()) + ")"


def counted(spans: DataFrame) -> DataFrame:
    """How many proposals have each combination of features (n), and how many touch a base span (y)."""
    rows = spans.where("size(proposed) > 0").selectExpr(
        f"explode(transform(proposed, p -> named_struct('f', {_features('p')}, 'y', exists(base, q -> q.s < p.e and p.s < q.e)))) as r")
    return rows.groupBy(F.col("r.f").alias("f")).agg(F.count("*").alias("n"), F.sum(F.col("r.y").cast("int")).alias("y")).select("f.*", "n", "y")


def _fit(x: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[list, np.ndarray]:
    """Trees ((feature, cut) or leaf value, nested) boosted on counts, and the margin of each row."""
    margin, trees = np.zeros(len(n)), []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
        best, gain = None, 1e-6
        if depth:
            score = g[rows].sum() ** 2 / (h[rows].sum() + 1)
            for f in range(x.shape[1]):
                for cut in np.unique(x[rows, f])[:-1]:
                    low = rows[x[rows, f] <= cut]
                    high = rows[x[rows, f] > cut]
                    now = sum(g[r].sum() ** 2 / (h[r].sum() + 1) for r in (low, high)) - score
                    if now > gain:
                        best, gain = (f, int(cut), low, high), now
        if best is None:
            value = float(RATE * g[rows].sum() / (h[rows].sum() + 1))
            margin[rows] += value
            return value
        f, cut, low, high = best
        return f, cut, grow(low, g, h, depth - 1), grow(high, g, h, depth - 1)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        trees.append(grow(np.arange(len(n)), y - n * p, n * p * (1 - p), DEPTH))
    return trees, margin


def _sql(tree) -> str:
    if isinstance(tree, float):
        return repr(tree) + "D"
    names = list(FEATURES)
    return f"if(f.{names[tree[0]]} <= {tree[1]}, {_sql(tree[2])}, {_sql(tree[3])})"


def model(table: list) -> tuple[str, list[float]]:
    """SQL of a proposal's margin over its features f, and each kind's threshold (infinite: none is added)."""
    if not table:
        return "0D", [float("inf")] * len(KINDS)
    table = sorted(table, key=tuple)
    x, n, y = (np.array([[r[c] for c in FEATURES] for r in table]), np.array([r["n"] for r in table], float), np.array([r["y"] for r in table], float))
    trees, margin = _fit(x, n, y)
    cuts = []
    for k in range(len(KINDS)):
        rows = np.flatnonzero(x[:, 0] == k)
        rows = rows[np.argsort(-margin[rows], kind="stable")]
        good = np.flatnonzero(np.cumsum(y[rows]) >= PRECISION * np.cumsum(n[rows]))
        cuts.append(float(margin[rows[good[-1]]]) if len(good) else float("inf"))
    return " + ".join(_sql(t) for t in trees), cuts


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans): arrays of (s, k, e) by start, then kind; code points, end exclusive; k counts KINDS.

    ``spans`` holds the base spans and the method's. A null text is empty;
    an empty one has no spans; repeated rows each come back; other columns
    play no part. An empty table gives no rows and learns nothing.
    """
    spans = _all_spans(docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text")))
    margin, cuts = model(counted(spans).collect())
    if all(np.isinf(cuts)):
        return spans.selectExpr("doc_id", "base", "base as spans")
    limit = "case p.k " + " ".join(f"when {k} then {c!r}D" for k, c in enumerate(cuts) if not np.isinf(c)) + " else double('infinity') end"
    free = spans.selectExpr("doc_id", "base", "filter(proposed, p -> not exists(base, q -> q.s < p.e and p.s < q.e)) as free")
    scored = free.selectExpr("doc_id", "base", f"transform(transform(free, p -> named_struct('p', p, 'f', {_features('p')})), r -> named_struct('s', r.p.s, 'k', r.p.k, 'e', r.p.e, 'm', "
                             + margin.replace("f.", "r.f.") + ")) as scored")
    passed = scored.selectExpr("doc_id", "base", f"filter(scored, p -> p.m >= {limit}) as passed")
    # of overlapping proposals the likeliest stays, then the one listed first
    best = ("filter(passed, p -> not exists(passed, q -> q.s < p.e and p.s < q.e and "
            "(q.m > p.m or q.m = p.m and (q.s < p.s or q.s = p.s and q.k < p.k))))")
    return passed.selectExpr("doc_id", "base", f"sort_array(concat(base, transform({best}, p -> named_struct('s', p.s, 'k', p.k, 'e', p.e)))) as spans")


def _listed(spans: str) -> F.Column:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', {names}[x.k], x.s, x.e)), ',')")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the counts of base spans by kind, their digest, and all spans."""
    return find(docs, id_col, text_col).select(
        "doc_id", *[F.expr(f"cast(size(filter(base, x -> x.k = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))
