"""Secret scan over a trigram inverted index, in DataFrame operations only.

From each rule's regular expression a Boolean trigram query is derived: for every
alternative, the trigrams that any match must hold. The index has a posting
``trigram -> row`` for the trigrams that occur in a query; a row is a candidate of
a rule when, for one of its alternatives, it is in the postings of all its
trigrams. Candidates are verified with the expression itself; a rule without
mandatory trigrams scans every row. The index folds case, so it may only say
too much.

Positions come from cutting the text at its matches: lengths of pieces and
matches add up to starts and ends, in code points, end exclusive.

Null text reads as empty and has no spans. Rows equal in id and text share their
postings and each gets the same result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import attach, free_name, keyed, table


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the syntax that Java and Python share; ``group`` must have
    at least ``least`` characters, or the match is dropped."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


# The kinds and patterns to find, in the order that breaks ties.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

_MOST = 64          # texts kept while a query is derived; beyond, an element counts as unknown


def _texts(tokens) -> list[set[str] | None]:
    """For each element of a parsed expression the set of its lower-cased texts, or None."""
    out: list[set[str] | None] = []
    for op, value in tokens:
        name = str(op)
        if name == "LITERAL":
            out.append({chr(value).lower()})
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in value):
            out.append({chr(c).lower() for _, c in value})
        elif name == "SUBPATTERN":
            out += _texts(value[-1])
        elif name == "BRANCH":
            branches = [_joined(_texts(b)) for b in value[1]]
            out.append(None if None in branches else set().union(*branches))
        elif name == "MAX_REPEAT":
            low, high, inner = value
            one = _joined(_texts(inner))
            if one is None or high > 4:
                out += [one] * min(low, 4) + [None]
            else:
                out.append({"".join(p) for n in range(low, high + 1) for p in product(one, repeat=n)})
        else:
            out.append(None)
    return out


def _joined(parts: list[set[str] | None]) -> set[str] | None:
    texts = {""}
    for part in parts:
        if part is None or len(texts) * len(part) > _MOST:
            return None
        texts = {a + b for a in texts for b in part}
    return texts


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives, each the trigrams that a match must hold; empty if a match
    needs none. Every stretch of known texts restricts the match; they are combined."""
    stretches, current = [], {""}
    for part in [*_texts(re._parser.parse(pattern)), None]:
        if part is not None and len(current) * len(part) <= _MOST:
            current = {a + b for a in current for b in part}
        else:
            stretches.append(current)
            current = {""}
    query = {frozenset()}
    for texts in stretches:
        grams = {frozenset(t[i:i + 3] for i in range(len(t) - 2)) for t in texts}
        if frozenset() not in grams and len(query) * len(grams) <= _MOST:
            query = {a | b for a in query for b in grams}
    query = {a for a in query if not any(b < a for b in query)}      # a wider alternative adds nothing
    return [] if query == {frozenset()} else sorted(query, key=sorted)


def candidates(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``did, rk, rules``: the rules whose trigram query a row satisfies."""
    spark = rows.sparkSession
    clauses = [(r.kind, n, gram, len(alt)) for r in rules for n, alt in enumerate(trigram_query(r.pattern)) for gram in sorted(alt)]
    grams = sorted({c[2] for c in clauses})
    folded = rows.select("did", "rk", F.lower("text").alias("folded"))         # once a text, not once a trigram
    present = F.array_compact(F.array(*[F.when(F.col("folded").contains(g), F.lit(g)) for g in grams]))
    postings = folded.select("did", "rk", F.explode(present).alias("gram"))
    queries = spark.createDataFrame(clauses, "rule string, alt int, gram string, need int")
    return (postings.join(F.broadcast(queries), "gram")          # fixed by the rules, not by the data
            .groupBy("did", "rk", "rule", "alt", "need").agg(F.size(F.collect_set("gram")).alias("have"))
            .where("have = need").groupBy("did", "rk").agg(F.collect_set("rule").alias("rules")))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of one rule: struct(start, order, kind, end)."""
    regex = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    value = F.regexp_extract_all(text, regex, F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, rule.pattern, -1)
    parts = F.zip_with(
        F.zip_with(F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))), found,
                   lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("len"))),
        value, lambda p, v: F.struct(p["gap"].alias("gap"), p["len"].alias("len"), F.length(v).alias("size")))
    none = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(acc, p):
        begin = acc["at"] + p["gap"]
        end = begin + p["len"]
        span = F.struct(begin.alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(p["size"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.when(text.rlike(rule.pattern), F.aggregate(parts, start, step, lambda acc: acc["out"])).otherwise(none)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``spans``: struct(start, order, kind, end), by start, then
    rule. A column ``spans`` of the input is replaced."""
    info = free_name(docs, "__info")
    found = candidates(keyed(docs, id_col, text_col), rules)
    joined = attach(docs, found, "left", id_col, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")
    parts = []
    for n, rule in enumerate(rules):
        spans = _spans(text, rule, n)
        if trigram_query(rule.pattern):
            spans = F.when(F.array_contains(F.col(info)["rules"], rule.kind), spans).otherwise(none)
        parts.append(spans)
    return joined.withColumn("spans", F.array_sort(F.concat(*parts))).drop(info)


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_secret_spans(spark, sf_dir: str) -> DataFrame:
    """Spans of every document, with the base kinds counted."""
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in RULES if r.base]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", *map(count, base),
                      F.sha2(_written(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
                      _written(F.col("spans")).alias("spans"))


def _rule_sql(n: int, rule: Rule) -> str:
    regex = rule.pattern.replace("(?i:(password|passwd|secret|token|api_?key))", "(" + "|".join(
        "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key")) + ")")
    regex = regex.replace("'", "''")
    return f"""
  SELECT doc_id, rid, {n} AS o, '{rule.kind}' AS kind, pos AS s, pos + length(m) AS e, {str(rule.base).lower()} AS base
  FROM (SELECT doc_id, rid, m[i] AS m, v[i] AS v,
               coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS pos
        FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i
              FROM (SELECT doc_id, rid, regexp_extract_all(t, '{regex}') AS m, regexp_extract_all(t, '{regex}', {rule.group}) AS v,
                           string_split_regex(t, '{regex}') AS g FROM d)))
  WHERE length(v) >= {rule.least}"""


OP9_SQL = "WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),\ns AS (" + " UNION ALL ".join(
    _rule_sql(n, r) for n, r in enumerate(RULES)) + """),
a AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (base) AS b,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans FROM s GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (rid)"""
