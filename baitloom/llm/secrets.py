"""Secret scans over a trigram inverted index, in DataFrame operations only.

Each rule's regex is parsed into a Boolean query over lower-cased trigrams that
any match must hold. The index has a posting (trigram, text key) for each of the
trigrams that some rule asks for; a rule's postings are intersected and united
per key as its query says, and only candidates are verified with the regex. A
rule without mandatory trigrams scans every text.

Spans are code points, end exclusive; matches of one kind are leftmost and do
not overlap. Null and empty texts have no spans. Repeated rows and null ids are
scanned each for itself. Texts are scanned whole, however long. An empty table gives
no rows. Other columns are kept, whatever their names; those named like a result are
replaced.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parse
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import free_name, saved, sized

#: Up to so many candidate texts are looked up where the texts lie; more are joined. Spans gathered at a time.
MOST_BROADCAST, BLOCK = 1_000_000, 128


@dataclass(frozen=True)
class Rule:
    """A kind, its regex (one that Java and Python read alike), and the least length of a group."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0


# Kinds and patterns of the base rules.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Published formats of further credentials.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

#: A query is a list of clauses, all of which must hold; a clause is a list of
#: alternatives, each a set of trigrams that occur together.
Query = list[list[frozenset[str]]]
_MOST_STRINGS = 64


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def trigram_query(regex: str) -> Query:
    """The Boolean trigram query of a regex: a necessary condition for a match."""
    clauses: Query = []

    def close(strings: set[str]) -> set[str]:
        """Ends a run of exact strings; it is a clause if each of them has a trigram."""
        sets = {trigrams(s) for s in strings}
        if sets and all(sets):
            clauses.append(sorted(sets, key=sorted))
        return {""}

    def exact(node: tuple) -> set[str] | None:
        """All strings that a node matches, lower-cased, if they are few."""
        kind, value = node
        if kind is sre.LITERAL:
            return {chr(value).lower()}
        if kind is sre.IN and all(k is sre.LITERAL for k, _ in value):
            return {chr(v).lower() for _, v in value}
        if kind is sre.SUBPATTERN:
            return joined(value[-1])
        if kind is sre.BRANCH:
            parts = [joined(x) for x in value[1]]
            return set().union(*parts) if all(p is not None for p in parts) else None
        if kind is sre.MAX_REPEAT and value[1] <= 3:
            part = joined(value[2])
            if part is None:
                return None
            out, run = set(), {""}
            for n in range(int(value[1]) + 1):
                out |= run if n >= value[0] else set()
                run = {a + b for a in run for b in part}
            return out if len(out) <= _MOST_STRINGS else None
        return None

    def joined(nodes) -> set[str] | None:
        out = {""}
        for node in nodes:
            part = exact(node)
            if part is None or len(part) * len(out) > _MOST_STRINGS:
                return None
            out = {a + b for a in out for b in part}
        return out

    def walk(nodes) -> None:
        run = {""}
        for kind, value in nodes:
            part = exact((kind, value))
            if part is not None and len(part) * len(run) <= _MOST_STRINGS and not (min(map(len, part)) == 0 and all(trigrams(s) for s in run)):
                run = {a + b for a in run for b in part}
                continue
            run = close(run)
            if part is not None:
                run = part
            elif kind is sre.SUBPATTERN:
                walk(value[-1])
            elif kind is sre.MAX_REPEAT and value[0] >= 1:
                walk(value[2])
        close(run)

    walk(sre_parse.parse(regex))
    return clauses


def build_index(texts: DataFrame, key: str, text: str, wanted: list[str]) -> DataFrame:
    """Postings (trigram, key): which texts hold which of the wanted trigrams, lower-cased."""
    lowered = texts.select(key, F.lower(text).alias("low"))
    present = F.filter(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted]), lambda t: t.isNotNull())
    return lowered.select(key, F.explode(present).alias("trigram"))


def candidates(postings: DataFrame, key: str, queries: dict[str, Query]) -> DataFrame:
    """Keys with the kinds whose queries their postings fulfil."""
    held = F.collect_set("trigram").alias("held")

    def fulfilled(query: Query) -> Column:
        out = F.lit(True)
        for clause in query:
            some = F.lit(False)
            for together in clause:
                some = some | (F.size(F.array_intersect("held", F.array(*map(F.lit, sorted(together))))) == len(together))
            out = out & some
        return out

    kinds = F.filter(F.array(*[F.when(fulfilled(q), F.lit(k)) for k, q in queries.items()]), lambda k: k.isNotNull())
    return postings.groupBy(key).agg(held).select(key, kinds.alias("kinds")).where(F.size("kinds") > 0)


def _spans(rule: Rule, number: int) -> Column:
    """Spans of m{number}, the rule's matches in text, as (start, kind, end): what lies between them gives their places.

    Spans are gathered in blocks, so work stays near the number of matches.
    """
    regex, matches = F.lit(rule.regex), F.col(f"m{number}")
    sized_ = F.zip_with(
        F.zip_with(F.split("text", rule.regex, -1), matches, lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("n"))),
        F.regexp_extract_all("text", regex, F.lit(rule.group)) if rule.group else matches,
        lambda both, part: F.struct(both["gap"].alias("gap"), both["n"].alias("n"), (F.length(part) >= rule.least).alias("ok")),
    )
    none = F.expr("CAST(array() AS array<struct<start:int,kind:int,end:int>>)")
    start = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<array<struct<start:int,kind:int,end:int>>>)").alias("done"), none.alias("open"))

    def one(have: Column, x: Column) -> Column:
        at = have["at"] + x["gap"]
        full = F.size(have["open"]) >= BLOCK
        done = F.when(full, F.concat(have["done"], F.array(have["open"]))).otherwise(have["done"])
        spans = F.when(full, none).otherwise(have["open"])
        span = F.array(F.struct(at.alias("start"), F.lit(number).alias("kind"), (at + x["n"]).alias("end")))
        return F.struct((at + x["n"]).alias("at"), done.alias("done"), F.when(x["ok"], F.concat(spans, span)).otherwise(spans).alias("open"))

    folded = F.aggregate(F.slice(sized_, 1, F.size(matches)), start, one, lambda have: F.concat(F.flatten(have["done"]), have["open"]))
    return F.when(F.size(matches) > 0, folded).otherwise(none)


def _said(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame, *, base: tuple[Rule, ...] = BASE, more: tuple[Rule, ...] = MORE, redact: bool = False) -> DataFrame:
    """Adds n_<kind> for each base rule, base_sha256, spans and n_secrets to each document row.

    spans lists kind:start:end by start, then in the rules' order. With redact,
    `text` has each stretch that some span covers replaced by [kind].
    """
    rules = (*base, *more)
    made = [*(f"n_{r.kind}" for r in base), "base_sha256", "spans", "n_secrets"]
    docs = docs.drop(*made)
    kept = [c for c in docs.columns if c != "text"]
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    wanted = sorted({t for q in indexed.values() for clause in q for together in clause for t in together})
    # the input's other columns travel in one struct, so none can clash with what is made here;
    # the key tells rows apart, so that copies of one text do not meet in one task
    ids = [F.col("doc_id")] if "doc_id" in docs.columns else []
    text = F.coalesce("text", F.lit(""))
    row = F.struct(F.lit(0).alias(free_name("none", kept)), *[F.col(f"`{c}`") for c in kept]).alias("row")
    keyed = docs.select(row, F.col("text").alias("original"), text.alias("text"), F.xxhash64(*ids, text).alias("key"))
    found = saved(candidates(build_index(keyed.select("key", "text"), "key", "text", wanted), "key", indexed), "secret-candidates")
    out = keyed.join(sized(found, found.count(), MOST_BROADCAST), "key", "left").drop("key")
    for i, rule in enumerate(rules):
        match = F.regexp_extract_all("text", F.lit(rule.regex), F.lit(0))
        asked = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False)) if rule.kind in indexed else F.lit(True)
        out = out.withColumn(f"m{i}", F.when(asked, match).otherwise(F.expr("CAST(array() AS array<string>)")))
    out = out.select("row", "original", "text", *[_spans(rule, i).alias(f"s{i}") for i, rule in enumerate(rules)])
    whole = F.concat(*[F.col(f"s{i}") for i in range(len(rules))])
    text = F.when(F.size("whole") > 0, _redacted(rules)).otherwise(F.col("original")) if redact else F.col("original")
    return out.withColumn("whole", F.array_sort(whole)).select(
        *[(text if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns],
        *[F.size(f"s{i}").cast("long").alias(f"n_{r.kind}") for i, r in enumerate(base)],
        F.sha2(_said(F.concat(*[F.col(f"s{i}") for i in range(len(base))]), rules), 256).alias("base_sha256"),
        _said(F.col("whole"), rules).alias("spans"),
        F.size("whole").cast("long").alias("n_secrets"),
    )


def _redacted(rules: tuple[Rule, ...]) -> Column:
    """The text with covered stretches replaced; a stretch is named after its first span."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    folded = F.aggregate(
        "whole",
        start,
        lambda have, s: F.when(
            s["start"] >= have["at"],
            F.struct(
                F.concat(have["out"], F.substring(F.col("text"), have["at"] + 1, s["start"] - have["at"]), F.lit("["), F.get(names, s["kind"]), F.lit("]")).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(F.struct(have["out"].alias("out"), F.greatest(have["at"], s["end"]).alias("at"))),
    )
    return F.concat(folded["out"], F.substring(F.col("text"), folded["at"] + 1, F.length("text")))


def _oracle(base: tuple[Rule, ...] = BASE, more: tuple[Rule, ...] = MORE) -> str:
    """The same by scanning every text with every regex."""
    rules = (*base, *more)
    fold = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    keys = "|".join(fold(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    parts = []
    for i, r in enumerate(rules):
        regex = r.regex.replace("(?i:password|passwd|secret|token|api_?key)", f"(?:{keys})").replace("'", "''")
        parts.append(
            f"SELECT r, {i} AS k, '{r.kind}' AS kind, m, p, g FROM (SELECT r, regexp_extract_all(t, '{regex}') AS m, string_split_regex(t, '{regex}') AS p, regexp_extract_all(t, '{regex}', {r.group}) AS g FROM d) WHERE len(m) > 0"
        )
    least = "CASE k " + " ".join(f"WHEN {i} THEN {r.least}" for i, r in enumerate(rules)) + " END"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
f AS ({' UNION ALL '.join(parts)}),
e AS (SELECT r, k, kind, m, g, p, unnest(range(1, len(m) + 1)) AS i FROM f),
s AS (SELECT r, k, kind, CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a, length(m[i]) AS n FROM e WHERE length(g[i]) >= {least}),
o AS (SELECT r, {', '.join(f"count(*) FILTER (k = {i}) AS n_{x.kind}" for i, x in enumerate(base))}, count(*) AS n_secrets,
  string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, k) FILTER (k < {len(base)}) AS b, string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, k) AS spans FROM s GROUP BY r)
SELECT doc_id, {', '.join(f"coalesce(n_{x.kind}, 0) AS n_{x.kind}" for x in base)}, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_secrets, 0) AS n_secrets
FROM d LEFT JOIN o USING (r)
"""


ORACLE = _oracle()
