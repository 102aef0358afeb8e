"""Secret scanning through a trigram inverted index (DataFrame functions only).

Each rule's regular expression gives a Boolean trigram query: the strings that any match
must contain, as alternatives of trigram sets. The index posts every document under
each trigram that some rule asks for; the postings of an alternative are intersected,
and only documents that pass are searched with the expression. A rule without a
mandatory trigram (a bare character class) searches every document.

Cases: a null text counts as empty and has no spans; repeated rows and null ids each
keep their row, since a candidate list is only ever too long, never too short; an empty
table gives no rows. Spans are code points, end exclusive, in whole texts of any length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, whole_text

_sre = re._parser  # the standard library's own reader of regular expressions


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches are leftmost and do not overlap; those whose ``value``
    group is shorter than ``min_value`` are dropped."""

    kind: str
    pattern: str
    value: int = 0
    min_value: int = 1


#: For ``access`` and ``hex`` a match is a maximal run, so its least length is written into the
#: expression: shorter runs would be dropped anyway, and no match can begin inside one.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[baprs]-[0-9A-Za-z-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

#: Alternatives that a run of literals may branch into before it is cut.
MOST_STRINGS = 64


def _exact(node) -> set[str] | None:
    """All strings that a node matches, in lower case, if they are few."""
    op, arg = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "IN":
        out: set[str] = set()
        for kind, x in arg:
            if str(kind) == "LITERAL":
                out.add(chr(x).lower())
            elif str(kind) == "RANGE" and x[1] - x[0] < 8:
                out |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op == "SUBPATTERN":
        return _joined(arg[3])
    if op == "BRANCH":
        parts = [_joined(x) for x in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op in ("MAX_REPEAT", "MIN_REPEAT") and arg[:2] == (0, 1):
        inner = _joined(arg[2])
        return None if inner is None else inner | {""}
    return None


def _joined(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        x = _exact(node)
        if x is None or len(x) * len(out) > MOST_STRINGS:
            return None
        out = {a + b for a, b in product(out, x)}
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of trigram sets, one of which each matching text holds whole (lower-cased); None: no such need."""
    runs: list[set[str]] = []
    run = {""}
    for node in _sre.parse(pattern):
        x = _exact(node)
        if x is not None and len(x) * len(run) <= MOST_STRINGS:
            run = {a + b for a, b in product(run, x)}
            continue
        runs.append(run)
        run = {""}
    runs.append(run)
    query: set[frozenset[str]] = {frozenset()}
    for strings in runs:
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        if frozenset() not in sets:
            query = {a | b for a, b in product(query, sets)}
    least = [a for a in query if not any(b < a for b in query)]
    return None if frozenset() in least else sorted(least, key=sorted)


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, doc_id) for the given trigrams of lower-cased texts."""
    lowered = docs.select("doc_id", F.lower(whole_text()).alias("lowered"))
    held = F.array_compact(F.array(*(F.when(F.contains("lowered", F.lit(t)), F.lit(t)) for t in trigrams)))
    return lowered.select("doc_id", F.explode(held).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame | None:
    """doc_id and the kinds whose trigram query its postings satisfy; None if no rule has a query."""
    terms = [
        (rule.kind, i, t, len(alternative))
        for rule in rules
        for i, alternative in enumerate(trigram_query(rule.pattern) or [])
        for t in sorted(alternative)
    ]
    if not terms:
        return None
    wanted = docs.sparkSession.createDataFrame(terms, "kind string, alternative int, trigram string, need int")
    return (
        trigram_index(docs, sorted({t[2] for t in terms}))
        .join(F.broadcast(wanted), "trigram")  # as long as the rules
        .groupBy("doc_id", "kind", "alternative")
        .agg(F.count(F.lit(1)).alias("have"), F.max("need").alias("need"))
        .filter(F.col("have") >= F.col("need"))
        .groupBy("doc_id")
        .agg(F.collect_set("kind").alias("kinds"))
    )


_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Places of the rule's matches: the pieces between matches give the distances."""
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1),
        F.regexp_extract_all(text, pattern, F.lit(0)),
        F.regexp_extract_all(text, pattern, F.lit(rule.value)),
    )

    def step(acc, x):
        start = acc["at"] + F.char_length(x["0"])
        end = F.coalesce(start + F.char_length(x["1"]), start)
        found = F.array(F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))).cast(_SPANS)
        keep = x["1"].isNotNull() & (F.char_length(x["2"]) >= rule.min_value)
        return F.struct(
            F.coalesce(end, F.lit(0)).alias("at"), F.when(keep, F.concat(acc["out"], found)).otherwise(acc["out"]).alias("out")
        )

    first = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))
    return F.aggregate(parts, first, step, lambda acc: acc["out"])


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """``docs`` with ``secrets``: an array of (start, kind number in ``rules``, end), by start and kind."""
    found = candidates(docs, rules)
    if found is None:
        joined = docs.withColumn("__kinds", F.lit(None).cast("array<string>"))
    else:
        found = found.select(F.col("doc_id").alias("__id"), F.col("kinds").alias("__kinds"))
        joined = docs.join(found, docs["doc_id"].eqNullSafe(found["__id"]), "left").drop("__id")
    text, none = whole_text(), F.array().cast(_SPANS)
    spans = []
    for i, rule in enumerate(rules):
        search = text.rlike(rule.pattern)
        if trigram_query(rule.pattern) is not None:
            search = F.coalesce(F.array_contains("__kinds", rule.kind), F.lit(False)) & search
        spans.append(F.when(search, _spans(text, rule, i)).otherwise(none))
    return joined.withColumn("secrets", F.array_sort(F.concat(*spans))).drop("__kinds")


def _written(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op8_trigram_secrets(spark, sf_dir: str) -> DataFrame:
    rules = BASE_RULES + MORE_RULES
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), rules).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind"] < len(BASE_RULES))
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE_RULES)),
        F.sha2(_written(base, rules), 256).alias("base_sha256"),
        _written(F.col("secrets"), rules).alias("spans"),
    )


def _kind_sql(number: int, rule: Rule) -> str:
    p = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {number} AS k, '{rule.kind}' AS kind, start, start + length(m[i]) AS stop, length(v[i]) AS n
  FROM (SELECT *, (coalesce(list_sum(list_transform(parts[1:i], lambda x: length(x))), 0)
                   + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start
        FROM (SELECT doc_id, parts, m, v, unnest(range(1, len(m) + 1)) AS i
              FROM (SELECT doc_id, string_split_regex(t, '{p}') AS parts, regexp_extract_all(t, '{p}', 0) AS m,
                           regexp_extract_all(t, '{p}', {rule.value}) AS v
                    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))))
  WHERE length(v[i]) >= {rule.min_value}"""


OP8_SQL = f"""
WITH spans AS ({" UNION ALL ".join(_kind_sql(i, r) for i, r in enumerate(BASE_RULES + MORE_RULES))}),
written AS (SELECT *, kind || ':' || start || ':' || stop AS span FROM spans)
SELECT d.doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
       count(*) FILTER (k = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, k) FILTER (k < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, k), '') AS spans
FROM documents d LEFT JOIN written w ON d.doc_id = w.doc_id GROUP BY d.doc_id
"""
