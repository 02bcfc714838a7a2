"""Secret scans over a trigram inverted index.

Every rule's regular expression is turned into a Boolean query over trigrams:
an OR of ANDs that any match must satisfy. The index holds a posting
(trigram, doc_id) for each trigram that a rule asks for and each document that
holds it, in lower case. A rule's postings are intersected per document; only
the documents left are scanned with the rule's expression. Rules whose
expression requires no trigram are run over every document.

All of it is DataFrame expressions; only the rules are analysed on the driver.
Postings are at most one row per document and trigram of the rules, and their
intersection groups by document, so no posting list is gathered anywhere.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parse
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm.common import packed, read, unpacked
from cardsentry.sources.storage import materialize


@dataclass(frozen=True)
class Rule:
    """A kind of secret: ``pattern`` finds it, and a match counts if its
    ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


# The base rules, in their order.
BASE_RULES = (
    Rule(
        "assign",
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        8,
        2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    # a run of 32 or more is what is left of all runs once short ones are dropped
    Rule("hex", r"[0-9a-f]{32,}", 32),
)
# Further kinds: public prefixes of access tokens and the header of private keys.
MORE_RULES = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
)
RULES = BASE_RULES + MORE_RULES
# A literal set that grows past this is cut up into trigrams.
MOST_LITERALS = 64
# Matches whose places are added up together.
CHUNK = 256

# A query is an OR of ANDs of trigrams; ANY matches every document.
Query = frozenset
ANY: Query = frozenset([frozenset()])


def _both(a: Query, b: Query) -> Query:
    return _least({x | y for x in a for y in b})


def _least(ands) -> Query:
    """Without the ANDs that a smaller one implies."""
    return frozenset(x for x in ands if not any(y < x for y in ands))


def _grams(texts: frozenset[str]) -> Query:
    return _least({frozenset(t[i : i + 3] for i in range(len(t) - 2)) for t in texts}) if texts else ANY


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query that every match of the pattern satisfies,
    over text in lower case."""
    query, literals = _walk(sre_parse.parse(pattern))
    return _both(query, _grams(literals))


def _walk(items) -> tuple[Query, frozenset[str]]:
    """Query of what is finished, and the literal texts the end may consist of.

    Literals grow while the next item has few forms. Otherwise their trigrams
    join the query and the literals start afresh.
    """
    query, tails = ANY, frozenset([""])
    for op, arg in items:
        forms, inner = _forms(op, arg)
        if forms and len(forms) * len(tails) <= MOST_LITERALS:
            tails = frozenset(t + f for t in tails for f in forms)
        else:
            query, tails = _both(query, _grams(tails)), frozenset([""])
            query = _both(query, inner if not forms else _grams(forms))
    return query, tails


def _forms(op, arg) -> tuple[frozenset[str], Query]:
    """All literal texts of an item if they are few, else a query for it."""
    if op is sre.LITERAL:
        return frozenset([chr(arg).lower()]), ANY
    if op is sre.IN:
        chars = set()
        for kind, what in arg:
            if kind is sre.LITERAL:
                chars.add(chr(what).lower())
            elif kind is sre.RANGE and what[1] - what[0] < 8:
                chars |= {chr(c).lower() for c in range(what[0], what[1] + 1)}
            else:
                return frozenset(), ANY
        return (frozenset(chars), ANY) if len(chars) <= 8 else (frozenset(), ANY)
    if op is sre.SUBPATTERN:
        query, tails = _walk(arg[-1])
        return (tails, ANY) if query == ANY else (frozenset(), _both(query, _grams(tails)))
    if op is sre.BRANCH:
        parts = [_walk(p) for p in arg[1]]
        if all(q == ANY for q, _ in parts):
            return frozenset().union(*[t for _, t in parts]), ANY
        return frozenset(), _least(frozenset().union(*[_both(q, _grams(t)) for q, t in parts]))
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, what = arg
        query, tails = _walk(what)
        if (least, most) == (0, 1) and query == ANY:
            return tails | {""}, ANY
        return (frozenset(), _both(query, _grams(tails))) if least else (frozenset(), ANY)
    return frozenset(), ANY


def trigram_postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: (trigram, doc_id), for the trigrams asked for."""
    lower = F.lower("text")
    held = F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(F.col("lower"), t))
    return docs.select("doc_id", lower.alias("lower")).select(F.explode(held).alias("trigram"), "doc_id")


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame | None:
    """(id, kinds): the rules that each document may match, by the index."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    queries = {k: q for k, q in queries.items() if q != ANY}
    trigrams = sorted({t for q in queries.values() for a in q for t in a})
    if not trigrams:
        return None
    index = materialize(trigram_postings(docs, trigrams), "trigram-index")
    held = index.groupBy("doc_id").agg(F.collect_set("trigram").alias("held"))  # as many as the rules ask for
    met = lambda a: F.size(F.array_intersect("held", F.array(*map(F.lit, sorted(a))))) == len(a)

    def any_met(q: Query) -> Column:
        out = F.lit(False)
        for a in sorted(map(sorted, q)):
            out = out | met(a)
        return out

    kinds = F.filter(
        F.array(*[F.when(any_met(q), F.lit(k)) for k, q in queries.items()]), lambda k: k.isNotNull()
    )
    return held.select(F.col("doc_id").alias("id"), kinds.alias("kinds")).where(F.size("kinds") > 0)


def _once(value: Column, use) -> Column:
    """``use(value)``, an array, with ``value`` computed once however often it
    is used."""
    return F.flatten(F.transform(F.array(value), use))


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of the leftmost non-overlapping matches of a rule that count:
    structs of start, rank, kind, stop, in code points.

    The pieces between the matches give the places: each match starts where the
    pieces and matches before it end. These are added up in chunks of matches,
    then over the chunks, as an array that grows is copied for each new element.
    """
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    zipped = F.arrays_zip(
        F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(found)).alias("gap"),
        found.alias("found"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
    )

    def step(s: Column, m: Column) -> Column:
        start = s["at"] + F.length(m["gap"])
        stop = start + F.length(m["found"])
        span = F.struct(start.alias("start"), stop.alias("stop"), F.length(m["part"]).alias("size"))
        return F.struct(stop.alias("at"), F.array_append(s["out"], span).alias("out"))

    none = F.array().cast("array<struct<start:int, stop:int, size:int>>")
    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def chunked(matches: Column) -> Column:
        last = F.floor((F.greatest(F.size(matches), F.lit(1)) - 1) / F.lit(CHUNK)).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last), lambda k: F.aggregate(F.slice(matches, k * CHUNK + 1, F.lit(CHUNK)), zero, step)
        )

    def shifted(chunks: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        begins = F.aggregate(
            chunks, start,
            lambda s, c: F.struct((s["at"] + c["at"]).alias("at"), F.array_append(s["out"], s["at"]).alias("out")),
            lambda s: s["out"],
        )
        move = lambda c, at: F.transform(c["out"], lambda m: F.struct(
            (m["start"] + at).alias("start"), (m["stop"] + at).alias("stop"), m["size"].alias("size")))
        return F.flatten(F.zip_with(chunks, begins, move))

    placed = _once(zipped, lambda matches: _once(chunked(matches), shifted))
    return F.transform(
        F.filter(placed, lambda m: m["size"] >= rule.least),
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), m["stop"].alias("stop")
        ),
    )


def with_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``spans``: array of (start, rank, kind, stop), by start, then by the
    order of the rules; empty if nothing is found.

    A null text counts as empty. Repeated rows and rows without an id are
    scanned like all others (ids only steer which rules run), an empty table
    gives an empty table, and an input column named spans is replaced.
    """
    rows = docs.select(packed(docs), F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    found = candidates(docs.select("doc_id", "text"), rules)
    if found is None:
        rows = rows.withColumn("kinds", F.lit(None).cast("array<string>"))
    else:
        # candidates grow with the corpus, so they are never broadcast
        rows = rows.join(found.hint("merge"), F.col("key").eqNullSafe(F.col("id")), "left")
    none = F.array().cast("array<struct<start:int, rank:int, kind:string, stop:int>>")
    each = []
    for rank, rule in enumerate(rules):
        indexed = trigram_query(rule.pattern) != ANY
        # a scan without positions first: most texts hold nothing
        may = F.array_contains("kinds", rule.kind) if indexed else F.lit(True)
        may = F.coalesce(may, F.lit(False)) & F.rlike("text", F.lit(rule.pattern))
        each.append(F.when(may, spans_of(F.col("text"), rule, rank)).otherwise(none))
    spans = F.array_sort(F.concat(*each))
    return rows.withColumn("found", spans).select(*unpacked(docs.columns, {"spans": F.col("found")}))


def joined(spans: Column) -> Column:
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))
    )


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents with every secret replaced by ``[kind]``; spans that
    overlap are replaced together, under the kind of the first. ``n_chars``,
    where there is one, is set to the new length. A null text stays null."""
    rows = with_spans(docs, rules)
    # at: where the text after the last replaced span starts (1-based)
    built = F.expr("""
        aggregate(spans, named_struct('at', 1, 'out', ''),
          (s, m) -> if(m.start + 1 < s.at,
             named_struct('at', greatest(s.at, m.stop + 1), 'out', s.out),
             named_struct('at', m.stop + 1, 'out', concat(s.out, substring(text, s.at, m.start + 1 - s.at), '[', m.kind, ']'))),
          s -> concat(s.out, substring(text, s.at)))""")
    rows = rows.withColumn("text", F.when(F.size("spans") > 0, built).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the spans in every document."""
    rows = with_spans(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_RULES))
    return rows.select(
        "doc_id",
        *[count(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def _kind_sql(rule: Rule, rank: int) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {rank} AS r, '{rule.kind}' AS kind, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s,
         length(m[i]) AS n, length(v[i]) AS size
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT doc_id, string_split_regex(text, '{pattern}') AS g, regexp_extract_all(text, '{pattern}') AS m,
           regexp_extract_all(text, '{pattern}', {rule.group}) AS v FROM documents))
  WHERE length(v[i]) >= {rule.least}"""


OP6_SQL = f"""
WITH found AS ({' UNION ALL '.join(_kind_sql(r, i) for i, r in enumerate(RULES))}
), spans AS (
  SELECT doc_id, r, kind, s, kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT) AS span FROM found
), sums AS (
  SELECT doc_id, count(*) FILTER (r = 0) AS n_assign, count(*) FILTER (r = 1) AS n_access, count(*) FILTER (r = 2) AS n_hex,
         string_agg(span, ',' ORDER BY s, r) FILTER (r < 3) AS base, string_agg(span, ',' ORDER BY s, r) AS spans
  FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN sums USING (doc_id)
"""
