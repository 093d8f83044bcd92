"""Secret scans through a trigram inverted index, with DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: what any match must
contain. Postings (trigram, document) are kept for the trigrams that rules ask for; per document
they are intersected as the queries say, and only candidates are verified by the expression. A
rule without a mandatory trigram scans every text. Verification runs on the text itself, so a
candidate too many costs time but changes nothing.

Defined results: a null text is the empty one; rows that share an id, null or not, are told
apart by their text; equal rows get equal results. Columns of the input are kept.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import empty_as, fresh_name, quoted, written
from riskmart.llm.spans import MARK, find, let, marks, replaced

MOST_STRINGS = 64
MOST_CHOICES = 8
REPLACEMENT = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if its ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # Runs of at least 16: the same matches as all runs with the short ones dropped.
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)

# Published shapes of access tokens and keys.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
)

RULES = BASE + MORE

# A query is True, a trigram, or ("and" | "or", queries).
Query = bool | str | tuple


def _all(queries: list) -> Query:
    queries = list(dict.fromkeys(q for q in queries if q is not True))
    return True if not queries else queries[0] if len(queries) == 1 else ("and", tuple(queries))


def _any(queries: list) -> Query:
    queries = list(dict.fromkeys(queries))
    return True if not queries or True in queries else queries[0] if len(queries) == 1 else ("or", tuple(queries))


def _of_strings(strings: set[str]) -> Query:
    """What a text must hold that has one of the strings in it."""
    grams = {s: {s[i : i + 3] for i in range(len(s) - 2)} for s in sorted(strings)}
    # What asks for more than another way does adds nothing.
    least = [s for s in grams if not any(grams[o] < grams[s] for o in grams)]
    return _any([_all([s[i : i + 3] for i in range(len(s) - 2)]) for s in least])


def _strings(op, value) -> set[str] | None:
    """All lower-case texts a part can match, if they are few."""
    if op is sre.LITERAL:
        return {chr(value).lower()}
    if op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
        return {""}
    if op is sre.IN:
        chars: set[str] = set()
        for kind, x in value:
            if kind is sre.LITERAL:
                chars.add(chr(x).lower())
            elif kind is sre.RANGE and x[1] - x[0] < 2 * MOST_CHOICES:
                chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return chars if len(chars) <= MOST_CHOICES else None
    if op is sre.SUBPATTERN:
        return _sequence_strings(value[-1])
    if op is sre.BRANCH:
        parts = [_sequence_strings(b) for b in value[1]]
        return None if None in parts else set().union(*parts)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        low, high, body = value
        inner = _sequence_strings(body) if high is not sre.MAXREPEAT and high <= 4 else None
        if inner is None:
            return None
        return _few({"".join(p) for n in range(low, high + 1) for p in product(inner, repeat=n)})
    return None


def _few(strings: set[str]) -> set[str] | None:
    return strings if len(strings) <= MOST_STRINGS else None


def _sequence_strings(parts) -> set[str] | None:
    out: set[str] | None = {""}
    for op, value in parts:
        more = _strings(op, value)
        if more is None or out is None:
            return None
        out = _few({a + b for a in out for b in more})
    return out


def _required(parts) -> Query:
    """What every match of a sequence must contain."""
    queries, run = [], {""}
    for op, value in parts:
        more = _strings(op, value)
        joined = _few({a + b for a in run for b in more}) if more is not None else None
        if joined is not None:
            run = joined
            continue
        queries.append(_of_strings(run))
        run = more or {""}
        if more is None:
            if op is sre.SUBPATTERN:
                queries.append(_required(value[-1]))
            elif op is sre.BRANCH:
                queries.append(_any([_required(b) for b in value[1]]))
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT) and value[0] >= 1:
                queries.append(_required(value[2]))
    return _all([*queries, _of_strings(run)])


def trigram_query(pattern: str) -> Query:
    """The Boolean query over lower-case trigrams; True if nothing is mandatory."""
    return _required(sre_parser.parse(pattern))


def trigrams(query: Query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def _holds(query: Query, present: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(present, query)
    op = (lambda a, b: a & b) if query[0] == "and" else (lambda a, b: a | b)
    return reduce(op, [_holds(q, present) for q in query[1]])


def build_index(texts: DataFrame, grams: set[str]) -> DataFrame:
    """Postings (gram, id, key) for rows (id, key, text)."""
    wanted = F.array(*[F.lit(g) for g in sorted(grams)])
    present = let(F.lower("text"), lambda t: F.filter(wanted, lambda g: F.contains(t, g)))
    return texts.select(F.explode(present).alias("gram"), "id", "key")


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """Documents that some query admits: c_id, c_key and the rules' kinds.

    The postings of a document meet in one group, of at most as many rows as there are trigrams.
    """
    present = index.groupBy("id", "key").agg(F.collect_set("gram").alias("present"))
    kinds = F.array_compact(F.array(*[F.when(_holds(q, F.col("present")), F.lit(k)) for k, q in queries.items()]))
    return present.select(F.col("id").alias("c_id"), F.col("key").alias("c_key"), kinds.alias("kinds")).filter(F.size("kinds") > 0)


def verified(text: Column, rule: Rule) -> Column:
    spans = find(text, rule.pattern)
    if rule.least > 1:
        part = (lambda s: F.regexp_extract(s["value"], rule.pattern, rule.group)) if rule.group else (lambda s: s["value"])
        spans = F.filter(spans, lambda s: F.char_length(part(s)) >= rule.least)
    return spans


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a column of marks (start, ord, end, kind); returns the frame and its name."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q is not True}
    name, key = fresh_name(docs, "secrets"), fresh_name(docs, "secrets_key")
    body = empty_as(text)
    keyed = docs.withColumn(key, F.xxhash64(body))
    if indexed:
        rows = docs.select(F.col(quoted(doc_id)).alias("id"), F.xxhash64(body).alias("key"), body.alias("text"))
        index = written(build_index(rows, set().union(*map(trigrams, indexed.values()))), "trigram-index")
        found = candidates(index, indexed)
        found = found.select(*[F.col(c).alias(fresh_name(docs, c)) for c in found.columns])
        c_id, c_key, kinds = found.columns
        keyed = keyed.join(
            found, (F.col(key) == F.col(c_key)) & F.col(quoted(doc_id)).eqNullSafe(F.col(c_id)), "left"
        )
    none = F.array().cast(MARK)
    parts = []
    for order, rule in enumerate(rules):
        hits = marks(verified(body, rule), rule.kind, order)
        if rule.kind in indexed:
            hits = F.when(F.array_contains(kinds, rule.kind), hits).otherwise(none)
        parts.append(hits)
    return keyed.select(*[F.col(quoted(c)) for c in docs.columns], F.concat(*parts).alias(name)), name


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: str = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced in the text; a column ``size`` follows the text's length.

    Texts without secrets, null ones included, stay as they are.
    """
    frame, name = scan(docs, doc_id=doc_id, text=text)
    changed = F.size(F.col(name)) > 0
    hidden = replaced(F.col(quoted(text)), F.col(name), lambda m: F.lit(REPLACEMENT))
    # Under a name of its own first: a column named like the text would be taken for the text.
    clean = fresh_name(frame, "clean_text")
    frame = frame.withColumn(clean, F.when(changed, hidden).otherwise(F.col(quoted(text))))
    kinds = dict(docs.dtypes)

    def column(c: str) -> Column:
        if c == text:
            return F.col(clean).alias(c)
        if c == size and kinds[c] in ("int", "bigint"):
            return F.when(changed, F.char_length(clean).cast(kinds[c])).otherwise(F.col(quoted(c))).alias(c)
        return F.col(quoted(c))

    return frame.select(*[column(c) for c in docs.columns])
