"""Information-theoretic sanitisation of personal data, with DataFrame functions only.

E-mail addresses, IP addresses, card and phone numbers are the protected entities. The corpus
tells how strongly the words around them reveal them: with p from document counts, the pointwise
mutual information of a term and an entity, as a share of the entity's information content

    strength = ln(N c(e,t) / (c(e) c(t))) / ln(N / c(e)),

is 1 when the term never occurs without the entity. c(e,t) counts documents in which the term
stands wholly within ``WINDOW`` code points of a mention; c(t) and c(e) count documents that hold
them anywhere; N counts all documents. A term seen with an entity in at least ``SUPPORT``
documents is generalised from ``GENERALISE`` on and removed from ``REMOVE`` on, where it stands
near the entity. Terms are runs of ASCII letters, digits and non-ASCII characters, compared in
ASCII lower case; those that overlap a protected entity are left to it.

Defined results: a null text is the empty one and counts as a document; an entity in every
document has no information and is revealed by nothing; rows that share an id are told apart by
their text, and equal rows get equal results.

``find_whole`` has no least support: every entity is rated, and so is the group of its likes (an
e-mail's domain, the network of an IP, the first digits of a number), with the share of a term's
documents that hold the entity drawn towards the base rate c(e)/N by ``PRIOR`` documents. It has
no window either: terms count and are marked in whole documents. Entities that stand in the same
documents are counted as one, and so are terms, so that a long list of addresses stays cheap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import empty_as, quoted, written
from riskmart.llm.spans import MARK, find, let, marks, replaced

WINDOW = 48
SUPPORT = 3
GENERALISE = 0.8
REMOVE = 0.95
PRIOR = 1.0  # documents that ``find_whole`` adds at the entity's base rate to those with a term
SLOTS = 1 << 22  # at least so many, up to ``MOST_SLOTS``
MOST_SLOTS = 1 << 27
SPELT = 1000  # terms of a text up to which a pattern spells them; with more, all words are located

# Each is written so that failing attempts end early; the matches are those of the plain form
# in the comment. \G lets a match begin right after the last one.
EMAIL = r"(?=[A-Za-z0-9._%+-])(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"  # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
IP = r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"  # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
CARD = r"[0-9](?:[\x20-]?[0-9])++"  # [0-9]([\x20-]?[0-9])+
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
KINDS = ("email", "ip", "card", "phone")
ACTIONS = ("remove", "generalise")

LETTER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = LETTER + "+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether at most 20 digits pass the Luhn check."""
    wide = F.lpad(digits, 20, "0")
    doubled = F.translate(wide, "0123456789", "0246813579")
    total = sum(
        (doubled.substr(i, 1).cast("int") + wide.substr(i + 1, 1).cast("int") for i in range(1, 20, 2)), F.lit(0)
    )
    return total % 10 == 0


def _card(s: Column) -> Column:
    return let(_digits(s["value"]), lambda d: F.char_length(d).between(12, 19) & luhn(d))


def entities(text: Column) -> dict[str, Column]:
    """Spans of each kind of protected entity."""
    has = lambda mark, spans: F.when(F.contains(text, F.lit(mark)), spans).otherwise(F.array().cast(spans_type))
    spans_type = "array<struct<start:bigint,end:bigint,value:string>>"
    return {
        "email": has("@", find(text, EMAIL)),
        "ip": has(".", F.filter(find(text, IP), lambda s: s["value"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))),
        "card": F.filter(find(text, CARD), _card),
        "phone": has("+", F.filter(find(text, PHONE), lambda s: F.char_length(_digits(s["value"])).between(9, 15))),
    }


def _near(text: Column, start: Column, end: Column) -> Column:
    """Terms wholly within the window on either side: start, end, term.

    A word that the mention or the edge of the window cuts is none.
    """
    is_word = lambda at: F.coalesce(text.substr(at.cast("int"), F.lit(1)).rlike(WORD), F.lit(False))
    begin = F.greatest(start - WINDOW - 1, F.lit(0).cast("bigint"))
    size = F.char_length(text)

    def placed(context: Column, offset: Column, cut_left: Column, cut_right: Column) -> Column:
        inside = lambda w: ~(cut_left & (w["start"] == 0)) & ~(cut_right & (w["end"] == F.char_length(context)))
        return F.transform(
            F.filter(find(context, WORD), inside),
            lambda w: F.struct(
                (w["start"] + offset).alias("start"), (w["end"] + offset).alias("end"),
                F.translate(w["value"], UPPER, LOWER).alias("term"),
            ),
        )

    left = text.substr((begin + 1).cast("int"), (start - begin).cast("int"))
    right = text.substr((end + 1).cast("int"), F.lit(WINDOW + 1))
    return F.concat(
        let(left, lambda c: placed(c, begin, start > WINDOW, is_word(start + 1))),
        let(right, lambda c: placed(c, end, is_word(end), size - end > WINDOW)),
    )


def _named(spans: Column, kind: str) -> Column:
    """Spans under the name of their entity: kind and value."""
    return F.transform(
        spans,
        lambda s: F.struct(
            F.concat(F.lit(f"{kind}:"), s["value"]).alias("entity"), s["start"].alias("start"), s["end"].alias("end")
        ),
    )


def _protected(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per row: doc_id, key, text, base marks, and the spans with the names of their entities."""
    body = empty_as(text)
    rows = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.xxhash64(body).alias("key"), body.alias("text"))
    found = rows.select("*", *[c.alias(k) for k, c in entities(F.col("text")).items()])
    base = F.concat(*[marks(F.col(k), k, i) for i, k in enumerate(KINDS)])
    named = F.concat(*[_named(F.col(k), k) for k in KINDS])
    return found.select("doc_id", "key", "text", base.alias("base"), named.alias("named"))


def _free(w: Column) -> Column:
    return ~F.exists(F.col("base"), lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"]))


def mentions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, key, base marks, distinct entities, and the terms near each mention."""
    found = _protected(docs, doc_id, text)
    near = F.flatten(
        F.transform(
            F.col("named"),
            lambda m: F.transform(
                F.filter(_near(F.col("text"), m["start"], m["end"]), _free),
                lambda w: F.struct(m["entity"].alias("entity"), w["term"].alias("term"), w["start"].alias("start"), w["end"].alias("end")),
            ),
        )
    )
    held = F.array_distinct(F.transform(F.col("named"), lambda m: m["entity"]))
    return found.select("doc_id", "key", "base", held.alias("entities"), near.alias("near"))


def term_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """In how many documents each term occurs."""
    words = F.regexp_extract_all(F.translate(empty_as(text), UPPER, LOWER), F.lit(WORD), F.lit(0))
    return docs.select(F.explode(F.array_distinct(words)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("c_t"))


def disclosures(docs: DataFrame, found: DataFrame, text: str = "text", support: int = SUPPORT,
                generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """Terms that reveal an entity: entity, term, strength, ord (place in ``ACTIONS``)."""
    pairs = found.select(
        F.explode(F.array_distinct(F.transform("near", lambda n: F.struct(n["entity"].alias("entity"), n["term"].alias("term"))))).alias("p")
    )
    pairs = pairs.groupBy("p.entity", "p.term").agg(F.count(F.lit(1)).alias("c_et")).filter(F.col("c_et") >= support)
    held = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("c_e"))
    total = F.broadcast(found.agg(F.count(F.lit(1)).alias("n")))  # one row
    joined = pairs.join(held, "entity").join(term_counts(docs, text), "term").crossJoin(total)
    information = F.ln(F.col("n") / F.col("c_e"))
    shared = F.ln(F.col("n") * F.col("c_et") / (F.col("c_e") * F.col("c_t")))
    strength = F.when(F.col("c_e") < F.col("n"), shared / F.when(F.col("c_e") < F.col("n"), information).otherwise(F.lit(1.0)))
    rated = joined.select("entity", "term", strength.alias("strength")).filter(F.col("strength") >= generalise)
    return rated.withColumn("ord", F.when(F.col("strength") >= remove, 0).otherwise(1))


def group_of(entity: Column) -> Column:
    """An entity's likes: its domain, its first three parts, or its first digits."""
    kind, value = F.substring_index(entity, ":", 1), F.substring_index(entity, ":", -1)
    likes = (
        F.when(kind == "email", F.concat(F.lit("@"), F.substring_index(value, "@", -1)))
        .when(kind == "ip", F.concat(F.substring_index(value, ".", 3), F.lit(".")))
        .otherwise(F.substring(_digits(value), 1, 6))
    )
    return F.concat(kind, F.lit("-group:"), likes)


def _with_groups(items: Column) -> Column:
    return F.array_distinct(F.concat(items, F.transform(items, group_of)))


def _sets(items: DataFrame, name: str) -> DataFrame:
    """Per value of ``name`` in rows of (row, name): how many rows hold it, and a 128-bit hash of which."""
    return items.groupBy(name).agg(
        F.count(F.lit(1)).alias("size"),
        F.bit_xor(F.xxhash64("row")).alias("h1"), F.bit_xor(F.xxhash64("row", F.lit("2"))).alias("h2"),
    )


def shared_rows(found: DataFrame, counts: DataFrame, total: DataFrame, generalise: float = GENERALISE) -> tuple[DataFrame, DataFrame]:
    """Pairs of entities and terms with the rows they share, and the terms by their ``terms`` class.

    Entities in the same rows are one class, and so are terms in the same rows and as many
    documents: their strengths are the same. Terms that no entity can reach ``generalise`` with
    are left out: in k of the rows with entities, (k + PRIOR b) / b^(1 - generalise) is largest at
    one end of k/N <= b <= 1.
    """
    held = found.select("row", F.explode("entities").alias("entity"))
    sets = _sets(held, "entity").select("entity", F.struct("size", "h1", "h2").alias("e"))
    entities = held.join(sets, "entity").select("row", "e").distinct()
    own = found.select("row", F.explode("own").alias("term"))
    known = _sets(own, "term").join(counts, "term").crossJoin(F.broadcast(total))  # one row
    k, n = F.col("size").cast("double"), F.col("n")
    most = F.greatest(k * (1 + PRIOR / n) * F.pow(n / k, F.lit(1 - generalise)), k + PRIOR)
    known = known.filter(F.col("c_t") + PRIOR <= most * (1 + 1e-9))
    known = written(known.select("term", F.struct("c_t", "size", "h1", "h2").alias("t")), "terms")
    terms = own.join(known, "term").select("row", "t").distinct()
    pairs = terms.join(entities, "row").groupBy("e", "t").agg(F.count(F.lit(1)).alias("c_et"))
    return pairs, known


def rated(pairs: DataFrame, total: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """Every pair's strength from e, t, c_et and n: t, and the ord of its strongest pair."""
    joined = pairs.crossJoin(F.broadcast(total))  # one row
    base = F.col("e.size") / F.col("n")
    share = (F.col("c_et") + PRIOR * base) / (F.col("t.c_t") + PRIOR)
    strength = F.when(base < 1, F.ln(share / base) / F.ln(F.when(base < 1, 1 / base).otherwise(F.lit(2.0))))
    strong = joined.select("t", strength.alias("strength")).filter(F.col("strength") >= generalise)
    return strong.groupBy("t").agg(F.min(F.when(F.col("strength") >= remove, 0).otherwise(1)).alias("ord"))


def _covered(spans: Column) -> Column:
    """For each code point up to the last span, whether it lies in one."""

    def flags(v: Column, s: Column, i: Column) -> Column:
        gap = s["start"] - F.when(i > 0, F.get(v, i - 1)["end"]).otherwise(F.lit(0))
        return F.concat(
            F.array_repeat(F.lit(False), gap.cast("int")), F.array_repeat(F.lit(True), (s["end"] - s["start"]).cast("int"))
        )

    return let(spans, lambda v: F.flatten(F.transform(v, lambda s, i: flags(v, s, i))))


def _free_of(base: Column, terms: Column) -> Column:
    """The marks of ``terms`` that overlap none of ``base``, in time that grows with the text."""

    def in_one(t: Column, flags: Column) -> Column:
        here = F.slice(flags, (t["start"] + 1).cast("int"), (t["end"] - t["start"]).cast("int"))
        return F.exists(here, lambda f: f)

    def of_kind(kind: str) -> Column:
        return F.filter(base, lambda b: b["kind"] == kind)

    covered = F.array(*[_covered(of_kind(k)) for k in KINDS])
    free = let(covered, lambda kinds: F.filter(terms, lambda t: ~F.exists(kinds, lambda flags: in_one(t, flags))))
    return F.when(F.size(base) == 0, terms).otherwise(free)


def _marked(found: DataFrame, hits: DataFrame, anywhere: bool = False) -> DataFrame:
    """The rows of ``found`` with the marks of their hits: n_id, n_key, start, end, ord.

    Hits ``anywhere`` have one verdict each and may overlap an entity, which drops them.
    """
    action = F.when(F.col("ord") == 0, ACTIONS[0]).otherwise(ACTIONS[1])
    mark = F.struct("start", (F.col("ord") + len(KINDS)).alias("ord"), "end", action.alias("kind"))
    lists = hits.groupBy("n_id", "n_key").agg(F.collect_set(mark).alias("terms"))
    # Near two entities a term may get two verdicts; the stronger stays.
    strongest = F.filter(
        "terms", lambda a: ~F.exists("terms", lambda b: (b["start"] == a["start"]) & (b["ord"] < a["ord"]))
    )
    terms = F.col("terms") if anywhere else strongest
    lists = lists.select("n_id", "n_key", terms.cast(MARK).alias("terms"))
    joined = found.join(lists, F.col("doc_id").eqNullSafe(F.col("n_id")) & (F.col("key") == F.col("n_key")), "left")
    terms = _free_of(F.col("base"), F.col("terms")) if anywhere else F.col("terms")
    return joined.select("doc_id", "key", "base", F.coalesce(terms, F.array().cast(MARK)).alias("terms"))


def _terms(text: Column) -> Column:
    """The distinct terms of a text; what is between them is quicker to find."""
    return F.array_remove(F.array_distinct(F.split(F.translate(text, UPPER, LOWER), GAP, -1)), "")


def _slot(term: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(slots))


def _slots(terms: DataFrame, slots: int) -> Column:
    """A bit for each of ``slots`` hashes, in words of 64, set where some term has that hash."""
    slot = _slot(F.col("term"), slots)
    bits = terms.select(F.floor(slot / 64).alias("i"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (slot % 64).cast("int")).alias("bit"))
    bits = bits.groupBy("i").agg(F.bit_or("bit").alias("bits"))
    every = terms.sparkSession.range(slots // 64).join(bits, F.col("id") == F.col("i"), "left")
    pair = F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))
    return every.agg(F.transform(F.array_sort(F.collect_list(pair)), lambda p: p["bits"])).scalar()


def _placed(docs: DataFrame, terms: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Where terms stand that may be among ``terms``: n_id, n_key, start, end, term.

    A text is searched only for those of its words whose bit is set, by a pattern that spells them.
    """
    slots = SLOTS
    while slots < min(16 * terms.count(), MOST_SLOTS):
        slots *= 2

    def may_be(bits: Column, term: Column) -> Column:
        slot = _slot(term, slots)
        return F.getbit(F.element_at(bits, (F.floor(slot / 64) + 1).cast("int")), (slot % 64).cast("int")) == 1

    # A subquery can't stand in a lambda. Beside plain columns only, Spark folds it into the step that uses it.
    rows = docs.select(F.col(quoted(doc_id)).alias("n_id"), F.col(quoted(text)).alias("raw"), _slots(terms, slots).alias("bits"))
    body = empty_as("raw")
    known = let(F.col("bits"), lambda bits: F.filter(_terms(body), lambda t: may_be(bits, t)))
    low = F.translate(body, UPPER, LOWER)
    rows = rows.select("n_id", F.xxhash64(body).alias("n_key"), low.alias("low"), known.alias("known"))
    # No filter: it would be pushed down, and the words of a text would be taken twice.
    some = F.size("known") > 0
    spelt = F.concat(F.lit(f"(?<!{LETTER})(?:"), F.array_join("known", "|"), F.lit(f")(?!{LETTER})"))
    pattern = F.when(F.size("known") <= SPELT, spelt).otherwise(F.lit(WORD))
    rows = rows.select("*", pattern.alias("pattern"))
    words = F.when(some, find(F.col("low"), F.col("pattern")))
    placed = rows.select("n_id", "n_key", F.explode(words).alias("w"))
    return placed.select("n_id", "n_key", "w.start", "w.end", F.col("w.value").alias("term"))


def find_whole(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", generalise: float = GENERALISE,
               remove: float = REMOVE) -> DataFrame:
    """Like ``find_all``, with every entity and its group rated, however rare, and no window.

    c(e,t) counts the documents that hold both, a term inside the entity included; a revealing
    term is marked wherever it stands, in any document, unless it overlaps an entity.
    """
    rows = _protected(docs, doc_id, text)
    groups = _with_groups(F.array_distinct(F.transform("named", lambda m: m["entity"])))
    own = F.when(F.size("named") > 0, _terms(F.col("text")))
    found = written(
        rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "key", "base", groups.alias("entities"), own.alias("own")), "mentions"
    )
    total = found.agg(F.count(F.lit(1)).alias("n"))
    counts = docs.select(F.explode(_terms(empty_as(text))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("c_t"))
    pairs, terms = shared_rows(found, counts, total, generalise)
    strong = rated(pairs, total, generalise, remove)
    revealing = written(terms.join(strong, "t").select("term", "ord"), "revealing")
    return _marked(found, _placed(docs, revealing, doc_id, text).join(revealing, "term"), anywhere=True)


def find_all(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """One row per row of ``docs``: doc_id, key, marks of the entities, marks of revealing terms."""
    found = written(mentions(docs, doc_id, text), "mentions")
    revealing = disclosures(docs, found, text, **limits)
    near = found.select(F.col("doc_id").alias("n_id"), F.col("key").alias("n_key"), F.explode("near").alias("n"))
    hits = near.select("n_id", "n_key", "n.*").join(revealing.select("entity", "term", "ord"), ["entity", "term"])
    return _marked(found, hits)


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", find: Callable = find_all, **limits) -> DataFrame:
    """doc_id and text: entities replaced by their kind, revealing terms generalised or removed."""
    found = find(docs, doc_id, text, **limits).select(F.col("doc_id").alias("f_id"), F.col("key").alias("f_key"), F.concat("base", "terms").alias("marks"))
    rows = docs.select(F.col(quoted(doc_id)).alias("doc_id"), empty_as(text).alias("text"))
    joined = rows.join(found.dropDuplicates(["f_id", "f_key"]), F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.xxhash64("text") == F.col("f_key")))
    word = lambda m: F.when(m["kind"] == "remove", F.lit("")).when(m["kind"] == "generalise", F.lit("[TERM]")).otherwise(F.concat(F.lit("["), F.upper(m["kind"]), F.lit("]")))
    return joined.select("doc_id", replaced(F.col("text"), F.col("marks"), word).alias("text"))
