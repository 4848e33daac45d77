"""Personal data: fixed patterns, and information-theoretic sanitisation of the words that give them away.

Only DataFrame functions are used.  Two layers:

* Base spans: e-mail addresses, IPv4 addresses, card numbers and phone numbers by the patterns
  below, leftmost and not overlapping within a kind.
* Disclosing terms: the protected entities are the values found, what they share (e-mail domain,
  first digits of a number) and their kinds, so that a value of one text counts with its like.  Over
  the whole corpus (distinct texts) it is counted in how many texts an entity stands, in how many a
  term does (outside base spans), and in how many both do, wherever in the text.  A term discloses an
  entity if their pointwise mutual information reaches ``ALPHA`` of the entity's information content:

      log(n(t,e) N / (n(t) n(e)))  >=  ALPHA log(N / n(e))

  that is, if whoever reads the term has nearly the entity itself, and if that is no accident: the
  probability of so many common texts, were term and entity independent, is at most ``LEVEL`` over
  the number of (text, entity, term) counted.  It is bounded by Chernoff's exp(-n KL) from either side

      max(n(t) KL(n(t,e)/n(t), n(e)/N), n(e) KL(n(t,e)/n(e), n(t)/N))  >=  log(counted / LEVEL)

  so how many texts are evidence follows from the corpus: a word that all three texts of a value
  share tells more among a million texts than among a hundred.  Such terms are removed wherever
  they stand.

Matches are found by setting marks around them with one regular-expression replacement and cutting
at the marks; positions are sums of lengths in code points.  Possessive quantifiers and look-behinds
keep every pattern linear in the text and free of recursion, also on very long runs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import pin, split_by_keys

ALPHA = 0.9
LEVEL = 0.01            # expected number of accidental (entity, term) pairs in a whole corpus
BROADCAST_ROWS = 200_000  # candidate terms up to which they are broadcast (some 20 MB)

KINDS = ("email", "ip", "card", "phone", "term")
_MARK, _JOIN, _OTHER = "﷐", "﷑", "﷒"  # code points that are never characters
_LOCAL = "[A-Za-z0-9._%+-]"
_EMAIL = rf"((?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)"
_IP = r"((?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++)"
_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|(?<=0))"
_IP_GOOD = rf"^{_PART}(?:\.{_PART}){{3}}$"
_CARD = f"([0-9][0-9{_JOIN}]{{11,}}+)"
_PHONE = r"(\+[0-9][\x20().0-9-]+[0-9])"
_WORD = r"([\p{L}\p{N}]++)"
_SPAN = "struct<start:int,rank:int,end:int,value:string>"


def _clean(text: Column) -> Column:
    """The text with the mark code points replaced, should it hold any; lengths stay."""
    t = F.coalesce(text, F.lit(""))
    odd = F.contains(t, F.lit(_MARK)) | F.contains(t, F.lit(_JOIN))
    return F.when(odd, F.translate(t, _MARK + _JOIN, _OTHER * 2)).otherwise(t)


def text_key(text: Column) -> Column:
    """The key under which spans of a text are found."""
    return F.md5(_clean(text).cast("binary"))


def _matches(text: Column, pattern: str, rank: int, keep) -> Column:
    """Spans of ``pattern`` (one group around the whole) whose matched string satisfies ``keep``."""
    parts = F.split(F.regexp_replace(text, pattern, f"{_MARK}$1{_MARK}"), _MARK)
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), F.array().cast(f"array<{_SPAN}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        end = (acc["at"] + F.length(x)).cast("int")
        span = F.struct(acc["at"].alias("start"), F.lit(rank).alias("rank"), end.alias("end"), x.alias("value"))
        return F.struct(end.alias("at"), (~acc["inside"]).alias("inside"),
                        F.when(acc["inside"] & keep(x), F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, start, step, lambda acc: acc["out"])


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn check of a string of digits."""
    back = F.reverse(digits)

    def value(i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + value(i))
    return total % 10 == 0


def _between(x: Column, low: int, high: int) -> Column:
    return F.length(_digits(x)).between(low, high)


def base_spans(text: Column) -> Column:
    """Spans of the four fixed kinds in a text that holds no mark, by start and then kind."""
    none = F.array().cast(f"array<{_SPAN}>")
    email = F.when(F.contains(text, F.lit("@")), _matches(text, _EMAIL, 0, lambda x: F.lit(True))).otherwise(none)
    digit = F.rlike(text, F.lit(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"))
    ip = F.when(digit, _matches(text, _IP, 1, lambda x: F.rlike(x, F.lit(_IP_GOOD)))).otherwise(none)
    joined = F.regexp_replace(text, r"(?<=[0-9])[\x20-](?=[0-9])", _JOIN)
    card = F.when(F.rlike(text, F.lit(r"[0-9][0-9\x20-]{10,}[0-9]")), _matches(
        joined, _CARD, 2, lambda x: F.when(_between(x, 12, 19), _luhn(_digits(x))).otherwise(False))).otherwise(none)
    phone = F.when(F.contains(text, F.lit("+")), _matches(text, _PHONE, 3, lambda x: _between(x, 9, 15))).otherwise(none)
    return F.array_sort(F.concat(email, ip, card, phone))


def _words(text: Column, spans: Column) -> Column:
    """Distinct lower-case words of a text outside its spans."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.greatest(s["start"] - acc["at"], F.lit(0))
        return F.struct(F.concat(acc["out"], F.substring(text, acc["at"] + 1, gap), F.lit(" ")).alias("out"),
                        F.greatest(acc["at"], s["end"]).cast("int").alias("at"))

    rest = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    rest = F.when(F.size(spans) > 0, rest).otherwise(text)
    return F.array_remove(F.array_distinct(F.split(F.lower(rest), r"[^\p{L}\p{N}]++")), "")


def _entities(span: Column) -> Column:
    """A span's kind, what its value shares with others, and its value."""
    rank, value = span["rank"], span["value"]
    kind = rank.cast("string")
    number = F.when(rank >= 2, _digits(value)).otherwise(value)
    shared = F.when(rank == 0, F.substring_index(value, "@", -1)) \
        .when(rank == 1, F.substring_index(value, ".", 3)).otherwise(F.substring(number, 1, 6))  # network, issuer, area
    return F.array(kind, F.concat_ws("~", kind, shared), F.concat_ws(":", kind, number))


def find_base(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (hash of the text), spans (start, rank, end, value), words (outside the spans)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), _clean(F.col(f"`{text_col}`")).alias("__llm_text"))
    found = rows.select("doc_id", "__llm_text", F.md5(F.col("__llm_text").cast("binary")).alias("key"), base_spans(F.col("__llm_text")).alias("__llm_spans"))
    return found.select("doc_id", "key", F.transform("__llm_spans", lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), F.lower(s["value"]).alias("value"))).alias("spans"),
        _words(F.col("__llm_text"), F.col("__llm_spans")).alias("words"))


def _kl(p: Column, q: Column) -> Column:
    """Information of a coin of ``p`` against one of ``q``."""
    def part(x: Column, y: Column) -> Column:
        return F.when((x > 0) & (y > 0), x * F.log(x / y)).otherwise(0.0)

    return part(p, q) + part(1 - p, 1 - q)


def _telling(n_t: Column, total: int, counted: int, alpha: float, level: float) -> Column:
    """Does a term of ``n_t`` texts disclose its entity?  Never turns true as ``n_t`` grows."""
    texts = F.lit(float(max(total, 1)))
    information = F.log(texts / F.col("n_e"))
    share = F.log(F.col("n_te") * texts / (n_t * F.col("n_e"))) >= alpha * information
    evidence = F.greatest(n_t * _kl(F.col("n_te") / n_t, F.col("n_e") / texts), F.col("n_e") * _kl(F.col("n_te") / F.col("n_e"), n_t / texts))
    return (information > 0) & share & (evidence >= math.log(max(counted, 1) / level))


def disclosing_terms(base: DataFrame, *, alpha: float = ALPHA, level: float = LEVEL) -> DataFrame:
    """``key, terms``: per text that holds any, the terms that disclose a protected entity."""
    keys = base.groupBy("key").agg(F.count("*").alias("copies"))
    total = keys.count()
    copied = keys.where("copies > 1")
    if copied.count() <= BROADCAST_ROWS:
        copied = F.broadcast(copied)
    # every row of a text counts as its part of one text
    rows = base.join(copied, "key", "left").select("spans", "words", (F.lit(1.0) / F.coalesce("copies", F.lit(1))).alias("part"))
    texts = F.round(F.sum("part")).cast("long")
    held = rows.where(F.size("spans") > 0).select("words", "part", F.array_distinct(F.flatten(F.transform("spans", _entities))).alias("entities"))
    n_entity = held.select(F.explode("entities").alias("entity"), "part").groupBy("entity").agg(texts.alias("n_e"))
    counted = held.agg(F.round(F.coalesce(F.sum(F.size("words") * F.size("entities") * F.col("part")), F.lit(0))).cast("long")).collect()[0][0]
    # texts with the term and any entity: no more than those with the term, so a term that
    # fails by this count fails by the corpus count too, and common words need no counting
    n_held = held.select(F.explode("words").alias("term"), "part").groupBy("term").agg(texts.alias("n_h"))
    near = held.select("words", "part", F.explode("entities").alias("entity")).select("entity", "part", F.explode("words").alias("term")) \
        .groupBy("entity", "term").agg(texts.alias("n_te"))
    # no pair has more evidence than one whose term and entity stand nowhere else
    near = near.where(F.col("n_te") * F.log(F.lit(float(max(total, 1))) / F.col("n_te")) >= math.log(max(counted, 1) / level))
    near = near.join(n_entity, "entity").join(n_held, "term")
    near = pin(near.where(_telling(F.col("n_h"), total, counted, alpha, level)).select("entity", "term", "n_te", "n_e"), "near-terms")
    wanted = near.select("term").distinct()
    if near.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    n_term = rows.select(F.explode("words").alias("term"), "part").join(wanted, "term", "left_semi").groupBy("term").agg(texts.alias("n_t"))
    telling = near.join(n_term, "term").where(_telling(F.col("n_t"), total, counted, alpha, level)).select("term").distinct()
    telling = pin(telling, "telling-terms")
    if telling.count() <= BROADCAST_ROWS:
        telling = F.broadcast(telling)
    return base.select("key", F.explode("words").alias("term")).join(telling, "term", "left_semi") \
        .groupBy("key").agg(F.collect_set("term").alias("terms"))


def find_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA,
               level: float = LEVEL) -> DataFrame:
    """One row per row of ``docs``: doc_id, base (spans of the four kinds), spans (with disclosing terms).

    Spans are (start, rank, end) by start, in code points, end exclusive; rank counts ``KINDS``.
    Null and empty texts have none; equal texts have equal spans; ids play no part; other columns
    are not read; no rows give none.  A term inside a base span is no span of its own.
    """
    base = pin(find_base(docs, id_col=id_col, text_col=text_col), "pii-base")
    terms = pin(disclosing_terms(base, alpha=alpha, level=level), "pii-terms")
    extra = _term_spans(docs, terms, text_col)
    joined = base.join(extra, "key", "left")
    own = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))
    added = F.filter(F.coalesce("found", F.array().cast("array<struct<start:int,rank:int,end:int>>")),
                     lambda f: ~F.exists("spans", lambda s: (s["start"] < f["end"]) & (f["start"] < s["end"])))
    return joined.select("doc_id", "key", own.alias("base"), F.array_sort(F.concat(own, added)).alias("spans"))


def _term_spans(docs: DataFrame, terms: DataFrame, text_col: str) -> DataFrame:
    """``key, found``: spans of each text's disclosing terms, once per text."""
    texts = docs.select(_clean(F.col(f"`{text_col}`")).alias("__llm_text")).withColumn("key", F.md5(F.col("__llm_text").cast("binary")))
    if terms.count() <= BROADCAST_ROWS // 10:
        having = texts.join(F.broadcast(terms), "key")
    else:  # only texts that hold terms are shuffled
        having = split_by_keys(texts, "key", terms, "key")[1].join(terms, "key")
    found = _matches(F.col("__llm_text"), _WORD, 4, lambda x: F.array_contains(F.col("terms"), F.lower(x)))
    return having.select("key", found.alias("found")).select("key", F.transform("found", lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"))).alias("found")) \
        .groupBy("key").agg(F.first("found").alias("found"))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        grown = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(kinds, s["rank"] + 1))
        return F.struct(F.when(s["start"] >= acc["at"], grown).otherwise(acc["out"]).alias("out"),
                        F.greatest(acc["at"], s["end"]).cast("int").alias("at"))

    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
