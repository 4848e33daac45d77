import math
import random
import re
from collections import Counter

from brute import PATTERNS, base_spans, sha, span_text
from pyspark.sql import functions as F

from mercata.llm import registry, sanitise
from mercata.llm.sanitise import find_spans, redact, span_list

PARTS = ["a", "B.", "@", "b-c", ".com", "x%", "_", "+", "1", "22", "255", "256", ".", "-", " ", "(", ")", "4111 1111 1111 1111", "+49 30 ", "123456", "0",
         "00", "é", "\n", "  ", "﷐", "﷑"]


def expected(text):
    b = base_spans(text)
    return (*(sum(r == k for _, r, _ in b) for k in range(4)), sha(span_text(b)))


def test_query_equals_plain_patterns(spark, sf, rows):
    got = {r.doc_id: r for r in registry.op5_disclosure_spans(spark, sf).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        r = got[d]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == expected(t)
        assert [x for x in r.spans.split(",") if x and not x.startswith("term")] == [x for x in span_text(base_spans(t)).split(",") if x]


def test_patterns_on_random_strings_and_long_runs(spark):
    r = random.Random(2)
    docs = [(i, "".join(r.choice(PARTS) for _ in range(r.randint(0, 25)))) for i in range(2000)]
    docs += [(5000, None), (5001, ""), (5002, "a.b" * 20000), (5003, "1 " * 20000), (5005, "a@" + "b." * 20000), (5006, "+1" + " " * 40000 + "x")]
    got = {x.doc_id: x for x in find_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for d, t in docs:
        assert [(s.start, s.rank, s.end) for s in got[d].base] == base_spans(t), t


def test_terms_that_disclose_an_entity_are_found_and_common_ones_are_not(spark):
    """'zorblax' stands in nearly no text without the address; 'the' and 'mail' do."""
    docs = [(i, f"the {w} team of zorblax answers mail at zed@corp.example every day") for i, w in enumerate(["red", "blue", "green", "grey"])]
    docs += [(10 + i, f"the other text number w{i} has mail and the day and every team") for i in range(60)]
    docs += [(90, "Zorblax alone, é zorblax."), (91, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in find_spans(frame).withColumn("s", span_list(F.col("spans"))).collect()}
    text = dict(docs)
    terms = {d: [text[d][s.start:s.end].lower() for s in r.spans if s.rank == 4] for d, r in got.items()}
    assert all("zorblax" in terms[d] and not {"the", "mail", "team", "day", "every"} & set(terms[d]) for d in range(4))
    assert terms[90] == ["zorblax", "zorblax"] and got[90].base == []
    assert all(not terms[d] for d in (*range(10, 70), 91))
    assert got[0].s.count("email:") == 1 and got[0].s.count(",") == len(got[0].spans) - 1
    # few texts together are no evidence
    assert not any(s.rank == 4 for r in find_spans(frame.where("doc_id in (0, 1) or doc_id >= 10")).collect() for s in r.spans)


def test_redaction_merges_overlaps(spark):
    t = "é call +378282246310005 or x@y.zz"  # a phone number that holds a card number
    row = spark.createDataFrame([(1, t)], "doc_id long, text string")
    spans = find_spans(row).select("spans")
    out = row.crossJoin(spans).select(redact(F.col("text"), F.col("spans")).alias("o")).first().o
    assert "@" not in out and "3782" not in out and out == "é call [PHONE] or [EMAIL]"


def test_odd_rows_and_empty_table(odd, nothing, odd_rows):
    got = find_spans(odd).collect()
    assert Counter((r.doc_id, tuple((s.start, s.rank, s.end) for s in r.base)) for r in got) == Counter((d, tuple(base_spans(t))) for d, t in odd_rows)
    assert find_spans(nothing).collect() == []
    assert [k for k, _, _ in PATTERNS] == ["email", "ip", "card", "phone"]


def plain_terms(texts, spans_of):
    """Terms that disclose a kind, a shared part or a value, counted one distinct text at a time."""
    n_t, n_e, n_te, counted = Counter(), Counter(), Counter(), 0
    texts = set(texts)
    for t in texts:
        rest, at, entities = "", 0, set()
        for a, k, b in spans_of(t):
            v = t[a:b].lower()
            number = "".join(c for c in v if c.isdigit()) if k >= 2 else v
            entities |= {f"{k}", f"{k}:{number}", f"{k}~{[v.split('@')[-1], v.rsplit('.', 1)[0], number[:6], number[:6]][k]}"}
            rest, at = rest + t[at:max(a, at)] + " ", max(at, b)
        words = {w for w in re.split(r"[\W_]+", (rest + t[at:]).lower()) if w}
        n_t.update(words)
        n_e.update(entities)
        n_te.update((e, w) for e in entities for w in words)
        counted += len(entities) * len(words)

    def kl(p, q):
        return sum(x * math.log(x / y) for x, y in ((p, q), (1 - p, 1 - q)) if x > 0 and y > 0)

    n, out = len(texts), set()
    for (e, w), both in n_te.items():
        evidence = max(n_t[w] * kl(both / n_t[w], n_e[e] / n), n_e[e] * kl(both / n_e[e], n_t[w] / n))
        if n_e[e] < n and math.log(both * n / (n_t[w] * n_e[e])) >= 0.9 * math.log(n / n_e[e]) and evidence >= math.log(counted / 0.01):
            out.add(w)
    return out


def test_terms_far_from_values_that_never_repeat(spark):
    """Every address and number stands in one text; the telling words stand 60 words before it."""
    r = random.Random(8)
    fill = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(300):
        words = r.choices(fill, k=80)
        if i < 12:
            words = ["Zorblax", *words[:60], f"p{i}@corp.example", *words[60:], "corp"]
        elif i < 24:
            words = ["quuxish", *words[:60], f"+49 30 12{i}456", *words[60:]]
        elif i < 30:
            words = [*words, f"p{i}@other.example"]
        docs += [(i, " ".join(words))] * r.choice((1, 1, 3))
    docs += [(900, "zorblax without any address"), (901, None)]
    got = find_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    text = dict(docs)
    terms = {(row.doc_id, text[row.doc_id][s.start:s.end].lower()) for row in got for s in row.spans if s.rank == 4}
    want = plain_terms([t or "" for _, t in docs], base_spans)
    assert {"zorblax", "quuxish", "corp"} == want == {w for _, w in terms}
    assert {d for d, w in terms if w == "zorblax"} == {*range(12), 900} and {d for d, w in terms if w == "quuxish"} == set(range(12, 24))


def test_terms_of_random_corpora(spark):
    """Shared parts and values that repeat, among texts of many entities, against one text at a time."""
    for seed in (1, 2):
        r = random.Random(seed)
        docs = []
        for i in range(220):
            words = r.choices([f"w{k}" for k in range(60)], k=r.randint(3, 30))
            for g in range(4):
                if r.random() < 0.09:
                    k = r.randint(0, 2)
                    words += [f"group{g}", f"tell{g}{k}", (f"a{r.randint(0, 2)}@g{g}.example", f"10.{g}.7.{r.randint(1, 3)}", f"+49 30 9{g}12345")[k]]
            if i % 40 == 0:
                words += [f"x{r.randint(0, 999)}@host{k}.example" for k in range(30)]
            docs.append((i, " ".join(words)))
        docs += [(1000 + i, docs[r.randint(0, 219)][1]) for i in range(60)]
        got = find_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()
        text = dict(docs)
        want = plain_terms(list(text.values()), base_spans)
        assert {text[row.doc_id][s.start:s.end].lower() for row in got for s in row.spans if s.rank == 4} == want and want


def test_terms_of_many_texts_are_found_without_a_broadcast(spark, monkeypatch):
    """The same spans where the texts with terms are too many to be sent to every task."""
    docs = [(i, f"the {i} team of zorblax answers mail at zed@corp.example") for i in range(8)]
    docs += [(10 + i, f"the other text number w{i} has mail and every team") for i in range(90)] + [(200, "Zorblax"), (201, None), (202, "Zorblax")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted(find_spans(frame).select("doc_id", span_list(F.col("spans"))).collect())
    assert sum("term" in s for _, s in want) == 10
    monkeypatch.setattr(sanitise, "BROADCAST_ROWS", 0)
    assert sorted(find_spans(frame).select("doc_id", span_list(F.col("spans"))).collect()) == want
