from collections import Counter
from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
from brute import PATTERNS, base_spans, components, sha
from pyspark.sql import functions as F
from test_models import leaks
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from mercata.llm import common, jaccard, latent_retrieval, registry
from mercata.llm.common import pin, split_by_keys


def test_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "bpe"]
    names = {n.split("_")[0] for n in entry.queries()}
    assert {f"op{i}" for i in range(1, 11)} <= names and "pipeline" in names


def hidden(text):
    """The text with personal data replaced by its kind; overlapping spans become one."""
    out, at = "", 0
    for a, r, b in base_spans(text):
        if a >= at:
            out += text[at:a] + f"[{PATTERNS[r][0].upper()}]"
        at = max(at, b)
    return out + text[at:]


def test_pipeline_equals_the_plain_one(spark, sf, rows):
    scored = {r.doc_id: r.predicted for r in registry.op4_ftrl_toxicity(spark, sf).collect()}
    docs = [(d, t) for d, t in rows if not scored[d]]
    top = components(docs)
    docs = [(d, t) for d, t in docs if top[d][1] == d]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {d for d, _ in leaks(docs, items)}
    docs = [(d, hidden(t or "")) for d, t in docs if d not in bad]
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for d, t in docs:
        ids = lib.encode(t, add_special_tokens=False).ids
        want[d] = (len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want and 0 < len(got) < len(rows)


def test_stages_keep_columns_and_take_odd_rows(spark, sf, odd, nothing, odd_rows):
    more = ["__llm_key", "__LLM_key_", "__llm_out", "__llm_spans", "__llm_listed", "__llm_of", "row", "stays"]
    columns = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in more)
    docs = spark.createDataFrame([(d, t, "en", None, len(t or ""), *more) for d, t in odd_rows], columns)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert name == "bpe" or out.dtypes == docs.dtypes
        rows = out.collect()
        kept[name] = Counter(r.doc_id for r in rows)
        assert name == "bpe" or all([r[c] for c in more] == more for r in rows)
        assert stage(spark, nothing, sf).collect() == []
    ids = Counter(d for d, _ in odd_rows)
    assert kept["toxicity"] == kept["decontamination"] == kept["personal_data"] == kept["bpe"] == ids
    assert ids - kept["near_duplicates"] == Counter({5: 1, 9: 1})
    six = [r for r in corpus_pipeline.remove_personal_data(spark, docs, sf).collect() if r.doc_id == 6][0]
    assert "a.b@c.de" not in six.text and "10.0.0.256" in six.text and "[IP]" in six.text and six.n_chars == len(six.text)


def shuffled_rows(df):
    """Rows that the exchanges of a collected frame wrote, one number an exchange."""
    def exchanges(node):
        if node.nodeName() == "Exchange":
            yield node.metrics().apply("shuffleRecordsWritten").value()
        inner = [node.plan()] if node.nodeName().endswith("QueryStage") else []
        children = node.children()
        for child in inner + [children.apply(i) for i in range(children.size())]:
            yield from exchanges(child)

    df.collect()
    return list(exchanges(df._jdf.queryExecution().executedPlan().finalPhysicalPlan()))


def test_texts_that_no_list_names_are_not_shuffled(spark):
    """However long the list of spans or texts is: only the listed texts (and few others) are dealt out by a join."""
    docs = pin(spark.createDataFrame([(i, f"text {i} of much mail" + " a@b.cd" * (i % 100 == 0), 10) for i in range(4000)],
                                     "doc_id long, text string, n_chars long").repartition(4), "t")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cleared = corpus_pipeline.remove_personal_data(spark, docs, "")
        assert max(shuffled_rows(cleared)) <= 200
        got = {r.doc_id: (r.text, r.n_chars) for r in cleared.collect()}
        assert got == {i: (f"text {i} of much mail [EMAIL]", len(f"text {i} of much mail [EMAIL]")) if i % 100 == 0 else (f"text {i} of much mail", 10)
                       for i in range(4000)}
        keys = pin(docs.where("doc_id % 80 = 0").select(corpus_pipeline._text_key().alias("text_key"), "doc_id"), "t")
        for how, rest in (("left_semi", 0), ("left_anti", 1)):
            some = corpus_pipeline._listed(docs, keys, True, how)
            assert max(shuffled_rows(some)) <= 200 and some.dtypes == docs.dtypes
            assert sorted(r.doc_id for r in some.collect()) == [i for i in range(4000) if (i % 80 > 0) == rest]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_full_bitmap_of_keys_loses_no_row(spark, monkeypatch):
    """No key is missed, whatever the size of the bitmap; the join behind it is exact."""
    rows = spark.range(100_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("__llm_bucket"))
    keys = pin(rows.where("`__llm_bucket` % 10 = 3").select(F.col("k").alias("of")), "t")
    for most in (common.MOST_KEY_BITS, 1 << 15):
        monkeypatch.setattr(common, "MOST_KEY_BITS", most)
        others, maybe = split_by_keys(rows, "k", keys, "of")
        assert others.columns == maybe.columns == rows.columns
        assert others.join(keys, F.col("k") == F.col("of"), "left_semi").isEmpty()
        assert others.count() + maybe.count() == 100_000 and maybe.count() >= 10_000
        assert most == 1 << 15 or maybe.count() < 13_000
    others, maybe = split_by_keys(rows, "k", keys.limit(0), "of")
    assert others.count() == 100_000 and maybe.isEmpty()


def test_a_decontamination_task_gives_memory_back_after_its_own_objects_are_gone(monkeypatch):
    import weakref

    seen = []

    class Table:
        pass

    def task():
        table = Table()
        seen.append(weakref.ref(table))
        yield 1
        yield 2
        del table

    monkeypatch.setattr(common, "release_memory", lambda: seen.append(seen[0]()))
    got = common.released(task())
    assert next(got) == 1 and len(seen) == 1
    assert list(got) == [2] and seen[1:] == [None]


def test_arrow_batches_of_the_stages_are_bounded_and_hold_every_row(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(name, None)
    none = spark.createDataFrame([], "doc_id long, text string")
    docs = spark.range(0, 9_000, 1, 1).select(F.col("id").alias("doc_id"), F.lit("x" * 2_000).alias("text"))
    try:
        spark.conf.set(name, "1m")
        common.small_batches(spark)
        assert spark.conf.get(name) == "1m"  # the session's own bound stays
        spark.conf.unset(name)
        corpus_pipeline.encode(spark, none, "")
        got = docs.mapInArrow(lambda it: (pa.RecordBatch.from_arrays([pa.array([b.nbytes] * b.num_rows)], names=["n"]) for b in it), "n long")
        sizes = [r.n for r in got.collect()]
        assert len(sizes) == 9_000 and max(sizes) <= common.BATCH_BYTES + 10_000
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def test_tasks_hold_the_words_of_a_part_of_a_piece_and_give_the_same_rows(monkeypatch):
    texts = [None, "", "One two, three four!", "so on and so on " * 40, "two", " \n", "four three one " * 9, "x"] * 3
    ids = pa.array(range(len(texts)), pa.int64())
    docs = pa.RecordBatch.from_arrays([ids, pa.array(texts)], names=[latent_retrieval._DOC, latent_retrieval._TEXT])
    terms = SimpleNamespace(value={w: i for i, w in enumerate(["one", "two", "so", "on", "four"])})

    def rows():
        split = [b.to_pylist() for b in latent_retrieval._split(iter([docs]), terms, 4)]
        return split, [b.to_pylist() for b in jaccard._sets(iter([docs]), 5)]

    whole, seen = rows(), []
    for module, name in ((latent_retrieval, "_coded"), (jaccard, "shingle_sets")):
        def watched(part, *more, f=getattr(module, name)):
            seen.append((len(part), sum(map(len, part))))
            return f(part, *more)

        monkeypatch.setattr(module, name, watched)
        monkeypatch.setattr(module, "PART", 100)
    assert rows() == whole
    assert len(seen) > 6 and all(size < 100 + 640 for _, size in seen)
