import hashlib
import os
import random
import subprocess
import sys

import corpus_pipeline
from txrisk.llm.common import prepare
from txrisk.llm.queries import QUERIES, vocabulary_path

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def planted(spark):
    """The table and, behind it, documents with a known fate."""
    docs = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text.replace("\n", " ")
    passage = words(1, 70)
    rows = [
        (900001, words(11, 80)), (900002, words(12, 80) + " " + item + " " + words(13, 80)), (900003, "12345 !!!"), (900004, None),
        (900005, words(14, 40) + "\n" + passage), (900006, words(15, 40) + "\n" + passage), (900007, words(11, 80)),
    ]
    extra = spark.createDataFrame([(i, t, "en", "x", len(t or "")) for i, t in rows], docs.schema)
    return docs.unionByName(extra), passage


def test_stages_do_their_work(spark):
    docs, passage = planted(spark)
    columns, done = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        docs = docs.persist()
        done[name] = rows_of(docs)
        assert len(done[name]) == docs.count()
    assert not {900003, 900004} & done["language_id"].keys()
    assert {900001, 900002, 900005, 900006, 900007} <= done["language_id"].keys()
    assert 900007 not in done["simhash_dedup"] and 900001 in done["simhash_dedup"]
    texts = {i: r.text for i, r in done["substring_dedup"].items()}
    assert passage in texts[900005] and passage not in texts[900006] and texts[900006] == words(15, 40)
    assert 900002 not in done["decontamination"]
    assert {900001, 900005, 900006} <= done["decontamination"].keys()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    for i, r in done["bpe"].items():
        assert r.ids == tokenizer.encode(done["decontamination"][i].text, add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(r.ids, skip_special_tokens=False).encode()).hexdigest()


def test_run_applies_the_stages(spark):
    docs = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    key = lambda r: (r.doc_id, r.n_tokens, r.ids_sha256)
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, docs.collect()))


def test_stages_on_odd_and_empty_documents(spark, odd_docs, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd_docs, SF)
        assert out.count() <= odd_docs.count()
        assert stage(spark, no_docs, SF).count() == 0


def test_one_query_per_operator():
    numbers = [int(f.__name__[2:].split("_")[0]) for f in QUERIES]
    assert numbers == list(range(1, 11))


def test_entry_without_the_subpackage():
    """The other queries are there without the operators; nothing else imports them."""
    code = (
        "import sys; sys.modules['txrisk.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; names = set(e.queries())\n"
        "assert 'feature_table' in names and 'pipeline' not in names and not any(n.startswith('op1') for n in names)\n"
        "assert set(e.oracle_sql()) <= names"
    )
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], cwd=top, check=True, timeout=120)
