import hashlib

import numpy as np
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
import helpers
from clinflat.llm import compression_rules
from clinflat.llm.queries import vocabulary
from test_decontamination import plain as leaks
from test_simhash import plain_fingerprint
from test_suffix import plain as without_repeats


def brute_force(docs, items):
    """The stages on plain lists; documents are (id, text), repeats of rows go at the second."""
    docs = [d for d in docs if compression_rules.judge_text(d[1])[-1]]
    prints = [plain_fingerprint(t) for _, t in docs]
    links = [
        (a, b) for a in range(len(docs)) for b in range(a)
        if (prints[a] ^ prints[b]).bit_count() <= 3
    ]
    root = helpers.roots(len(docs), links)
    first = {}
    for k, r in enumerate(root):
        if r not in first or docs[k][0] < docs[first[r]][0]:
            first[r] = k
    docs = sorted(docs[k] for k in first.values())
    kept = without_repeats([t for _, t in docs])
    docs = [(i, k[0].decode("utf-8", "ignore")) for (i, _), k in zip(docs, kept)]
    dirty = {d for d, _ in leaks(docs, items)}
    return [d for d in docs if d[0] not in dirty]


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{helpers.SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{helpers.SF}/benchmark.parquet").collect()
    want = brute_force(
        [(d["doc_id"], d["text"]) for d in docs], [(i["item_id"], i["text"]) for i in items]
    )
    library = Tokenizer.from_file(vocabulary())
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, helpers.SF).collect()}
    assert set(got) == {i for i, _ in want}
    for i, text in want:
        ids = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert bytes(got[i]["ids"]) == ids
        assert got[i]["ids_sha256"] == hashlib.sha256(ids).hexdigest()


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "repeated_text", "benchmark_leaks", "tokens"]
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    docs = spark.read.parquet(f"{helpers.SF}/documents.parquet").withColumnRenamed("lang", "h1")
    odd = docs.unionByName(docs.limit(20)).unionByName(
        helpers.awkward_rows(spark).withColumnRenamed("lang", "h1")
    )
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, odd, helpers.SF)
        assert out.columns == odd.columns and 0 < out.count() <= odd.count()
        none = step(spark, odd.limit(0), helpers.SF)
        assert none.columns == odd.columns and none.count() == 0
    tokens = corpus_pipeline.STAGES[-1][1]
    assert tokens(spark, odd, helpers.SF).count() == odd.count()
    assert tokens(spark, odd.limit(0), helpers.SF).count() == 0
