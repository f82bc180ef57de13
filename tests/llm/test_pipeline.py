"""The pipeline against its parts."""

import collections
import hashlib
import re

import corpus_pipeline
import numpy as np
import public_tokenizers
import tiktoken

from railpulse.llm import bpe, mixing, simhash, toxicity
from railpulse.llm.common import query_scratch, table
from tests.conftest import SF
from tests.llm.test_simhash import slow_groups, slow_print


def test_stages_and_their_whole(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "mix", "encode"]
    scratch = query_scratch(spark)
    scores = {r.doc_id: r.predicted for r in toxicity.score_documents(docs, table(spark, SF, "labels"), scratch).collect()}
    clean = [r for r in docs.collect() if not scores[r.doc_id]]
    assert 0 < len(clean) < len(scores)
    prints = [(r.doc_id, slow_print(r.text)) for r in clean]
    of = slow_groups(prints)
    kept = [r for r, p in zip(clean, prints) if of[p] == r.doc_id]
    taken = {r.doc_id: r.taken for r in mixing.mix_report(spark.createDataFrame(kept, docs.schema), scratch).collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == {i for i, n in taken.items() if n}
    assert max(collections.Counter(r.doc_id for r in rows).values()) == 2
    assert all(r.n_tokens > 0 and len(r.ids) == 4 * r.n_tokens for r in rows)
    # Ids are those of the library, and what they decode to are runs of the document's own words, as many as the mix takes.
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe._ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    whole, words = {r.doc_id: r.text for r in kept}, collections.Counter()
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        data = library.decode_bytes(ids)
        assert ids == library.encode_ordinary(data.decode())
        assert r.decoded_sha256 == hashlib.sha256(data).hexdigest()
        own = re.findall(r"[^\x20\x09-\x0D]+", data.decode())
        every = re.findall(r"[^\x20\x09-\x0D]+", whole[r.doc_id])
        assert data.decode() in whole[r.doc_id] and any(every[i:i + len(own)] == own for i in range(len(every)) if every[i] == own[0])
        words[r.doc_id] += len(own)
    assert words == {i: n for i, n in taken.items() if n}


def test_every_stage_takes_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "a b c d", "en", "s", 7), (2, "a b c d", "en", "s", 7), (3, "x " * 70_000, None, "", 1)],
        table(spark, SF, "documents").schema)
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SF)
            assert name == "encode" or out.schema.names == docs.schema.names
            assert out.count() <= 2 * rows.count()
