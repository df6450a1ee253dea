"""The pipeline's stages against separate means: dictionary counts, SQL, all pairs of sets, the tokenizer."""

import hashlib
import itertools
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from compare import connect
from review_pulse.llm import byte_bpe, language_id, oracle

STAGES = dict(corpus_pipeline.STAGES)


def rows_of(frame):
    return [r.asDict() for r in frame.collect()]


def written(spark, frame, folder):
    folder.mkdir()
    frame.toPandas().to_parquet(folder / "documents.parquet")
    return spark.read.parquet(str(folder / "documents.parquet"))


def shingles(text, width=5):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(words)} if 0 < len(words) < width else {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def test_pipeline_equals_its_stages_checked_one_by_one(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    named = STAGES["language_id"](spark, docs, sf_dir)
    model = language_id.fit(docs, may_learn=~corpus_pipeline.language_id.held_out(docs["doc_id"]))[0]
    want = {}
    for r in rows_of(docs):
        if language_id.has_letter(r["text"]):
            logs = language_id.log_scores(model, [r["text"]])[0]
            if 1 / np.exp(logs - logs.max()).sum() >= 0.5:
                want[r["doc_id"]] = model.languages[logs.argmax()]
    assert {r["doc_id"]: r["lang"] for r in rows_of(named)} == want and named.columns == docs.columns

    named = written(spark, named, tmp_path / "named")
    judged = STAGES["quality_rules"](spark, named, sf_dir)
    verdicts = connect(str(tmp_path / "named")).execute(oracle.SQL["op2_quality_rules"])
    places = [d[0] for d in verdicts.description]
    good = {row[places.index("doc_id")] for row in verdicts.fetchall() if row[places.index("kept")]}
    assert {r["doc_id"] for r in rows_of(judged)} == good and judged.columns == docs.columns

    judged = written(spark, judged, tmp_path / "judged")
    single = STAGES["near_dedup"](spark, judged, sf_dir)
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows_of(judged)}
    group = {k: k for k in sets}
    for x, y in itertools.combinations(sorted(sets), 2):
        if group[x] != group[y] and sets[x] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
            low, high = sorted((group[x], group[y]))
            group = {k: low if v == high else v for k, v in group.items()}
    assert len(set(group.values())) < len(group)
    assert sorted(group[r["doc_id"]] for r in rows_of(single)) == sorted(set(group.values()))

    single = written(spark, single, tmp_path / "single")
    mixed = STAGES["source_mix"](spark, single, sf_dir)
    taken = connect(str(tmp_path / "single")).execute(oracle.SQL["op3_source_mix"])
    names = [d[0] for d in taken.description]
    want = Counter()
    for row in (dict(zip(names, r)) for r in taken.fetchall()):
        want[row["doc_id"]] = int(row["taken"] / row["size"] + 0.5) if row["size"] else 0
    assert Counter(r["doc_id"] for r in rows_of(mixed)) == +want

    mixed = written(spark, mixed, tmp_path / "mixed")
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in rows_of(mixed):
        ids = own.encode_ordinary(r["text"])
        want.append((r["doc_id"], r["source"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(r["text"].encode()).hexdigest()))
    assert sorted(map(tuple, STAGES["byte_bpe"](spark, mixed, sf_dir).collect())) == sorted(want)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(want)
