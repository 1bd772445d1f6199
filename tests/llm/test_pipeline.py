"""The pipeline's stages against plain versions, each on its own input."""

import collections

import corpus_pipeline
from corvid.llm import pii, quality
from corvid.llm.spark_util import read_table, stored
from tests.conftest import SF_SMALL
from tests.llm.test_neardup import brute_classes
from tests.llm.test_packing import check as check_packing
from tests.llm.test_tables import plain_mix


def test_stages(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), name)
        tables.append(docs)
    rows = [[tuple(r) for r in t.collect()] for t in tables]
    start, good, single, clean, mixed, packed = rows
    assert all(t.columns == tables[0].columns for t in tables[:5])

    labels = read_table(spark, SF_SMALL, "labels")
    scores = quality.quality_scores(tables[0], *quality.fit(tables[0], labels)).collect()
    keep = {r.doc_id for r in scores if r.score >= 0.3}
    assert sorted(good) == sorted(r for r in start if r[0] in keep)

    classes = brute_classes([(r[0], r[1]) for r in good])
    assert sorted(r[0] for r in single) == sorted(set(classes)) and set(single) <= set(good)

    spans = {r.key: r for r in pii.personal_spans(tables[2]).collect()}
    by_id = {r[0]: r for r in clean}
    assert len(clean) == len(single) == len(by_id)
    for r in single:
        new = by_id[r[0]]
        if not spans[r[0]].base:
            assert new == r
        else:
            assert all(r[1][s.start:s.end] not in new[1] for s in spans[r[0]].base) and new[4] == len(new[1])

    size = {r[0]: len((r[1] or "").split()) for r in clean}
    copies = collections.Counter(r[0] for r in mixed)
    assert set(mixed) <= set(clean) and max(copies.values()) <= 3
    sizes, target = plain_mix([(r[0], r[3], size[r[0]]) for r in clean], (5, 2, 1), 3)
    taken = collections.Counter()
    for r in mixed:
        taken[r[3]] += size[r[0]]
    assert all(abs(taken[s] - target[s]) <= max(size.values()) for s in sizes)

    check_packing(spark, [(r[0], r[1]) for r in mixed], 2048)
    assert collections.Counter(r[0] for r in packed if r[1] == 0) == copies
