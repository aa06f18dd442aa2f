"""Rows of the pipeline's stages against brute force."""

import random

from cases import components, shingle_set
from conftest import SF

import corpus_pipeline as pipe


def near_groups(pairs, percent=80):
    """Smallest linked id of every id, from all pairs."""
    sets = [(i, shingle_set(t)) for i, t in sorted(pairs)]
    label = {i: i for i, _ in sets}
    for x, (i, s) in enumerate(sets):
        for j, t in sets[:x]:
            both = len(s & t)
            if both and 100 * both >= percent * (len(s) + len(t) - both) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = {k: new if v == old else v for k, v in label.items()}
    return label


def test_near_duplicates_from_four_fifths(spark):
    """Copies at 0.82 and at exactly 0.8 go, at 0.77 they stay; chains between them count."""
    draw = random.Random(8)
    texts = []
    for group in range(12):
        start = [f"g{group}-{i}" for i in range(139 if group % 2 else 160)]
        texts.append(" ".join(start))
        for changes in (3, 4):
            own = list(start)
            for k in range(changes):
                own[10 + 30 * k + draw.randrange(5)] = f"n{group}-{changes}-{k}"
            texts.append(" ".join(own))
    docs = list(enumerate(texts))
    near = near_groups(docs)
    assert near != components(docs) and len(set(near.values())) > 12
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs],
                               "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id for r in pipe.near_duplicates(spark, df, SF).collect()}
    assert got == {i for i in near if near[i] == i}
